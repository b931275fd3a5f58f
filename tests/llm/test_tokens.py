import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tests.llm.samples import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import pieces, token_counts
from tidemark.llm.queries import QUERIES

BPE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", "it's 'twas we're we'll they'd 'r 'v 'l 're 've 'll x'lx 'rx", "a  b   c\n\n d \n e\t f", "  lead", "trail  ", "\n", "'", " '", "  'x'", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>",
    "漢字かな交じり文 123٣ ½", "😀👍🏽 é ﬁ", "''''s", "a'b'c's", "a" * 700, "\x00\x01\x7f\x80ÿ", " a b\u0085c　d​e", "▁▁ ▁x", "<s> </s> <unk> <0x0A>", "x" * 65 + " " + "y" * 65,
]


@pytest.fixture(scope="module")
def bpe():
    return token_counts.TokenCounter(BPE), Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)


def counts_of(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_odd_texts(bpe):
    ours, library = bpe
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choice("abcdest 'rvelm\n\t  'X1é漢!?-_ ") for _ in range(draw.randint(0, 300))) for _ in range(800)]
    texts += ["".join(chr(draw.randrange(1, 0xD7FF)) for _ in range(draw.randint(0, 60))) for _ in range(300)]
    assert ours.counts(texts).tolist() == counts_of(library, texts)
    assert [int(ours.counts([t])[0]) for t in ODD] == counts_of(library, ODD) and ours.counts([]).tolist() == []


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_counts_of_any_text(text):
    ours, library = token_counts.counter(BPE), Tokenizer.from_file(BPE) if not hasattr(test_counts_of_any_text, "t") else test_counts_of_any_text.t
    test_counts_of_any_text.t = library
    assert ours.counts([text]).tolist() == counts_of(library, [text])


def test_scan_composes_maps():
    draw = np.random.default_rng(0)
    maps = draw.integers(0, 13, (37, 13)).astype(np.uint8)
    state, out = np.arange(13), token_counts.scan_maps(maps)
    for i, m in enumerate(maps):
        state = m[state]
        assert (out[i] == state).all()


def test_boundaries_by_one_pass():
    classes, step, emit = token_counts._tables()
    text = "It's  a\n\n test 'll'x 12ab  " * 50
    cls = np.append(classes[[ord(c) for c in text]], token_counts.END)
    state, marks = 0, set()
    for i, c in enumerate(cls):
        e = emit[c, state]
        marks |= ({i} if e & token_counts.HERE else set()) | ({i - 1} if e & token_counts.BEFORE else set())
        state = step[c, state]
    assert token_counts.boundaries(cls).tolist() == sorted(marks)


def test_machine_starts_afresh(bpe, monkeypatch):
    monkeypatch.setattr(token_counts, "STATES", 50)
    monkeypatch.setattr(token_counts, "PIECES", 20)
    ours = token_counts.TokenCounter(BPE)
    assert ours.counts(ODD).tolist() == counts_of(bpe[1], ODD) and len(ours.machine.states) < 2000


def test_pieces_of_odd_texts(codec):
    ours, library = codec
    draw = random.Random(2)
    texts = ODD + ["".join(draw.choice("abcdest  \n\tX1é漢!?▁ ") for _ in range(draw.randint(0, 200))) for _ in range(500)]
    want = [np.array(x, "<u4").tobytes() for x in library.encode(texts, add_bos=True, add_eos=True)]
    assert ours.encode_batch(texts) == want
    assert ours.decode(want) == [library.decode(np.frombuffer(x, "<u4").tolist()) for x in want]


def test_agenda_order(codec):
    ours, library = codec
    for word in ("▁internationalization", "▁▁▁▁▁x", "aaaaaaa", "▁", "漢字"):
        assert ours.agenda(word) == library.encode("\n" + word)[2:]


def test_memo_starts_afresh(codec, monkeypatch):
    monkeypatch.setattr(pieces, "STRETCHES", 5)
    ours = pieces.PieceCodec(PIECE)
    for _ in range(3):
        assert ours.encode_batch(ODD) == [np.array(x, "<u4").tobytes() for x in codec[1].encode(ODD, add_bos=True, add_eos=True)]


def test_queries_against_the_libraries(spark, bpe, codec):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op9_token_counts"](spark, SF).collect():
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), counts_of(bpe[1], [texts[r.doc_id]])[0]) and r.over_limit == (r.n_tokens > 1024)
    for r in QUERIES["op6_pieces"](spark, SF).collect():
        ids = codec[1].encode(texts[r.doc_id], add_bos=True, add_eos=True)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(codec[1].decode(ids).encode()))


def test_hard_rows(hard, empty):
    got = token_counts.count_tokens(hard, BPE).collect()
    assert len(got) == 15 and {r.n_tokens for r in got if r.n_bytes == 0} == {0}
    assert token_counts.count_tokens(empty, BPE).count() == 0
    got = pieces.digest_texts(hard, PIECE).collect()
    assert len(got) == 15 and sum(r.n_tokens == 2 for r in got) == 3
    assert pieces.digest_texts(empty, PIECE).count() == 0
    got = pieces.encode_decode(hard, PIECE).filter("doc_id = 8").collect()
    assert [r.decoded for r in got] == ["word"] * 2 and pieces.encode_texts(hard, PIECE).filter("doc_id = 3").first().ids == [1, 2]
