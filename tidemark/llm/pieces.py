"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they form, leftmost first among
equals; the best pair is merged, its new neighbours enter the agenda, and entries whose symbols have changed are
skipped. Symbols without a piece fall back to bytes. No piece crosses from another character into a space mark or
touches a character that occurs in no longer piece, so texts are cut there, and each stretch is encoded once per
worker and remembered. Every Arrow batch is checked against the sentencepiece library.

Defined results: null counts as empty; an empty text has only the begin and end ids and decodes to the empty text;
repeated rows each get their row; an empty table gives an empty result; further columns are ignored. Texts are
processed whole, whatever their length.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb

from .common import map_texts

#: Stretches that a worker remembers, in two generations: when the young one holds half, it becomes the old one, and of
#: that only what is met again comes along.
STRETCHES = 1_000_000
#: Bytes of text encoded at once: a stretch that is new in them is learned once.
SLICE = 4_000_000
MARK = "▁"


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceCodec:
    """A merge-type vocabulary with identity normalisation, compiled from a .model file."""

    def __init__(self, path: str, stretches: int = STRETCHES):
        self.stretches = stretches
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = model_pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only merge-type models with identity normalisation and a prefix mark are supported")
        kind = model_pb.ModelProto.SentencePiece
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in spec.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL}
        scores = sorted({p.score for p in spec.pieces if p.type == kind.NORMAL}, reverse=True)
        order = {x: i for i, x in enumerate(scores)}
        self.ranks = {p.piece: order[p.score] for p in spec.pieces if p.type == kind.NORMAL}
        byte = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == kind.BYTE}
        if len(byte) != 256:
            raise ValueError("the model has no byte fallback")
        self.bytes = [byte[b] for b in range(256)]
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        longer = {c for p in self.ids if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.ids) or "\n" in longer:
            self.split, self.cut = False, re.compile(r"(?s).+")
        else:  # a line feed is in no longer piece, so it stands alone
            self.split = True
            self.cut = re.compile(" *[^ \n]+| +|\n")
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def agenda(self, text: str) -> list[int]:
        """Ids of one stretch of normalised text.

        Agenda entries are numbers: the rank of the piece's score, then the position of its left symbol. Every symbol
        knows the entry of its pair with the next one, if that is a piece; an entry that its symbol no longer knows is
        stale.
        """
        symbols, n = list(text), len(text)
        rank, none = self.ranks.get, -1
        live = [none if (r := rank(x + y)) is None else r << 32 | i for i, (x, y) in enumerate(zip(symbols, symbols[1:]))]  # noqa: B905
        queue = [e for e in live if e >= 0]
        if queue:
            live.append(none)
            heapq.heapify(queue)
            pop, push = heapq.heappop, heapq.heappush
            before, after = list(range(-1, n)), list(range(1, n + 1))
            while queue:
                entry = pop(queue)
                left = entry & 0xFFFFFFFF
                if live[left] != entry:
                    continue
                right = after[left]
                symbols[left] = piece = symbols[left] + symbols[right]
                symbols[right], live[right] = "", none
                following = after[left] = after[right]
                live[left] = none
                if following < n:
                    before[following] = left
                    r = rank(piece + symbols[following])
                    if r is not None:
                        live[left] = entry = r << 32 | left
                        push(queue, entry)
                previous = before[left]
                if previous >= 0:
                    r = rank(symbols[previous] + piece)
                    if r is None:
                        live[previous] = none
                    else:
                        live[previous] = entry = r << 32 | previous
                        push(queue, entry)
        ids, out = self.ids, []
        for s in filter(None, symbols):
            found = ids.get(s)
            if found is None:
                out += [self.bytes[b] for b in s.encode()]
            else:
                out.append(found)
        return out

    def _learn(self, stretches: list[str]) -> dict[str, bytes]:
        """Encode stretches that are not in memory, each held against the library; a difference is an error, not a result.

        Behind a line feed, which stands alone, the library adds no mark, so its ids follow the two of mark and feed.
        """
        out, agenda, memo = {}, self.agenda, self.memo
        lead, skip = ("\n", 2) if self.split else ("", 0)
        theirs = self.library.encode([lead + (s if self.split else s[1:]) for s in stretches], num_threads=1)
        for s, ids in zip(stretches, theirs, strict=True):
            own = agenda(s.replace(" ", MARK))
            if own != ids[skip:]:
                raise ValueError("the agenda and the sentencepiece library disagree on a text")
            out[s] = packed(own)
            if len(s) <= 64:
                memo[s] = out[s]
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, with begin and end, checked against the library."""
        if len(self.memo) >= self.stretches // 2:
            self.old, self.memo = self.memo, {}
        # Marks of the text itself count as spaces; stretches are kept with spaces, which take half the room.
        cut = [self.cut.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        memo = self.memo
        new = {s for stretches in cut for s in stretches if s not in memo}
        met = new & self.old.keys()
        memo.update((s, self.old[s]) for s in met)
        new = sorted(new - met)
        more = self._learn(new) if new else {}
        if more:
            known = memo.get
            return [self.begin + b"".join([known(s) or more[s] for s in stretches]) + self.end for stretches in cut]
        return [self.begin + b"".join([memo[s] for s in stretches]) + self.end for stretches in cut]

    def decode(self, encoded: list[bytes]) -> list[str]:
        return self.library.decode([np.frombuffer(x, "<u4").tolist() for x in encoded], num_threads=1) if encoded else []


@functools.cache
def codec(path: str, stretches: int = STRETCHES) -> PieceCodec:
    return PieceCodec(path, stretches)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (array of int, with begin and end)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(x, "<u4") for x in codec(path).encode_batch([t or "" for t in batch.column(1).to_pylist()])]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, ids array<int>", SLICE)


def digest_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding without shipping the ids."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        encoded = c.encode_batch([t or "" for t in batch.column(1).to_pylist()])
        sha = lambda x: hashlib.sha256(x).hexdigest()
        decoded = [sha(t.encode()) for t in c.decode(encoded)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) // 4 for x in encoded], pa.int64()), pa.array([sha(x) for x in encoded], pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string", SLICE)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", stretches: int = STRETCHES, batch_bytes: int = SLICE) -> DataFrame:
    """Per row: doc_id, ids (array of int, with begin and end), n_tokens, decoded (the text that the ids decode to).

    `stretches` and `batch_bytes` bound a worker's memory; less of it costs time and changes nothing else.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path, stretches)
        encoded = c.encode_batch([t or "" for t in batch.column(1).to_pylist()])
        ids = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in encoded], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array([len(x) // 4 for x in encoded], pa.int64()), pa.array(c.decode(encoded), pa.string())], ["doc_id", "ids", "n_tokens", "decoded"])

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, ids array<int>, n_tokens long, decoded string", batch_bytes)
