import hashlib
import zlib

import numpy as np
import pytest
from tests.llm.samples import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import media, webp
from tidemark.llm.queries import QUERIES


def images():
    draw = np.random.default_rng(0)
    for w, h in ((1, 1), (7, 5), (33, 20), (64, 16)):
        yield draw.integers(0, 2**32, (h, w), dtype=np.uint32)
        yield webp.BLACK | (np.add.outer(np.arange(h), np.arange(w)).astype(np.uint32) * np.uint32(0x010203) & np.uint32(0xFFFFFF))
        yield np.tile(draw.integers(0, 2**32, (1, max(1, w // 3)), dtype=np.uint32), (h, 4))[:, :w]
        for n in (2, 4, 16, 200):
            yield draw.integers(0, 2**32, n, dtype=np.uint32)[draw.integers(0, n, (h, w))]


def options(shape):
    draw = np.random.default_rng(3)
    blocks = (-(-shape[0] // 4), -(-shape[1] // 4))
    modes, colours, groups = draw.integers(0, 14, blocks), draw.integers(0, 2**32, blocks, dtype=np.uint32), draw.integers(0, 3, blocks)
    yield {}
    yield {"subtract_green": True}
    yield {"references": True}
    yield {"cache_bits": 5}
    yield {"predictor": modes}
    yield {"cross_colour": colours}
    yield {"groups": groups, "references": True, "cache_bits": 3}
    yield {"predictor": modes, "cross_colour": colours, "subtract_green": True, "references": True, "cache_bits": 8}


def test_every_part_of_the_format_round_trips():
    for p in images():
        for o in [*options(p.shape), *([{"palette": True}, {"palette": True, "references": True}] if len(np.unique(p)) <= 256 else [])]:
            assert (webp.decode(webp.encode(p, **o)) == p).all(), o


def test_all_fourteen_predictors():
    p = np.random.default_rng(4).integers(0, 2**32, (12, 12), dtype=np.uint32)
    for mode in range(14):
        assert (webp.decode(webp.encode(p, predictor=np.full((3, 3), mode))) == p).all()
    # Worked by hand: average of 3 and 6 is 4; select prefers what the gradient is nearer to; the clamp stops at 255.
    assert webp.predict(7, 0x03030303, 0x06060606, 0, 0) == 0x04040404
    assert webp.predict(11, 0x10101010, 0x20202020, 0, 0x1F1F1F1F) == 0x10101010
    assert webp.predict(12, 0xF0F0F0F0, 0xF0F0F0F0, 0, 0x10101010) == 0xFFFFFFFF
    assert webp.predict(13, 0x0A0A0A0A, 0x0A0A0A0A, 0, 0x0D0D0D0D) == 0x09090909


def test_plane_codes():
    codes = webp.plane_codes()
    assert len(set(codes)) == 120 and codes[:8] == ((0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2)) and codes[-1] == (8, 7)


@pytest.mark.parametrize("data", [b"", b"RIFF\x04\0\0\0WEBP", b"RIFF\x0e\0\0\0WEBPVP8L\x01\0\0\0\0\0", b"x" * 40])
def test_what_is_no_image_is_refused(data):
    with pytest.raises(ValueError):
        webp.decode(data)


# ---- streams written by hand from the format's description: (value, bits), lowest bit first; the encoder has no part in them


def file_of(width, height, *fields):
    value = size = 0
    for v, n in [(0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3), *fields]:
        value, size = value | v << size, size + n
    data = value.to_bytes(-(-size // 8), "little")
    chunk = b"VP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) % 2)
    return b"RIFF" + (len(chunk) + 4).to_bytes(4, "little") + b"WEBP" + chunk


def simple(*symbols):
    """A simple prefix code of one or two symbols of eight bits; of two, the smaller one is bit 0."""
    return [(1, 1), (len(symbols) - 1, 1), (1, 1), *[(s, 8) for s in symbols]]


NO_DISTANCE = [(1, 1), (0, 1), (0, 1), (0, 1)]
NONE, PLAIN = [(0, 1)], [(0, 1), (0, 1)]  # no (further) transform; neither cache nor meta codes
#: A normal code whose lengths are written with two codes: 0 says length 1, and 1 says a run of 11 zeros and seven bits more.
LENGTHS = [(0, 1), (0, 4), (0, 3), (1, 3), (0, 3), (1, 3)]


def zeros(n):
    return [(1, 1), (n - 11, 7)]


def pixels_of(data):
    return [f"{x:08x}" for x in webp.decode(data).ravel().tolist()]


def test_literals_by_hand():
    codes = [*simple(10, 20), *simple(200), *simple(5), *simple(255), *NO_DISTANCE]
    assert pixels_of(file_of(3, 1, *NONE, *PLAIN, *codes, (0, 1), (1, 1), (0, 1))) == ["ffc80a05", "ffc81405", "ffc80a05"]


def test_back_references_by_hand():
    # Green 20 is bit 0 and length symbol 258, three pixels, is bit 1; the only distance is code 2, the pixel on the left.
    green = [*LENGTHS, (0, 1), *zeros(20), (0, 1), *zeros(138), *zeros(99), (0, 1), *zeros(21)]
    left = [(1, 1), (0, 1), (0, 1), (1, 1)]
    assert pixels_of(file_of(4, 1, *NONE, *PLAIN, *green, *simple(200), *simple(5), *simple(255), *left, (0, 1), (1, 1))) == ["ffc81405"] * 4
    # Red 1 or 2 takes the way pixel by pixel: a pixel, another, and three from the left of the last.
    got = pixels_of(file_of(5, 1, *NONE, *PLAIN, *green, *simple(1, 2), *simple(5), *simple(255), *left, (0, 1), (0, 1), (0, 1), (1, 1), (1, 1)))
    assert got == ["ff011405", "ff021405", "ff021405", "ff021405", "ff021405"]


def test_colour_cache_by_hand():
    # A cache of two colours; (0x1e35a7bd * 0xffc81405) mod 2^32 = 0x16cf0ab1, whose top bit tells the slot.
    assert 0x1E35A7BD * 0xFFC81405 % 2**32 >> 31 == 0
    green = [*LENGTHS, (1, 1), (0, 3), (3, 2), *zeros(20), (0, 1), *zeros(138), *zeros(121), (0, 1)]
    got = pixels_of(file_of(3, 1, *NONE, (1, 1), (1, 4), (0, 1), *green, *simple(200), *simple(5), *simple(255), *NO_DISTANCE, (0, 1), (1, 1), (1, 1)))
    assert got == ["ffc81405"] * 3


def test_subtract_green_by_hand():
    codes = [*simple(20), *simple(10), *simple(250), *simple(255), *NO_DISTANCE]
    assert pixels_of(file_of(1, 1, (1, 1), (2, 2), *NONE, *PLAIN, *codes)) == ["ff1e140e"]


def test_predictors_by_hand():
    # Four pixels of residue 01010101: black, left and top are fixed; the last has L = T = TR = 01020202 and TL = 00010101.
    last = dict.fromkeys(range(14), "02030303") | {0: "00010101", 4: "01020202", 6: "01020202", 8: "01020202", 10: "01020202", 12: "03040404"}
    for mode, want in last.items():
        modes = [(0, 1), *simple(mode), *simple(0), *simple(0), *simple(0), *NO_DISTANCE]
        residue = [*simple(1), *simple(1), *simple(1), *simple(1), *NO_DISTANCE]
        assert pixels_of(file_of(2, 2, (1, 1), (0, 2), (0, 3), *modes, *NONE, *PLAIN, *residue)) == ["00010101", "01020202", "01020202", want], mode


def test_cross_colour_by_hand():
    # Green to red 16, green to blue 64, red to blue 32: red 100 + 16 * 64 / 32, blue 50 + 64 * 64 / 32 + 32 * -124 / 32.
    element = [(0, 1), *simple(64), *simple(32), *simple(16), *simple(255), *NO_DISTANCE]
    assert pixels_of(file_of(1, 1, (1, 1), (1, 2), (0, 3), *element, *NONE, *PLAIN, *simple(64), *simple(100), *simple(50), *simple(255), *NO_DISTANCE)) == ["ff844036"]


def test_palette_by_hand():
    # Two colours, the second as a difference; eight indices share a byte of green, the first in the lowest bit.
    table = [(0, 1), *simple(1, 11), *simple(1, 10), *simple(1, 12), *simple(0, 255), *NO_DISTANCE, *[(1, 1)] * 4, *[(0, 1)] * 4]
    image = [*simple(2, 141), *simple(0), *simple(0), *simple(0), *NO_DISTANCE, (1, 1), (0, 1)]
    got = pixels_of(file_of(10, 1, (1, 1), (3, 2), (1, 8), *table, *NONE, *PLAIN, *image))
    assert got == [("ff0a0b0c", "ff0b0c0d")[i] for i in (1, 0, 1, 1, 0, 0, 0, 1, 0, 1)]


def test_repeats_are_references_and_few_values_a_palette():
    draw = np.random.default_rng(5)
    for k in range(60):
        piece = draw.integers(0, int(draw.integers(2, 256)), int(draw.integers(1, 300))).astype(np.uint8).tobytes()
        payload = piece * int(draw.integers(1, 20)) + bytes(int(draw.integers(0, 6000))) + piece[::-1] + piece
        payload += b"\0" * (-len(payload) % 64)
        assert media.decode_payload(media.encode_payload(payload)).tobytes() == payload
    once = draw.integers(0, 256, 4096).astype(np.uint8).tobytes()
    assert webp.long_matches(np.frombuffer(once, np.uint8)) == []
    assert webp.long_matches(np.frombuffer(once + once, np.uint8)) == [(4096, 4096, 4096)]
    assert len(media.encode_payload(once + once)) < len(media.encode_payload(once)) + 64 and len(media.encode_payload(b"ab" * 32)) < 64


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=400))
def test_any_text_comes_back(text):
    payload = media.payload_of(text)
    assert len(payload) % 64 == 0 and media.decode_payload(media.encode_payload(payload)).tobytes() == payload


def test_skewed_counts_and_several_files():
    weights = np.array([int(1.7**i) + 1 for i in range(40)])
    lengths = webp.code_lengths(weights, 12)
    assert lengths.max() <= 12 and sum(2.0 ** -int(x) for x in lengths) == 1
    payload = media.payload_of("ab" * 1_100_000)
    assert media.decode_payload(media.encode_payload(payload)).tobytes() == payload


def test_query_against_plain_python(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op2_media"](spark, SF).collect():
        data = texts[r.doc_id].encode()
        padded = data + b"\0" * (-len(data) % 64 or (0 if data else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))


def test_hard_rows(hard, empty):
    rows = media.describe_texts(hard).collect()
    assert len(rows) == 15 and {r.payload_bytes for r in rows if r.n_bytes == 0} == {64} and len({(r.media_sha256, r.feature) for r in rows if r.payload_sha256 == hashlib.sha256(b"word" + b"\0" * 60).hexdigest()}) == 1
    assert media.describe_texts(empty).count() == 0
    stored = media.store_texts(hard).filter("doc_id = 6").first()
    assert bytes(stored.media[:4]) == b"RIFF"


def test_reading_a_media_column(spark):
    """Images of every part of the format, several in a value, come back from a binary column."""
    cases = [[(p, webp.encode(p, **o)) for o in options(p.shape)] for p in images()]
    rows = [(i, b"".join(f for _, f in case)) for i, case in enumerate(cases)] + [(None, None), (None, b"")]
    got = media.read_media(spark.createDataFrame(rows, "doc_id long, media binary")).collect()
    assert len(got) == len(rows) and all(not r.images for r in got if r.doc_id is None)
    for r in got:
        if r.doc_id is not None:
            assert [(x.width, x.height, bytes(x.pixels)) for x in r.images] == [(p.shape[1], p.shape[0], p.tobytes()) for p, _ in cases[r.doc_id]]
