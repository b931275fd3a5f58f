"""Media columns: texts as lossless greyscale WebP images and back, with features of the pixels.

A text's UTF-8 bytes, padded with zeros to a positive multiple of 64, become the rows of a 64 pixels wide grey image.
The format's sides end at 16,384 pixels, so a longer payload continues in further files, one after the other in the
same column; none is cut. Features come from the decoded pixels, never from the text.

Defined results: null counts as empty, and the empty payload is one row of 64 zeros; repeated rows each get their
row, and equal texts equal values; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import webp
from .common import map_texts

WIDTH = 64
IMAGE_BYTES = WIDTH * webp.MAX_SIDE
#: Compressed bytes of media that are decoded at once.
READ_BYTES = 64_000
#: The most values whose palette indices share a pixel.
PACKED = 16


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + b"\0" * (max(1, -(-len(data) // WIDTH)) * WIDTH - len(data))


def encode_payload(payload: bytes) -> bytes:
    """The payload as grey pixels, in the form that takes the fewest bytes for its kind.

    Of up to 16 values a palette packs two to eight pixels into one. Otherwise grey minus green leaves red and blue
    constant, so that only green is coded, and stretches that repeat earlier ones are back-references. Predictors,
    cross-colour and the colour cache do not make text smaller; the reader knows them all.
    """
    files = []
    for at in range(0, len(payload), IMAGE_BYTES):
        data = np.frombuffer(payload[at : at + IMAGE_BYTES], np.uint8)
        pixels = webp.BLACK | data.astype(np.uint32).reshape(-1, WIDTH) * np.uint32(0x010101)
        few = np.count_nonzero(np.bincount(data, minlength=256)) <= PACKED
        files.append(webp.encode(pixels, palette=True, repeats=True) if few else webp.encode(pixels, subtract_green=True, repeats=True))
    return b"".join(files)


def decode_payload(media: bytes) -> np.ndarray:
    """Grey samples (rows x 64) of all files in a media value."""
    rows, at = [], 0
    while at < len(media):
        pixels, at = webp.decode_at(media, at)
        rows.append((pixels & np.uint32(255)).astype(np.uint8))
    return np.concatenate(rows)


def feature_of(samples: np.ndarray) -> str:
    """Mean, mean absolute step along the rows, and a bit per column that is lighter than the whole, all from integers."""
    total, n = int(samples.sum(dtype=np.int64)), samples.size
    steps = int(np.abs(np.diff(samples.astype(np.int16), axis=1)).sum(dtype=np.int64))
    lighter = samples.sum(0, dtype=np.int64) * WIDTH > total
    return f"{total * 1000 // n}:{steps * 1000 // n}:{np.packbits(lighter).tobytes().hex()}"


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, media (binary), the media column itself."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        media = [encode_payload(payload_of(t)) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary())], ["doc_id", "media"])

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, media binary")


def read_media(docs: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Per row: doc_id, images, an array of (width, height, pixels) of the lossless WebP files in the media column, in order.

    Pixels are four bytes each, blue, green, red and alpha, row by row. Null and empty media have no images; what is no
    lossless WebP file is an error. A batch holds few compressed bytes, since they may decode to many.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    images_type = pa.list_(pa.struct([("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.binary())]))

    def images(media: bytes | None) -> list[dict]:
        found, at = [], 0
        while at < len(media or b""):
            pixels, at = webp.decode_at(media, at)
            found.append({"width": pixels.shape[1], "height": pixels.shape[0], "pixels": pixels.astype("<u4").tobytes()})
        return found

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([images(m) for m in batch.column(1).to_pylist()], images_type)], ["doc_id", "images"])

    return map_texts(docs.select(id_col, media_col), run, f"doc_id {id_type}, images array<struct<width:int,height:int,pixels:binary>>", limit=READ_BYTES)


def describe_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    Storing and reading back happen in one pass; the payload columns come from the decoded bytes.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            payload = payload_of(text)
            media = encode_payload(payload)
            samples = decode_payload(media)
            back = samples.tobytes()
            if back != payload:
                raise ValueError("a stored payload did not come back")
            rows.append((len((text or "").encode()), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(samples)))
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return map_texts(
        docs.select(id_col, text_col), run,
        f"doc_id {id_type}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string",
    )
