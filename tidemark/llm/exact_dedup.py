"""Exact deduplication against an immutable snapshot, screened by static binary-fuse filters.

A snapshot's digests are dealt by their leading bits into buckets of bounded size, and each bucket gets a static
3-wise binary-fuse filter of 16-bit fingerprints, built once. Incoming digests are first grouped among themselves;
each group then meets the filter of its bucket. What the filter clears is new for certain; what it passes joins the
exact bucket, and texts are compared byte for byte before rows count as copies.

Defined results: null texts count as empty, and empty texts are copies of each other; of equal texts the largest id
stays (null ids come last, so a null id stays only in a group without others); repeated rows are rows of their group;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, shipped, written
from .hashing import mix64

#: Digests a bucket holds on average; a filter of so many takes about 2.3 bytes each.
BUCKET_KEYS = 100_000
#: Most 64-bit keys of repeated digests that are broadcast (32 MB); more of them are joined by a shuffle.
BROADCAST_KEYS = 4_000_000

class BinaryFuse:
    """A static 3-wise binary-fuse filter over distinct 64-bit keys, with 16-bit fingerprints."""

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def shape(n: int) -> tuple[int, int]:
        """Segment length (a power of two) and the number of segments a key's first cell can be in."""
        segment = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        return segment, max(1, int(np.ceil(max(n, 4) * factor / segment)) - 2)

    @staticmethod
    def _places(h: np.ndarray, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        mask, at = np.uint64(segment - 1), [h & np.uint64(0x3FFFF), (h >> np.uint64(18)) & np.uint64(0x3FFFF), mix64(h, 1) & np.uint64(0x3FFFF)]
        rows = [(first + np.uint64(i)) * np.uint64(segment) + (x & mask) for i, x in enumerate(at)]
        return np.stack(rows).astype(np.int64), ((h ^ (h >> np.uint64(29))) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(np.uint64))
        segment, segments = cls.shape(len(keys))
        for seed in range(1, 200):
            if seed % 20 == 0:  # a stubborn small set gets room
                segments += max(1, segments // 4)
            size = (segments + 2) * segment
            places, prints = cls._places(mix64(keys, seed), segment, segments)
            order = cls._peel(places, size, len(keys))
            if order is None:
                continue
            cells = np.zeros(size, np.uint16)
            for own, at in reversed(order):  # each round's cells are distinct and read by later rounds only
                others = places[:, own]
                cells[at] = prints[own] ^ cells[others[0]] ^ cells[others[1]] ^ cells[others[2]]
            return cls(seed, segment, segments, cells)
        raise RuntimeError("no seed gave a peelable filter")

    @staticmethod
    def _peel(places: np.ndarray, size: int, n: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, the cell that each alone occupies), or None if a core is left."""
        count, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
        ids = np.arange(n)
        for row in places:
            np.add.at(count, row, 1)
            np.add.at(total, row, ids)
        rounds, done = [], 0
        while done < n:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                return None
            own, first = np.unique(total[alone], return_index=True)
            rounds.append((own, alone[first]))
            for row in places:
                np.subtract.at(count, row[own], 1)
                np.subtract.at(total, row[own], own)
            done += len(own)
        return rounds

    def contains(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(mix64(keys.astype(np.uint64), self.seed), self.segment, self.segments)
        return (self.cells[places[0]] ^ self.cells[places[1]] ^ self.cells[places[2]]) == prints

    def dump(self) -> bytes:
        return np.array([self.seed, self.segment, self.segments], np.int64).tobytes() + self.cells.tobytes()

    @classmethod
    def load(cls, blob: bytes) -> BinaryFuse:
        seed, segment, segments = np.frombuffer(blob, np.int64, 3)
        return cls(int(seed), int(segment), int(segments), np.frombuffer(blob, np.uint16, offset=24))


def digest64(sha256: Column) -> Column:
    """The first 15 hex digits of a digest as a non-negative bigint."""
    return F.conv(F.substring(sha256, 1, 15), 16, 10).cast("bigint")


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("key64", digest64(F.col("text_sha256"))).withColumn("bucket", F.pmod("key64", F.lit(buckets)).cast("int"))


def build_filters(snapshot_groups: DataFrame) -> DataFrame:
    """(bucket, filter) of a snapshot's distinct digests; write it beside the snapshot, it never changes."""
    shipped(snapshot_groups.sparkSession)

    def build(key: tuple, group: pa.Table) -> pa.Table:
        blob = BinaryFuse.build(group.column("key64").to_numpy()).dump()
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([blob], pa.binary())})

    return snapshot_groups.select("bucket", "key64").groupBy("bucket").applyInArrow(build, "bucket int, filter binary")


def screen(groups: DataFrame, filters: DataFrame) -> DataFrame:
    """Mark the incoming groups that the filter of their bucket passes (maybe); a bucket without filter clears all."""
    shipped(groups.sparkSession)

    def test(left: pa.Table, right: pa.Table) -> pa.Table:
        maybe = np.zeros(left.num_rows, bool)
        if right.num_rows and left.num_rows:
            maybe = BinaryFuse.load(right.column("filter")[0].as_py()).contains(left.column("key64").to_numpy())
        return left.select(["text_sha256"]).append_column("maybe", pa.array(maybe))

    narrow = groups.select("bucket", "key64", "text_sha256")
    return narrow.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(test, "text_sha256 string, maybe boolean")


def _grouped(rows: DataFrame, buckets: int) -> DataFrame:
    return _bucketed(rows.groupBy("text_sha256").agg(F.max("doc_id").alias("top"), F.count("*").alias("n")), buckets)


def exact_dedup(docs: DataFrame, in_snapshot: Column, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS, expected_rows: int | None = None, tell_screened: bool = False) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 and, with tell_screened, screened.

    `in_snapshot` tells the snapshot's rows from the incoming batch; screened is true for incoming rows that the
    filters cleared without reading the snapshot. All rows meet what is known of their digests in one join, which Spark
    can split where one text is very common. The byte check groups rows of a digest by their whole text with
    partial aggregation in each map task, so a group of any size arrives as one row per task.
    """
    total = docs.count() if expected_rows is None else expected_rows
    buckets = max(1, -(-total // bucket_keys))
    rows = docs.select(F.col(id_col).alias("doc_id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"), F.coalesce(in_snapshot, F.lit(False)).alias("old"))
    rows = rows.withColumn("text_sha256", F.sha2("norm", 256))
    narrow = written(rows.select("doc_id", "text_sha256", "old"), "digests")
    snapshot, incoming = _grouped(narrow.filter("old"), buckets), _grouped(narrow.filter("NOT old"), buckets)
    screened = screen(incoming, build_filters(snapshot))
    if tell_screened:  # else it is read once, where repeated digests are gathered
        screened = written(screened, "screened")
    positives = screened.filter("maybe").select("text_sha256")
    repeated = snapshot.filter("n > 1").select("key64").union(incoming.filter("n > 1").select("key64")).union(snapshot.join(positives, "text_sha256", "left_semi").select("key64"))
    repeated = written(repeated.distinct(), "repeated")
    # The byte check: rows whose digest occurs more than once, by digest and text. Only such texts are moved; where
    # the keys are few enough to broadcast, no others are even sorted. Rows that merely share 64 bits of a digest
    # with them form groups of their own.
    few = F.broadcast(repeated) if repeated.count() <= BROADCAST_KEYS else repeated
    rows = rows.withColumn("key64", digest64(F.col("text_sha256"))).join(few, "key64", "left_semi").drop("key64")
    texts = rows.groupBy("text_sha256", "norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    texts = written(texts.withColumn("norm", F.when(F.count("*").over(Window.partitionBy("text_sha256")) > 1, F.col("norm"))), "texts")
    checked = texts.groupBy("text_sha256").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("n_texts"))
    clash = checked.filter("n_texts > 1").select("text_sha256")
    told = checked.filter("n_texts = 1").drop("n_texts")
    if tell_screened:
        cleared = screened.filter("NOT maybe").select("text_sha256", F.lit(None).cast(told.schema["keep_id"].dataType).alias("keep_id"), F.lit(None).cast("long").alias("group_size"), F.lit(True).alias("cleared"))
        told = told.withColumn("cleared", F.lit(False)).unionByName(cleared).groupBy("text_sha256").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.max("cleared").alias("cleared"))
    else:
        told = told.withColumn("cleared", F.lit(False))
    told = written(told, "told")
    result = narrow.join(told, "text_sha256", "left").select("text_sha256", "doc_id", "old", "keep_id", "group_size", "cleared")
    if not clash.isEmpty():  # different texts of one digest are told apart by their bytes
        apart = rows.join(clash, "text_sha256", "left_semi").join(texts, ["text_sha256", "norm"]).select("text_sha256", "doc_id", "old", "keep_id", "group_size", F.lit(False).alias("cleared"))
        result = result.join(clash, "text_sha256", "left_anti").union(apart)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    told_too = [(~F.col("old") & F.coalesce("cleared", F.lit(False))).alias("screened")] if tell_screened else []
    return result.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", *told_too,
    )
