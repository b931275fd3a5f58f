"""What the corpus operators share: reading tables, cutting lineage, Arrow-batch plumbing."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that Python code handles at once; bounds a worker's memory whatever the batch's row count.
SLICE_BYTES = 1_000_000
#: Rows and bytes of one Arrow batch between the JVM and Python; Spark's own defaults would hold 64 MB twice over.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table through Spark, so that any store Spark reaches will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Unset, a temporary one stands in where the master is local
    (one machine); anywhere else that is an error, as executors would write to disks of their own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^,]*(,[^,]*)?\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder once and read it back.

    Unlike checkpoint(), the last stage is computed once, and a lost executor costs no recomputation. A table that no
    later result reads can be given to `discard`; what a lazy result reads stays, and goes with the shared folder.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that `written` made and nothing reads any more; others are left alone."""
    for t in tables:
        path = getattr(t, "_tidemark_path", None)
        if path:
            jvm = t.sparkSession.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def shipped(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver has it, and bound Arrow batches.

    A cluster gets the package by --py-files or an image; this serves sessions started elsewhere on one machine.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key, None) or "0"
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def released() -> None:
    """Give a worker's free memory back, so that a long-lived Python worker does not keep the peak of its last task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library that has no such call keeps its memory
        return


def slices(batch: pa.RecordBatch, column: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts exceed `limit` bytes together; a single longer text stays whole."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def map_texts(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """Apply `function` to bounded Arrow batches of df, whose second column is text."""
    shipped(df.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=limit):
                yield function(part)
        released()

    return df.mapInArrow(run, schema)
