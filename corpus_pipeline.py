"""A corpus pipeline of five stages, each a table in and a table out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written and read again before
the next one starts, so that a lost executor costs a part of one stage. All stages but the last return the columns
of `documents`; further columns of the input are carried along.

1. language: documents that have no letter in their text cannot be told a language and go; where no
   row has a known language, nothing is learned and all stay.
2. exact dedup: of equal texts (A-Z as a-z) the row with the largest id stays.
3. near dedup: of documents linked by five-word shingles at 0.8 or more, the smallest id of each group stays.
4. mixing: sources come to their target weights; documents repeat for complete epochs, and the document at a source's
   boundary comes whole, so that a source passes its target by less than one document. Documents that take no words go.
5. pieces: each row is encoded and decoded; its ids come with the text they decode to.

Rows with a null id pass language and near dedup by their own text, and of equal texts they stay only if no row with
an id has that text. Rows that repeat both id and text count once after exact dedup. Empty tables pass every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.common import crc_mod, lower_ascii, written
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.pieces import encode_decode
from tidemark.llm.queries import tokenizer_file


#: Bytes of keys that may be broadcast (each counts its text and 32 more); beyond that the same join is a shuffle.
BROADCAST_BYTES = 64 << 20


def _without(docs: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of docs whose keys are not among dropped (nulls are equal); broadcast only where their counted bytes are few."""
    dropped = written(dropped.select(*[F.col(k).alias(f"_dropped_{k}") for k in keys]).distinct(), "dropped")
    texts = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 32 for c in dropped.columns), F.lit(0))
    size = dropped.agg(F.sum(texts.cast("long"))).first()[0] or 0
    few = F.broadcast(dropped) if size <= BROADCAST_BYTES else dropped
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_dropped_{k}"))
    return docs.join(few, same, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = language_id.learn_profiles(docs, F.lit(True))
    return language_id.filter_known(docs, profiles)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(exact_dedup(docs, crc_mod(F.col("doc_id"), 2) == 0).select("doc_id", F.col("text_sha256").alias("_sha"), "kept"), "exact")
    digest = F.sha2(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), 256)
    rows = _without(docs.withColumn("_sha", digest), found.filter("NOT kept"), ["doc_id", "_sha"])
    repeated = found.filter("kept").groupBy("doc_id", "_sha").count().filter("count > 1")
    if not repeated.isEmpty():  # rows that repeat both id and text
        rows = rows.dropDuplicates(["doc_id", "_sha"])
    return rows.select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_duplicates(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return _without(docs, found.filter("NOT kept"), ["doc_id"])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Each row takes its own place in the plan along, whatever its id.
    copies = F.col("epochs") + (F.col("part") > 0).cast("long")
    rows = mix(docs, carry=True).filter("taken > 0").select("row", F.explode(F.sequence(F.lit(1), copies)))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers still hold memory of the stages before, so they remember fewer stretches here.
    return encode_decode(docs, tokenizer_file("piece_bpe_32k.model"), stretches=250_000, batch_bytes=1_000_000)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("pieces", pieces)]

#: Language prototypes, MinHash bands and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
