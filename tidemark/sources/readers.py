"""Sources: all-text CSV and JSON arrays with row provenance, Parquet, and unions of files whose columns differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def payload(columns: list[str]) -> Column:
    """The raw row as JSON, with its nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with every value as text; blanks, and what short rows or the header lack, are empty texts.

    Columns go by the header's names. Adds _src_row (first data row: 2) and _raw (all columns of the file). Quoted
    values may hold line feeds and doubled quotes (RFC 4180), so a file is read by one task, in its order; a folder of
    many files is read by many.
    """
    options = {"header": True, "mode": "PERMISSIVE", "multiLine": True, "quote": '"', "escape": '"'}
    rows = spark.read.options(**options).csv(path).fillna("")
    rows = rows.withColumns({"_raw": payload(rows.columns)} | {c: F.lit("") for c in columns if c not in rows.columns})
    return with_positions(rows.select(*columns, "_raw"), 2)


def with_positions(rows: DataFrame, first: int) -> DataFrame:
    """Add _src_row, the position in reading order, from `first` on.

    Rows count up within a partition; with several, each partition's offset is the count of those before it, from one
    pass over the same scan that gives one row per partition.
    """
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    if rows.rdd.getNumPartitions() <= 1:
        return rows.withColumn("_src_row", F.col("_at") + first).drop("_at")
    part, own = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return rows.join(offsets, part == F.col("_part")).withColumn("_src_row", F.col("_offset") + own + first).drop("_at", "_part", "_offset")


def json_array(spark: SparkSession, path: str, columns: list[str], kinds: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """A file with one JSON array of objects: (rows as text with _src_row from 1 and _raw, one row telling repaired).

    Where the text does not parse, a comma that is missing between two objects on following lines is put in and the
    text parsed again; a text that still does not parse gives no rows and repaired is false. Absent keys are nulls.
    For the columns in `kinds`, <column>_kind tells what the value was: number, boolean, string, null or other.
    """
    kind = "array<map<string,variant>>"
    whole = spark.read.text(path, wholetext=True)
    mended = F.regexp_replace("value", r"\}\s*\n(\s*)\{", "},\n$1{")
    read = lambda c: F.from_json(c, kind, {"mode": "PERMISSIVE"})
    both = whole.select(read(F.col("value")).alias("straight"), read(mended).alias("mended"))
    both = both.withColumn("repaired", F.col("straight").isNull() & F.col("mended").isNotNull())
    rows = both.select(F.posexplode(F.coalesce("straight", "mended")).alias("at", "o"))
    value = lambda c: F.try_element_at("o", F.lit(c))
    told = lambda c: F.schema_of_variant(value(c))
    kind_of = lambda c: F.when(told(c) == "BOOLEAN", "boolean").when(told(c) == "STRING", "string").when(told(c) == "VOID", "null").when(told(c).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), "number").when(told(c).isNotNull(), "other")
    rows = rows.select(
        *[F.try_variant_get(value(c), "$", "string").alias(c) for c in columns], *[kind_of(c).alias(f"{c}_kind") for c in kinds],
        (F.col("at") + 1).cast("long").alias("_src_row"), F.to_json("o", {"ignoreNullFields": "false"}).alias("_raw"),
    )
    return rows, both.select("repaired")


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parquet_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """All files' rows, with the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(*paths)
