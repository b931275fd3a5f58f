"""Sinks: Parquet by batch, one CSV per result, views, and a self-contained HTML page."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """One file with a header, for results that a person reads, which are small; else a file for each partition."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def create_views(frames: dict[str, DataFrame]) -> None:
    """Temporary views by name. A view keeps its frame's plan, so it shows what the tables held when the frame was made."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Drop and create a table over Parquet files, its schema taken from them."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.catalog.createTable(name, path=path, source="parquet")


def _table(df: DataFrame, most: int) -> str:
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    rows = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in df.limit(most).collect())
    return f"<table><tr>{head}</tr>{rows}</table>"


def _bars(df: DataFrame, label: str, value: str, most: int) -> str:
    rows = df.select(F.col(label).cast("string"), F.col(value).cast("double")).limit(most).collect()
    top = max((abs(v or 0) for _, v in rows), default=0) or 1
    parts = [f'<text x="0" y="{18 * i + 12}">{html.escape(k or "")}</text><rect x="160" y="{18 * i}" height="14" width="{300 * abs(v or 0) / top:.1f}"/>' for i, (k, v) in enumerate(rows)]
    return f'<svg width="480" height="{18 * len(rows) + 4}" font-size="12" fill="#357">{"".join(parts)}</svg>'


def _lines(df: DataFrame, series: str, x: str, y: str, most: int) -> str:
    """The `most` series of largest total, each whole; the page says how many others there are."""
    totals = df.groupBy(series).agg(F.sum(F.abs(F.col(y).cast("double"))).alias("_total"))
    first = totals.orderBy(F.desc_nulls_last("_total"), series).limit(most)
    rows = df.join(F.broadcast(first.select(F.col(series).alias("_series"))), F.col(series) == F.col("_series")).groupBy(F.col(series).cast("string").alias("s"), F.col(x).cast("string").alias("x")).agg(F.sum(F.col(y).cast("double")).alias("y"))
    found = rows.orderBy("s", "x").collect()  # one row per period of `most` series
    xs = sorted({r[1] for r in found if r[1] is not None})
    place, top = {k: 460 * i / max(1, len(xs) - 1) for i, k in enumerate(xs)}, max((r[2] or 0 for r in found), default=0) or 1
    names = sorted({r[0] for r in found})
    shapes = []
    for i, name in enumerate(names):
        points = " ".join(f"{place[r[1]]:.1f},{200 - 190 * (r[2] or 0) / top:.1f}" for r in found if r[0] == name and r[1] in place)
        shapes.append(f'<polyline fill="none" stroke="hsl({i * 360 // max(1, len(names))},60%,40%)" points="{points}"><title>{html.escape(name)}</title></polyline>')
    rest = totals.count() - len(names)
    return f'<svg width="480" height="210">{"".join(shapes)}</svg>' + (f"<p>{rest} smaller series are not shown</p>" if rest > 0 else "")


def dashboard(title: str, tiles: dict[str, object], tables: dict[str, DataFrame], bars: dict[str, tuple[DataFrame, str, str]] | None = None, lines: dict[str, tuple[DataFrame, str, str, str]] | None = None, most: int = 50) -> str:
    """One HTML page: figures, tables (up to `most` rows of each report), bar charts and line charts."""
    parts = [f"<div class=tile><b>{html.escape(str(v))}</b><br>{html.escape(k)}</div>" for k, v in tiles.items()]
    parts += [f"<h2>{html.escape(k)}</h2>{_bars(*v, most)}" for k, v in (bars or {}).items()]
    parts += [f"<h2>{html.escape(k)}</h2>{_lines(*v, 12)}" for k, v in (lines or {}).items()]
    parts += [f"<h2>{html.escape(k)}</h2>{_table(v, most)}" for k, v in tables.items()]
    style = "body{font-family:sans-serif}.tile{display:inline-block;margin:8px;padding:12px;border:1px solid #ccc}td,th{padding:2px 8px;text-align:left}"
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><style>{style}</style><h1>{html.escape(title)}</h1>{''.join(parts)}"
