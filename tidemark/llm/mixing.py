"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key, -ln(u) / weight, from a hash of its id and a quality weight from its text; in
key order a source's documents are a weighted sample without replacement of any size. Targets come from source
weights and sizes by water-filling. A source is passed whole as often as its target allows (complete epochs); the
rest of the target goes to documents in key order by prefix sums, and the document at the boundary gives the
remaining words, so a source's total is its target rounded down.

No task holds a source: keys are counted per (source, bucket of the key), cumulative sums run over bucket totals, and
only the documents of the bucket that holds a source's boundary are sorted. Buckets follow the exponential law in
fixed steps, so that their share of a source does not depend on its size.

Defined results: null texts have size 0 and take 0; null sources are one source, the last; ties of a key go by id,
and repeated ids with equal size share what their prefix sums give; an empty table gives an empty result; sizes of 0
everywhere give targets of 0; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

WORD = r"[^\x20\x09-\x0D]+"
#: Characters that lower a document's quality weight.
NOISE = "0123456789#$%&*!|<>{}[]\\^~@=_+"
WEIGHTS = (5, 2, 1)
CAP = 3
#: Products of words and weights of all sources may pass 64 bits.
WIDE = "decimal(28,0)"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of characters that are not noise, in tenths from 0.1 to 1."""
    clean = F.length(F.translate(text, NOISE, "")) * 10
    return F.coalesce(F.greatest(F.floor(clean / F.nullif(F.length(text), F.lit(0))), F.lit(1)), F.lit(1)).cast("double") / 10


def uniform(doc_id: Column, salt: str = "mix") -> Column:
    """A number in (0, 1) from the md5 of salt and id: 52 bits, never 0 or 1."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: bool = False) -> DataFrame:
    """(doc_id, source, size, key, bucket) of every row; smaller keys are chosen first. With carry, also the row itself
    (row, a struct) and a hash of its text (tie), which orders rows of one id."""
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text_col).alias("tie")] if carry else []
    rows = docs.select(*own, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), quality_weight(F.col(text_col)).alias("quality"))
    rows = rows.withColumn("key", -F.log(uniform(F.col("doc_id"))) / F.col("quality")).drop("quality")
    body, tail = F.floor((1 - F.exp(-F.col("key"))) * 65536), 65536 + F.floor((F.col("key") - 8) * 512)
    return rows.withColumn("bucket", F.when(F.col("key") < 8, body).otherwise(tail).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, share: float = 1.0) -> DataFrame:
    """Water-filling over (source, source_size): adds target, budget (whole words), epochs and rest.

    A source saturates once the level (target / weight) reaches cap * size / weight. In order of that ratio the
    saturated sources are a prefix; the others share what is left by weight. One row per source is sorted here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", cycle.cast("long")).withColumn("most", F.lit(cap) * F.col("source_size"))
    everything = Window.partitionBy()
    rows = rows.withColumn("total", F.floor(F.sum("source_size").over(everything) * F.lit(share)))
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0)))
    rows = rows.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("full", F.col("left").cast(WIDE) * F.col("weight") >= F.col("most").cast(WIDE) * F.col("open"))
    # The level is set by the first source in this order that is not saturated.
    first = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("left"), F.col("open")))).over(everything)
    level = F.col("weight") * first["left"] / first["open"]
    rows = rows.withColumn("target", F.when(F.col("full"), F.col("most").cast("double")).otherwise(level))
    rows = rows.withColumn("budget", F.floor("target").cast("long"))
    n = F.nullif(F.col("source_size"), F.lit(0))
    return rows.select(
        "source", "source_size", "target", "budget",
        F.coalesce(F.floor(F.col("budget") / n), F.lit(0)).cast("long").alias("epochs"),
        F.coalesce(F.col("budget") % n, F.lit(0)).alias("rest"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, share: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: bool = False) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words, repeats counted), epochs, part (words of the last pass).

    With `carry`, each row comes with itself (row, a struct of its columns): its words and key are then computed a second
    time where it is read, so that no text is shuffled but those of the buckets that hold a source's boundary.
    """
    rows = written(keyed(docs, id_col, text_col, source_col), "keys")
    histogram = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    plan = written(targets(histogram.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap, share), "plan")
    # The bucket in which a source's running total passes its rest, and the total before that bucket.
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = histogram.withColumn("prior", F.coalesce(F.sum("words").over(running), F.lit(0)))
    edge = sums.alias("s").join(plan.alias("p"), F.expr("s.source <=> p.source AND s.prior <= p.rest AND p.rest < s.prior + s.words"))
    edge = edge.groupBy(F.col("s.source").alias("source")).agg(F.min(F.struct("bucket", "prior")).alias("edge"))
    edges = written(plan.join(edge, plan["source"].eqNullSafe(edge["source"]), "left").select(plan["*"], "edge.bucket", "edge.prior"), "edges")
    discard(plan)
    if carry:
        discard(rows)
        rows = keyed(docs, id_col, text_col, source_col, True)
    own = ["row", "tie"] if carry else []
    planned = rows.alias("r").join(edges.alias("p"), F.expr("r.source <=> p.source")).select(
        *[f"r.{c}" for c in own], "r.doc_id", "r.size", "r.key", "r.source", "p.source_size", "p.target", "p.epochs", "p.rest", "p.prior", F.col("r.bucket").alias("own"), F.col("p.bucket").alias("edge")
    )
    out = [*own[:1], "doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs") + F.col("part")).alias("taken"), "epochs", "part"]
    clear = planned.filter("NOT (own <=> edge)").withColumn("part", F.when(F.col("own") < F.coalesce("edge", F.lit(-1)), F.col("size")).otherwise(F.lit(0)))
    close = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), *own[1:]).rowsBetween(Window.unboundedPreceding, -1)
    edge_rows = planned.filter("own <=> edge").withColumn("before", F.col("prior") + F.coalesce(F.sum("size").over(close), F.lit(0)))
    edge_rows = edge_rows.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))))
    return clear.select(*out).unionByName(edge_rows.select(*out))
