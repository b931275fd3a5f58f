"""License scan by canonical digest, with DataFrame functions only.

A text is normalised line by line (case, copyright lines, equivalent spellings, punctuation and spacing), its lines
are joined, and the digest is hash-joined to the digests of known licence texts that went through the same
expression. A whole text that this does not match is looked up in its flowing form, in which only copyright notices
and a title are dropped and lines are joined before spellings are replaced, so that it does not depend on where lines
are broken; `canonical_sha256` is the digest of the first form. Every line is looked up as a text of its own too, since
documents often carry a one-line grant. Whole text and lines come out of one pass, and only one row per document is
shuffled.

The catalogue holds `KNOWN` and the whole texts of `license_files`; a text of another licence, or edited, matches nothing.

Defined results: null or empty texts have the digest of the empty string and match nothing; repeated rows, and rows
that share an id (null is an id too), each get their own result row with the notices of their own text; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import KNOWN, whole_texts

#: Spellings that licence comparison treats as equal, as (pattern on lower-cased text, replacement).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("authoris", "authoriz"),
    ("catalogue", "catalog"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("merchantibility", "merchantability"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("recognis", "recogniz"),
    ("sub license", "sublicense"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    ("copyright owner", "copyright holder"),
    ("http ", "https "),
)

COPYRIGHT_LINE = "^[ \t/*#;%.-]*(copyright|\\(c\\)|©|all rights reserved)"
#: On lower-cased text: a copyright notice (a sign, a year or a blank to fill in), and the sentence that often follows alone.
NOTICE_LINE = r"(?md)^[ \t/*#;%.-]*(?:copyright[ \t:,]*(?:\(c\)|©|(?:19|20)[0-9y]{2}|[<\[{]).*|(?:\(c\)|©)[ \t]*(?:copyright|(?:19|20)[0-9]{2}).*|all rights reserved[ \t\r.*/#]*)$"
#: The usual titles of texts that stand without one in the catalogue, on a line of their own at the head.
TITLE = (
    r"^[^\p{L}\p{N}]*(?:the )?(?:mit|isc|expat|x11|zlib(?:/libpng)?|unlicense|"
    r"(?:(?:new|modified|revised|simplified|zero[- ]clause|[0-4][- ]clause) )?bsd(?:[- ](?:[0-4]|zero)[- ]clause)?(?: [\"“]?(?:new|revised|simplified|modified)[\"”]?(?: or [\"“]?(?:new|revised|simplified)[\"”]?)?)?)"
    r"(?: licen[sc]e)?(?: ?\([^)\n]{1,40}\))?[^\p{L}\p{N}\n]*(?=\n)"
)
#: ASCII characters other than letters, digits and line feeds, and typographic ones.
PUNCTUATION = "[\\x00-\\x09\\x0b-\\x2f\\x3a-\\x60\\x7b-\\x7f\u00a0©‘’“”–—…·•]+"


def canonical_line(line: Column) -> Column:
    """The canonical form of a lower-cased line without its line feed."""
    x = F.regexp_replace(line, PUNCTUATION, " ")
    for old, new in SPELLINGS:
        x = F.replace(x, F.lit(old), F.lit(new))
    return F.trim(x)


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, without copyright lines and empty ones; null counts as empty."""
    lines = F.split(F.lower(F.coalesce(text, F.lit(""))), "\n")
    lines = F.filter(lines, lambda x: ~x.rlike(COPYRIGHT_LINE))
    return F.filter(F.transform(lines, canonical_line), lambda x: x != "")


def digest(text: Column) -> Column:
    """The digest of a text's canonical form."""
    return F.sha2(F.array_join(canonical_lines(text), " "), 256)


def flowing(text: Column) -> Column:
    """The text without notices and title, as one canonical line; null counts as empty."""
    x = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOTICE_LINE, "")
    return canonical_line(F.translate(F.regexp_replace(x, TITLE, ""), "\n", " "))


def known_digests(spark: SparkSession, known: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """(license_digest, license_id), one row per digest of either form; of equal texts the smallest id counts, that of the first form before, and empty ones none.

    A catalogue that is not a DataFrame has a fixed number of texts: their digests are computed here and come as literals.
    """
    built_in = not isinstance(known, DataFrame)
    if built_in:
        pairs = F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("text")) for k, v in sorted((known or KNOWN | whole_texts()).items())])
        known = spark.range(1).select(F.inline(pairs))
    text = F.col("text")
    forms = F.array(
        F.struct(F.lit(0).alias("form"), digest(text).alias("license_digest"), (F.size(canonical_lines(text)) > 0).alias("any")),
        F.struct(F.lit(1).alias("form"), F.sha2(flowing(text), 256).alias("license_digest"), (flowing(text) != "").alias("any")),
    )
    rows = known.select("license_id", F.inline(forms)).filter("any")
    rows = rows.groupBy("license_digest").agg(F.min(F.struct("form", "license_id"))["license_id"].alias("license_id"))
    if built_in:
        pairs = F.array(*[F.struct(F.lit(r.license_digest).alias("license_digest"), F.lit(r.license_id).alias("license_id")) for r in rows.sort("license_digest").collect()])
        rows = spark.range(1).select(F.inline(pairs))
    return rows


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, canonical_sha256, license_id (of the whole text, or null), notice_lines, notice_ids (sorted, comma-joined).

    The built-in catalogue has a fixed number of rows, so its digests are broadcast; a catalogue given as a DataFrame
    has no such bound, and Spark picks the join from its size.
    """
    digests = known_digests(docs.sparkSession, known)
    small = digests if isinstance(known, DataFrame) else F.broadcast(digests)
    lines = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("lines"), flowing(F.col(text_col)).alias("flow"))
    # Rows that share all their lines are one group, counted; each line is counted once for every row of the group.
    lines = lines.select("doc_id", F.xxhash64("lines", "flow").alias("tie"), F.sha2(F.array_join("lines", " "), 256).alias("canonical_sha256"), F.posexplode(F.concat(F.array(F.array_join("lines", " "), "flow"), "lines")).alias("at", "line"))
    found = lines.withColumn("d", F.when(F.col("at") == 0, F.col("canonical_sha256")).otherwise(F.sha2("line", 256))).drop("line")
    found = found.join(small, F.col("d") == F.col("license_digest"), "left")
    notice = (F.col("at") > 1) & F.col("license_id").isNotNull()
    per_doc = found.groupBy("doc_id", "canonical_sha256", "tie").agg(
        F.coalesce(F.max(F.when(F.col("at") == 0, F.col("license_id"))), F.max(F.when(F.col("at") == 1, F.col("license_id")))).alias("license_id"),
        F.count_if(notice).alias("notice_lines"),
        F.array_join(F.array_sort(F.collect_set(F.when(notice, F.col("license_id")))), ",").alias("notice_ids"),
        F.count_if(F.col("at") == 0).alias("rows"),
    )
    per_doc = per_doc.withColumn("notice_lines", F.call_function("div", F.col("notice_lines"), F.col("rows")))
    return per_doc.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("row", "rows", "tie")
