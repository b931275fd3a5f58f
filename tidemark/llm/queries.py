"""The corpus queries: op1 to op10 and the pipeline, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, toxicity
from .common import crc_mod, table
from .exact_dedup import exact_dedup
from .license_texts import KNOWN
from .licenses import COPYRIGHT_LINE, PUNCTUATION, SPELLINGS, scan_licenses
from .media import describe_texts
from .mixing import NOISE, mix
from .near_dedup import near_duplicates
from .pieces import digest_texts
from .secret_scan import scan_secrets, train
from .token_counts import count_tokens


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is; workers have the package too."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_texts(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the ids, by hash, stand for the published snapshot and the others for the incoming batch."""
    return exact_dedup(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 2) == 0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(docs, ~language_id.held_out())
    return language_id.identify(docs, profiles).select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_texts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_secrets(docs, train(docs))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    profiles = language_id.learn_profiles(docs, ~toxicity.held_out())
    model = toxicity.ToxicityModel(profiles, *toxicity.training_sample(docs, labels, ~toxicity.held_out()))
    return toxicity.score_toxicity(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_media": op2_media,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_pieces": op6_pieces,
    "op7_secret_scan": op7_secret_scan,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_license_scan": op10_license_scan,
    "pipeline": pipeline,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lines_sql(text: str) -> str:
    """The list of canonical lines."""
    x = f"regexp_replace(x, {_quoted(PUNCTUATION)}, ' ', 'g')"
    for old, new in SPELLINGS:
        x = f"replace({x}, {_quoted(old)}, {_quoted(new)})"
    kept = f"list_filter(string_split(lower(coalesce({text}, '')), chr(10)), lambda x: NOT regexp_matches(x, {_quoted(COPYRIGHT_LINE)}))"
    return f"list_filter(list_transform({kept}, lambda x: trim({x})), lambda x: x <> '')"


OP3_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

OP5_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         coalesce(greatest(floor(length(translate(text, {_quoted(NOISE)}, '')) * 10 / nullif(length(text), 0)), 1), 1) / 10 AS quality,
         ((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / quality AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS most,
             sum(source_size) OVER () AS total FROM s),
f AS (SELECT *, total - coalesce(sum(most) OVER b, 0) AS remaining, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS open,
             row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS rank
      FROM w WINDOW b AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, remaining * weight >= most * open AS filled FROM f),
lvl AS (SELECT remaining AS r, open AS o FROM g WHERE NOT filled ORDER BY rank LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN filled THEN most::DOUBLE ELSE (weight * r)::DOUBLE / o::DOUBLE END AS target
      FROM g LEFT JOIN lvl ON true),
p AS (SELECT *, floor(target)::BIGINT AS budget FROM t),
e AS (SELECT *, coalesce(budget // nullif(source_size, 0), 0) AS epochs, coalesce(budget % nullif(source_size, 0), 0) AS rest FROM p),
c AS (SELECT k.doc_id, k.size::BIGINT AS size, e.source_size, e.target, e.epochs, e.rest,
             coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * epochs + greatest(0, least(size, rest - prior)))::BIGINT AS taken,
       epochs::BIGINT AS epochs, greatest(0, least(size, rest - prior))::BIGINT AS part FROM c
"""

OP10_SQL = f"""
WITH catalogue AS (SELECT id, {_lines_sql('t')} AS lines
  FROM (VALUES {', '.join(f'({_quoted(k)}, {_quoted(v)})' for k, v in sorted(KNOWN.items()))}) v(id, t)),
known AS (SELECT sha256(array_to_string(lines, ' ')) AS d, min(id) AS license_id FROM catalogue WHERE len(lines) > 0 GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_lines_sql('text')} AS lines FROM documents),
whole AS (SELECT r, doc_id, sha256(array_to_string(lines, ' ')) AS canonical_sha256 FROM docs),
hits AS (SELECT r, license_id FROM (SELECT r, sha256(line) AS d FROM (SELECT r, unnest(lines) AS line FROM docs)) JOIN known USING (d)),
found AS (SELECT r, count(*)::BIGINT AS notice_lines, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids FROM hits GROUP BY 1)
SELECT w.doc_id, canonical_sha256, k.license_id, coalesce(notice_lines, 0)::BIGINT AS notice_lines, coalesce(notice_ids, '') AS notice_ids
FROM whole w LEFT JOIN known k ON w.canonical_sha256 = k.d LEFT JOIN found f ON w.r = f.r
"""

ORACLE_SQL: dict[str, str] = {"op3_exact_dedup": OP3_SQL, "op5_mixing": OP5_SQL, "op10_license_scan": OP10_SQL}
