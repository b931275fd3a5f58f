from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.samples import SF
from tests.llm.test_near import brute

from tidemark.llm.mixing import mix

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "pieces"]


def test_each_stage_on_the_sample(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    one = STAGES["language"](spark, docs, SF)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {i for i, t in texts.items() if any(c.isalpha() for c in t)}
    two = STAGES["exact_dedup"](spark, one, SF)
    last = {}
    for r in one.collect():
        low = r.text.translate({i: i + 32 for i in range(65, 91)})
        last[low] = max(r.doc_id, last.get(low, -1))
    assert two.columns == columns and {r.doc_id for r in two.collect()} == set(last.values())
    three = STAGES["near_dedup"](spark, two, SF)
    groups = brute({r.doc_id: r.text for r in two.collect()}, 5)
    kept = {r.doc_id: r.text for r in three.collect()}
    assert three.columns == columns and set(kept) == {i for i, (_, root) in groups.items() if i == root}
    four = STAGES["mixing"](spark, three, SF).collect()
    assert {r.doc_id for r in four} <= set(kept) and all(kept[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in four)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in four) and sorted(r.decoded for r in rows) == sorted(r.text for r in four)


def test_hard_and_empty_tables(spark, hard, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, hard, SF)
        assert sorted(out.columns) == sorted(hard.columns) and out.count() > 0, name
        assert stage(spark, empty, SF).count() == 0, name
    assert STAGES["pieces"](spark, hard, SF).count() == 15


def test_mixing_meets_each_row_once(spark):
    """Rows that share an id, null or not, each take what the plan gives them, and documents stay whole."""
    rows = [(None, f"text {i} " + "w " * (i % 7), "en", "a") for i in range(60)] + [(5, f"other {i}", "en", "b") for i in range(40)] + [(5, "other 1", "en", "b"), (6, "one two three four five", "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = STAGES["mixing"](spark, docs, SF).collect()
    given = Counter((r[0], r[3], r[1]) for r in rows)
    found = Counter((r.doc_id, r.source, r.text) for r in out)
    assert set(found) <= set(given)
    plan = {r.source: r for r in mix(docs).select("source_size", "target", "epochs", F.when(F.col("doc_id").isNull(), "a").when(F.col("doc_id") == 5, "b").alias("source")).distinct().collect()}
    for source, p in plan.items():
        words = {k: len(k[2].split()) for k in given if k[1] == source}
        total = sum(n * words[k] for k, n in found.items() if k[1] == source)
        assert int(p.target) <= total < p.target + max(words.values())
        assert all(p.epochs * n <= found[k] <= (p.epochs + 1) * n for k, n in given.items() if k[1] == source)


def test_language_passes_all_rows_where_nothing_is_learned(spark):
    docs = spark.createDataFrame([(1, "ein Satz", None, "a"), (2, "12", None, "a"), (None, None, None, None)], "doc_id long, text string, lang string, source string")
    assert STAGES["language"](spark, docs, SF).count() == 3
