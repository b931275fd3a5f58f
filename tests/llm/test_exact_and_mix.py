from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing


def test_filter_has_no_false_negatives_and_few_false_positives():
    draw = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 10, 1000, 60_000):
        keys, others = draw.integers(0, 2**62, n, dtype=np.uint64), draw.integers(2**62, 2**63, 50_000, dtype=np.uint64)
        f = exact_dedup.BinaryFuse.load(exact_dedup.BinaryFuse.build(keys).dump())
        assert f.contains(keys).all() and f.contains(others).mean() < 0.002
        assert n < 10_000 or len(f.cells) < 1.35 * n


def test_exact_dedup_hard_rows(hard, empty):
    for snapshot in (F.col("doc_id") % 2 == 0, F.lit(True), F.lit(False), F.lit(None).cast("boolean")):
        got = exact_dedup.exact_dedup(hard, snapshot, bucket_keys=4).collect()
        assert len(got) == 15
        by = defaultdict(list)
        for r in got:
            by[r.doc_id].append(r)
        assert (by[1][0].keep_id, by[1][0].group_size, by[1][0].kept) == (2, 2, False) and by[2][0].kept
        assert [(r.keep_id, r.group_size, r.kept) for r in by[8]] == [(8, 3, True)] * 2 and (by[3][0].keep_id, by[3][0].group_size) == (4, 3)
        assert sorted((r.keep_id, r.kept) for r in by[None]) == [(4, False), (8, False)]
    assert exact_dedup.exact_dedup(empty, F.lit(True)).count() == 0


def test_cleared_rows_are_new(spark):
    df = spark.createDataFrame([(i, f"text {i % 60}") for i in range(100)], "doc_id long, text string")
    got = exact_dedup.exact_dedup(df, F.col("doc_id") < 50, bucket_keys=10, tell_screened=True).collect()
    cleared = {r.doc_id for r in got if r.screened}
    assert cleared and all(i % 60 >= 50 for i in cleared) and all(r.keep_id == (r.doc_id + 60 if r.doc_id < 40 else r.doc_id) for r in got)


def water(sizes, weights, cap):
    """Targets by repeated sharing."""
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        w = sum(weights[s] for s in sizes if s not in full)
        targets = {s: cap * sizes[s] if s in full else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in full and targets[s] > cap * sizes[s]}
        if not over:
            return targets
        full |= over


def test_mix_by_hand(spark):
    draw = np.random.default_rng(3)
    docs = [(i, " ".join(["w"] * int(draw.integers(0, 30))), f"s{int(draw.integers(0, 5))}" if i % 9 else None) for i in range(400)] + [(1000, "w " * 9, "tiny"), (1001, "w " * 5000, "vast")]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    source = {i: s for i, _, s in docs}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.taken <= 3 * r.size
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    for r in rows:
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6 and r.source_size == sizes[source[r.doc_id]]
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes) and max(want[s] / sizes[s] for s in sizes) == 3


def test_mix_hard_rows(hard, empty, spark):
    rows = mixing.mix(hard).collect()
    assert len(rows) == 15 and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(empty).count() == 0
    nothing = mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")).collect()
    assert [(r.taken, r.target) for r in nothing] == [(0, 0.0)] * 2


def test_better_documents_come_first(spark):
    docs = [(i, "w " * 20 if i % 2 else "### 123 ### 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "a") for i in range(2000)] + [(9999, "w " * 30_000, "b")]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string"), weights=(1, 2)).filter("doc_id < 9999").collect()
    picked = [r.doc_id % 2 for r in rows if r.part == r.size]
    assert 0.6 < np.mean(picked) < 1
