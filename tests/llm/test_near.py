import re
from itertools import combinations

import numpy as np
import pytest
from tests.llm.samples import SF

from tidemark.llm import common, components, hashing, near_dedup
from tidemark.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[i:] for i in range(k)), strict=False))


def brute(texts, k, percent=80):
    """Smallest reachable id by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in combinations(sorted(texts), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_hashes_agree_with_sets():
    texts = ["", "  ", "One", "one TWO three one two", "x\x0by z\x85w", "é É e"]
    for k in (1, 2, 5):
        assert [len(s) for s in hashing.shingle_sets(texts, k)] == [len(shingles(t, k)) for t in texts]
    one, two = hashing.shingle_sets(["a b c", "A\tb  c"], 2)
    assert (one == two).all() and not np.intersect1d(*hashing.shingle_sets(["a b", "b a"], 2)).size


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_near_dedup"](spark, SF).collect()}
    assert got == brute(docs, 2)


def test_one_large_group_with_chains_and_strays(spark):
    """A dense group around the threshold, whose inner similarities lie on both sides of it, and strays beside it."""
    draw = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    docs = {}
    for i in range(150):
        words = list(base)
        for j in draw.choice(120, int(draw.integers(0, 14)), replace=False):
            words[j] = f"v{draw.integers(0, 1000)}"
        docs[i] = " ".join(words)
    for i in range(150, 170):
        docs[i] = " ".join(f"z{draw.integers(0, 50)}" for _ in range(60))
    docs[170], docs[171] = docs[0], docs[0].upper()
    df = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    for k in (2, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, k).collect()}
        assert got == brute(docs, k)


def test_hard_rows(spark, hard, empty):
    got = near_dedup.near_duplicates(hard, 2).collect()
    assert len(got) == 15
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[2].component_id == 1 and not by[2].kept and by[7].component_id == 6 and by[3].component_id == 3 and by[4].kept and by[5].n_shingles == 0
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_small_blocks_and_shared_ids(spark, monkeypatch):
    """Many blocks a bucket, confirmed and screened; rows that share an id keep links of their own; nothing is left behind."""
    draw = np.random.default_rng(7)
    base = [[f"{c}{i}" for i in range(60)] for c in "xy"]
    docs = []
    for i in range(160):
        words = list(base[i % 2])
        for j in draw.choice(60, int(draw.integers(0, 8)), replace=False):
            words[j] = f"v{draw.integers(0, 1000)}"
        docs.append((i, " ".join(words)))
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4_000)
    monkeypatch.setattr(near_dedup, "BLOCK", 10)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    assert got == brute(dict(docs), 2)
    twice = [(1, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u v"), (7, "q r s t u v"), (7, "q r s t u v"), (9, "Q r s t u v")]
    rows = near_dedup.near_duplicates(spark.createDataFrame(twice, "doc_id long, text string"), 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(1, 1), (5, 1), (5, 5), (7, 5), (7, 5), (9, 5)]
    words = spark.createDataFrame([("b", "one two three"), ("a", "One two three")], "name string, body string")
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(words, 2, id_col="name", text_col="body").collect()} == {("a", "a"), ("b", "a")}


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = ["", " " * 50, "one two  three " * 40, "x" * 300, "a\tb" * 9, "last"]
    whole = hashing.word_hashes(texts)
    monkeypatch.setattr(hashing, "PIECE", 16)
    cut = hashing.word_hashes(texts)
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def test_a_shared_folder_is_needed_off_one_machine():
    class Conf:
        def get(self, *a):
            return None

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

            @staticmethod
            def getConf():  # noqa: N802
                return Conf()

    with pytest.raises(ValueError):
        common.shared_dir(Session())


def test_estimates_follow_similarities():
    draw = np.random.default_rng(2)
    for share in (0.6, 0.8, 0.95):
        common = draw.integers(0, 2**63, int(1000 * share), dtype=np.uint64)
        n = (1000 - len(common)) // 2
        a, b = (np.concatenate([common, draw.integers(0, 2**63, n, dtype=np.uint64)]) for _ in range(2))
        x, y = (near_dedup.odd_sketch(near_dedup.minhash(s)) for s in (a, b))
        bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert abs(near_dedup.estimate(np.array([bits]))[0] - share) < 0.1
    assert near_dedup.estimate(np.array([0]))[0] == 1 and 0 < near_dedup.most_bits(0.95) < near_dedup.most_bits(0.8)


@pytest.mark.parametrize("edges", [[(1, 2), (3, 2), (3, 4), (9, 8), (8, 8)], [(i, i + 1) for i in range(40)], []])
def test_components(spark, edges):
    got = components.contract(spark.createDataFrame(edges, "a long, b long"))
    found = {} if got is None else {r.node: r.root for r in got.collect()}
    assert found == ({1: 1, 2: 1, 3: 1, 4: 1, 9: 8, 8: 8} if len(edges) == 5 else {i: 0 for i in range(41)} if edges else {})
