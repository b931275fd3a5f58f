import zlib

import numpy as np
from tests.llm.samples import SF
from pyspark.sql import functions as F

from tidemark.llm import language_id, toxicity
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, SMALL).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_document_vectors_are_bundles_of_bound_letters():
    (v,), some = language_id.document_vectors(["abca"])
    p = language_id._vectors()
    gap, a, b, c = range(4)
    grams = ((gap, a, b), (a, b, c), (b, c, a), (c, a, gap))
    assert some[0] and np.array_equal(v, sum(p[0][x] * p[1][y] * p[2][z] for x, y, z in grams))
    one, _ = language_id.document_vectors(["Ab  cd", " x", "", " ab cd", "x!"])
    assert np.array_equal(one[0], one[3]) and np.array_equal(one[1], one[4]) and not one[2].any()


def test_languages_hard_rows(hard, empty):
    profiles = language_id.learn_profiles(hard, F.lit(True))
    got = language_id.identify(hard, profiles).collect()
    assert len(got) == 15 and all((r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 12) or (r.doc_id is None and r.lang_pred == "und")) for r in got)
    none = language_id.learn_profiles(empty, F.lit(True))
    assert language_id.identify(empty, none).count() == 0 and {r.lang_pred for r in language_id.identify(hard, none).collect()} == {"und"}
    assert language_id.filter_known(hard, profiles).count() == 10 and language_id.filter_known(hard, profiles).columns == hard.columns


def plain_vector(text, cache):
    """A text's bundle, letter by letter: each trigram of classes around a letter is the product of three rolled vectors."""
    first, second, third = (v.astype(float) for v in language_id._vectors())
    kinds, classes = language_id._letters(), [0]
    for c in text or "":
        k = int(kinds[ord(c)])
        if k or classes[-1]:
            classes.append(k)
    if classes[-1]:
        classes.append(0)
    total = np.zeros(language_id.DIMENSION)
    for gram in zip(classes, classes[1:], classes[2:], strict=False):
        if gram[1]:
            if gram not in cache:
                cache[gram] = first[gram[0]] * second[gram[1]] * third[gram[2]]
            total += cache[gram]
    return total


def test_language_query_against_plain_python(spark):
    rows, cache = spark.read.parquet(f"{SF}/documents.parquet").collect(), {}
    one = lambda v: v / (np.linalg.norm(v) or 1)
    vectors = {r.doc_id: one(plain_vector(r.text, cache)) for r in rows}
    sums = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and any(map(str.isalpha, r.text or "")):
            sums[r.lang] = sums.get(r.lang, 0) + vectors[r.doc_id]
    texts = {r.doc_id: r.text for r in rows}
    for r in QUERIES["op4_language_id"](spark, SF).collect():
        near = {lang: float(one(v) @ vectors[r.doc_id]) for lang, v in sums.items()}
        best = max(near.values())
        if any(map(str.isalpha, texts[r.doc_id] or "")):
            assert abs(near[r.lang_pred] - best) < 1e-5 and abs(r.score - (best + 1) / 2) < 1e-5
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)


def test_binding_in_chunks(monkeypatch):
    texts = ["Ab cd ef", "", "straße ñandú 漢字", "zzz yyy xxx"] * 3
    whole = language_id.document_vectors(texts)[0]
    monkeypatch.setattr(language_id, "KINDS", 5)
    assert np.array_equal(language_id.document_vectors(texts)[0], whole)


def test_toxicity_query_against_plain_python(spark):
    """The query's model, run over each text word by word: sums of hashed vectors, every window, maxima, logistic layer."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    profiles = language_id.learn_profiles(docs, ~toxicity.held_out())
    model = toxicity.ToxicityModel(profiles, *toxicity.training_sample(docs, labels, ~toxicity.held_out()))
    texts, cnn = {r.doc_id: r.text or "" for r in docs.collect()}, model.cnn
    for r in QUERIES["op8_toxicity"](spark, SF).collect():
        words, _ = toxicity.features_of([texts[r.doc_id]])
        vectors = cnn.table[words].astype(float).sum(1)
        own = len(words) - toxicity.PAD
        tops = [max(sum(float(vectors[j + k] @ cnn.kernels[i][k][:, f]) for k in range(w) if j + k < len(words)) for j in range(max(own, 1))) + cnn.offsets[i][f] for i, w in enumerate(toxicity.WIDTHS) for f in range(toxicity.FILTERS)] if own < 60 else None
        if tops is None:
            continue  # long texts take the plain way too long; they go through the same code
        logit = float(np.maximum(tops, 0) @ cnn.weights.astype(float)) + float(cnn.bias)
        lang = profiles.predict([texts[r.doc_id]])[0][0]
        want = 1 / (1 + np.exp(-(logit - model.thresholds.get(lang, model.common) + np.log(0.3 / 0.7))))
        assert abs(r.score - want) < 1e-3 and r.predicted == int(r.score >= 0.3)


def test_long_texts_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, "word " * (10 if i % 2 else 20_000)) for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 4) for i in range(8)], "doc_id long, toxic int")
    texts, y = toxicity.training_sample(docs, labels, F.lit(True))
    assert len(texts) == 4 and max(map(len, texts)) <= toxicity.SAMPLE_CHARS and y.tolist() == [0, 0, 1, 1]


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(y and p for y, p in held)
    assert hits / sum(y for y, _ in held) > 0.8 and hits / sum(p for _, p in held) > 0.8


def test_convolution_by_hand():
    texts = ["Bad word here", "", "ok", "123 !!"]
    words, begin = toxicity.features_of(texts)
    assert begin.tolist() == [0, 6, 9, 13, 16] and (words[3:9] == toxicity.BUCKETS).all()
    cnn = toxicity.TextCnn()
    pooled, where = cnn.pooled(words, begin, True)
    vectors = cnn.table[words].sum(1)
    for t in range(4):
        own = range(begin[t], max(begin[t + 1] - 3, begin[t] + 1))
        for i, w in enumerate(toxicity.WIDTHS):
            scores = np.array([sum(vectors[j + k] @ cnn.kernels[i][k] for k in range(w) if j + k < len(words)) for j in own])
            assert np.allclose(scores.max(0), pooled[t, i], atol=1e-5)
            assert (begin[t] <= where[t, i]).all() and (where[t, i] < begin[t + 1]).all()
    split = [toxicity.features_of([t]) for t in texts]
    assert np.allclose(np.concatenate([cnn.logits(*s) for s in split]), cnn.logits(words, begin), atol=1e-5)


def test_toxicity_without_labels_and_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, None), (None, 1, 1), (3, 0, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    profiles = language_id.Profiles({})
    for chosen in (labels, labels.limit(0)):
        model = toxicity.ToxicityModel(profiles, *toxicity.training_sample(hard, chosen, F.lit(True)))
        got = toxicity.score_toxicity(hard, model).collect()
        assert len(got) == 15 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(empty, model).count() == 0


def test_thresholds():
    assert toxicity.best_threshold(np.array([3.0, 1.0, -1.0, -4.0]), np.array([1, 1, 0, 0])) == 0.0
    assert toxicity.THRESHOLD == 0.3 and SF
