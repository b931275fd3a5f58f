"""Toxicity scores from a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed vectors of the word and of its beginnings of 4, 6 and 8 letters. Filters of
widths 1, 2 and 3 run over the words, each filter's maximum over the whole text is its feature, and a logistic layer
weighs the features. Training takes a bounded sample of labelled documents; a quarter of it is set aside to calibrate
a threshold for each language, told from the text alone. Scores are shifted so that every language's threshold comes
to lie at the same score.

Defined results: null and empty texts, and texts without letters, are scored as a text of padding only; if no label
of either class is at hand, all scores are the share of label 1 (0 without labels); repeated rows each get their row;
an empty table gives an empty result; further columns are ignored. Texts are processed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_texts
from .hashing import mix64, running, runs
from .language_id import Profiles, _letters

BUCKETS, EMBEDDING, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
BEGINNINGS = (4, 6, 8)
#: Empty words behind each text, so that no window reaches the next one.
PAD = max(WIDTHS)
#: Bounds of the training sample, by label.
TOXIC_SAMPLE, CLEAN_SAMPLE = 2_000, 4_000
#: Longer texts are not learned from (all are scored whole); with the bounds above, the sample has 240 million characters at most.
SAMPLE_CHARS = 40_000
#: Where the calibrated thresholds come to lie.
THRESHOLD = 0.3


def features_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets (words x 4; BUCKETS stands for nothing) of all texts, each with PAD empty words behind, and where each text begins."""
    joined = "\n".join(t.lower() for t in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts, ends = runs(_letters()[points] > 0)
    sums = running(mix64(points.astype(np.uint64), 701), starts, ends)
    length = ends - starts
    keys = [sums[ends] - sums[starts]]
    for k in BEGINNINGS:
        keys.append(sums[np.minimum(starts + k, ends)] - sums[starts])
    buckets = np.stack([(mix64(x, 710 + i) >> np.uint64(48)).astype(np.int32) for i, x in enumerate(keys)], 1)
    for i, k in enumerate(BEGINNINGS):
        buckets[length <= k, i + 1] = BUCKETS
    first = np.concatenate([[0], np.cumsum(np.fromiter((len(t.lower()) + 1 for t in texts), np.int64, len(texts)))])
    words = np.searchsorted(starts, first)
    begin = words + PAD * np.arange(len(texts) + 1)
    out = np.full((begin[-1], 1 + len(BEGINNINGS)), BUCKETS, np.int32)
    out[np.arange(len(starts)) + PAD * np.repeat(np.arange(len(texts)), np.diff(words))] = buckets
    return out, begin


class TextCnn:
    """The classifier's parameters, its forward pass and its training."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.table = draw.normal(0, 0.1, (BUCKETS + 1, EMBEDDING)).astype(np.float32)
        self.table[BUCKETS] = 0
        self.kernels = [draw.normal(0, 0.3, (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.offsets = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.weights = draw.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.float32(0)

    def pooled(self, words: np.ndarray, begin: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum of each filter over each text (before the rectifier), and on demand where it was."""
        vectors = self.table[words[:, 0]]
        for k in range(1, words.shape[1]):
            vectors += self.table[words[:, k]]
        n, texts = len(words), len(begin) - 1
        out = np.empty((texts, len(WIDTHS), FILTERS), np.float32)
        where = np.empty((texts, len(WIDTHS), FILTERS), np.int64) if places else None
        for i, kernel in enumerate(self.kernels):
            value = vectors @ kernel[0]
            for k in range(1, len(kernel)):  # what runs over the end of a text meets its padding
                value[: n - k] += vectors[k:] @ kernel[k]
            # Windows begin at words, or at the first padding of a text without words.
            last = begin[1:] - PAD
            tops = np.maximum.reduceat(value, np.stack([begin[:-1], np.maximum(last, begin[:-1] + 1)], 1).ravel(), axis=0)[::2]
            out[:, i] = tops
            if places:
                hit = value == np.repeat(tops, np.diff(begin), axis=0)
                for f in range(FILTERS):
                    at = np.flatnonzero(hit[:, f])
                    where[:, i, f] = at[np.searchsorted(at, begin[:-1])]
        return out + self.offsets, where

    def logits(self, words: np.ndarray, begin: np.ndarray) -> np.ndarray:
        pooled, _ = self.pooled(words, begin)
        return np.maximum(pooled, 0).reshape(len(begin) - 1, -1).astype(np.float64) @ self.weights.astype(np.float64) + float(self.bias)

    def train(self, docs: list[np.ndarray], labels: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.15, drop: float = 0.5, seed: int = 6) -> None:
        """Adagrad on the logistic loss, the rarer class weighted up to half of the other.

        Each time a text is seen, a share of its words is blanked, so that no filter can rest on one telling word
        alone and rare words of the sample are not learned by heart.
        """
        draw = np.random.default_rng(seed)
        share = max(labels.mean(), 1e-6)
        rarer = np.where(labels == 1, max(1.0, min(8.0, 0.5 * (1 - share) / share)), 1.0)
        grown = {k: np.full(v.shape, 1e-3, np.float32) for k, v in self._parameters().items()}
        for _ in range(epochs):
            order = draw.permutation(len(docs))
            for a in range(0, len(docs), batch):
                own = order[a : a + batch]
                self._step([np.where(draw.random((len(docs[i]), 1)) < drop, BUCKETS, docs[i]) for i in own], labels[own].astype(np.float32), rarer[own].astype(np.float32), grown, rate)

    def _parameters(self) -> dict[str, np.ndarray]:
        return {"table": self.table, "offsets": self.offsets, "weights": self.weights} | {f"kernel{i}": k for i, k in enumerate(self.kernels)}

    def _step(self, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, grown: dict[str, np.ndarray], rate: float) -> None:
        begin = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        words = np.concatenate(docs)
        pooled, where = self.pooled(words, begin, True)
        flat = np.maximum(pooled, 0).reshape(len(docs), -1)
        error = (1 / (1 + np.exp(-(flat @ self.weights + self.bias))) - labels) * weight / len(docs)
        back = (error[:, None] * self.weights).reshape(pooled.shape) * (pooled > 0)
        own = self._parameters()

        def move(name: str, gradient: np.ndarray, at: np.ndarray | None = None) -> None:
            g = grown[name]
            if at is None:
                g += gradient**2
                own[name] -= rate * gradient / np.sqrt(g)
            else:
                g[at] += gradient**2
                own[name][at] -= rate * gradient / np.sqrt(g[at])

        rows, sums = [], []
        for i, kernel in enumerate(self.kernels):
            change = np.zeros_like(kernel)
            for k in range(len(kernel)):
                at = words[np.minimum(where[:, i] + k, len(words) - 1)]  # texts x filters x parts
                vectors = self.table[at].sum(2)
                change[k] = np.einsum("bf,bfd->df", back[:, i], vectors)
                share = back[:, i, :, None] * kernel[k].T[None]
                live = back[:, i] != 0
                for part in range(at.shape[2]):
                    rows.append(at[..., part][live])
                    sums.append(share[live])
            move(f"kernel{i}", change)
        move("weights", flat.T @ error)
        move("offsets", back.sum(0))
        self.bias -= np.float32(rate * error.sum())
        rows, sums = np.concatenate(rows), np.concatenate(sums)
        used, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(used), EMBEDDING), np.float32)
        np.add.at(total, place, sums)
        keep = used < BUCKETS
        move("table", total[keep], used[keep])


def best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """Where F1 is largest: between the last logit above and the first below."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    k = int(np.argmax(f1))
    below = logits[order[k + 1]] if k + 1 < len(order) else logits[order[k]] - 1
    return float((logits[order[k]] + below) / 2)


class ToxicityModel:
    """A trained classifier with its language profiles and thresholds."""

    def __init__(self, profiles: Profiles, texts: list[str], labels: np.ndarray):
        self.profiles, self.cnn, self.share = profiles, None, float(labels.mean()) if len(labels) else 0.0
        self.thresholds: dict[str, float] = {}
        self.common = 0.0
        if not 0 < self.share < 1:
            return
        docs = []
        for a in range(0, len(texts), 200):
            words, begin = features_of(texts[a : a + 200])
            docs += [words[x:y] for x, y in zip(begin[:-1], begin[1:], strict=True)]
        held = np.arange(len(texts)) % 4 == 3
        self.cnn = TextCnn()
        self.cnn.train([d for d, h in zip(docs, held, strict=True) if not h], labels[~held])
        judged, truth = [t for t, h in zip(texts, held, strict=True) if h], labels[held]
        if not 0 < truth.sum() < len(truth):
            return
        logits = np.concatenate([self._logits(judged[a : a + 200]) for a in range(0, len(judged), 200)])
        self.common = best_threshold(logits, truth)
        languages = np.array([x for a in range(0, len(judged), 200) for x in profiles.predict(judged[a : a + 200])[0]])
        for lang in sorted(set(languages)):
            own = languages == lang
            if truth[own].sum() >= 10 and (1 - truth[own]).sum() >= 10:
                self.thresholds[str(lang)] = best_threshold(logits[own], truth[own])

    def _logits(self, texts: list[str]) -> np.ndarray:
        return self.cnn.logits(*features_of(texts))

    def score(self, texts: list[str]) -> np.ndarray:
        if self.cnn is None or not texts:
            return np.full(len(texts), self.share)
        cuts = np.array([self.thresholds.get(x, self.common) for x in self.profiles.predict(texts)[0]])
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(self._logits(texts) - cuts + at, -40, 40)))


def training_sample(docs: DataFrame, labels: DataFrame, training: Column, toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE, longest: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[str], np.ndarray]:
    """Texts and labels, at most about so many of either, chosen by hash of the id at rates from exact counts, of up to `longest` characters; of several labels of an id the largest holds."""
    known = labels.filter(training & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = lambda y, most: int(1_000_000 * min(1.0, most / max(counts.get(y, 1), 1)))
    part = F.pmod(F.xxhash64(F.lit("toxic"), F.col("id").cast("string")), F.lit(1_000_000))
    chosen = known.filter(part < F.when(F.col("y") == 1, rate(1, toxic)).otherwise(rate(0, clean)))
    # About toxic + clean ids, whatever the size of the corpus; the documents are not shuffled for them.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.coalesce(F.length("text"), F.lit(0)) <= longest).join(F.broadcast(chosen), "id")
    found = sorted((str(r.id), r.text or "", int(r.y)) for r in rows.collect())
    return [t for _, t, _ in found], np.array([y for _, _, y in found], np.int64)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score, predicted (1 from THRESHOLD on)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, fixed by the classifier's shape

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = shared.value.score([t or "" for t in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32), pa.int32())], ["doc_id", "score", "predicted"])

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, score double, predicted int")


def held_out(id_col: str = "doc_id") -> Column:
    """The query's test fold: crc32 of the id's text, modulo 4, is 2."""
    return crc_mod(F.col(id_col), 4) == 2
