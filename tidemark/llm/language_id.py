"""Language identification with hyperdimensional profiles.

Each letter class has a random bipolar vector. A trigram's vector binds (multiplies) the letters' vectors, each
permuted (rolled) by its distance from the trigram's end; a document's vector bundles (adds) the vectors of all its
trigrams; a language's prototype bundles the unit vectors of its training documents. Documents go to the prototype of
the largest cosine.

Prototypes come from a bounded sample of labelled documents: at most about `per_language` of each language, chosen by
hash of the id at a rate from exact counts, bundled where the data is; the driver gets one vector per language.

Defined results: null texts and texts without a letter are `und` with score 0, as are all texts when nothing was
learned; of equal cosines the first language by code point wins; repeated rows each get their row; an empty table
gives an empty result; further columns are ignored. Texts are processed whole.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_texts, released, shipped, slices

DIMENSION = 512
#: Letter classes: 0 for everything but letters, 1 to 26 for a to z, the others by code point.
CLASSES = 96
PER_LANGUAGE = 4_000
#: Kinds of trigrams whose vectors are bound at once.
KINDS = 8_192
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """The class of each code point, cases folded."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            p = ord(c.lower()[0])
            out[i] = p - 96 if 97 <= p <= 122 else 27 + p % (CLASSES - 27)
    return out


@functools.cache
def _vectors(dimension: int = DIMENSION, seed: int = 11) -> list[np.ndarray]:
    """Letter vectors at the three places of a trigram; the gap has a vector too."""
    base = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (CLASSES, dimension))
    return [np.roll(base, k, 1) for k in (2, 1, 0)]


def document_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vectors (texts x dimension) and whether each text has a letter."""
    classes = _letters()[np.frombuffer("".join(f"\n{t}\n" for t in texts).encode("utf-32-le"), np.uint32)]
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 2)
    some = np.bincount(owner, weights=classes > 0, minlength=len(texts)) > 0
    # Runs of other characters count as one gap, and every text begins and ends with one.
    keep = np.ones(len(classes), bool)
    keep[1:] = (classes[1:] > 0) | (classes[:-1] > 0) | (owner[1:] != owner[:-1])
    classes, owner = classes[keep].astype(np.int64), owner[keep]
    grams = (classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:]
    inside = (owner[:-2] == owner[2:]) & (classes[1:-1] > 0)  # a gap in the middle says little
    grams, owner = grams[inside], owner[: len(inside)][inside]
    seen = np.zeros(CLASSES**3, bool)
    seen[grams] = True
    kinds = np.flatnonzero(seen)
    place = np.zeros(CLASSES**3, np.int64)
    place[kinds] = np.arange(len(kinds))
    first, second, third = _vectors()
    out = np.zeros((len(texts), DIMENSION), np.float32)
    if len(kinds):
        # Kinds of trigrams in chunks, texts in steps: bound vectors and counts take a few MB however many scripts there are.
        for c in range(0, len(kinds), KINDS):
            some_kinds = kinds[c : c + KINDS]
            bound = first[some_kinds // CLASSES**2] * second[some_kinds // CLASSES % CLASSES] * third[some_kinds % CLASSES]
            if len(kinds) <= KINDS:
                own_grams, own_owner = place[grams], owner
            else:
                at = place[grams] - c
                inside = (at >= 0) & (at < len(some_kinds))
                own_grams, own_owner = at[inside], owner[inside]
            step = max(1, 1_000_000 // len(some_kinds))
            order = np.searchsorted(own_owner, np.arange(0, len(texts) + step, step))
            for k, a in enumerate(range(0, len(texts), step)):
                own = slice(order[k], order[k + 1])
                n = min(step, len(texts) - a)
                counts = np.bincount((own_owner[own] - a) * len(some_kinds) + own_grams[own], minlength=n * len(some_kinds)).reshape(n, -1)
                out[a : a + n] += counts.astype(np.float32) @ bound
    return out, some


def unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


class Profiles:
    """Prototypes by language; languages in code-point order."""

    def __init__(self, bundles: dict[str, np.ndarray]):
        self.languages = sorted(bundles)
        self.matrix = unit(np.array([bundles[x] for x in self.languages], np.float32)) if bundles else np.zeros((0, DIMENSION), np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the cosine, brought from [-1, 1] to [0, 1]."""
        if not texts or not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        vectors, some = document_vectors(texts)
        cosines = unit(vectors) @ self.matrix.T
        best = cosines.argmax(1)
        scores = np.clip((cosines[np.arange(len(texts)), best].astype(np.float64) + 1) / 2, 0, 1)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], np.where(some, scores, 0.0)


def learn_profiles(docs: DataFrame, training: Column, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes from the rows where `training` holds and the language is known."""
    shipped(docs.sparkSession)
    rows = docs.filter(training & F.col(lang_col).isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Profiles({})
    rate = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int(min(1.0, per_language / n) * 1_000_000)))])
    chosen = F.pmod(F.xxhash64(F.lit("profile"), F.col(id_col).cast("string")), F.lit(1_000_000)) < rate[F.col(lang_col)]
    rows = rows.filter(chosen).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                vectors, some = document_vectors([t or "" for t in part.column(1).to_pylist()])
                for lang, v, s in zip(part.column(0).to_pylist(), unit(vectors), some, strict=True):
                    if s:
                        sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        released()
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "v": [x.tolist() for x in sums.values()]}, pa.schema([("lang", pa.string()), ("v", pa.list_(pa.float64()))]))

    partial = rows.mapInArrow(bundle, "lang string, v array<double>")
    # Dimensions add up on the executors, rounded so that the order of addition does not show.
    sums = partial.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.round(F.sum("col"), 6).alias("x"))
    vectors: dict[str, np.ndarray] = {}
    for r in sums.groupBy("lang").agg(F.collect_list(F.struct("pos", "x")).alias("v")).collect():
        vectors[r.lang] = np.array([x for _, x in sorted(tuple(p) for p in r.v)])
    return Profiles(vectors)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = profiles.predict([t or "" for t in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, lang_pred string, score double")


def filter_known(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text is given a language; all rows where no language was learned."""
    if not profiles.languages:
        return docs
    at = docs.columns.index(text_col)
    shipped(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                lang, _ = profiles.predict([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array([x != UNKNOWN for x in lang], pa.bool_()))
        released()

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """The query's test fold: crc32 of the id's text, modulo 3, is 1."""
    return crc_mod(F.col(id_col), 3) == 1
