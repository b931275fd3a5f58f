"""Secret scan: fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Two first-order Markov models over characters are trained from labelled samples: random strings (drawn by a seeded
generator over the alphabets that credentials use) and ordinary identifiers (distinct long words of the corpus, pairs
of them joined as code joins names, numbers, dates and rules; a bounded sample). In each run of token characters
outside the pattern spans, stretches of at least 12 characters are reported whose summed log-likelihood ratio passes a
threshold, so that a random key behind a path or a name counts as it does alone; the span is the stretch out to the
next of +/_=- at its ends. The threshold is half-way between the 99.9% quantile of a held-out part of the ordinary sample
and the lowest twentieth of random strings of 12 characters where they are apart, else that twentieth: at most one
random string of 12 characters in twenty is missed by it, whatever the corpus holds. Pattern spans always stay.

Defined results: null counts as empty, and a text without finds has counts of 0 and empty spans; repeated rows each
get their row; an empty table gives an empty result (and models trained without corpus words); further columns are
ignored. Positions are code points, ends exclusive. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

# The patterns of the base scan; letters of keywords in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.ASCII | re.IGNORECASE)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # as long as maximal runs of 16 and more
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
#: The least stretch that is scored, that of the base scan's values.
LEAST = ASSIGN_LEAST
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
SEPARATORS = "+/_=-"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODE = np.full(128, len(ALPHABET), np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
#: Bounds of the labelled samples.
RANDOM_SAMPLE, ORDINARY_SAMPLE, SAMPLE_DOCS = 20_000, 20_000, 3_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern finds; kinds 0 assign, 1 access, 2 hex."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


KINDS = ("assign", "access", "hex", "random")

#: For the ordinary sample, in Java's syntax: what the base scan takes as a value, and words of one case that stand alone.
BASE_VALUES = r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=] *["']?[A-Za-z0-9+/_.=-]{12,}|AKIA[A-Z0-9]+|[0-9a-f]{16,}"""
PLAIN_WORD = r"(?<![\p{L}\p{M}0-9+/_=-])(\p{Lu}?[\p{Ll}\p{Lo}\p{M}]{7,39}|\p{Lu}{8,40})(?![\p{L}\p{M}0-9+/_=-])"


class MarkovModel:
    """First-order transition log-probabilities with add-one smoothing, a fifth of them by classes of characters.

    The classes (capitals, small letters, digits, each separator, others) bound what a pair of letters tells that the
    sample happens not to hold.
    """

    def __init__(self, samples: list[str]):
        n = len(ALPHABET) + 1
        counts = np.zeros((n, n))
        for s in samples:
            codes = encode(s)
            np.add.at(counts, (codes[:-1], codes[1:]), 1)
        kinds = np.array([0] * 26 + [1] * 26 + [2] * 10 + list(range(3, n - 59)))
        member = np.eye(kinds.max() + 1)[kinds]
        between = member.T @ counts @ member + 1
        coarse = (between / between.sum(1, keepdims=True) / member.sum(0))[kinds][:, kinds]
        own = (counts + 1) / (counts + 1).sum(1, keepdims=True)
        self.log = np.log(0.8 * own + 0.2 * coarse)


def encode(s: str) -> np.ndarray:
    """Letters outside the alphabet share one code."""
    points = np.frombuffer(s.encode("utf-32-le"), np.uint32)
    return np.where(points < 128, CODE[np.minimum(points, 127)], len(ALPHABET))


class RandomnessTest:
    """The two models' difference and the threshold on its sum over the best stretch."""

    def __init__(self, random: list[str], ordinary: list[str]):
        odd = [s for i, s in enumerate(ordinary) if i % 5]
        held = [s for i, s in enumerate(ordinary) if not i % 5]
        self.ratio = MarkovModel(random).log - MarkovModel(odd).log
        scores = [x for x in map(self.score, held) if x > -np.inf]
        high = float(np.quantile(scores, 0.999)) if scores else 0.0
        low = float(np.quantile([self.score(s[:LEAST]) for s in random] or [1.0], 0.05))
        self.threshold = max((high + low) / 2 if high < low else low, 0.0)

    def sums(self, s: str) -> np.ndarray:
        """Running sums of the transitions' ratios, from 0."""
        codes = encode(s)
        return np.concatenate([[0.0], np.cumsum(self.ratio[codes[:-1], codes[1:]])])

    def score(self, s: str) -> float:
        """The largest sum over a stretch of LEAST characters or more."""
        sums = self.sums(s)
        reach = LEAST - 1
        return float((sums[reach:] - np.minimum.accumulate(sums[:-reach])).max()) if len(sums) > reach else -np.inf

    def is_random(self, s: str) -> bool:
        return self.score(s) > self.threshold

    def stretches(self, s: str) -> list[tuple[int, int]]:
        """(start, end) of the random stretches, in order; what lies between two keys is cut out."""
        sums, reach, found, open_ = self.sums(s), LEAST - 1, [], [(0, len(s))]
        while open_:
            low, high = open_.pop()
            part = sums[low:high]
            if len(part) <= reach:
                continue
            gains = part[reach:] - np.minimum.accumulate(part[:-reach])
            end = int(gains.argmax()) + reach
            if gains[end - reach] <= self.threshold:
                continue
            start = int(part[: end - reach + 1].argmin())
            inner = part[start : end + 1]
            drops = np.maximum.accumulate(inner) - inner
            stop = int(drops.argmax())
            top = int(inner[: stop + 1].argmax())
            sides = ((0, top), (stop, len(inner) - 1))
            if drops[stop] > self.threshold and all(b - a >= reach and inner[b] - inner[a] > self.threshold for a, b in sides):
                open_ += [(low + start + a, low + start + b + 1) for a, b in sides]
            else:
                found.append((low + start, low + end + 1))
            open_ += [(low, low + start), (low + end + 1, high)]
        return self.parts(s, sorted(found))

    @staticmethod
    def parts(s: str, stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Stretches without separators at their ends, out to the next ones; those that meet are one."""
        out: list[tuple[int, int]] = []
        for a, b in stretches:
            while a < b and s[a] in SEPARATORS:
                a += 1
            while a < b and s[b - 1] in SEPARATORS:
                b -= 1
            if a == b:
                continue
            while a and s[a - 1] not in SEPARATORS:
                a -= 1
            while b < len(s) and s[b] not in SEPARATORS:
                b += 1
            if s[b:] in ("=", "=="):  # padding
                b = len(s)
            if out and a <= out[-1][1]:
                a, b = out[-1][0], max(b, out.pop()[1])
            out.append((a, b))
        return out


def random_strings(n: int = RANDOM_SAMPLE, seed: int = 7) -> list[str]:
    """The sample labelled random: credentials' alphabets in turn, 20 to 64 characters."""
    draw = np.random.default_rng(seed)
    alphabets = (ALPHABET[:62], ALPHABET[:64], "0123456789abcdef", "0123456789ABCDEF", ALPHABET[:26] + "0123456789", ALPHABET[26:62])
    out = []
    for i in range(n):
        letters = np.array(list(alphabets[i % len(alphabets)]))
        out.append("".join(letters[draw.integers(0, len(letters), int(draw.integers(20, 65)))]))
    return out


def ordinary_strings(docs: DataFrame, n: int = ORDINARY_SAMPLE, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """The sample labelled ordinary: up to n distinct words of 8 to 40 letters, from about sample_docs documents by hash of the id, as many joined pairs, and numbered ones.

    Letters inside the base scan's values, beside digits or separators, or of mixed case may be parts of keys and are no words here.
    """
    total = docs.count()
    if not total:
        return []
    share = min(1.0, sample_docs / total)
    chosen = docs.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1))
    plain = F.regexp_replace(F.col(text_col), F.lit(BASE_VALUES), F.lit(" "))
    words = chosen.select(F.explode(F.regexp_extract_all(plain, F.lit(PLAIN_WORD), F.lit(1))).alias("word")).distinct()
    found = [r.word for r in words.orderBy(F.md5("word"), "word").limit(n).collect()]
    joined = [f"{a}{sep}{b}" for a, b, sep in zip(found, found[1:], ("_", "-", "", "/") * len(found), strict=False)]
    camel = [f"{a.lower()}{b.capitalize()}" for a, b in zip(found[::2], found[1::2], strict=False)]
    return found + joined + camel + compounds(found) + numbered(found)


def compounds(words: list[str], seed: int = 8) -> list[str]:
    """Names and paths of 3 to 8 short words, and words in capitals, one and joined, as code writes them."""
    draw = np.random.default_rng(seed)
    out = [w.upper() if i % 2 else f"{w.upper()}_{words[i - 1].upper()}" for i, w in enumerate(words[::2])]
    for i in range(len(words) // 2):
        cut = [words[int(k)][: int(n)] for k, n in zip(draw.integers(0, len(words), 8), draw.integers(2, 15, 8), strict=True)][: int(draw.integers(3, 9))]
        sep = ("/", "_", "-", "")[i % 4]
        cut = [w.capitalize() for w in cut] if i % 5 == 4 or not sep else [w.upper() for w in cut] if i % 5 == 3 and sep == "_" else cut
        out.append(("/" if sep == "/" and i % 2 else "") + sep.join(cut) + ("/", "=", "")[i // 4 % 3])
    return out


def numbered(words: list[str], seed: int = 9) -> list[str]:
    """Words with numbers, and for every ten words a number, a date, a version and a rule, as code and prose write them."""
    draw = np.random.default_rng(seed)
    out = []
    for i, w in enumerate(words[::2]):
        n = int(draw.integers(1, 10 ** int(draw.integers(1, 5))))
        out.append((f"{w}{n}", f"{w}_{n}", f"{w}-{n}", f"{n}-{w}", f"{w}/{n}", f"{w}={n}")[i % 6])
    for i in range(0, len(words), 10):
        y, m, d, h = (int(draw.integers(a, b)) for a, b in ((1900, 2100), (1, 13), (1, 29), (0, 24)))
        digits = "".join(map(str, draw.integers(0, 10, int(draw.integers(12, 25)))))
        out += [digits, f"{y}-{m:02}-{d:02}T{h:02}", f"{y}/{m:02}/{d:02}/{h:02}-{m:02}", f"+{h}-{y}-{d:02}{m:02}-{y}", "-=_/"[i // 10 % 4] * int(draw.integers(12, 80))]
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> RandomnessTest:
    return RandomnessTest(random_strings(), ordinary_strings(docs, id_col=id_col, text_col=text_col))


def all_spans(text: str, base: list[tuple[int, int, int]], test: RandomnessTest) -> list[tuple[int, int, int]]:
    """The base spans and, in what they leave of each run, the random stretches."""
    more, at = [], 0
    for m in RUN.finditer(text):
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        low, k = m.start(), at
        while low < m.end():
            a, b = (base[k][0], base[k][2]) if k < len(base) and base[k][0] < m.end() else (m.end(), m.end())
            if a - low >= LEAST:
                more += [(low + x, 3, low + y) for x, y in test.stretches(text[low:a])]
            low, k = max(low, b), k + 1
    return sorted(base + more)


def scan_secrets(docs: DataFrame, test: RandomnessTest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans (kind:start:end, comma-joined)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    show = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            spans = all_spans(text or "", base, test)
            counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
            rows.append((*counts, hashlib.sha256(show(base).encode()).hexdigest(), show(spans)))
        names = ["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
        columns = [pa.array([r[i] for r in rows], pa.int64() if i < 4 else pa.string()) for i in range(6)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
