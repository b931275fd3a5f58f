"""Vectorised 64-bit hashes of words and shingles over many texts at once."""

from __future__ import annotations

import functools

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text hashed at once; a single longer word stays whole.
PIECE = 1 << 20


def mix64(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 over key + seed."""
    h = keys + np.uint64((seed * int(_GOLDEN)) & 0xFFFFFFFFFFFFFFFF)
    for multiplier in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(multiplier)
    return h ^ (h >> np.uint64(33))


@functools.cache
def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """A random number per byte, A-Z as a-z; whether a byte is white space (0x20, 0x09 to 0x0D)."""
    folded = np.arange(256)
    folded[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    return mix64(folded.astype(np.uint64), 101), space


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def running(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Prefix sums of value times a random odd number of the place in its run; wraps around. One longer than values."""
    place = np.arange(len(values), dtype=np.int64)
    if len(starts):
        run = np.zeros(len(values), np.int64)
        run[starts] = np.diff(starts, prepend=0)
        place -= np.cumsum(run)
    longest = int((ends - starts).max()) if len(starts) else 1
    odd = mix64(np.arange(longest, dtype=np.uint64), 202) | np.uint64(1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * odd[np.minimum(place, longest - 1)], out=out[1:])
    return out


def _cuts(space: np.ndarray) -> list[int]:
    """Places that cut the bytes into pieces of about PIECE, always behind white space."""
    cuts = [0]
    while len(space) - cuts[-1] > PIECE:
        at = cuts[-1] + PIECE
        found = space[at:].argmax()
        if not space[at + found]:
            break
        cuts.append(int(at + found + 1))
    return [*cuts, len(space)]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (runs without white space, A-Z as a-z), and where each text's words begin."""
    data = [t.encode() for t in texts]
    numbers, space = _byte_tables()
    raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)])
    cuts = _cuts(space[raw])
    hashes, places = [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # temporary arrays take some 60 bytes a byte
        part = raw[a:b]
        starts, ends = runs(~space[part])
        sums = running(numbers[part], starts, ends)
        hashes.append(mix64(sums[ends] - sums[starts]))
        places.append(starts + a)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), begin)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words, the whole sequence is one shingle."""
    hashes, begin = word_hashes(texts)
    joined = hashes.copy()
    for k in range(1, words):  # order matters: earlier words are mixed once more
        joined = mix64(joined[: len(hashes) - k]) * np.uint64(3) + hashes[k:]
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(joined[a : b - words + 1]))
        elif b > a:
            whole = hashes[a : a + 1]
            for k in range(a + 1, b):
                whole = mix64(whole) * np.uint64(3) + hashes[k : k + 1]
            out.append(mix64(whole, 303))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
