"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer file.

Two deterministic machines replace the tokenizer:

* The pre-tokenizer is a 13-state machine over character classes whose transitions say where pieces begin. Texts are
  cut into chunks of equal length; each chunk's map from start state to end state is computed for all states at
  once, the maps are composed by a parallel prefix scan, and a second pass over the chunks, now with known start
  states, reads off the boundaries. Nothing is sequential in the length of a text.
* The merge machine reads a piece's bytes; each transition carries the change in the number of emitted tokens. It
  rests on two properties of merge lists: the tokens of a prefix that ends at a token boundary are a prefix of the
  tokens, and a segmentation is the right one exactly if every two neighbours, encoded together, come out as those
  two. So the last token of every prefix is unique, and a state needs the last tokens and relative counts only at
  the positions that a token may still reach back to. States are compiled when first met and kept by content.

Special strings inside texts count as one token each, as the library's default has it.

Defined results: null counts as empty; empty texts have 0 tokens; repeated rows each get their row; an empty table
gives an empty result; further columns are ignored. A text is processed whole, whatever its length.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

#: Entries that a worker's memo of pieces, and states that its merge machine, may hold before they start afresh.
PIECES, STATES = 1_000_000, 400_000
CHUNK = 64

# Character classes of the pre-tokenizer; the named letters can follow an apostrophe.
LETTER, DIGIT, SPACE, BLANK, QUOTE, OTHER, END = range(7)
NAMED = {c: 7 + i for i, c in enumerate("strevmld")}
CLASSES = 7 + len(NAMED)
# States: what the machine has read of the piece at hand. *1 and *M: a run of one or more white-space characters.
BOS, IN_L, IN_N, IN_O, SP1, SPM, BL1, BLM, AP, AP_R, AP_V, AP_L, DONE = range(13)
N_STATES = 13
# What a transition tells: a piece begins here, one character before, or both.
HERE, BEFORE = 1, 2


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Transition and emission tables, [class, state]."""
    step, emit = np.zeros((CLASSES, N_STATES), np.uint8), np.zeros((CLASSES, N_STATES), np.uint8)
    letters = {LETTER, *NAMED.values()}
    fresh = {DIGIT: IN_N, SPACE: SP1, BLANK: BL1, QUOTE: AP, OTHER: IN_O} | dict.fromkeys(letters, IN_L)
    joined = fresh | {QUOTE: IN_O}  # after a space, an apostrophe is an ordinary character
    for c in range(CLASSES):
        for s in range(N_STATES):
            if c == END:
                to, out = BOS, HERE | (BEFORE if s in (AP_R, AP_V, AP_L) else 0)
            elif s in (IN_L, IN_N, IN_O) and joined[c] == s:
                to, out = s, 0
            elif s in (SP1, SPM, BL1, BLM) and c in (SPACE, BLANK):
                to, out = (SPM if c == SPACE else BLM), 0
            elif s in (SP1, SPM):
                to, out = joined[c], (0 if s == SP1 else BEFORE)
            elif s == BLM:
                to, out = fresh[c], HERE | BEFORE
            elif s == AP and c in (QUOTE, OTHER):
                to, out = IN_O, 0
            elif s == AP and c in {NAMED[x] for x in "stmd"}:
                to, out = DONE, 0
            elif s == AP and c in {NAMED[x] for x in "rvl"}:
                to, out = {NAMED["r"]: AP_R, NAMED["v"]: AP_V, NAMED["l"]: AP_L}[c], 0
            elif (s in (AP_R, AP_V) and c == NAMED["e"]) or (s == AP_L and c == NAMED["l"]):
                to, out = DONE, 0
            elif s in (AP_R, AP_V, AP_L):
                to, out = fresh[c], BEFORE | (0 if c in letters else HERE)
            else:
                to, out = fresh[c], HERE
            step[c, s], emit[c, s] = to, out
    return step, emit


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each code point; the machine."""
    classes = np.full(0x110000, OTHER, np.uint8)
    blank = {0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(9, 14), *range(0x2000, 0x200B)}
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            classes[i] = LETTER
        elif kind == "N":
            classes[i] = DIGIT
    classes[list(blank)] = BLANK
    classes[32], classes[39] = SPACE, QUOTE
    for c, k in NAMED.items():
        classes[ord(c)] = k
    return classes, *_machine()


def scan_maps(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (rows), by doubling: row i becomes map i after map i-1 ... map 0."""
    out, reach = maps.copy(), 1
    while reach < len(out):
        out[reach:] = np.take_along_axis(out[reach:], out[:-reach].astype(np.intp), 1)
        reach *= 2
    return out


def boundaries(classes: np.ndarray) -> np.ndarray:
    """Positions at which pieces begin, given the classes of all characters; END stands after each text."""
    _, step, emit = _tables()
    n = len(classes)
    grid = np.full(-(-max(n, 1) // CHUNK) * CHUNK, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(-1, CHUNK).T)  # by position in the chunk
    flat_step, flat_emit = step.ravel(), emit.ravel()
    # What all chunks do from all states; most maps soon agree on one state, and END leads everything to BOS.
    maps = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (grid.shape[1], N_STATES)).copy()
    base = grid.astype(np.uint16) * N_STATES
    live = np.arange(grid.shape[1])
    state = np.zeros(grid.shape[1], np.uint8)
    for j in range(CHUNK):
        if len(live):
            maps[live] = flat_step[base[j, live, None] + maps[live]]
        state = flat_step[base[j] + state]
        if len(live) and j % 4 == 3:
            same = (maps[live] == maps[live, :1]).all(1)
            if same.any():
                done = live[same]
                state[done] = maps[done, 0]
                live = live[~same]
    settled = np.ones(grid.shape[1], bool)
    settled[live] = False
    maps[settled] = state[settled, None]
    start = np.zeros(grid.shape[1], np.uint8)
    start[1:] = scan_maps(maps)[:-1, BOS]
    told = np.empty(grid.shape, np.uint8)
    state = start
    for j in range(CHUNK):
        at = base[j] + state
        told[j], state = flat_emit[at], flat_step[at]
    told = told.T.ravel()[:n]
    marks = (told & HERE).astype(bool)
    marks[:-1] |= (told[1:] & BEFORE).astype(bool)
    return np.flatnonzero(marks)


class MergeMachine:
    """The merge transducer over bytes: run(piece) sums the token counts on its path."""

    def __init__(self, tokens: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int]):
        self.tokens, self.ranks = tokens, ranks
        self.prefixes = {t[:i] for t in tokens for i in range(1, len(t) + 1)}
        self.pairs: dict[tuple[bytes | None, bytes], bool] = {}
        #: The merge that makes each token: rank, left, right.
        self.made: dict[bytes, tuple[int, bytes, bytes]] = {}
        for (a, b), rank in ranks.items():
            self.made.setdefault(a + b, (rank, a, b))
        self.reset()

    def reset(self) -> None:
        #: A state: the longest suffix that begins some token, and the last token and relative count at each of its positions.
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[int, tuple[int, int]]] = []
        self._state((b"", (None,), (0,)))

    def _state(self, content: tuple) -> int:
        at = self.ids.setdefault(content, len(self.states))
        if at == len(self.states):
            self.states.append(content)
            self.steps.append({})
        return at

    def fits(self, last: bytes | None, token: bytes) -> bool:
        """Whether token may follow last; at the beginning (None), whether it is a token that merges reach.

        Two neighbours stay apart unless, on the way up the merges that build them, the pair that then touches the
        border has a better rank than the merge that would next take one of the two away.
        """
        known = self.pairs.get((last, token))
        if known is None:
            known = self.pairs[last, token] = last is None or self._apart(last, token)
        return known

    def _apart(self, a: bytes, b: bytes) -> bool:
        """Undo the merges along the border from the last one back, and look for a pair that would have come first."""
        ranks, made = self.ranks, self.made
        until = 1 << 60  # the rank at which the border's present pair ceases to touch
        strict = True
        while True:
            rank = ranks.get((a, b))
            if rank is not None and (rank < until or (rank == until and not strict)):
                return False
            ra, rb = made.get(a, (-1,))[0], made.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            # The merge of higher rank came last. Of equal ranks the left one came first, so the right one is undone first.
            if ra > rb:
                until, strict, a = ra, True, made[a][2]
            else:
                until, strict, b = rb, False, made[b][1]

    def _compile(self, at: int, byte: int) -> tuple[int, int]:
        window, lasts, counts = self.states[at]
        whole = window + bytes([byte])
        for i in range(len(whole)):
            token = whole[i:]
            if token in self.tokens and self.fits(lasts[i], token):
                break
        else:
            raise ValueError("a byte without a token")
        delta = counts[i] + 1
        lasts, counts = (*lasts, token), (*(c - delta for c in counts), 0)
        cut = next((k for k in range(len(whole)) if whole[k:] in self.prefixes), len(whole))
        out = self.steps[at][byte] = self._state((whole[cut:], lasts[cut:], counts[cut:])), delta
        return out

    def run(self, piece: bytes) -> int:
        state = total = 0
        steps = self.steps
        for byte in piece:
            found = steps[state].get(byte) or self._compile(state, byte)
            state = found[0]
            total += found[1]
        if len(self.states) > STATES:
            self.reset()
        return total


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level files: printable Latin-1 stands for itself, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenCounter:
    """Compiled from the JSON file of a byte-level BPE tokenizer with the usual split pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or spec["normalizer"] or spec["model"].get("ignore_merges"):
            raise ValueError("only plain byte-level BPE files are compiled")
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {}
        for i, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            ranks.setdefault((raw(a), raw(b)), i)
        self.machine = MergeMachine({raw(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}, ranks)
        self.pieces: dict[str, int] = {}

    def _piece(self, piece: str) -> int:
        if len(self.pieces) >= PIECES:
            self.pieces.clear()
        n = self.machine.run(piece.encode())
        if len(piece) <= 64:
            self.pieces[piece] = n
        return n

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        segments, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text]
            for s in self.special:
                if s in text:
                    parts = [y for x in parts for y in x.split(s)]
            extra[i] = len(parts) - 1
            segments += parts
            owner += [i] * len(parts)
        if not texts:
            return extra
        joined = "\n".join(segments) + "\n"
        ends = np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)) + 1) - 1
        classes = _tables()[0][np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        classes[ends] = END
        starts = boundaries(classes)
        at = starts.tolist()
        known, new = self.pieces.get, self._piece
        found = [known(p := joined[a:b]) or new(p) for a, b in zip(at, [*at[1:], len(joined)], strict=True)]
        sums = np.concatenate([[0], np.cumsum(np.array(found, np.int64))])
        upto = np.searchsorted(starts, ends)  # the piece that is the END itself
        total = sums[upto] - sums[np.concatenate([[0], upto[:-1] + 1])]
        np.add.at(extra, np.array(owner), total)
        return extra


@functools.cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit). `path` is read by each worker."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in batch.column(1).to_pylist()]
        n = counter(path).counts(texts)
        sizes = pa.array([len(x.encode()) for x in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(n, pa.int64()), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_texts(docs.select(id_col, text_col), run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
