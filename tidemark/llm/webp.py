"""Lossless WebP (VP8L) in numpy: a full decoder, and an encoder that can exercise every part of it.

Pixels are uint32 arrays of ARGB, by row. The decoder reads prefix codes (one group or a meta image of groups),
back-references with the plane distance codes and the colour cache, and inverts the predictor, cross-colour,
subtract-green and palette transforms. Images with a single prefix group, no cache and literals that vary in green
only take a vectorised way: what the bits at every position would mean, a literal or a whole back-reference, is looked
up at once, the chain of positions is followed by pointer doubling, and back-references are copied in order.
"""

from __future__ import annotations

import functools
import heapq
import struct

import numpy as np

PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
MAX_SIDE = 16384
MAX_COPY = 4096
MAX_BITS = 15
BLACK = np.uint32(0xFF000000)


@functools.cache
def plane_codes() -> tuple[tuple[int, int], ...]:
    """(dx, dy) of the 120 short distance codes: neighbours above or left by Euclidean distance, then |dx|, right of it first."""
    near = [(dx, dy) for dy in range(8) for dx in range(-7, 9) if dy or dx > 0]
    return tuple(sorted(near, key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0)))


# ---------------------------------------------------------------- bits


class BitReader:
    def __init__(self, data: bytes):
        self.data, self.at, self.buffer, self.held, self.read_bits = data, 0, 0, 0, 0

    def need(self, n: int) -> None:
        while self.held < n:
            self.buffer |= int.from_bytes(self.data[self.at : self.at + 8], "little") << self.held
            self.at += 8
            self.held += 64

    def read(self, n: int) -> int:
        if self.held < n:
            self.need(n)
        out = self.buffer & ((1 << n) - 1)
        self.buffer >>= n
        self.held -= n
        self.read_bits += n
        return out

    def skip_to(self, bit: int) -> None:
        self.at, self.buffer, self.held, self.read_bits = bit // 8, 0, 0, bit - bit % 8
        self.read(bit % 8)


class BitWriter:
    def __init__(self) -> None:
        self.value = self.size = 0

    def write(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> bytes:
        """What was written so far and then all values (up to 15 bits each), as bytes; ends the stream."""
        pad = self.size % 8
        head = self.value.to_bytes(self.size // 8 + 1, "little")
        starts = np.cumsum(sizes) - sizes + pad
        total = int(sizes.sum()) + pad
        shifted = values.astype(np.int64) << (starts & 7)
        at, n = starts >> 3, total // 8 + 4
        body = sum(np.bincount(at + k, weights=(shifted >> (8 * k)) & 255, minlength=n) for k in range(3)).astype(np.uint8)
        body[0] |= head[-1]
        return head[:-1] + body[: -(-total // 8)].tobytes()

    def bytes(self) -> bytes:
        return self.value.to_bytes(-(-self.size // 8), "little")


# ---------------------------------------------------------------- prefix codes


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Huffman code lengths of at most `limit` bits; counts are flattened until they fit. A sole symbol gets length 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts).tolist()
    if len(used) < 2:
        return lengths
    weights = [int(counts[s]) for s in used]
    while True:
        parent = [0] * (2 * len(used) - 1)
        heap = [(w, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        for node in range(len(used), 2 * len(used) - 1):
            a, i = heapq.heappop(heap)
            b, k = heap[0]
            parent[i] = parent[k] = node
            heapq.heapreplace(heap, (a + b, node))
        depth = [0] * len(parent)
        for i in range(len(parent) - 2, -1, -1):
            depth[i] = depth[parent[i]] + 1
        if max(depth) <= limit:
            lengths[used] = depth[: len(used)]
            return lengths
        weights = [(w + 3) // 4 + 1 for w in weights]


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol with its first bit lowest."""
    used = np.flatnonzero(lengths)
    out = np.zeros(len(lengths), np.int64)
    order = used[np.argsort(lengths[used], kind="stable")]
    size = lengths[order]
    if not len(order):
        return out
    # Canonical order: the code is the running sum of 2^-length, read as a fraction.
    step = np.int64(1) << (MAX_BITS - size)
    out[order] = mirrored()[np.cumsum(step) - step]
    return out


@functools.cache
def mirrored() -> np.ndarray:
    """Every 15-bit number with its bits in reverse."""
    value, back = np.arange(1 << MAX_BITS), np.zeros(1 << MAX_BITS, np.int64)
    for _ in range(MAX_BITS):
        back = (back << 1) | (value & 1)
        value = value >> 1
    return back


class PrefixCode:
    """A decoding table over the next `bits` bits: symbol and length."""

    def __init__(self, lengths: np.ndarray | None = None, only: int | None = None):
        self.only = only
        self.bits = 0 if only is not None else int(lengths.max())
        self.most = only if only is not None else int(np.flatnonzero(lengths)[-1])
        if only is None:
            used = np.flatnonzero(lengths)
            order = used[np.argsort(lengths[used], kind="stable")]
            room = np.int64(1) << (self.bits - lengths[order])
            if int(room.sum()) != 1 << self.bits:
                raise ValueError("a prefix code is not complete")
            by_code = mirrored()[: 1 << self.bits] >> (MAX_BITS - self.bits)
            self.symbols, self.sizes = np.repeat(order, room)[by_code], np.repeat(lengths[order], room)[by_code]
        self._lists: tuple[list, list] | None = None

    def read(self, r: BitReader) -> int:
        if self.only is not None:
            return self.only
        if self._lists is None:
            self._lists = self.symbols.tolist(), self.sizes.tolist()
        r.need(self.bits)
        at = r.buffer & ((1 << self.bits) - 1)
        n = self._lists[1][at]
        r.buffer >>= n
        r.held -= n
        r.read_bits += n
        return self._lists[0][at]

    @classmethod
    def load(cls, r: BitReader, alphabet: int) -> PrefixCode:
        if r.read(1):  # one or two symbols
            two, wide = r.read(1), r.read(1)
            first = r.read(8 if wide else 1)
            if not two:
                return cls(only=first)
            lengths = np.zeros(max(alphabet, 256), np.int64)
            lengths[[first, r.read(8)]] = 1
            return cls(lengths) if lengths.sum() == 2 else cls(only=first)
        of_lengths = np.zeros(19, np.int64)
        for i in range(4 + r.read(4)):
            of_lengths[LENGTH_ORDER[i]] = r.read(3)
        used = np.flatnonzero(of_lengths)
        reader = cls(only=int(used[0])) if len(used) == 1 else cls(of_lengths)
        left = alphabet
        if r.read(1):
            left = 2 + r.read(2 + 2 * r.read(3))
        out: list[int] = []
        last = 8
        while len(out) < alphabet and left:
            left -= 1
            n = reader.read(r)
            if n < 16:
                out.append(n)
                last = n or last
            elif n == 16:
                out += [last] * (3 + r.read(2))
            else:
                out += [0] * (3 + r.read(3) if n == 17 else 11 + r.read(7))
        if len(out) > alphabet:
            raise ValueError("too many code lengths")
        lengths = np.array(out + [0] * (alphabet - len(out)), np.int64)
        used = np.flatnonzero(lengths)
        if not len(used):
            raise ValueError("an empty prefix code")
        return cls(only=int(used[0])) if len(used) == 1 else cls(lengths)


def write_code(w: BitWriter, lengths: np.ndarray, counts: np.ndarray) -> None:
    """Write a code as the reader expects it; the simple forms where they apply."""
    used = np.flatnonzero(counts).tolist()
    if not used:
        w.write(0b0001, 4)  # simple, one symbol, one bit, symbol 0
        return
    if len(used) <= 2 and used[-1] < 256:
        wide = used[0] > 1
        w.write(1 | (len(used) == 2) << 1 | wide << 2, 3)
        w.write(used[0], 8 if wide else 1)
        if len(used) == 2:
            w.write(used[1], 8)
        return
    coded = lengths.copy()
    if len(used) == 1:
        coded[used[0]] = 1
    tokens: list[tuple[int, int, int]] = []  # code, extra value, extra bits
    edges = np.flatnonzero(np.diff(coded)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(coded)], strict=True):
        n, run = int(coded[a]), b - a
        if n == 0:
            while run >= 3:
                take = min(run, 138)
                tokens.append((17, take - 3, 3) if take <= 10 else (18, take - 11, 7))
                run -= take
        else:
            tokens.append((n, 0, 0))
            run -= 1
            while run >= 3:
                take = min(run, 6)
                tokens.append((16, take - 3, 2))
                run -= take
        tokens += [(n, 0, 0)] * run
    used_lengths = np.bincount([t[0] for t in tokens], minlength=19)
    inner = code_lengths(used_lengths, 7)
    if np.count_nonzero(used_lengths) == 1:
        inner[np.argmax(used_lengths)] = 1
    codes = canonical_codes(inner)
    if np.count_nonzero(used_lengths) == 1:
        shown, inner_size = inner.copy(), np.zeros(19, np.int64)
    else:
        shown = inner_size = inner
    top = max(i for i, s in enumerate(LENGTH_ORDER) if shown[s])
    w.write(0, 1)
    w.write(max(top - 3, 0), 4)
    for s in LENGTH_ORDER[: max(top + 1, 4)]:
        w.write(int(shown[s]), 3)
    w.write(0, 1)
    for code, extra, bits in tokens:
        w.write(int(codes[code]), int(inner_size[code]))
        w.write(extra, bits)


# ---------------------------------------------------------------- decoding


def _chain(data: bytes, start_bit: int, code: PrefixCode, n: int) -> tuple[np.ndarray, int]:
    """n symbols of one code from start_bit on, and the bit after them."""
    if code.only is not None:
        return np.full(n, code.only, np.uint32), start_bit
    first = start_bit // 8
    raw = np.frombuffer(data, np.uint8, offset=first)[: (n * code.bits) // 8 + 3]
    raw = np.concatenate([raw, np.zeros(4, np.uint8)]).astype(np.uint32)
    window = raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16
    at = ((window[:, None] >> np.arange(8, dtype=np.uint32)) & np.uint32((1 << code.bits) - 1)).ravel()
    step = np.minimum(np.arange(len(at), dtype=np.int32) + code.sizes.astype(np.int32)[at], len(at) - 1)
    leap, jumps = 4, [step]
    for _ in range(leap):
        jumps.append(jumps[-1][jumps[-1]])
    wide = jumps[leap].item
    here = [start_bit - 8 * first]
    for _ in range(-(-n // (1 << leap)) - 1):
        here.append(wide(here[-1]))
    places = np.array(here, np.int32)
    for k in range(leap - 1, -1, -1):
        places = np.stack([places, jumps[k][places]], 1).ravel()
    places = places[:n]
    last = int(places[-1])
    return code.symbols.astype(np.uint32)[at[places]], 8 * first + last + int(code.sizes[at[last]])


def _token_chain(data: bytes, start_bit: int, green: PrefixCode, distance: PrefixCode, n: int, width: int) -> tuple[np.ndarray, int]:
    """n green values from literals and back-references of one prefix group, and the bit after them."""
    first = start_bit // 8
    raw = np.concatenate([np.frombuffer(data, np.uint8, offset=first), np.zeros(8, np.uint8)]).astype(np.uint64)
    window = raw[:-7] | raw[1:-6] << np.uint64(8) | raw[2:-5] << np.uint64(16) | raw[3:-4] << np.uint64(24) | raw[4:-3] << np.uint64(32)
    end = 8 * (len(window) - 1)

    def bits(at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        at = np.minimum(at, end)
        return ((window[at >> 3] >> (at & 7).astype(np.uint64)) & ((np.uint64(1) << np.asarray(size, np.uint64)) - np.uint64(1))).astype(np.int64)

    def meant(symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of length or distance symbols whose extra bits begin at `at`, and where these end."""
        extra = np.where(symbol < 4, 0, (symbol - 2) >> 1)
        return np.where(symbol < 4, symbol + 1, ((2 + (symbol & 1)) << extra) + bits(at, extra) + 1), at + extra

    place = ((window[:, None].astype(np.uint32) >> np.arange(8, dtype=np.uint32)) & np.uint32((1 << green.bits) - 1)).ravel()
    symbols = green.symbols[place].astype(np.int32)
    step = green.sizes[place].astype(np.int32)
    copies = np.flatnonzero(symbols >= 256)
    length, at = meant(symbols[copies].astype(np.int64) - 256, copies + step[copies])
    if distance.only is None:
        own = bits(at, distance.bits)
        code, at = meant(distance.symbols[own], at + distance.sizes[own])
    else:
        code, at = meant(np.full(len(copies), distance.only, np.int64), at)
    step[copies] = at - copies
    jumps = [np.minimum(np.arange(len(step), dtype=np.int32) + step, len(step) - 1)]
    for _ in range(4):
        jumps.append(jumps[-1][jumps[-1]])
    wide, here, last = jumps[4].item, [start_bit - 8 * first], len(step) - 1
    for _ in range(-(-n // 16) - 1):
        here.append(wide(here[-1]))
        if here[-1] == last:
            break
    tokens = np.array(here, np.int32)
    for k in range(3, -1, -1):
        tokens = np.stack([tokens, jumps[k][tokens]], 1).ravel()
    found = symbols[tokens]
    is_copy = found >= 256
    of_copy = np.searchsorted(copies, tokens[is_copy])
    sizes = np.ones(len(tokens), np.int64)
    sizes[is_copy] = length[of_copy]
    ends = np.cumsum(sizes)
    count = int(np.searchsorted(ends, n)) + 1
    if count > len(tokens) or ends[count - 1] != n:
        raise ValueError("a back-reference leaves the image")
    starts = (ends - sizes)[:count]
    out = np.zeros(n, np.uint32)
    literal = ~is_copy[:count]
    out[starts[literal]] = found[:count][literal]
    planes = plane_codes()
    chosen = of_copy[: int(is_copy[:count].sum())]
    for to, size, c in zip(starts[~literal].tolist(), length[chosen].tolist(), code[chosen].tolist(), strict=True):
        back = c - 120 if c > 120 else max(1, planes[c - 1][0] + planes[c - 1][1] * width)
        if back > to:
            raise ValueError("a back-reference leaves the image")
        out[to : to + size] = out[to - back : to - back + size] if back >= size else np.resize(out[to - back : to], size)
    final = int(tokens[count - 1])
    return out, 8 * first + final + int(step[final])


def _value(r: BitReader, symbol: int) -> int:
    """Of a length or distance symbol and its extra bits."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + r.read(extra) + 1


def _pixels(r: BitReader, width: int, height: int, main: bool) -> np.ndarray:
    """An entropy-coded image: cache, meta codes (of the main image only), prefix codes, pixels."""
    n = width * height
    cache_bits = r.read(4) if r.read(1) else 0
    if cache_bits > 11:
        raise ValueError("a colour cache is too large")
    groups, block, group_of = 1, 0, None
    if main and r.read(1):
        block = r.read(3) + 2
        across = -(-width >> block)
        group_of = ((_pixels(r, across, -(-height >> block), False) >> np.uint32(8)) & np.uint32(0xFFFF)).tolist()
        groups = max(group_of) + 1
    sizes = (256 + 24 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    codes = [[PrefixCode.load(r, s) for s in sizes] for _ in range(groups)]
    if groups == 1 and not cache_bits and all(c.only is not None for c in codes[0][1:4]) and (codes[0][0].only is None or codes[0][0].only < 256):
        green, red, blue, alpha, distance = codes[0]
        symbols, end = _chain(r.data, r.read_bits, green, n) if green.most < 256 else _token_chain(r.data, r.read_bits, green, distance, n, width)
        r.skip_to(end)
        return symbols << np.uint32(8) | np.uint32(red.only << 16 | blue.only | alpha.only << 24)
    out = [0] * n
    cache = [0] * (1 << cache_bits)
    planes = plane_codes()
    i = 0
    while i < n:
        if group_of is None:
            own = codes[0]
        else:
            own = codes[group_of[(i // width >> block) * across + (i % width >> block)]]
        s = own[0].read(r)
        if s < 256:
            red = own[1].read(r)
            blue = own[2].read(r)
            run = [own[3].read(r) << 24 | red << 16 | s << 8 | blue]
            out[i] = run[0]
        elif s < 280:
            length = _value(r, s - 256)
            code = _value(r, own[4].read(r))
            if code > 120:
                back = code - 120
            else:
                dx, dy = planes[code - 1]
                back = max(1, dx + dy * width)
            if back > i or i + length > n:
                raise ValueError("a back-reference leaves the image")
            run = []
            for k in range(i, i + length):
                out[k] = out[k - back]
            run = out[i : i + length]
        else:
            run = [cache[s - 280]]
            out[i] = run[0]
        if cache_bits:
            for p in run:
                cache[((0x1E35A7BD * p) & 0xFFFFFFFF) >> (32 - cache_bits)] = p
        i += len(run)
    return np.array(out, np.uint32)


def _parts(p: np.ndarray) -> list[np.ndarray]:
    """Alpha, red, green, blue as int32."""
    return [((p >> np.uint32(s)) & np.uint32(255)).astype(np.int32) for s in (24, 16, 8, 0)]


def _packed(a: np.ndarray, r: np.ndarray, g: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint32) & 255) << np.uint32(24) | (r.astype(np.uint32) & 255) << np.uint32(16) | (g.astype(np.uint32) & 255) << np.uint32(8) | (b.astype(np.uint32) & 255)


def _add(p: np.ndarray, q: np.ndarray, sign: int = 1) -> np.ndarray:
    return _packed(*(x + sign * y for x, y in zip(_parts(np.asarray(p, np.uint32)), _parts(np.asarray(q, np.uint32)), strict=True)))


def predict(mode: int, left: int, top: int, top_right: int, top_left: int) -> int:
    """What predictor `mode` makes of the neighbours, each ARGB."""
    average = lambda x, y: (((x ^ y) & 0xFEFEFEFE) >> 1) + (x & y)
    split = lambda x: [(x >> s) & 255 for s in (24, 16, 8, 0)]
    join = lambda c: c[0] << 24 | c[1] << 16 | c[2] << 8 | c[3]
    clamp = lambda x: max(0, min(255, x))
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(split(top), split(top_left), strict=True))
        to_top = sum(abs(x - c) for x, c in zip(split(left), split(top_left), strict=True))
        return left if to_left < to_top else top
    if mode == 12:
        return join([clamp(x + t - c) for x, t, c in zip(split(left), split(top), split(top_left), strict=True)])
    if mode == 13:
        return join([clamp(m + int((m - c) / 2)) for m, c in zip(split(average(left, top)), split(top_left), strict=True)])
    return {
        1: left, 2: top, 3: top_right, 4: top_left, 5: average(average(left, top_right), top), 6: average(left, top_left), 7: average(left, top),
        8: average(top_left, top), 9: average(top, top_right), 10: average(average(left, top_left), average(top, top_right)),
    }.get(mode, int(BLACK))


def _predicted(out: list[int], x: int, y: int, width: int, modes: list[int], block: int, across: int) -> int:
    i = y * width + x
    if not i:
        return int(BLACK)
    if not y:
        return out[i - 1]
    if not x:
        return out[i - width]
    mode = (modes[(y >> block) * across + (x >> block)] >> 8) & 15
    return predict(mode, out[i - 1], out[i - width], out[i - width + 1], out[i - width - 1])


def _invert_predictor(p: np.ndarray, width: int, height: int, block: int, modes: np.ndarray) -> np.ndarray:
    across, out, rest, by = -(-width >> block), [0] * len(p), p.tolist(), modes.tolist()
    for y in range(height):
        for x in range(width):
            i = y * width + x
            q, d = _predicted(out, x, y, width, by, block, across), rest[i]
            # Bytes add without carry into each other.
            out[i] = (((q & 0xFF00FF00) + (d & 0xFF00FF00)) & 0xFF00FF00) | (((q & 0x00FF00FF) + (d & 0x00FF00FF)) & 0x00FF00FF)
    return np.array(out, np.uint32)


def _spread(small: np.ndarray, width: int, height: int, block: int) -> np.ndarray:
    """A block image's value at each pixel."""
    across = -(-width >> block)
    y, x = np.divmod(np.arange(width * height), width)
    return small[(y >> block) * across + (x >> block)]


def _signed(x: np.ndarray) -> np.ndarray:
    return ((x & 255) ^ 128) - 128


def _cross(p: np.ndarray, elements: np.ndarray, forward: bool) -> np.ndarray:
    """Apply or invert the cross-colour transform; elements are spread to pixels."""
    a, r, g, b = _parts(p)
    _, red_blue, green_blue, green_red = map(_signed, _parts(elements))
    delta = lambda t, c: (t * _signed(c)) >> 5
    sign = -1 if forward else 1
    red = (r + sign * delta(green_red, g)) & 255
    blue = b + sign * (delta(green_blue, g) + delta(red_blue, r if forward else red))
    return _packed(a, red, g, blue)


def decode_vp8l(data: bytes) -> tuple[np.ndarray, int, int]:
    """Pixels (ARGB, height x width) of a VP8L stream."""
    r = BitReader(data)
    if r.read(8) != 0x2F:
        raise ValueError("not a VP8L stream")
    width, height = r.read(14) + 1, r.read(14) + 1
    r.read(1)
    if r.read(3):
        raise ValueError("an unknown version")
    steps, across, seen = [], width, set()
    while r.read(1):
        kind = r.read(2)
        if kind in seen:
            raise ValueError("a transform occurs twice")
        seen.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = r.read(3) + 2
            steps.append((kind, across, block, _pixels(r, -(-across >> block), -(-height >> block), False)))
        elif kind == PALETTE:
            n = r.read(8) + 1
            table = _pixels(r, n, 1, False)
            channels = [np.cumsum(c) for c in _parts(table)]
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            steps.append((kind, across, pack, _packed(*channels)))
            across = -(-across >> pack)
        else:
            steps.append((kind, across, 0, None))
    p = _pixels(r, across, height, True)
    for kind, w, x, image in reversed(steps):
        if kind == PREDICTOR:
            p = _invert_predictor(p, w, height, x, image)
        elif kind == CROSS_COLOUR:
            p = _cross(p, _spread(image, w, height, x), False)
        elif kind == SUBTRACT_GREEN:
            g = (p >> np.uint32(8)) & np.uint32(255)
            p = (p & np.uint32(0xFF00FF00)) | (((p & np.uint32(0xFF00FF)) + (g << np.uint32(16) | g)) & np.uint32(0xFF00FF))
        else:
            table = np.zeros(256, np.uint32)
            table[: len(image)] = image
            index = ((p >> np.uint32(8)) & np.uint32(255)).reshape(height, -1)
            if x:
                bits = 8 >> x
                index = ((index[:, :, None] >> (np.arange(1 << x, dtype=np.uint32) * np.uint32(bits))) & np.uint32((1 << bits) - 1)).reshape(height, -1)[:, :w]
            p = table[index].ravel()
    return p.reshape(height, width), width, height


def decode(data: bytes) -> np.ndarray:
    """Pixels (ARGB, height x width) of a lossless WebP file."""
    return decode_at(data, 0)[0]


def decode_at(data: bytes, at: int) -> tuple[np.ndarray, int]:
    """The file that begins at `at`, and where it ends."""
    if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 12] != b"WEBP":
        raise ValueError("not a WebP file")
    end, here = at + 8 + struct.unpack_from("<I", data, at + 4)[0], at + 12
    while here + 8 <= end:
        name, size = data[here : here + 4], struct.unpack_from("<I", data, here + 4)[0]
        if name == b"VP8L":
            return decode_vp8l(data[here + 8 : here + 8 + size])[0], end
        here += 8 + size + size % 2
    raise ValueError("no lossless image in the file")


# ---------------------------------------------------------------- encoding


def _split_value(v: int) -> tuple[int, int, int]:
    """Symbol, extra value and extra bits of a length or distance."""
    v -= 1
    if v < 4:
        return v, 0, 0
    top = v.bit_length() - 1
    half = (v >> (top - 1)) & 1
    return 2 * top + half, v & ((1 << (top - 1)) - 1), top - 1


def _references(p: list[int], width: int) -> list[tuple[int, int]]:
    """Greedy matches of 4 pixels and more: (length, distance), or (0, pixel) for a literal."""
    out, seen, i, n = [], {}, 0, len(p)
    while i < n:
        key = tuple(p[i : i + 4])
        back, length = i - seen[key] if key in seen and len(key) == 4 else 0, 0
        if back:
            while i + length < n and length < 4096 and p[i + length] == p[i + length - back]:
                length += 1
        if length >= 4:
            out.append((length, back))
        else:
            out.append((0, p[i]))
            length = 1
        for k in range(i, i + length):
            seen[tuple(p[k : k + 4])] = k
        i += length
    return out


def long_matches(data: np.ndarray, least: int = 16, worth: int = 48) -> list[tuple[int, int, int]]:
    """(start, length, distance) of stretches of `least` bytes or more that repeat earlier ones, in order, without overlap;
    none if they save less than `worth` bytes together, as the codes of references take room too.

    Every window of eight bytes looks up its last occurrence; windows in a row at one distance are one stretch.
    """
    n = len(data) - 7
    if n <= least:
        return []
    keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    # 40 bits of a window's hash, then its place: one sort of plain numbers brings like windows together in order.
    place = np.uint64(24)
    order = np.sort((keys * np.uint64(0x9E3779B97F4A7C15)) >> place << place | np.arange(n, dtype=np.uint64))
    alike = np.flatnonzero(order[1:] >> place == order[:-1] >> place)
    if len(alike) < least - 7:
        return []
    order = (order & np.uint64((1 << 24) - 1)).astype(np.int64)
    later, earlier = order[alike + 1], order[alike]
    same = keys[later] == keys[earlier]
    distance = np.zeros(n, np.int64)
    distance[later[same]] = (later - earlier)[same]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(distance)) + 1, [n]])
    out, free = [], 0
    long = np.flatnonzero((distance[edges[:-1]] > 0) & (np.diff(edges) + 7 >= least))
    for a, b, d in zip(edges[long].tolist(), edges[long + 1].tolist(), distance[edges[long]].tolist(), strict=True):
        a, b = max(a, free), b + 7
        while b - a >= least:
            size = min(b - a, MAX_COPY)
            out.append((a, size, d))
            a += size
            free = a
    return out if sum(m[1] for m in out) >= worth else []


def _write_matches(w: BitWriter, p: np.ndarray, green: np.ndarray, matches: list[tuple[int, int, int]]) -> bytes:
    """End the stream with an image of one group whose literals vary in green only, and whose `matches` are back-references."""
    covered = np.zeros(len(green) + 1, np.int64)
    starts = np.array([m[0] for m in matches])
    covered[starts] += 1
    covered[starts + np.array([m[1] for m in matches])] -= 1
    at = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    lengths, distances = ([_split_value(v) for v in vs] for vs in ([m[1] for m in matches], [m[2] + 120 for m in matches]))
    counts = np.bincount(green[at], minlength=280) + np.bincount([256 + x[0] for x in lengths], minlength=280)
    far = np.bincount([x[0] for x in distances], minlength=40)
    sizes, far_sizes = code_lengths(counts, 12), code_lengths(far, 12)
    codes, far_codes = canonical_codes(sizes), canonical_codes(far_sizes)
    write_code(w, sizes, counts)
    for s in (16, 0, 24):
        w.write(0b101 | (int(p[0] >> np.uint32(s)) & 255) << 3, 11)
    write_code(w, far_sizes, far)
    # Each back-reference is five pieces of up to 15 bits; pieces and literals go out by their place.
    pieces = [
        (int(codes[256 + s]), int(sizes[256 + s]), extra, n, int(far_codes[t]), int(far_sizes[t]), far_extra & 0x3FFF, min(m, 14), far_extra >> 14, max(m - 14, 0))
        for (s, extra, n), (t, far_extra, m) in zip(lengths, distances, strict=True)
    ]
    grid = np.array(pieces, np.int64).reshape(-1, 5, 2)
    places = np.concatenate([at, np.repeat(starts, 5)])
    values = np.concatenate([codes[green[at]], grid[:, :, 0].ravel()])
    widths = np.concatenate([sizes[green[at]], grid[:, :, 1].ravel()])
    order = np.argsort(places, kind="stable")
    return w.extend(values[order], widths[order])


def _write_pixels(w: BitWriter, p: np.ndarray, width: int, main: bool, references: bool = False, cache_bits: int = 0, groups: np.ndarray | None = None, block: int = 2, repeats: bool = False) -> bytes | None:
    """Write an entropy-coded image. A plain one with literals in green only ends the stream and returns its bytes."""
    w.write(bool(cache_bits) | cache_bits << 1, 5 if cache_bits else 1)
    if main:
        w.write(groups is not None, 1)
        if groups is not None:
            w.write(block - 2, 3)
            _write_pixels(w, groups.ravel().astype(np.uint32) << np.uint32(8), -(-width >> block), False)
    height, n_groups = len(p) // width, 1 if groups is None else int(groups.max()) + 1
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    if main and groups is None and not references and not cache_bits and not np.any((p ^ p[0]) & np.uint32(0xFFFF00FF)):
        green = ((p >> np.uint32(8)) & np.uint32(255)).astype(np.uint8)
        matches = long_matches(green) if repeats else []
        if matches:
            return _write_matches(w, p, green, matches)
        counts = np.bincount(green, minlength=280)
        lengths = code_lengths(counts, 12)  # small tables decode faster
        write_code(w, lengths, counts)
        for s in (16, 0, 24):
            w.write(0b101 | (int(p[0] >> np.uint32(s)) & 255) << 3, 11)  # one symbol, in eight bits
        w.write(0b0001, 4)
        return w.extend(canonical_codes(lengths)[green], lengths[green])
    across = -(-width >> block)
    spread = np.zeros(len(p), np.int64) if groups is None else _spread(groups.ravel(), width, height, block)
    steps = _references(p.tolist(), width) if references else [(0, x) for x in p.tolist()]
    planes = {max(1, dx + dy * width): k + 1 for k, (dx, dy) in reversed(list(enumerate(plane_codes())))}
    written: list[tuple[int, int, int, int, int]] = []  # group, alphabet, symbol, extra, bits
    cache, i = [0] * (1 << cache_bits), 0
    slot = lambda x: ((0x1E35A7BD * x) & 0xFFFFFFFF) >> (32 - cache_bits)
    pixels = p.tolist()
    for length, x in steps:
        g = int(spread[i])
        if length:
            s, extra, bits = _split_value(length)
            written.append((g, 0, 256 + s, extra, bits))
            written.append((g, 4, *_split_value(planes.get(x, x + 120))))
        elif cache_bits and cache[slot(x)] == x:
            written.append((g, 0, 280 + slot(x), 0, 0))
        else:
            written += [(g, k, (x >> s) & 255, 0, 0) for k, s in enumerate((8, 16, 0, 24))]
        for k in range(i, i + max(length, 1)):
            if cache_bits:
                cache[slot(pixels[k])] = pixels[k]
        i += max(length, 1)
    counts = [[np.zeros(s, np.int64) for s in sizes] for _ in range(n_groups)]
    for g, k, s, _, _ in written:
        counts[g][k][s] += 1
    lengths = [[code_lengths(c) for c in own] for own in counts]
    codes = [[canonical_codes(x) for x in own] for own in lengths]
    for own, c in zip(lengths, counts, strict=True):
        for x, y in zip(own, c, strict=True):
            write_code(w, x, y)
    for g, k, s, extra, bits in written:
        w.write(int(codes[g][k][s]), int(lengths[g][k][s]))
        w.write(extra, bits)
    return None


def encode(pixels: np.ndarray, predictor: np.ndarray | None = None, cross_colour: np.ndarray | None = None, subtract_green: bool = False, palette: bool = False, references: bool = False, cache_bits: int = 0, groups: np.ndarray | None = None, block: int = 2, repeats: bool = False) -> bytes:
    """A lossless WebP file of ARGB pixels (height x width).

    predictor: modes by block; cross_colour: ARGB elements by block; groups: prefix groups by block; references: greedy
    back-references from 4 pixels on; repeats: long ones, where only green varies. Transforms are applied in the order
    palette, predictor, cross-colour, subtract-green.
    """
    height, width = pixels.shape
    p, across = pixels.astype(np.uint32).ravel(), width
    w = BitWriter()
    w.write(0x2F, 8)
    w.write(width - 1 | (height - 1) << 14, 28)
    w.write(int(np.any(p >> np.uint32(24) != 255)), 4)
    if palette:
        table, index = np.unique(p, return_inverse=True)
        if len(table) > 256:
            raise ValueError("too many colours for a palette")
        w.write(1 | PALETTE << 1, 3)
        w.write(len(table) - 1, 8)
        _write_pixels(w, np.concatenate([table[:1], _add(table[1:], table[:-1], -1)]), len(table), False)
        pack = 3 if len(table) <= 2 else 2 if len(table) <= 4 else 1 if len(table) <= 16 else 0
        across = -(-width >> pack)
        grid = np.zeros((height, across << pack), np.uint32)
        grid[:, :width] = index.reshape(height, width)
        bits = 8 >> pack
        packed = (grid.reshape(height, across, 1 << pack) << (np.arange(1 << pack, dtype=np.uint32) * np.uint32(bits))).sum(2).astype(np.uint32)
        p = (packed.ravel() << np.uint32(8)) | BLACK
    if predictor is not None:
        w.write(1 | PREDICTOR << 1 | (block - 2) << 3, 6)
        modes = (predictor.astype(np.uint32).ravel() << np.uint32(8)) | BLACK
        _write_pixels(w, modes, -(-across >> block), False)
        by, full = modes.tolist(), p.tolist()
        guess = np.array([_predicted(full, x, y, across, by, block, -(-across >> block)) for y in range(height) for x in range(across)], np.uint32)
        p = _add(p, guess, -1)
    if cross_colour is not None:
        w.write(1 | CROSS_COLOUR << 1 | (block - 2) << 3, 6)
        _write_pixels(w, cross_colour.astype(np.uint32).ravel(), -(-across >> block), False)
        p = _cross(p, _spread(cross_colour.astype(np.uint32).ravel(), across, height, block), True)
    if subtract_green:
        w.write(1 | SUBTRACT_GREEN << 1, 3)
        g = (p >> np.uint32(8)) & np.uint32(255)
        p = (p & np.uint32(0xFF00FF00)) | (((p | np.uint32(0xFF00FF00)) - (g << np.uint32(16) | g)) & np.uint32(0xFF00FF))
    w.write(0, 1)
    data = _write_pixels(w, p, across, True, references, cache_bits, groups, block, repeats) or w.bytes()
    chunk = b"VP8L" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk
