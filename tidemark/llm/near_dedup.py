"""Near-duplicate groups by MinHash banding and odd sketches, with exact confirmation.

1. One pass over the texts gives, per document, the number of distinct shingles, a fingerprint of the whole set, the
   band keys of 128 MinHash samples (32 bands of 4: a pair at similarity 0.8 shares a band but for a chance of
   5e-8), and an odd sketch: each sample flips one of 512 bits, so the XOR of two sketches counts the samples in
   which two documents differ, which is precise where similarities are high.
2. Equal fingerprints are one class; only its representative (smallest id) goes on, under a number of its own.
3. Representatives that share a band key are a bucket's members. No step lists a bucket's pairs. First, every member
   takes its text to the largest of its buckets, once; a task holds a block of a bucket, cut by bytes of sets, with a
   few hubs that all blocks of the bucket share. Sketches screen the pairs there, full shingle sets confirm them, a
   union-find skips pairs that are connected by then, and only spanning links leave the task: fewer than its members.
4. Buckets that still hold several groups are gone through whole: every block of members outside a bucket's largest
   group meets every block of its members, first with sketches alone, which names the members that keep a candidate,
   then with the texts of those members, confirmed as above. A pair that shares several bands is looked at in the
   first of them. Links inside one group need no proof.
5. A sketch only ever discards pairs whose estimate lies more than five standard errors below the threshold. All
   others are confirmed by intersecting whole sets.

Nothing about all documents reaches the driver; tables between steps are written to the shared folder, and those that
the result does not read are deleted.

Defined results: null and empty texts, and texts of white space, have no shingles and stay alone; ids are meant to be
unique, but rows that share an id keep links of their own; rows with a null id stay alone with a null component and
are kept; texts with fewer words than a shingle have their whole sequence as the only shingle; an empty table gives an
empty result; further columns are ignored. Texts are processed whole.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, map_texts, released, shipped, slices, written
from .components import contract
from .hashing import mix64, shingle_sets

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Standard errors that a sketch's estimate may lie below the threshold.
SLACK = 5.0
#: Bytes of shingle sets in a block that is confirmed, and members of a block whose sketches alone are compared.
BLOCK_BYTES, BLOCK = 8 << 20, 16_384
#: About so many members of a bucket of several blocks go to all of them, to link the blocks' groups.
HUBS = 8
#: Candidates of one member confirmed at a time, nearest first; doubles while they do not settle it.
FIRST = 4


@functools.cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return draw.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, SAMPLES, dtype=np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """SAMPLES minima of 32-bit hashes."""
    a, b = _permutations()
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 4096):  # bounded memory for very long texts
        out = np.minimum(out, ((shingles[i : i + 4096, None] * a + b) >> np.uint64(32)).min(0))
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    grid = samples.reshape(BANDS, ROWS)
    key = mix64(np.arange(BANDS, dtype=np.uint64), 404)
    for k in range(ROWS):
        key = mix64(key ^ grid[:, k], 405 + k)
    return key.astype(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of the samples, each with its number, over SKETCH_BITS cells."""
    cells = mix64(samples ^ mix64(np.arange(SAMPLES, dtype=np.uint64), 500), 501) % np.uint64(SKETCH_BITS)
    return np.packbits((np.bincount(cells.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def estimate(differing_bits: np.ndarray) -> np.ndarray:
    """Similarity from the population count of two sketches' XOR."""
    share = np.minimum(2 * differing_bits / SKETCH_BITS, 1 - 1 / SKETCH_BITS)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(1 - share)


def most_bits(threshold: float) -> int:
    """The most bits in which two sketches may differ to stay candidates."""
    error = np.sqrt(threshold * (1 - threshold) / SAMPLES) + 1 / np.sqrt(SKETCH_BITS * SAMPLES)
    kept = estimate(np.arange(SKETCH_BITS + 1)) >= threshold - SLACK * error
    return int(np.flatnonzero(kept)[-1])


def sketch(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text_hash, n, fp1, fp2, bands, odd (null for empty sets)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, fp1, fp2, bands, odd = [], [], [], [], []
        for s in shingle_sets([t or "" for t in batch.column(1).to_pylist()], words):
            samples = minhash(s) if len(s) else None
            n.append(len(s))
            fp1.append(int(mix64(s, 601).sum(dtype=np.uint64).astype(np.int64)))
            fp2.append(int(np.bitwise_xor.reduce(mix64(s, 602)).astype(np.int64)) if len(s) else 0)
            bands.append(None if samples is None else band_keys(samples))
            odd.append(None if samples is None else odd_sketch(samples))
        columns = [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "n", "fp1", "fp2", "bands", "odd"])

    rows = docs.select(id_col, text_col, F.xxhash64(text_col).alias("text_hash"))
    return map_texts(rows, run, f"id {id_type}, text_hash long, n long, fp1 long, fp2 long, bands array<long>, odd array<long>")


class Members:
    """Members of one task's block: node, group, n, odd (uint64 words), and where needed bands, few and sets."""

    def __init__(self, rows: pa.Table, sets: list[np.ndarray] | None = None, at: np.ndarray | None = None):
        if at is not None:
            rows, sets = rows.take(pa.array(at)), None if sets is None else [sets[i] for i in at]
        words = lambda c, n: rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, n)
        self.node, self.n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
        self.group = rows.column("g").to_numpy() if "g" in rows.column_names else self.node
        self.odd = words("odd", SKETCH_BITS // 64).view(np.uint64)
        self.bands = words("bands", BANDS) if "bands" in rows.column_names else None
        self.few = rows.column("few").to_numpy() if "few" in rows.column_names else None
        self.sets = sets


def _candidates(one: Members, i: int, two: Members, at: np.ndarray, key: int | None, most: int, percent: int) -> np.ndarray:
    """Of the members `at` of two, those that sizes and sketches leave possible for member i of one, nearest first.

    With a key, a pair counts only in the first band that it shares, and a pair of two few members from one side only.
    """
    at = at[100 * np.minimum(one.n[i], two.n[at]) >= percent * np.maximum(one.n[i], two.n[at])]
    bits = np.bitwise_count(one.odd[i] ^ two.odd[at]).sum(1, dtype=np.int64)
    near = bits <= most
    at, bits = at[near], bits[near]
    if key is not None and len(at):
        first = two.bands[at, (two.bands[at] == one.bands[i]).argmax(1)] == key
        first &= ~two.few[at] | (one.node[i] < two.node[at])
        at, bits = at[first], bits[first]
    return at[np.argsort(bits, kind="stable")]


def _spanning(one: Members, two: Members | None, key: int | None, most: int, percent: int) -> list[tuple[int, int]]:
    """Confirmed links (group, smaller group) that connect what members of one and two (or of one alone) connect."""
    two, alone = (one, True) if two is None else (two, False)
    groups, label = np.unique(np.concatenate([one.group, two.group]), return_inverse=True)
    mine, theirs = label[: len(one.node)], label[len(one.node) :]
    root = np.arange(len(groups))
    for i, own in enumerate(one.sets):
        others = theirs[:i] if alone else theirs
        at = np.flatnonzero(root[others] != root[mine[i]])
        if not len(at):
            continue
        at, step = _candidates(one, i, two, at, key, most, percent), FIRST
        while len(at):
            now = at[:step]
            lengths = np.fromiter((len(two.sets[j]) for j in now), np.int64, len(now))
            theirs_all = np.concatenate([two.sets[j] for j in now])
            hit = own[np.minimum(np.searchsorted(own, theirs_all), len(own) - 1)] == theirs_all
            common = np.add.reduceat(hit, np.cumsum(lengths) - lengths, dtype=np.int64)
            for j in now[100 * common >= percent * (len(own) + lengths - common)]:
                x, y = sorted((root[mine[i]], root[theirs[j]]))
                if x != y:
                    root[root == y] = x
            at = at[step:]
            at, step = at[root[theirs[at]] != root[mine[i]]], 2 * step
    moved = np.flatnonzero(root != np.arange(len(groups)))
    return list(zip(groups[moved].tolist(), groups[root[moved]].tolist(), strict=True))


def _by_block(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], prepare: Callable, work: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by `keys`: gathers each block's rows over batches and gives them to `work`, whose tuples are the result.

    `prepare` turns a bounded batch into (table, list) pairs: the rows without text, and a list of one item a row or None.
    """
    parts: list[tuple[pa.Table, list | None]] = []
    last = None

    def block() -> list[tuple]:
        rows = pa.concat_tables([t for t, _ in parts])
        items = None if parts[0][1] is None else [x for _, xs in parts for x in xs]
        return work(rows, items)

    for batch in batches:
        found: list[tuple] = []
        for rows, items in prepare(batch):
            columns = [rows.column(k).to_numpy() for k in keys]
            change = np.zeros(rows.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), rows.num_rows]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if a == b:
                    continue
                now = tuple(c[a] for c in columns)
                if parts and now != last:
                    found += block()
                    parts = []
                last = now
                parts.append((rows.slice(a, b - a), None if items is None else items[a:b]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
    if parts and (found := block()):
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
    released()


def _blocked(rows: DataFrame, keys: tuple[str, ...], work: Callable, names: tuple[str, str], words: int | None) -> DataFrame:
    """Rows dealt and sorted by their block, each block given to `work`; texts come as sets of shingles of `words` words."""
    shipped(rows.sparkSession)
    schema = pa.schema([(n, pa.int64()) for n in names])

    def prepare(batch: pa.RecordBatch) -> Iterator[tuple[pa.Table, list | None]]:
        if words is None:
            yield pa.Table.from_batches([batch]), None
            return
        at = batch.schema.get_field_index("text")
        for part in slices(batch, at):
            sets = shingle_sets([t or "" for t in part.column(at).to_pylist()], words)
            yield pa.Table.from_batches([part]).drop_columns(["text"]), sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_block(batches, keys, prepare, work, schema)

    dealt = rows.repartition(*map(F.col, keys)).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, f"{names[0]} long, {names[1]} long")


def _blocks_of(size: Column, limit: int) -> Column:
    return F.greatest(F.ceil(size / limit), F.lit(1)).cast("int")


def _crossed(rows: DataFrame) -> DataFrame:
    """Each few member (asks) with every block of its bucket's members, and each member with every block of few ones: x, y."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    roles = F.array(F.struct(F.lit(True).alias("asks")), F.struct(F.lit(False).alias("asks")))
    rows = rows.withColumn("role", F.explode(F.when(F.col("few"), roles).otherwise(F.slice(roles, 2, 1))))
    rows = rows.select("*", F.col("role.asks").alias("asks"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    x, y = F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")), F.when(F.col("asks"), F.col("other")).otherwise(F.col("own"))
    return rows.withColumns({"x": x, "y": y}).drop("role", "own", "other", "blocks")


def _with_texts(rows: DataFrame, own: DataFrame) -> DataFrame:
    """Rows of (id, text_hash, ...) with their texts; equal rows of the input come once."""
    texts = own.select("id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.join(texts, ["id", "text_hash"]).dropDuplicates(["id", "text_hash", "node"] + (["key"] if "few" in rows.columns else [])).drop("id", "text_hash")


def first_links(members: DataFrame, classes: DataFrame, own: DataFrame, words: int, percent: int, most: int) -> DataFrame:
    """Links found when each member goes to the largest of its buckets only; (a, b), nodes."""
    order = F.col("size") * (1 << 32) + F.pmod(F.col("key"), F.lit(1 << 32))
    best = members.groupBy("node").agg(F.max_by("key", order).alias("key"))
    placed = written(classes.select("node", "id", "text_hash", "n", "odd").join(best, "node"), "placed")
    bins = placed.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.col("n") * 8).alias("bytes")).filter("size > 1")
    rows = placed.join(bins, "key").withColumn("blocks", _blocks_of(F.col("bytes"), BLOCK_BYTES))
    hub = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit("hub")), F.col("size")) < HUBS)
    mine = F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("at", F.when(hub, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(mine)).drop("size", "bytes", "blocks")
    rows = _with_texts(rows, own).withColumn("block", F.explode("at")).drop("at")

    def work(rows: pa.Table, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        return _spanning(Members(rows, sets), None, None, most, percent) if rows.num_rows > 1 else []

    links = written(_blocked(rows, ("key", "block"), work, ("a", "b"), words), "links")
    discard(placed)
    return links


def _split(members: DataFrame, groups: DataFrame | None, classes: DataFrame) -> DataFrame:
    """Members of buckets that several groups share: key, size, node, g, few (not of the bucket's largest group), and their class."""
    if groups is None:
        placed = members.select("key", "size", "node", F.col("node").alias("g"))
    else:
        placed = members.join(groups, "node", "left").select("key", "size", "node", F.coalesce("root", "node").alias("g"))
    placed = written(placed, "placed")
    sizes = placed.groupBy("key", "g").count()
    mixed = sizes.groupBy("key").agg(F.max(F.struct("count", "g")).alias("top"), F.count("*").alias("groups")).filter("groups > 1").select("key", F.col("top.g").alias("main"))
    split = placed.join(mixed, "key").withColumn("few", F.col("g") != F.col("main")).drop("main")
    out = written(split.join(classes.select("node", "id", "text_hash", "n", "odd", "bands"), "node"), "split")
    discard(placed)
    return out


def last_links(split: DataFrame, own: DataFrame, words: int, percent: int, most: int) -> DataFrame:
    """Links (a, b) between groups that buckets still hold apart: all their pairs, screened and then confirmed."""
    keys = ("key", "x", "y")

    def sides(rows: pa.Table, sets: list[np.ndarray] | None) -> tuple[Members, Members, int]:
        asks = rows.column("asks").to_numpy()
        return Members(rows, sets, np.flatnonzero(asks)), Members(rows, sets, np.flatnonzero(~asks)), rows.column("key")[0].as_py()

    def screen(rows: pa.Table, _: None) -> list[tuple[int, int]]:
        one, two, key = sides(rows, None)
        kept: set[int] = set()
        for i in range(len(one.node)):
            at = _candidates(one, i, two, np.flatnonzero(two.group != one.group[i]), key, most, percent)
            if len(at):
                kept.add(int(one.node[i]))
                kept.update(two.node[at].tolist())
        return [(key, x) for x in sorted(kept)]

    def confirm(rows: pa.Table, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        one, two, key = sides(rows, sets)
        return _spanning(one, two, key, most, percent) if len(one.node) and len(two.node) else []

    alike = _crossed(split.select("key", "node", "g", "few", "n", "odd", "bands", _blocks_of(F.col("size"), BLOCK).alias("blocks")))
    kept = written(_blocked(alike, keys, screen, ("key", "node"), None).distinct(), "kept")
    rows = split.drop("size").join(kept, ["key", "node"])
    blocks = rows.groupBy("key").agg(F.sum(F.col("n") * 8).alias("bytes")).select("key", _blocks_of(F.col("bytes"), BLOCK_BYTES).alias("blocks"))
    rows = written(rows.join(blocks, "key"), "rows")
    links = written(_blocked(_crossed(_with_texts(rows, own)), keys, confirm, ("a", "b"), words), "links")
    discard(kept, rows)
    return links


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable), kept (doc_id is that id)."""
    most = most_bits(percent / 100)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = written(sketch(own, words, "id"), "sketches")
    some = rows.filter("id IS NOT NULL AND n > 0")
    # Classes of equal sets; the smallest id carries its class's bands and sketch on, under a number of its own.
    classes = some.groupBy("fp1", "fp2", "n").agg(F.min(F.struct("id", "text_hash", "bands", "odd")).alias("top"))
    classes = written(classes.select("fp1", "fp2", "n", "top.*").withColumn("node", F.monotonically_increasing_id()), "classes")
    keys = classes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = written(keys.join(shared, "key"), "members")
    links = first_links(members, classes, own, words, percent, most)
    groups = contract(links)
    split = _split(members, groups, classes)
    more = last_links(split, own, words, percent, most)
    wider = contract(more)
    # Groups of nodes, and the smallest id of each; a node that no link reaches is its own group.
    roots = classes.select("fp1", "fp2", "n", "id", F.col("node").alias("root"))
    for found in (groups, wider):
        if found is not None:
            up = found.select(F.col("node").alias("root"), F.col("root").alias("above"))
            roots = roots.join(up, "root", "left").withColumn("root", F.coalesce("above", "root")).drop("above")
    roots = written(roots, "roots")
    smallest = roots.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("classes")).filter("classes > 1").drop("classes")
    found = written(roots.join(smallest, "root", "left").select("fp1", "fp2", "n", F.coalesce("component_id", "id").alias("component_id")), "components")
    discard(members, links, split, more, groups, wider, roots, classes)
    linked = some.join(found, ["fp1", "fp2", "n"]).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("id IS NULL OR n = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
