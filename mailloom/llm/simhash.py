"""SimHash near-duplicates with sharded BK-trees.

Each text gets the 64-bit majority fingerprint of its word shingles' hashes. Fingerprints that differ in few bits are
linked, and components of links are classes of near-duplicates.

Links are found among distinct fingerprints. If two differ in at most 3 bits, then of four bands of bits at least one
is equal, so fingerprints go to one shard per band, and each shard builds a BK-tree: a node's children are keyed by
their Hamming distance to it, and a query follows only edges within the radius of its own distance. A shard with too
many fingerprints is dealt again by four bands of its remaining bits, and so on: every pair still meets, and with each
level a shard has fewer free bits, so its size is bounded whatever the data. A shard hands on a spanning forest of its
links, not pairs. Components come from alternating star contraction on stored edge tables.

Nothing of this passes through the driver. Trees are not broadcast: together they hold every fingerprint, which has no
size bound, so queries travel to the shard's tree by shuffle instead.

Defined cases: a text without words (null too) has fingerprint zero, linked like any other; with fewer words than a
shingle the whole sequence is the only shingle; repeated doc_ids share their smallest id like any copies; null doc_ids
are never the smallest unless alone; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from mailloom.llm.common import discard, per_slab, stored

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Fingerprints in a tree before the shard is dealt again.
TREE = 2048


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits set in over half of each text's hashes; the hashes of texts follow one another, `counts` of each."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        values = hashes.astype("<u8")
        sums = np.zeros((len(full), 64), np.int64)
        firsts = np.cumsum(counts[full]) - counts[full]
        part = 1 << 16
        for a in range(0, len(values), part):  # bounded for a very long text
            b = min(a + part, len(values))
            bits = np.unpackbits(values[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k = int(np.searchsorted(firsts, a, "right")) - 1
            cuts = np.concatenate([[a], firsts[k + 1 : np.searchsorted(firsts, b)]])
            sums[k : k + len(cuts)] += np.add.reduceat(bits, cuts - a, axis=0, dtype=np.int64)
        most = 2 * sums > counts[full][:, None]
        out[full] = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """Majority fingerprints of the texts' word shingles."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    hashed = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        words = text.encode().lower().split() if text else []
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) < shingle:
            hashes.append(hashed(joined, SEED))
            counts[k] = 1
            continue
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        hashes += [hashed(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
        counts[k] = len(starts)
    return majority(np.array(hashes, np.uint64), counts)


def _fingerprints(rows: DataFrame, shingle: int, kept: tuple[str, ...]) -> DataFrame:
    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        found = fingerprints_of(slab.column("text").to_pylist(), shingle)
        return pa.RecordBatch.from_arrays([*(slab.column(c) for c in kept), pa.array(found.view(np.int64))], names=[*kept, "fp"])

    return per_slab(rows, "text", ", ".join(f"{c} long" for c in (*kept, "fp")), work)


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every document."""
    return _fingerprints(documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")), shingle, ("doc_id",))


@lru_cache(None)
def submasks(fixed: int, radius: int) -> tuple[int, ...]:
    """Masks that fix one more of radius + 1 bands of the bits which `fixed` leaves free."""
    free = [b for b in range(64) if not fixed >> b & 1]
    bands, rest = divmod(len(free), radius + 1)
    out, at = [], 0
    for k in range(radius + 1):
        size = bands + (k < rest)
        out.append(fixed | sum(1 << b for b in free[at : at + size]))
        at += size
    return tuple(out)


def _deal(rows: DataFrame, radius: int) -> DataFrame:
    """A row for each of radius + 1 submasks of mask, with the shard (mask, value) and fp."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, fp = (batch.column(c).to_numpy() for c in ("mask", "fp"))
            subs = {m: np.array(submasks(m & (1 << 64) - 1, radius), np.uint64).view(np.int64) for m in np.unique(mask).tolist()}
            masks = np.array([subs[m] for m in mask.tolist()], np.int64).ravel()
            fps = np.repeat(fp, radius + 1)
            yield pa.RecordBatch.from_arrays([pa.array(masks), pa.array(masks & fps), pa.array(fps)], names=["mask", "value", "fp"])

    return rows.select("mask", "fp").mapInArrow(task, "mask long, value long, fp long")


class BKTree:
    """Nodes are [fingerprint, {distance: node}]."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, fp: int) -> None:
        if self.root is None:
            self.root = [fp, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ fp).bit_count()
            child = node[1].get(d)
            if child is None:
                node[1][d] = [fp, {}]
                return
            node = child

    def near(self, fp: int, radius: int) -> list[int]:
        """All fingerprints of the tree within the radius."""
        found, stack = [], [self.root] if self.root else []
        while stack:
            held, children = stack.pop()
            d = (held ^ fp).bit_count()
            if d <= radius:
                found.append(held)
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)
        return found


def forest(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what a shard's tree joins: each fingerprint with the smallest of its component."""
    parent = {f: f for f in fps}

    def top(f: int) -> int:
        while parent[f] != f:
            parent[f] = f = parent[parent[f]]
        return f

    tree = BKTree()
    for f in parent:
        for g in tree.near(f, radius):
            a, b = top(f), top(g)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(f)
    return [(top(f), f) for f in parent if top(f) != f]


def _trees(shards: DataFrame, radius: int) -> DataFrame:
    """Links (a, b), a < b, of all shards (mask, value, fp)."""
    unsigned = (1 << 64) - 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, links = None, [], []

        def flush() -> None:
            if len(held) > 1:
                links.extend(forest([f & unsigned for f in held], radius))

        def rows() -> pa.RecordBatch:
            pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

        for batch in batches:
            for *k, fp in zip(*(batch.column(c).to_pylist() for c in ("mask", "value", "fp"))):
                if k != key:
                    flush()
                    key, held = k, []
                held.append(fp)
            if len(links) > 10_000:
                yield rows()
                links.clear()
        flush()
        yield rows()

    return shards.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(task, "a long, b long")


def links(distinct: DataFrame, radius: int = RADIUS, most: int = TREE) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints (column fp, distinct) within the radius."""
    dealt = distinct.select(F.lit(0).cast("long").alias("mask"), "fp")
    found, used = None, []
    while True:
        rows = stored(_deal(dealt, radius), "simhash-shards", used)
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        sized = rows.join(sizes, ["mask", "value"])
        # A shard whose free bits are few is small by itself.
        fits = (F.col("n") <= most) | (F.bit_count("mask") >= 54)
        own = _trees(sized.where(fits).select("mask", "value", "fp"), radius)
        found = own if found is None else found.unionByName(own)
        dealt = sized.where(~fits).select("mask", "fp")
        if dealt.isEmpty():
            out = stored(found.distinct(), "simhash-links")
            discard(distinct.sparkSession, used)
            return out


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node of the edges (a, b); nulls are not allowed."""

    def hooked(e: DataFrame, small: bool) -> DataFrame:
        """Large star: larger neighbours go to the smallest one; small star: smaller ones and the node itself do."""
        if small:
            to = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        else:
            to = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = to.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = to.join(least, "u")
        if small:
            own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own)
        else:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    used: list[str] = []
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars", used)
    before = state(current)
    while before[0]:
        current = stored(hooked(hooked(current, False), True), "stars", used)
        discard(edges.sparkSession, used[:-1])
        del used[:-1]
        now = state(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def groups_of(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, its group (a fingerprint that names the component) and the component's smallest doc_id; fps: doc_id, fp."""
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct.select("fp"), radius))
    member = distinct.join(roots, distinct["fp"] == roots["node"]).select("root", "fp", "first")
    smallest = member.groupBy("root").agg(F.min("first").alias("component"))
    # Only fingerprints with links, or with several documents, need another id than their own.
    linked = member.join(smallest, "root").select("fp", "root", "component")
    return distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"), F.coalesce("component", "first").alias("component_id"))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, and component_id: the smallest doc_id that links reach, itself included."""
    fps = stored(fingerprints(documents, shingle, doc, text), "fingerprints")
    return fps.join(groups_of(fps, radius), "fp").select("doc_id", "fp", "component_id")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents, all columns, one row of each group: that with the smallest doc_id, null last, then by text hashes.

    Rows are told apart by doc_id and text, so other rows of a repeated or null doc_id are judged by themselves. Only
    narrow rows are grouped; texts move once, to meet the list of rows that stay.
    """
    key = ("doc_id", "d1", "d2")
    hashes = [F.xxhash64("text").alias("d1"), F.shiftleft(F.hash("text").cast("long"), 32).bitwiseOR(F.coalesce(F.octet_length("text"), F.lit(-1))).alias("d2")]
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *hashes)
    fps = stored(_fingerprints(keyed, shingle, key), "fingerprints")
    grouped = fps.join(groups_of(fps, radius), "fp").groupBy("group", *key).agg(F.count("*").alias("n"))
    least = grouped.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), *key, "n")).alias("w"))
    winners = stored(least.select("w.*"), "winners").select(*(F.col(c).alias(f"_{c}") for c in key), F.col("n").alias("_n"))
    own = [F.col("doc_id").cast("long"), *hashes]
    met = [a.eqNullSafe(F.col(f"_{c}")) for a, c in zip(own, key)]
    single = documents.join(winners.where("_n = 1"), met, "left_semi")
    several = documents.join(winners.where("_n > 1"), met, "left_semi")
    return single.unionByName(several.dropDuplicates(["doc_id", "text"]))


def hex_of(fp: Column) -> Column:
    """16 lower-case hexadecimal digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
