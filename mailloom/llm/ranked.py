"""Ranked lexical search with NRA: sequential reads of impact-sorted lists, no random access.

1. Index. A task cuts its documents into slabs, counts each text's terms and stores one row per slab: the documents'
   ids and lengths, and for each term its postings. Only terms of the items are kept, told by a bitmap of fixed size
   over the terms' checksums; a term that shares a bit is stored for nothing and never read.
2. Totals. Documents, terms and the terms' document counts are aggregates over the stored rows.
3. Search. Items are taken in blocks of bounded size; each block is one job over the index. Within a slab each term's
   list is sorted by impact. For an item all its lists are read downward in step, a chunk at a time. A document's lower
   bound is the impacts seen; its upper bound adds the last impact read of every list it was not seen in. A list is
   read on while a document that may still belong to the best is not seen in it, or an unseen one could get in. So the
   search ends when membership is certain and every member's score is exact; members that tie are told apart by id.
4. A task carries each item's best over its slabs, and starts a slab with the worst of them as the score to beat. Tasks
   hand on `best` rows per item; two windows (by item and a salt, then by item) merge them.

Rows in a task are bounded by a slab and by items of a block times `best`; no posting is shuffled.

Defined cases: null and empty texts have no terms but count as rows without rank; an item without terms, or whose terms
no document holds, has no rows; items with a null or repeated item_id are ranked row by row; each row of a repeated
doc_id is ranked by itself, and a null doc_id comes after all others of its score; other columns are not carried. A long
text is counted in pieces of 1 MB, cut between terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailloom.llm.common import offsets_of, slabs, stored

BEST = 50
#: Bits of the bitmap of terms; bytes of text in a slab; bytes of items in a block; postings of a list read at a time.
BITS, SLAB, BLOCK_BYTES, CHUNK = 1 << 20, 4 << 20, 1 << 18, 256
PIECE = 1 << 20
#: Partial results of an item are merged in so many groups first.
GROUPS = 64

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A-Z to a-z, and what is not of a term to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_NONE = np.iinfo(np.int64).max  # in place of a null doc_id: after all others
_INDEX = "docs array<long>, lengths array<long>, terms array<string>, sizes array<int>, at array<int>, tf array<int>"


def terms_of(text: Column) -> Column:
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(F.coalesce(folded, F.lit("")), F.lit(f"({_TERM})"), F.lit(1))


def count_terms(text: bytes) -> Counter:
    """The terms of a text with their occurrences."""
    out: Counter = Counter()
    first = 0
    while first < len(text):
        last = first + PIECE
        part = text[first:last].translate(_FOLD)
        if last < len(text) and (cut := part.rfind(b" ")) > 0:
            last, part = first + cut, part[:cut]
        elif last < len(text):  # one term fills the piece: take it whole
            rest = text[last:].translate(_FOLD)
            more = rest.find(b" ")
            part += rest if more < 0 else rest[:more]
            last += len(rest) if more < 0 else more
        out.update(part.split())
        first = last
    return out


def bitmap(items: DataFrame) -> bytes:
    """A bit for each checksum, modulo BITS, of the items' terms; at most BITS short rows reach the driver."""
    bits = items.select(F.explode("terms").alias("t")).select((F.crc32("t") % BITS).cast("int").alias("bit")).distinct().toArrow()
    out = np.zeros(BITS, bool)
    out[bits.column("bit").to_numpy()] = True
    return np.packbits(out, bitorder="little").tobytes()


def index(documents: DataFrame, bits: bytes, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each slab of documents; see _INDEX: `at` and `tf` hold the postings of all terms one after another."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").tolist()
        known: dict[bytes, int] = {}
        for batch in batches:
            for slab in slabs(batch, "text", SLAB):
                data, at = offsets_of(slab.column("text"))
                raw = data.tobytes()
                lists: dict[bytes, list[int]] = {}
                lengths = []
                for k in range(slab.num_rows):
                    found = count_terms(raw[at[k] : at[k + 1]])
                    lengths.append(found.total())
                    for term, tf in found.items():
                        keep = known.get(term)
                        if keep is None:
                            if len(known) > 1 << 18:
                                known.clear()
                            keep = known[term] = wanted[crc32(term) % BITS]
                        if keep:
                            lists.setdefault(term, []).extend((k, tf))
                flat = np.array([x for own in lists.values() for x in own], np.int32).reshape(-1, 2)
                row = [
                    pa.ListArray.from_arrays([0, slab.num_rows], slab.column("doc_id").fill_null(_NONE)), pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([[t.decode() for t in lists]], pa.list_(pa.string())), pa.array([[len(x) // 2 for x in lists.values()]], pa.list_(pa.int32())),
                    pa.array([flat[:, 0].copy()], pa.list_(pa.int32())), pa.array([flat[:, 1].copy()], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(row, names=["docs", "lengths", "terms", "sizes", "at", "tf"])

    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(task, _INDEX)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], docs: np.ndarray, most: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the best documents by the sum of their impacts over lists of (places, impacts), sorted downward.

    docs holds the places' ids, the smaller of which wins a tie. Documents with a score of `floor` or less may be left out
    where they are not among the best; scores returned are exact and above zero.
    """
    n, k = len(docs), len(lists)
    lower = np.zeros(n, np.int64)
    seen = np.zeros((k, n), bool)
    read = [0] * k
    bottom = np.array([own[1][0] if len(own[1]) else 0 for own in lists], np.int64)
    reading = [i for i in range(k) if len(lists[i][0])]
    chunk = CHUNK
    while reading:
        for i in reading:
            places, impacts = lists[i]
            a, b = read[i], min(read[i] + chunk, len(places))
            lower[places[a:b]] += impacts[a:b]
            seen[i, places[a:b]] = True
            read[i] = b
            bottom[i] = impacts[b - 1] if b < len(places) else 0
        chunk *= 2
        # The best by lower bounds; what cannot reach the last of them is out.
        positive = np.flatnonzero(lower)
        bar = floor
        if len(positive) >= most:
            bar = max(bar, int(np.partition(lower[positive], len(positive) - most)[len(positive) - most]))
        missing = bottom @ ~seen[:, positive]
        alive = positive[lower[positive] + missing >= max(bar, 1)]
        unseen = int(bottom.sum()) >= max(bar, 1)  # a document not met yet could still get in, or tie
        reading = [i for i in range(k) if read[i] < len(lists[i][0]) and (unseen or not seen[i, alive].all())]
    found = np.flatnonzero(lower >= max(floor, 1))
    if len(found) > 4 * most:
        found = found[lower[found] >= np.partition(lower[found], len(found) - most)[len(found) - most]]
    order = np.lexsort((docs[found], -lower[found]))[:most]
    return found[order], lower[found[order]]


def search(stored_index: DataFrame, items: list[tuple[int, list[str]]], weights: dict[str, int], documents: int, terms: int, best: int) -> DataFrame:
    """Each task's best documents: item (its key), doc_id (_NONE for null) and score."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                docs, lengths, names, sizes, at, tf = (c.slice(r, 1).flatten() for c in batch.columns)
                docs, lengths, at, tf = (c.to_numpy() for c in (docs, lengths, at, tf))
                ends = np.cumsum(sizes.to_numpy().astype(np.int64))
                modest = 20 * (50 + 50 * lengths * documents // max(terms, 1))
                impacts = {}
                for name, a, b in zip(names.to_pylist(), (ends - sizes.to_numpy()).tolist(), ends.tolist()):
                    w = weights.get(name)
                    if w:
                        often = tf[a:b].astype(np.int64)
                        impact = w * (1_000_000_000 * often // (1000 * often + modest[at[a:b]]))
                        order = np.argsort(-impact, kind="stable")
                        order = order[: np.count_nonzero(impact)]
                        impacts[name] = (at[a:b][order], impact[order])
                for item, own in items:
                    lists = [impacts[t] for t in own if t in impacts]
                    if not lists:
                        continue
                    old = kept.get(item)
                    bar = int(old[1][-1]) if old is not None and len(old[1]) == best else 0
                    places, scores = nra(lists, docs, best, bar)
                    ids = docs[places]
                    if old is not None:
                        ids, scores = np.concatenate([old[0], ids]), np.concatenate([old[1], scores])
                        order = np.lexsort((ids, -scores))[:best]
                        ids, scores = ids[order], scores[order]
                    kept[item] = ids, scores
        for item, (ids, scores) in kept.items():
            columns = [pa.array(np.full(len(ids), item)), pa.array(ids), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return stored_index.mapInArrow(task, "item long, doc_id long, score long")


def rank(documents: DataFrame, items: DataFrame, best: int = BEST, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of each item's best documents."""
    spark = documents.sparkSession
    keyed = items.select(F.monotonically_increasing_id().alias("item"), F.col(item).cast("long").alias("item_id"), F.array_distinct(terms_of(F.col(text))).alias("terms"))
    keyed = stored(keyed, "ranked-items")
    whole = stored(index(documents, bitmap(keyed), doc, text), "ranked-index")
    n, total = whole.select(
        F.size(F.filter("lengths", lambda x: x > 0)).cast("long").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("total")
    ).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    counts = whole.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.sizes").alias("df"))
    size = F.aggregate("terms", F.lit(64).cast("long"), lambda a, t: a + F.octet_length(t) + 8)
    blocks = math.ceil((keyed.agg(F.sum(size)).first()[0] or 0) / BLOCK_BYTES)
    if blocks > 1:
        counts = stored(counts, "ranked-counts")
    found = None
    for k in range(blocks):
        own = keyed.where((F.size("terms") > 0) & (F.pmod(F.xxhash64("item"), F.lit(blocks)) == k))
        block = [(r["item"], r["terms"]) for r in own.select("item", "terms").collect()]
        held = counts.join(own.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")
        weights = {r["term"]: weight(n, r["df"]) for r in held.collect()}
        part = search(whole, block, weights, n, total, best)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id"))
    salted = found.withColumn("salt", F.spark_partition_id() % GROUPS)
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= best)
    named = ranked.join(keyed.select("item", "item_id"), "item")
    return named.select("item_id", "rank", F.nullif(F.col("doc_id"), F.lit(_NONE)).alias("doc_id"), "score")
