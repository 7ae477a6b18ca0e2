"""Benchmark decontamination with a distributed positional inverted index.

The training texts are cut into shards of bounded size. Each shard's index holds, for every word of the benchmark, the
sorted list of its positions in the shard (a posting list), and one row with its documents; lists are rows of a stored
table. A shard is searched where its lists are: for every window of consecutive benchmark words the lists are taken
from the rarest word on, offset-adjusted to the window's start and intersected until nothing is left. With a slop of k
a word may stand up to k places from where it should (proximity); 0 is the exact phrase.

The benchmark is a stored table, dealt to blocks of bounded size. Each block is one search of the stored index, the only
one the driver and the tasks hold; several blocks' hits are merged per document. The benchmark's vocabulary, which only
narrows the index, is left out beyond a bound, and then every word is indexed. Shards are dealt by bytes, so a hot
source or word only means longer lists within shards of the same size.

Defined cases: null and empty texts have no words; items without a word are ignored; an item with fewer words than a
window is one window; repeated documents each give a row; repeated items each count; windows of an item without an id hit, but it is not
listed; empty tables give no rows, or
rows without hits; other columns are not carried. Words are compared by a 64-bit hash of their lower-cased bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from mailloom.llm.common import FOLDED, PLAIN, offsets_of, slabs, stored, word_hashes, words_of

WINDOW = 10
#: Bytes of text in a shard, words of the benchmark in a broadcast block, words of the vocabulary filter.
SHARD_BYTES, BLOCK_WORDS, VOCABULARY = 4 << 20, 1 << 20, 1 << 21
#: Positions between two documents of a shard: no window spans them.
GAP = 1 << 10

_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("first", pa.int64()), ("n_words", pa.int64())]))
INDEX = "shard long, term long, positions binary, documents array<struct<doc_id: long, first: long, n_words: long>>"
HITS = "doc_id long, n_words long, n_hit long, items array<long>, hits array<struct<first_word: long, end_word: long>>"
_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column of texts, and the n + 1 word offsets of the texts."""
    data, at = offsets_of(column)
    data = FOLDED[data]
    starts, ends = words_of(data, at, PLAIN)
    return word_hashes(data, starts, ends).view(np.int64), np.searchsorted(starts, at)


def index(documents: DataFrame, vocabulary: np.ndarray | None = None, doc: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Posting lists of the shards, as a stored table; only words of a sorted vocabulary, if one is given.

    positions: ascending unsigned 32-bit integers. A shard's documents are in its row with a null term. One text of
    more than 2^32 words is beyond the format and raises.
    """
    known = documents.sparkSession.sparkContext.broadcast(vocabulary) if vocabulary is not None else None

    def flush(shard: int, docs: list, terms: list, places: list) -> Iterator[pa.RecordBatch]:
        term, place = np.concatenate(terms), np.concatenate(places)
        order = np.argsort(term, kind="stable")
        term, place = term[order], place[order].astype("<u4")
        cuts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        lists = pa.Array.from_buffers(
            pa.binary(), len(cuts), [None, pa.py_buffer((np.append(cuts, len(term)) * 4).astype(np.int32)), pa.py_buffer(place.tobytes())]
        )
        n = len(cuts)
        names = ["shard", "term", "positions", "documents"]
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([docs], _DOCS)], names=names)
        for a in range(0, n, 10_000):
            b = min(n, a + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, shard)), pa.array(term[cuts[a:b]]), lists.slice(a, b - a), pa.nulls(b - a, _DOCS)], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        docs, terms, places, held, at = [], [], [], 0, 0
        for batch in batches:
            for slab in slabs(batch, "text"):
                found, cuts = terms_of(slab.column("text"))
                n_words = np.diff(cuts)
                first = at + np.cumsum(n_words + GAP) - (n_words + GAP)
                place = np.arange(len(found)) + np.repeat(first - cuts[:-1], n_words)
                if known is not None:
                    words = known.value
                    near = np.minimum(np.searchsorted(words, found), max(len(words) - 1, 0))
                    keep = words[near] == found if len(words) else np.zeros(len(found), bool)
                    found, place = found[keep], place[keep]
                docs += [{"doc_id": d, "first": a, "n_words": n} for d, a, n in zip(slab.column("doc_id").to_pylist(), first.tolist(), n_words.tolist())]
                terms.append(found)
                places.append(place)
                at = int(first[-1] + n_words[-1] + GAP)
                if at >= 1 << 32:
                    raise OverflowError("a text has too many words for one shard")
                held += slab.nbytes
                if held >= shard_bytes:
                    yield from flush(shard, docs, terms, places)
                    shard, docs, terms, places, held, at = shard + 1, [], [], [], 0, 0
        if docs:
            yield from flush(shard, docs, terms, places)

    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(task, INDEX), "postings")


#: In place of a null item_id: its windows hit, but it is not listed.
NO_ITEM = -(1 << 63)


def items_of(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """The benchmark as a stored table: item_id, words (their hashes) and n; a very long item in pieces that overlap by a window."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch, "text"):
                found, cuts = terms_of(slab.column("text"))
                ids, words = [], []
                for own, a, b in zip(slab.column("item_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                    for k in range(a, max(b - window + 1, a + 1), BLOCK_WORDS):
                        ids.append(NO_ITEM if own is None else own)
                        words.append(found[k : min(k + BLOCK_WORDS + window - 1, b)].astype("<i8"))
                sizes = pa.array([len(w) for w in words], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([w.tobytes() for w in words], pa.binary()), sizes], names=["item_id", "words", "n"])

    rows = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(task, "item_id long, words binary, n long").where("n > 0")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "benchmark")


def vocabulary_of(items: DataFrame, most: int) -> np.ndarray | None:
    """The sorted words of the items, if they are `most` or fewer; no more than that reaches the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.frombuffer(b"".join(batch.column("words").to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(words).astype(np.int64))], names=["word"])

    found = items.select("words").mapInArrow(task, "word long").distinct().limit(most + 1).toArrow()
    return np.sort(found.column("word").to_numpy()) if found.num_rows <= most else None


def block_of(items: DataFrame, number: int, of: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """One block of items: their ids, offsets and words; about BLOCK_WORDS words, and one item's piece more at most."""
    rows = items.where(F.pmod(F.xxhash64("row"), F.lit(of)) == number).select("item_id", "words").collect()
    words = [np.frombuffer(r["words"], "<i8") for r in rows]
    return [r["item_id"] for r in rows], np.cumsum([0] + [len(w) for w in words]), np.concatenate([*words, np.zeros(0, np.int64)])


def find(lists: dict[int, np.ndarray], words: list[int], slop: int = 0) -> np.ndarray:
    """Starts of the places where the words stand, each at most `slop` places from where the rarest one puts it."""
    found = [lists.get(w) for w in words]
    if any(x is None for x in found):
        return np.zeros(0, np.int64)
    order = sorted(range(len(words)), key=lambda o: len(found[o]))
    starts = found[order[0]] - order[0]
    for o in order[1:]:
        places = found[o]
        near = np.searchsorted(places, starts + (o - slop))
        inside = near < len(places)
        starts, near = starts[inside], near[inside]
        starts = starts[places[near] <= starts + (o + slop)]
        if not len(starts):
            break
    return starts


def search(index_rows: DataFrame, block: tuple, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """For every document its shard and place there, its words, its words inside the block's windows, the items they come
    from, and their spans."""
    held = index_rows.sparkSession.sparkContext.broadcast(block)  # bounded, see block_of

    def shard(table: pa.Table) -> pa.Table:
        documents, lists, own_shard = [], {}, table.column("shard")[0].as_py()
        for batch in table.to_batches():
            data, at = offsets_of(batch.column("positions"))
            data = data.tobytes()
            for i, (term, docs) in enumerate(zip(batch.column("term").to_pylist(), batch.column("documents"))):
                if term is None:
                    documents = docs.as_py()
                else:
                    lists[term] = np.frombuffer(data, "<u4", (at[i + 1] - at[i]) // 4, at[i]).astype(np.int64)
        documents.sort(key=lambda d: d["first"])
        firsts = np.array([d["first"] for d in documents])
        starts, lengths, items = [], [], []
        ids, offsets, words = held.value
        have = np.isin(words, np.fromiter(lists, np.int64, len(lists)))
        absent = np.concatenate([[0], np.cumsum(~have)])
        for item, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
            size = min(window, b - a)
            first = np.arange(a, b - size + 1)
            for w in first[absent[first + size] == absent[first]].tolist():
                at = find(lists, words[w : w + size].tolist(), slop)
                if len(at):
                    starts.append(at)
                    lengths.append(np.full(len(at), size))
                    items.append(np.full(len(at), item))
        n = len(documents)
        hit, spans, own = np.zeros(n, np.int64), [[] for _ in range(n)], [set() for _ in range(n)]
        if starts:
            start, length, item = np.concatenate(starts), np.concatenate(lengths), np.concatenate(items)
            doc = np.searchsorted(firsts, start + slop, "right") - 1
            for d, i in set(zip(doc.tolist(), item.tolist())):
                if i != NO_ITEM:
                    own[d].add(i)
            order = np.argsort(start, kind="stable")
            start, end, doc = start[order], (start + length)[order], doc[order]
            reach = np.maximum.accumulate(end)
            opens = np.concatenate([[True], start[1:] > reach[:-1]])
            last = np.append(np.flatnonzero(opens)[1:], len(start)) - 1
            for a, b, d in zip(start[opens].tolist(), reach[last].tolist(), doc[opens].tolist()):
                a, b = max(0, a - int(firsts[d])), min(b - int(firsts[d]), documents[d]["n_words"])
                spans[d].append({"first_word": a, "end_word": b})
                hit[d] += b - a
        return pa.Table.from_arrays(
            [pa.array([d["doc_id"] for d in documents], pa.int64()), pa.array([d["n_words"] for d in documents], pa.int64()), pa.array(hit)]
            + [pa.array([sorted(o) for o in own], pa.list_(pa.int64())), pa.array(spans, _SPANS), pa.array(np.full(n, own_shard)), pa.array(firsts, pa.int64())],
            names=["doc_id", "n_words", "n_hit", "items", "hits", "shard", "first"],
        )

    return index_rows.groupBy("shard").applyInArrow(shard, HITS + ", shard long, first long")


def merged(found: DataFrame) -> DataFrame:
    """The hits of several blocks as one row per document; there is one row per block to merge."""
    ordered = F.array_sort(F.flatten(F.collect_list("hits")))
    last = lambda spans: F.element_at(spans, -1)

    def grown(spans, s):
        longer = F.struct(last(spans)["first_word"].alias("first_word"), F.greatest(last(spans)["end_word"], s["end_word"]).alias("end_word"))
        touches = (F.size(spans) > 0) & (s["first_word"] <= last(spans)["end_word"])
        return F.when(touches, F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(longer))).otherwise(F.concat(spans, F.array(s)))

    none = F.array().cast("array<struct<first_word:bigint,end_word:bigint>>")
    rows = found.groupBy("shard", "first").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        ordered.alias("all"),
    )
    rows = rows.withColumn("hits", F.aggregate("all", none, grown))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end_word"] - s["first_word"])
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "hits")


def contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted) and hits (spans of words) of every document."""
    items = items_of(benchmark, window)
    whole = index(documents, vocabulary_of(items, VOCABULARY))
    blocks = max(1, -(-(items.agg(F.sum("n")).first()[0] or 0) // BLOCK_WORDS))
    found = search(whole, block_of(items, 0, blocks), window, slop)
    if blocks == 1:
        return found.drop("shard", "first")
    for k in range(1, blocks):
        found = found.unionByName(search(whole, block_of(items, k, blocks), window, slop))
    return merged(found)
