"""Substring dedup by seed and extend: repeats across documents from winnowed anchors.

A window is `length` consecutive words. A word goes if a window that covers it also starts in a document with a smaller
doc_id; windows are judged on the input.

1. Seeds. Words are hashed, and grams of GRAM words from them. Each window stands at the gram in it whose hash is
   smallest, leftmost first (winnowing), so equal windows have equal anchors at equal places. Consecutive windows with
   one anchor are one row: the seed, with its anchor (64 bits) and 64 bits of all the words its windows reach, left and
   right.
2. Documents meet on anchors. One total sort by anchor, reach and doc_id (ranges, so a hot passage is spread like any
   other) puts equal reaches side by side, the smallest doc_id first: all windows of the other documents repeat, which
   settles copies without pairs. Where an anchor has different reaches, the seeds of each one's smallest document go on.
   A run that a range's edge cuts is put right by the edges' own rows, two a range.
3. Extension. These seeds get their words back and are extended both ways, a word at a time, up to the ends of their
   reach: every extension of `length` words, so many to the left and the rest to the right, meets the same extensions
   of the anchor's other seeds in an aggregate that keeps the smallest doc_id. No pair of documents is formed, and a
   seed has at most length - GRAM + 1 extensions.
4. Extensions that touch or overlap are merged per text to maximal repeats, none shorter than `length`, and cut out.

Rows are keyed by doc_id and a hash of the text, so repeated doc_ids do no harm. Words are compared by 64-bit hashes of
their bytes, reaches and windows by 128 bits mixed from those in order.

Defined cases: a null text has no words; a text with fewer than `length` words is kept; a null doc_id is neither smaller
nor larger than any, so such rows are kept whole and remove nothing; of equal doc_ids none is smaller; an empty table
gives no rows; other columns are not carried. A text is cut into pieces of 2^20 words, overlapping by length - 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailloom.llm.common import SPACED, mixed, offsets_of, per_slab, slabs, stored, word_hashes, words_of

LENGTH, GRAM = 13, 5
PIECE_WORDS = 1 << 20

_PLACE = np.uint64((1 << 21) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEED = "h long, x long, doc long, t long, first int, last int"
_FOUND = "kind string, " + _SEED


def chained(parts: list[np.ndarray], start: int) -> np.ndarray:
    """Hashes of sequences, given element by element; no sum of elements, so nothing cancels."""
    out = np.full(len(parts[0]), start, np.uint64)
    for part in parts:
        out = mixed(out * _ODD + part)
    return out


def seeds_of(words: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """First and last window, anchor and reach hash of each seed; `at` are the offsets of texts laid end to end."""
    ends = np.repeat(at[1:], np.diff(at))
    starts = np.flatnonzero(np.arange(len(words)) + length <= ends)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = chained([words[j : len(words) - gram + 1 + j] for j in range(gram)], 5)
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    spread = length - gram + 1
    width = 1
    while 2 * width <= spread:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < spread:
        least = np.minimum(least[: len(least) - (spread - width)], least[spread - width :])
    place = (least[starts] & _PLACE).astype(np.int64)
    # A place is in one text only, so a new text has a new one.
    heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    first, last, place = starts[heads], starts[np.append(heads[1:], len(starts)) - 1], place[heads]
    shape = ((place - first) * 64 + (last - first)).astype(np.uint64)
    x = mixed(shape + np.uint64(1))
    for j in range(length + spread):  # the reach has at most so many words
        more = np.flatnonzero(first + j < last + length)
        if not len(more):
            break
        x[more] = mixed(x[more] * _ODD + words[first[more] + j])
    return first, last, grams[place].view(np.int64), x.view(np.int64)


def sequences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid end to end (offsets `at` in bytes), and the texts' offsets in words."""
    starts, ends = words_of(data, at, SPACED)
    return word_hashes(data, starts, ends), np.searchsorted(starts, at)


def seeds(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """A row for each seed of each text (doc, t, text); places count words."""

    def rows(doc: np.ndarray, t: np.ndarray, words: np.ndarray, at: np.ndarray, shift: int = 0) -> pa.RecordBatch:
        first, last, *hashes = seeds_of(words, at, length, gram)
        own = np.searchsorted(at, first, "right") - 1
        columns = [pa.array(c) for c in (*hashes, doc[own], t[own])]
        places = [pa.array((c - at[own] + shift).astype(np.int32)) for c in (first, last)]
        return pa.RecordBatch.from_arrays([*columns, *places], names=["h", "x", "doc", "t", "first", "last"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch, "text"):
                data, at = offsets_of(slab.column("text"))
                doc, t = (slab.column(c).to_numpy() for c in ("doc", "t"))
                words, cuts = sequences(data, at)
                if len(words) <= PIECE_WORDS:
                    yield rows(doc, t, words, cuts)
                    continue
                for k in range(len(doc)):
                    own = words[cuts[k] : cuts[k + 1]]
                    for a in range(0, max(len(own) - length + 1, 1), PIECE_WORDS - length + 1):
                        part = own[a : a + PIECE_WORDS]
                        yield rows(doc[k : k + 1], t[k : k + 1], part, np.array([0, len(part)]), a)

    return documents.select("doc", "t", "text").mapInArrow(task, _SEED)


def meet(rows: DataFrame, most: int = 100_000) -> DataFrame:
    """Sort all seeds by anchor, reach and doc_id, and compare neighbours.

    kind `repeat`: a smaller doc_id has the same reach. `vary`: of the smallest doc_id of its run, while another reach of
    the anchor stands beside it, or may stand in the next range. `open`: of the smallest doc_id of a range's first run,
    which may have begun in the range before. `edge`: the first and last run of a range, with that doc_id.
    """
    names = _FOUND.replace(",", "").split()[::2]

    def out(kind: str, found: np.ndarray) -> pa.RecordBatch:
        columns = [*(pa.array(c) for c in found[:, :4].T.copy()), *(pa.array(c, pa.int32()) for c in found[:, 4:].T.copy())]
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(found), pa.string()), *columns], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The open run's rows of its smallest doc_id head the next batch.
        carried, linked, opening = np.zeros((0, 6), np.int64), False, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.concatenate([carried, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], 1)])
            fresh = np.concatenate([[True], (table[1:, :2] != table[:-1, :2]).any(1)])
            heads, run = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            own = table[:, 2] == table[heads, 2][run]
            if not own.all():
                yield out("repeat", table[~own])
            before = np.concatenate([[linked], table[heads[1:], 0] == table[heads[:-1], 0]])  # the run before has the anchor too
            beside = before.copy()
            beside[:-1] |= before[1:]
            last = len(heads) - 1
            if opening and last:
                beside[0] = True
                yield out("open", table[own & (run == 0)])
                yield out("edge", table[:1])
                opening = False
            if (found := own & (run < last) & beside[run]).any():
                yield out("vary", table[found])
            carried, linked = table[own & (run == last)], bool(before[last])
            if len(carried) > most:  # one text repeats it so often
                yield out("vary", carried)
                if opening:
                    yield out("open", carried)
                carried = carried[-1:]
        if len(carried):
            yield out("vary", carried)
            if opening:
                yield out("open", carried)
            yield out("edge", carried[:1])

    ordered = rows.repartitionByRange("h", "x", "doc").sortWithinPartitions("h", "x", "doc")
    return ordered.mapInArrow(task, _FOUND)


def extend(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every extension of the wanted seeds of a text (doc, t, text, cuts): its hashes, doc, t and first word."""

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        data, at = offsets_of(slab.column("text"))
        words, offsets = sequences(data, at)
        cuts = slab.column("cuts")
        flat = cuts.flatten()
        own = np.repeat(np.arange(slab.num_rows), cuts.value_lengths().to_numpy())
        first, last = (flat.field(c).to_numpy().astype(np.int64) for c in range(2))
        sizes = last - first + 1
        own, first = np.repeat(own, sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
        grown = [words[first + offsets[own] + j] for j in range(length)]
        w1, w2 = (c.view(np.int64) for c in (chained(grown, 1), chained([~g for g in grown], 2)))
        columns = [pa.array(c) for c in (w1, w2, *(slab.column(c).to_numpy()[own] for c in ("doc", "t")), first.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "doc", "t", "first"])

    return per_slab(texts, "text", "w1 long, w2 long, doc long, t long, first int", work)


def repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, t and spans of words (first, end) that windows of smaller doc_ids cover; spans may overlap. documents: doc, t, text."""
    found = stored(meet(seeds(documents, length)), "seeds")
    span = lambda rows: rows.select("doc", "t", "first", (F.col("last") + length).cast("int").alias("end"))
    edges = found.where("kind = 'edge'").groupBy("h", "x").agg(F.min("doc").alias("least"))  # two rows a range at most
    late = found.where("kind = 'open'").join(edges, ["h", "x"]).where("doc > least")
    vary = found.where("kind = 'vary'").groupBy("doc", "t").agg(F.collect_set(F.struct("first", "last")).alias("cuts"))
    texts = documents.dropDuplicates(["doc", "t"]).join(vary, ["doc", "t"])
    grown = stored(extend(texts, length), "extensions")
    least = grown.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    again = grown.join(least, ["w1", "w2"]).where("doc > least").select("doc", "t", "first", (F.col("first") + length).cast("int").alias("end"))
    return span(found.where("kind = 'repeat'")).unionByName(span(late)).unionByName(again)


def deduplicate(documents: DataFrame, length: int = LENGTH, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, removed (spans of words), n_removed, kept (words joined by a space) and its digest, of every document."""
    rows = documents.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text")).withColumn("t", F.xxhash64("text"))
    spans = repeats(rows.where("doc IS NOT NULL AND text IS NOT NULL"), length)
    by_text = spans.groupBy("doc", "t").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans"))
    joined = rows.join(by_text, ["doc", "t"], "left").select("doc", "text", "spans")
    _span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        data, at = offsets_of(slab.column("text"))
        raw = data.tobytes()
        removed, kept, sizes = [], [], []
        for k, spans in enumerate(slab.column("spans")):
            words = raw[at[k] : at[k + 1]].split()
            merged, parts, done = [], [], 0
            if spans.is_valid:
                flat = spans.values
                for a, b in zip(flat.field(0).to_pylist(), flat.field(1).to_pylist()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
            for a, b in merged:
                parts += words[done:a]
                done = b
            kept.append(b" ".join([*parts, *words[done:]]))
            removed.append([{"first": a, "end": b} for a, b in merged])
            sizes.append(len(words))
        gone = [sum(s["end"] - s["first"] for s in own) for own in removed]
        digests = [hashlib.sha256(x).hexdigest() for x in kept]
        columns = [slab.column("doc"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, _span), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "removed", "kept", "kept_sha256"])

    return per_slab(joined, "text", "doc_id long, n_words long, n_removed long, removed array<struct<first: long, end: long>>, kept string, kept_sha256 string", work)
