"""Exact substring dedup with suffix arrays built by two-stage sorting.

Every byte that a string of `LENGTH` bytes covers which also starts anywhere else (in this text or another) is found.
A suffix array of a whole corpus fits no task, so strings are first brought together by content:

1. Anchors. Each string of LENGTH bytes stands at the gram of GRAM bytes in it whose hash is smallest, leftmost first.
   Equal strings have equal anchors. Consecutive strings with one anchor are one row: its extent.
2. One total sort of the rows by anchor and extent (ranges, so a hot anchor or extent is spread like any other) puts
   equal extents side by side. Where extents repeat, all their strings do; this is the pre-aggregation of copies.
   Where an anchor has different extents, one row of each goes on.
3. Suffix arrays. The bytes of these extents are fetched, dealt by anchor in groups of bounded size, and laid end to end.
   Two-stage sorting orders the strings' suffixes: only suffixes smaller than their successors are sorted directly,
   all others are induced by scanning the buckets of first bytes from the smallest up. Adjacent common prefixes of
   LENGTH bytes are the repeats. An anchor whose extents are many bytes is dealt to several groups; of these, each distinct
   string also leaves its hash, and hashes that several groups leave are repeats too.
4. The spans of a text are merged and its other bytes kept.

Texts are keyed by 128 bits of their content (two hashes and the length), so copies of a text share their result and
null or repeated doc_ids do no harm. Anchors and extents are compared by 128 bits of hashes.

Defined cases: a null or empty text has no bytes and nothing removed; texts shorter than LENGTH are kept; an empty table
gives no rows; other columns are not carried. A text is cut into pieces of 1 MB, overlapping by LENGTH - 1 bytes, for
its anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailloom.llm.common import BASE, BYTE_VALUES, INVERSE, mixed, offsets_of, per_slab, powers, release, segment_hashes, slabs, stored

LENGTH, GRAM = 200, 32
#: Bytes of extents in a group before its anchor is dealt to several; bytes of a suffix array's text, but for one group.
GROUP_BYTES, BLOCK_BYTES = 2 << 20, 1 << 18
#: Rows of a batch that a suffix array's task hands on.
BATCH_ROWS = 1 << 15
#: Bytes of text whose grams a task hashes at once, and of a piece of a long text.
SCAN_BYTES, PIECE_BYTES = 1 << 18, 1 << 20

_PLACE = np.uint64((1 << 24) - 1)
_ROW = "h long, x long, d1 long, d2 long, first long, last long"


def text_key(text: Column) -> list[Column]:
    """128 bits of a text: two hashes and its length."""
    return [F.xxhash64(text).alias("d1"), F.shiftleft(F.hash(text).cast("long"), 32).bitwiseOR(F.octet_length(text)).alias("d2")]


def anchors(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Extents of texts laid end to end (under 2^24 bytes): first and last string start, anchor hash, extent hash."""
    n = len(data)
    ends = np.repeat(at[1:], np.diff(at))
    starts = np.flatnonzero(np.arange(n) + length <= ends)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, n), out=sums[1:])
    inverse = powers(INVERSE, n + 1)
    grams = mixed((sums[gram:] - sums[:-gram]) * inverse[: n + 1 - gram])
    # The smallest hash of each string, with its place in the low bits: the leftmost wins a tie.
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, length - gram + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    place = (least[starts] & _PLACE).astype(np.int64)
    fresh = np.concatenate([[True], place[1:] != place[:-1]])
    first, place = starts[fresh], place[fresh]
    last = starts[np.append(np.flatnonzero(fresh)[1:], len(starts)) - 1]
    whole = (sums[last + length] - sums[first]) * inverse[first]
    shape = ((place - first) << 32 | (last - first)).astype(np.uint64)
    return first, last, grams[place], mixed(mixed(whole) + shape)


def extents(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row for each extent of each text (d1, d2, text)."""

    def rows(d1: np.ndarray, d2: np.ndarray, data: np.ndarray, at: np.ndarray, shift: int = 0) -> pa.RecordBatch:
        first, last, h, x = anchors(data, at, length)
        doc = np.searchsorted(at, first, "right") - 1
        columns = [h.view(np.int64), x.view(np.int64), d1[doc], d2[doc], first - at[doc] + shift, last - at[doc] + shift]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "x", "d1", "d2", "first", "last"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch, "text", SCAN_BYTES):
                data, at = offsets_of(slab.column("text"))
                d1, d2 = slab.column("d1").to_numpy(), slab.column("d2").to_numpy()
                if len(data) <= PIECE_BYTES:
                    yield rows(d1, d2, data, at)
                    continue
                for i in range(len(d1)):
                    own = data[at[i] : at[i + 1]]
                    for a in range(0, max(len(own) - length + 1, 1), PIECE_BYTES - length + 1):
                        part = own[a : a + PIECE_BYTES]
                        yield rows(d1[i : i + 1], d2[i : i + 1], part, np.array([0, len(part)]), a)
        release()

    return documents.select("d1", "d2", "text").mapInArrow(task, _ROW)


_KINDS = "kind string, h long, x long, n long, mixed boolean, d1 long, d2 long, first long, last long"


def sort_extents(rows: DataFrame) -> DataFrame:
    """Sort all extents and compare neighbours.

    kind `repeat`: an extent that stands elsewhere too. `varied`: one row for each extent of an anchor with several;
    n is 2 if it repeats. `edge`: the first and last extent of a sorted range, whose neighbours are in another range.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # rows of the last, open run: its last row
        count, before_same_h, opening = 0, False, True

        def out(kind: str, at: np.ndarray, n: np.ndarray, several: np.ndarray) -> pa.RecordBatch:
            h, x, d1, d2, first, last = (pa.array(c) for c in at.T.copy())
            k = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * k, pa.string()), h, x, pa.array(n), pa.array(several), d1, d2, first, last],
                names=["kind", "h", "x", "n", "mixed", "d1", "d2", "first", "last"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([c.to_numpy() for c in batch.columns], 1)
            if held is not None:
                table = np.concatenate([held, table])
            # The open run counts `count` rows, of which the last one heads this table.
            same_h = table[1:, 0] == table[:-1, 0]
            same = same_h & (table[1:, 1] == table[:-1, 1])
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            sizes = np.diff(np.append(starts, len(table)))
            if held is not None:
                sizes[0] += count - 1
            linked = np.concatenate([[before_same_h], same_h[starts[1:] - 1]])  # the run before has the same anchor
            several = linked.copy()
            several[:-1] |= linked[1:]
            # Rows that repeat, but for the last row: it waits for the next batch. The head may have been held alone.
            double = np.zeros(len(table), bool)
            double[1:] |= same
            double[:-1] |= same
            if held is not None and count > 1:
                double[0] = True
            found = table[:-1][double[:-1]]
            if len(found):
                yield out("repeat", found, np.full(len(found), 2), np.ones(len(found), bool))
            closed = np.arange(len(starts) - 1)
            if len(closed):
                ends = starts[1:] - 1
                if opening:
                    yield out("edge", table[ends[:1]], np.minimum(sizes[:1], 2), several[:1])
                    closed = closed[1:]
                    opening = False
                closed = closed[several[closed]]
                if len(closed):
                    yield out("varied", table[ends[closed]], np.minimum(sizes[closed], 2), np.ones(len(closed), bool))
            held, count, before_same_h = table[-1:], int(sizes[-1]), bool(linked[-1])
        if held is not None:
            if count > 1:
                yield out("repeat", held, np.array([2]), np.array([True]))
            yield out("edge", held, np.array([min(count, 2)]), np.array([before_same_h]))

    ordered = rows.repartitionByRange("h", "x", "d1", "first").sortWithinPartitions("h", "x", "d1", "first")
    return ordered.mapInArrow(task, _KINDS)


def _next(marked: np.ndarray) -> np.ndarray:
    """For every position the nearest marked one at or after it; the length if there is none."""
    n = len(marked)
    return np.minimum.accumulate(np.where(marked, np.arange(n, dtype=np.int32), np.int32(n))[::-1])[::-1]


def by_words(data: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the `depth` bytes from each: by words of eight bytes, of which later ones settle ties."""
    words = np.ndarray((len(data) - 7,), ">u8", data.tobytes(), strides=(1,))
    at, group = at.copy(), np.zeros(len(at), np.int32)
    tied = np.arange(len(at), dtype=np.int32)
    for k in range(0, depth, 8):
        own = at[tied]
        keys = words[own + min(k, depth - 8)].astype(np.uint64)
        order = np.lexsort((keys, group)).astype(np.int32)
        at[tied], keys, group = own[order], keys[order], group[order]
        del own, order
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])])
        alone = fresh & np.append(fresh[1:], True)
        group = np.cumsum(fresh, dtype=np.int32)[~alone]
        tied = tied[~alone]
        if not len(tied):
            break
    return at


def _covered(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of n positions lie in a range first..last."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, first, 1)
    np.subtract.at(change, last + 1, 1)
    return np.cumsum(change[:n], out=change[:n]) > 0


def two_stage(data: np.ndarray, first: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """Positions first..last of several ranges, in order of the `depth` bytes from each, by two-stage sorting.

    Sorted directly are suffixes smaller than their successors. Each other one is larger than its successor and placed
    when the scan of the buckets meets that, so a range also takes the positions up to its next smaller suffix. data
    ends in `depth` zeros and a one.
    """
    n = len(data)
    # Positions are 32 bits wide and what is not used again goes: a block's memory is mostly this.
    rising = np.ones(n + 1, bool)
    np.greater(data[1:], data[:-1], out=rising[: n - 1])
    differs = np.zeros(n, bool)
    np.not_equal(data[1:], data[:-1], out=differs[:-1])
    smaller = rising[_next(differs)]  # equal bytes: as at the end of their run
    del rising, differs
    taken = _covered(n, first, _next(smaller)[last])
    induced = taken & ~smaller
    direct = np.flatnonzero(taken & smaller).astype(np.int32)
    del taken, smaller
    direct = by_words(data, direct, depth)
    bounds = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    result = []
    for byte in range(256):
        own = direct[bounds[byte] : bounds[byte + 1]]
        wave = np.concatenate(waiting[byte]) if waiting[byte] else own[:0]
        bucket = []
        while len(wave):  # runs of this byte
            bucket.append(wave)
            before = wave - 1
            wave = before[(before >= 0) & induced[before] & (data[before] == byte)]
        bucket = np.concatenate([*bucket, own])
        result.append(bucket)
        before = bucket - 1
        before = before[(before >= 0) & induced[before]]
        before = before[data[before] > byte]
        head = data[before]
        order = np.argsort(head, kind="stable")
        before, head = before[order], head[order]
        cuts = np.flatnonzero(np.diff(head, prepend=-1)).tolist() if len(head) else []
        for a, b in zip(cuts, [*cuts[1:], len(head)]):
            waiting[int(head[a])].append(before[a:b])
    ordered = np.concatenate(result)
    del result, direct, induced
    return ordered[_covered(n, first, last)[ordered]]


def common_prefixes(data: np.ndarray, ordered: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the adjacent common prefixes, up to `most`, in steps of eight bytes."""
    words = np.ndarray((len(data) - 7,), ">u8", data.tobytes(), strides=(1,))
    common = np.zeros(max(len(ordered) - 1, 0), np.int32)
    left = np.arange(len(common), dtype=np.int32)
    for k in range(0, most, 8):
        k = min(k, most - 8)
        left = left[words[ordered[left] + k] == words[ordered[left + 1] + k]]
        common[left] = k + 8
    return common


_FOUND = "kind string, d1 long, d2 long, first long, end long, w1 long, w2 long"


def _runs(at: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive positions whose mark is set and whose owner (at) is the same."""
    edge = np.flatnonzero(mark & np.concatenate([[True], ~mark[:-1] | (at[1:] != at[:-1])]))
    stop = np.flatnonzero(mark & np.concatenate([~mark[1:] | (at[1:] != at[:-1]), [True]]))
    return edge, stop


def suffix_repeats(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeats among the extents of each group (h, salt), from suffix arrays.

    kind `span`: bytes first..end of a text that repeated strings cover. `open`: of a group that holds only a part of
    an anchor's extents, a string's hashes (w1, w2) and place, once for each distinct string; end is 0 if it has no
    repeat here.
    """

    _names = [c.split()[0] for c in _FOUND.split(", ")]

    def block(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        many, split, d1, d2, place, text = (list(c) for c in zip(*rows))
        sizes = np.array([len(t) for t in text])
        first = np.cumsum(sizes + 1) - sizes - 1
        last = first + sizes - length
        data = np.frombuffer(b"\0".join(text) + bytes(length + 8) + b"\1" + bytes(8), np.uint8)
        ordered = two_stage(data, first, last, length)
        same = common_prefixes(data, ordered, length) >= length
        near = np.zeros(len(ordered), bool)
        near[:-1] |= same
        near[1:] |= same
        repeated = np.zeros(len(data), bool)
        repeated[ordered[near]] = True
        # Strings in text order, with the extent each belongs to.
        n = last - first + 1
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), n)
        at = np.arange(n.sum(), dtype=np.int32)
        at += (first - np.cumsum(n) + n).astype(np.int32)[owner]
        many, split, d1, d2, place = (np.array(c) for c in (many, split, d1, d2, place))
        a, b = _runs(owner, repeated[at] & ~many[owner])
        if len(a):
            own = owner[a]
            start = place[own] + at[a] - first[own]
            columns = [d1[own], d2[own], start, start + at[b] - at[a] + length]
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(["span"] * len(a)), *(pa.array(c) for c in columns), none, none], names=_names)
        # One of each run of equal strings, if the anchor's other extents are elsewhere.
        if not split.any():
            return
        heads = ordered[np.concatenate([[True], ~same])] if len(ordered) else ordered.copy()
        del ordered, same, near, owner, at
        heads.sort()
        for k in range(0, len(heads), BATCH_ROWS):
            some = heads[k : k + BATCH_ROWS].astype(np.int64)
            base = some[0]
            near_by = data[base : some[-1] + length]
            which = np.searchsorted(first, some, "right") - 1
            some, which = some[split[which]], which[split[which]]
            own = some - base
            alone = ~(repeated[some] | many[which])
            w1 = segment_hashes(near_by, own, own + length).view(np.int64)
            w2 = mixed(segment_hashes(near_by, own, own + length // 2) * np.uint64(3)).view(np.int64)
            start = place[which] + some - first[which]
            columns = [d1[which], d2[which], start, np.where(alone, start + length, 0), w1, w2]
            yield pa.RecordBatch.from_arrays([pa.array(["open"] * len(some), pa.string()), *(pa.array(c) for c in columns)], names=_names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in batches:
            for h, salt, many, split, d1, d2, place, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (h, salt) != key:
                    key = (h, salt)
                    if size >= BLOCK_BYTES:
                        yield from block(held)
                        held, size = [], 0
                        release()
                held.append((many, split, d1, d2, place, text))
                size += len(text)
        if held:
            yield from block(held)
        release()

    ordered = pieces.repartition("h", "salt").sortWithinPartitions("h", "salt")
    return ordered.select("h", "salt", "many", "split", "d1", "d2", "first", "bytes").mapInArrow(task, _FOUND)


def repeated_spans(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """d1, d2, first and end of spans of texts that repeated strings cover; spans may overlap. documents: d1, d2, text."""
    found = stored(sort_extents(extents(documents, length)), "extents")
    span = F.struct("d1", "d2", "first", (F.col("last") + length).alias("end"))
    edges = found.where("kind = 'edge'")  # two a sorted range at most
    by_extent = edges.groupBy("h", "x").agg(F.least(F.sum("n"), F.lit(2)).alias("n"), F.max("mixed").alias("mixed"), F.min(F.struct("d1", "d2", "first", "last")).alias("at"))
    by_anchor = by_extent.groupBy("h").agg((F.max("mixed") | (F.count("*") > 1)).alias("several"))
    late = edges.where("n = 1").join(by_extent.where("n > 1").select("h", "x"), ["h", "x"], "left_semi").select(span.alias("s"))
    repeats = found.where("kind = 'repeat'").select(span.alias("s")).unionByName(late).select("s.*")
    varied = found.where("kind = 'varied'").select("h", "n", "d1", "d2", "first", "last").unionByName(
        by_extent.join(by_anchor.where("several"), "h", "left_semi").select("h", "n", "at.*")
    )
    # Anchors with very many bytes of extents are dealt to several groups.
    size = F.col("last") - F.col("first") + length
    groups = varied.groupBy("h").agg(F.ceil(F.sum(size) / GROUP_BYTES).alias("groups")).where("groups > 1")
    dealt = varied.join(groups, "h", "left").select(
        "h", "d1", "d2", "first", "last", (F.col("n") > 1).alias("many"), F.col("groups").isNotNull().alias("split"),
        F.coalesce(F.pmod(F.xxhash64("d1", "d2", "first"), F.col("groups")), F.lit(0)).alias("salt"),
    )
    wanted = dealt.groupBy("d1", "d2").agg(F.collect_list(F.struct("h", "salt", "many", "split", "first", "last")).alias("cuts"))
    texts = documents.groupBy("d1", "d2").agg(F.first("text").alias("text"))
    pieces = texts.join(wanted, ["d1", "d2"]).mapInArrow(_cut(length), "h long, salt long, many boolean, split boolean, d1 long, d2 long, first long, bytes binary")
    matched = stored(suffix_repeats(pieces, length), "suffix-repeats")
    opened = matched.where("kind = 'open'")
    again = opened.groupBy("w1", "w2").agg(F.count("*").alias("k")).where("k > 1").select("w1", "w2")
    across = opened.where("end > 0").join(again, ["w1", "w2"], "left_semi")
    return repeats.unionByName(matched.where("kind = 'span'").select("d1", "d2", "first", "end")).unionByName(across.select("d1", "d2", "first", "end"))


def _cut(length: int):
    """Cut the wanted extents' bytes out of the texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "salt", "many", "split", "d1", "d2", "first", "bytes"]
        for batch in batches:
            for slab in slabs(batch, "text"):
                data, at = offsets_of(slab.column("text"))
                raw = memoryview(data.tobytes())
                cuts = slab.column("cuts")
                flat = cuts.flatten()
                h, salt, many, split, first, last = (flat.field(k) for k in range(6))
                doc = np.repeat(np.arange(slab.num_rows), cuts.value_lengths().to_numpy())
                a = at[doc] + first.to_numpy()
                b = at[doc] + last.to_numpy() + length
                d1, d2 = (pa.array(slab.column(c).to_numpy()[doc]) for c in ("d1", "d2"))
                pieces = [raw[i:j] for i, j in zip(a.tolist(), b.tolist())]
                yield pa.RecordBatch.from_arrays([h, salt, many, split, d1, d2, first, pa.array(pieces, pa.binary())], names=names)

    return task


def deduplicate(documents: DataFrame, length: int = LENGTH, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, removed (spans of bytes), n_removed, kept (bytes) and its digest, of every document."""
    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = rows.select("doc_id", "text", *text_key(F.col("text")))
    spans = repeated_spans(keyed.where(F.octet_length("text") >= length).select("d1", "d2", "text"), length)
    by_text = spans.groupBy("d1", "d2").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans"))
    joined = keyed.join(by_text, ["d1", "d2"], "left").select("doc_id", "text", "spans")
    _span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        data, at = offsets_of(slab.column("text"))
        raw = data.tobytes()
        removed, kept = [], []
        for k, spans in enumerate(slab.column("spans")):
            own = raw[at[k] : at[k + 1]]
            joined, parts, done = [], [], 0
            if spans.is_valid:
                flat = spans.values
                for a, b in zip(flat.field(0).to_pylist(), flat.field(1).to_pylist()):
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], b)
                    else:
                        joined.append([a, b])
            for a, b in joined:
                parts.append(own[done:a])
                done = b
            kept.append(b"".join([*parts, own[done:]]))
            removed.append([{"first": a, "end": b} for a, b in joined])
        sizes = np.diff(at)
        left = np.array([len(x) for x in kept], np.int64)
        digests = [hashlib.sha256(x).hexdigest() for x in kept]
        columns = [slab.column("doc_id"), pa.array(sizes), pa.array(sizes - left), pa.array(removed, _span), pa.array(kept, pa.binary()), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "removed", "kept", "kept_sha256"])

    return per_slab(joined, "text", "doc_id long, n_bytes long, n_removed long, removed array<struct<first: long, end: long>>, kept binary, kept_sha256 string", work)
