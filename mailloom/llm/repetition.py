"""Quality rules on repetition within a text, by a suffix array over its words.

The suffixes of all texts of a slab are ranked together by prefix doubling (words of different texts never compare
equal, so no repeat crosses a text); each round sorts only suffixes that still tie. The ranks of the rounds also give
the longest common prefixes of neighbours in suffix order. One scan of that array with a stack yields its intervals, a
tree; an interval is a maximal repeated substring if its places do not all follow one word. The union of the spans of
all their places is covered (of nested repeats that start at one place, the longest counts). A text fails if too large a
part of its word characters is covered, or if one maximal repeat is too long.

Row-local: a task streams bounded slabs, and a long text is ranked alone (about 100 bytes of memory per word).

Defined cases: a null or empty text has no words and fails the base rule on length; repeated rows each give a row;
an empty table gives no rows; other columns are not carried. Words are compared by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailloom.llm.common import SPACED, mixed, offsets_of, per_slab, word_hashes, words_of

# --- fixed values of the base rules -------------------------------------------
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
WHITE = " \t\n\x0b\x0c\r"
# --------------------------------------------------------------------------------
#: A repeat has at least so many words.
REPEAT_WORDS = 10
#: Limits: part of the word characters that repeats cover, and words of the longest repeat as a part of all words.
MOST_COVERED, MOST_LONGEST = 0.4, 0.25

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_share double, longest_words long, n_repeats long, repeats array<struct<first_word: long, end_word: long>>"
)
_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... symbols; the last ranks are all different.

    `ends` is the end of the text each position belongs to. A rank is the number of smaller suffixes.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, length = [rank], 1
    while True:
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(tied):
            return levels
        ahead = tied + length
        inside = ahead < ends[tied]
        second = np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        first = rank[tied]
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new_group = np.ones(len(tied), bool)
        new_group[1:] = a[1:] != a[:-1]
        fresh = new_group.copy()
        fresh[1:] |= b[1:] != b[:-1]
        index = np.arange(len(tied))
        group_at = np.maximum.accumulate(np.where(new_group, index, 0))
        fresh_at = np.maximum.accumulate(np.where(fresh, index, 0))
        rank = rank.copy()
        rank[tied[order]] = a + fresh_at - group_at
        levels.append(rank)
        length *= 2


def neighbours(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in suffix order, and the longest common prefixes of each suffix and the next."""
    n = len(levels[0])
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[k], -1)
        same = (rank[a] == rank[b]) & (a < n) & (b < n)
        step = same.astype(np.int64) << k
        common += step
        a = np.minimum(a + step, n)
        b = np.minimum(b + step, n)
    return suffixes, common


def prefix_intervals(common: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """The tree of intervals of suffixes that share a prefix of `least` symbols or more, each with the whole of it.

    Arrays over intervals: length of the prefix, first and last place in suffix order, enclosing interval or -1; then
    their numbers, each after those inside it; then the array of the entries of `common` at or above `least`, and for
    each the interval whose length it is.
    """
    entries = np.flatnonzero(common >= least)
    run_ends = np.append(np.diff(entries) > 1, True) if len(entries) else []
    length, first, last, outer, done, owner, open_ = [], [], [], [], [], [], []
    for e, v, ends in zip(entries.tolist(), common[entries].tolist(), list(run_ends)):
        begin, inner = e, -1
        while open_ and length[open_[-1]] > v:
            inner = open_.pop()
            last[inner], begin = e, first[inner]
            done.append(inner)
            outer[inner] = open_[-1] if open_ else -1
        if not open_ or length[open_[-1]] < v:
            if inner >= 0:
                outer[inner] = len(length)
            open_.append(len(length))
            length.append(v)
            first.append(begin)
            last.append(-1)
            outer.append(-1)
        owner.append(open_[-1])
        while ends and open_:
            inner = open_.pop()
            last[inner], outer[inner] = e + 1, open_[-1] if open_ else -1
            done.append(inner)
    return *(np.array(x, np.int64) for x in (length, first, last, outer, done)), entries, np.array(owner, np.int64)


def maximal_repeats(symbols: np.ndarray, begins: np.ndarray, levels: list[np.ndarray], least: int) -> tuple[np.ndarray, ...]:
    """Maximal repeated substrings of `least` symbols or more, and for every position the longest that starts there.

    An interval's prefix cannot be extended to the right at all its places; it is maximal if it cannot be to the left
    either: its places do not all follow one symbol. `begins` marks the first positions of texts. Returns lengths and one
    place of each maximal repeat, and the array over positions (0: none starts there).
    """
    suffixes, common = neighbours(levels)
    length, first, last, outer, done, entries, owner = prefix_intervals(common, least)
    a, b = suffixes[:-1], suffixes[1:]
    differ = begins[a] | begins[b] | (symbols[a - 1] != symbols[b - 1])
    before = np.concatenate([[0], np.cumsum(differ)])
    maximal = before[last] > before[first]
    own, outside = np.where(maximal, length, 0).tolist(), outer.tolist()
    for i in done[::-1].tolist():  # enclosing ones first: a repeat that is not maximal gives way to the one around it
        if not own[i] and outside[i] >= 0:
            own[i] = own[outside[i]]
    reach = np.zeros(len(symbols), np.int64)
    longest = np.array(own, np.int64)[owner]
    np.maximum.at(reach, suffixes[entries], longest)
    np.maximum.at(reach, suffixes[entries + 1], longest)
    return length[maximal], suffixes[first[maximal]], reach


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Positions inside any of the spans."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def letters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 segments: bytes that continue none."""
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return before[ends] - before[starts]


def _lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def measure_slab(slab: pa.RecordBatch) -> pa.RecordBatch:
    texts = [t or "" for t in slab.column("text").to_pylist()]
    data, at = offsets_of(slab.column("text"))
    starts, ends = words_of(data, at, SPACED)
    docs = len(texts)
    first = np.searchsorted(starts, at)
    n_words = np.diff(first)
    zeros = np.zeros(docs, np.int64)
    repeat_words, longest, n_repeats, share, spans = zeros, zeros, zeros, np.zeros(docs), [[]] * docs
    if len(starts):
        doc = np.repeat(np.arange(docs), n_words)
        symbols = mixed(word_hashes(data, starts, ends) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        levels = suffix_ranks(symbols, first[1:][doc])
        n = len(starts)
        if len(levels) > 3:
            windows = np.flatnonzero(np.bincount(levels[3], minlength=n)[levels[3]] > 1)
            repeat_words = np.bincount(doc[_covered(windows, np.full(len(windows), WINDOW), n)], minlength=docs)
        begins = np.zeros(n, bool)
        begins[first[:-1][n_words > 0]] = True
        lengths, places, reach = maximal_repeats(symbols, begins, levels, REPEAT_WORDS)
        at_repeat = np.flatnonzero(reach)
        if len(at_repeat):
            inside = _covered(at_repeat, reach[at_repeat], n)
            size = letters(data, starts, ends)
            share = np.bincount(doc, size * inside, docs) / np.maximum(np.bincount(doc, size, docs), 1)
            longest = zeros.copy()
            np.maximum.at(longest, doc[places], lengths)
            n_repeats = np.bincount(doc[places], minlength=docs)
            edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
            opened, closed = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            spans = [[] for _ in range(docs)]
            for a, b in zip(opened.tolist(), closed.tolist()):
                while a < b:  # a span that ends a text may touch one that begins the next
                    d = doc[a]
                    stop = min(b, int(first[d + 1]))
                    spans[d].append({"first_word": a - int(first[d]), "end_word": stop - int(first[d])})
                    a = stop
    chars = [len(t) - sum(map(t.count, WHITE)) for t in texts]
    marks = [sum(map(t.count, SYMBOLS)) for t in texts]
    columns = [n_words, chars, marks, [_lines(t) for t in texts], repeat_words]
    return pa.RecordBatch.from_arrays(
        [slab.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array(share), *(pa.array(c, pa.int64()) for c in (longest, n_repeats)), pa.array(spans, _SPANS)],
        names=[c.split()[0] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_share", "longest_words", "n_repeats", "repeats")],
    )


def measure(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of every document, its share of repeated characters, the longest and the number of its maximal repeats, and
    the union of their spans."""
    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return per_slab(rows, "text", SCHEMA, measure_slab)


def judge(measured: DataFrame, most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST) -> DataFrame:
    """Add base_failed and kept."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    repeats = (F.col("covered_share") > most_covered) | (F.col("longest_words") > most_longest * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repeats)
