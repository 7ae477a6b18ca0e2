"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokenisation without a regex: every code point gets a class from an array, every class is a transition function of
a small automaton, and functions compose associatively. The functions that compositions can yield are numbered once
(the monoid of the automaton), so a scan over a slab is one table lookup per code point and step: chunks are scanned
side by side, then the chunk totals, then each chunk's start state gives all states. A boundary is a table lookup of
state and class. Texts are scanned in one go: the class of a text's first code point resets the state.

The slices between boundaries go to a cache from slice to token ids; on a miss the lowest-ranked pair is merged until
none is left, with a heap, so a slice of n bytes takes n log n steps. The cache is two generations of bounded size.
Slice offsets are kept with the ids; decoding joins the vocabulary's bytes.

Row-local, no shuffle. Defined cases: a null or empty text has no ids; special-token strings are ordinary text; repeated
rows each give a row; an empty table gives no rows; other columns are not carried. Ids are little-endian unsigned
32-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailloom.llm.common import per_slab

# --- fixed values: the classes the split pattern is made of -----------------------
#: Code points of \s: Unicode's White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What follows the apostrophe of a contraction: one letter, or two.
SHORT, LONG = "stmd", ("re", "ve", "ll")
# -----------------------------------------------------------------------------------

# Classes of code points. The last white space before something else has a class of its own, and so have an
# apostrophe that a contraction's letters follow (QUOTE) and the last of these letters (TAIL).
LETTER, NUMBER, OTHER, SPACE, BLANK, SPACE_IN, BLANK_IN, QUOTE, TAIL, CLASSES = range(10)
# States: what the last code point belongs to. FRESH is after a contraction, and at the start of a text.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, AFTER_BLANK, CONTRACTED, STATES = range(8)
CHUNK = 64
CACHE_ENTRIES, CACHED_LENGTH = 150_000, 48


def _next(state: int, cls: int) -> int:
    if state == CONTRACTED:
        return FRESH if cls == TAIL else CONTRACTED
    if cls == QUOTE:
        # An apostrophe within a run of others, or led by a space, opens nothing.
        return IN_OTHER if state in (IN_OTHER, AFTER_SPACE) else CONTRACTED
    return {
        LETTER: IN_LETTERS, TAIL: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER,
        SPACE: AFTER_SPACE, SPACE_IN: AFTER_SPACE, BLANK: AFTER_BLANK, BLANK_IN: AFTER_BLANK,
    }[cls]


def _boundary(state: int, cls: int) -> bool:
    """Does a slice begin at a code point of this class after this state?"""
    if state in (CONTRACTED, FRESH):
        return state == FRESH
    white = cls in (SPACE, SPACE_IN, BLANK, BLANK_IN)
    if state in (AFTER_SPACE, AFTER_BLANK):
        # The last of several white spaces stands alone or leads the next slice.
        return cls in (SPACE, BLANK) if white else state == AFTER_BLANK
    kind = {QUOTE: OTHER, TAIL: LETTER}.get(cls, cls)
    return {IN_LETTERS: LETTER, IN_NUMBERS: NUMBER, IN_OTHER: OTHER}[state] != kind


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Elements of single classes (then of classes that open a text), products, actions and boundaries."""
    functions = [tuple(_next(s, c) for s in range(STATES)) for c in range(CLASSES)]
    functions += [(_next(FRESH, c),) * STATES for c in range(CLASSES)]
    number = {f: i for i, f in enumerate(dict.fromkeys(functions))}
    generators = [number[f] for f in functions]
    elements = list(number)
    for f in elements:  # grows while it is read
        for g in set(functions):
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(elements)
                elements.append(h)
    assert len(elements) <= 256
    products = np.zeros((256, 256), np.uint8)
    for i, f in enumerate(elements):
        products[i, : len(elements)] = [number[tuple(g[s] for s in f)] for g in elements]
    boundaries = np.array([[_boundary(s, c) for c in range(CLASSES)] for s in range(STATES)])
    return np.array(generators, np.uint8), products, np.array(elements, np.uint8), boundaries


GENERATORS, PRODUCTS, ACTIONS, BOUNDARIES = _monoid()


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            kinds[point] = LETTER
        elif kind == "N":
            kinds[point] = NUMBER
    kinds[WHITE] = BLANK_IN
    kinds[0x20] = SPACE_IN
    return kinds


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return PRODUCTS.ravel().take((a.astype(np.uint16) << 8) | b)


def _prefixes(elements: np.ndarray) -> np.ndarray:
    """Inclusive products of a sequence of monoid elements."""
    n = len(elements)
    if n <= CHUNK:
        out = elements.copy()
        for i in range(1, n):
            out[i] = PRODUCTS[out[i - 1], out[i]]
        return out
    rows = n // CHUNK
    out = np.ascontiguousarray(elements[: rows * CHUNK].reshape(rows, CHUNK).T)
    for i in range(1, CHUNK):
        out[i] = _times(out[i - 1], out[i])
    before = _prefixes(out[-1])[:-1]
    out[:, 1:] = _times(before[None, :], out[:, 1:])
    done = out.T.reshape(-1)
    rest = elements[rows * CHUNK :].copy()
    last = done[-1]
    for i in range(len(rest)):
        last = rest[i] = PRODUCTS[last, rest[i]]
    return np.concatenate([done, rest])


def boundaries(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where slices begin in the code points of several texts; `firsts` are the texts' first positions."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kinds = _classes()[points]
    opens = np.zeros(n + 1, bool)
    opens[firsts] = True
    opens[n] = True
    white = (kinds == SPACE_IN) | (kinds == BLANK_IN)
    # White space before something else of the same text.
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~opens[1:n])
    kinds[last] = np.where(kinds[last] == SPACE_IN, SPACE, BLANK)
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        end = np.concatenate([opens, [True, True]])
        inside1 = ~end[quotes + 1]
        inside2 = inside1 & ~end[quotes + 2]
        found = [(quotes[inside1 & np.isin(one, [ord(c) for c in SHORT])], 1)]
        found += [(quotes[inside2 & (one == ord(pair[0])) & (two == ord(pair[1]))], 2) for pair in LONG]
        for at, length in found:
            kinds[at] = QUOTE
            kinds[at + length] = TAIL
    states = ACTIONS[_prefixes(GENERATORS[kinds + np.where(opens[:n], CLASSES, 0).astype(np.uint8)]), FRESH]
    before = np.empty(n, np.uint8)
    before[0] = FRESH
    before[1:] = states[:-1]
    before[opens[:n]] = FRESH
    return np.flatnonzero(BOUNDARIES[before, kinds])


class Vocabulary:
    """Ranks of byte strings, and the cache of encoded slices."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            self.ranks = {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            self.bytes_of[rank] = word
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one slice."""
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        n = len(word)
        ends = list(range(1, n + 1))  # of the part that starts here; 0: merged away
        before = list(range(-1, n - 1))
        heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= n or middle >= end or ends[middle] != end:
                continue  # one of the two has changed since
            ends[i], ends[middle] = end, 0
            if end < n:
                before[end] = i
                if (rank := ranks.get(word[i : ends[end]])) is not None:
                    heapq.heappush(heap, (rank, i, ends[end]))
            if (left := before[i]) >= 0 and (rank := ranks.get(word[left:end])) is not None:
                heapq.heappush(heap, (rank, left, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : ends[i]]])
            i = ends[i]
        return out

    def slice_ids(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.merge(piece.encode()), "<u4").tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self.young) >= CACHE_ENTRIES:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """For each text its ids and the code points at which its slices begin."""
        joined = "".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        firsts = np.cumsum(lengths) - lengths
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = boundaries(points, firsts[lengths > 0])
        at = starts.tolist() + [len(joined)]
        ids = []
        for a, b in zip(at, at[1:]):
            piece = joined[a:b]
            ids.append(self.young.get(piece) or self.slice_ids(piece))
        cuts = np.searchsorted(starts, np.append(firsts, len(joined))).tolist()
        for k, first in enumerate(firsts.tolist()):
            yield b"".join(ids[cuts[k] : cuts[k + 1]]), starts[cuts[k] : cuts[k + 1]] - first

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """Read once per worker process; every executor has the vocabulary file at this path."""
    return Vocabulary(path)


def encode(documents: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (binary), n_tokens and slice_starts (binary, code points, unsigned 32-bit) of every document."""

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        found = list(vocabulary(path).encode([t or "" for t in slab.column("text").to_pylist()]))
        return pa.RecordBatch.from_arrays(
            [slab.column("doc_id"), pa.array([i for i, _ in found], pa.binary()), pa.array([len(i) // 4 for i, _ in found], pa.int64()), pa.array([s.astype("<u4").tobytes() for _, s in found], pa.binary())],
            names=["doc_id", "ids", "n_tokens", "slice_starts"],
        )

    rows = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    return per_slab(rows, "text", f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, n_tokens long, slice_starts binary", work)


def decode(encoded: DataFrame, path: str, doc: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and the bytes that ids stand for; null ids give none."""

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        words = [vocabulary(path).decode(i or b"") for i in slab.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([slab.column("doc_id"), pa.array(words, pa.binary())], names=["doc_id", "bytes"])

    rows = encoded.select(F.col(doc).alias("doc_id"), F.col(ids).alias("ids"))
    return per_slab(rows, "ids", f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bytes binary", work)


def round_trip(documents: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, then decode the ids, in one task: n_tokens and the digests of ids and of the decoded bytes."""

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        rows = [
            (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(words.decode(ids)).hexdigest())
            for ids, _ in words.encode([t or "" for t in slab.column("text").to_pylist()])
        ]
        n, coded, decoded = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [slab.column("doc_id"), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    return per_slab(rows, "text", f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string", work)
