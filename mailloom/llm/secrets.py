"""Secret scans: fixed forms, and sliding-window entropy over candidate strings.

Candidates are runs of characters that keys are made of. For each character class a window of fixed width slides over
the candidate; the counts of the characters in it, and with them the Shannon entropy, are updated by the one character
that enters and the one that leaves. Windows at or above the class's threshold are flagged and their union becomes a
span of kind `entropy`. The allow list suppresses candidates that are known harmless forms (UUIDs, digests announced as
such, dates, paths, numbers). A run of one letter case without digits is a word, whatever its entropy; one that mixes both cases is flagged by
a higher threshold than identifiers of joined words reach.

Row-local, so no shuffle: a task streams its rows in bounded slabs and a hot source does not matter.

Defined cases: a null text is empty and has no spans; repeated rows each give a row; spans count code points, end
exclusive; spans of different kinds may overlap, those of one kind never do; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailloom.llm.common import per_slab

# --- fixed values: forms of the contract, and minimal lengths -------------------
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")
# ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Charset:
    """A character class: which candidates it takes, the window, the entropy that flags it, and classes it must mix."""

    form: re.Pattern
    window: int
    bits: float
    mixes: tuple[re.Pattern, ...]


_DIGIT, _LOWER, _UPPER = re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")
CHARSETS = (
    Charset(re.compile(r"[0-9A-Fa-f]+"), 24, 3.0, (_DIGIT, re.compile("[A-Fa-f]"))),
    Charset(re.compile(r"[0-9a-z]+"), 20, 3.3, (_DIGIT, _LOWER)),
    Charset(re.compile(r"[0-9A-Z]+"), 20, 3.25, (_DIGIT, _UPPER)),
    Charset(re.compile(r"[0-9A-Za-z]+"), 20, 3.6, (_DIGIT, _LOWER, _UPPER)),
    Charset(re.compile(r"[A-Za-z]+"), 20, 3.95, (_LOWER, _UPPER)),
    Charset(re.compile(r"[0-9A-Za-z+/_=-]+"), 24, 3.9, (_DIGIT, _LOWER, _UPPER)),
)
#: Runs that can hold a flagged window at all, by length; every class mixes a digit with letters, or letters of both cases.
CANDIDATE = re.compile(r"[0-9A-Za-z+/_=-]{20,}")
_DIGESTS = (("md5", 16), ("sha1", 20), ("sha256", 32), ("sha384", 48), ("sha512", 64))
ALLOWED = (
    re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"),
    re.compile(r"[0-9-]+"),
    # In hexadecimal, or in Base64 up to its length.
    re.compile("|".join(f"{name}-(?:[0-9A-Fa-f]{{{2 * n}}}|[0-9A-Za-z+/_-]{{1,{-(-4 * n // 3)}}}={{0,2}})" for name, n in _DIGESTS)),
    re.compile(r"/?(?:[a-z_-]+[0-9]{0,4}/)+[a-z_-]*[0-9]{0,4}"),
)

_TERM = [0.0] + [k * math.log2(k) for k in range(1, 4097)]


def windows_above(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Union of the windows of a run whose entropy is at least `bits`, as (start, end)."""
    if len(run) < window:
        return []
    counts: dict[str, int] = {}
    total = 0.0
    for c in run[:window]:
        n = counts.get(c, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
    top = math.log2(window)
    # entropy = log2(window) - sum(k log2 k) / window
    limit = (top - bits) * window + 1e-9
    spans: list[tuple[int, int]] = []
    for end in range(window, len(run) + 1):
        if total <= limit:
            start = end - window
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
        if end < len(run):
            gone, came = run[end - window], run[end]
            if gone != came:
                n = counts[gone]
                total += _TERM[n - 1] - _TERM[n]
                counts[gone] = n - 1
                n = counts.get(came, 0)
                total += _TERM[n + 1] - _TERM[n]
                counts[came] = n + 1
    return spans


def entropy_spans(text: str) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if not (_DIGIT.search(run) or (_LOWER.search(run) and _UPPER.search(run))) or any(a.fullmatch(run) for a in ALLOWED):
            continue
        for charset in CHARSETS:
            for part in charset.form.finditer(run):
                piece = part.group()
                if len(piece) >= charset.window and all(c.search(piece) for c in charset.mixes):
                    base = m.start() + part.start()
                    found += [(base + a, base + b) for a, b in windows_above(piece, charset.window, charset.bits)]
    found.sort()
    joined: list[tuple[int, int]] = []
    for a, b in found:
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return joined


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), in order; kind is an index of KINDS."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found += [(a, 3, b) for a, b in entropy_spans(text)]
    found.sort()
    return found


def scan(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans (kind, start_at, end_at) of every document, by start, then kind; other columns are not carried."""
    span = pa.struct([("kind", pa.string()), ("start_at", pa.int64()), ("end_at", pa.int64())])

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[{"kind": KINDS[k], "start_at": a, "end_at": b} for a, k, b in spans_of(t)] if t else [] for t in slab.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([slab.column("doc_id"), pa.array(rows, pa.list_(span))], names=["doc_id", "spans"])

    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return per_slab(rows, "text", "doc_id long, spans array<struct<kind: string, start_at: long, end_at: long>>", work)


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start_at"], s["end_at"])), ",")


def redact(documents: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows with every secret in the text replaced by a mark; a null text stays null.

    A key shared by several overlapping spans is replaced once, from the first start to the last end.
    """

    def clean(value: str) -> str:
        out, at = [], 0
        for a, _, b in spans_of(value):
            if a >= at:
                out += [value[at:a], mark]
            at = max(at, b)
        return "".join(out) + value[at:] if out else value

    def task(batches):
        for batch in batches:
            i = batch.schema.get_field_index(text)
            values = [None if v is None else clean(v) for v in batch.column(i).to_pylist()]
            yield batch.set_column(i, batch.schema.field(i), pa.array(values, batch.schema.field(i).type))

    return documents.mapInArrow(task, documents.schema)

