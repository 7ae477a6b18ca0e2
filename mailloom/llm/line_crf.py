"""Document quality from a linear-chain conditional random field over lines.

Every line has features of its characters and words; a line's potential for being good also uses the features of the
lines before and after it. Forward-backward gives each line's marginal probability of being good, and the document's
score is their mean weighted by the lines' lengths, calibrated by a logistic curve.

Training takes a bounded sample: the documents of at most `SAMPLE` labels, lowest hash of doc_id first, so that the same
ones are taken at any partitioning, of at most `SAMPLE_BYTES` each. Only their feature rows reach the driver, where
weights, transitions and the curve are fitted by gradient ascent; all lines of a document carry its label. Everything
else is row-local over whole texts.

Defined cases: a null or empty text is one empty line; repeated documents each give a row; of several labels of one
doc_id the smallest counts; null labels are ignored; a null doc_id is not held out and takes no label; without labels
of both kinds every score is 0.5; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailloom.llm.common import SPACED, lookup, offsets_of, per_slab, slabs, words_of

#: Labelled documents in the training sample, and the size of one.
SAMPLE, SAMPLE_BYTES = 6_000, 200_000
FOLDS, THRESHOLD = 5, 0.3
ROUNDS, RATE, DECAY = 150, 0.1, 1e-3

_CLASSES = (
    lookup(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    lookup(b"0123456789"),
    lookup(b"#*$%&<>@^~="),
    lookup(b"|"),
    lookup(b"!"),
    lookup(b".,;:?"),
    lookup(b"\"'()[]{}/\\_-+`"),
    lookup(bytes(range(0x80, 0x100))),
)
#: Of a line: length, characters a word, shares of the classes, share of words that are new in the line and of lines
#: seen before in the text, and how the line ends.
FEATURES = 2 + len(_CLASSES) + 4


def line_features(texts: list[str | None], column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of several texts, the n + 1 line offsets of the texts, and the lines' lengths in bytes."""
    data, at = offsets_of(column)
    cuts = np.flatnonzero(data == 10)
    n_lines = np.searchsorted(cuts, at[1:]) - np.searchsorted(cuts, at[:-1]) + 1
    first = np.concatenate([[0], np.cumsum(n_lines)])
    starts = np.sort(np.concatenate([at[:-1], cuts + 1]), kind="stable")
    ends = np.sort(np.concatenate([cuts, at[1:]]), kind="stable")
    size = np.maximum(ends - starts, 0)
    safe = np.maximum(size, 1)
    word_starts, _ = words_of(data, at, SPACED)
    n_words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
    out = np.zeros((len(starts), FEATURES), np.float32)
    out[:, 0] = np.log1p(size)
    out[:, 1] = np.log1p(size / np.maximum(n_words, 1))
    sums = np.zeros(len(data) + 1, np.int64)
    for k, inside in enumerate(_CLASSES):
        np.cumsum(inside[data], out=sums[1:])
        out[:, 2 + k] = np.sqrt((sums[ends] - sums[starts]) / safe)
    k = 2 + len(_CLASSES)
    i = 0
    for text in texts:
        seen: set[str] = set()
        for line in (text or "").split("\n"):
            words = line.split()
            if words:
                out[i, k] = len(set(words)) / len(words)
                out[i, k + 1] = line in seen
                out[i, k + 2] = line[-1] in ".?!"
                out[i, k + 3] = min(len(words), 20) / 20
                seen.add(line)
            i += 1
    return out, first, size


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # before, own, after
    bias: float
    transitions: tuple[float, float, float, float]  # log potentials bad-bad, bad-good, good-bad, good-good
    curve: tuple[float, float]

    def potentials(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-odds of good of every line by its own and its neighbours' features."""
        return neighbourhood((features - self.mean) / self.scale, first) @ self.weights + self.bias

    def marginals(self, potentials: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.concatenate([_marginals(potentials[a:b].tolist(), self.transitions) for a, b in zip(first, first[1:])]) if len(first) > 1 else np.zeros(0)

    def scores(self, texts: list[str | None], column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        features, first, size = line_features(texts, column)
        good = self.marginals(self.potentials(features, first), first)
        return calibrated(weighted(good, first, size), self.curve), good, first


def neighbourhood(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of the line before, the line and the line after, zero beyond a text's ends."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.hstack([before, x, after])


def weighted(good: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    weight = size + 1.0
    return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def calibrated(share: np.ndarray, curve: tuple[float, float]) -> np.ndarray:
    odds = np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1 - 1e-6))
    return 1 / (1 + np.exp(-np.clip(curve[0] * odds + curve[1], -30, 30)))


def _step(odds: float, t: tuple[float, float, float, float]) -> float:
    """What a neighbour's log-odds of good say of the next line."""
    bb, bg, gb, gg = t
    if odds > 0:
        e = math.exp(-odds)
        return math.log((math.exp(gg) + e * math.exp(bg)) / (math.exp(gb) + e * math.exp(bb)))
    e = math.exp(odds)
    return math.log((e * math.exp(gg) + math.exp(bg)) / (e * math.exp(gb) + math.exp(bb)))


def _marginals(own: list[float], t: tuple[float, float, float, float]) -> np.ndarray:
    """Forward-backward of one text in log-odds."""
    n = len(own)
    ahead, back = [0.0] * n, [0.0] * n
    for i in range(1, n):
        ahead[i] = _step(ahead[i - 1] + own[i - 1], t)
    turned = (t[0], t[2], t[1], t[3])
    for i in range(n - 2, -1, -1):
        back[i] = _step(back[i + 1] + own[i + 1], turned)
    odds = np.clip(np.array(own) + np.array(ahead) + np.array(back), -30, 30)
    return 1 / (1 + np.exp(-odds))


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(features, lengths, label) of the sampled documents' lines; at most `most` documents reach the driver."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most `most` rows of two numbers: small enough to broadcast at any size of the tables.
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(chosen), "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch, "text"):
                features, first, size = line_features(slab.column("text").to_pylist(), slab.column("text"))
                cut = list(zip(first.tolist(), first[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [slab.column("doc_id"), slab.column("quality"), pa.array([features[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([size[a:b].astype("<i8").tobytes() for a, b in cut], pa.binary())],
                    names=["doc_id", "quality", "features", "size"],
                )

    typed = rows.select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
    # A repeated doc_id counts once; the order makes the fit the same at any partitioning.
    own = typed.mapInArrow(task, "doc_id long, quality int, features binary, size binary").groupBy("doc_id").agg(F.min(F.struct("features", "size", "quality")).alias("x"))
    return [
        (np.frombuffer(r["x"]["features"], np.float32).reshape(-1, FEATURES), np.frombuffer(r["x"]["size"], "<i8"), r["x"]["quality"])
        for r in own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toLocalIterator()
    ]


def fit(sample: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Weights and transitions that maximise the labels' conditional likelihood, classes weighted alike."""
    labels = np.array([y for _, _, y in sample])
    if not len(sample) or labels.min() == labels.max():
        zeros = np.zeros(FEATURES)
        return Model(zeros, zeros + 1, np.zeros(3 * FEATURES), 0.0, (0.0,) * 4, (1.0, 0.0))
    sizes = np.array([len(x) for x, _, _ in sample])
    order = np.argsort(-sizes, kind="stable")
    sample, sizes, labels = [sample[i] for i in order], sizes[order], labels[order]
    first = np.concatenate([[0], np.cumsum(sizes)])
    x = np.concatenate([f for f, _, _ in sample]).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = neighbourhood((x - mean) / scale, first)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    y = (labels[doc] > 0).astype(np.float64)
    cost = np.where(labels > 0, 0.5 / max((labels > 0).mean(), 1e-9), 0.5 / max((labels <= 0).mean(), 1e-9)) / np.sqrt(sizes)
    cost /= (cost * sizes).sum()
    params = np.concatenate([np.zeros(x.shape[1] + 1), [0.5, -0.5, -0.5, 0.5]])
    m, v = np.zeros_like(params), np.zeros_like(params)
    most = int(sizes[0])
    # Texts are sorted by length: those with a line at step s are a prefix.
    have = [int((sizes > s).sum()) for s in range(most)]
    for step in range(1, ROUNDS + 1):
        weights, bias, t = params[:-5], params[-5], params[-4:].reshape(2, 2)
        u = x @ weights + bias
        e = np.exp(t - t.max())
        forward = np.zeros((len(u), 2))
        unary = np.stack([np.zeros_like(u), u], 1)
        unary = np.exp(unary - unary.max(1, keepdims=True))
        for s in range(most):
            at = first[: have[s]] + s
            a = unary[at] * (forward[at - 1] @ e) if s else unary[at]
            forward[at] = a / a.sum(1, keepdims=True)
        backward = np.ones((len(u), 2))
        pairs = np.zeros((2, 2))
        for s in range(most - 2, -1, -1):
            k = have[s + 1]
            at = first[:k] + s
            b = unary[at + 1] * backward[at + 1]
            joint = forward[at][:, :, None] * e[None] * b[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            pairs += (joint * cost[:k, None, None]).sum(0)
            b = b @ e.T
            backward[at] = b / b.sum(1, keepdims=True)
        p = forward * backward
        p = p[:, 1] / p.sum(1)
        residual = (y - p) * cost[doc]
        seen = np.zeros((2, 2))
        for label in (0, 1):
            own = (labels > 0) == bool(label)
            seen[label, label] = (cost[own] * (sizes[own] - 1)).sum()
        gradient = np.concatenate([x.T @ residual - DECAY * weights, [residual.sum()], (seen - pairs).ravel()])
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        params = params + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        params[-4:] = np.clip(params[-4:], -1.5, 1.5)  # neighbours count, but a line can still differ from them
    model = Model(mean, scale, params[:-5], float(params[-5]), tuple(params[-4:].tolist()), (1.0, 0.0))
    share = weighted(model.marginals(x @ model.weights + model.bias, first), first, np.concatenate([s for _, s, _ in sample]))
    return Model(mean, scale, model.weights, model.bias, model.transitions, _curve(share, labels > 0))


def _curve(share: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve from log-odds of a share to the label."""
    odds = np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1 - 1e-6))
    a, b = 1.0, 0.0
    for _ in range(30):  # Newton's method, slightly damped
        p = 1 / (1 + np.exp(-np.clip(a * odds + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((good - p) * odds).mean() - 1e-3 * (a - 1), (good - p).mean()])
        h = np.array([[(w * odds**2).mean() + 1e-3, (w * odds).mean()], [(w * odds).mean(), w.mean() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        size = max(1.0, abs(da), abs(db))
        a, b = a + da / size, b + db / size
    return max(float(a), 1e-3), float(b)


def score(documents: DataFrame, model: Model, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and the marginal of every line being good."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def work(slab: pa.RecordBatch) -> pa.RecordBatch:
        scores, good, first = shared.value.scores(slab.column("text").to_pylist(), slab.column("text"))
        lines = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(good))
        return pa.RecordBatch.from_arrays([slab.column("doc_id"), slab.column("held_out"), pa.array(scores), lines], names=["doc_id", "held_out", "score", "lines"])

    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out(F.col(doc)).alias("held_out"))
    return per_slab(rows, "text", "doc_id long, held_out boolean, score double, lines array<double>", work)


def trained(documents: DataFrame, labels: DataFrame) -> Model:
    return fit(training_sample(documents, labels))


def keep(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch, text):
                column = slab.column(text)
                yield slab.filter(pa.array(shared.value.scores(column.to_pylist(), column)[0] >= threshold))

    return documents.mapInArrow(task, documents.schema)
