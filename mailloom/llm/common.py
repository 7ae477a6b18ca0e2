"""Helpers the operators share: table access, stored intermediate tables, text buffers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from mailloom.session import shared_uri, work_folder

# A task works on so many bytes of text at once; a longer text is a slab of its own.
SLAB_BYTES = 1 << 20
# Of the batches that Spark hands to Python: executors keep two or more of them outside the heap.
ARROW_BYTES = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, inside the folder all executors share."""
    return f"{shared_uri(spark, work_folder(spark)).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, used: list[str] | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back, which also cuts the lineage; `used` notes the folder."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    folder = run_folder(spark, name)
    df.write.parquet(folder)
    if used is not None:
        used.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Remove stored tables that no frame reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def offsets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and the n + 1 offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slabs(batch: pa.RecordBatch, text: str, most: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about so many bytes of text; one row is never cut."""
    _, at = offsets_of(batch.column(text))
    first, n = 0, batch.num_rows
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def per_slab(df: DataFrame, text: str, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], most: int = SLAB_BYTES) -> DataFrame:
    """Apply a function to bounded runs of rows; nothing is kept between them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch, text, most):
                yield work(slab)

    return df.mapInArrow(task, schema)


def release() -> None:
    """Give freed memory back: a worker lives on between tasks, and what it once held would count beside the others'."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim is not None:
        trim(0)


def lookup(inside: bytes) -> np.ndarray:
    table_ = np.zeros(256, bool)
    table_[list(inside)] = True
    return table_


#: Bytes of a word that ends at ASCII white space; of one that also ends at ASCII punctuation, once lower-cased.
SPACED = ~lookup(b" \t\n\x0b\x0c\r")
PLAIN = lookup(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Random 64-bit values of bytes, and the odd base of the polynomial hash with its inverse.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C55
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base to the 0, 1, ..., n - 1, modulo 2^64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, SLAB_BYTES + 4096), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 4 * SLAB_BYTES:
            _POWERS[base] = known
    return known[:n]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte segments; equal bytes give equal hashes wherever they stand."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts laid end to end; `at` holds the texts' offsets."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = inside[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = word
    before[at] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = word
    after[at] = False
    return np.flatnonzero(word & ~before[:-1]), np.flatnonzero(word & ~after[1:]) + 1


#: Words beyond so many bytes are hashed one by one.
_LONG_WORD = 256
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 13) -> np.ndarray:
    """64-bit hashes of byte segments, mixed anew after every eight bytes, so that nothing cancels."""
    sizes = ends - starts
    out = mixed(sizes.astype(np.uint64) * _ODD + np.uint64(seed))
    eights = np.ndarray((len(data),), "<u8", data.tobytes() + bytes(8), strides=(1,))
    left, k = np.flatnonzero(sizes <= _LONG_WORD), 0
    while len(left):
        rest = np.minimum(sizes[left] - k, 8)
        out[left] = mixed((out[left] ^ (eights[starts[left] + k] & _MASKS[rest])) * _ODD)
        k += 8
        left = left[sizes[left] > k]
    for i in np.flatnonzero(sizes > _LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out
