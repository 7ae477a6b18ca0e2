"""Output tables, the optional one-file-per-object export, and texts from ordered lines."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.functions.text import sidecar_key
from mailloom.session import arrow_store, shared_uri, work_folder


def write_content(df: DataFrame, path: str) -> None:
    """Parquet by day; only the days present in `df` are replaced.

    Adaptive execution merges the rows of small days and splits a very large
    one over several tasks and files.
    """
    (
        df.hint("rebalance", "send_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("send_date")
        .parquet(path)
    )


def write_attachments(df: DataFrame, path: str) -> None:
    write_content(df, path)


def objects(df: DataFrame) -> DataFrame:
    """(output_key, bytes) of every page and its sidecar."""
    pair = F.array(
        F.struct(F.col("output_key").alias("k"), F.col("markdown").alias("v")),
        F.struct(sidecar_key(F.col("output_key")).alias("k"), F.col("metadata_json").alias("v")),
    )
    return df.select(F.explode(pair).alias("o")).select(
        F.col("o.k").alias("output_key"), F.col("o.v").cast("binary").alias("content")
    )


class _Files:
    """Files below a root, with the folders made so far."""

    def __init__(self, uri: str) -> None:
        self.files, self.base = arrow_store(uri)
        self.known: set[str] = set()

    def open(self, key: str):
        path = f"{self.base.rstrip('/')}/{key}"
        folder = path.rsplit("/", 1)[0]
        if folder not in self.known:
            self.files.create_dir(folder, recursive=True)
            self.known.add(folder)
        return self.files.open_output_stream(path)


def _by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of a key side by side and in order, in as many tasks as shuffles have; few bytes are not merged into one."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, key).sortWithinPartitions(key, *order)


def _reported(df: DataFrame, name: str) -> DataFrame:
    """Run the writing tasks, once, and return the rows they hand on."""
    spark = df.sparkSession
    folder = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def export_objects(df: DataFrame, root: str) -> DataFrame:
    """Write (output_key, content) rows as files with exactly those names.

    A key that several rows claim is not written but returned, with their number `n`. The rows are evaluated once; files
    are replaced whole, so a task that runs again leaves the same files. Rows without a key are reported under NULL.
    """
    return exported(df, root).filter("n > 1 OR output_key IS NULL")


def exported(df: DataFrame, root: str) -> DataFrame:
    """As `export_objects`, but returns every key with the number `n` of rows that claim it; files exist where n is 1.

    The names stay in a stored table, so that tasks can read the files again without a listing of them on the driver.
    """
    uri = shared_uri(df.sparkSession, root)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(uri)
        told: list[tuple[str | None, int]] = []
        key, content, n = None, None, 0

        def settle() -> None:
            if n == 1 and key is not None:
                with files.open(key) as out:
                    out.write(content.as_py() or b"")
            if n:
                told.append((key, n))

        def report() -> pa.RecordBatch:
            names, counts = zip(*told) if told else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["output_key", "n"])

        for batch in batches:
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if n and k == key:
                    n += 1
                    continue
                settle()
                key, content, n = k, value, 1
            if len(told) > 10_000:
                yield report()
                told.clear()
        settle()
        yield report()

    return _reported(_by_key(df.select("output_key", "content"), "output_key", []).mapInArrow(write, "output_key string, n bigint"), "exported")


def write_texts(lines: DataFrame, key: str, order: list[str], text: str, root: str, separator: str = "\n") -> DataFrame:
    """Stream lines into one file per key: its texts in the given order, with a separator between them.

    One exchange on the key and a sort; a task holds one batch of lines, whatever a document's size. Returns (key, lines)
    of the files written.
    """
    uri = shared_uri(lines.sparkSession, root)
    gap = separator.encode()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, done, out, current, n = _Files(uri), [], None, None, 0

        def report() -> pa.RecordBatch:
            names, counts = zip(*done) if done else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["key", "lines"])

        for batch in batches:
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None or k != current:
                    if out is not None:
                        out.close()
                        done.append((current, n))
                    out, current, n = files.open(k), k, 0
                if n:
                    out.write(gap)
                out.write((value or "").encode())
                n += 1
            if len(done) > 10_000:
                yield report()
                done.clear()
        if out is not None:
            out.close()
            done.append((current, n))
        yield report()

    ordered = _by_key(lines.filter(F.col(key).isNotNull()), key, order).select(F.col(key).cast("string"), F.col(text))
    return _reported(ordered.mapInArrow(write, "key string, lines bigint"), "texts")
