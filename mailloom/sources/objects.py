"""Objects named by rows, listed and fetched inside the tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.session import arrow_store, shared_uri, work_folder

# A binary value ends at 2 GiB.
MOST_BYTES = (1 << 31) - 1
RANGE_BYTES = 8 << 20
# Objects a task fetches; bytes of objects in one batch of rows.
OBJECTS_PER_TASK, BATCH_BYTES = 256, 32 << 20

# Folders a task lists, beyond the first 64 tasks.
FOLDERS_PER_TASK = 256
# Of files that a listing found, a task fetches so many, or so many bytes.
FILES_PER_TASK, TASK_BYTES = 1024, 64 << 20

LISTED = "path string, modification_time timestamp, length bigint, is_folder boolean"
FETCHED = "bucket string, source_key string, path string, modification_time timestamp, length bigint, content binary, error string"


def located(named: DataFrame, store: str) -> DataFrame:
    """Add the `root` and `path` of each (bucket, source_key); `store` is a URI with `{bucket}` in it, such as s3a://{bucket}."""
    root = F.replace(F.lit(store.rstrip("/")), F.lit("{bucket}"), F.col("bucket"))
    return named.withColumns({"root": root, "path": F.concat(root, F.lit("/"), F.col("source_key"))})


def fetch(named: DataFrame, store: str, most_bytes: int = MOST_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The objects that rows (bucket, source_key) name, one row for each; what cannot be read has an `error` instead.

    Tasks open the objects themselves and read them in ranges, so a missing one, one beyond `most_bytes` or one that
    breaks off is a row of its own and fails no task. The names are dealt evenly, however few bytes they are.
    """
    rows = located(named.select("bucket", "source_key"), store).withColumn("place", F.col("source_key"))
    return _fetched(rows, max(1, -(-rows.count() // OBJECTS_PER_TASK)), most_bytes, range_bytes)


def _fetched(rows: DataFrame, tasks: int, most_bytes: int = MOST_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The objects of rows (bucket, source_key, root, path, place): `place` is an object's path below its root."""

    def read(stores: dict, root: str, key: str) -> dict:
        # Keys are taken as they are: only the root is a URI.
        if root not in stores:
            stores[root] = arrow_store(root)
        files, base = stores[root]
        place = f"{base.rstrip('/')}/{key}"
        info = files.get_file_info(place)
        if not info.is_file:
            return {"error": "missing object"}
        row = {"modification_time": info.mtime, "length": info.size}
        if info.size > most_bytes:
            return row | {"error": f"object of {info.size} bytes, beyond {most_bytes}"}
        with files.open_input_file(place) as source:
            parts = [source.read_at(min(range_bytes, info.size - a), a) for a in range(0, info.size, range_bytes)]
        content = b"".join(parts)
        if len(content) != info.size:
            return row | {"error": f"{len(content)} of {info.size} bytes read"}
        return row | {"content": content}

    kinds = [("bucket", pa.string()), ("source_key", pa.string()), ("path", pa.string()), ("modification_time", pa.timestamp("us", "UTC"))]
    schema = pa.schema([*kinds, ("length", pa.int64()), ("content", pa.binary()), ("error", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, stores = [], 0, {}
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    found = read(stores, row.pop("root"), row.pop("place"))
                except Exception as problem:  # one object must not fail the task
                    found = {"error": f"{type(problem).__name__}: {problem}"}
                held.append(row | found)
                size += found.get("length", 0) if "content" in found else 0
                if size >= BATCH_BYTES or len(held) >= 1000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)

    return rows.repartition(tasks, "path").mapInArrow(task, FETCHED)


def contents(fetched: DataFrame) -> DataFrame:
    """Objects that must all be there: one with an `error` ends the job."""
    failed = F.raise_error(F.concat("path", F.lit(": "), "error")).cast("binary")
    return fetched.withColumn("content", F.when(F.col("error").isNull(), F.col("content")).otherwise(failed)).drop("error")


def check_folder(spark: SparkSession, root: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(root)


def _hidden(name: str) -> bool:
    """Names that Spark's own listings leave out."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


def listed(spark: SparkSession, root: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """Files below `root` whose path there starts with `prefix` and, in lower case, ends in `suffix`.

    Columns: path (below the root), modification_time and length. Folders are listed level by level, each by a task, and
    the names are stored: the driver holds none of them, however many there are. Times are cut to milliseconds.
    """
    uri = shared_uri(spark, root)
    schema = pa.schema([("path", pa.string()), ("modification_time", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("is_folder", pa.bool_())])

    def level(start: str):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            files, base = arrow_store(uri)
            base = base.rstrip("/")
            for batch in batches:
                for folder in batch.column("path").to_pylist():
                    held = []
                    for info in files.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/") or "/", allow_not_found=True)):
                        name, folds = info.base_name, info.type == fs.FileType.Directory
                        if _hidden(name) or not name.startswith(start) or not (folds or info.is_file and name.lower().endswith(suffix)):
                            continue
                        held.append((f"{folder}/{name}" if folder else name, None if folds else info.mtime, None if folds else info.size, folds))
                        if len(held) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

        return task

    within, _, start = prefix.rpartition("/")
    folders, levels = spark.createDataFrame([(within,)], "path string"), []
    while True:
        stored = f"{work_folder(spark)}/listed-{uuid.uuid4().hex}"
        folders.mapInArrow(level(start if not levels else ""), LISTED).write.parquet(stored)
        levels.append(spark.read.schema(LISTED).parquet(stored))
        folders = levels[-1].where("is_folder").select("path")
        n = folders.count()
        if not n:
            break
        folders = folders.repartition(min(n, max(64, n // FOLDERS_PER_TASK)), "path")
    found = reduce(DataFrame.unionByName, levels).where("not is_folder")
    return found.select("path", F.date_trunc("millisecond", "modification_time").alias("modification_time"), "length")


def fetch_listed(found: DataFrame, root: str, key: Column) -> DataFrame:
    """The files that a stored listing of `root` found, with their key; one that cannot be read ends the job."""
    uri = shared_uri(found.sparkSession, root).rstrip("/")
    n, size = found.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    least = min(-(-n // 64), found.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, least, -(-n // FILES_PER_TASK), -(-size // TASK_BYTES))
    place = F.col("path")
    rows = found.select(
        F.lit(None).cast("string").alias("bucket"), key.alias("source_key"), F.lit(uri).alias("root"),
        F.concat(F.lit(uri + "/"), place).alias("path"), place.alias("place"),
    )
    return contents(_fetched(rows, tasks)).drop("bucket").withColumn("modification_time", F.date_trunc("millisecond", "modification_time"))
