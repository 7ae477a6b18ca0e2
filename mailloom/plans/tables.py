"""Where a run keeps its tables, one partition per batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.operators.dedup import (
    REGISTRY_SCHEMA,
    identity_filters,
    known_among,
    maybe_known,
    select_identities,
    slots_for,
    with_hash,
    without,
)
from mailloom.operators.monitor import ATTEMPT_SCHEMA
from mailloom.operators.retrieval import check_prefix, latest_pages
from mailloom.session import durable
from mailloom.sources.sinks import write_content

TABLES = (
    "work", "listed", "emails", "quarantine", "units", "candidates", "claims", "accepted", "attachments", "content", "attachment_content",
    "run_metrics", "attempts", "registry", "registry_filters", "batches", "tombstones",
)

# What tells the pages of a table apart; a later batch replaces the rows of the same one.
PAGES = {"content": ("identity",), "attachment_content": ("source_key", "part_no")}

# Candidates that a filter lets through: so many are named in the scan's own filter, so many are broadcast.
NAMED, BROADCAST = 1_000, 200_000


class Tables:
    """Paths under one root in shared storage.

    Every table is written as `<table>/batch_id=<n>`, replaced whole when the
    batch is repeated. The registry is written after all outputs and the row in
    `batches`, which marks the batch as done, after the registry. Nothing else is
    ever rewritten: what is cleared or forgotten gets a tombstone with the last
    batch it covers.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        if table not in TABLES:
            raise ValueError(table)
        return f"{self.root}/{table}"

    def write(
        self, df: DataFrame, table: str, batch_id: int, by: str | None = None, sort: tuple[str, ...] = (), near: str | None = None
    ) -> DataFrame:
        """Replace a batch's partition and return it as read back.

        Rows go to a folder for each value of `by`, which must have few; rows with one value of `near` go to one file.
        """
        path = f"{self.path(table)}/batch_id={batch_id}"
        schema = df.schema
        if by or near:
            # Adaptive execution merges the rows of small values and splits a large one.
            df = df.hint("rebalance", by or near)
        if near is not None:
            df = df.sortWithinPartitions(near)
        if sort:
            df = df.sortWithinPartitions(*sort)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if by is not None:
            writer = writer.partitionBy(by)
        writer.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, table: str, batch_id: int) -> None:
        """Remove a batch's partition, if there is one."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/batch_id={batch_id}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _all(self, table: str, schema: str | None = None) -> DataFrame | None:
        """Every batch of a table; None if there is none yet."""
        path = self.path(table)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.option("basePath", path).parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def read(self, table: str, finished_only: bool = True) -> DataFrame:
        """A table over all batches, by default without a batch still at work; pages as their latest batch wrote them."""
        rows = self._all(table)
        if rows is None:
            raise ValueError(f"{table} was never written below {self.root}")
        done = self._finished()
        if done is not None and finished_only:
            rows = rows.join(done, "batch_id", "left_semi")
        if table not in PAGES:
            return rows
        rows = latest_pages(rows, PAGES[table])
        gone = self._tombstones(table)
        return rows if gone is None else without(rows, gone, "output_key")

    def unseen(self, names: DataFrame) -> DataFrame:
        """Listed files (with `path`) that no finished batch of a stream has listed."""
        seen, done = self._all("listed", "path string, batch_id bigint"), self._finished()
        if seen is None or done is None:
            return names
        return names.join(seen.join(done, "batch_id", "left_semi"), "path", "left_anti")

    def publish(self, table: str, path: str) -> None:
        """Lay a page table out by day alone, in few large files, at another path."""
        write_content(self.read(table).drop("batch_id"), path)

    def _finished(self) -> DataFrame | None:
        return self._all("batches", "batch_id bigint")

    def finish(self, batch_id: int) -> None:
        done = self.spark.range(1).select(F.current_timestamp().alias("finished_at"))
        self.write(done, "batches", batch_id)

    def _last(self) -> int | None:
        done = self._finished()
        return None if done is None else done.agg(F.max("batch_id")).first()[0]

    def next_batch(self) -> int:
        """One after the last finished batch, so a failed one keeps its number."""
        last = self._last()
        return 0 if last is None else last + 1

    # --- the registry ---------------------------------------------------------

    def write_registry(self, rows: DataFrame, batch_id: int) -> None:
        """Store accepted identities by hash bucket, sorted by hash, and their filter."""
        stored = self.write(with_hash(rows.drop("batch_id")), "registry", batch_id, by="bucket", sort=("bucket", "h"))
        self.write(identity_filters(stored, slots_for(stored.count())), "registry_filters", batch_id)

    def registry(self, before_batch: int | None = None) -> DataFrame | None:
        """Accepted identities, leaving out forgotten ones and those of a batch that is repeated."""
        known = self._all("registry", REGISTRY_SCHEMA)
        if known is None:
            return None
        known = known if before_batch is None else known.filter(known.batch_id != before_batch)
        gone = self._tombstones("registry")
        return known if gone is None else without(known, gone, "identity")

    def knows_any(self, before_batch: int) -> bool:
        known = self._all("registry", REGISTRY_SCHEMA)
        return known is not None and not known.filter(known.batch_id != before_batch).isEmpty()

    def known(self, firsts: DataFrame, before_batch: int) -> DataFrame | None:
        """Identities of stored candidates that the registry holds; None if it surely holds none.

        The batches' filters are asked first, at about 2 bytes an identity. Of the registry only the buckets are read
        that a candidate which passed can be in, and in them, if these are few, only row groups with their hashes.
        """
        registry, filters = self._all("registry", REGISTRY_SCHEMA), self._all("registry_filters")
        if registry is None or filters is None:
            return None
        registry, filters = (x.filter(x.batch_id != before_batch) for x in (registry, filters))
        sizes = [r[0] for r in filters.select("slots").distinct().collect()]  # powers of two
        if not sizes:
            return None
        maybe = durable(maybe_known(with_hash(firsts), filters, sizes))
        n = maybe.count()
        if n == 0:
            return None
        touched = [r[0] for r in with_hash(maybe).select("bucket").distinct().collect()]  # BUCKETS at most
        registry = registry.filter(registry.bucket.isin(touched))
        if n <= NAMED:
            registry = registry.filter(registry.h.isin([r[0] for r in maybe.select("h").collect()]))
        found = known_among(F.broadcast(maybe) if n <= BROADCAST else maybe, registry)
        gone = self._tombstones("registry")
        return found if gone is None else without(found, gone, "identity")

    # --- attempts ---------------------------------------------------------------

    def attempts(self) -> DataFrame:
        rows = self._all("attempts", ATTEMPT_SCHEMA + ", batch_id bigint")
        return self.spark.createDataFrame([], ATTEMPT_SCHEMA + ", batch_id bigint") if rows is None else rows

    def due(self, batch_id: int) -> DataFrame:
        """Sources to try again: those left for a retry by the last batch before this one that kept a ledger."""
        before = self.attempts().filter(F.col("batch_id") < batch_id)
        last = before.agg(F.max("batch_id")).first()[0]
        return before.filter((F.col("batch_id") == F.lit(last)) & (F.col("state") == "retry")).drop("batch_id")

    # --- clearing ---------------------------------------------------------------

    def _tombstones(self, table: str) -> DataFrame | None:
        path = f"{self.path('tombstones')}/{table}"
        try:
            return self.spark.read.schema("name string, upto bigint").parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _bury(self, table: str, names: DataFrame) -> None:
        """Add tombstones for these keys in all batches up to the last one; safe to repeat."""
        rows = names.toDF("name").distinct().select("name", F.lit(self._last()).cast("bigint").alias("upto"))
        rows.write.mode("append").parquet(f"{self.path('tombstones')}/{table}")

    def forget(self, everything: bool = False, keys: list[str] | None = None, prefix: str | None = None, dry_run: bool = False) -> int:
        """Remove identities from the registry so their mails are processed again; a dry run only counts them."""
        known = self.registry()
        if known is None:
            return 0
        selected = durable(select_identities(known, everything, keys, prefix).distinct())
        if not dry_run:
            self._bury("registry", selected)
        return selected.count()

    def clear(self, table: str, output_prefix: str, prefix: str | None = None, force: bool = False, dry_run: bool = False) -> int:
        """Remove pages whose key starts with a prefix inside the output root, in all their versions; a dry run only counts."""
        hit = F.col("output_key").startswith(check_prefix(prefix, output_prefix, force))
        selected = durable(self.read(table).filter(hit).select("output_key"))
        if not dry_run:
            self._bury(table, self._all(table).filter(hit).select("output_key"))
        return selected.count()
