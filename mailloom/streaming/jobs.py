"""Message files to tables, as one batch or as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mailloom.operators.attachments import (
    Decoder,
    attach_to_top,
    attachment_refs,
    extract_attachments,
    real_attachments,
    render_attachments,
    without_useless_bytes,
)
from mailloom.operators.dedup import accepted, candidates, flagged, registry_rows, winners
from mailloom.operators.monitor import flush_counters, ledger, quarantine, run_counters
from mailloom.options import Options
from mailloom.plans.mail import address_units, content_of, units_of
from mailloom.plans.tables import Tables
from mailloom.session import durable, small_files
from mailloom.sources.backfill import backfill, select_keys
from mailloom.sources.messages import list_messages, parse_messages, read_messages
from mailloom.sources.notifications import failed_events, flatten_events
from mailloom.sources.objects import check_folder, fetch

ACCEPTED = (
    "identity", "copies", "source_key", "unit_order", "is_wrapper", "is_external", "message_id",
    "from_", "to_", "cc", "subject", "date_header", "body", "hash8", "thread", "sent_at", "sent_text",
    "send_date", "output_key",
)


# What a batch writes of decoded mails; a repeated batch without any leaves none of it behind.
AFTER_DECODING = (
    "units", "candidates", "claims", "accepted", "attachments", "attachment_content", "content", "run_metrics", "registry", "registry_filters",
)


def process_batch(
    objects: DataFrame,
    tables: Tables,
    batch_id: int,
    options: Options = Options(),
    decoders: Mapping[str, Decoder] | None = None,
    work: DataFrame | None = None,
    rejected: DataFrame | None = None,
) -> None:
    """Process one set of message files; repeating a batch replaces its output.

    Decoded mails, claims and accepted mails are written before they are used
    again, so MIME is decoded once and a lost executor only repeats its own
    tasks. `work` is what the batch set out to read (see `ledger`), `rejected`
    failures from before (source_key, error).
    """
    # A stream's batch has a session of its own.
    with small_files(objects.sparkSession), small_files(tables.spark):
        _process(objects, tables, batch_id, options, decoders, work, rejected)


def _process(
    objects: DataFrame,
    tables: Tables,
    batch_id: int,
    options: Options,
    decoders: Mapping[str, Decoder] | None,
    work: DataFrame | None,
    rejected: DataFrame | None,
) -> None:
    emails = without_useless_bytes(parse_messages(objects), decoders, options)
    emails = tables.write(emails, "emails", batch_id)
    good, bad = quarantine(emails)
    failed_parts = (
        good.select("source_key", F.explode("parts").alias("p"))
        .filter("p.error IS NOT NULL")
        .select("source_key", "p.part_no", "p.error")
    )
    failed = bad.select("source_key", "error")
    listed = failed if rejected is None else failed.unionByName(rejected)
    listed = listed.select("source_key", F.lit(None).cast("int").alias("part_no"), "error")
    tables.write(listed.unionByName(failed_parts), "quarantine", batch_id)

    if good.isEmpty():  # such as a batch of retries that all fail again
        for table in AFTER_DECODING:
            tables.drop(table, batch_id)
        if work is not None:
            tables.write(ledger(work, failed), "attempts", batch_id)
        tables.finish(batch_id)
        return
    # Messages are split once; claims are narrow rows, and texts wait until the winners are known.
    units = tables.write(units_of(good.drop("parts", "error", "body_is_markdown"), options), "units", batch_id)
    firsts, known = candidates(units), None
    if tables.knows_any(batch_id):
        firsts = tables.write(firsts, "candidates", batch_id)
        known = tables.known(firsts, batch_id)
    claims = tables.write(flagged(firsts, known), "claims", batch_id)
    claimed = address_units(winners(units, accepted(claims)), options).select(*ACCEPTED)
    claimed = tables.write(claimed, "accepted", batch_id)

    parts = real_attachments(good)
    extracted = extract_attachments(attach_to_top(claimed, parts), decoders, options)
    extracted = tables.write(extracted, "attachments", batch_id)
    pages = tables.write(render_attachments(extracted, options), "attachment_content", batch_id, near="send_date")
    tables.write(content_of(claimed, attachment_refs(pages)), "content", batch_id, near="send_date")
    flush_counters(run_counters(emails, claims, extracted, parts), tables.path("run_metrics"), batch_id)
    if work is not None:
        tables.write(ledger(work, failed), "attempts", batch_id)
    tables.write_registry(registry_rows(claimed, batch_id), batch_id)
    tables.finish(batch_id)


def process_events(
    queue: DataFrame,
    tables: Tables,
    batch_id: int,
    store: str,
    options: Options = Options(),
    decoders: Mapping[str, Decoder] | None = None,
) -> None:
    """Process the messages that notifications (column `body`) name, and those an earlier batch left for a retry.

    Objects are fetched in the tasks, see `sources.objects`. One that is missing or cannot be read is a failure of its
    own: it is quarantined and tried again by later batches until its fifth failure, when it is dead. Records without
    bucket or key are quarantined. `store` is a URI with `{bucket}` in it.
    """
    named = flatten_events(queue.select("body")).withColumnRenamed("key", "source_key")
    new = select_keys(named, options.input_prefix, "bucket").withColumn("attempt", F.lit(0))
    due = tables.due(batch_id).select("bucket", "source_key", "attempt")
    work = new.unionByName(due).groupBy("bucket", "source_key").agg(F.max("attempt").alias("attempt"))
    work = tables.write(work, "work", batch_id)
    rejected = failed_events(queue.select("body")).select(F.col("key").alias("source_key"), "error")
    objects = fetch(work, store).drop("bucket")
    process_batch(objects, tables, batch_id, options, decoders, work, rejected)


def run_events(
    queue: DataFrame,
    tables_root: str,
    store: str,
    options: Options = Options(),
    decoders: Mapping[str, Decoder] | None = None,
) -> int:
    """Process a set of notifications and return the batch's number."""
    tables = Tables(queue.sparkSession, tables_root)
    batch_id = tables.next_batch()
    process_events(queue, tables, batch_id, store, options, decoders)
    return batch_id


def run_event_stream(
    queue: DataFrame,
    tables_root: str,
    store: str,
    options: Options = Options(),
    decoders: Mapping[str, Decoder] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Process notifications as they arrive, or once through all if `every` is None; see `run_stream`."""
    tables = Tables(queue.sparkSession, tables_root)

    def each(batch: DataFrame, batch_id: int) -> None:
        process_events(batch, tables, batch_id, store, options, decoders)

    writer = queue.select("body").writeStream.foreachBatch(each).option("checkpointLocation", f"{tables.root}/_events")
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def run_batch(
    spark: SparkSession,
    source: str,
    tables_root: str,
    options: Options = Options(),
    decoders: Mapping[str, Decoder] | None = None,
    prefix: str | None = None,
) -> int:
    """Process every message under `source` and return the batch's number.

    `prefix` narrows the run to the keys that start with it. Files are listed and fetched in tasks.

    A run that failed is repeated under the same number.
    """
    tables = Tables(spark, tables_root)
    batch_id = tables.next_batch()
    names = backfill(list_messages(spark, source, options.input_prefix, prefix), prefix or options.input_prefix)
    process_batch(read_messages(names, source), tables, batch_id, options, decoders)
    return batch_id


def run_stream(
    spark: SparkSession,
    source: str,
    tables_root: str,
    options: Options = Options(),
    decoders: Mapping[str, Decoder] | None = None,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
    prefix: str | None = None,
) -> StreamingQuery:
    """Process new messages as they arrive, or once through all if `every` is None.

    A tick of the stream lists the source in tasks; files are new by path, not by date: a table keeps the paths of every
    finished batch, so neither the driver nor the stream's checkpoint holds a name. A batch takes `max_files_per_trigger`
    files, the oldest first; once through all is as many batches as that needs. Batches are numbered as by `run_batch`,
    so one that failed is repeated under its number with what is there then. One query owns a registry.
    """
    tables = Tables(spark, tables_root)
    check_folder(spark, source)

    def each(tick: DataFrame, tick_no: int) -> None:
        found = backfill(list_messages(spark, source, options.input_prefix), prefix or options.input_prefix)
        fresh = durable(tables.unseen(found))
        while not (names := tables.unseen(fresh)).isEmpty():
            batch_id = tables.next_batch()
            if max_files_per_trigger:
                names = names.orderBy("modification_time", "path").limit(max_files_per_trigger)
            names = tables.write(names, "listed", batch_id)
            process_batch(read_messages(names, source), tables, batch_id, options, decoders)
            if every is not None:
                break

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    writer = ticks.writeStream.foreachBatch(each).option("checkpointLocation", f"{tables.root}/_ticks")
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def claim_any(units: DataFrame, lateness: str | None = None, ts: str = "modification_time") -> DataFrame:
    """Streaming first-seen filter held in Spark's state store.

    Simpler than the registry, but which copy wins is up to arrival order.
    With `lateness` the state of old identities expires.
    """
    if lateness is None:
        return units.dropDuplicates(["identity"])
    return units.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(["identity"])
