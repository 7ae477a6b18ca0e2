"""Counters, failure handling and alarms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
MAX_RECEIVES = 5
ALARM_PERIOD = "5 minutes"
ATTEMPT_SCHEMA = "bucket string, source_key string, attempt int, error string, state string"
ERROR_PATTERN = "Exception|Traceback"
COUNTERS = (
    "emails_processed",
    "emails_written",
    "dedup_skips",
    "attachments_extracted",
    "extraction_failures",
    "decode_errors",
    "attachments_unowned",
)
# ----------------------------------------------------------------------------


def run_counters(
    emails: DataFrame | None = None,
    claims: DataFrame | None = None,
    attachments: DataFrame | None = None,
    parts: DataFrame | None = None,
) -> DataFrame:
    """One row of run counters.

    `emails` has `error`; `claims` is the result of `claim`; `attachments` the
    result of `extract_attachments`; `parts` all real attachments, from which
    those without an accepted owner are derived. Each input is aggregated by
    itself and the one-row results are added up.
    """
    pieces: list[DataFrame] = []

    def add(df: DataFrame, **counts: Column) -> None:
        pieces.append(
            df.agg(*[F.coalesce(counts[c], F.lit(0)).alias(c) if c in counts else F.lit(0).alias(c) for c in COUNTERS])
        )

    if emails is not None:
        add(emails, emails_processed=F.count_if(F.col("error").isNull()))
    if claims is not None:
        written = F.count_if("is_new")
        add(claims, emails_written=written, dedup_skips=F.sum("copies") - written)
    if attachments is not None:
        add(
            attachments,
            attachments_extracted=F.count_if(F.col("markdown").isNotNull()),
            extraction_failures=F.count_if("oversize"),
            decode_errors=F.count_if(F.col("extract_error").isNotNull()),
            attachments_unowned=-F.count("*"),
        )
    if parts is not None:
        add(parts, attachments_unowned=F.count("*"))
    total = reduce(DataFrame.unionByName, pieces)
    sums = [F.sum(c).cast("bigint").alias(c) for c in COUNTERS]
    if attachments is None or parts is None:
        sums[-1] = F.lit(0).cast("bigint").alias(COUNTERS[-1])
    return total.agg(*sums)


def flush_counters(counters: DataFrame, path: str, batch_id: int) -> None:
    """Write the counters of one run, nothing when all are zero.

    The run's partition is replaced, so a repeated run is not counted twice.
    """
    some = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in COUNTERS])
    counters.filter(some).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def quarantine(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows)."""
    failed = F.col(error).isNotNull()
    return df.filter(~failed), df.filter(failed)


def attempt_state(attempts: Column, max_receives: int = MAX_RECEIVES) -> Column:
    return F.when(attempts < max_receives, "retry").otherwise("dead")


def retry_or_dead(attempts: DataFrame, max_receives: int = MAX_RECEIVES) -> DataFrame:
    """Failed attempts per source and whether it is tried again."""
    return (
        attempts.groupBy("source_key")
        .agg(F.count("*").alias("receives"))
        .withColumn("state", attempt_state(F.col("receives"), max_receives))
    )


def ledger(work: DataFrame, failed: DataFrame, max_receives: int = MAX_RECEIVES) -> DataFrame:
    """The sources of a batch that failed, with their attempts so far, this one included.

    `work` lists what the batch tried (bucket, source_key, attempt: failures before it), `failed` the errors by
    source_key. What succeeded is not in the ledger; what is `dead` is not tried again.
    """
    errors = failed.groupBy("source_key").agg(F.min("error").alias("error"))
    tried = (F.col("attempt") + 1).cast("int")
    return work.join(errors, "source_key").select(
        "bucket", "source_key", tried.alias("attempt"), "error", attempt_state(tried, max_receives).alias("state")
    )


def alarm_windows(
    events: DataFrame,
    ts: str = "ts",
    depth: str = "depth",
    errors: str = "errors",
    period: str = ALARM_PERIOD,
    threshold: float = 0,
    lateness: str | None = None,
) -> DataFrame:
    """Tumbling windows with the greatest queue depth and the sum of errors.

    The same plan serves streams; there `lateness` bounds the state kept.
    """
    if lateness is not None:
        events = events.withWatermark(ts, lateness)
    return (
        events.groupBy(F.window(ts, period).alias("w"))
        .agg(F.max(depth).alias("max_depth"), F.sum(errors).alias("sum_errors"))
        .select(
            F.col("w.start").alias("window_start"),
            "max_depth",
            "sum_errors",
            (F.coalesce(F.col("max_depth"), F.lit(0)) > threshold).alias("depth_alarm"),
            (F.coalesce(F.col("sum_errors"), F.lit(0)) > threshold).alias("error_alarm"),
        )
    )


def reconcile(counters: DataFrame, units: DataFrame) -> DataFrame:
    """Whether written plus skipped mails equal the units produced."""
    produced = units.agg(F.count("*").alias("units"), F.lit(0).cast("bigint").alias("written"), F.lit(0).cast("bigint").alias("skips"))
    counted = counters.select(
        F.lit(0).cast("bigint").alias("units"),
        F.col("emails_written").alias("written"),
        F.col("dedup_skips").alias("skips"),
    )
    return (
        produced.unionByName(counted)
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("units", "written", "skips")])
        .withColumn("balanced", F.col("written") + F.col("skips") == F.col("units"))
    )


def recent_errors(log: DataFrame, n: int = 50, ts: str = "ts", message: str = "message", tie: str = "event_id") -> DataFrame:
    """Newest log lines that mention an exception (a top-n, no full sort)."""
    return log.filter(F.col(message).rlike(ERROR_PATTERN)).orderBy(F.desc(ts), F.desc(tie)).limit(n)
