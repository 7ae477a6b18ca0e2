"""What the physical plans look like."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom.operators import dedup, retrieval
from mailloom.plans.mail import units_of
from mailloom.plans.mailbox import mailbox, message_bytes
from mailloom.plans.tables import Tables
from mailloom.sources.messages import parse_messages, scan_messages
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_has_no_shuffle_of_its_own(spark):
    mails = mailbox(spark, SF_SMALL)
    assert plan(units_of(mails)).count("Exchange") == plan(mails).count("Exchange")


def test_claim_moves_no_text(spark, tmp_path):
    units_of(mailbox(spark, SF_SMALL)).write.parquet(str(tmp_path / "u"))
    units = spark.read.parquet(str(tmp_path / "u"))
    text = plan(dedup.flagged(dedup.candidates(units)))
    # A hot identity is reduced before it is shuffled, and its text is not read.
    assert text.count("Exchange") == 1 and "partial_min" in text and "body" not in text


def test_registry_is_not_shuffled_and_read_by_bucket(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    ids = spark.range(0, 20_000).select(F.concat(F.lit("id-"), "id").alias("identity"))
    empty = [F.lit("x").alias(c) for c in ("source_key", "output_key", "subject", "date_header")]
    tables.write_registry(dedup.registry_rows(ids.select("identity", *empty)), 0)
    tables.finish(0)
    asked = spark.createDataFrame([("id-7",), ("id-19999",), ("new-1",)], "identity string")
    known = tables.known(asked, 1)
    assert sorted(r.identity for r in known.select("identity").collect()) == ["id-19999", "id-7"]
    text = plan(known)
    scan = next(line for line in text.split("\n") if "FileScan" in line and "registry" in line)
    assert "PartitionFilters" in scan and "bucket" in scan.split("PartitionFilters")[1] and "In(h," in scan
    assert "hashpartitioning" not in text
    assert tables.known(spark.createDataFrame([("new-2",)], "identity string"), 1) is None
    assert tables.known(asked, 0) is None  # a batch that is repeated does not know its own


def test_prefix_lists_only_its_folders(spark, tmp_path):
    for name in ("emails/2026-07-01/a.eml", "emails/2026-07-02/b.eml", "emails/2026-08-01/c.eml", "emails/[x]/d.eml"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    for prefix, wanted in (("emails/2026-07-0", 2), ("emails/2026-07-02/", 1), ("emails/[x]/", 1), ("emails/none/", 0), ("emails/", 4)):
        found = scan_messages(spark, str(tmp_path), prefix=prefix)
        assert len(found.inputFiles()) == found.count() == wanted


def test_positions_run_nothing_before_they_are_used(spark):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    content = spark.range(1000).select(
        *[F.concat(F.lit("a"), F.col("id") % 1).alias(c) for c in ("send_date", "thread", "hash8", "subject")],
        *[F.col("id").cast("string").alias(c) for c in ("sent_text", "output_key")],
    )
    before = set(jobs())
    listed = retrieval.thread_listing(content)
    text = plan(listed)
    assert set(jobs()) == before
    # Cells are spread by hash, so a hot thread is no single task, and no order is global.
    assert "rangepartitioning" not in text and "SinglePartition" not in text
    assert listed.agg(F.max("thread_position")).first()[0] == 1000


def test_mime_is_the_only_python_stage(spark):
    parsed = parse_messages(message_bytes(mailbox(spark, SF_SMALL)))
    text = plan(units_of(parsed.drop("parts", "error", "body_is_markdown")))
    assert text.count("ArrowEvalPython") == 1


def test_registry_prefix_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", "emails/x")], "identity string, source_key string").write.parquet(str(tmp_path / "r"))
    text = plan(dedup.select_identities(spark.read.parquet(str(tmp_path / "r")), prefix="emails/"))
    assert "StringStartsWith(source_key,emails/)" in text
