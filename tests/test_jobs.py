"""Message files through the batch and streaming jobs."""

from __future__ import annotations

import json
import os

import pytest

from mailloom.operators.attachments import real_attachments
from mailloom.options import Options
from mailloom.plans.tables import Tables
from mailloom.sources import backfill, messages, objects, sinks
from mailloom.streaming.jobs import claim_any, process_batch, run_batch, run_event_stream, run_events, run_stream
from tests import samples

COUNTERS = ("emails_processed", "emails_written", "dedup_skips", "attachments_extracted", "extraction_failures")


@pytest.fixture
def source(tmp_path):
    return samples.write_files(tmp_path / "in", samples.mailbox_files())


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def content(spark, root):
    return rows(Tables(spark, root).read("content"), "output_key", "identity", "source_key", "markdown", "metadata_json")


def test_scan_finds_messages_and_keys(spark, source):
    found = messages.scan_messages(spark, source)
    keys = {r[0] for r in found.select("source_key").collect()}
    assert len(keys) == 9 and "emails/2026-07-27/fwd.EML" in keys
    plan = backfill.backfill(found, "emails/misc/", dry_run=True)
    assert plan.count() == 3
    assert "content" not in plan._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_parse(spark, source):
    parsed = messages.parse_messages(messages.scan_messages(spark, source))
    by_key = {r.source_key.rsplit("/", 1)[1]: r for r in parsed.collect()}
    assert all(r.error is None for r in by_key.values())
    direct = by_key["direct.eml"]
    assert (direct.from_, direct.subject, direct.message_id) == ("Ada Stone <ada@example.com>", "Pump figures", "<direct-1@example.com>")
    assert direct.cc is None and direct.parts == [] and not direct.body_is_markdown
    html = by_key["html.eml"]
    assert html.body_is_markdown and html.body == "Dear **team**,\n\nsee [this](http://x.example/a_b)"
    latin = by_key["latin.eml"]
    assert latin.subject == "Café" and latin.body.strip() == "Le café est prêt, voilà."
    nested = by_key["nested.eml"]
    assert nested.body == "Plain part.\n"
    assert "attached" in by_key["att.eml"].body
    kept = rows(real_attachments(parsed), "source_key", "filename")
    assert kept == [
        ("emails/2026-07-27/att.eml", "report.txt"), ("emails/misc/nested.eml", "a.zip"), ("emails/misc/nested.eml", "big.txt"),
    ]
    assert all(p.data is None for p in by_key["att.eml"].parts if p.disposition == "inline")


def test_broken_message_is_reported(spark, tmp_path):
    source = samples.write_files(tmp_path / "in", {"a/bad.eml": samples.broken(), "a/good.eml": samples.direct(), "a/empty.eml": b""})
    root = str(tmp_path / "out")
    run_batch(spark, source, root)
    tables = Tables(spark, root)
    bad = tables.read("quarantine").collect()
    assert [r.source_key for r in bad] == ["emails/a/bad.eml"] and "no-such-charset" in bad[0].error
    assert tables.read("content").count() == 1


def test_batch_job(spark, source, tmp_path):
    root = str(tmp_path / "out")
    assert run_batch(spark, source, root, Options(max_attachment_bytes=200)) == 0
    out = {r[2].rsplit("/", 1)[1]: r for r in content(spark, root)}
    # The copy came later than the original and was skipped.
    assert "direct.eml" in out and "copy.eml" not in out
    assert out["early.eml"][0].startswith("emails-extracted/content/2026-07-15/")
    assert out["nodate.eml"][0].startswith("emails-extracted/content/2026-07-27/")
    forwarded = [r for r in content(spark, root) if "fwd" in r[2]]
    assert len(forwarded) == 2
    assert sum("> **EXTERNAL EMAIL**" in r[3] for r in forwarded) == 1
    assert all(r[0].split("/")[2] == "2026-07-27" for r in forwarded)
    assert len({r[0].split("/")[3][:8] for r in forwarded}) == 1
    meta = json.loads(out["att.eml"][4])
    pages = {r.output_key: r for r in Tables(spark, root).read("attachment_content").collect()}
    assert [a["filename"] for a in meta["attachments"]] == ["report.txt"]
    page = pages[meta["attachments"][0]["output_key"]]
    assert "Line one of the report" in page.markdown and page.markdown.startswith("# Attachment: report.txt")
    assert meta["order"] == 0 and meta["is_wrapper"] is True and list(meta)[:3] == ["schema_version", "identity", "message_id"]
    counted = Tables(spark, root).read("run_metrics").select(*COUNTERS).first()
    assert tuple(counted) == (9, 9, 1, 1, 1)
    # A second run finds everything known.
    assert run_batch(spark, source, root) == 1
    assert Tables(spark, root).read("content").filter("batch_id = 1").count() == 0
    again = Tables(spark, root).read("run_metrics").filter("batch_id = 1").select(*COUNTERS).first()
    assert tuple(again)[:4] == (9, 0, 10, 0)


def test_key_dates_option(spark, source, tmp_path):
    root = str(tmp_path / "out")
    run_batch(spark, source, root, Options(date_source="key", output_prefix="out"))
    early = [r for r in content(spark, root) if "early" in r[2]]
    assert early[0][0].startswith("out/content/2026-07-27/")


@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch(spark, source, tmp_path, files):
    batch_root, stream_root = str(tmp_path / "b"), str(tmp_path / "s")
    run_batch(spark, source, batch_root)
    run_stream(spark, source, stream_root, max_files_per_trigger=files).awaitTermination()
    assert content(spark, stream_root) == content(spark, batch_root)
    # Nothing new: the stream has nothing to do.
    run_stream(spark, source, stream_root).awaitTermination()
    assert content(spark, stream_root) == content(spark, batch_root)
    metrics = Tables(spark, stream_root).read("run_metrics").selectExpr("sum(emails_written)", "sum(dedup_skips)").first()
    assert tuple(metrics) == (9, 1)


def test_repeating_a_batch_changes_nothing(spark, source, tmp_path):
    root = str(tmp_path / "out")
    tables = Tables(spark, root)
    found = messages.scan_messages(spark, source)
    first = found.filter("source_key LIKE '%2026-07-27%'")
    process_batch(first, tables, 0)
    process_batch(found, tables, 1)
    before = content(spark, root), rows(tables.read("registry"), "identity", "batch_id"), rows(tables.read("run_metrics"), *COUNTERS)
    process_batch(first, tables, 0)
    process_batch(found, tables, 1)
    after = content(spark, root), rows(tables.read("registry"), "identity", "batch_id"), rows(tables.read("run_metrics"), *COUNTERS)
    assert before == after


def test_failed_batch_is_repeated_under_its_number(spark, source, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    original = Tables.write

    def fails(self, df, table, *args, **kw):
        if table == "registry":
            raise RuntimeError("lost")
        return original(self, df, table, *args, **kw)

    monkeypatch.setattr(Tables, "write", fails)
    with pytest.raises(RuntimeError):
        run_batch(spark, source, root)
    assert Tables(spark, root).read("content", finished_only=False).count() == 9
    monkeypatch.setattr(Tables, "write", original)
    assert run_batch(spark, source, root) == 0
    assert Tables(spark, root).read("content").count() == 9


def test_decoders_are_isolated(spark, tmp_path):
    m = samples.message("Docs", "See files.\n", mid="<docs@example.com>")
    m.add_attachment(b"ok", maintype="application", subtype="pdf", filename="a.pdf")
    m.add_attachment(b"bad", maintype="application", subtype="pdf", filename="b.pdf")
    m.add_attachment(b"ok", maintype="application", subtype="x", filename="c.XLSX")
    source = samples.write_files(tmp_path / "in", {"x/docs.eml": m.as_bytes()})

    def pdf(data: bytes):
        if data == b"bad":
            raise ValueError("not a pdf")
        return [{"section_no": 1, "block_no": 0, "kind": "text", "text": "Page text"}]

    def xlsx(data: bytes):
        return [{"section_no": 0, "section_title": "Data", "block_no": 0, "kind": "table", "rows": [["Name", "Value"], ["Alpha", 1], [None, " "], [None, True]]}]

    root = str(tmp_path / "out")
    run_batch(spark, source, root, decoders={"pdf": pdf, "xlsx": xlsx})
    pages = {r.filename: r for r in Tables(spark, root).read("attachment_content").collect()}
    assert set(pages) == {"a.pdf", "c.XLSX"}
    assert pages["a.pdf"].markdown.endswith("## Page 1\n\nPage text\n")
    assert json.loads(pages["c.XLSX"].metadata_json)["data"] == {"sheets": [{"sheet": "Data", "rows": [["Name", "Value"], ["Alpha", 1], ["", True]]}]}
    assert "| Alpha | 1 |" in pages["c.XLSX"].markdown
    counted = Tables(spark, root).read("run_metrics").first()
    assert (counted.attachments_extracted, counted.decode_errors, counted.extraction_failures) == (2, 1, 0)


def test_export_and_collisions(spark, source, tmp_path):
    root, target = str(tmp_path / "out"), tmp_path / "objects"
    run_batch(spark, source, root)
    pages = Tables(spark, root).read("content")
    sinks.export_objects(sinks.objects(pages), f"file://{target}")
    files = [p for p in target.rglob("*") if p.is_file()]
    assert len(files) == 18
    sidecar = next(p for p in files if p.suffix == ".json" and "caf" in p.name)
    assert "Café" in sidecar.read_text(encoding="utf-8")
    double = sinks.objects(pages.unionByName(pages))
    again = tmp_path / "again"
    single = double.limit(0).unionByName(spark.createDataFrame([("x/one.md", bytearray(b"1")), (None, None)], "output_key string, content binary"))
    report = sinks.export_objects(double.unionByName(single), f"file://{again}")
    assert report.count() == 19 and report.filter("n = 2").count() == 18
    assert [p.name for p in again.rglob("*") if p.is_file()] == ["one.md"]


def test_claim_any_keeps_one_of_each(spark, source, tmp_path):
    schema = "identity string, modification_time timestamp"
    spark.createDataFrame([("a", None), ("a", None), ("b", None)], schema).write.parquet(str(tmp_path / "u"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "u"))
    q = claim_any(stream).writeStream.format("memory").queryName("claimed_any").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("claimed_any"), "identity") == [("a",), ("b",)]


def test_forget_clear_and_backfill(spark, source, tmp_path):
    root = str(tmp_path / "out")
    tables = Tables(spark, root)
    assert run_batch(spark, source, root, prefix="emails/misc/") == 0
    assert tables.read("content").count() == 3
    assert run_batch(spark, source, root) == 1
    before = rows(tables.read("content"), "identity")
    assert len(before) == 9
    known, pages = tables.registry().count(), tables.read("content").count()
    assert tables.forget(prefix="emails/2026-07-27/att", dry_run=True) == 1
    assert tables.clear("content", "emails-extracted/", "emails-extracted/content/2026-07-15/", dry_run=True) == 1
    assert (tables.registry().count(), tables.read("content").count()) == (known, pages)
    assert tables.forget(prefix="emails/2026-07-27/att") == 1
    assert tables.forget(keys=["<direct-1@example.com>", "unknown"]) == 1
    assert tables.registry().count() == 7
    assert tables.clear("content", "emails-extracted/", "emails-extracted/content/2026-07-15/") == 1
    assert tables.read("content").count() == 8
    with pytest.raises(ValueError):
        tables.clear("content", "emails-extracted/", "elsewhere/")
    assert run_batch(spark, source, root) == 2
    assert rows(tables.read("content").filter("batch_id = 2"), "identity") == [("<att-1@example.com>",), ("<direct-1@example.com>",)]
    tables.publish("content", str(tmp_path / "by_day"))
    published = spark.read.parquet(str(tmp_path / "by_day"))
    assert rows(published, "output_key") == rows(tables.read("content"), "output_key")
    assert tables.forget(everything=True) == 9 and tables.registry().count() == 0
    assert run_batch(spark, source, root) == 3
    keys = [r["output_key"] for r in tables.read("content").collect()]
    assert len(keys) == len(set(keys)) == 9
    # A cleared page is gone in all its versions, until it is processed again.
    assert tables.clear("content", "emails-extracted/", "emails-extracted/content/2026-07-27/") == 8
    assert tables.read("content").filter("send_date = '2026-07-27'").count() == 0
    assert tables.clear("content", "emails-extracted/") == 1 and tables.read("content").count() == 0
    tables.forget(keys=["<direct-1@example.com>"])
    assert run_batch(spark, source, root) == 4
    assert rows(tables.read("content"), "identity") == [("<direct-1@example.com>",)]


def test_attachments_of_one_name_stay_apart(spark, tmp_path):
    """Same subject, time, file name and a long common stem, in two batches."""
    def mail(number):
        m = samples.message("Same", "Body.\n", mid=f"<same-{number}@example.com>")
        for text in (b"first", b"second"):
            m.add_attachment(text + str(number).encode(), maintype="text", subtype="plain", filename="report.txt")
        return m.as_bytes()

    root, stem = str(tmp_path / "out"), "s" * 60
    source = samples.write_files(tmp_path / "in", {f"2026-07-27/{stem}1.eml": mail(1)})
    run_batch(spark, source, root)
    samples.write_files(tmp_path / "in", {f"2026-07-27/{stem}2.eml": mail(2)})
    run_batch(spark, source, root)
    pages = Tables(spark, root).read("attachment_content").collect()
    assert len({r.output_key for r in pages}) == len(pages) == 4
    assert {w for r in pages for w in r.markdown.split() if w[-1] in "12" and w[:1] in "fs" and w[:3] in ("fir", "sec")} == {"first1", "second1", "first2", "second2"}


def queue_of(spark, *keys, bucket="in"):
    return backfill.requests(spark.createDataFrame([(k,) for k in keys], "source_key string"), bucket).select("body")


def test_events_are_fetched_and_failures_reported(spark, source, tmp_path):
    root, store = str(tmp_path / "out"), f"file://{tmp_path}/{{bucket}}"
    keys = ["emails/2026-07-27/direct.eml", "emails/misc/latin.eml", "emails/gone.eml", "emails/2026-07-27/direct.eml", "emails/notes.txt", "other/x.eml"]
    queue = queue_of(spark, *keys).unionByName(spark.createDataFrame([('{"Records": [{"s3": {"bucket": {"name": "in"}}}]}',), ("junk",)], "body string"))
    assert run_events(queue, root, store) == 0
    tables = Tables(spark, root)
    assert rows(tables.read("content"), "identity") == [("<direct-1@example.com>",), ("<latin-1@example.com>",)]
    bad = sorted((r.source_key or "", r.error) for r in tables.read("quarantine").collect())
    assert bad == [("", "record without bucket or key"), ("emails/gone.eml", "missing object")]


def test_objects_in_ranges_and_beyond_a_value(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "odd name+%é.eml").write_bytes(bytes(range(256)) * 50)
    (tmp_path / "b" / "large.eml").write_bytes(b"x" * 20_000)
    (tmp_path / "b" / "folder.eml").mkdir()
    (tmp_path / "b" / "empty.eml").write_bytes(b"")
    named = spark.createDataFrame([("b", k) for k in ("odd name+%é.eml", "large.eml", "folder.eml", "none.eml", "empty.eml")], "bucket string, source_key string")
    found = {r.source_key: r for r in objects.fetch(named, f"file://{tmp_path}/{{bucket}}", most_bytes=15_000, range_bytes=700).collect()}
    assert bytes(found["odd name+%é.eml"].content) == bytes(range(256)) * 50 and found["odd name+%é.eml"].error is None
    assert found["large.eml"].content is None and "beyond 15000" in found["large.eml"].error and found["large.eml"].length == 20_000
    assert found["folder.eml"].error == found["none.eml"].error == "missing object" and found["empty.eml"].content == b""


def test_event_stream_retries_to_the_fifth_failure(spark, source, tmp_path):
    """Seven batches: one object never comes, one comes after the second failure; the store is asked five times."""
    root, store, folder = str(tmp_path / "out"), f"file://{tmp_path}/{{bucket}}", tmp_path / "queue"
    folder.mkdir()
    late = tmp_path / "in" / "emails" / "late.eml"
    for number in range(7):
        keys = ["emails/gone.eml", "emails/late.eml"] if number == 0 else [f"emails/none-{number}.txt"]
        queue_of(spark, *keys).coalesce(1).write.mode("append").json(str(folder))
        if number == 2:
            late.write_bytes(samples.message("Late", "Here.\n", mid="<late-1@example.com>").as_bytes())
        stream = spark.readStream.schema("body string").json(str(folder))
        run_event_stream(stream, root, store).awaitTermination()
    tables = Tables(spark, root)
    got = rows(tables.attempts(), "source_key", "attempt", "state", "batch_id")
    assert [r for r in got if "late" in r[0]] == [("emails/late.eml", 1, "retry", 0), ("emails/late.eml", 2, "retry", 1)]
    assert [r[1:] for r in got if "gone" in r[0]] == [(n, "retry" if n < 5 else "dead", n - 1) for n in range(1, 6)]
    assert rows(tables.read("content"), "identity", "batch_id") == [("<late-1@example.com>", 2)]


def test_enqueue_counts(spark, source, tmp_path):
    queue = str(tmp_path / "queue")
    assert tuple(backfill.enqueue(spark, source, "in", queue, "emails/misc/").first()) == (3, 3, 1)
    assert tuple(backfill.enqueue(spark, source, "in", queue, "emails/2026-07", dry_run=True).first()) == (6, 0, 0)
    assert tuple(backfill.enqueue(spark, source, "in", queue, "emails/none").first()) == (0, 0, 0)
    backfill.enqueue(spark, source, "in", queue)
    root = str(tmp_path / "out")
    run_events(spark.read.schema("body string").json(queue), root, f"file://{tmp_path}/{{bucket}}")
    assert Tables(spark, root).read("content").count() == 9


def test_exported_names_are_stored(spark, tmp_path):
    """every key comes back with its number of rows, and its file is read by it in a task."""
    df = spark.createDataFrame([("a/1.md", bytearray(b"x")), ("a/2.md", bytearray(b"")), ("b", bytearray(b"1")), ("b", None)], "output_key string, content binary")
    told = sinks.exported(df, str(tmp_path))
    assert rows(told, "output_key", "n") == [("a/1.md", 1), ("a/2.md", 1), ("b", 2)]
    named = told.select(told.output_key.alias("source_key")).selectExpr("'x' AS bucket", "source_key")
    store = f"file://{tmp_path}"
    read = objects.contents(objects.fetch(named.filter("source_key <> 'b'"), store))
    assert rows(read, "source_key", "content") == [("a/1.md", bytearray(b"x")), ("a/2.md", bytearray(b""))]
    with pytest.raises(Exception, match="missing object"):
        objects.contents(objects.fetch(named, store)).collect()


@pytest.mark.parametrize("stream", [True, False])
def test_many_small_files_go_to_few_tasks(spark, tmp_path, stream):
    """F7, F8, F11: tasks go by bytes, not by four files each; the session's settings are as before."""
    mails = {f"2026-07-27/m{i}.eml": samples.message("S", f"Body {i}.\n", mid=f"<m{i}@example.com>").as_bytes() for i in range(60)}
    source, root = samples.write_files(tmp_path, mails), str(tmp_path / "out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    before = dict(spark.conf.getAll)
    try:
        run_stream(spark, source, root).awaitTermination() if stream else run_batch(spark, source, root)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert before == {**dict(spark.conf.getAll), "spark.sql.files.maxPartitionBytes": "4m"}
    assert len(list((tmp_path / "out" / "emails" / "batch_id=0").glob("*.parquet"))) <= 10
    assert Tables(spark, root).read("content").count() == 60


def test_headers_are_parsed_once():
    """F7, F8, F10 to F12: as the default policy reads them, without parsing each one at every look."""
    from email import policy
    from email.parser import BytesParser

    for raw in samples.mailbox_files().values():
        whole = BytesParser(policy=policy.default).parsebytes(raw)
        messages._header.cache_clear()
        got = messages._decode_message(raw)
        assert {c: got[c] for c in messages._HEADERS} == {c: messages._clean(whole[n]) for c, n in messages._HEADERS.items()}
        if whole["Content-Type"]:
            assert messages._header.cache_info().hits > 0


@pytest.mark.parametrize("prefix", [None, "emails/misc/", "emails/2026-07-2", "emails/none/"])
@pytest.mark.parametrize("below", ["in/emails", "in"])
def test_names_listed_in_tasks_are_those_of_a_scan(spark, tmp_path, below, prefix):
    """F3 to F5: folder by folder, no name passes through the driver; hidden and other files are left out as by Spark."""
    names = ("2026-07-27/a.eml", "2026-07-27/deep/er/b.EML", "2026-08-01/c.eml", "misc/d.eml", "misc/emails/e.eml", "misc/.f.eml", "_g/h.eml", "misc/i.txt", "misc/j.eml")
    for name in names:
        path = tmp_path / below / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name == "misc/j.eml" else name.encode())
    root = str(tmp_path / "in")
    got = messages.read_messages(messages.list_messages(spark, root, prefix=prefix), root)
    want = messages.scan_messages(spark, root, prefix=prefix)
    # A scan by prefix keeps an empty file's name but reads no row of it.
    want, got = (rows(df.filter("length > 0"), "source_key", "length", "content", "modification_time") for df in (want, got))
    assert got == want and len(got) == {None: 5, "emails/misc/": 2, "emails/2026-07-2": 2, "emails/none/": 0}[prefix]


def test_stream_keeps_the_paths_of_finished_batches(spark, tmp_path):
    """files are new by path, whatever their date; pages lie in few files, whatever the days they are of."""
    day = "Mon, {:02} Jul 2026 10:00:00 +0000".format
    mail = lambda i: samples.message("S", f"Body {i}.\n", mid=f"<m{i}@example.com>", date=day(i)).as_bytes()
    source, root = samples.write_files(tmp_path, {f"2026-07-{i:02}/m.eml": mail(i) for i in range(1, 7)}), str(tmp_path / "out")
    tables = Tables(spark, root)
    run_stream(spark, source, root, max_files_per_trigger=4).awaitTermination()
    assert [r["n"] for r in tables.read("listed").groupBy("batch_id").count().orderBy("batch_id").selectExpr("count AS n").collect()] == [4, 2]
    assert len(list((tmp_path / "out" / "content" / "batch_id=0").rglob("*.parquet"))) == 1
    late = tmp_path / "emails" / "2026-07-01" / "late.eml"
    late.write_bytes(mail(7))
    os.utime(late, (1, 1))
    run_stream(spark, source, root).awaitTermination()
    assert rows(tables.read("content").filter("batch_id = 2"), "identity") == [("<m7@example.com>",)]
    assert tables.read("listed").count() == tables.read("content").count() == 7


def test_plain_headers_are_as_parsed():
    """values that are not parsed stand as the default policy reads them."""
    from email import message_from_bytes, policy

    values = ("user7 <user7@example.com>", "A B <a@b>", '"A, B" <a@b.c>', "a@b.c", "A  B <a@b.c>", "A <a@b.c>, B <b@b.c>", "A <a@b.c> (x)", "Re: Topic 7", "=?utf-8?q?caf=C3=A9?=", "a =?utf-8?q?b?= c", "two  blanks", "end ", "tab\there", "A <a..b@c>")
    for value in values:
        raw = "".join(f"{name}: {value}\n" for name in ("From", "To", "Cc", "Subject")).encode() + b"\n\n"
        whole, got = message_from_bytes(raw, policy=policy.default), messages._decode_message(raw)
        assert [got[c] for c in ("from_", "to_", "cc", "subject")] == [str(whole[n]) for n in ("From", "To", "Cc", "Subject")], value
    assert type(messages._POLICY.header_fetch_parse("From", values[0])) is str
