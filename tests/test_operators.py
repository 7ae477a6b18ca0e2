"""Operators on small tables, including very uneven ones."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from mailloom.operators import attachments as att
from mailloom.operators import dedup, documents, monitor, quality, ranking, retrieval
from mailloom.plans import queries
from mailloom.sources import notifications, sinks
from tests.conftest import SF_SMALL

UNIT = "identity string, modification_time timestamp, source_key string, unit_order int, body string"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def units(spark, *items):
    import datetime

    base = datetime.datetime(2026, 1, 1)
    data = [(i, base + datetime.timedelta(minutes=t), k, o, "b") for i, t, k, o in items]
    return spark.createDataFrame(data, UNIT)


def test_first_writer_order(spark):
    df = units(spark, ("a", 2, "k1", 0), ("a", 1, "k9", 1), ("a", 1, "k9", 0), ("a", 1, "k8", 3), ("b", 5, "x", 0))
    got = rows(dedup.claim(df), "identity", "source_key", "unit_order", "copies", "is_new")
    assert got == [("a", "k8", 3, 4, True), ("b", "x", 0, 1, True)]


def test_claim_against_registry(spark):
    df = units(spark, ("a", 1, "k", 0), ("b", 1, "k", 1), ("b", 2, "k", 2))
    known = spark.createDataFrame([("b",), ("b",), ("z",)], "identity string")
    claims = dedup.claim(df, known)
    assert rows(claims, "identity", "copies", "is_new") == [("a", 1, True), ("b", 2, False)]
    assert rows(dedup.accepted(claims), "identity") == [("a",)]


def test_registry_selection(spark):
    registry = spark.createDataFrame([("a", "emails/x/1", 0), ("b", "emails/y/1", 2)], "identity string, source_key string, batch_id long")
    pick = dedup.select_identities
    assert rows(pick(registry, everything=True)) == [("a",), ("b",)]
    assert rows(pick(registry, keys=["b", "q"])) == [("b",)]
    assert rows(pick(registry, keys=registry.filter("identity = 'a'"))) == [("a",)]
    assert rows(pick(registry, prefix="emails/y/")) == [("b",)]
    with pytest.raises(ValueError):
        pick(registry)
    assert rows(dedup.forget_identities(registry, pick(registry, keys=["b"])), "identity") == [("a",)]


def test_positions_with_one_dominant_group(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.6 else f"g{rng.randint(0, 30)}", i) for i in range(3000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, n int").repartition(7)
    want = []
    for g in {g for g, _ in data}:
        want += [(g, n, p) for p, n in enumerate(sorted(n for h, n in data if h == g))]
    assert rows(ranking.with_position(df, ["n"], ["g"])) == sorted(want, key=repr)
    for bits in ([8], [3, 7, 11]):
        assert rows(ranking.with_position(df, ["n"], ["g"], ranking.whole_levels("n", bits))) == sorted(want, key=repr)
    order = sorted((n, g) for g, n in data)
    everywhere = ranking.with_position(df, ["n"], levels=ranking.whole_levels("n", [2, 9]))
    assert rows(everywhere, "n", "position") == sorted(((n, i) for i, (n, _) in enumerate(order)), key=repr)
    with pytest.raises(ValueError):
        ranking.with_position(df, ["n"])


def test_positions_over_texts_and_nulls(spark):
    rng = random.Random(2)
    names = [None, "", "a", "a-c/d", "a/b", "a/b/c", "a/c", "\u00e9\u00e9x", "\U0001f600z", "\uffeey", "zz"]
    data = [(g, n, i) for i, (g, n) in enumerate((rng.choice([None, "g", "h"]), rng.choice(names)) for _ in range(400))]
    df = spark.createDataFrame(data, "g string, s string, n long").repartition(5)
    levels = [*ranking.text_levels("s", [3, 1]), F.col("s"), *ranking.whole_levels("n", [4])]
    want = []
    for g in (None, "g", "h"):
        own = sorted((s is not None, (s or "").encode(), n, s) for h, s, n in data if h == g)
        want += [(g, s, n, p) for p, (_, _, n, s) in enumerate(own)]
    assert rows(ranking.with_position(df, ["s", "n"], ["g"], levels)) == sorted(want, key=repr)
    assert rows(ranking.with_position(df.limit(0), ["s", "n"], ["g"], levels)) == []
    negative = spark.createDataFrame([(n,) for n in (-(1 << 63), -70_000, -1, 0, 65_536, (1 << 63) - 1)], "n long")
    placed = ranking.with_position(negative, ["n"], levels=ranking.whole_levels("n", [16, 32, 48]))
    assert [r.position for r in placed.orderBy("n").collect()] == list(range(6))


def test_threads_that_share_their_short_id(spark):
    """Positions go by the whole subject, replies included; undated mails of one time text by their digest."""
    mails = [("d1", "Plan", "20260701T080000Z"), ("d1", "RE: plan", "20260701T090000Z"), ("d1", "Other", "20260701T083000Z"), ("d2", "Plan", "20260702T000000Z")]
    mails += [("undated", None, "00000000T000000Z")] * 40
    content = spark.createDataFrame(
        [(d, "same0000", s, t, f"{i * 2654435761 % (1 << 32):08x}", f"k{i}") for i, (d, s, t) in enumerate(mails)],
        "send_date string, thread string, subject string, sent_text string, hash8 string, output_key string",
    )
    listed = {r["output_key"]: r for r in retrieval.thread_listing(content).collect()}
    assert [listed[f"k{i}"]["thread_position"] for i in range(4)] == [1, 2, 1, 1]
    undated = sorted((r for r in listed.values() if r["send_date"] == "undated"), key=lambda r: r["hash8"])
    assert [r["thread_position"] for r in undated] == list(range(1, 41))
    assert set(listed["k0"].asDict()) == {*content.columns, "thread_position"}
    assert retrieval.thread_listing(content, "d2").count() == 1


def test_chunks(spark):
    df = spark.createDataFrame([(f"k{i:03d}", i % 4 == 0) for i in range(25)], "k string, ok boolean")
    chunks = ranking.assign_chunks(df, 10, ["k"], ranking.text_levels("k", [2, 3]))
    assert rows(ranking.chunk_report(chunks, F.col("ok"))) == [(0, 10, 3), (1, 10, 2), (2, 5, 2)]


def test_identity_filters(spark):
    """A filter lets through all it holds and few others, over batches of several sizes."""
    known = [spark.range(a, b).select(F.concat(F.lit("id-"), "id").alias("identity")) for a, b in ((0, 10), (10, 5000), (5000, 40_000))]
    slots = [dedup.slots_for(n) for n in (10, 4990, 35_000)]
    assert slots == [1, 4, 32] and dedup.slots_for(0) == 1
    filters = [dedup.identity_filters(dedup.with_hash(k), n) for k, n in zip(known, slots)]
    every = filters[0].unionByName(filters[1]).unionByName(filters[2])
    asked = dedup.with_hash(spark.range(0, 60_000).select(F.concat(F.lit("id-"), "id").alias("identity")))
    passed = dedup.maybe_known(asked, every, sorted(set(slots))).select(F.substring("identity", 4, 9).cast("long").alias("n"))
    inside, outside = passed.agg(F.count_if(F.col("n") < 40_000), F.count_if(F.col("n") >= 40_000)).first()
    assert inside == 40_000 and outside < 600


def document(lines, order, column, separator):
    return separator.join(r[column] for r in sorted(lines, key=lambda r: tuple(r[c] for c in order)))


def test_tables_as_lines(spark):
    data = [("big", i, [str(i)] + (["wide", "x"] if i == 57 else [])) for i in range(3, 100)] + [("big", 0, [])]
    data += [("small", i, ["s", str(i), None]) for i in range(2)] + [("none", 0, []), (None, 4, ["a|b"])]
    df = spark.createDataFrame(data, "g string, n int, c array<string>").repartition(5)
    found = {}
    for r in documents.rows_to_lines(df, ["g"], "n", "c").collect():
        found.setdefault(r.g, []).append(r)
    shown = {g: document(rs, ("n", "sub"), "line", "\n").split("\n") for g, rs in found.items()}
    assert set(shown) == {"big", "small", None}
    assert shown["big"][:3] == ["| 3 |  |  |", "| --- | --- | --- |", "| 4 |  |  |"] and len(shown["big"]) == 98
    assert "| 57 | wide | x |" in shown["big"]
    assert shown["small"] == ["| s | 0 |  |", "| --- | --- | --- |", "| s | 1 |  |"] and shown[None] == ["| a\\|b |", "| --- |"]


def test_workbooks_as_lines(spark, tmp_path):
    data = []
    for row in range(40):
        for col in range(3):
            data.append(("d", 0, "S", row, col, None if row in (0, 1, 2, 7) else f"{row}.{col}"))
    data += [("d", 1, "T", 0, 0, "t"), ("e", 0, "U", 0, 0, "u"), ("e", 1, "V", 0, 0, " ")]
    schema = "doc_id string, section_no int, section_title string, row_no int, col_no int, cell string"
    cells = spark.createDataFrame(data, schema).repartition(4)
    lines = documents.sheets_to_lines(cells)
    files = sinks.write_texts(lines, "doc_id", ["section_no", "row_no", "sub"], "line", str(tmp_path))
    assert rows(files) == [("d", 44), ("e", 4)]
    text = (tmp_path / "d").read_text()
    assert text.startswith("## S\n\n| 3.0 | 3.1 | 3.2 |\n| --- | --- | --- |\n| 4.0") and text.endswith("| 39.0 | 39.1 | 39.2 |\n\n## T\n\n| t |\n| --- |")
    assert (tmp_path / "e").read_text() == "## U\n\n| u |\n| --- |"
    assert "| 7." not in text
    typed = cells.withColumn("cell", F.when(F.col("cell") == "u", F.lit(1).cast("variant")).otherwise(F.col("cell").cast("variant")))
    got = {r.data for r in documents.sheets_to_lines(typed).filter("data IS NOT NULL AND (doc_id = 'e' OR row_no = 3)").collect()}
    assert got == {"[1]", '["3.0","3.1","3.2"]'}


def test_decks_and_pages_as_pieces(spark):
    blocks = [(1, 0, "notes", " n "), (1, 3, "text", "b"), (1, 1, "table", "a"), (2, 0, "text", " "), (3, 0, "table", "t"), (3, 1, "text", "x")]
    df = spark.createDataFrame([("d", *b) for b in blocks], "doc_id string, section_no int, block_no int, kind string, text string")
    whole = lambda found: document(found.collect(), ("section_no", "place", "block_no"), "piece", documents.PIECE_BREAK)
    assert whole(documents.slides_to_pieces(df)) == "## Slide 1\n\na\n\nb\n\n**Notes:** n\n\n## Slide 2\n\n## Slide 3\n\nt\n\nx"
    assert whole(documents.pages_to_pieces(df)) == "## Page 1\n\n**Notes:** n\n\nb\n\na\n\n## Page 2\n\n## Page 3\n\nx\n\nt"
    got = documents.paragraphs_to_pieces(df.drop("section_no").filter("kind <> 'notes'")).collect()
    assert document(got, ("place", "block_no"), "piece", "|") in ("x|b|a|t", "x|b|t|a")


def test_whole_tables(spark):
    """one text per group, with every row and cell, a hot group and a NULL one included."""
    data = [("big", i, [str(i), "a|b", None]) for i in range(3_000)] + [("small", 1, ["x"]), ("none", 0, []), (None, 4, ["y", "z"])]
    df = spark.createDataFrame(data, "g string, n int, c array<string>").repartition(5)
    got = {r.g: r.markdown for r in documents.rows_to_markdown(df, ["g"], "n", "c").collect()}
    want = [f"| {i} | a\\|b |  |" for i in range(3_000)]
    assert got == {"big": "\n".join([want[0], "| --- | --- | --- |", *want[1:]]), "small": "| x |\n| --- |", None: "| y | z |\n| --- | --- |"}


def test_whole_workbooks(spark):
    """one text and its typed sheets per workbook; blank rows and sheets are left out."""
    data = [("d", 1, "T", 5, 0, "1"), ("d", 0, "S", 2, 1, '"b"'), ("d", 0, "S", 2, 0, "7"), ("d", 0, "S", 1, 0, '" "'), ("d", 0, "S", 9, 0, "true"), ("d", 0, "S", 9, 1, None)]
    data += [("d", 2, "U", 0, 0, '" "'), (None, 0, None, 0, 0, '"n"')]
    cells = spark.createDataFrame(data, "doc_id string, section_no int, section_title string, row_no int, col_no int, cell string")
    cells = cells.withColumn("cell", F.parse_json("cell")).repartition(4)
    got = {r.doc_id: (r.markdown, r.data) for r in documents.sheets_to_documents(cells).collect()}
    assert got["d"][0] == "## S\n\n| 7 | b |\n| --- | --- |\n| true |  |\n\n## T\n\n| 1 |\n| --- |"
    assert json.loads(got["d"][1]) == {"sheets": [{"sheet": "S", "rows": [[7, "b"], [True, ""]]}, {"sheet": "T", "rows": [[1]]}]}
    assert set(got) == {"d", None} and got[None][0] == "## \n\n| n |\n| --- |"


def test_sheets_of_the_query_move_once(spark):
    """rows, sheets and workbooks share the exchange of the row numbers."""
    plan = queries.queries()["sheet_documents"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan


def test_whole_paragraphs(spark):
    """a document whose blocks show nothing has a row too."""
    blocks = [("d", 3, "text", "b"), ("d", 1, "table", "t"), ("d", 0, "text", " a "), ("d", 2, "text", " "), ("e", 0, "text", " "), (None, 0, "text", "n")]
    df = spark.createDataFrame(blocks, "doc_id string, block_no int, kind string, text string").repartition(3)
    assert {tuple(r) for r in documents.paragraphs_to_documents(df).collect()} == {("d", "a\n\nb\n\nt"), ("e", ""), (None, "n")}


def test_whole_decks_and_pages(spark):
    """the same texts as their pieces give in order."""
    blocks = [(1, 0, "notes", " n "), (1, 3, "text", "b"), (1, 1, "table", "a"), (2, 0, "text", " "), (10, 0, "table", "t"), (10, 1, "text", "x")]
    df = spark.createDataFrame([(d, *b) for b in blocks for d in ("d", None)], "doc_id string, section_no int, block_no int, kind string, text string").repartition(3)
    slides = "## Slide 1\n\na\n\nb\n\n**Notes:** n\n\n## Slide 2\n\n## Slide 10\n\nt\n\nx"
    pages = "## Page 1\n\n**Notes:** n\n\nb\n\na\n\n## Page 2\n\n## Page 10\n\nx\n\nt"
    for made, text in ((documents.slides_to_documents, slides), (documents.pages_to_documents, pages)):
        assert {tuple(r) for r in made(df).collect()} == {("d", text), (None, text)}


def test_lines_of_a_document_in_half_of_all_rows(spark, tmp_path):
    """One document holds most lines; it is written whole and in order."""
    lines = spark.range(0, 30_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 50)).alias("k"), F.col("id").alias("n"), F.col("id").cast("string").alias("t"))
    report = sinks.write_texts(lines.repartition(9), "k", ["n"], "t", str(tmp_path))
    assert report.count() == 26 and (tmp_path / "hot").read_text() == "\n".join(str(i) for i in range(0, 30_000, 2))


def test_attachment_refs(spark):
    data = [("m", i, f"f{i}", f"o{i}", "t") for i in range(12)] + [("n", 0, "f", "o", "t")]
    df = spark.createDataFrame(data, "source_key string, part_no int, filename string, output_key string, content_type string")
    whole = {r.source_key: [x.filename for x in r.refs] for r in att.attachment_refs(df).collect()}
    assert whole == {"m": [f"f{i}" for i in range(12)], "n": ["f"]}


def test_attachments_follow_the_first_accepted_unit(spark):
    top = spark.createDataFrame(
        [("a", 0, "d", "t"), ("a", 1, "d", "t"), ("b", 1, "d", "t")], "source_key string, unit_order int, send_date string, thread string"
    ).withColumn("sent_at", F.lit(None).cast("timestamp_ntz"))
    parts = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "source_key string, part_no int")
    assert rows(att.attach_to_top(top, parts), "source_key", "part_no") == [("a", 0), ("a", 1)]


def test_size_guard_keeps_the_limit_itself(spark):
    df = spark.createDataFrame([(bytearray(5),), (bytearray(6),), (None,)], "data binary")
    kept, oversize = att.within_size(df, 5)
    assert kept.count() == 2 and oversize.count() == 1


def test_flatten_events(spark):
    def wrap(*keys):
        return json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in keys]})

    bodies = [
        ("1", wrap("emails/x+y.eml")), ("2", '{"Event": "s3:TestEvent"}'), ("3", "{bad"), ("4", '{"Records": [{"other": 1}]}'),
        ("5", wrap("a%20b%2Bc", "50%off%zz")), ("6", "{}"), ("7", None),
    ]
    df = spark.createDataFrame(bodies, "id string, body string")
    assert rows(notifications.flatten_events(df)) == [
        ("1", "b", "emails/x y.eml"), ("5", "b", "50%off%zz"), ("5", "b", "a b+c"),
    ]
    broken = spark.createDataFrame([("9", '{"Records": [{"s3": {"bucket": {"name": "b"}}}, {"other": 1}]}')], "id string, body string")
    assert notifications.flatten_events(broken).count() == 0
    assert rows(notifications.failed_events(broken), "id", "bucket", "key") == [("9", "b", None)]
    record = json.dumps(json.loads(wrap("k"))["Records"][0])
    direct = spark.createDataFrame([("8", None, record)], "id string, body string, record string")
    assert rows(notifications.flatten_events(direct, "body", "record")) == [("8", "b", "k")]


def test_retry_or_dead(spark):
    df = spark.createDataFrame([("a",)] * 4 + [("b",)] * 5, "source_key string")
    assert rows(monitor.retry_or_dead(df)) == [("a", 4, "retry"), ("b", 5, "dead")]


def test_ledger_counts_to_the_fifth_failure(spark):
    work = spark.createDataFrame([("b", "k", 0), ("b", "l", 3), ("b", "m", 4), ("b", "fine", 2)], "bucket string, source_key string, attempt int")
    failed = spark.createDataFrame([("k", "e"), ("l", "e"), ("l", "f"), ("m", "e"), (None, "no key")], "source_key string, error string")
    got = rows(monitor.ledger(work, failed), "source_key", "attempt", "error", "state")
    assert got == [("k", 1, "e", "retry"), ("l", 4, "e", "retry"), ("m", 5, "e", "dead")]


def test_zero_counters_are_not_flushed(spark, tmp_path):
    zero = spark.createDataFrame([tuple([0] * 7)], ", ".join(f"{c} bigint" for c in monitor.COUNTERS))
    monitor.flush_counters(zero, str(tmp_path / "m"), 0)
    one = zero.withColumn("dedup_skips", F.lit(2).cast("bigint"))
    monitor.flush_counters(one, str(tmp_path / "m"), 1)
    monitor.flush_counters(one, str(tmp_path / "m"), 1)
    assert rows(spark.read.schema(zero.schema).parquet(str(tmp_path / "m") + "/*"), "dedup_skips") == [(2,)]


def test_alarm_windows_stream_equals_batch(spark, tmp_path):
    import datetime

    base = datetime.datetime(2026, 1, 1)
    data = [(base + datetime.timedelta(minutes=m), d, e) for m, d, e in [(0, 0, 0), (4, 2, 0), (5, 0, 1), (11, 0, 0), (300, 0, 0)]]
    df = spark.createDataFrame(data, "ts timestamp, depth int, errors int")
    df.write.parquet(str(tmp_path / "e"))
    batch = sorted(tuple(r) for r in monitor.alarm_windows(df).collect())
    assert [r[3:] for r in batch] == [(True, False), (False, True), (False, False), (False, False)]
    stream = monitor.alarm_windows(spark.readStream.schema(df.schema).parquet(str(tmp_path / "e")), lateness="10 minutes")
    q = stream.writeStream.format("memory").queryName("alarms").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    # The last window stays open until the watermark passes it.
    assert sorted(tuple(r) for r in spark.table("alarms").collect()) == batch[:-1]


def test_clear_is_guarded(spark):
    df = spark.createDataFrame([("out/content/a",), ("out/attachments/b",), ("other/c",)], "output_key string")
    kept, cleared = retrieval.clear_outputs(df, "out/", "out/content/")
    assert rows(cleared) == [("out/content/a",)] and kept.count() == 2
    with pytest.raises(ValueError):
        retrieval.clear_outputs(df, "out/", "other/")
    assert rows(retrieval.clear_outputs(df, "out/", "other/", force=True)[1]) == [("other/c",)]
    assert rows(retrieval.clear_outputs(df, "out/")[0]) == [("other/c",)]


def test_checks(spark):
    keys = spark.createDataFrame(
        [("2026-07-01", "x/content/2026-07-01/0123abcd__20260701T000000Z__a-b__89abcdef.md"), ("undated", "x/content/undated/bad.md")],
        "send_date string, output_key string",
    )
    assert rows(quality.check_keys(keys)) == [("2026-07-01", 1, 0), ("undated", 1, 1)]
    text = spark.createDataFrame([(1, "a < b and c > d"), (2, "<p>"), (3, "x=20y"), (4, chr(0xC3) + chr(0xA9))], "k int, t string")
    assert rows(quality.check_residue(text, "k", "t"), "k") == [(2,), (3,), (4,)]
