"""Scalar operators on literal cases."""

from __future__ import annotations

import json

from datetime import timezone
from email.utils import parsedate_to_datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mailloom.functions import dates, documents, html, render, text, threads


def values(spark, column, inputs, schema="x string"):
    df = spark.createDataFrame([(i,) for i in inputs], schema)
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_slugify(spark):
    cases = {"Fw: Alpha Site / Gas!": "fw-alpha-site-gas", "": "untitled", "!!!": "untitled", "--": "untitled"}
    assert values(spark, text.slugify, cases) == list(cases.values())
    assert values(spark, lambda c: text.slugify(c, 20), ["a" * 200]) == ["a" * 20]
    assert values(spark, lambda c: text.slugify(c, 3), ["ab cd"]) == ["ab"]


def test_normalize_subject_and_thread(spark):
    cases = {"Re: Fw: Alpha Site": "alpha site", "FWD:  Plan  ": "plan", "AW [2]: x": "x", "Regarding: y": "regarding: y"}
    assert values(spark, text.normalize_subject, cases) == list(cases.values())
    ids = values(spark, text.thread_id, ["Plan", "re: PLAN", "Other", "", "Re:"])
    assert ids[0] == ids[1] != ids[2] and ids[3] == ids[4] and all(len(i) == 8 for i in ids)


DATES = [
    "Mon, 27 Jul 2026 13:45:00 +0000", "Mon, 27 Jul 2026 06:45:00 -0700", "", "not a date",
    "Wednesday, July 8, 2026 3:43 PM", "Mon 27 Jul 2026 10:00 EST", "27-Jul-26 10:00:00 GMT",
    "Monday, 27-Jul-26 10:00:00 GMT", "Mon Jul 27 10:00:00 2026", "Mon Jul 27 10:00:00 PDT 2026",
    "Mon,27 Jul 2026 10:00:00 -0000", "27 Jul 69 10:00", "27 Jul 68 1:2:3 XYZ", "31 Feb 2026 10:00:00 +0000",
    "27 Jul 2026 24:00:00 +0000", "27 Jul 2026 10:00:60 +0000", "2026-07-27T10:00:00Z",
    "27 Jul 2026 10.30.11 +0530", "27 July 2026 10:00:00+0200", "Mon, 27 Jul 2026 01:00:00 +9999",
    "July 8 2026, 3:43 PM", "Tue, 1 Sept 2026 10:00:00 +0000", "Mon,  27\tJul 2026 13:45:00 +0000 (UTC)",
]


def library_stamp(value: str) -> str:
    try:
        parsed = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return dates.TIMESTAMP_FALLBACK
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(timezone.utc)
    return parsed.strftime("%Y%m%dT%H%M%SZ")


def test_dates_agree_with_the_standard_library(spark):
    assert values(spark, dates.format_timestamp, DATES) == [library_stamp(d) for d in DATES]


def test_random_dates_agree_with_the_standard_library(spark):
    import random

    rng = random.Random(3)
    months = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec January March august".split()
    zones = "+0000 -0700 +0530 GMT EST PDT XYZ -0000 Z 0200".split()

    def one() -> str:
        day, month, year = rng.randint(0, 32), rng.choice(months), rng.choice([26, 70, 1999, 2026])
        clock = ":".join(f"{rng.randint(0, 61):02d}" for _ in range(rng.choice([2, 3])))
        lead = rng.choice(["", "Mon, ", "Tuesday, ", "wed "])
        shape = rng.randint(0, 2)
        if shape == 0:
            return f"{lead}{day} {month} {year} {clock} {rng.choice(zones)}"
        if shape == 1:
            return f"{lead}{month} {day}, {year} {clock} {rng.choice(['AM', 'PM', ''])}".strip()
        return f"{lead}{month} {day} {clock} {rng.choice(['EST', 'PDT'])} {rng.choice([1999, 2026])}"

    inputs = [one() for _ in range(400)]
    got = values(spark, dates.format_timestamp, inputs)
    assert [(i, g) for i, g in zip(inputs, got) if g != library_stamp(i)] == []


def test_twelve_hour_option_and_days(spark):
    twelve = lambda c: dates.format_timestamp(c, meridiem=True)
    assert values(spark, twelve, ["Wednesday, July 8, 2026 3:43 PM", "July 8, 2026 12:05 AM"]) == [
        "20260708T154300Z", "20260708T000500Z",
    ]
    assert values(spark, dates.format_date, ["Mon, 27 Jul 2026 01:00:00 +0200", "Mon, 27 Jul 2026 23:00:00 -0300", "junk"]) == [
        "2026-07-26", "2026-07-28", None,
    ]


def test_keys(spark):
    assert values(spark, text.date_from_key, ["emails/2026-07-27/a.eml", "emails/misc/a.eml"]) == ["2026-07-27", "undated"]
    assert values(spark, text.key_stem, ["emails/2026-07-27/ENTRY==.eml", "A.EML", "x/b.txt"]) == ["ENTRY==", "A", "b.txt"]
    assert values(spark, text.sidecar_key, ["a.md", "a.md.md", "a"]) == ["a.json", "a.md.json", "a.json"]


def test_identity(spark):
    def ident(mid, body, chars=None):
        df = spark.createDataFrame([(mid, body)], "m string, b string")
        parts = (F.col("m"), F.lit("A"), F.lit("d"), F.lit("s"), F.col("b"))
        return df.select(text.identity(*parts, chars)).first()[0]

    assert ident(" <a@b> ", "x") == "<a@b>"
    assert ident(None, "Hello \t  world") == ident("  ", " hello world ")
    assert ident(None, "x" * 2000 + "a") != ident(None, "x" * 2000 + "b")
    assert ident(None, "x" * 2000 + "a", 2000) == ident(None, "x" * 2000 + "b", 2000)


def python_lines(body: str) -> list[str]:
    return body.splitlines()


BREAKS = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", chr(0x2028), chr(0x2029)]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", " ", chr(0xA0), *BREAKS]), max_size=8).map("".join))
def test_split_lines_matches_python(spark, body):
    assert values(spark, threads.split_lines, [body]) == [python_lines(body)]


def units(spark, body, **kw):
    df = spark.createDataFrame([(body,)], "x string")
    exploded = df.select(F.explode(threads.thread_units(F.col("x"), **kw)).alias("u")).select("u.*")
    folded = exploded.withColumn("h", threads.unfold_headers(F.col("head")))
    names = {"from_": "From", "to_": "To", "date": "Sent|Date", "subject": "Subject"}
    return folded.select("*", *[threads.header_value(F.col("h"), w).alias(n) for n, w in names.items()]).collect()


RULE = "_" * 32


def test_single_mail_and_empty_bodies(spark):
    (only,) = units(spark, "Hi,\n\nnumbers.\n")
    assert only.is_wrapper and only.body == "Hi,\n\nnumbers."
    assert units(spark, "") == [] and units(spark, "  \n \n") == []


def test_header_block_rules(spark):
    body = (
        f"{RULE}\nFrom: Bo\n{RULE}\nSent: Monday, July 6, 2026 9:00 AM\nTo: A;\n  B;\nAttachments: x\nTo: C\n D\nSubject: S\n\n"
        f"{RULE}\nText here.\n\n{RULE}\n"
    )
    (u,) = units(spark, body)
    assert (u.from_, u.to_, u.date, u.subject) == ("Bo", "C D", "Monday, July 6, 2026 9:00 AM", "S")
    assert u.body == "Text here." and not u.is_wrapper


def test_lookahead_is_five_lines(spark):
    near = "From: x\n1\n2\n3\n4\nSent: y\n\nbody"
    far = "From: x\n1\n2\n3\n4\n5\nSent: y\n\nbody"
    assert not units(spark, near)[0].is_wrapper
    assert units(spark, far)[0].is_wrapper


def test_header_only_blocks_are_dropped(spark):
    hop = f"{RULE}\nFrom: Hop\nSent: today\nTo: x\nSubject: Fw\n\n\n"
    got = units(spark, "\n" + hop + hop + f"{RULE}\nFrom: Last\nDate: today\nSubject: S\n\nContent.\n")
    assert [(u.from_, u.body) for u in got] == [("Last", "Content.")]
    # Without a blank line the block swallows its text and is dropped.
    assert units(spark, "From: A\nSent: b\nSubject: c\ntext") == []


def test_external_flag_covers_headers_of_quotes_only(spark):
    got = units(spark, "top\nFrom: External Email Desk\nSent: x\n\nhello")
    assert [u.is_external for u in got] == [False, True]


def test_bold_labels_need_the_option(spark):
    body = "top\n\n**From:** A <a@example.com>\n**Sent:** today\n**Subject:** S\n\ntext"
    assert len(units(spark, body)) == 1
    relaxed = units(spark, body, relax_markdown=True)
    assert [u.subject for u in relaxed] == ["", "S"]


def test_many_divider_lines_do_not_overflow_the_stack(spark):
    junk = (RULE + "\n\n") * 20000
    (u,) = units(spark, junk + "x\n" + junk)
    assert u.body == "x"


HTML = {
    "<html><body><p>Hello <b>team</b>,</p><p>See it.</p></body></html>": "Hello **team**,\n\nSee it.",
    "<head><style>p{color:red}</style></head><p>Keep</p><script>alert('x')</script>": "Keep",
    "": "",
    "  ": "",
    "<p>a</p><br><br><br><br><p>b</p>": "a\n\n  \n  \n  \n  \n\nb",
    "<h2>T</h2><p>a * b_c &lt;x&gt; &amp;amp; &#233;&#x20AC; &eacute; &bogus; R&D</p>": "## T\n\na \\* b\\_c <x> &amp; é€ é &bogus; R&D",
    '<p><a href="http://x.example/a_b">go</a> <a name="n">here</a></p>': "[go](http://x.example/a_b) here",
    "<ul><li>one</li><li>two</li></ul><ol><li>x</li><li>y</li></ol>": "* one\n* two\n\n1. x\n2. y",
    "<p>x<br>y <i><b>z</b></i> <code>c</code></p><hr><img src='a.png'>": "x  \ny ***z*** `c`\n\n---",
    "<blockquote><p>q1</p><p>q2</p></blockquote>after": "> q1\n>\n> q2\n\nafter",
    "<b><span>Team</span></b> <i> a <b>b</b></i>": "**Team**  *a **b***",
    "<a href=u>x</a> <a class=k href='v'>y</a>": "[x](u) [y](v)",
    "<b><a href='u'>go</a></b> <a href='w'><em>on</em> it</a>": "**[go](u)** [*on* it](w)",
    "<strong>open <p>next</p></strong><b></b><i></i>end <b>x": "open\n\nnext\n\nend x",
    "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>": "| a | b |\n| --- | --- |\n| 1 | 2 |",
}


def test_html(spark):
    got = values(spark, html.html_to_markdown, HTML)
    assert dict(zip(HTML, got)) == HTML


def test_best_body(spark):
    df = spark.createDataFrame([("p", "<p>h</p>"), (" ", "<p>h</p>"), (None, " "), (None, None)], "p string, h string")
    got = [tuple(r[0]) for r in df.select(html.best_body(F.col("p"), F.col("h"))).collect()]
    assert got == [("p", False), ("h", True), ("", False), ("", False)]


def test_attachment_kind(spark):
    cases = {"a.PDF": "pdf", "a.tar.gz": None, "notes": None, ".txt": None, "x.md": "text", "b.v1.csv": "text", "": None}
    assert values(spark, documents.attachment_kind, cases) == list(cases.values())


@pytest.mark.parametrize("strict", [False, True])
def test_decode_text(spark, strict):
    raw = {
        "plain é".encode(): "plain é",
        "é€😀".encode("utf-16"): "é€😀",
        "é€😀".encode("utf-16-be"): None,
        b"\xfe\xff" + "é€😀".encode("utf-16-be"): "é€😀",
        b"caf\xe9": "café" if not strict else b"caf\xe9".decode("utf-16-le"),
        b"\xff\xfe\x00\xd8": None,
        b" \xe9 ": "é",
    }
    got = values(spark, lambda c: documents.decode_text(c, strict), [bytearray(k) for k in raw], "x binary")
    for (data, want), have in zip(raw.items(), got):
        if want is not None:
            assert have == want, data
        assert have is not None


def test_markdown_table(spark):
    rows = [["a", "b"], [], ["1"], ["x|y", "l1\nl2", None]]
    df = spark.createDataFrame([(rows,)], "r array<array<string>>")
    got = df.select(documents.markdown_table(F.col("r"))).first()[0]
    assert got == "| a | b |  |\n| --- | --- | --- |\n| 1 |  |  |\n| x\\|y | l1 l2 |  |"


def block(section, number, kind, text=None, rows=None, title=None):
    return (section, title, number, kind, text, rows)


def test_document_assembly(spark):
    typed = lambda *rows: [[None if v is None else json.dumps(v) for v in r] for r in rows]
    head, rows = typed(["Name", "Value"]), typed(["Name", "Value"], ["", " ", None], ["Alpha", 1], [True, 2.5])
    cases = [
        ("docx", [block(0, 5, "table", rows=head), block(0, 6, "text", " b "), block(0, 0, "text", "a"), block(0, 1, "text", " ")],
         "a\n\nb\n\n| Name | Value |\n| --- | --- |"),
        ("pptx", [block(1, 0, "notes", "n"), block(1, 1, "text", "t"), block(2, 0, "text", "")], "## Slide 1\n\nt\n\n**Notes:** n\n\n## Slide 2"),
        ("pdf", [block(1, 0, "table", rows=head), block(1, 1, "text", "p"), block(2, 0, "text", "")],
         "## Page 1\n\np\n\n| Name | Value |\n| --- | --- |\n\n## Page 2"),
        ("xlsx", [block(0, 0, "table", rows=rows, title="Da\"ta"), block(1, 0, "table", rows=typed([""]), title="Blank")],
         "## Da\"ta\n\n| Name | Value |\n| --- | --- |\n| Alpha | 1 |\n| true | 2.5 |"),
    ]
    df = spark.createDataFrame([(k, b) for k, b, _ in cases], f"kind string, blocks {documents.BLOCK_TYPE}")
    got = [r[0] for r in df.select(documents.document_markdown(F.col("kind"), F.col("blocks"))).collect()]
    assert got == [want for _, _, want in cases]
    (data,) = df.filter("kind = 'xlsx'").select(documents.workbook_json(documents.workbook_sheets(F.col("blocks")))).first()
    assert json.loads(data) == {"sheets": [{"sheet": 'Da"ta', "rows": [["Name", "Value"], ["Alpha", 1], [True, 2.5]]}]}


def test_render_attachment_metadata(spark):
    df = spark.createDataFrame([("a.xlsx", '{"sheets":[]}'), ("b.txt", None)], "f string, d string")
    meta = render.attachment_metadata(F.col("f"), F.lit("t/x"), F.lit("s"), F.lit("o"), F.col("d"))
    got = [json.loads(r[0]) for r in df.select(meta).collect()]
    assert got[0]["data"] == {"sheets": []} and "data" not in got[1] and got[1]["filename"] == "b.txt"
