"""Message files: scan and MIME decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from email import policy
from email.message import EmailMessage
from email.parser import BytesParser
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from mailloom.functions.html import best_body
from mailloom.functions.text import clean_header
from mailloom.session import shared_uri
from mailloom.sources.objects import check_folder, fetch_listed, listed

MESSAGE_GLOB, MESSAGE_SUFFIX = "*.[eE][mM][lL]", ".eml"
OBJECT_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# A leaf of a message's tree of parts. `text` is set for what can be the body, `data` for what is attached by name.
_LEAF = pa.struct(
    [
        ("filename", pa.string()),
        ("content_type", pa.string()),
        ("disposition", pa.string()),
        ("text", pa.string()),
        ("data", pa.binary()),
        ("error", pa.string()),
    ]
)
_HEADERS = {
    "message_id": "Message-ID",
    "from_": "From",
    "to_": "To",
    "cc": "Cc",
    "subject": "Subject",
    "date_header": "Date",
}
_MESSAGE = pa.struct(
    [
        *[(name, pa.string()) for name in _HEADERS],
        ("leaves", pa.list_(_LEAF)),
        ("error", pa.string()),
    ]
)


# Values that the default policy gives back as they are: one plain mailbox, words of printable ASCII.
_MAILBOX = re.compile(r"[A-Za-z0-9]+(?: [A-Za-z0-9]+)* <[A-Za-z0-9]+@[A-Za-z0-9]+(?:\.[A-Za-z0-9]+)*>")
_WORDS = re.compile(r"(?!.*=\?)[!-~]+(?: [!-~]+)*")
_PLAIN = {"from": _MAILBOX, "to": _MAILBOX, "cc": _MAILBOX, "subject": _WORDS}


class _Policy(policy.EmailPolicy):
    """The default policy, which parses a header anew each time it is looked at, with the last headers remembered.

    Plain values of headers that are only shown are not parsed at all.
    """

    def header_fetch_parse(self, name: str, value: str):
        plain = _PLAIN.get(name.lower())
        if plain is not None and type(value) is str and plain.fullmatch(value):
            return value
        short = type(value) is str and len(value) <= 1_000
        return _header(name, value) if short else super().header_fetch_parse(name, value)


@lru_cache(maxsize=4096)
def _header(name: str, value: str):
    return policy.default.header_fetch_parse(name, value)


_POLICY = _Policy()


def below_prefix(root: str, prefix: str) -> str:
    """A path pattern for everything below `root` whose path there starts with `prefix`.

    The pattern names folders (or files) of one level, whose contents tasks list in parallel if they are many.
    """
    plain = re.sub(r"([\\\[\]{}*?])", r"\\\1", prefix)
    return f"{root.rstrip('/')}/{plain}*"


def _first_found(reader, paths: list[str]) -> DataFrame | None:
    for path in paths:
        try:
            return reader.load(path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


def _key(below: Column, input_prefix: str) -> Column:
    """A file's key: it begins at the first prefix folder below the root; without one the whole rest is below the prefix."""
    at = F.locate("/" + input_prefix, below)
    return F.when(at > 0, F.substring(below, at + 1, F.lit(1 << 30))).otherwise(F.concat(F.lit(input_prefix.rstrip("/")), below))


def scan_messages(
    spark: SparkSession,
    root: str,
    streaming: bool = False,
    input_prefix: str = "emails/",
    max_files_per_trigger: int | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """Message files under `root`, with `source_key` starting at `input_prefix`.

    With `prefix`, a prefix of keys, only folders and files are listed whose path below `root` starts with it. Reading
    only keys leaves the file contents untouched.
    """
    reader = (spark.readStream if streaming else spark.read).format("binaryFile").schema(OBJECT_SCHEMA)
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", MESSAGE_GLOB)
    if streaming:
        # Files are new by name, not by date: one that arrives with an old date counts.
        reader = reader.option("maxFileAge", "36500d")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if prefix is None:
        objects = reader.load(root)
    else:
        # Without the prefix folder below the root, all of it is below the prefix.
        objects = _first_found(reader, [below_prefix(root, prefix), below_prefix(root, prefix.removeprefix(input_prefix))])
        objects = spark.createDataFrame([], OBJECT_SCHEMA) if objects is None else objects
    base = re.sub("^[^:/]+:/*", "/", shared_uri(spark, root).rstrip("/"))
    below = F.substring(F.regexp_replace("path", "^[^:/]+:/*", "/"), len(base) + 1, 1 << 30)
    return objects.select(
        _key(below, input_prefix).alias("source_key"),
        "path",
        F.col("modificationTime").alias("modification_time"),
        "length",
        "content",
    )


def list_messages(spark: SparkSession, root: str, input_prefix: str = "emails/", prefix: str | None = None) -> DataFrame:
    """The names that `scan_messages` would scan, listed in tasks: source_key, path (below the root), modification_time, length."""
    if prefix is None:
        check_folder(spark, root)
    found = listed(spark, root, prefix or "", MESSAGE_SUFFIX)
    if prefix is not None and prefix.startswith(input_prefix) and found.isEmpty():
        # Without the prefix folder below the root, all of it is below the prefix.
        found = listed(spark, root, prefix.removeprefix(input_prefix), MESSAGE_SUFFIX)
    return found.withColumn("source_key", _key(F.concat(F.lit("/"), F.col("path")), input_prefix))


def read_messages(names: DataFrame, root: str) -> DataFrame:
    """The files of listed messages, fetched in tasks; like a scan, without empty files and ended by one that cannot be read."""
    return fetch_listed(names.filter("length > 0"), root, F.col("source_key")).drop("error")


def _clean(value: object) -> str | None:
    """Text that is valid UTF-8, with undecodable bytes replaced."""
    return None if value is None else str(value).encode("utf-8", "replace").decode("utf-8")


def _leaves(part: EmailMessage) -> Iterator[EmailMessage]:
    if part.get_content_maintype() != "multipart":
        yield part
    elif part.is_multipart():
        for below in part.iter_parts():
            yield from _leaves(below)


def _payload(part: EmailMessage) -> bytes:
    """The bytes of a leaf without transfer encoding; of an attached message, its source."""
    if part.is_multipart():
        return b"".join(below.as_bytes() for below in part.get_payload())
    return part.get_payload(decode=True) or b""


def _leaf(part: EmailMessage) -> dict:
    row: dict = {}
    try:
        row = {"content_type": part.get_content_type(), "disposition": part.get_content_disposition(), "filename": _clean(part.get_filename())}
        attached = row["disposition"] == "attachment"
        if attached and not row["filename"] or not attached and row["content_type"] not in ("text/plain", "text/html"):
            return row  # never shown, so its bytes are not moved
        data = _payload(part)
        if part.get_content_maintype() == "text":
            text = data.decode(part.get_content_charset() or "utf-8", "replace")
            if not attached:
                return row | {"text": _clean(text)}
            data = text.encode("utf-8", "replace")
        row["data"] = data
    except Exception as problem:  # keep the mail, report the part
        row["error"] = f"{type(problem).__name__}: {problem}"
    return row


def _decode_message(raw: bytes | None) -> dict:
    if raw is None:
        return {"error": "no content"}
    try:
        message = BytesParser(policy=_POLICY).parsebytes(raw)
        return {c: _clean(message[name]) for c, name in _HEADERS.items()} | {"leaves": [_leaf(p) for p in _leaves(message)]}
    except Exception as problem:  # one bad message must not fail the task
        return {"error": f"{type(problem).__name__}: {problem}"}


@F.arrow_udf(from_arrow_type(_MESSAGE))
def _decode_messages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([_decode_message(raw.as_py()) for raw in batch], _MESSAGE)


def _first_place(content_type: str) -> Column:
    """Place of the first leaf of a type that is not attached, from 1; 0 if there is none."""
    fits = F.transform(
        "leaves", lambda x: (x["content_type"] == content_type) & ~F.coalesce(x["disposition"] == "attachment", F.lit(False))
    )
    return F.coalesce(F.array_position(fits, True), F.lit(0)).cast("int")


def parse_messages(objects: DataFrame) -> DataFrame:
    """Decode `content` to headers, body and parts; a bad message gets an `error`, or keeps the one it came with.

    The only Python stage of the mail path yields headers and leaf parts in Arrow
    batches; cleaning, body choice and part numbers are built-in functions.
    """
    carried = [c for c in objects.columns if c not in ("content", "path", "length", "error")]
    given = F.col("error") if "error" in objects.columns else F.lit(None).cast("string")
    decoded = objects.select(*carried, given.alias("given"), _decode_messages(F.col("content")).alias("m"))
    plain, html = _first_place("text/plain"), _first_place("text/html")
    at = lambda place: F.when(F.col(place) > 0, F.try_element_at("leaves", F.col(place)))
    others = F.filter("leaves", lambda _, i: (i + 1 != F.col("plain_at")) & (i + 1 != F.col("html_at")))
    part = lambda x, i: F.struct(
        i.cast("int").alias("part_no"), *(x[c].alias(c) for c in ("filename", "content_type", "disposition", "data", "error"))
    )
    return (
        decoded.select(*carried, "given", "m.*")
        .withColumns({c: clean_header(F.col(c)) for c in _HEADERS})
        .withColumns({"plain_at": plain, "html_at": html})
        .withColumn("chosen", best_body(at("plain_at")["text"], at("html_at")["text"]))
        .withColumn("parts", F.transform(others, part))
        # A body that cannot be read is the message's error; other parts keep theirs.
        .withColumn("error", F.coalesce("given", "error", at("plain_at")["error"], at("html_at")["error"]))
        .select(
            *carried,
            *_HEADERS,
            F.col("chosen.body").alias("body"),
            F.col("chosen.is_markdown").alias("body_is_markdown"),
            "parts",
            "error",
        )
    )
