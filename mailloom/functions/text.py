"""String columns: whitespace, identities, slugs, subjects and object keys.

Everything here is a plain Column expression, so it stays inside whole-stage
code generation and works the same on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Characters that count as blank in mail text (Unicode white space and the
# four ASCII separators), split into those that end a line and those that don't.
LINE_BREAK_CODES = (0x0A, 0x0D, 0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029)
BLANK_CODES = (0x20, 0x09, 0x1F, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
# Reply and forward markers that are ignored when subjects are compared.
REPLY_MARKERS = "re|fw|fwd|aw|wg|sv|vs"
SUBJECT_FALLBACK = "no-subject"
SLUG_FALLBACK = "untitled"
DATE_FALLBACK = "undated"
SLUG_CHARS = 60
STEM_SLUG_CHARS = 40
# ----------------------------------------------------------------------------

LINE_BREAK_CHARS = "".join(map(chr, LINE_BREAK_CODES))
BLANK_CHARS = "".join(map(chr, BLANK_CODES))
SPACE_CHARS = BLANK_CHARS + LINE_BREAK_CHARS
# The same two sets as regular expression classes. One category test is much
# cheaper per character than a list of code points.
BLANK = r"[\p{Zs}\t\x1f]"
SPACE = r"[\p{Z}\t-\r\x1c-\x1f\x85]"
_NOT_PLAIN = r"[\p{Z}\t-\r\x1c-\x1f\x85&&[^ ]]"
# Any run of blanks but a single U+0020, which is left as it is.
_RUN = f" {SPACE}+|{_NOT_PLAIN}{SPACE}*"


def strip_space(c: Column) -> Column:
    """Trim every kind of blank, not only U+0020."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def collapse_space(c: Column) -> Column:
    """One plain space for each run of blanks, none at the ends."""
    return F.btrim(F.regexp_replace(c, _RUN, " "))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def clean_header(c: Column) -> Column:
    """Unfold a header value; an empty one becomes NULL."""
    return F.nullif(collapse_space(c), F.lit(""))


def normalize_body(c: Column) -> Column:
    return F.lower(collapse_space(or_empty(c)))


def identity(
    message_id: Column, from_: Column, date: Column, subject: Column, body: Column, body_chars: int | None = None
) -> Column:
    """Message-id when there is one, else a digest of sender, date, subject and text.

    The whole text counts; `body_chars` narrows it to a prefix of its normal form.
    """
    given = strip_space(message_id)
    folded = [F.lower(strip_space(or_empty(c))) for c in (from_, date, subject)]
    text = normalize_body(body)
    text = text if body_chars is None else F.substring(text, 1, body_chars)
    digest = F.sha2(F.concat_ws("\n", *folded, text), 256)
    return F.when(given != "", given).otherwise(F.concat(F.lit("sha256:"), digest))


def short_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 8)


def slugify(c: Column, n: int = SLUG_CHARS) -> Column:
    dashed = F.btrim(F.regexp_replace(F.lower(or_empty(c)), "[^a-z0-9]+", "-"), F.lit("-"))
    cut = F.btrim(F.substring(dashed, 1, n), F.lit("-"))
    return F.when(cut == "", F.lit(SLUG_FALLBACK)).otherwise(cut)


def normalize_subject(c: Column) -> Column:
    """Drop all leading reply/forward markers, fold blanks and case."""
    marker = rf"{SPACE}*(?:{REPLY_MARKERS}){SPACE}*(?:\[\p{{Nd}}+\])?{SPACE}*:{SPACE}*"
    return F.lower(collapse_space(F.regexp_replace(or_empty(c), rf"(?i)\A(?:{marker})++", "")))


def thread_digest(c: Column) -> Column:
    """All 256 bits, for grouping; keys show the first 32."""
    subject = normalize_subject(c)
    return F.sha2(F.when(subject == "", F.lit(SUBJECT_FALLBACK)).otherwise(subject), 256)


def thread_id(c: Column) -> Column:
    return F.substring(thread_digest(c), 1, 8)


def date_from_key(c: Column) -> Column:
    found = F.regexp_extract(c, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(DATE_FALLBACK))


def key_stem(c: Column) -> Column:
    return F.regexp_replace(F.substring_index(c, "/", -1), r"(?i)\.eml\z", "")


def sidecar_key(c: Column) -> Column:
    return F.concat(F.regexp_replace(c, r"\.md\z", ""), F.lit(".json"))
