"""Mail dates as Column expressions.

A date header is rewritten by one regular expression per word order into seven
fields joined by a separator, then checked and assembled by the built-in
timestamp constructor. A header that matches neither order gives NULL.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailloom.functions.text import collapse_space, date_from_key

# --- fixed values -----------------------------------------------------------
MONTHS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
MONTH_ORDER = "janfebmaraprmayjunjulaugsepoctnovdec"
WEEKDAYS = "mon|tue|wed|thu|fri|sat|sun"
# Named zones of RFC 5322, hours from UTC. Other words count as "zone unknown".
ZONE_HOURS = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -4, "ADT": -3, "EST": -5, "EDT": -4,
    "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}
TWO_DIGIT_PIVOT = 68
TIMESTAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
TIMESTAMP_FALLBACK = "00000000T000000Z"
# ----------------------------------------------------------------------------

_FIELD = "\x1f"
_LEAD = rf"(?i)\A(?:[^ ]*, ?|(?:{WEEKDAYS}) )?"
_DAY_MONTH = rf"(?:([0-9]{{1,9}}),?[ -]({MONTHS})|({MONTHS})[ -]([0-9]{{1,9}}),?)"
_CLOCK = r"([0-9]{1,9})[:.]([0-9]{1,9})(?:[:.]([0-9]{1,9}))?"
_YEAR_THEN_CLOCK = rf"{_LEAD}{_DAY_MONTH}[ -]([0-9]{{1,9}}),? {_CLOCK},?(?: ?([^ ]+).*)?\z"
_CLOCK_THEN_YEAR = rf"{_LEAD}{_DAY_MONTH} {_CLOCK},?(?: ([a-z]+))? ([0-9]{{1,9}}),?\z"


def _zone_seconds(zone: Column) -> Column:
    """Seconds east of UTC; 0 for a missing, unknown or `-0000` zone."""
    names = F.from_json(F.lit(json.dumps(ZONE_HOURS)), "map<string,int>")
    number = F.abs(F.when(zone.rlike(r"\A[+-]?[0-9]{1,6}\z"), zone.cast("int")))
    size = F.floor(number / 100) * 3600 + (number % 100) * 60
    signed = F.when(zone.startswith("-"), -size).otherwise(size)
    return F.coalesce(F.element_at(names, F.upper(zone)) * 3600, signed, F.lit(0)).cast("int")


def parse_mail_date(c: Column, meridiem: bool = False) -> Column:
    """UTC instant (TIMESTAMP_NTZ) of a mail date, NULL when it cannot be read.

    By default an AM/PM word is ignored like any unknown zone word;
    `meridiem=True` reads it as a twelve-hour clock.
    """
    text = collapse_space(c)
    fields = F.split(
        F.regexp_replace(
            F.regexp_replace(
                text, _YEAR_THEN_CLOCK, "$1$4|$2$3|$5|$6|$7|$8|$9".replace("|", _FIELD)
            ),
            _CLOCK_THEN_YEAR,
            "$1$4|$2$3|$9|$5|$6|$7|$8".replace("|", _FIELD),
        ),
        _FIELD,
    )
    part = [F.get(fields, F.lit(i)) for i in range(7)]
    day, hour, minute = (part[i].cast("int") for i in (0, 3, 4))
    second = F.when(part[5] == "", F.lit(0)).otherwise(part[5].cast("int"))
    month = (F.position(F.lower(F.substring(part[1], 1, 3)), F.lit(MONTH_ORDER)) + 2) / 3
    year = part[2].cast("int")
    year = (
        F.when(year > 99, year)
        .when(year > TWO_DIGIT_PIVOT, year + 1900)
        .otherwise(year + 2000)
    )
    if meridiem:
        word = F.upper(part[6])
        hour = (
            F.when((word == "PM") & (hour < 12), hour + 12)
            .when((word == "AM") & (hour == 12), F.lit(0))
            .otherwise(hour)
        )
    zone = _zone_seconds(part[6])
    local = F.try_make_timestamp_ntz(year, month.cast("int"), day, hour, minute, second)
    usable = (
        (F.size(fields) == 7)
        & year.between(1, 9999)
        & (second < 60)
        & (F.abs(zone) < 86400)
    )
    shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), zone.cast("decimal(18,6)"))
    return F.when(usable, local - shift)


def format_timestamp(c: Column, meridiem: bool = False) -> Column:
    """Sortable `YYYYMMDDThhmmssZ`, all zeros for an unreadable date."""
    return timestamp_text(parse_mail_date(c, meridiem))


def timestamp_text(sent_at: Column) -> Column:
    return F.coalesce(F.date_format(sent_at, TIMESTAMP_FORMAT), F.lit(TIMESTAMP_FALLBACK))


def format_date(c: Column, meridiem: bool = False) -> Column:
    return F.date_format(parse_mail_date(c, meridiem), "yyyy-MM-dd")


def partition_date(
    date: Column, key: Column, source: str = "header", meridiem: bool = False
) -> Column:
    """Day folder: header date, else the date in the key, else `undated`."""
    if source == "key":
        return date_from_key(key)
    return F.coalesce(format_date(date, meridiem), date_from_key(key))
