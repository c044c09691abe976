"""Tolerant date parsing and month arithmetic against an as-of date, as SQL expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text formats in order of precedence. Day-first wins over month-first,
# so 08/12/2021 is 8 December.
DATE_FORMATS = (
    "dd/MM/yyyy",
    "yyyy-MM-dd",
    "dd-MM-yyyy",
    "yyyy/MM/dd",
    "yyyyMMdd",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd/yyyy",
)


#: Loose forms of the plain dates, and how their parts make an ISO date. What follows a date is
#: ignored, as are blanks before it, so a time of day and an offset change nothing: no text depends
#: on the session's time zone.
_LOOSE = (
    (
        r"(?:(\d{1,2})([-/])(\d{1,2})\2(\d{4})|(\d{4})([-/])(\d{1,2})\6(\d{1,2})"
        r"|(\d{4})(\d{2})(\d{2}))",
        "$4$5$9-$3$7$10-$1$8$11",
    ),
    (r"(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
)


def _read(text: str, fmt: str) -> str:
    """Rearrange a text known to have the shape of `fmt` to ISO order and cast it, which costs a
    fraction of a pattern parse and raises no error inside."""
    parts = (f"substr({text}, {fmt.index(p) + 1}, {len(p)})" for p in ("yyyy", "MM", "dd"))
    return f"try_cast(concat_ws('-', {', '.join(parts)}) AS DATE)"


def _search(text: str) -> str:
    """The same dates wherever a pattern parse would see them: after blanks, with single digits,
    before other text. Text of another form becomes "--", which is no date."""
    reads = []
    for pattern, iso in _LOOSE:
        whole = rf"(?s)^(?:[ \t]*{pattern}(?!\d).*|.*)$".replace("\\", r"\\")
        reads.append(f"try_cast(regexp_replace({text}, '{whole}', '{iso}') AS DATE)")
    return f"coalesce({', '.join(reads)})"


def date_sql(column: str) -> str:
    """Text (or a date) to a date; NULL when no format fits.

    The shape of the text picks its candidates: a padded date, alone or before a time of day, is
    cut out at fixed places. Only other text of eight characters or more that holds a digit is
    searched by pattern. Impossible dates are NULL, and so are years of fewer than four digits,
    which a lenient parser would take for years of the first century.
    """
    text = f"CAST({column} AS STRING)"
    plain = [f for f in DATE_FORMATS if "H" not in f]
    by_shape: dict[str, list[str]] = {}
    for fmt in plain:
        by_shape.setdefault(re.sub("[yMd]", "0", fmt), []).append(_read(text, fmt))
    shape = f"translate({text}, '123456789', '000000000')"
    branches = " ".join(
        f"WHEN {shape} = '{known}' THEN coalesce({', '.join(reads)})"
        for known, reads in by_shape.items()
    )
    return (
        f"CASE {branches} "
        f"WHEN {shape} LIKE '0000-00-00%' AND NOT {shape} LIKE '0000-00-000%' "
        f"THEN try_cast(left({text}, 10) AS DATE) "
        f"WHEN length({text}) >= 8 AND {shape} LIKE '%0%' THEN {_search(text)} END"
    )


def parse_date(column: str) -> Column:
    return F.expr(date_sql(column))


def months_since(event: str, as_of: str) -> str:
    """Fractional months from an event to the as-of date; NULL for events after it."""
    return f"CASE WHEN {event} <= {as_of} THEN months_between({as_of}, {event}) END"


def window_start(as_of: str, months: int) -> str:
    """The first day that is at most so many months before a date: `months_between` of the two is
    `months` or less for this day and all between. A day that the month lacks starts the next one,
    unless both are the last of their months, which count as whole months apart."""
    back = f"add_months({as_of}, -{months})"
    later = f"day({back}) < day({as_of}) AND {as_of} <> last_day({as_of})"
    return f"date_add({back}, IF({later}, 1, 0))"


def months_ceil(later: str, earlier: str) -> str:
    """Whole months between two dates, rounded up, as an int (negative when reversed)."""
    return f"CAST(ceil(months_between({later}, {earlier})) AS INT)"
