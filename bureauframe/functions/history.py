"""Monthly history as arrays: alignment to the as-of date and window statistics, as SQL.

A history array has 37 slots, newest first, counted from the account's own report month. `md` is
how many months the report lies before the as-of date, so month `k` before the as-of date is slot
`k - md`. A window of the last W months is therefore one contiguous slice.

Functions take and return SQL text. Text keeps the driver fast: one parse per projection instead of
thousands of calls into the JVM to build the same tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from bureauframe.sources.schemas import HISTORY_MONTHS, history_columns

SLOTS = HISTORY_MONTHS + 1


def number(column: str) -> str:
    """Lenient cast: text that is no number becomes NULL instead of failing the job."""
    return f"try_cast({column} AS DOUBLE)"


def non_negative(value: str) -> str:
    return f"CASE WHEN {value} >= 0 THEN {value} END"


def positive(value: str) -> str:
    return f"CASE WHEN {value} > 0 THEN {value} END"


def history(family: str, drop_negative: bool) -> str:
    """One array<double> per family. Families with a -1 sentinel drop negatives."""
    values = [number(name) for name in history_columns(family)]
    if drop_negative:
        values = [non_negative(value) for value in values]
    return f"array({', '.join(values)})"


def month(arr: str, md: str, k: int) -> str:
    """Value `k` months before the as-of date; NULL outside the history."""
    return f"get({arr}, {k} - {md})"


def _first_slot(md: str, first: int = 0) -> str:
    return f"greatest({first} - {md}, 0)"


def months_covered(md: str, months: int, first: int = 0) -> str:
    """How many slots of the history fall into months `first` .. `months - 1`.

    greatest/least skip NULLs, hence the explicit guard for an unknown report date.
    """
    end = f"least({months} - {md}, {SLOTS})"
    return f"CASE WHEN {md} IS NOT NULL THEN greatest({end} - {_first_slot(md, first)}, 0) END"


def window(arr: str, md: str, months: int, first: int = 0) -> str:
    """Slots of months `first` .. `months - 1`; NULL when the report date is unknown."""
    return f"slice({arr}, {_first_slot(md, first)} + 1, {months_covered(md, months, first)})"


def window_max(arr: str, md: str, months: int, first: int = 0) -> str:
    return f"array_max({window(arr, md, months, first)})"


def window_min(arr: str, md: str, months: int) -> str:
    return f"array_min({window(arr, md, months)})"


def months_aligned(arr: str, md: str, months: int) -> list[str]:
    """Months 0 .. months - 1 as scalars. Sums and counts over them stay compiled expressions,
    where lambda functions over an array would be interpreted per element."""
    return [month(arr, md, k) for k in range(months)]


def newest(values: Sequence[str]) -> str:
    return f"coalesce({', '.join(values)})"


def total(values: Sequence[str]) -> str:
    """Sum of the known values; NULL when none is known."""
    added = " + ".join(f"coalesce({value}, 0.0D)" for value in values)
    return f"CASE WHEN {newest(values)} IS NOT NULL THEN {added} END"


def known_count(values: Sequence[str]) -> str:
    """Number of known values; NULL when none is known."""
    counted = " + ".join(f"CAST({value} IS NOT NULL AS INT)" for value in values)
    return f"CASE WHEN {newest(values)} IS NOT NULL THEN {counted} END"


def share_positive(values: Sequence[str], covered: str) -> str:
    """Share of the covered months with a positive value; a month without a value counts as not
    positive, and no covered month at all gives NULL."""
    hits = " + ".join(f"CASE WHEN {value} > 0 THEN 1 ELSE 0 END" for value in values)
    return f"CASE WHEN ({covered}) > 0 THEN ({hits}) / ({covered}) END"


def hits(family: str, hit: str) -> str:
    """Slot numbers whose value satisfies `hit`, NULL elsewhere, in slot order."""
    names = history_columns(family)
    marks = (f"CASE WHEN {number(name)} {hit} THEN {slot} END" for slot, name in enumerate(names))
    return f"array({', '.join(marks)})"


def months_to_last(marks: str, md: str) -> str:
    """Distance in months from the as-of date back to the newest marked slot, ignoring slots after
    the as-of date."""
    past = f"slice({marks}, {_first_slot(md)} + 1, {SLOTS})"
    return f"CAST({md} + array_min({past}) AS DOUBLE)"


def ratios(numerator: str, denominator: str) -> str:
    """Slot-wise ratio of two families: negatives and unknown numerators count as 0, a denominator
    that is not positive gives NULL."""
    pairs = zip(history_columns(numerator), history_columns(denominator), strict=True)
    values = (
        f"CASE WHEN {number(d)} > 0 THEN greatest({number(n)}, 0.0D) / {number(d)} END"
        for n, d in pairs
    )
    return f"array({', '.join(values)})"


def mean_known(arr: str) -> str:
    """Mean of the known values of an array; NULL when none is known. Interpreted per element, so
    call it under a condition that few rows meet."""
    known = f"array_compact({arr})"
    summed = f"aggregate({known}, 0.0D, (acc, v) -> acc + v)"
    return f"CASE WHEN size({known}) > 0 THEN {summed} / size({known}) END"


def value_as_of(arr: str, ahead: str) -> str:
    """Value at the as-of date given `ahead` = whole months the report lies after it. A report
    from before the as-of date is the newest information there is, so slot 0 stands."""
    return f"CASE WHEN {ahead} IS NOT NULL THEN get({arr}, greatest({ahead}, 0)) END"
