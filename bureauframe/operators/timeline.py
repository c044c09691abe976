"""As-of lookups in timelines: per key one sorted array of days, searched by bisection.

A key has at most one entry a day, so an array is bounded by the calendar however many rows the key
has, and rows combine by day before they are shuffled. What looks a timeline up meets one row, so a
join yields as many rows as are looked up: neither a busy key nor a window multiplies them, and
adaptive execution can split the lookups of a hot key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureauframe.functions.dates import window_start
from bureauframe.plans.features import Feature, FeatureGroup

TIMELINE = "timeline"
DAY = "day"


def rank_sql(timeline: str, day: str) -> str:
    """How many entries of a timeline lie at or before a day (days since the epoch)."""
    middle = "shiftright(s.lo + s.hi, 1)"
    return (
        f"aggregate(sequence(1, CAST(ceil(log2(size({timeline}) + 1)) AS INT)), "
        f"named_struct('lo', 0, 'hi', size({timeline})), "
        f"(s, i) -> IF(s.lo >= s.hi, s, IF(get({timeline}, {middle}).{DAY} <= {day}, "
        f"named_struct('lo', {middle} + 1, 'hi', s.hi), named_struct('lo', s.lo, 'hi', {middle}))), "
        "s -> s.lo)"
    )


def gathered(entries: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """key, timeline: the entries of each key (one a day) in the order of their days."""
    entry = F.struct(DAY, *names)
    return entries.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias(TIMELINE))


# -- counts and newest days -----------------------------------------------------------------------


def recent_groups(groups: Iterable[FeatureGroup]) -> bool:
    """Whether every feature reads a timeline: counts, flags and minima of age in a trailing window."""
    return all(f.recent or f.kind == "derived" for group in groups for f in group.features)


def _kinds(features: Sequence[Feature]) -> dict[str | None, int]:
    """The conditions that tell entries apart, each with its number; None takes all."""
    found = dict.fromkeys(f.recent.among for f in features if f.recent)
    return {among: i for i, among in enumerate(found)}


def event_timelines(events: DataFrame, key: str, day: Column, groups: Iterable[FeatureGroup]) -> DataFrame:
    """key, timeline: for each day with events how many there were up to it of each kind that the
    groups ask for, and the newest two days with one. Events without a day or key are left out."""
    features = [f for group in groups for f in group.features]
    kinds = _kinds(features)
    dated = {f.recent.among for f in features if f.recent and f.kind == "min"}
    counts = [F.count(F.when(F.expr(k), 1) if k else F.lit(1)).alias(f"n{i}") for k, i in kinds.items()]
    daily = (
        events.withColumn(DAY, F.unix_date(day))
        .filter(F.col(DAY).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, DAY)
        .agg(*counts)
    )
    so_far = Window.partitionBy(key).orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    numbers = [i for k, i in kinds.items() if k in dated]
    older = {f"older{i}": F.max(F.when(F.col(f"n{i}") > 0, F.col(DAY))).over(before) for i in numbers}
    seen = daily.select("*", *(value.alias(name) for name, value in older.items()))
    totals = [F.sum(f"n{i}").over(so_far).alias(f"c{i}") for i in kinds.values()]
    newest = [
        F.max(F.when(F.col(f"n{i}") > 0, F.struct(F.col(DAY).alias("last"), F.col(f"older{i}").alias("older"))))
        .over(so_far)
        .alias(f"d{i}")
        for i in numbers
    ]
    entries = seen.select(key, DAY, *totals, *newest)
    return gathered(entries, key, [f"c{i}" for i in kinds.values()] + [f"d{i}" for i in numbers])


def timeline_features(
    lookups: DataFrame, keys: Sequence[str], as_of: str, groups: Iterable[FeatureGroup]
) -> DataFrame:
    """The features of all groups for rows that carry their timeline, in catalogue order. Rows
    without an event up to their date are left out, as they are by an aggregation of events."""
    features = [f for group in groups for f in group.features]
    kinds = _kinds(features)
    months = sorted({f.recent.within for f in features if f.recent and f.recent.within})
    today = f"unix_date(CAST({as_of} AS DATE))"
    starts = {w: f"unix_date({window_start(f'CAST({as_of} AS DATE)', w)})" for w in months}
    ranked = lookups.selectExpr(
        *keys,
        TIMELINE,
        f"{rank_sql(TIMELINE, today)} AS _upto",
        *(f"{rank_sql(TIMELINE, f'({day} - 1)')} AS _before{w}" for w, day in starts.items()),
    ).filter("_upto > 0")
    found = ranked.selectExpr(
        *keys,
        f"get({TIMELINE}, _upto - 1) AS _now",
        *(f"get({TIMELINE}, _before{w} - 1) AS _before{w}" for w in months),
    )

    def value(f: Feature) -> str:
        i = kinds[f.recent.among]
        if f.kind == "min":
            ages = (f"months_between({as_of}, date_from_unix_date(_now.d{i}.{x}))" for x in ("last", "older"))
            # The newest day is not always the nearest: the end of February is a whole month after
            # the 31 January and less than one after the 30th. Nothing older than that comes nearer.
            return f"least({', '.join(ages)})"
        n = f"_now.c{i}" + (f" - coalesce(_before{f.recent.within}.c{i}, 0L)" if f.recent.within else "")
        return f"CAST({n} > 0 AS INT)" if f.kind == "flag" else n

    read = found.selectExpr(*keys, *(f"{value(f)} AS {f.name}" for f in features if f.recent))
    return read.selectExpr(
        *keys, *(f"{f.value} AS {f.name}" if f.kind == "derived" else f.name for f in features if not f.hidden)
    )
