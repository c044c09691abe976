"""Compile a set of feature groups into one aggregation.

All groups share one projection and one `groupBy`, so any number of features costs one shuffle.
Every aggregate is algebraic: Spark combines partial results before the shuffle, so a key that
owns a large part of the rows reaches the reducers as one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureauframe.plans.features import Feature, FeatureGroup

_FLAGS_PER_MASK = 32
_VALUES_PER_MASK = 63
MAX_VALUES = 504  #: of a distinct count that travel as bits, in eight masks


def _aggregate_sql(feature: Feature) -> str:
    if feature.kind == "count":
        return f"count(CASE WHEN {feature.where} THEN 1 END)"
    value = feature.value
    if feature.where:
        value = f"CASE WHEN {feature.where} THEN {value} END"
    out = f"{feature.kind}({value})"
    return f"coalesce({out}, 0.0D)" if feature.zero else out


def _masks(flags: Sequence[Feature]) -> tuple[dict[str, str], dict[str, str]]:
    """Pack 0/1 flags into bit masks: `any` over rows is a bitwise OR, so dozens of flags travel
    through the shuffle as one long. Returns the aggregates and how to unpack each flag."""
    packed, unpacked = {}, {}
    for start in range(0, len(flags), _FLAGS_PER_MASK):
        chunk = flags[start : start + _FLAGS_PER_MASK]
        mask = f"_mask{start // _FLAGS_PER_MASK}"
        bits = (f"CASE WHEN {f.where} THEN {1 << i}L ELSE 0L END" for i, f in enumerate(chunk))
        packed[mask] = f"bit_or({' | '.join(bits)})"
        unpacked |= {f.name: f"CAST(getbit({mask}, {i}) AS INT)" for i, f in enumerate(chunk)}
    return packed, unpacked


def gather(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the rows of a key together before a wide aggregation.

    With hundreds of aggregates a partial result is several times wider than an account row, so
    where nearly every account of a customer is read by another task, shuffling rows first can move
    less than partial results do; `bench.py` prints both. The exchange is a rebalance, which splits
    partitions that grow too large: a key with a third of all rows is spread over many tasks and the following
    aggregation merges its parts. It runs on a hash of the keys because an exchange on the keys
    themselves would satisfy the aggregation and pin such a key to one task.
    """
    gathered = rows.withColumn("_gather", F.xxhash64(*keys)).hint("rebalance", "_gather")
    return gathered.drop("_gather")


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _value_masks(feature: Feature, values: Sequence[str]) -> tuple[dict[str, str], str]:
    """A distinct count of known values as bits, one for each: the masks, and how to count them."""
    masks = {}
    for start in range(0, len(values), _VALUES_PER_MASK):
        known = ", ".join(map(_literal, values[start : start + _VALUES_PER_MASK]))
        place = f"array_position(array({known}), {feature.value})"
        hit = f"CASE WHEN {place} > 0 THEN shiftleft(1L, CAST({place} - 1 AS INT)) ELSE 0L END"
        if feature.where:
            hit = f"CASE WHEN {feature.where} THEN {hit} ELSE 0L END"
        masks[f"_bits{start // _VALUES_PER_MASK}_{feature.name}"] = f"bit_or({hit})"
    return masks, " + ".join(f"bit_count({name})" for name in masks) or "0"


def learned_values(rows: DataFrame, groups: Iterable[FeatureGroup]) -> dict[str, list[str]]:
    """For each distinct count of texts the values in `rows` beyond its listed ones, by a pass over
    one column: a superset, for conditions are not looked at. With them `feature_frame` reads its
    rows once. A feature with more values than MAX_VALUES is left out."""
    found = {}
    for feature in (f for group in groups for f in group.features if f.kind == "distinct"):
        values = rows.selectExpr(f"{feature.value} AS value").filter("value IS NOT NULL")
        if not isinstance(values.schema["value"].dataType, T.StringType):
            continue
        more = values.filter(~F.col("value").isin(*feature.listed)) if feature.listed else values
        room = MAX_VALUES - len(feature.listed)
        own = [row.value for row in more.distinct().limit(room + 1).collect()]
        if len(own) <= room:
            found[feature.name] = sorted(own)
    return found


def _unlisted(rows: DataFrame, keys: Sequence[str], feature: Feature) -> DataFrame:
    """Distinct values beyond the listed ones, by a pass of its own over a few columns."""
    where = f"{feature.value} IS NOT NULL" + (f" AND ({feature.where})" if feature.where else "")
    if feature.listed:
        names = ", ".join(f"'{v}'" for v in feature.listed)
        where += f" AND {feature.value} NOT IN ({names})"
    found = rows.filter(where).selectExpr(*keys, f"{feature.value} AS _value").distinct()
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"_more_{feature.name}"))


def _null_free(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Replace each key by a value and whether it is NULL. Joins on these are plain equalities, so
    what is grouped by them joins without another shuffle. Returns how to get the keys back."""
    stand_in = {T.StringType(): "''", T.DateType(): "DATE '1970-01-01'"}
    items, pairs, back = [], [], []
    for i, key in enumerate(keys):
        kind = rows.schema[key].dataType
        value = stand_in.get(kind, f"CAST(0 AS {kind.simpleString()})")
        items += [f"coalesce({key}, {value}) AS _key{i}", f"{key} IS NULL AS _null{i}"]
        pairs += [f"_key{i}", f"_null{i}"]
        back.append(f"CASE WHEN NOT _null{i} THEN _key{i} END AS {key}")
    return rows.selectExpr("*", *items), pairs, back


def feature_frame(
    rows: DataFrame,
    keys: Sequence[str],
    groups: Iterable[FeatureGroup],
    null_keys: bool = True,
    values: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per key with the features of all groups, in catalogue order. Without `null_keys` no
    key is NULL, and rows that are already partitioned by some of them are not shuffled again.

    Distinct counts never enter the wide aggregation as sets, which would turn all of it into
    object aggregation: known values travel as bits, others are counted apart and joined. `values`
    (see `learned_values`) has all that occur beyond the listed ones, by feature; then none is apart.
    """
    values = values or {}
    features = [feature for group in groups for feature in group.features]
    distincts = [f for f in features if f.kind == "distinct"]
    packed, unpacked = _masks([f for f in features if f.kind == "flag"])
    plain = {
        f.name: _aggregate_sql(f)
        for f in features
        if f.kind not in ("flag", "derived", "distinct")
    }
    masks = {f.name: _value_masks(f, [*f.listed, *values.get(f.name, ())]) for f in distincts}
    bits = {name: sql for own, _ in masks.values() for name, sql in own.items()}
    aggregates = [F.expr(f"{sql} AS {name}") for name, sql in (plain | packed | bits).items()]
    by, back = list(keys), list(keys)
    apart = [f for f in distincts if f.name not in values]
    if apart and null_keys:
        rows, by, back = _null_free(rows, keys)
    grouped = rows.groupBy(*by).agg(*aggregates or [F.count(F.lit(1)).alias("_rows")])
    counted = {f.name: f"CAST({masks[f.name][1]} AS BIGINT)" for f in distincts}
    for feature in apart:
        grouped = grouped.join(_unlisted(rows, by, feature), by, "left")
        more = f"coalesce(_more_{feature.name}, 0)"
        counted[feature.name] = f"CAST({masks[feature.name][1]} + {more} AS BIGINT)"

    opened = grouped.selectExpr(
        *back, *plain, *(f"{sql} AS {name}" for name, sql in (unpacked | counted).items())
    )
    return opened.selectExpr(
        *keys,
        *(
            f"{f.value} AS {f.name}" if f.kind == "derived" else f.name
            for f in features
            if not f.hidden
        ),
    )
