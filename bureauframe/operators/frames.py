"""Small DataFrame helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    right_prefix: str = "",
) -> DataFrame:
    """Join whose right-hand columns carry a prefix, so no name appears twice."""
    renamed = {c: f"{right_prefix}{c}" for c in right.columns if c not in on}
    return left.join(right.withColumnsRenamed(renamed), list(on), how)


def coalesce_nulls(df: DataFrame, columns: Sequence[str], fill_value=0) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fill_value)) for c in columns})


def add_feature_prefix(df: DataFrame, prefix: str, exclude: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c not in exclude})


def safe_divide(numerator: str, denominator: str) -> Column:
    """NULL when either side is NULL or the denominator is 0."""
    return F.try_divide(F.col(numerator), F.col(denominator))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a few digits, so that summation order does not show. The shift by 1e-9 keeps exact
    ties at the next digit from depending on the last bit; adding 0.0 drops a negative zero."""
    return df.select(
        *(
            (F.round(F.col(f.name) + F.lit(1e-9), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def distinct_columns(df: DataFrame) -> DataFrame:
    """Keep the first column of each name."""
    if len(set(df.columns)) == len(df.columns):
        return df
    seen: set[str] = set()
    numbered = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    kept = []
    for i, name in enumerate(df.columns):
        if name not in seen:
            seen.add(name)
            kept.append(F.col(f"c{i}").alias(name))
    return numbered.select(*kept)


def assemble(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join feature frames on their keys, first frame leading. For frames computed apart;
    groups of one source are cheaper in one aggregation."""
    first, *others = parts
    out = first
    for part in others:
        new = [c for c in part.columns if c not in out.columns]
        out = out.join(part.select(*keys, *new), list(keys), "left")
    return out


def mask_absent(df: DataFrame, companions: Mapping[str, str]) -> DataFrame:
    """NULL every feature whose companion says the customer never had the product, which tells an
    imputed 0 from a real one."""
    present = {f: c for f, c in companions.items() if f in df.columns and c in df.columns}
    return df.withColumns({f: F.when(F.col(c) != 0, F.col(f)) for f, c in present.items()})
