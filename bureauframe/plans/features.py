"""Feature definitions as data.

A feature is a name plus SQL text over the columns of `plans.rows` (aggregates) or over other
features of the same group (`derived`). Conditions follow SQL logic: NULL never qualifies.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

ACCOUNT = "account"
ENQUIRY = "enquiry"


@dataclass(frozen=True)
class Recent:
    """What a feature over the age of events looks at: those of one kind (a condition without the
    age, None for all), and how many months back at most (None for all)."""

    among: str | None = None
    within: int | None = None


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str  # count, flag, sum, max, min, avg, distinct or derived
    value: str | None = None
    where: str | None = None
    zero: bool = False  # deliver 0.0 instead of NULL when no row qualifies
    hidden: bool = False  # only feeds derived features
    listed: tuple[str, ...] = ()  # of a distinct count: values known beforehand, at most 63
    recent: Recent | None = None  # set where the feature can be read from a timeline of events


def count(name: str, where: str) -> Feature:
    return Feature(name, "count", where=where)


def flag(name: str, where: str) -> Feature:
    """1 when any row qualifies, else 0."""
    return Feature(name, "flag", where=where)


def _aged(age: str, recent: Recent) -> str:
    near = f"{age} <= {recent.within}" if recent.within else f"{age} IS NOT NULL"
    return f"{recent.among} AND {near}" if recent.among else near


def recent_count(name: str, age: str, within: int | None = None, among: str | None = None) -> Feature:
    """Events whose age in months is known and at most `within`."""
    recent = Recent(among, within)
    return Feature(name, "count", where=_aged(age, recent), recent=recent)


def recent_flag(name: str, age: str, within: int, among: str | None = None) -> Feature:
    recent = Recent(among, within)
    return Feature(name, "flag", where=_aged(age, recent), recent=recent)


def least_age(name: str, age: str, among: str | None = None) -> Feature:
    return Feature(name, "min", age, among, recent=Recent(among))


def total(name: str, value: str, where: str | None = None, zero: bool = False) -> Feature:
    return Feature(name, "sum", value, where, zero)


def highest(name: str, value: str, where: str | None = None, zero: bool = False) -> Feature:
    return Feature(name, "max", value, where, zero)


def lowest(name: str, value: str, where: str | None = None) -> Feature:
    return Feature(name, "min", value, where)


def mean(name: str, value: str, where: str | None = None) -> Feature:
    return Feature(name, "avg", value, where)


def distinct(
    name: str, value: str, where: str | None = None, listed: tuple[str, ...] = ()
) -> Feature:
    """Number of distinct values. Values in `listed` are cheaper; any other value counts too."""
    return Feature(name, "distinct", value, where, listed=listed[:63])


def derived(name: str, expression: str) -> Feature:
    return Feature(name, "derived", expression)


def derived_flag(name: str, condition: str) -> Feature:
    return derived(name, f"CASE WHEN {condition} THEN 1 ELSE 0 END")


def ratio(name: str, numerator: str, denominator: str, scale: int = 1) -> Feature:
    """NULL unless the denominator is positive."""
    scaled = f" * {scale}" if scale != 1 else ""
    return derived(
        name, f"CASE WHEN {denominator} > 0 THEN ({numerator}) / {denominator}{scaled} END"
    )


def hide(feature: Feature) -> Feature:
    return replace(feature, hidden=True)


@dataclass(frozen=True)
class FeatureGroup:
    """A named set of features over one source. A new group is just another instance."""

    name: str
    source: str
    features: tuple[Feature, ...]

    @property
    def outputs(self) -> list[str]:
        return [f.name for f in self.features if not f.hidden]
