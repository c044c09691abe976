"""Retro mode: features of given parties as of given past dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureauframe.operators import asof, timeline
from bureauframe.operators.aggregate import feature_frame
from bureauframe.plans.catalogue import ACCOUNT_GROUPS, ENQUIRY_GROUPS
from bureauframe.plans.features import FeatureGroup
from bureauframe.plans.rows import account_rows, enquiry_events, enquiry_rows
from bureauframe.plans.scrub import Computation, learned_codes
from bureauframe.session import tuned
from bureauframe.sources import layout, sinks, tables
from bureauframe.sources.schemas import CUSTOMER_KEY, PARTY, REFERENCE_DATE, RETRO_KEYS, SCRUB_DATE


def tradeline_features(
    tradeline: DataFrame,
    resolved: DataFrame,
    groups: Sequence[FeatureGroup] = ACCOUNT_GROUPS,
    strict: bool = False,
    colocated: bool = False,
    values: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per resolved reference with at least one account in its delivery.

    A reference has one delivery and customer, so these are keys of the aggregation too: the
    exchange that brought accounts to their references serves it as well. `colocated` says that the
    accounts are laid out by customer (`sources.layout`): then neither shuffles them. With `values`
    from `scrub.learned_codes` they are read once.
    """
    accounts = asof.retro_tradeline(tradeline, resolved, colocated)
    keys = [*RETRO_KEYS, CUSTOMER_KEY, SCRUB_DATE]
    rows = account_rows(accounts, keys, REFERENCE_DATE, strict)
    features = feature_frame(rows, keys, groups, null_keys=False, values=values)
    return features.drop(CUSTOMER_KEY, SCRUB_DATE)


def _account_features(
    spark: SparkSession, tradeline: str, resolved: DataFrame, what: Computation
) -> DataFrame:
    """`tradeline_features` of a source; of one laid out by customer, with its heavy customers."""
    laid = layout.is_colocated(spark, tradeline)
    parts = {tradeline: laid} | ({layout.heavy_table(tradeline): False} if laid else {})
    made = []
    for name, colocated in parts.items():
        accounts = tables.read_tradeline(spark, name)
        values = learned_codes(accounts, what.account_groups)
        made.append(
            tradeline_features(accounts, resolved, what.account_groups, what.strict, colocated, values)
        )
    return reduce(DataFrame.unionByName, made)


def enquiry_features(
    enquiry: DataFrame,
    resolved: DataFrame,
    master: DataFrame,
    groups: Sequence[FeatureGroup] = ENQUIRY_GROUPS,
    dedup_on: list[str] | None = None,
) -> DataFrame:
    """One row per resolved reference with at least one enquiry up to it. `dedup_on` names the
    columns that identify an enquiry across deliveries; one of each is kept.

    Groups of counts, flags and least ages are read from one timeline per party, so references and
    enquiries of a busy party do not multiply. A group with other features sees each enquiry with
    each reference after it.
    """
    if timeline.recent_groups(groups):
        found = asof.party_enquiries(enquiry, resolved, master, dedup_on)
        events = enquiry_events(found, [PARTY])
        timelines = timeline.event_timelines(events, PARTY, F.col("inquired"), groups)
        lookups = asof.with_timelines(resolved, timelines)
        return timeline.timeline_features(lookups, RETRO_KEYS, REFERENCE_DATE, groups)
    found = asof.retro_enquiries(enquiry, resolved, master, dedup_on)
    return feature_frame(enquiry_rows(found, RETRO_KEYS, REFERENCE_DATE), RETRO_KEYS, groups)


@dataclass(frozen=True)
class RetroReport:
    """References asked for, and those without a delivery in their window (see `unmatched`)."""

    references: int
    unmatched: int


def run(
    spark: SparkSession,
    references: str,
    tradeline: str,
    enquiry: str,
    master: str,
    tradeline_sink: str,
    enquiry_sink: str,
    window_months: int = asof.SNAPSHOT_WINDOW_MONTHS,
    computation: Computation = Computation(),
    dedup_on: list[str] | None = None,
    unmatched_sink: str | None = None,
) -> RetroReport:
    """Both feature tables for a list of references, replacing earlier results. References without
    a delivery go to `unmatched_sink`, if one is named."""
    parties = tables.read_master(spark, master)
    wanted = asof.reference_keys(tables.read_references(spark, references))
    resolved = asof.resolve_snapshots(wanted, parties, window_months).persist(StorageLevel.DISK_ONLY)
    try:
        with tuned(spark):
            features = _account_features(spark, tradeline, resolved, computation)
            sinks.write_overwrite(features, tradeline_sink)
            enquiries = tables.read_enquiry(spark, enquiry)
            features = enquiry_features(
                enquiries, resolved, parties, computation.enquiry_groups, dedup_on
            )
            sinks.write_overwrite(features, enquiry_sink)
            unmatched = asof.unmatched_references(wanted, resolved)
            if unmatched_sink:
                sinks.write_overwrite(unmatched, unmatched_sink)
            return RetroReport(wanted.count(), unmatched.count())
    finally:
        resolved.unpersist()
