"""Scrub mode: features of every customer in a delivery, as of the delivery date."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bureauframe.operators import ledger
from bureauframe.operators.aggregate import feature_frame, gather, learned_values
from bureauframe.operators.asof import attach_party, batch_enquiries, party_map, scrub_enquiries
from bureauframe.operators.incremental import source_dates, written_dates
from bureauframe.plans.catalogue import ACCOUNT_GROUPS, ENQUIRY_GROUPS
from bureauframe.plans.features import FeatureGroup
from bureauframe.plans.rows import account_rows, enquiry_rows
from bureauframe.session import tuned
from bureauframe.sources import sinks, tables
from bureauframe.sources.schemas import CUSTOMER_KEY, PARTY, SCRUB_DATE

log = logging.getLogger(__name__)

BATCH_BYTES = 64 << 30  #: of account files computed in one job

Groups = Sequence[FeatureGroup]


def tradeline_features(
    tradeline: DataFrame,
    master: DataFrame,
    groups: Groups = ACCOUNT_GROUPS,
    strict: bool = False,
    gathered: bool = False,
    values: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per customer and delivery.

    The party depends on the customer key alone, so it joins the finished rows instead of the
    accounts: the wide account table is never shuffled for it. `gathered` puts an exchange of the
    account rows in front of the aggregation. It pays only where nearly every account of a customer
    lies in another file: in the bench it moved two to three times the bytes of the partial
    results, for scattered and for clustered accounts. With `values` from
    `learned_codes` the accounts are read once.
    """
    keys = [CUSTOMER_KEY, SCRUB_DATE]
    rows = account_rows(tradeline, keys, SCRUB_DATE, strict)
    features = feature_frame(gather(rows, keys) if gathered else rows, keys, groups, values=values)
    return attach_party(features, party_map(master))


def learned_codes(tradeline: DataFrame, groups: Groups = ACCOUNT_GROUPS) -> dict[str, list[str]]:
    """Codes beyond the code book that occur, for the distinct counts of the groups: a job that reads
    one column."""
    return learned_values(account_rows(tradeline, [CUSTOMER_KEY, SCRUB_DATE], SCRUB_DATE), groups)


def enquiry_features(
    enquiry: DataFrame,
    tradeline: DataFrame,
    master: DataFrame,
    scrub_date: str,
    groups: Groups = ENQUIRY_GROUPS,
) -> DataFrame:
    """One row per customer of the delivery with at least one enquiry up to it.

    Keys belong to a delivery: the semi-join drops the enquiries of all others before anything is
    aggregated. Its right side has one row per key, so adaptive execution can split a hot key.
    """
    day = F.lit(scrub_date).cast("date")
    known = scrub_enquiries(enquiry, tradeline, scrub_date)
    features = feature_frame(
        enquiry_rows(known, [CUSTOMER_KEY], SCRUB_DATE), [CUSTOMER_KEY], groups
    )
    with_party = attach_party(features, party_map(master))
    names = [c for c in features.columns if c != CUSTOMER_KEY]
    return with_party.select(CUSTOMER_KEY, PARTY, day.alias(SCRUB_DATE), *names)


def batch_enquiry_features(
    enquiry: DataFrame, tradeline: DataFrame, master: DataFrame, groups: Groups = ENQUIRY_GROUPS
) -> DataFrame:
    """The same for all deliveries of `tradeline`, each as of its own date."""
    keys = [CUSTOMER_KEY, SCRUB_DATE]
    rows = enquiry_rows(batch_enquiries(enquiry, tradeline), keys, SCRUB_DATE)
    features = attach_party(feature_frame(rows, keys, groups), party_map(master))
    names = [c for c in features.columns if c not in (CUSTOMER_KEY, PARTY, SCRUB_DATE)]
    return features.select(CUSTOMER_KEY, PARTY, SCRUB_DATE, *names)


@dataclass(frozen=True)
class ScrubTables:
    """Names or paths of the inputs and of the two feature sinks."""

    tradeline: str
    enquiry: str
    master: str
    tradeline_sink: str
    enquiry_sink: str


@dataclass(frozen=True)
class Computation:
    """What a run computes: feature groups of both sources, and whether look-ahead is closed."""

    account_groups: Groups = ACCOUNT_GROUPS
    enquiry_groups: Groups = ENQUIRY_GROUPS
    strict: bool = False


@dataclass
class ScrubReport:
    """Deliveries computed, oldest first, and for each the sinks written, with their rows, and those
    skipped; and deliveries left to another run that is computing them."""

    dates: list[str] = field(default_factory=list)
    written: dict[str, list[str]] = field(default_factory=dict)
    skipped: dict[str, list[str]] = field(default_factory=dict)
    rows: dict[str, dict[str, int]] = field(default_factory=dict)
    taken: list[str] = field(default_factory=list)


def _write(features: DataFrame, sink: str, dates: Sequence[str]) -> dict[str, int]:
    """Replace the partitions of a batch, and count their rows in the job that writes them."""
    seen = Observation()
    counts = [F.count_if(F.col(SCRUB_DATE) == F.lit(d).cast("date")).alias(d) for d in dates]
    sinks.write_append(features.observe(seen, *counts), sink, SCRUB_DATE)
    return {d: seen.get[d] for d in dates}


def _compute(
    spark: SparkSession, names: ScrubTables, dates: Sequence[str], todo: Sequence[str], what: Computation
) -> dict[str, dict[str, int]]:
    """All deliveries of a batch in one job a sink. Returns rows by sink and date."""
    master = tables.read_master(spark, names.master)
    accounts = tables.read_tradeline(spark, names.tradeline, *dates)
    rows = {}
    if names.tradeline_sink in todo:
        values = learned_codes(accounts, what.account_groups)
        features = tradeline_features(accounts, master, what.account_groups, what.strict, values=values)
        rows[names.tradeline_sink] = _write(features, names.tradeline_sink, dates)
    if names.enquiry_sink in todo:
        enquiries = tables.read_enquiry(spark, names.enquiry)
        features = batch_enquiry_features(enquiries, accounts, master, what.enquiry_groups)
        rows[names.enquiry_sink] = _write(features, names.enquiry_sink, dates)
    return rows


def batches(
    deliveries: Sequence[ledger.Delivery], todo: Mapping[str, Sequence[str]], limit: int
) -> Iterator[list[ledger.Delivery]]:
    """Neighbouring deliveries for the same sinks, up to `limit` bytes of accounts together. One of
    unknown size is a batch by itself."""
    batch: list[ledger.Delivery] = []
    size = 0
    for delivery in deliveries:
        more = limit if delivery.bytes is None else delivery.bytes
        if batch and (size + more > limit or todo[delivery.date] != todo[batch[0].date]):
            yield batch
            batch, size = [], 0
        batch.append(delivery)
        size += more
    if batch:
        yield batch


def _present(spark: SparkSession, sink: str) -> set[str]:
    """One date a delivery, from the sink's partitions."""
    return {str(row[SCRUB_DATE]) for row in written_dates(spark, sink).collect()}


def run(
    spark: SparkSession,
    names: ScrubTables,
    what: str = "ALL",
    start: str | None = None,
    end: str | None = None,
    force: bool = False,
    computation: Computation = Computation(),
    batch_bytes: int = BATCH_BYTES,
) -> ScrubReport:
    """Dispatch: a date, ALL (pending only), FULL (everything again) or RANGE (start to end).

    A sink that has a delivery is skipped, unless `force` (or FULL) has it computed again, or its
    input has changed since (`operators.ledger`). Deliveries are computed in batches, oldest first,
    as many as have `batch_bytes` of accounts; a failure stops the run, written batches stay and the
    next run resumes. Deliveries that another run is computing are left to it.

    Input, sinks and ledgers are listed once a run. Only dates, one a delivery, reach the driver.
    """
    if what == "RANGE" and not (start and end):
        raise ValueError("RANGE needs start and end")
    force = force or what == "FULL"
    targets = (names.tradeline_sink, names.enquiry_sink)
    present = {sink: _present(spark, sink) for sink in targets}
    known = {sink: ledger.entries(spark, sink) for sink in targets}
    delivered = ledger.deliveries(spark, names.tradeline)
    if delivered is None:
        dates = source_dates(spark, names.tradeline).orderBy(SCRUB_DATE).collect()
        delivered = [ledger.Delivery(str(row[SCRUB_DATE])) for row in dates]
    if what == "RANGE":
        delivered = [d for d in delivered if start <= d.date <= end]
    elif what not in ("ALL", "FULL"):
        delivered = [d for d in delivered if d.date == what] or [ledger.Delivery(what)]
    todo = {
        d.date: [s for s in targets if force or not ledger.is_done(d, known[s], present[s])]
        for d in delivered
    }
    report = ScrubReport()
    if what in ("ALL", "FULL", "RANGE"):
        delivered = [d for d in delivered if todo[d.date]]
    claimed: list[str] = []
    with tuned(spark):
        try:
            for batch in batches(delivered, todo, batch_bytes):
                sinks_todo = todo[batch[0].date]
                if sinks_todo:
                    for delivery in batch:
                        mine = ledger.claim(spark, names.tradeline_sink, delivery.date)
                        (claimed if mine else report.taken).append(delivery.date)
                    batch = [d for d in batch if d.date in claimed]
                dates = [d.date for d in batch]
                rows = _compute(spark, names, dates, sinks_todo, computation) if sinks_todo and dates else {}
                for delivery in batch:
                    date = delivery.date
                    for sink in sinks_todo:
                        if not rows[sink][date] and date in present[sink]:
                            sinks.drop_partition(spark, sink, SCRUB_DATE, date)
                        ledger.append(spark, sink, delivery, rows[sink][date])
                    report.dates.append(date)
                    report.written[date] = sinks_todo
                    report.skipped[date] = [sink for sink in targets if sink not in sinks_todo]
                    report.rows[date] = {sink: rows[sink][date] for sink in sinks_todo}
                log.info("deliveries %s: wrote %s", dates, sinks_todo or "nothing")
                ledger.release(spark, names.tradeline_sink, claimed)
                claimed.clear()
        finally:
            ledger.release(spark, names.tradeline_sink, claimed)
    return report
