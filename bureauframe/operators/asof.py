"""Joins that decide which rows a customer and as-of date may see.

No join carries a broadcast hint: Spark broadcasts a side when its size, estimated or measured at
run time, is under the session's threshold, and otherwise shuffles and splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.functions.dates import parse_date
from bureauframe.operators.timeline import DAY, TIMELINE, gathered, rank_sql
from bureauframe.sources.schemas import CUSTOMER_KEY, PARTY, REFERENCE_DATE, SCRUB_DATE

SNAPSHOT_WINDOW_MONTHS = 12


def party_map(master: DataFrame) -> DataFrame:
    """One party per customer key: the smallest, where NULL sorts first.

    An aggregate instead of a ranking window: parts combine before the shuffle, so a key never
    meets all its rows. (Spark sorts within a task for minima of text.)
    """
    party = F.when(F.count(F.when(F.col(PARTY).isNull(), 1)) == 0, F.min(PARTY))
    return master.groupBy(CUSTOMER_KEY).agg(party.alias(PARTY))


def attach_party(df: DataFrame, parties: DataFrame) -> DataFrame:
    """Add the party to every row; a party already present is replaced, an unknown one is NULL."""
    rest = [c for c in df.columns if c not in (CUSTOMER_KEY, PARTY)]
    return df.drop(PARTY).join(parties, CUSTOMER_KEY, "left").select(CUSTOMER_KEY, PARTY, *rest)


def scrub_enquiries(enquiry: DataFrame, tradeline: DataFrame, scrub_date: str) -> DataFrame:
    """Enquiries of the customers in one delivery, not later than it, stamped with its date."""
    day = F.lit(scrub_date).cast("date")
    customers = tradeline.filter(F.col(SCRUB_DATE) == day).select(CUSTOMER_KEY).distinct()
    return (
        enquiry.filter(parse_date("inq_date") <= day)
        .join(customers, CUSTOMER_KEY, "left_semi")
        .withColumn(SCRUB_DATE, day)
    )


def batch_enquiries(enquiry: DataFrame, tradeline: DataFrame) -> DataFrame:
    """The same for all deliveries of `tradeline` at once, each enquiry stamped with the dates of the
    deliveries that have its customer: one, for a key belongs to a delivery."""
    customers = tradeline.select(CUSTOMER_KEY, SCRUB_DATE).distinct()
    found = enquiry.drop(SCRUB_DATE).join(customers, CUSTOMER_KEY)
    return found.filter(parse_date("inq_date") <= F.col(SCRUB_DATE))


def reference_keys(references: DataFrame) -> DataFrame:
    """Distinct (party, reference date), with the date typed."""
    day = parse_date(REFERENCE_DATE).alias(REFERENCE_DATE)
    return references.select(PARTY, day).distinct()


def resolve_snapshots(
    references: DataFrame, master: DataFrame, months: int = SNAPSHOT_WINDOW_MONTHS
) -> DataFrame:
    """For each of the distinct references the latest delivery within `months` after it.

    The master is reduced to one row per party: the timeline of its deliveries, each with the
    smallest customer key. A reference meets that row once and finds the last delivery up to the end
    of its window by bisection, so no reference is multiplied by the deliveries of its party.
    """
    deliveries = (
        master.filter(F.col(SCRUB_DATE).isNotNull())
        .groupBy(PARTY, F.unix_date(SCRUB_DATE).alias(DAY))
        .agg(F.min(CUSTOMER_KEY).alias(CUSTOMER_KEY))
    )
    limit = f"unix_date(add_months({REFERENCE_DATE}, {months}))"
    latest = F.expr(f"get({TIMELINE}, {rank_sql(TIMELINE, limit)} - 1)")
    return (
        references.join(gathered(deliveries, PARTY, [CUSTOMER_KEY]), PARTY)
        .select(PARTY, REFERENCE_DATE, latest.alias("latest"))
        .filter(F.col(f"latest.{DAY}") >= F.unix_date(REFERENCE_DATE))
        .select(
            PARTY,
            REFERENCE_DATE,
            F.date_from_unix_date(f"latest.{DAY}").alias(SCRUB_DATE),
            F.col(f"latest.{CUSTOMER_KEY}").alias(CUSTOMER_KEY),
        )
    )


def unmatched_references(references: DataFrame, resolved: DataFrame) -> DataFrame:
    """References without a delivery in their window; they have no feature row."""
    return references.join(resolved, [PARTY, REFERENCE_DATE], "left_anti")


def retro_tradeline(tradeline: DataFrame, resolved: DataFrame, colocated: bool = False) -> DataFrame:
    """Accounts of the resolved delivery, once per reference.

    The dates asked for, one a delivery, are broadcast and prune the partitions of the scan while it
    runs. `resolved` itself, which grows with the references, is joined after. Accounts that are
    `colocated` by customer are joined on that key alone, which their layout serves without an
    exchange; the date, which the key belongs to, is compared in the join.
    """
    dates = F.broadcast(resolved.select(SCRUB_DATE).distinct())
    read = tradeline.drop(PARTY).join(dates, SCRUB_DATE, "left_semi")
    if not colocated:
        return read.join(resolved, [CUSTOMER_KEY, SCRUB_DATE])
    found = resolved.withColumnRenamed(SCRUB_DATE, "_resolved")
    # A difference instead of an equality: Spark would take that for a second join key.
    joined = read.join(found, CUSTOMER_KEY).filter(F.datediff(SCRUB_DATE, "_resolved") == 0)
    return joined.drop("_resolved")


def retro_enquiries(
    enquiry: DataFrame, resolved: DataFrame, master: DataFrame, dedup_on: list[str] | None = None
) -> DataFrame:
    """Enquiries of every key of the party, not later than the reference.

    An enquiry delivered under several keys of a party counts once per key. `dedup_on` names the
    columns that identify an enquiry across deliveries and keeps one of each.
    """
    keys = master.select(CUSTOMER_KEY, PARTY).distinct()
    parties = resolved.select(PARTY, REFERENCE_DATE).join(keys, PARTY)
    found = enquiry.drop(PARTY, SCRUB_DATE).join(parties, CUSTOMER_KEY)
    found = found.filter(parse_date("inq_date") <= F.col(REFERENCE_DATE))
    if dedup_on:
        found = found.dropDuplicates([PARTY, REFERENCE_DATE, *dedup_on])
    return found


def party_enquiries(
    enquiry: DataFrame, resolved: DataFrame, master: DataFrame, dedup_on: list[str] | None = None
) -> DataFrame:
    """Enquiries of every key of the parties that references ask for, each with its party, once per
    key. With `dedup_on` one of each is kept, the earliest."""
    wanted = resolved.select(PARTY).distinct()
    keys = master.select(CUSTOMER_KEY, PARTY).distinct().join(wanted, PARTY, "left_semi")
    found = enquiry.drop(PARTY, SCRUB_DATE).join(keys, CUSTOMER_KEY)
    if not dedup_on:
        return found
    day = parse_date("inq_date")
    rest = [c for c in found.columns if c not in (PARTY, *dedup_on)]
    first = F.min_by(F.struct(*rest), day).alias("first")
    return found.filter(day.isNotNull()).groupBy(PARTY, *dedup_on).agg(first).select(PARTY, *dedup_on, "first.*")


def with_timelines(resolved: DataFrame, timelines: DataFrame) -> DataFrame:
    """Each reference with the timeline of its party; references without one are left out."""
    return resolved.select(PARTY, REFERENCE_DATE).join(timelines, PARTY)
