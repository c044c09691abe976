"""Headline timings. Prints one JSON line.

The bureau tables are derived from the test tables and written once, outside the timing, so a query
is timed from its parquet scan to its last row. `wide_*` are the full feature rows in one
aggregation, `wide_hot_key` over input in which one customer owns a third of all accounts. The
comparison `grouped_joins` times the same account features as 16 aggregations joined on their keys,
in one pass; it is not part of the total, and BENCH_COMPARE=0 leaves it out. The comparison also
holds the bytes the wide aggregation shuffles with and without gathering, for accounts scattered
over the input and for accounts clustered by customer.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from bureauframe.operators import asof, frames
from bureauframe.plans import retro, scrub
from bureauframe.plans.catalogue import ACCOUNT_GROUPS, GROUPS
from bureauframe.session import local_session
from bureauframe.sources import derived
from bureauframe.sources.schemas import CUSTOMER_KEY, PARTY, SCRUB_DATE

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS) if CPUS.isdigit() else 8)
    root = tempfile.mkdtemp(prefix="bureauframe-bench-")
    for name in ("tradeline", "enquiry", "master", "references"):
        frame = getattr(derived, name)(spark, SF_DIR)
        writer = frame.repartition(spark.sparkContext.defaultParallelism * 2).write
        if name == "tradeline":
            writer = writer.partitionBy(SCRUB_DATE)
        writer.parquet(f"{root}/{name}")
    clustered = spark.read.parquet(f"{root}/tradeline").repartition(CUSTOMER_KEY)
    clustered.sortWithinPartitions(CUSTOMER_KEY).write.parquet(f"{root}/clustered")

    def read(name: str):
        return spark.read.parquet(f"{root}/{name}")

    def hot_key():
        key = F.when(F.col("acct_id") % 3 == 0, F.lit("C0")).otherwise(F.col(CUSTOMER_KEY))
        return scrub.tradeline_features(read("tradeline").withColumn(CUSTOMER_KEY, key), read("master"))

    def resolved():
        return asof.resolve_snapshots(asof.reference_keys(read("references")), read("master"))

    def one_group(name: str):
        return scrub.tradeline_features(
            read("tradeline"), read("master"), [GROUPS[name]], gathered=False
        )

    def enquiries():
        return scrub.enquiry_features(
            read("enquiry"), read("tradeline"), read("master"), derived.SCRUB_DATES[1]
        )

    def grouped_joins():
        parts = [one_group(group.name) for group in ACCOUNT_GROUPS]
        return frames.assemble(parts, [CUSTOMER_KEY, PARTY, SCRUB_DATE])

    queries = {
        "wide_tradeline": lambda: scrub.tradeline_features(
            read("tradeline"), read("master"), values=scrub.learned_codes(read("tradeline"))
        ),
        "wide_hot_key": hot_key,
        "wide_enquiry": enquiries,
        "wide_retro": lambda: retro.tradeline_features(
            read("tradeline"), resolved(), values=scrub.learned_codes(read("tradeline"))
        ),
        "wide_retro_enquiry": lambda: retro.enquiry_features(
            read("enquiry"), resolved(), read("master")
        ),
        "asof_snapshot": resolved,
        "grp01_portfolio_counts": lambda: one_group("grp01_portfolio_counts"),
        "grp03b_credit_utilization": lambda: one_group("grp03b_credit_utilization"),
        "grp07_delinquency": lambda: one_group("grp07_delinquency"),
        "grp08a_payment_behaviour": lambda: one_group("grp08a_payment_behaviour"),
        "grp09_obligations": lambda: one_group("grp09_obligations"),
    }

    def timed(build, passes: int = 2) -> float:
        best = float("inf")
        for _ in range(passes):  # the first pass also compiles
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        return round(best, 3)

    def shuffled(form: str, gathered: bool) -> float:
        """MB written to shuffles by the wide aggregation."""
        accounts = read("tradeline" if form == "scattered" else "clustered")
        before = written()
        features = scrub.tradeline_features(accounts, read("master"), gathered=gathered)
        features.write.format("noop").mode("overwrite").save()
        return round(written() - before, 1)

    def written() -> float:
        executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size())) / 1e6

    seconds = {name: timed(build) for name, build in queries.items()}
    result = {
        "metric": "feature_rows_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_COMPARE", "1") != "0":
        result["comparison"] = {"grouped_joins": timed(grouped_joins, passes=1)} | {
            f"shuffled_mb_{form}_{'gathered' if gathered else 'plain'}": shuffled(form, gathered)
            for form in ("scattered", "clustered")
            for gathered in (True, False)
        }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
