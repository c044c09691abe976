"""Retro features over accounts laid out by customer."""

import pytest
from pyspark.sql import functions as F

from bureauframe.operators import asof
from bureauframe.plans import retro
from bureauframe.plans.catalogue import GROUPS
from bureauframe.plans.scrub import Computation
from bureauframe.sources import derived, layout
from bureauframe.sources.schemas import CUSTOMER_KEY
from plans import nodes

SOME = tuple(GROUPS[n] for n in ("grp01_portfolio_counts", "grp06a_recency", "grp07_delinquency") if n in GROUPS)


@pytest.fixture(scope="module")
def inputs(spark, sf):
    """Bucketed accounts, one customer with a third of them, and resolved references."""
    accounts = derived.tradeline(spark, sf)
    hot = accounts.agg(F.max(CUSTOMER_KEY)).first()[0]
    key = F.when(F.col("acct_id") % 3 == 0, F.lit(hot)).otherwise(F.col(CUSTOMER_KEY))
    accounts = accounts.withColumn(CUSTOMER_KEY, key)
    layout.write_colocated(accounts, "laid_accounts", 4)
    resolved = asof.resolve_snapshots(asof.reference_keys(derived.references(spark, sf)), derived.master(spark, sf))
    yield accounts, resolved, hot
    for name in ("laid_accounts", "laid_accounts_heavy"):
        spark.sql(f"DROP TABLE {name}")


def shuffled_accounts(frame):
    """Exchanges with an account scan below them."""

    def scans(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(plan.plan())
        if "FileSourceScanExec" in name:
            return "laid_accounts" in plan.toString()
        children = plan.children()
        return any(scans(children.apply(i)) for i in range(children.size()))

    return [p for p in nodes(frame) if p.getClass().getSimpleName() == "ShuffleExchangeExec" and scans(p)]


def test_no_exchange_of_accounts(spark, inputs):
    accounts, resolved, hot = inputs
    laid = spark.table("laid_accounts")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for colocated in (True, False):
            frame = retro.tradeline_features(laid, resolved, SOME, colocated=colocated)
            got = sorted(map(str, frame.collect()))
            assert bool(shuffled_accounts(frame)) != colocated
            want = retro.tradeline_features(accounts.filter(F.col(CUSTOMER_KEY) != hot), resolved, SOME)
            assert got == sorted(map(str, want.collect())) and got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_exchange_serves_join_and_aggregation(spark, inputs):
    """Of accounts in any layout: the aggregation needs no second one."""
    accounts, resolved, _ = inputs
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = retro.tradeline_features(spark.table("laid_accounts_heavy"), resolved, [GROUPS["grp01_portfolio_counts"]])
        frame.collect()
        assert len(shuffled_accounts(frame)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_heavy_customers_are_apart(spark, inputs):
    accounts, _, hot = inputs
    heavy = {r[0] for r in spark.table("laid_accounts_heavy").select(CUSTOMER_KEY).distinct().collect()}
    assert hot in heavy and len(heavy) < 4
    both = spark.table("laid_accounts").unionByName(spark.table("laid_accounts_heavy")).select(accounts.columns)
    assert both.count() == accounts.count() and both.exceptAll(accounts).isEmpty()


def test_run_over_a_laid_out_table(spark, inputs, sf, tmp_path):
    accounts, _, _ = inputs
    for name in ("enquiry", "master", "references"):
        getattr(derived, name)(spark, sf).write.parquet(str(tmp_path / name))
    accounts.write.parquet(str(tmp_path / "tradeline"))
    for n, source in enumerate(("laid_accounts", str(tmp_path / "tradeline"))):
        report = retro.run(
            spark, *(str(tmp_path / "references"), source), *(str(tmp_path / x) for x in ("enquiry", "master", f"tl{n}", f"enq{n}")),
            computation=Computation(account_groups=SOME),
        )
        assert report.references > report.unmatched
    one, two = (spark.read.parquet(str(tmp_path / f"tl{n}")) for n in (0, 1))
    assert one.count() and one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert layout.is_colocated(spark, "laid_accounts") and not layout.is_colocated(spark, str(tmp_path / "tradeline"))


def test_buckets_grow_with_the_table(spark, sf, monkeypatch):
    """One task reads a bucket, so a larger table has more of them; narrow rows are shuffled alone."""
    monkeypatch.setattr(layout, "BUCKET_ROWS", 100)
    accounts = derived.tradeline(spark, sf)
    layout.write_colocated(derived.narrow_tradeline(spark, sf), "grown_accounts", 4, derived.widened)
    try:
        about = {r.col_name: r.data_type for r in spark.sql("DESCRIBE FORMATTED grown_accounts").collect()}
        assert int(about["Num Buckets"]) == -(-accounts.count() // 100) > 4
        both = spark.table("grown_accounts").unionByName(spark.table("grown_accounts_heavy"))
        both = both.select(accounts.columns)
        assert both.exceptAll(accounts).isEmpty() and accounts.exceptAll(both).isEmpty()
    finally:
        for name in ("grown_accounts", "grown_accounts_heavy"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
