import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from bureauframe.operators import asof, frames, incremental
from bureauframe.plans import retro, scrub
from bureauframe.plans.catalogue import GROUPS
from bureauframe.session import tune
from bureauframe.sources import derived, sinks
from bureauframe.sources.schemas import SCRUB_DATE, TRADELINE, require_columns
from bureauframe.sources.tables import partition_columns, read_source

EARLIER, LATER = derived.SCRUB_DATES


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_replaces_only_its_partitions(spark, tmp_path):
    target = str(tmp_path / "sink")
    df = spark.createDataFrame([("a", EARLIER, 1), ("b", LATER, 2)], "k string, d string, v int")
    sinks.write_append(df, target, "d")
    before = sorted((tmp_path / "sink" / f"d={EARLIER}").iterdir())
    sinks.write_append(df.filter(f"d = '{LATER}'").selectExpr("k", "d", "v + 1 AS v"), target, "d")
    assert sorted((tmp_path / "sink" / f"d={EARLIER}").iterdir()) == before
    got = spark.read.parquet(target).selectExpr("k", "v", "CAST(d AS STRING) AS d")
    assert rows(got) == [("a", 1, EARLIER), ("b", 3, LATER)]


def test_append_without_partition_adds(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        sinks.write(df, str(tmp_path / "sink"), "append")
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 6


def test_merge_updates_inserts_and_keeps_old_columns(spark, tmp_path):
    target = str(tmp_path / "sink")
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, x string, y int")
    sinks.write(old, target, "merge", keys=["k"])
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, x string")
    sinks.write(new, target, "merge", keys=["k"])
    assert rows(spark.read.parquet(target).fillna(0)) == [(1, "a", 10), (2, "B", 20), (3, "C", 0)]
    with pytest.raises(ValueError, match="keys"):
        sinks.write(new, target, "merge")


def test_party_map_prefers_null_then_smallest(spark):
    master = spark.createDataFrame(
        [("a", "P2"), ("a", "P1"), ("b", None), ("b", "P0")],
        "customer_scrub_key string, party_code string",
    )
    assert {tuple(r) for r in asof.party_map(master).collect()} == {("a", "P1"), ("b", None)}


def test_snapshot_window_is_inclusive_and_takes_the_latest(spark):
    day = dt.date
    master = spark.createDataFrame(
        [("k1", "P", day(2023, 1, 15)), ("k2", "P", day(2024, 1, 15)), ("k0", "P", day(2024, 1, 15)),
         ("k3", "P", day(2024, 1, 16))],
        "customer_scrub_key string, party_code string, scrub_output_date date",
    )
    refs = spark.createDataFrame([("P", "15/01/2023"), ("P", "15/01/2023"), ("Q", "2023-01-01")],
                                 "party_code string, reference_dt string")
    keys = asof.reference_keys(refs)
    got = asof.resolve_snapshots(keys, master)
    assert rows(got) == [("P", day(2023, 1, 15), day(2024, 1, 15), "k0")]
    assert [r.party_code for r in asof.unmatched_references(keys, got).collect()] == ["Q"]


def test_pending_dates(spark):
    def dates(*days):
        return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], f"{SCRUB_DATE} date")

    both, first = dates(EARLIER, LATER), dates(EARLIER)
    assert [str(r[0]) for r in incremental.pending_dates(both, [both, first]).collect()] == [LATER]
    assert incremental.pending_dates(both, []).count() == 2


@pytest.fixture(scope="module")
def inputs(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inputs"))
    for name in ("tradeline", "enquiry", "master", "references"):
        frame = getattr(derived, name)(spark, sf)
        sinks.write_append(frame, f"{root}/{name}", SCRUB_DATE if name == "tradeline" else None)
    return root


def test_run_modes(spark, inputs, tmp_path):
    names = scrub.ScrubTables(
        f"{inputs}/tradeline",
        f"{inputs}/enquiry",
        f"{inputs}/master",
        str(tmp_path / "tl"),
        str(tmp_path / "enq"),
    )
    small = scrub.Computation(account_groups=(GROUPS["grp01_portfolio_counts"],))

    def run(*what, **options):
        return scrub.run(spark, names, *what, computation=small, **options)

    def totals():
        return rows(spark.read.parquet(names.tradeline_sink).select("customer_scrub_key", "tot_pls"))

    assert run("RANGE", "2023-01-01", "2023-12-31").dates == [EARLIER]
    assert run("ALL").dates == [LATER]
    assert run("ALL").dates == []
    both = [names.tradeline_sink, names.enquiry_sink]
    again = run(LATER)
    assert again.written == {LATER: []} and again.skipped == {LATER: both}
    first = totals()
    assert run("FULL").dates == [EARLIER, LATER]
    forced = run("RANGE", EARLIER, EARLIER, force=True)
    assert forced.written == {EARLIER: both} and totals() == first
    with pytest.raises(ValueError, match="start"):
        run("RANGE")


def test_one_sink_present_and_one_absent(spark, inputs, tmp_path):
    names = scrub.ScrubTables(*(f"{inputs}/{n}" for n in ("tradeline", "enquiry", "master")),
                              str(tmp_path / "tl"), str(tmp_path / "enq"))
    small = scrub.Computation((GROUPS["grp04_bureau_vintage"],))
    scrub.run(spark, names, EARLIER, computation=small)
    before = sorted((tmp_path / "tl").rglob("*.parquet"))
    shutil.rmtree(tmp_path / "enq")
    report = scrub.run(spark, names, EARLIER, computation=small)
    assert report.written == {EARLIER: [names.enquiry_sink]}
    assert report.skipped == {EARLIER: [names.tradeline_sink]}
    assert sorted((tmp_path / "tl").rglob("*.parquet")) == before
    assert scrub.run(spark, names, "ALL", computation=small).dates == [LATER]


def test_delivery_without_enquiries_is_done_once(spark, inputs, tmp_path):
    empty = str(tmp_path / "no_enquiries")
    spark.read.parquet(f"{inputs}/enquiry").limit(0).write.parquet(empty)
    names = scrub.ScrubTables(f"{inputs}/tradeline", empty, f"{inputs}/master",
                              str(tmp_path / "tl"), str(tmp_path / "enq"))
    small = scrub.Computation((GROUPS["grp04_bureau_vintage"],))
    assert scrub.run(spark, names, "ALL", computation=small).dates == [EARLIER, LATER]
    assert scrub.run(spark, names, "ALL", computation=small).dates == []


def test_pending_dates_come_from_metadata(spark, inputs):
    plan = incremental.source_dates(spark, f"{inputs}/tradeline")
    assert [str(r[0]) for r in plan.orderBy(SCRUB_DATE).collect()] == [EARLIER, LATER]
    assert "FileScan" not in plan._jdf.queryExecution().toString()


def test_runs_leave_the_session_as_it_was(spark, inputs, tmp_path):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "12345")
    names = scrub.ScrubTables(*(f"{inputs}/{n}" for n in ("tradeline", "enquiry", "master")),
                              str(tmp_path / "tl"), str(tmp_path / "enq"))
    scrub.run(spark, names, EARLIER, computation=scrub.Computation((GROUPS["grp04_bureau_vintage"],)))
    assert spark.conf.get(key) == "12345"
    tune(spark)


def test_sinks_refuse_to_lose_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", EARLIER, 1)], "k string, d string, v int")
    wider = df.selectExpr("*", "v AS w")
    for target in (str(tmp_path / "sink"), "sink_columns"):
        for partition in ("d", None):
            name = f"{target}_{partition}"
            sinks.write_append(df, name, partition)
            with pytest.raises(ValueError, match="w"):
                sinks.write_append(wider, name, partition)
            with pytest.raises(ValueError, match="missing"):
                sinks.write_append(df.drop("v"), name, partition)
            with pytest.raises(ValueError, match="types"):
                sinks.write_append(df.withColumn("v", df.v.cast("string")), name, partition)
            assert rows(read_source(spark, name).select("k", "v")) == [("a", 1)]
    sinks.write_append(wider, "sink_columns_d", "d", evolve=True)
    assert rows(spark.table("sink_columns_d").select("k", "v", "w")) == [("a", 1, 1)]
    for partition in ("d", None):
        spark.sql(f"DROP TABLE sink_columns_{partition}")


def test_merge_errors_and_layout(spark, tmp_path):
    target = str(tmp_path / "sink")
    old = spark.createDataFrame([(1, EARLIER, 1), (2, LATER, 2)], "k int, d string, v int")
    sinks.write(old, target, "merge", "d", ["k", "d"])
    with pytest.raises(ValueError, match="among the keys"):
        sinks.write(old, target, "merge", "d", ["k"])
    with pytest.raises(ValueError, match="more than once"):
        sinks.write(old.unionByName(old), target, "merge", "d", ["k", "d"])
    moved = spark.createDataFrame([(1, LATER, 5), (3, LATER, 6)], "k int, d string, v int")
    sinks.write(moved.withColumn("d", moved.d.cast("date")), target, "merge", keys=["k"])
    assert partition_columns(spark, target) == ["d"]
    got = spark.read.parquet(target).selectExpr("k", "CAST(d AS STRING) AS d", "v")
    assert rows(got) == [(1, LATER, 5), (2, LATER, 2), (3, LATER, 6)]


def test_a_failed_overwrite_keeps_the_old_sink(spark, tmp_path):
    target = str(tmp_path / "sink")
    sinks.write_overwrite(spark.range(3), target)
    with pytest.raises(Exception, match="stop here"):
        sinks.write_overwrite(spark.range(9).selectExpr("raise_error('stop here') AS id"), target)
    assert spark.read.parquet(target).count() == 3


def test_retro_scan_is_pruned_by_resolved_deliveries(spark, inputs):
    wanted = asof.reference_keys(spark.read.parquet(f"{inputs}/references"))
    resolved = asof.resolve_snapshots(wanted, spark.read.parquet(f"{inputs}/master"))
    resolved = resolved.filter(f"{SCRUB_DATE} = DATE '{LATER}'")
    plan = asof.retro_tradeline(spark.read.parquet(f"{inputs}/tradeline"), resolved)
    scan = next(x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "tradeline" in x)
    assert f"{SCRUB_DATE}" in scan.partition("PartitionFilters: [")[2].partition("]")[0]
    assert set(r[0] for r in plan.select(F.col(SCRUB_DATE).cast("string")).distinct().collect()) == {LATER}


def test_only_the_deliverys_keys_are_aggregated(spark, inputs):
    frame = scrub.enquiry_features(*(spark.read.parquet(f"{inputs}/{n}") for n in ("enquiry", "tradeline", "master")), LATER)
    lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    wide = next(i for i, line in enumerate(lines) if "total_enquiries" in line and "Aggregate" in line)
    assert wide < semi


def test_wide_aggregation_uses_hash_aggregates_only(spark, inputs):
    accounts = spark.read.parquet(f"{inputs}/tradeline")
    frame = scrub.tradeline_features(accounts, spark.read.parquet(f"{inputs}/master"))
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    # The party map takes the minimum of a text and is not part of the feature aggregation.
    assert not [x for x in lines if "ObjectHashAggregate" in x or "SortAggregate" in x and "min(party_code" not in x]


def test_retro_on_a_delivery_date_equals_scrub(spark, inputs):
    """One key per party and delivery, reference on the delivery date, no look-ahead."""
    accounts = spark.read.parquet(f"{inputs}/tradeline").filter(f"{SCRUB_DATE} = DATE '{LATER}'")
    master = asof.party_map(spark.read.parquet(f"{inputs}/master"))
    keyed = accounts.select("customer_scrub_key", SCRUB_DATE).distinct()
    master = keyed.join(master, "customer_scrub_key")
    refs = master.selectExpr("party_code", f"{SCRUB_DATE} AS reference_dt").distinct()
    groups = [GROUPS["grp01_portfolio_counts"], GROUPS["grp07_delinquency"]]
    names = [n for g in groups for n in g.outputs]
    now = scrub.tradeline_features(accounts, master, groups).select("party_code", *names)
    then = retro.tradeline_features(accounts, asof.resolve_snapshots(refs, master, 0), groups)
    then = then.select("party_code", *names)
    assert now.exceptAll(then).isEmpty() and then.exceptAll(now).isEmpty()


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="open_dt"):
        require_columns(spark.range(1), TRADELINE, "tradeline")


def test_frame_helpers(spark):
    left = spark.createDataFrame([(1, 4.0, 0.0)], "k int, a double, b double")
    joined = frames.safe_join(left, left, ["k"], right_prefix="r_")
    assert joined.columns == ["k", "a", "b", "r_a", "r_b"]
    assert left.select(frames.safe_divide("a", "b").alias("q")).first().q is None
    assert frames.distinct_columns(left.join(left, left.k == left.k)).columns == ["k", "a", "b"]
    masked = frames.mask_absent(left, {"a": "b"}).first()
    assert masked.a is None
