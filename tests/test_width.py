"""Wide account rows are neither sorted nor shuffled where narrow ones serve."""

import __spark_entry__ as entry
from bureauframe.operators import asof
from bureauframe.session import tuned
from bureauframe.sources import derived, sinks
from bureauframe.sources.schemas import SCRUB_DATE
from plans import nodes


def widths(frame, kind):
    """Columns below each operator of a kind, of a frame that has run."""
    return [p.children().apply(0).output().size() for p in nodes(frame) if p.getClass().getSimpleName() == kind]


def test_partitions_are_written_without_a_sort(spark, sf, tmp_path):
    """With few partitions a task writes them side by side; the rows are all there."""
    accounts = derived.tradeline(spark, sf)
    with tuned(spark):
        writers = int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        sinks.write_append(accounts, str(tmp_path / "sink"), SCRUB_DATE)
    assert writers >= len(derived.SCRUB_DATES)
    back = spark.read.parquet(str(tmp_path / "sink")).select(accounts.columns)
    assert back.exceptAll(accounts).isEmpty() and accounts.exceptAll(back).isEmpty()


def test_party_joins_narrow_accounts(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry.scrub_tradeline(spark, sf)
        got = frame.collect()
        assert max(widths(frame, "ShuffleExchangeExec") + widths(frame, "SortExec")) < 20
        accounts = derived.tradeline(spark, sf).filter(f"{SCRUB_DATE} = DATE '{entry.LATER}'")
        want = asof.attach_party(accounts, entry.party_map(spark, sf))
        assert frame.schema == want.schema and sorted(map(str, got)) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orders_are_gathered_before_they_are_widened(spark, sf):
    frame = derived.tradeline(spark, sf, gathered=True)
    got = frame.collect()
    assert widths(frame, "ShuffleExchangeExec") and max(widths(frame, "ShuffleExchangeExec")) < 20
    assert sorted(map(str, got)) == sorted(map(str, derived.tradeline(spark, sf).collect()))
