"""Which deliveries a run takes up, and in what batches."""

import os
import time

import pytest
from pyspark.sql import functions as F

from bureauframe.operators import incremental, ledger
from bureauframe.plans import scrub
from bureauframe.plans.catalogue import GROUPS
from bureauframe.sources import derived, sinks
from bureauframe.sources.schemas import CUSTOMER_KEY, SCRUB_DATE

DATES = ["2023-07-31", "2023-10-31", "2024-01-31", "2024-04-30"]
SMALL = scrub.Computation((GROUPS["grp04_bureau_vintage"],), (GROUPS["grp12_enquiries"],))


@pytest.fixture
def names(spark, sf, tmp_path):
    """Four deliveries of their own customers; the third has accounts but no enquiries."""
    accounts, enquiries = derived.tradeline(spark, sf), derived.enquiry(spark, sf)
    accounts = accounts.filter(f"{SCRUB_DATE} = DATE '{DATES[0]}' AND acct_id % 7 < 4")
    n = F.pmod(F.hash(CUSTOMER_KEY), F.lit(4))
    day = F.element_at(F.array(*map(F.lit, DATES)), n + 1)
    accounts.withColumn(SCRUB_DATE, day.cast("date")).write.partitionBy(SCRUB_DATE).parquet(str(tmp_path / "tl"))
    enquiries.filter(n != 2).write.parquet(str(tmp_path / "enq"))
    derived.master(spark, sf).write.parquet(str(tmp_path / "master"))
    return scrub.ScrubTables(*(str(tmp_path / x) for x in ("tl", "enq", "master", "tl_sink", "enq_sink")))


def rows(spark, sink):
    frame = spark.read.parquet(sink)
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def run(spark, names, *what, **options):
    return scrub.run(spark, names, *what, computation=SMALL, **options)


def test_batches_equal_single_deliveries(spark, names, tmp_path):
    one = run(spark, names, "ALL", batch_bytes=0)
    other = scrub.ScrubTables(names.tradeline, names.enquiry, names.master, str(tmp_path / "b1"), str(tmp_path / "b2"))
    two = run(spark, other, "ALL")
    assert one.dates == two.dates == DATES and one.rows.keys() == two.rows.keys()
    for a, b in ((names.tradeline_sink, other.tradeline_sink), (names.enquiry_sink, other.enquiry_sink)):
        assert rows(spark, a) == rows(spark, b)
        for date in DATES:
            count = spark.read.parquet(a).filter(f"{SCRUB_DATE} = DATE '{date}'").count()
            assert one.rows[date][a] == two.rows[date][b] == count
    assert two.rows[DATES[2]][other.enquiry_sink] == 0
    assert run(spark, other, "ALL").dates == []


def test_a_redelivery_is_computed_again(spark, names):
    run(spark, names)
    more = spark.read.parquet(names.tradeline).filter(f"{SCRUB_DATE} = DATE '{DATES[1]}'").limit(1)
    more = more.withColumn(CUSTOMER_KEY, F.lit("new"))
    more.write.mode("append").partitionBy(SCRUB_DATE).parquet(names.tradeline)
    again = run(spark, names)
    assert again.dates == [DATES[1]] and again.written[DATES[1]] == [names.tradeline_sink, names.enquiry_sink]
    found = spark.read.parquet(names.tradeline_sink).filter(f"{CUSTOMER_KEY} = 'new'")
    assert [str(r[SCRUB_DATE]) for r in found.collect()] == [DATES[1]]
    assert run(spark, names).dates == []


def test_a_half_loaded_delivery_is_computed_again(spark, names, monkeypatch):
    """Stopped after the first sink was written and before the ledger knows."""
    run(spark, names, DATES[0])
    write, done = scrub._write, []

    def fail(*args):
        done.append(args[1])
        if len(done) == 2:
            raise OSError("stop here")
        return write(*args)

    monkeypatch.setattr(scrub, "_write", fail)
    with pytest.raises(OSError, match="stop here"):
        run(spark, names)
    monkeypatch.undo()
    assert {str(r[0]) for r in incremental.written_dates(spark, names.tradeline_sink).collect()} == set(DATES)
    again = run(spark, names)
    assert again.dates == DATES[1:] and all(len(w) == 2 for w in again.written.values())


def test_a_failed_batch_resumes(spark, names, monkeypatch):
    compute, done = scrub._compute, []

    def fail(spark_, names_, dates, *rest):
        if len(done) == 2:
            raise OSError("stop here")
        done.append(dates)
        return compute(spark_, names_, dates, *rest)

    monkeypatch.setattr(scrub, "_compute", fail)
    with pytest.raises(OSError):
        run(spark, names, batch_bytes=0)
    monkeypatch.undo()
    assert done == [[DATES[0]], [DATES[1]]]
    assert run(spark, names).dates == DATES[2:]


def test_lost_rows_are_computed_again(spark, names):
    run(spark, names)
    sinks.drop_partition(spark, names.tradeline_sink, SCRUB_DATE, DATES[3])
    again = run(spark, names)
    assert again.written == {DATES[3]: [names.tradeline_sink]} and again.skipped == {DATES[3]: [names.enquiry_sink]}


def test_a_sink_older_than_its_ledger_counts_as_it_is(spark, names):
    run(spark, names, DATES[0])
    for sink in (names.tradeline_sink, names.enquiry_sink):
        os.rename(ledger.folder(spark, sink), f"{sink}_away")
    assert run(spark, names).dates == DATES[1:]


def test_rows_that_are_gone_leave_the_sink(spark, names):
    run(spark, names)
    before = spark.read.parquet(names.enquiry_sink).count()
    spark.read.parquet(names.enquiry).limit(0).write.mode("overwrite").parquet(names.enquiry)
    report = run(spark, names, "RANGE", DATES[0], DATES[0], force=True)
    gone = report.rows[DATES[0]]
    assert gone[names.enquiry_sink] == 0 < before
    assert spark.read.parquet(names.enquiry_sink).filter(f"{SCRUB_DATE} = DATE '{DATES[0]}'").isEmpty()


def test_two_runs_do_not_take_the_same_delivery(spark, names, monkeypatch):
    assert ledger.claim(spark, names.tradeline_sink, DATES[1])
    assert not ledger.claim(spark, names.tradeline_sink, DATES[1])
    report = run(spark, names)
    assert report.taken == [DATES[1]] and report.dates == [DATES[0], *DATES[2:]]
    monkeypatch.setattr(ledger, "LEASE_SECONDS", 0)
    time.sleep(0.01)
    assert run(spark, names).dates == [DATES[1]]
    assert not list(os.scandir(f"{ledger.folder(spark, names.tradeline_sink)}/_claims"))


def test_batches_are_bounded_by_bytes():
    days = [ledger.Delivery(str(i), "x", size) for i, size in enumerate([4, 4, 4, 20, 1, 1, None, 1])]
    todo = {d.date: ["a"] for d in days} | {"5": ["b"]}
    got = [[d.date for d in batch] for batch in scrub.batches(days, todo, 10)]
    assert got == [["0", "1"], ["2"], ["3"], ["4"], ["5"], ["6"], ["7"]]
