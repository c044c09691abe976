import datetime as dt

import pytest

from bureauframe.functions.dates import parse_date

D = dt.date(2021, 12, 8)


def parsed(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", parse_date("t").alias("d")).orderBy("i").collect()
    return [r["d"] for r in rows]


def test_every_format(spark):
    texts = [
        "08/12/2021", "2021-12-08", "08-12-2021", "2021/12/08", "20211208",
        "2021-12-08T01:02:03.004+00:00", "2021-12-08T01:02:03.004Z", "2021-12-08T01:02:03.004",
        "2021-12-08T01:02:03", "2021-12-08 01:02:03",
    ]
    assert parsed(spark, *texts) == [D] * len(texts)


def test_day_first_then_month_first(spark):
    assert parsed(spark, "08/12/2021", "12/25/2021") == [D, dt.date(2021, 12, 25)]


def test_what_a_lenient_parser_reads(spark):
    texts = ["8/12/2021", "2021-12-08T01:02:03Z", "2021-12-08T01:02:03+05:30", "2021-12-08 01:02:03.5",
             " 2021-12-08", "\t08/12/2021", "2021-12-08x", "8-12-2021", "2021/12/8", "2021-12-8 x",
             "08/12/2021 10:00", "20211208T1", "2021-12-08T25:00:00"]
    assert parsed(spark, *texts) == [D] * len(texts)
    assert parsed(spark, "8/1/2021", "1/13/2021") == [dt.date(2021, 1, 8), dt.date(2021, 1, 13)]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_offsets_do_not_move_the_day(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        late, early = "2021-12-07T22:00:00.000-05:00", "2021-12-09T02:00:00.000+05:30"
        assert parsed(spark, late, early) == [dt.date(2021, 12, 7), dt.date(2021, 12, 9)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_date_is_null(spark):
    texts = ["garbage", "", None, "08/12/21", "31/02/2021", "2021-13-01", "2021-12", "2021", "0",
             "00000000", "2021-12-081", "08-12/2021", "08/12/20215", "x 2021-12-08", "2021-12-xx"]
    assert parsed(spark, *texts) == [None] * len(texts)


def test_typed_dates_pass(spark):
    df = spark.createDataFrame([(D,)], "t date")
    assert df.select(parse_date("t").alias("d")).first()["d"] == D
