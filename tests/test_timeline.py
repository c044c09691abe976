"""As-of lookups by bisection against joins and brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from bureauframe.functions.dates import window_start
from bureauframe.operators import asof, timeline
from bureauframe.operators.aggregate import feature_frame
from bureauframe.plans import retro
from bureauframe.plans.catalogue import ENQUIRY_GROUPS
from bureauframe.plans.features import ENQUIRY, FeatureGroup, mean
from bureauframe.plans.rows import enquiry_rows
from bureauframe.sources import derived
from bureauframe.sources.schemas import REFERENCE_DATE, RETRO_KEYS
from plans import output_rows

DAY = dt.date(2022, 12, 1)
MASTER = "customer_scrub_key string, party_code string, scrub_output_date date"
RESOLVED = "party_code string, reference_dt date"
ENQUIRIES = "customer_scrub_key string, inq_date string, inq_purp_cd string, m_sub_id string"


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_window_start_is_where_months_between_crosses(spark):
    days = spark.range(800).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("today"))
    for w in (1, 3, 6, 12, 24):
        seen = days.selectExpr("today", f"{window_start('today', w)} AS start", f"explode(sequence(0, {w * 31 + 40})) AS back")
        wrong = seen.filter(f"(months_between(today, date_sub(today, back)) <= {w}) <> (date_sub(today, back) >= start)")
        assert wrong.isEmpty()


def test_rank_by_bisection(spark):
    rng = random.Random(1)
    rows = []
    for n in (1, 2, 3, 7, 8, 9, 100):
        days = sorted(rng.sample(range(-50, 200), n))
        rows += [([(d,) for d in days], x, sum(d <= x for d in days)) for x in [-99, 250, *rng.sample(range(-60, 210), 20)]]
    frame = spark.createDataFrame(rows, "t array<struct<day: int>>, x int, want int")
    assert frame.filter(f"{timeline.rank_sql('t', 'x')} <> want").isEmpty()


def test_features_equal_an_aggregation_of_all_pairs(spark):
    """Also at the ends of months, with repeated days, keys of two parties and events without a day."""
    rng = random.Random(2)

    def day():
        d = DAY + dt.timedelta(rng.randrange(600))
        return (d.replace(day=1) - dt.timedelta(rng.choice([1, 2, 3]))) if rng.random() < 0.5 else d

    master = spark.createDataFrame(
        [(f"k{i}", f"p{i % 7}", DAY) for i in range(30)] + [("k1", "p5", DAY), ("k2", None, DAY), ("k3", "p3", DAY)], MASTER
    )
    resolved = spark.createDataFrame(list({(f"p{rng.randrange(9)}", day()) for _ in range(300)}), RESOLVED)
    enquiry = spark.createDataFrame(
        [(f"k{rng.randrange(33)}", rng.choice([str(day())] * 9 + [None, "never"]), rng.choice(["13", "7", "8", "1", "99", None]),
          rng.choice(["NBF", "pvt", "PUB", None])) for _ in range(400)], ENQUIRIES
    )
    got = retro.enquiry_features(enquiry, resolved, master)
    pairs = enquiry_rows(asof.retro_enquiries(enquiry, resolved, master), RETRO_KEYS, REFERENCE_DATE)
    want = feature_frame(pairs, RETRO_KEYS, ENQUIRY_GROUPS)
    assert same(got, want) and want.count() > 100
    again = retro.enquiry_features(enquiry.unionByName(enquiry), resolved, master, dedup_on=enquiry.columns)
    once = retro.enquiry_features(enquiry.distinct(), resolved, master.distinct(), dedup_on=enquiry.columns)
    assert same(again, once)


def test_the_earliest_of_repeated_enquiries_counts(spark):
    master = spark.createDataFrame([("a", "p", DAY), ("b", "p", DAY)], MASTER)
    resolved = spark.createDataFrame([("p", dt.date(2023, 3, 1)), ("p", dt.date(2023, 6, 1))], RESOLVED)
    enquiry = spark.createDataFrame([("a", "2023-05-01", "13", "x"), ("b", "2023-02-01", "13", "x"), ("b", None, "13", "x")], ENQUIRIES)
    got = retro.enquiry_features(enquiry, resolved, master, dedup_on=["inq_purp_cd", "m_sub_id"]).orderBy(REFERENCE_DATE)
    assert [(r.total_enquiries, r.enquiry_in_last_3m, r.enquiry_pl_last_6m) for r in got.collect()] == [(1, 1, 1), (1, 0, 1)]


def test_groups_with_other_features_still_work(spark):
    master = spark.createDataFrame([("a", "p", DAY)], MASTER)
    resolved = spark.createDataFrame([("p", dt.date(2023, 3, 1))], RESOLVED)
    enquiry = spark.createDataFrame([("a", "2023-01-01", "13", "x"), ("a", "2023-02-01", "7", "x")], ENQUIRIES)
    own = (FeatureGroup("own", ENQUIRY, (mean("mean_age", "mse"),)),)
    assert retro.enquiry_features(enquiry, resolved, master, own).first().mean_age == 1.5


def test_a_busy_party_is_not_multiplied(spark):
    n = 10_000
    master = spark.createDataFrame([("a", "p", DAY)], MASTER)
    resolved = spark.range(n).selectExpr("'p' AS party_code", "date_add(DATE '2000-01-01', CAST(id AS INT)) AS reference_dt")
    enquiry = spark.range(n).selectExpr(
        "'a' AS customer_scrub_key", "CAST(date_add(DATE '2000-01-01', CAST(id * 7919 % 10000 AS INT)) AS STRING) AS inq_date",
        "'13' AS inq_purp_cd", "'NBF' AS m_sub_id",
    )
    frame = retro.enquiry_features(enquiry, resolved, master)
    rows = sorted((r.reference_dt, r.total_enquiries, r.enquiry_in_last_3m) for r in frame.collect())
    assert [r[1] for r in rows] == list(range(1, n + 1)) and {r[2] for r in rows[100:]} <= set(range(89, 94))
    assert max(k for _, k in output_rows(frame)) <= 2 * n


def test_references_meet_one_row_each(spark):
    """A party that owns most references and many deliveries."""
    n = 10_000
    master = spark.range(400).selectExpr(
        "concat('k', id) AS customer_scrub_key", "IF(id < 300, 'hot', concat('p', id)) AS party_code",
        "date_add(DATE '2000-01-01', CAST(id % 150 * 30 AS INT)) AS scrub_output_date",
    )
    references = spark.range(n).selectExpr(
        "IF(id < 9000, 'hot', concat('p', id % 400)) AS party_code", "date_add(DATE '1999-01-01', CAST(id AS INT)) AS reference_dt"
    )
    got = asof.resolve_snapshots(references, master)
    joined = references.join(master, "party_code").filter("scrub_output_date BETWEEN reference_dt AND add_months(reference_dt, 12)")
    want = joined.groupBy("party_code", "reference_dt").agg(
        F.max("scrub_output_date").alias("scrub_output_date"),
        F.expr("min_by(customer_scrub_key, struct(-unix_date(scrub_output_date), customer_scrub_key))").alias("customer_scrub_key"),
    )
    assert same(got, want)
    got.collect()
    assert max(k for _, k in output_rows(got)) <= n
    missing = asof.unmatched_references(references, got)
    assert missing.count() == n - got.count()


def test_registered_tables_agree_with_the_join(spark, sf):
    enquiry, master = derived.enquiry(spark, sf), derived.master(spark, sf)
    resolved = asof.resolve_snapshots(asof.reference_keys(derived.references(spark, sf)), master)
    pairs = enquiry_rows(asof.retro_enquiries(enquiry, resolved, master), RETRO_KEYS, REFERENCE_DATE)
    assert same(retro.enquiry_features(enquiry, resolved, master), feature_frame(pairs, RETRO_KEYS, ENQUIRY_GROUPS))
