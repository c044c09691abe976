import datetime as dt

from accounts import AS_OF, KEYS, features, frame
from bureauframe.operators import aggregate
from bureauframe.operators.aggregate import feature_frame, gather
from bureauframe.plans.catalogue import ACCOUNT_GROUPS, ENQUIRY_GROUPS, GROUPS
from bureauframe.plans.features import ACCOUNT, FeatureGroup, count, distinct
from bureauframe.plans.rows import account_rows
from bureauframe.sources.schemas import TRADELINE, history_columns


def test_catalogue_size_and_unique_names():
    names = [n.lower() for g in ACCOUNT_GROUPS + ENQUIRY_GROUPS for n in g.outputs]
    assert len(names) == len(set(names)) == 377
    assert sum(len(g.outputs) for g in ACCOUNT_GROUPS) == 354


def test_future_account_is_invisible_except_in_loan_amounts(spark):
    future = {"open_dt": "01/02/2024", "orig_loan_am": 900000.0}
    row = features(spark, {}, future)["C1"]
    assert row.tot_tradelines == 1
    assert row.BureauActiveTradelines == 1
    assert row.highest_credit_any_5_years == 100000.0
    assert row.max_loanamount == 900000.0  # this group never looks at the opening date
    assert row.flag_has_large_pl == 1
    strict = features(spark, {}, future, strict=True)["C1"]
    assert strict.max_loanamount == 100000.0


def test_strict_mode_hides_slots_after_the_as_of_date(spark):
    late = {"balance_dt": "30/04/2024", "days_past_due": 200.0, "days_past_due_04": 5.0}
    assert features(spark, late)["C1"].max_dpd == 200.0
    strict = features(spark, late, strict=True)["C1"]
    assert (strict.max_dpd, strict.max_dpd_in_12_months) == (5.0, 5.0)


def test_sentinels_and_unknown_codes(spark):
    row = features(
        spark,
        {"orig_loan_am": -1.0, "days_past_due": -1.0, "actual_payment_am": -1.0},
        {"acct_type_cd": None, "orig_loan_am": 5.0},
    )["C1"]
    assert row.max_loanamount == 5.0
    assert row.max_dpd is None
    assert row.payments_3_month is None
    assert row.no_of_dpd_in_12_months is None
    # A NULL code is neither secured nor unsecured, nor a product.
    assert row.countoftradelines_unsecured == 1
    assert row.max_loanamount_sl == row.max_loanamount_usl == 0.0
    assert row.count_products_ever == 1


def test_padded_codes_and_amounts_as_text(spark):
    fields = [f"{f.name} string" if f.name in ("orig_loan_am", "emi", "balance_am") else
              f"{f.name} {f.dataType.simpleString()}" for f in TRADELINE.fields]
    schema = spark.createDataFrame([], ", ".join(fields)).schema
    rows = [
        {"acct_type_cd": " 58 ", "orig_loan_am": "2500000", "emi": "12.5", "balance_am": "2500000"},
        {"acct_type_cd": "5", "orig_loan_am": "n/a", "emi": "x", "balance_am": "7"},
    ]
    row = features(spark, *rows, schema=schema)["C1"]
    assert row.flag_high_value_hl == 1
    assert row.obligations == 12.5
    assert row.currentbalancedue == 2500007.0


def test_lender_spellings(spark):
    row = features(spark, {"m_sub_id": " pvt "}, {"m_sub_id": "PVT"}, {"m_sub_id": None})["C1"]
    assert row.count_accounts_Pvt_bank == 2


def test_report_beyond_history_and_no_report(spark):
    old = {"balance_dt": "01/01/2020", "days_past_due": 90.0, "balance_am": 10.0}
    none = {"customer_scrub_key": "C2", "balance_dt": None, "days_past_due": 90.0, "balance_am": 9.0}
    rows = features(spark, old, none)
    assert rows["C1"].max_dpd_in_3_years is None
    assert rows["C1"].months_since_last_dpd30 == 49.0
    assert rows["C1"].currentbalancedue == 10.0
    assert rows["C2"].months_since_last_dpd30 is None
    assert rows["C2"].past_due_freq_last_12m is None
    assert rows["C2"].currentbalancedue == 0.0


def test_two_month_offsets_differ_between_whole_months(spark):
    """A report 13.5 months before the as-of date: payments count it as 14 months back, obligations
    as 13, so month 24 is slot 10 of one and slot 11 of the other."""
    old = {"balance_dt": "16/12/2022", "open_dt": "01/01/2020", "emi": 10.0}
    assert features(spark, {**old, "balance_am_11": 1e5})["C1"].obligations_24m == 10.0
    assert features(spark, {**old, "balance_am_10": 1e5})["C1"].obligations_24m == 0.0
    near = {"balance_dt": "16/12/2023", "actual_payment_am": 50.0}  # 1.5 months: 2 and 1
    row = features(spark, {**near, "actual_payment_am_10": 70.0})["C1"]
    assert (row.payments_3_month, row.payments_12_month) == (50.0, 50.0)
    assert row.Max_obligations_paid_last12months == 70.0


def test_every_product_counts_once(spark):
    codes = ["123", "123", " 123", "999", "X1", "x1", None]
    row = features(spark, *({"acct_type_cd": c} for c in codes))["C1"]
    assert row.count_products_ever == 4


def test_windows_grow(spark):
    months = {name: float(i % 5) for i, name in enumerate(history_columns("actual_payment_am"))}
    row = features(spark, months, {**months, "balance_dt": "05/11/2023"})["C1"]
    assert row.payments_3_month <= row.payments_6_month <= row.payments_12_month
    assert (row.count_of_tradelines_opened_last_6m, row.count_of_tradelines_opened_last_12m) == (0, 2)


def test_gathering_does_not_change_results(spark):
    rows = [{"customer_scrub_key": f"C{i % 7}", "orig_loan_am": float(i)} for i in range(200)]
    rows += [{"customer_scrub_key": None}, {"customer_scrub_key": "hot"}] * 100
    df = account_rows(frame(spark, *rows), KEYS, KEYS[1])
    plain = feature_frame(df, KEYS, ACCOUNT_GROUPS[:4])
    moved = feature_frame(gather(df, KEYS), KEYS, ACCOUNT_GROUPS[:4])
    assert plain.exceptAll(moved).isEmpty() and moved.exceptAll(plain).isEmpty()
    assert plain.count() == 9


def test_a_hot_key_is_split_when_gathered(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        rows = spark.range(60_000).selectExpr("'hot' AS k", "id", "uuid() AS wide")
        tasks = gather(rows, ["k"]).selectExpr("spark_partition_id() AS p", "wide").groupBy("p")
        spread = len(tasks.agg({"wide": "max"}).collect())  # a count would prune the column
    finally:
        spark.conf.set(key, before)
    assert spread > 3


def test_partial_aggregation_comes_before_the_shuffle(spark):
    df = account_rows(frame(spark, {}), KEYS, KEYS[1])
    plan = feature_frame(df, KEYS, ACCOUNT_GROUPS)._jdf.queryExecution().executedPlan().toString()
    # The wide rows are shuffled once; values beyond the code book are counted by two narrow ones.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.index("partial_") > plan.index("Exchange hashpartitioning")


def test_distinct_values_beyond_the_listed_ones(spark):
    codes = ["123", "5", "5", " 123", "odd", "odd", "0123", "", None]
    rows = [{"customer_scrub_key": k, "acct_type_cd": c} for k in ("C1", None) for c in codes]
    for listed in ((), ("5", "123"), ("5",)):
        group = FeatureGroup("mine", ACCOUNT, (distinct("n", "acct", listed=listed),))
        got = features(spark, *rows, groups=[group])
        assert {k: r.n for k, r in got.items()} == {"C1": 5, None: 5}


def test_own_group(spark):
    group = FeatureGroup("mine", ACCOUNT, (count("n_big", "amt > 50000"),))
    assert features(spark, {}, {"orig_loan_am": 1.0}, groups=[group])["C1"].n_big == 1


def test_group_reads_only_its_columns(spark, tmp_path):
    frame(spark, {}).write.parquet(str(tmp_path / "t"))
    df = account_rows(spark.read.parquet(str(tmp_path / "t")), KEYS, KEYS[1])
    features = feature_frame(df, KEYS, [GROUPS["grp04_bureau_vintage"]])
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "balance_am" not in plan and "days_past_due" not in plan


def test_month_end_rule(spark):
    row = features(spark, {"open_dt": "28/02/2023"})["C1"]  # both month ends: whole months
    assert row.bureaage_months == 11.0
    assert AS_OF == dt.date(2024, 1, 31)


def test_learned_values_need_no_second_pass(spark, tmp_path, monkeypatch):
    """More values than a mask has bits, quotes, and a limit beyond which values are counted apart."""
    rows = [(f"c{i % 5}", f"v{i}'\\" if i % 4 else None, i % 3 == 0) for i in range(400)] + [(None, "v1", True)]
    spark.createDataFrame(rows, "k string, v string, good boolean").write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    group = FeatureGroup("mine", ACCOUNT, (distinct("n", "v"), distinct("m", "v", "good", ("v1", "zz"))))
    want = sorted(map(str, aggregate.feature_frame(frame, ["k"], [group]).collect()))
    values = aggregate.learned_values(frame, [group])
    assert len(values["n"]) == 301 and len(values["m"]) == 300
    once = aggregate.feature_frame(frame, ["k"], [group], values=values)
    assert sorted(map(str, once.collect())) == want
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    monkeypatch.setattr(aggregate, "MAX_VALUES", 301)
    assert list(aggregate.learned_values(frame, [group])) == ["n"]
    part = aggregate.feature_frame(frame, ["k"], [group], values=aggregate.learned_values(frame, [group]))
    assert sorted(map(str, part.collect())) == want
