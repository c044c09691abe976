"""Bureau tables derived from the star-schema test tables.

The same SQL text runs on Spark and on DuckDB, so a query and its check start from equal rows.
Every expression is integer arithmetic or floor, and amounts are whole numbers, so both engines
agree cell by cell. All work is projection over `orders`, `events` and `customer`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from bureauframe.operators.aggregate import gather
from bureauframe.sources.schemas import HISTORY_FAMILIES, HISTORY_MONTHS

SCRUB_DATES = ("2023-07-31", "2024-01-31")

_SCRUBS = "(" + " UNION ALL ".join(f"SELECT DATE '{d}' AS sd" for d in SCRUB_DATES) + ") s"


def _lookup(codes: list[str], alias: str) -> str:
    rows = ", ".join(f"({i}, '{code}')" for i, code in enumerate(codes))
    return f"(VALUES {rows}) AS {alias}(i, code)"


_PRODUCTS = _lookup(
    ["123", "242", "5", "191", "195", "47", "189", "184",
     "167", "245", "220", "58", "243", "173", "999", "177", "219", "PL9"],
    "p",
)
_LENDERS = _lookup(["NBF", "PVT", "PUB", "MFI", "HFC", "SFB", "FOR", " pvt "], "l")


def _pad(part: str, date: str) -> str:
    return f"lpad(CAST({part}({date}) AS STRING), 2, '0')"


def iso(date: str) -> str:
    year = f"CAST(year({date}) AS STRING)"
    return f"({year} || '-' || {_pad('month', date)} || '-' || {_pad('day', date)})"


def dmy(date: str) -> str:
    year = f"CAST(year({date}) AS STRING)"
    return f"({_pad('day', date)} || '/' || {_pad('month', date)} || '/' || {year})"


def _key(number: str) -> str:
    return f"'C' || CAST({number} AS STRING) || '_' || {iso('sd')}"


def history_value(family: str, k: str) -> str:
    """Slot `k` of a history family (0 = current month) for account `ok` with amount `amt`."""
    rule = {
        "days_past_due": f"CASE WHEN (ok*7+{k}*13)%11=0 THEN -1 "
        f"WHEN (ok+{k})%6=0 THEN (ok*3+{k}*29)%200 ELSE 0 END",
        "balance_am": f"CASE WHEN (ok*5+{k})%13=0 THEN -1 ELSE floor(amt*((ok+{k})%21)/20) END",
        "past_due_am": f"CASE WHEN (ok+{k}*3)%7=0 THEN (ok+{k}*17)%5000 "
        f"WHEN (ok+{k})%9=0 THEN -1 ELSE 0 END",
        "credit_limit_am": f"CASE WHEN (ok+{k})%10=0 THEN -1 ELSE amt END",
        "actual_payment_am": f"CASE WHEN (ok*11+{k}*7)%9=0 THEN -1 "
        f"WHEN (ok+{k})%5=0 THEN 0 ELSE (ok*13+{k}*31)%9000 END",
    }[family]
    return f"CAST({rule} AS DOUBLE)"


def _day(base: str, days: str, sign: str = "+") -> str:
    return f"({base} {sign} CAST({days} AS INT))"


ACCOUNT_COLUMNS = {
    "customer_scrub_key": _key("ck"),
    "scrub_output_date": "sd",
    "acct_id": "ok",
    "acct_type_cd": "p.code",
    "m_sub_id": "l.code",
    "open_dt": f"CASE WHEN ok%3=0 THEN {iso('od')} ELSE {dmy('od')} END",
    "closed_dt": f"CASE WHEN st='F' THEN {dmy(_day('od', '200+ok%900'))} "
    "WHEN ok%50=0 THEN 'garbage' END",
    "balance_dt": dmy(_day("sd", "20-ok%140")),
    "last_reporting_pymt_dt": f"CASE WHEN ok%8<>0 THEN {dmy(_day('sd', '10-ok%100'))} END",
    "orig_loan_am": "CASE WHEN ok%17=0 THEN CAST(-1.0 AS DOUBLE) "
    "ELSE CAST(CASE WHEN ok%4=0 THEN floor(amt/20) ELSE amt END AS DOUBLE) END",
    "emi": "CASE WHEN ok%3=0 THEN NULL ELSE CAST(floor(amt*(ok%25)/20) AS DOUBLE) END",
    "suit_filed_willful_dflt": "CASE WHEN ok%29=0 THEN CAST(200+ok%10 AS STRING) "
    "WHEN ok%31=0 THEN '0' || CAST(ok%4 AS STRING) END",
    "written_off_and_settled_status": "CASE WHEN ok%23=0 "
    "THEN lpad(CAST(ok%18 AS STRING), 2, '0') END",
    "write_off_status_dt": f"CASE WHEN ok%23=0 OR ok%29=0 THEN {dmy(_day('od', '100+ok%800'))} END",
    "dflt_status_dt": f"CASE WHEN ok%29=0 OR ok%31=0 THEN {dmy(_day('od', '90+ok%700'))} END",
    "total_write_off_am_4in": "CASE WHEN ok%2=0 THEN '-1' "
    "ELSE CAST(CAST(amt AS BIGINT) AS STRING) END",
    "principal_write_off_am_4in": "CAST(CAST(floor(amt/2) AS BIGINT) AS STRING)",
    "settled_am_4in": "CASE WHEN ok%5=0 THEN '-1' "
    "ELSE CAST(CAST(floor(amt*(ok%12)/10) AS BIGINT) AS STRING) END",
}


def accounts_from(orders: str = "orders") -> str:
    """FROM clause shared by both engines: orders crossed with the two scrub dates."""
    base = (
        "SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS st, "
        "floor(o_totalprice) AS amt, CAST(o_orderdate AS DATE) + 8200 AS od, sd "
        f"FROM {orders} CROSS JOIN {_SCRUBS}"
    )
    return (
        f"({base}) b JOIN {_PRODUCTS} ON (ok+ck)%18 = p.i "
        f"JOIN {_LENDERS} ON CAST(amt AS BIGINT)%8 = l.i"
    )


def history_select(family: str) -> list[str]:
    """One select item per monthly column of a family."""
    return [
        f"{history_value(family, str(k))} AS {family}" + (f"_{k:02d}" if k else "")
        for k in range(HISTORY_MONTHS + 1)
    ]


def tradeline_sql(orders: str = "orders") -> str:
    items = [f"{expr} AS {name}" for name, expr in ACCOUNT_COLUMNS.items()]
    for family in HISTORY_FAMILIES:
        items += history_select(family)
    return f"SELECT {', '.join(items)} FROM {accounts_from(orders)}"


def enquiry_sql(events: str = "events") -> str:
    purpose = (
        "CASE event_type WHEN 'click' THEN '13' WHEN 'view' THEN '7' "
        "WHEN 'purchase' THEN '14' WHEN 'signup' THEN '11' ELSE '99' END"
    )
    asked = iso("(CAST(ts AS DATE) - CAST(event_id%900 AS INT))")
    return (
        f"SELECT {_key('user_id')} AS customer_scrub_key, event_id, {purpose} AS inq_purp_cd, "
        f"l.code AS m_sub_id, {asked} AS inq_date, CAST(floor(value*1000) AS DOUBLE) AS amount "
        f"FROM {events} JOIN {_LENDERS} ON event_id%8 = l.i CROSS JOIN {_SCRUBS}"
    )


def master_sql(customer: str = "customer") -> str:
    def arm(party: str, where: str = "") -> str:
        return (
            f"SELECT {_key('c_custkey')} AS customer_scrub_key, {party} AS party_code, "
            f"sd AS scrub_output_date FROM {customer} CROSS JOIN {_SCRUBS} {where}"
        )

    shared = arm("'P' || CAST(c_custkey%1400 AS STRING)")
    second = arm("'Q' || CAST(c_custkey AS STRING)", "WHERE c_custkey%40=0")
    return f"{shared} UNION ALL {second}"


def references_sql(customer: str = "customer") -> str:
    return (
        "SELECT 'P' || CAST(c_custkey%1400 AS STRING) AS party_code, "
        f"DATE '2023-01-01' + CAST((c_custkey*37)%420 AS INT) AS reference_dt FROM {customer}"
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def tradeline(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """Accounts; `gathered` brings the orders of a customer together while they are narrow, so that
    what is aggregated by customer combines in the task that made it."""
    orders = _orders(spark, sf_dir)
    return spark.sql(tradeline_sql("{t}"), t=gather(orders, ["o_custkey"]) if gathered else orders)


def narrow_tradeline(
    spark: SparkSession, sf_dir: str, scrub_dates: Sequence[str] = SCRUB_DATES
) -> DataFrame:
    """What the accounts of these deliveries are computed from, with their keys: a few columns, for
    joins and exchanges by customer. `widened` makes the accounts of it."""
    days = ", ".join(f"DATE '{d}'" for d in scrub_dates)
    key = f"{ACCOUNT_COLUMNS['customer_scrub_key']} AS customer_scrub_key"
    items = f"b.*, struct(p.code) AS p, struct(l.code) AS l, {key}"
    text = f"SELECT {items} FROM {accounts_from('{t}')} WHERE sd IN ({days})"
    return spark.sql(text, t=_orders(spark, sf_dir))


def widened(narrow: DataFrame, *more: str) -> DataFrame:
    """The accounts of `narrow_tradeline`, and its columns `more`."""
    names = {c: e for c, e in ACCOUNT_COLUMNS.items() if c != "customer_scrub_key"}
    items = [f"{expr} AS {name}" for name, expr in names.items()]
    histories = [item for family in HISTORY_FAMILIES for item in history_select(family)]
    return narrow.selectExpr("customer_scrub_key", *items, *histories, *more)


def enquiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(enquiry_sql("{t}"), t=_table(spark, sf_dir, "events"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(master_sql("{t}"), t=_table(spark, sf_dir, "customer"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(references_sql("{t}"), t=_table(spark, sf_dir, "customer"))
