"""DuckDB account and enquiry rows, written apart from the Spark expressions.

Windows are looked up slot by slot here, where the Spark side slices arrays.
"""

from __future__ import annotations

from bureauframe.sources import derived

SCRUB_DATES = derived.SCRUB_DATES

# Strptime spellings of the plain date formats, in order of precedence. A time of day
# or other text after the date is not read.
STRPTIME = ("%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y", "%Y/%m/%d", "%Y%m%d", "%m/%d/%Y")

# Product codes.
CC = "a IN ('5', '213', '214', '220', '224', '225')"
GL = "a IN ('191', '243')"
AL = "a IN ('47', '173', '172', '221', '222', '223', '246')"
HL = "a IN ('58', '195', '168', '240')"
SECURED_LIST = (
    "('47', '58', '168', '172', '173', '175', '181', '184', '185', '191', '195', '197', "
    "'198', '199', '200', '219', '221', '222', '223', '240', '241', '243', '246', '248')"
)
SEC = f"a IN {SECURED_LIST}"
USL = f"a NOT IN {SECURED_LIST}"
USL_NAMED = (
    "a IN ('123', '189', '187', '130', '242', '244', '245', '247', '167', '169', '170', '176', "
    "'177', '178', '179', '228', '227', '226', '249')"
)
SPL = "a IN ('184', '185', '175', '241', '248', '181', '197', '198', '199', '200')"
PL, STPL, CL = "a = '123'", "a = '242'", "a = '189'"


def day(text: str) -> str:
    lead = f"regexp_extract({text}, '^[ \\t]*([0-9]+[-/][0-9]+[-/][0-9]+|[0-9]+)', 1)"
    tries = ", ".join(f"try_strptime({lead}, '{f}')::DATE" for f in STRPTIME)
    return f"coalesce({tries})"


def months_between(a: str, b: str) -> str:
    whole = f"((year({a}) - year({b})) * 12 + month({a}) - month({b}))"
    same_day = f"day({a}) = day({b}) OR (last_day({a}) = {a} AND last_day({b}) = {b})"
    return (
        f"round(CASE WHEN {same_day} THEN {whole} "
        f"ELSE {whole} + (day({a}) - day({b})) / 31.0::DOUBLE END, 8)"
    )


def master(customer: str = "customer") -> str:
    return derived.master_sql(customer)


PARTIES = (
    "parties AS (SELECT customer_scrub_key, min(party_code) AS party_code "
    f"FROM ({derived.master_sql()}) GROUP BY customer_scrub_key)"
)

_ALIAS = {
    "days_past_due": "dpd",
    "balance_am": "bal",
    "past_due_am": "due",
    "credit_limit_am": "lim",
    "actual_payment_am": "pay",
}


def _accounts() -> str:
    """Accounts with histories as lists; -1 dropped where the family uses it as a sentinel."""
    items = [f"{sql} AS {name}" for name, sql in derived.ACCOUNT_COLUMNS.items()]
    for family, alias in _ALIAS.items():
        value = derived.history_value(family, "k")
        if alias in ("dpd", "pay"):
            value = f"CASE WHEN {value} >= 0 THEN {value} END"
        items.append(f"list_transform(range(0, 37), lambda k: {value}) AS {alias}")
    items.append(f"{derived.history_value('past_due_am', '0')} AS due_raw")
    items.append(f"{derived.history_value('balance_am', '0')} AS bal_raw")
    return f"SELECT {', '.join(items)} FROM {derived.accounts_from()}"


def _slots(arr: str, md: str, first: int, end: int) -> str:
    return (
        f"list_transform(range({first}, {end}), lambda k: "
        f"CASE WHEN k - {md} BETWEEN 0 AND 36 THEN {arr}[k - {md} + 1] END)"
    )


def _known(arr: str, md: str, end: int) -> str:
    return f"list_filter({_slots(arr, md, 0, end)}, lambda x: x IS NOT NULL)"


def _distance(hit: str) -> str:
    return (
        "list_min(list_transform(range(0, 37), lambda s: CASE WHEN "
        f"dpd[s + 1] {hit} AND mdd + s >= 0 THEN CAST(mdd + s AS DOUBLE) END))"
    )


def _in_window(w: int) -> str:
    return f"s + md >= 0 AND s + md <= {w - 1}"


def _share(w: int) -> str:
    inside = f"len(list_filter(range(0, 37), lambda s: {_in_window(w)}))"
    hits = f"len(list_filter(range(0, 37), lambda s: {_in_window(w)} AND due[s + 1] > 0))"
    return f"CASE WHEN {inside} > 0 THEN {hits} / {inside}::DOUBLE END"


def _card(w: int) -> str:
    return (
        f"list_transform(list_filter(range(0, 37), lambda s: {CC} AND {_in_window(w)}), lambda s: "
        "CASE WHEN lim[s + 1] > 0 THEN greatest(bal[s + 1], 0) / lim[s + 1] END)"
    )


def _owed(k: int) -> str:
    then = f"(ref_day - INTERVAL {k} MONTH)::DATE"
    slot = f"{k} + mdr"
    return (
        f"CASE WHEN CASE WHEN {slot} BETWEEN 0 AND 36 THEN bal[{slot} + 1] END >= 0.08 * amt "
        f"AND opened <= {then} AND (closed IS NULL OR closed > {then}) THEN emi_final ELSE 0.0 END"
    )


def account_rows(accounts: str = "SELECT *, scrub_output_date AS ref_day FROM acc") -> str:
    """CTEs `acc`, `typed`, `aged` and `r`; `accounts` selects from `acc` and adds `ref_day`."""
    typed = f"""SELECT *, {day('open_dt')} AS opened, {day('closed_dt')} AS closed,
      {day('balance_dt')} AS reported,
      coalesce({day('last_reporting_pymt_dt')}, {day('balance_dt')}) AS dpd_reported,
      {day('write_off_status_dt')} AS wo_on, {day('dflt_status_dt')} AS df_on,
      trim(acct_type_cd) AS a, upper(trim(m_sub_id)) AS l,
      trim(suit_filed_willful_dflt) AS su, trim(written_off_and_settled_status) AS st,
      CASE WHEN orig_loan_am > 0 THEN orig_loan_am END AS amt,
      nullif(greatest(total_write_off_am_4in::DOUBLE, 0), 0) AS wo_total,
      nullif(greatest(principal_write_off_am_4in::DOUBLE, 0), 0) AS wo_princ,
      nullif(greatest(settled_am_4in::DOUBLE, 0), 0) AS settled
      FROM ({accounts})"""
    aged = f"""SELECT *,
      CASE WHEN opened <= ref_day THEN {months_between('ref_day', 'opened')} END AS mso,
      coalesce(opened <= ref_day AND (closed IS NULL OR closed > ref_day), false) AS live,
      closed IS NULL OR closed > ref_day AS live0, closed <= ref_day AS dead0,
      {STPL} AND amt <= 30000 AS stplq,
      CAST(ceil({months_between('ref_day', 'reported')}) AS INTEGER) AS md,
      CAST(ceil({months_between('ref_day', 'dpd_reported')}) AS INTEGER) AS mdd,
      CAST(ceil({months_between('reported', 'ref_day')}) AS INTEGER) AS mdr,
      CASE WHEN wo_on <= ref_day THEN {months_between('ref_day', 'wo_on')} END AS since_wo,
      CASE WHEN df_on <= ref_day THEN {months_between('ref_day', 'df_on')} END AS since_suit,
      su IN ('201', '203', '205', '207', '01', '1', '03', '3') AS is_suit,
      su IN ('202', '203', '206', '207', '02', '2', '03', '3') AS is_wilful,
      su IN ('204', '205', '206', '207') OR st IN ('02', '05', '06', '08', '13') AS is_wo,
      su IN ('208', '209') OR st IN ('03', '04', '09', '15', '16') AS is_settled,
      su = '200' OR st IN ('00', '01', '10', '11', '12', '14') AS is_restr,
      su = '209' OR st = '04' AS is_post,
      CASE WHEN emi > 0 AND (amt IS NULL OR emi <= 0.9 * amt) THEN emi
           WHEN {PL} THEN 0.03 * amt WHEN {CC} THEN 0.05 * amt
           WHEN a IN ('58', '195') THEN 0.01 * amt WHEN a IN ('173', '189') THEN 0.05 * amt
           WHEN a = '47' THEN 0.025 * amt
           WHEN a IN ('177', '199') THEN CASE WHEN bal_raw >= 0 THEN 0.13 / 12 * bal_raw END
           ELSE 0.01 * amt END AS emi_final
      FROM typed"""
    now = "CASE WHEN mdr <= 0 THEN bal[1] WHEN mdr BETWEEN 1 AND 36 THEN bal[mdr + 1] END"
    more = [
        *(f"list_max({_slots('dpd', 'mdd', 0, w)}) AS d{w}" for w in (3, 6, 12, 36)),
        f"list_max({_slots('dpd', 'mdd', 3, 15)}) AS d3_15",
        "list_max(dpd) AS dever",
        "dpd[1] AS dnow",
        f"{_distance('>= 30')} AS far30",
        f"{_distance('> 15')} AS far15",
        f"{_distance('> 0')} AS far0",
        *(f"list_sum({_known('pay', 'md', w)}) AS p{w}" for w in (3, 6, 12)),
        *(f"nullif(len({_known('pay', 'md', w)}), 0) AS pn{w}" for w in (3, 6, 12)),
        *(f"{_known('pay', 'md', w)}[1] AS pl{w}" for w in (3, 6, 12)),
        *(f"list_max({_slots('pay', 'md', 0, w)}) AS pmax{w}" for w in (6, 12, 36)),
        *(f"list_min({_slots('pay', 'md', 0, w)}) AS pmin{w}" for w in (6, 12, 36)),
        *(f"{_share(w)} AS share{w}" for w in (3, 6, 12)),
        *(f"list_avg({_card(w)}) AS cavg{w}" for w in (3, 6, 12, 36)),
        *(f"list_max({_card(w)}) AS cmax{w}" for w in (3, 6, 12, 36)),
        "CASE WHEN due_raw >= 0 THEN due_raw END AS pdu",
        f"{now} AS bal_now",
        *(f"{_owed(k)} AS owed{k}" for k in (6, 12, 24)),
        f"list_max({_slots('pay', '(-mdr)', 0, 12)}) AS omax",
        f"{_known('pay', '(-mdr)', 12)}[1] AS olast",
    ]
    return (
        f"acc AS ({_accounts()}), typed AS ({typed}), aged AS ({aged}), "
        f"r AS (SELECT *, {', '.join(more)} FROM aged)"
    )


def enquiry_rows(enquiries: str) -> str:
    """CTEs `q` from a select that has `inq_date` text and `ref_day`."""
    return (
        f"e AS (SELECT *, {day('inq_date')} AS asked, upper(trim(m_sub_id)) AS l, "
        f"trim(inq_purp_cd) AS p FROM ({enquiries})), "
        f"q AS (SELECT *, {months_between('ref_day', 'asked')} AS mse FROM e WHERE asked <= ref_day)"
    )


def resolved() -> str:
    """CTE `resolved`: latest delivery in the twelve months after each reference."""
    ranked = (
        "SELECT f.party_code, f.reference_dt, m.scrub_output_date, m.customer_scrub_key, "
        "row_number() OVER (PARTITION BY f.party_code, f.reference_dt "
        "ORDER BY m.scrub_output_date DESC, m.customer_scrub_key) AS rn "
        f"FROM (SELECT DISTINCT party_code, reference_dt FROM ({derived.references_sql()})) f "
        f"JOIN ({derived.master_sql()}) m ON m.party_code = f.party_code "
        "AND m.scrub_output_date >= f.reference_dt "
        "AND m.scrub_output_date <= (f.reference_dt + INTERVAL 12 MONTH)::DATE"
    )
    return (
        "resolved AS (SELECT party_code, reference_dt, scrub_output_date, customer_scrub_key "
        f"FROM ({ranked}) WHERE rn = 1)"
    )


RETRO_ACCOUNTS = (
    "SELECT acc.*, z.party_code, z.reference_dt, z.reference_dt AS ref_day FROM acc "
    "JOIN resolved z ON z.customer_scrub_key = acc.customer_scrub_key "
    "AND z.scrub_output_date = acc.scrub_output_date"
)

SCRUB_ENQUIRIES = " UNION ALL ".join(
    f"SELECT x.*, DATE '{d}' AS ref_day FROM ({derived.enquiry_sql()}) x "
    f"WHERE {day('x.inq_date')} <= DATE '{d}' AND x.customer_scrub_key IN "
    f"(SELECT 'C' || CAST(o_custkey AS VARCHAR) || '_{d}' FROM orders)"
    for d in SCRUB_DATES
)

RETRO_ENQUIRIES = (
    "SELECT x.*, z.party_code, z.reference_dt, z.reference_dt AS ref_day "
    f"FROM ({derived.enquiry_sql()}) x "
    f"JOIN (SELECT DISTINCT customer_scrub_key, party_code FROM ({derived.master_sql()})) m "
    "ON m.customer_scrub_key = x.customer_scrub_key "
    "JOIN resolved z ON z.party_code = m.party_code"
)
