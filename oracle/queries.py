"""Complete DuckDB statements for every query in `__spark_entry__.py`."""

from __future__ import annotations

from bureauframe.sources import derived
from oracle import rows
from oracle.companions import COMPANIONS
from oracle.groups import ACCOUNT_GROUPS, ENQUIRY_GROUPS, real
from oracle.rows import CC

LATER = derived.SCRUB_DATES[1]


def _items(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _merged(groups) -> tuple[dict[str, str], dict[str, str]]:
    aggregates: dict[str, str] = {}
    post: dict[str, str] = {}
    for group in groups:
        a, d = group()
        aggregates |= a
        post |= d
    return aggregates, post


def _grouped(ctes: str, source: str, keys: str, groups, party: bool) -> str:
    aggregates, post = _merged(groups)
    outputs = ", ".join(["g." + name for name in aggregates] + [f"{s} AS {n}" for n, s in post.items()])
    lead, join = ", ".join("g." + k for k in keys.split(", ")), ""
    if party:
        lead += ", parties.party_code"
        join = " LEFT JOIN parties ON parties.customer_scrub_key = g.customer_scrub_key"
        ctes = f"{rows.PARTIES}, {ctes}"
    return (
        f"WITH {ctes}, g AS (SELECT {keys}, {_items(aggregates)} FROM {source} GROUP BY {keys}) "
        f"SELECT {lead}, {outputs} FROM g{join}"
    )


def scrub_accounts(*groups) -> str:
    keys = "customer_scrub_key, scrub_output_date"
    return _grouped(rows.account_rows(), "r", keys, groups, party=True)


def scrub_enquiries() -> str:
    ctes = rows.enquiry_rows(
        f"SELECT *, ref_day AS scrub_output_date FROM ({rows.SCRUB_ENQUIRIES})"
    )
    keys = "customer_scrub_key, scrub_output_date"
    return _grouped(ctes, "q", keys, ENQUIRY_GROUPS.values(), party=True)


def retro_accounts(*groups) -> str:
    ctes = f"{rows.resolved()}, {rows.account_rows(rows.RETRO_ACCOUNTS)}"
    return _grouped(ctes, "r", "party_code, reference_dt", groups, party=False)


def retro_enquiries(once: bool = False) -> str:
    """With `once` an event counts once for a reference, however many keys it came with."""
    source = rows.RETRO_ENQUIRIES
    if once:
        source = f"SELECT DISTINCT * EXCLUDE (customer_scrub_key) FROM ({source})"
    ctes = f"{rows.resolved()}, {rows.enquiry_rows(source)}"
    return _grouped(ctes, "q", "party_code, reference_dt", ENQUIRY_GROUPS.values(), party=False)


def per_account(columns: dict[str, str]) -> str:
    keys = "customer_scrub_key, scrub_output_date, acct_id"
    return f"WITH {rows.account_rows()} SELECT {keys}, {_items(columns)} FROM r"


def _date_texts() -> str:
    """Order dates written in each accepted format by remainder, the last one being no date. Texts
    of which a day and a month read either way are told apart by the order of formats."""
    y, m, d = (f"CAST({part}(o_orderdate) AS STRING)" for part in ("year", "month", "day"))
    short_m, short_d = m, d
    m, d = f"lpad({m}, 2, '0')", f"lpad({d}, 2, '0')"
    texts = [
        f"{d} || '/' || {m} || '/' || {y}",
        f"{y} || '-' || {m} || '-' || {d}",
        f"{d} || '-' || {m} || '-' || {y}",
        f"{y} || '/' || {m} || '/' || {d}",
        f"{y} || {m} || {d}",
        f"{y} || '-' || {m} || '-' || {d} || 'T01:02:03.004+00:00'",
        f"{y} || '-' || {m} || '-' || {d} || 'T01:02:03.004Z'",
        f"{y} || '-' || {m} || '-' || {d} || 'T01:02:03.004'",
        f"{y} || '-' || {m} || '-' || {d} || 'T01:02:03'",
        f"{y} || '-' || {m} || '-' || {d} || ' 01:02:03'",
        f"{m} || '/' || {d} || '/' || {y}",
        f"{short_d} || '/' || {short_m} || '/' || {y}",
        f"{short_d} || '-' || {short_m} || '-' || {y} || ' x'",
        f"{y} || '/' || {short_m} || '/' || {short_d}",
        f"' ' || {y} || '-' || {m} || '-' || {d}",
        f"{y} || '-' || {m} || '-' || {d} || 'T22:00:00.000-05:00'",
        f"{y} || '-' || {m} || '-' || {d} || 'T02:00:00+05:30'",
        f"{y} || '-' || {m} || '-' || {d} || ' 01:02:03.5'",
        f"{d} || '/' || {m} || '/' || {y} || ' 10:00'",
        f"{y} || '-' || {m} || '-' || {d} || 'x'",
    ]
    branches = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(texts))
    return f"CASE o_orderkey % {len(texts) + 1} {branches} ELSE 'no date' END"


def date_text_sql(orders: str = "orders") -> str:
    return f"SELECT o_orderkey, {_date_texts()} AS text FROM {orders}"


_CARD_FLAGS = {
    "pl": rows.PL,
    "stpl_small": f"{rows.STPL} AND orig_loan_am > 0 AND orig_loan_am <= 30000",
    "cc": CC,
    "gl": rows.GL,
    "al": rows.AL,
    "hl": rows.HL,
    "secured": rows.SEC,
    "usl": rows.USL,
    "nbfc": "l = 'NBF'",
    "pvt": "l = 'PVT'",
    "bank": "l IN ('PVT', 'PUB', 'FOR', 'RRB', 'SFB', 'COB')",
}

ROW_QUERIES = {
    "account_age": {
        "amt": real("amt"),
        "mso": real("mso"),
        "live": "live",
        "live_any": "live0",
        "dead_any": "coalesce(dead0, false)",
    },
    "product_classes": _CARD_FLAGS,
    "slot_resolution": {
        **{f"dpd_max{w}": real(f"d{w}") for w in (3, 6, 12, 36)},
        "dpd_max3_15": real("d3_15"),
        **{f"paid{w}": real(f"p{w}") for w in (3, 6, 12)},
        **{f"paid_n{w}": f"CAST(pn{w} AS INTEGER)" for w in (3, 6, 12)},
        **{f"paid_last{w}": real(f"pl{w}") for w in (3, 6, 12)},
        **{f"paid_max{w}": real(f"pmax{w}") for w in (6, 12, 36)},
        **{f"paid_min{w}": real(f"pmin{w}") for w in (6, 12, 36)},
    },
    "balance_asof": {
        "outstanding": real("CASE WHEN bal_now > 0 THEN bal_now ELSE 0 END"),
        "repaid": real("1 - bal_now / amt"),
    },
    "past_due_frequency": {f"due_share{w}": real(f"share{w}") for w in (3, 6, 12)},
    "card_utilization": {
        **{f"card_mean{w}": real(f"cavg{w}") for w in (3, 6, 12, 36)},
        **{f"card_max{w}": real(f"cmax{w}") for w in (3, 6, 12, 36)},
    },
    "dpd_distance": {
        "since_dpd30": real("far30"),
        "since_dpd15": real("far15"),
        "since_dpd0": real("far0"),
        "dpd_ever": real("dever"),
    },
    "emi": {
        "emi": real("emi_final"),
        "owes": "coalesce(bal_now >= 0.08 * amt AND live, false)",
        **{f"emi_{k}m": real(f"owed{k}") for k in (6, 12, 24)},
        "emi_paid_max12": real("omax"),
        "emi_paid_last12": real("olast"),
    },
    "status_tiers": {
        "is_suit": "is_suit",
        "is_wilful": "is_wilful",
        "is_wo": "is_wo",
        "is_settled": "is_settled",
        "is_restructured": "is_restr",
        "is_post_wo_settled": "is_post",
        "since_wo": real("since_wo"),
        "since_suit": real("since_suit"),
    },
}

_N = (
    "SELECT 'C' || CAST(o_custkey AS VARCHAR) || '_' || CAST(sd AS VARCHAR) AS customer_scrub_key, "
    "sd AS scrub_output_date, count(*) AS n, "
    "CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS closed "
    f"FROM orders CROSS JOIN {derived._SCRUBS} GROUP BY ALL"
)


def _masked() -> str:
    wide = scrub_accounts(*ACCOUNT_GROUPS.values())
    masked = ", ".join(
        f"CASE WHEN {c} <> 0 THEN {f} END AS {f}" for f, c in sorted(COMPANIONS.items())
    )
    return f"SELECT customer_scrub_key, scrub_output_date, {masked} FROM ({wide})"


def _own_group():
    return {
        "open_cards": f"count(*) FILTER (WHERE live AND {CC})",
        "products": "count(DISTINCT a)",
    }, {}


def _long(sql: str, groups) -> str:
    """Every feature as text, as Spark writes it: doubles with a point or an exponent."""
    aggregates, post = _merged(groups)
    names = [*aggregates, *post]
    items = ", ".join(f"struct_pack(f := '{x}', v := CAST({x} AS VARCHAR)) " for x in names)
    return (
        "SELECT customer_scrub_key, party_code, scrub_output_date, u.f AS feature, u.v AS value "
        f"FROM (SELECT *, unnest([{items}]) AS u FROM ({sql}) WHERE "
        f"scrub_output_date = DATE '{LATER}' AND customer_scrub_key = ({_FIRST}))"
    )


_FIRST = (
    f"SELECT min(customer_scrub_key) FROM ({rows.SCRUB_ENQUIRIES}) "
    f"WHERE ref_day = DATE '{LATER}'"
)


def _listing() -> str:
    return (
        f"{_long(scrub_accounts(*ACCOUNT_GROUPS.values()), ACCOUNT_GROUPS.values())} UNION ALL "
        f"{_long(scrub_enquiries(), ENQUIRY_GROUPS.values())}"
    )


def statements() -> dict[str, str]:
    tradeline, enquiry = derived.tradeline_sql(), derived.enquiry_sql()
    master, references = derived.master_sql(), derived.references_sql()
    behaviour = ACCOUNT_GROUPS["grp06b_credit_behaviour_flags"]
    names = list(behaviour()[0])
    out = {
        "parse_dates": f"SELECT o_orderkey, {rows.day('text')} AS parsed FROM ({date_text_sql()})",
        "party_map": f"WITH {rows.PARTIES} SELECT customer_scrub_key, party_code FROM parties",
        "scrub_tradeline": f"WITH {rows.PARTIES} SELECT t.*, p.party_code FROM ({tradeline}) t "
        "LEFT JOIN parties p ON p.customer_scrub_key = t.customer_scrub_key "
        f"WHERE scrub_output_date = DATE '{LATER}'",
        "scrub_enquiry": f"SELECT * EXCLUDE (ref_day), ref_day AS scrub_output_date "
        f"FROM ({rows.SCRUB_ENQUIRIES}) WHERE ref_day = DATE '{LATER}'",
        "reference_keys": f"SELECT DISTINCT party_code, reference_dt FROM ({references})",
        "asof_snapshot": f"WITH {rows.resolved()} SELECT * FROM resolved",
        "unmatched_references": f"WITH {rows.resolved()} SELECT DISTINCT party_code, reference_dt "
        f"FROM ({references}) f WHERE NOT EXISTS (SELECT 1 FROM resolved z "
        "WHERE z.party_code = f.party_code AND z.reference_dt = f.reference_dt)",
        "retro_tradeline": f"WITH {rows.resolved()} SELECT z.party_code, z.reference_dt, t.* "
        f"FROM ({tradeline}) t JOIN resolved z ON z.customer_scrub_key = t.customer_scrub_key "
        "AND z.scrub_output_date = t.scrub_output_date",
        "retro_enquiry": f"WITH {rows.resolved()} SELECT * EXCLUDE (ref_day) "
        f"FROM ({rows.RETRO_ENQUIRIES}) WHERE {rows.day('inq_date')} <= ref_day",
        "wide_tradeline": scrub_accounts(*ACCOUNT_GROUPS.values()),
        "wide_enquiry": scrub_enquiries(),
        "scrub_run_enquiry": scrub_enquiries(),
        "own_group_run": scrub_accounts(_own_group),
        "retro_run_tradeline": retro_accounts(*ACCOUNT_GROUPS.values()),
        "retro_run_unmatched": f"WITH {rows.resolved()} SELECT DISTINCT party_code, reference_dt "
        f"FROM ({references}) f WHERE NOT EXISTS (SELECT 1 FROM resolved z "
        "WHERE z.party_code = f.party_code AND z.reference_dt = f.reference_dt)",
        "catalog_append": "SELECT customer_scrub_key, scrub_output_date, n, "
        f"CASE WHEN scrub_output_date = DATE '{LATER}' THEN closed END AS closed FROM ({_N})",
        "merge_layout": "SELECT customer_scrub_key, scrub_output_date, "
        f"CASE WHEN closed > 2 THEN -n ELSE n END AS n, closed FROM ({_N})",
        "rows_per_sink_date": f"SELECT scrub_output_date, count(*) AS n FROM ({_N}) GROUP BY 1",
        "customer_listing": _listing(),
        "wide_retro": retro_accounts(*ACCOUNT_GROUPS.values()),
        "wide_retro_enquiry": retro_enquiries(),
        "scrub_run": scrub_accounts(*ACCOUNT_GROUPS.values()),
        "retro_run": retro_enquiries(),
        "group_assembly": scrub_accounts(
            ACCOUNT_GROUPS["grp01_portfolio_counts"],
            ACCOUNT_GROUPS["grp04_bureau_vintage"],
            ACCOUNT_GROUPS["grp07_delinquency"],
        ),
        "companion_mask": _masked(),
        "pk_check": "SELECT customer_scrub_key, count(*) AS n "
        f"FROM ({master}) GROUP BY 1 HAVING count(*) > 1",
        "rows_per_scrub": f"SELECT scrub_output_date, count(*) AS n FROM ({tradeline}) GROUP BY 1",
        "feature_listing": "SELECT customer_scrub_key, party_code, scrub_output_date, feature, "
        f"CAST(value AS VARCHAR) AS value FROM ({scrub_accounts(behaviour)}) "
        f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(names)}))",
        "pending_dates": f"SELECT DISTINCT sd AS scrub_output_date FROM orders CROSS JOIN "
        f"{derived._SCRUBS} WHERE sd > DATE '{derived.SCRUB_DATES[0]}'",
        "wide_retro_enquiry_dedup": retro_enquiries(once=True),
        "redelivery_run": scrub_accounts(ACCOUNT_GROUPS["grp04_bureau_vintage"]),
        "delivery_ledger": "SELECT 'accounts' AS sink, scrub_output_date, count(*) AS n "
        f"FROM ({_N}) GROUP BY ALL UNION ALL SELECT 'enquiries', ref_day, "
        f"count(DISTINCT customer_scrub_key) FROM ({rows.SCRUB_ENQUIRIES}) GROUP BY ALL",
        "retro_run_colocated": retro_accounts(ACCOUNT_GROUPS["grp07_delinquency"]),
        "merge_by_file": "SELECT customer_scrub_key, scrub_output_date, CASE WHEN closed > 2 AND "
        f"scrub_output_date = DATE '{LATER}' THEN -n ELSE n END AS n, closed FROM ({_N})",
        "partition_overwrite": "SELECT customer_scrub_key, scrub_output_date, "
        f"CASE WHEN scrub_output_date = DATE '{LATER}' THEN closed ELSE n END AS n FROM ({_N})",
        "full_overwrite": f"SELECT customer_scrub_key, scrub_output_date, closed FROM ({_N})",
        "merge_upsert": "SELECT customer_scrub_key, scrub_output_date, "
        f"CASE WHEN closed > 2 THEN -n ELSE n END AS n, closed FROM ({_N})",
        "frame_helpers": "SELECT o_custkey, CAST(count(*) AS BIGINT) AS o_n, "
        "coalesce(max(c_nationkey), -1) AS c_c_nationkey, "
        "round(sum(o_totalprice) / nullif(max(c_acctbal), 0), 2) + 0.0 AS share "
        "FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey",
    }
    out |= {name: scrub_accounts(group) for name, group in ACCOUNT_GROUPS.items()}
    out["grp12_enquiries"] = (
        f"SELECT * FROM ({scrub_enquiries()}) WHERE scrub_output_date = DATE '{LATER}'"
    )
    out |= {name: per_account(columns) for name, columns in ROW_QUERIES.items()}
    return out
