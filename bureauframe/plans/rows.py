"""Row expressions: one narrow row per account or enquiry, computed once for all features.

Every date is parsed once, every flag evaluated once and every history window reduced to a scalar
here. Nothing in this module shuffles. Columns a caller does not aggregate are pruned by Catalyst,
down to the parquet scan, so one group alone reads only its own inputs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from bureauframe.functions import amounts, codes
from bureauframe.functions import history as h
from bureauframe.functions.dates import date_sql, months_ceil, months_since

AS_OF = "as_of"

# The ticket size up to which a short-term personal loan counts as one, and the
# days past due that mark the three recency features.
SHORT_TERM_MAX = 30000
DISTANCES = {"dpd30": ">= 30", "dpd15": "> 15", "dpd0": "> 0"}

_HISTORIES = {
    "dpd": ("days_past_due", True),
    "pay": ("actual_payment_am", True),
    "bal": ("balance_am", False),
    "due": ("past_due_am", False),
}


def account_rows(
    tradeline: DataFrame, keys: Sequence[str], as_of: str, strict: bool = False
) -> DataFrame:
    """Point-in-time account row.

    `strict` also hides what the default reads past the as-of date: accounts opened later in the
    loan-amount features, and history slots after the as-of date in the all-history features.
    """
    typed = _step(tradeline, keys, _cleaned(as_of))
    flagged = _step(typed, [c for c in typed.columns if c not in _ONLY_CLEANED], _flags(strict))
    kept = [c for c in flagged.columns if c not in _ONLY_FLAGGED]
    return _step(flagged, kept, _windows(strict))


def _items(columns: Mapping[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def _step(df: DataFrame, kept: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*kept, *_items(columns))


# Columns that end with the step that reads them.
_ONLY_CLEANED = ("lender", "suit", "settlement", "written_off_on", "defaulted_on")
_ONLY_FLAGGED = (
    AS_OF, "opened", "closed", "reported", "dpd_reported",
    "raw_emi", "raw_bal", "raw_due", "md", "md_dpd", "ahead",
    "card_use", *DISTANCES, *_HISTORIES,
)


def _cleaned(as_of: str) -> dict[str, str]:
    """Raw text to typed values."""
    typed = {
        AS_OF: f"CAST({as_of} AS DATE)",
        "opened": date_sql("open_dt"),
        "closed": date_sql("closed_dt"),
        "reported": date_sql("balance_dt"),
        "dpd_reported": f"coalesce({date_sql('last_reporting_pymt_dt')}, {date_sql('balance_dt')})",
        "written_off_on": date_sql("write_off_status_dt"),
        "defaulted_on": date_sql("dflt_status_dt"),
        "acct": codes.code("acct_type_cd"),
        "lender": codes.lender(),
        "suit": codes.code("suit_filed_willful_dflt"),
        "settlement": codes.code("written_off_and_settled_status"),
        "raw_amt": h.number("orig_loan_am"),
        "raw_emi": h.number("emi"),
        "raw_bal": h.number("balance_am"),
        "raw_due": h.number("past_due_am"),
        "wo_total": h.positive(h.number("total_write_off_am_4in")),
        "wo_principal": h.positive(h.number("principal_write_off_am_4in")),
        "settled": h.positive(h.number("settled_am_4in")),
    }
    arrays = {name: h.history(family, drop) for name, (family, drop) in _HISTORIES.items()}
    marks = {name: h.hits("days_past_due", hit) for name, hit in DISTANCES.items()}
    used = h.ratios("balance_am", "credit_limit_am")
    is_card = codes.one_of(codes.code("acct_type_cd"), codes.CARD)
    return typed | arrays | marks | {"card_use": f"CASE WHEN {is_card} THEN {used} END"}


def _flags(strict: bool) -> dict[str, str]:
    """Flags, ages and month offsets."""
    amt = h.positive("raw_amt")
    product = codes.product_flags("acct")
    return {
        "amt": amt,
        # The loan-amount group uses a looser notion of an open account than the others: it
        # never looks at the opening date.
        "amt_any": f"CASE WHEN opened <= {AS_OF} THEN {amt} END" if strict else amt,
        "mso": months_since("opened", AS_OF),
        "live": f"coalesce({amounts.open_on('opened', 'closed', AS_OF)}, false)",
        "live_any": f"closed IS NULL OR closed > {AS_OF}",
        "dead_any": f"coalesce(closed <= {AS_OF}, false)",
        **product,
        "stpl_small": f"{product['stpl']} AND raw_amt > 0 AND raw_amt <= {SHORT_TERM_MAX}",
        **codes.lender_flags("lender"),
        **codes.status_flags("suit", "settlement"),
        "since_wo": months_since("written_off_on", AS_OF),
        "since_suit": months_since("defaulted_on", AS_OF),
        "md": months_ceil(AS_OF, "reported"),
        "md_dpd": months_ceil(AS_OF, "dpd_reported"),
        # Rounded up after the report instead of before it: at 1.5 months `md` is 2, this is -1.
        "ahead": months_ceil("reported", AS_OF),
    }


def _windows(strict: bool) -> dict[str, str]:
    return _dpd(strict) | _payments() | _past_due() | _card_use() | _balances()


def _dpd(strict: bool) -> dict[str, str]:
    out = {f"dpd_max{w}": h.window_max("dpd", "md_dpd", w) for w in (3, 6, 12, 36)}
    out["dpd_max3_15"] = h.window_max("dpd", "md_dpd", 15, first=3)
    for name in DISTANCES:
        out[f"since_{name}"] = h.months_to_last(name, "md_dpd")
    # All-history figures take the array as delivered, whatever its report month.
    ever = "slice(dpd, greatest(0 - md_dpd, 0) + 1, 37)" if strict else "dpd"
    out["dpd_ever"] = f"array_max({ever})"
    out["dpd_now"] = h.value_as_of("dpd", "(0 - md_dpd)") if strict else "get(dpd, 0)"
    return out


def _payments() -> dict[str, str]:
    months = h.months_aligned("pay", "md", 12)
    out = {}
    for w in (3, 6, 12):
        out[f"paid{w}"] = h.total(months[:w])
        out[f"paid_n{w}"] = h.known_count(months[:w])
        out[f"paid_last{w}"] = h.newest(months[:w])
    for w in (6, 12, 36):
        out[f"paid_max{w}"] = h.window_max("pay", "md", w)
        out[f"paid_min{w}"] = h.window_min("pay", "md", w)
    return out


def _past_due() -> dict[str, str]:
    months = h.months_aligned("due", "md", 12)
    out = {
        f"due_share{w}": h.share_positive(months[:w], h.months_covered("md", w))
        for w in (3, 6, 12)
    }
    # Two cleanings of the current past-due amount: unknown as NULL, or unknown as nothing due.
    out["due_am"] = h.non_negative("raw_due")
    out["due_or_zero"] = "CASE WHEN raw_due > 0 THEN raw_due ELSE 0.0D END"
    return out


def _card_use() -> dict[str, str]:
    """Utilisation, for cards only."""
    out = {}
    for w in (3, 6, 12, 36):
        mean = h.mean_known(h.window("card_use", "md", w))
        out[f"card_mean{w}"] = f"CASE WHEN cc THEN {mean} END"
        out[f"card_max{w}"] = h.window_max("card_use", "md", w)
    return out


def _balances() -> dict[str, str]:
    now = h.value_as_of("bal", "ahead")
    emi = amounts.instalment("raw_emi", "acct", "amt", f"({h.non_negative('raw_bal')})")
    out = {
        "outstanding": f"CASE WHEN ({now}) > 0 THEN {now} ELSE 0.0D END",
        "repaid": f"1.0D - ({now}) / amt",
        "emi": emi,
        "owes": amounts.still_owes(f"({now})", "amt", "live"),
    }
    back = "(0 - ahead)"  # months the report lies before the as-of date, rounded down
    for k in (6, 12, 24):
        was_open = amounts.open_on("opened", "closed", f"add_months({AS_OF}, -{k})")
        owed = amounts.still_owes(h.month("bal", back, k), "amt", was_open)
        out[f"emi_{k}m"] = f"CASE WHEN {owed} THEN {emi} ELSE 0.0D END"
    out["emi_paid_max12"] = h.window_max("pay", back, 12)
    out["emi_paid_last12"] = h.newest(h.months_aligned("pay", back, 12))
    return out


def _enquiry_kinds() -> dict[str, str]:
    lender = codes.lender_flags(codes.lender())
    purpose = codes.purpose_flags(codes.code("inq_purp_cd"))
    return purpose | {"nbfc": lender["nbfc"], "pvt": lender["pvt"]}


def enquiry_rows(enquiry: DataFrame, keys: Sequence[str], as_of: str) -> DataFrame:
    """An enquiry as features see it as of a date: its age and its kinds."""
    age = months_since(date_sql("inq_date"), f"CAST({as_of} AS DATE)")
    return _step(enquiry, keys, {"mse": age} | _enquiry_kinds())


def enquiry_events(enquiry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same before any as-of date is known: its day and its kinds."""
    return _step(enquiry, keys, {"inquired": date_sql("inq_date")} | _enquiry_kinds())
