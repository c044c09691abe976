"""Declared schemas of the four input tables and checks against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# A history family is one current column plus 36 monthly columns: X, X_01 .. X_36.
HISTORY_FAMILIES = (
    "days_past_due",
    "balance_am",
    "past_due_am",
    "credit_limit_am",
    "actual_payment_am",
)
HISTORY_MONTHS = 36

SCRUB_DATE = "scrub_output_date"
CUSTOMER_KEY = "customer_scrub_key"
PARTY = "party_code"
REFERENCE_DATE = "reference_dt"

SCRUB_KEYS = (CUSTOMER_KEY, PARTY, SCRUB_DATE)
RETRO_KEYS = (PARTY, REFERENCE_DATE)


def history_columns(family: str) -> list[str]:
    """Column names of one family, current month first."""
    return [family] + [f"{family}_{month:02d}" for month in range(1, HISTORY_MONTHS + 1)]


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names]


TRADELINE = T.StructType(
    _fields(T.StringType(), CUSTOMER_KEY)
    + _fields(T.DateType(), SCRUB_DATE)
    + _fields(
        T.StringType(),
        "acct_type_cd",
        "m_sub_id",
        "open_dt",
        "closed_dt",
        "balance_dt",
        "last_reporting_pymt_dt",
    )
    + _fields(T.DoubleType(), "orig_loan_am", "emi")
    + _fields(
        T.StringType(),
        "suit_filed_willful_dflt",
        "written_off_and_settled_status",
        "write_off_status_dt",
        "dflt_status_dt",
        "total_write_off_am_4in",
        "principal_write_off_am_4in",
        "settled_am_4in",
    )
    + [f for family in HISTORY_FAMILIES for f in _fields(T.DoubleType(), *history_columns(family))]
)

ENQUIRY = T.StructType(
    _fields(T.StringType(), CUSTOMER_KEY, "inq_purp_cd", "inq_date", "m_sub_id")
    + _fields(T.DoubleType(), "amount")
)

MASTER = T.StructType(
    _fields(T.StringType(), CUSTOMER_KEY, PARTY) + _fields(T.DateType(), SCRUB_DATE)
)

RETRO_INPUT = T.StructType(_fields(T.StringType(), PARTY) + _fields(T.DateType(), REFERENCE_DATE))


def require_columns(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Fail early, naming every missing column, instead of deep inside a plan.

    Only presence is checked: the delivered types vary (amounts arrive as text or as numbers,
    dates as text or as dates) and the row expressions cast leniently.
    """
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df
