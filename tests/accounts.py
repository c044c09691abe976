"""Hand-made account rows: every column of the schema, overridable by name."""

import datetime as dt

from bureauframe.operators.aggregate import feature_frame
from bureauframe.plans.catalogue import ACCOUNT_GROUPS
from bureauframe.plans.rows import account_rows
from bureauframe.sources.schemas import TRADELINE

AS_OF = dt.date(2024, 1, 31)
KEYS = ["customer_scrub_key", "scrub_output_date"]


def frame(spark, *overrides, schema=TRADELINE):
    base = dict.fromkeys(schema.fieldNames())
    base |= {
        "customer_scrub_key": "C1",
        "scrub_output_date": AS_OF,
        "acct_type_cd": "123",
        "m_sub_id": "NBF",
        "open_dt": "31/01/2023",
        "balance_dt": "31/01/2024",
        "orig_loan_am": 100000.0,
    }
    rows = [tuple((base | o)[name] for name in schema.fieldNames()) for o in overrides]
    return spark.createDataFrame(rows, schema)


def features(spark, *overrides, groups=ACCOUNT_GROUPS, strict=False, schema=TRADELINE):
    rows = account_rows(frame(spark, *overrides, schema=schema), KEYS, KEYS[1], strict)
    return {r["customer_scrub_key"]: r for r in feature_frame(rows, KEYS, groups).collect()}
