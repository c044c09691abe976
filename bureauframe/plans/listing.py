"""All features of one named customer, in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.operators.checks import feature_listing
from bureauframe.operators.frames import rounded
from bureauframe.plans import scrub
from bureauframe.plans.scrub import Computation
from bureauframe.sources.schemas import CUSTOMER_KEY, PARTY, SCRUB_DATE


def customer_listing(
    tradeline: DataFrame,
    enquiry: DataFrame,
    master: DataFrame,
    customer_key: str,
    scrub_date: str,
    computation: Computation = Computation(),
    digits: int | None = None,
) -> DataFrame:
    """One row per feature of both sources for one customer of a delivery, values as text, doubles
    with `digits` decimals if given.

    The key is compared before anything else, so the filter reaches every scan.
    """
    own = [df.filter(F.col(CUSTOMER_KEY) == customer_key) for df in (tradeline, enquiry, master)]
    day = F.lit(scrub_date).cast("date")
    accounts = own[0].filter(F.col(SCRUB_DATE) == day)
    parts = [
        scrub.tradeline_features(
            accounts, own[2], computation.account_groups, computation.strict, gathered=False
        ),
        scrub.enquiry_features(own[1], accounts, own[2], scrub_date, computation.enquiry_groups),
    ]
    keys = [CUSTOMER_KEY, PARTY, SCRUB_DATE]
    if digits is not None:
        parts = [rounded(part, digits) for part in parts]
    return feature_listing(parts[0], keys).unionByName(feature_listing(parts[1], keys))
