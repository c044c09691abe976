"""The feature catalogue: 16 account groups and one enquiry group."""

from bureauframe.plans.catalogue.amounts import (
    CREDIT_CARD_LIMITS,
    HIGHEST_CREDIT,
    LOAN_AMOUNT_EXPOSURE,
    LOAN_VOLUME,
)
from bureauframe.plans.catalogue.conduct import (
    CREDIT_UTILIZATION,
    DELINQUENCY,
    OBLIGATIONS,
    OUTSTANDING_BALANCE,
    PAYMENT_BEHAVIOUR,
    REPAYMENT_RATIO,
    SEVERE_RISK,
)
from bureauframe.plans.catalogue.enquiries import ENQUIRIES
from bureauframe.plans.catalogue.lenders import LENDER_MIX
from bureauframe.plans.catalogue.portfolio import (
    BEHAVIOUR_FLAGS,
    BUREAU_VINTAGE,
    PORTFOLIO_COUNTS,
    RECENCY,
)

ACCOUNT_GROUPS = (
    PORTFOLIO_COUNTS,
    LOAN_AMOUNT_EXPOSURE,
    CREDIT_CARD_LIMITS,
    HIGHEST_CREDIT,
    LOAN_VOLUME,
    OUTSTANDING_BALANCE,
    CREDIT_UTILIZATION,
    BUREAU_VINTAGE,
    LENDER_MIX,
    RECENCY,
    BEHAVIOUR_FLAGS,
    DELINQUENCY,
    PAYMENT_BEHAVIOUR,
    REPAYMENT_RATIO,
    OBLIGATIONS,
    SEVERE_RISK,
)
ENQUIRY_GROUPS = (ENQUIRIES,)
GROUPS = {group.name: group for group in ACCOUNT_GROUPS + ENQUIRY_GROUPS}

__all__ = ["ACCOUNT_GROUPS", "ENQUIRY_GROUPS", "GROUPS"]
