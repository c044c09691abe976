"""Loan amounts, card limits, highest credit and loan volume.

The first group ignores the opening date (an account that opens after the as-of date counts);
the other three do not.
"""

from bureauframe.plans.features import (
    ACCOUNT,
    FeatureGroup,
    derived_flag,
    flag,
    highest,
    mean,
    ratio,
    total,
)


def _top(name: str, where: str, value: str = "amt"):
    return highest(name, value, where, zero=True)


def _sum(name: str, where: str, value: str = "amt"):
    return total(name, value, where, zero=True)


LOAN_AMOUNT_EXPOSURE = FeatureGroup(
    "grp02a_loan_amount_exposure",
    ACCOUNT,
    (
        highest("maxLoanAmountAllAccountsExceptGLandCC", "amt_any", "NOT gl AND NOT cc"),
        _top("MaxLoanAmountInactiveSTPL", "stpl_small AND dead_any", "amt_any"),
        _top("MaxLoanAmountActiveSTPL", "stpl_small AND live_any", "amt_any"),
        _top("MaxLoanAmountTotalSTPL", "stpl_small", "amt_any"),
        _top("MaxLoanAmountActivePersonalLoan", "pl AND live_any", "amt_any"),
        _sum("TotalLoanAmtOnActivePLAccounts", "pl AND live_any", "amt_any"),
        _sum("sumloanamount_personalloan", "pl", "amt_any"),
        _top("max_loanamount_sl", "secured", "amt_any"),
        _top("max_loanamount_usl", "usl", "amt_any"),
        _top("max_loanamount_cc", "cc", "amt_any"),
        _top("max_loanamount_gl", "gl", "amt_any"),
        _top("max_loanamount_hl", "hl", "amt_any"),
        _top("max_loanamount_al", "al", "amt_any"),
        _top("max_loanamount_others", "other_amount", "amt_any"),
        highest("max_loanamount", "amt_any"),
        highest("max_credit_limit", "amt_any", "cc AND live_any"),
        _sum("active_total_cc_credit_limit", "cc AND live_any", "amt_any"),
        ratio("ratio_max_pl_to_max_loanamount", "MaxLoanAmountActivePersonalLoan", "max_loanamount"),
        ratio("ratio_active_pl_sum_to_max_loan", "TotalLoanAmtOnActivePLAccounts", "max_loanamount"),
        derived_flag("flag_stpl_only", "MaxLoanAmountTotalSTPL > 0 AND max_loanamount <= 30000"),
        derived_flag("flag_high_value_hl", "max_loanamount_hl >= 2500000"),
        derived_flag("flag_has_large_pl", "MaxLoanAmountActivePersonalLoan >= 500000"),
        _sum("total_active_exposure", "live_any", "amt_any"),
        _sum("sumloanamount_personalloan_lt_50K", "pl AND amt_any <= 50000", "amt_any"),
        ratio("max_loanamount_usl_vs_sl_ratio", "max_loanamount_usl", "max_loanamount_sl"),
        derived_flag(
            "flag_stpl_active_and_inactive",
            "MaxLoanAmountActiveSTPL > 0 AND MaxLoanAmountInactiveSTPL > 0",
        ),
        derived_flag(
            "flag_pure_unsecured_customer",
            "max_loanamount_usl > 0 AND greatest(max_loanamount_sl, max_loanamount_hl, "
            "max_loanamount_al, max_loanamount_gl) = 0",
        ),
    ),
)

# Fixed values: (smallest card limit, months since opening).
CARD_LIMIT_BANDS = (
    (25000, 24),
    (50000, 24),
    (100000, 24),
    (100000, 12),
    (100000, 6),
    (10000, 6),
    (50000, 12),
)

CREDIT_CARD_LIMITS = FeatureGroup(
    "grp02b_credit_card_limits",
    ACCOUNT,
    tuple(
        total(
            f"CreditLimit_{limit}_Vintage_{months}",
            "amt",
            f"cc AND amt >= {limit} AND mso <= {months}",
        )
        for limit, months in CARD_LIMIT_BANDS
    ),
)

HIGHEST_CREDIT = FeatureGroup(
    "grp02c_highest_credit_signals",
    ACCOUNT,
    (
        _top("highest_credit_gold_loan_5_years", "gl AND mso <= 60"),
        _top("highest_credit_consumer_loan_3_years", "cl AND mso <= 36"),
        _top("highest_credit_personal_loan_3_years", "pl AND mso <= 36"),
        _top("highest_credit_housing_loan", "hl AND mso IS NOT NULL"),
        _top("highest_credit_unsecured_3_years", "usl AND mso <= 36"),
        _top("highest_credit_al_3_years", "al AND mso <= 36"),
        _top("highest_credit_cc_3_years", "cc AND mso <= 36"),
        _top("highest_credit_pl_5_years", "pl AND mso <= 60"),
        _top("highest_credit_any_5_years", "mso <= 60"),
        _top("highest_credit_gl_3_years", "gl AND mso <= 36"),
        flag("flag_ever_had_hl", "hl AND mso IS NOT NULL"),
        flag("flag_ever_had_gl_gt_1L", "gl AND mso IS NOT NULL AND amt > 100000"),
        ratio(
            "ratio_highest_pl_3y_to_gl_3y",
            "highest_credit_personal_loan_3_years",
            "highest_credit_gl_3_years",
        ),
    ),
)

LOAN_VOLUME = FeatureGroup(
    "grp02d_loan_volume_over_time",
    ACCOUNT,
    (
        _sum("total_loan_amt_in_last12_mon", "mso <= 12"),
        _sum("total_loan_amt_3_years", "mso <= 36"),
        mean("mean_credit_unsecured_in_3_years", "amt", "usl AND mso <= 36"),
        _sum("total_loan_amt_pl_12m", "pl AND mso <= 12"),
        _sum("total_loan_amt_pl_3_years", "pl AND mso <= 36"),
        _sum("total_loan_amt_unsecured_12m", "usl AND mso <= 12"),
        _sum("total_loan_amt_unsecured_3y", "usl AND mso <= 36"),
        _sum("total_loan_amt_secured_3_years", "secured AND mso <= 36"),
        mean("mean_credit_pl_in_3_years", "amt", "pl AND mso <= 36"),
        mean("mean_credit_all_in_12m", "amt", "mso <= 12"),
        ratio(
            "ratio_unsecured_to_total_vol_3y",
            "total_loan_amt_unsecured_3y",
            "total_loan_amt_3_years",
        ),
        ratio("ratio_12m_to_3y_volume", "total_loan_amt_in_last12_mon", "total_loan_amt_3_years"),
    ),
)
