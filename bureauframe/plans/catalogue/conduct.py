"""Balances, utilisation, delinquency, payments, obligations and write-offs."""

from bureauframe.plans.features import (
    ACCOUNT,
    FeatureGroup,
    count,
    derived,
    derived_flag,
    flag,
    highest,
    lowest,
    mean,
    ratio,
    total,
)

OUTSTANDING_BALANCE = FeatureGroup(
    "grp03a_outstanding_balance",
    ACCOUNT,
    (
        total("total_active_outstanding_debt", "outstanding", "live"),
        total("currentbalancedue", "outstanding"),
        total("TotalOutstandingOnActiveSTPL", "outstanding", "live AND stpl_small"),
        total("curr_CL_agg_bal", "outstanding", "live AND cl"),
        total("curr_PL_agg_bal", "outstanding", "live AND pl"),
        total("curr_HL_agg_bal", "outstanding", "live AND hl_property"),
        total("curr_CC_agg_bal", "outstanding", "live AND cc"),
        highest("max_agg_card_bal", "outstanding", "cc"),
    ),
)

CREDIT_UTILIZATION = FeatureGroup(
    "grp03b_credit_utilization",
    ACCOUNT,
    (
        *(mean(f"past_due_freq_last_{w}m", f"due_share{w}") for w in (3, 6, 12)),
        *(mean(f"past_due_freq_cc_last_{w}m", f"due_share{w}", "cc") for w in (3, 6, 12)),
        *(mean(f"past_due_freq_pl_last_{w}m", f"due_share{w}", "live AND pl") for w in (3, 6, 12)),
        mean("past_due_freq_stpl_last_12m", "due_share12", "stpl"),
        mean("past_due_freq_usl_last_12m", "due_share12", "usl"),
        *(mean(f"avg_cc_utilization_last_{w}m", f"card_mean{w}") for w in (3, 6, 12, 36)),
        *(highest(f"max_cc_utilization_last_{w}m", f"card_max{w}") for w in (3, 6, 12, 36)),
        total("total_past_due_active", "due_am", "live"),
        total("total_past_due_all", "due_am"),
        highest("max_past_due_single_account", "due_am"),
        count("count_accounts_with_past_due", "due_am > 0"),
        count("count_cc_with_past_due", "live AND cc AND due_am > 0"),
        derived_flag("flag_any_past_due", "count_accounts_with_past_due > 0"),
        derived_flag("flag_consistent_revolver", "past_due_freq_last_12m > 0.5"),
    ),
)


def _over(name: str, source: str, days: int):
    return derived_flag(name, f"{source} >= {days}")


# The counts are of accounts, not of months, and NULL when no account has data in the window.
def _accounts(name: str, source: str, hit: str, where: str | None = None):
    return total(name, f"CASE WHEN {source} {hit} THEN 1 WHEN {source} IS NOT NULL THEN 0 END", where)


DELINQUENCY = FeatureGroup(
    "grp07_delinquency",
    ACCOUNT,
    (
        highest("max_dpd", "dpd_ever"),
        highest("max_dpd_usl", "dpd_ever", "usl"),
        highest("max_dpd_usl_gt50k", "dpd_ever", "usl AND amt > 50000"),
        highest("max_dpd_CC", "dpd_ever", "cc"),
        highest("max_dpd_HL", "dpd_ever", "hl"),
        highest("max_dpd_GL", "dpd_ever", "gl"),
        highest("max_dpd_AL", "dpd_ever", "al"),
        highest("max_dpd_pl", "dpd_ever", "pl"),
        highest("max_dpd_in_3_years", "dpd_max36"),
        highest("max_dpd_in_12_months", "dpd_max12"),
        highest("max_dpd_in_last_3_15_mon", "dpd_max3_15"),
        highest("max_dpd_pl_12m", "dpd_max12", "pl"),
        highest("max_dpd_pl_3y", "dpd_max36", "pl"),
        _accounts("no_of_dpd_in_12_months", "dpd_max12", "> 0"),
        _accounts("no_of_dpd30_in_12_months", "dpd_max12", ">= 30"),
        _accounts("no_of_dpd60_in_12_months", "dpd_max12", ">= 60"),
        _accounts("no_of_dpd90_in_12_months", "dpd_max12", ">= 90"),
        _accounts("no_of_dpd_in_36_months", "dpd_max36", "> 0"),
        _accounts("no_of_dpd30_pl_12m", "dpd_max12", ">= 30", "pl"),
        _accounts("no_of_dpd_pl_36m", "dpd_max36", "> 0", "pl"),
        *(
            flag(f"is_{low}to{high}_last{w}_months", f"dpd_max{w} >= {low} AND dpd_max{w} < {high}")
            for w in (3, 6, 12)
            for low, high in ((10, 30), (30, 60), (60, 90))
        ),
        *(_over(f"is_dpd_{days}", "max_dpd", days) for days in (180, 90, 60, 30)),
        *(
            _over(f"is_dpd_{days}_last12m", "max_dpd_in_12_months", days)
            for days in (180, 90, 60, 30)
        ),
        *(_over(f"is_dpd_{days}_last36m", "max_dpd_in_3_years", days) for days in (180, 90)),
        lowest("months_since_last_dpd30", "since_dpd30"),
        lowest("MostRecentDPDGT15Month", "since_dpd15"),
        lowest("MostRecentDPDGT0Month", "since_dpd0"),
        highest("current_dpd", "dpd_now", "live"),
        total("current_dpd_due", "due_or_zero", "live"),
    ),
)


def _repayment_range(product: str, where: str):
    label = f"RepaymentOnActive{product}Accounts"
    for months, suffix in ((36, ""), (12, "_12m"), (6, "_6m")):
        yield highest(f"Max{label}{suffix}", f"paid_max{months}", where)
        yield lowest(f"Min{label}{suffix}", f"paid_min{months}", where)


# A payment counts as missed when the newest reported month of the window shows none.
_MISSED = {
    "": "",
    "cc_": " AND live AND cc",
    "pl_": " AND live AND pl",
    "stpl_": " AND live AND stpl",
    "pl_gt30k_": " AND live AND pl AND amt > 30000",
}

PAYMENT_BEHAVIOUR = FeatureGroup(
    "grp08a_payment_behaviour",
    ACCOUNT,
    (
        *(total(f"payments_{w}_month", f"paid{w}") for w in (3, 6, 12)),
        *(total(f"frequency_of_payments_{w}m", f"paid_n{w}") for w in (3, 6, 12)),
        *_repayment_range("CreditCard", "live AND cc"),
        *_repayment_range("PersonalLoan", "live AND pl"),
        *(
            count(f"no_of_missed_payments_{part}last_{w}m", f"paid_last{w} <= 0{where}")
            for part, where in _MISSED.items()
            for w in (3, 6, 12)
        ),
        *(
            derived_flag(
                f"flag_missed_{part or 'payment_'}last_{w}m",
                f"no_of_missed_payments_{part}last_{w}m > 0",
            )
            for part in ("", "stpl_", "pl_gt30k_")
            for w in (3, 12)
        ),
        highest("max_payment_last_12m", "paid_max12"),
        ratio("mean_payment_last_12m", "payments_12_month", "frequency_of_payments_12m"),
        ratio("ratio_payment_3m_to_12m", "payments_3_month", "payments_12_month"),
    ),
)

REPAYMENT_RATIO = FeatureGroup(
    "grp08b_repayment_ratio",
    ACCOUNT,
    (
        mean("RepaymentPercentageTotalSTPL", "repaid", "stpl"),
        mean("RepaymentPercentageActiveSTPL", "repaid", "stpl AND live"),
        mean("Paid_ratio_unsecured", "repaid", "usl"),
        mean("RepaymentPercentageTotalPL", "repaid", "pl"),
        mean("RepaymentPercentageActivePL", "repaid", "pl AND live"),
        mean("repayment_pct_all", "repaid"),
        mean("repayment_pct_active", "repaid", "live"),
        lowest("min_repayment_pct_active", "repaid", "live"),
        highest("max_repayment_pct_active", "repaid", "live"),
        count("count_stpl_fully_repaid", "stpl AND repaid >= 1.0"),
        count("count_pl_fully_repaid", "pl AND repaid >= 1.0"),
        derived_flag("flag_fully_repaid_pl", "count_pl_fully_repaid > 0"),
        flag("flag_balance_grown_stpl", "stpl AND repaid < 0"),
        flag("flag_balance_grown_pl", "pl AND repaid < 0"),
        ratio(
            "ratio_repayment_pl_vs_stpl",
            "RepaymentPercentageActivePL",
            "RepaymentPercentageActiveSTPL",
        ),
    ),
)


def _owed(name: str, product: str | None = None):
    where = f"owes AND {product}" if product else "owes"
    return total(name, f"CASE WHEN {where} THEN emi ELSE 0.0D END")


OBLIGATIONS = FeatureGroup(
    "grp09_obligations",
    ACCOUNT,
    (
        _owed("obligations"),
        count("count_obligating_accounts", "owes"),
        *(total(f"obligations_{k}m", f"emi_{k}m") for k in (6, 12, 24)),
        highest("Max_obligations_paid_last12months", "emi_paid_max12"),
        mean("mean_obligations_paid_last12months", "emi_paid_last12"),
        _owed("obligations_pl", "pl"),
        _owed("obligations_hl", "hl_mortgage"),
        _owed("obligations_cc", "cc"),
        ratio("ratio_obligations_change_12m", "obligations", "obligations_12m"),
    ),
)

SEVERE_RISK = FeatureGroup(
    "grp10_severe_risk",
    ACCOUNT,
    (
        flag("suit_filed_willful_dflt", "is_suit OR is_wilful"),
        flag("wo", "is_wo"),
        flag("wo_5_years", "is_wo AND since_wo <= 60"),
        flag("wo_3_years", "is_wo AND since_wo <= 36"),
        flag("flag_wilful_default", "is_wilful"),
        flag("flag_suit_filed", "is_suit"),
        flag("flag_settled", "is_settled"),
        flag("flag_restructured", "is_restructured"),
        flag("flag_post_wo_settled", "is_post_wo_settled"),
        flag("wo_1_year", "is_wo AND since_wo <= 12"),
        flag("flag_wo_active", "is_wo AND live"),
        flag("flag_wo_pl", "is_wo AND pl"),
        flag("flag_wo_stpl", "is_wo AND stpl"),
        flag("flag_wo_usl", "is_wo AND usl"),
        count("count_wo_accounts", "is_wo"),
        count("count_suit_accounts", "is_suit"),
        total("total_charge_off_am", "wo_total", "is_wo"),
        highest("max_charge_off_am", "wo_total", "is_wo"),
        total("total_principal_wo_am", "wo_principal", "is_wo"),
        highest("max_principal_wo_am", "wo_principal", "is_wo"),
        total("total_settled_am", "settled", "is_settled"),
        highest("max_settled_am", "settled", "is_settled"),
        flag("flag_partial_recovery", "is_settled AND settled < wo_total"),
        lowest("months_since_last_wo", "since_wo", "is_wo"),
        lowest("months_since_last_suit", "since_suit", "is_suit"),
        ratio("ratio_principal_to_total_wo", "total_principal_wo_am", "total_charge_off_am"),
        ratio("ratio_settled_to_wo", "total_settled_am", "total_charge_off_am"),
        derived("net_loss_am", "total_charge_off_am - coalesce(total_settled_am, 0.0D)"),
    ),
)

