"""Account counts, active portfolio, bureau age bands, vintage, recency and behaviour flags."""

from bureauframe.functions import codes
from bureauframe.plans.features import (
    ACCOUNT,
    FeatureGroup,
    count,
    derived,
    derived_flag,
    distinct,
    flag,
    hide,
    highest,
    lowest,
    mean,
    ratio,
)

EVER = "mso IS NOT NULL"


def _thickness(label: str, n: str, top: str, thin: str, thick: str) -> str:
    return (
        f"CASE WHEN {n} = 0 THEN 'No {label}' "
        f"WHEN {thin} AND {top} < 100000 THEN 'Thin {label}' "
        f"WHEN {thick} AND {top} >= 100000 THEN 'Thick {label}' "
        f"ELSE 'Medium {label}' END"
    )


PORTFOLIO_COUNTS = FeatureGroup(
    "grp01_portfolio_counts",
    ACCOUNT,
    (
        count("count_of_tradelines_opened_last_6m", "mso <= 6"),
        count("count_of_tradelines_opened_last_12m", "mso <= 12"),
        count("count_of_tradelines_opened_last_6m_lt_10000", "mso <= 6 AND amt < 10000"),
        count("count_of_tradelines_opened_last_12m_lt_20000", "mso <= 12 AND amt < 20000"),
        count("count_of_tradelines_opened_last_6m_personal_loan", "mso <= 6 AND pl"),
        count("count_of_tradelines_opened_last_1y_personal_loan", "mso <= 12 AND pl"),
        count("count_of_tradelines_opened_last_3y_personal_loan", "mso <= 36 AND pl"),
        count("count_of_tradelines_opened_last_3y_cc", "mso <= 36 AND cc"),
        count("CountBureauActivePersonalLoanAccounts", "live AND pl"),
        count("countoftradelines_unsecured", "usl"),
        count("countlessthan30KPlinLast24Months", "mso <= 24 AND pl AND amt <= 30000"),
        count("countBureauGoldLoansGreaterThan2L", "gold AND amt > 200000"),
        count("CountBureauActiveSTPLAccounts", "live AND stpl_small"),
        count("BureauActiveTradelines", "live"),
        count("active_usl", "live AND usl"),
        count("active_cc", "live AND cc"),
        count("active_hl", "live AND hl"),
        count("active_al", "live AND al"),
        count("active_gl", "live AND gl"),
        count("active_other_loans", "live AND other_count"),
        flag(
            "loan_flag",
            f"{EVER} AND (raw_amt >= 200000 AND acct IN ('123', '168', '195') "
            "OR raw_amt >= 50000 AND acct = '5' OR raw_amt >= 300000 AND acct = '221')",
        ),
        count("tot_pls", f"{EVER} AND pl"),
        highest("max_pl_loan_amount", "amt", f"{EVER} AND pl"),
        count("tot_cc", f"{EVER} AND cc"),
        highest("max_cc_loan_amount", "amt", f"{EVER} AND cc"),
        count("tot_tradelines", EVER),
        highest("bureaage_months", "mso"),
        derived(
            "pl_thickness",
            _thickness("PL", "tot_pls", "max_pl_loan_amount", "tot_pls <= 2", "tot_pls > 2"),
        ),
        derived(
            "cc_thickness",
            _thickness("CC", "tot_cc", "max_cc_loan_amount", "tot_cc = 1", "tot_cc >= 2"),
        ),
        derived(
            "bureaage",
            "CASE WHEN bureaage_months > 60 THEN '>5Y' WHEN bureaage_months > 24 THEN '2-5Y' "
            "WHEN bureaage_months > 12 THEN '1-2Y' WHEN bureaage_months > 0 THEN '<1Y' "
            "ELSE 'Unknown' END",
        ),
        derived(
            "bur_cohort",
            "CASE WHEN bureaage_months >= 18 AND tot_tradelines >= 3 THEN 'Thick' ELSE 'Thin' END",
        ),
    ),
)

BIG = "amt > 100000"

BUREAU_VINTAGE = FeatureGroup(
    "grp04_bureau_vintage",
    ACCOUNT,
    (
        mean("meanbureauage", "mso"),
        mean("meanbureauageonactive", "mso", "live"),
        mean("meanbureauage_gt_100k", "mso", BIG),
        mean("meanbureauage_unsecured", "mso", "usl"),
        mean("meanbureauage_pl", "mso", "pl"),
        mean("meanbureauage_cc", "mso", "cc"),
        mean("meanbureauage_active_pl", "mso", "pl AND live"),
        highest("bureage_overall", "mso"),
        highest("bureage_pl", "mso", "pl"),
        highest("bureage_cc", "mso", "cc"),
        highest("burage_unsecured", "mso", "usl"),
        highest("maxbureauage_gt_100k", "mso", BIG),
        lowest("minbureauage", "mso"),
        lowest("minbureauage_active", "mso", "live"),
        count("count_accounts_gt_60m", "mso > 60"),
        count("count_accounts_gt_24m", "mso > 24"),
        derived("age_range_months", "bureage_overall - minbureauage"),
        ratio("ratio_mean_to_max_age", "meanbureauage", "bureage_overall"),
    ),
)

RECENCY = FeatureGroup(
    "grp06a_recency_credit_activity",
    ACCOUNT,
    (
        *(
            lowest(f"months_from_last_{product}", "mso", product)
            for product in ("cl", "cc", "pl", "gl", "hl", "al", "stpl")
        ),
        lowest("months_from_last_any", "mso"),
        lowest("months_from_last_any_active", "mso", "live"),
        lowest("months_from_last_nbfc", "mso", "nbfc"),
        lowest("months_from_last_pl_or_stpl", "mso", "pl OR stpl"),
        flag("flag_pl_opened_last_3m", "pl AND mso <= 3"),
        flag("flag_cc_opened_last_6m", "cc AND mso <= 6"),
        flag("flag_any_opened_last_1m", "mso <= 1"),
        distinct("count_products_ever", "acct", EVER, codes.ANY_PRODUCT),
    ),
)

BEHAVIOUR_FLAGS = FeatureGroup(
    "grp06b_credit_behaviour_flags",
    ACCOUNT,
    (
        flag("hasActiveTradeLineInLast12Months", "mso <= 12 AND live"),
        flag("hasActiveTradeLineInLast24Months", "mso <= 24 AND live"),
        flag("has_taken_PL_ever", f"pl AND {EVER}"),
        flag("has_taken_pl_5yrs", "pl AND mso <= 60"),
        flag("has_active_credit_card_flag", "cc AND live"),
        flag("mcf_user", f"mcf AND {EVER}"),
        flag("has_active_pl_flag", "pl AND live"),
        flag("has_active_stpl_flag", "stpl AND live"),
        flag("has_active_gl_flag", "gl AND live"),
        flag("has_active_hl_flag", "hl AND live"),
        flag("has_taken_hl_ever", f"hl AND {EVER}"),
        flag("has_taken_gl_ever", f"gl AND {EVER}"),
        flag("has_taken_cc_ever", f"cc AND {EVER}"),
        flag("has_taken_stpl_ever", f"stpl AND {EVER}"),
        flag("mcf_active_user", "mcf AND live"),
        flag("has_p2p_loan_ever", f"p2p AND {EVER}"),
        flag("has_taken_pl_last_12m", "pl AND mso <= 12"),
        flag("has_active_al_flag", "al AND live"),
        flag("has_taken_al_ever", f"al AND {EVER}"),
        flag("has_active_usl_flag", "usl AND live"),
        flag("has_taken_usl_ever", f"usl AND {EVER}"),
        hide(flag("_secured_ever", f"secured AND {EVER}")),
        hide(count("_active_pl", "pl AND live")),
        derived_flag("has_only_secured_credit", "_secured_ever = 1 AND has_taken_usl_ever = 0"),
        derived_flag("has_both_pl_and_cc", "has_taken_PL_ever = 1 AND has_taken_cc_ever = 1"),
        derived_flag("has_multiple_active_pl", "_active_pl >= 2"),
    ),
)
