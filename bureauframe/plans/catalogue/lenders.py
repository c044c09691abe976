"""Lender mix: counts by lender type and shares of recent borrowing."""

from bureauframe.plans.features import (
    ACCOUNT,
    FeatureGroup,
    count,
    derived_flag,
    flag,
    hide,
    ratio,
)

EVER = "mso IS NOT NULL"


def _base(name: str, where: str):
    return hide(count(name, where))


def _percent(name: str, part: str, whole: str):
    return ratio(name, part, whole, scale=100)


LENDER_MIX = FeatureGroup(
    "grp05_lender_mix",
    ACCOUNT,
    (
        count("no_of_CL_taken_from_nbfc_5_years", "cl AND nbfc AND mso <= 60"),
        count("no_of_CL_taken_from_nbfc_3_years", "cl AND nbfc AND mso <= 36"),
        count("no_of_nbfc_lt_10k_12m", "nbfc AND mso <= 12 AND amt < 10000"),
        count("count_accounts_Pvt_bank", f"pvt AND {EVER}"),
        count("count_accounts_Pvt_bank_last24m", "pvt AND mso <= 24"),
        count("count_pl_Pvt_bank", f"pl AND pvt AND {EVER}"),
        count("count_pl_Pvt_bank_last24m", "pl AND pvt AND mso <= 24"),
        count("count_accounts_nbfc_alltime", f"nbfc AND {EVER}"),
        count("count_accounts_nbfc_last24m", "nbfc AND mso <= 24"),
        count("count_pl_nbfc_last24m", "pl AND nbfc AND mso <= 24"),
        count("count_accounts_pub_bank", f"pub AND {EVER}"),
        count("count_accounts_mfi", f"mfi AND {EVER}"),
        count("count_accounts_sfb", f"sfb AND {EVER}"),
        flag("flag_any_nbfc_last12m", "nbfc AND mso <= 12"),
        count("count_secured_loans_from_nbfc_3y", "nbfc AND secured AND mso <= 36"),
        count("count_unsecured_loans_from_nbfc_3y", "nbfc AND usl AND mso <= 36"),
        count("count_secured_loans_from_bank_3y", "bank AND secured AND mso <= 36"),
        count("count_unsecured_loans_from_bank_3y", "bank AND usl AND mso <= 36"),
        _base("_pl_5y", "pl AND mso <= 60"),
        _base("_pl_3y", "pl AND mso <= 36"),
        _base("_cc_5y", "cc AND mso <= 60"),
        _base("_cc_3y", "cc AND mso <= 36"),
        _base("_all_3y", "mso <= 36"),
        _base("_secured_3y", "secured AND mso <= 36"),
        _base("_usl_3y", "usl AND mso <= 36"),
        _base("_nbfc_pl_5y", "pl AND nbfc AND mso <= 60"),
        _base("_nbfc_pl_3y", "pl AND nbfc AND mso <= 36"),
        _base("_nbfc_3y", "nbfc AND mso <= 36"),
        _base("_bank_3y", "bank AND mso <= 36"),
        _base("_pvt_cc_5y", "cc AND pvt AND mso <= 60"),
        _base("_pvt_cc_3y", "cc AND pvt AND mso <= 36"),
        _base("_pvt_3y", "pvt AND mso <= 36"),
        _base("_pub_3y", "pub AND mso <= 36"),
        _base("_pvt_pl_3y", "pl AND pvt AND mso <= 36"),
        _base("_pub_pl_3y", "pl AND pub AND mso <= 36"),
        _percent("perc_PL_taken_from_nbfc_5_years", "_nbfc_pl_5y", "_pl_5y"),
        _percent("perc_CC_taken_from_prb_5_years", "_pvt_cc_5y", "_cc_5y"),
        _percent("perc_PL_taken_from_nbfc_3_years", "_nbfc_pl_3y", "_pl_3y"),
        _percent("perc_CC_taken_from_prb_3_years", "_pvt_cc_3y", "_cc_3y"),
        _percent("perc_accounts_from_nbfc_3y", "_nbfc_3y", "_all_3y"),
        _percent("perc_accounts_from_bank_3y", "_bank_3y", "_all_3y"),
        ratio("ratio_nbfc_to_bank_count_3y", "_nbfc_3y", "_bank_3y"),
        derived_flag("flag_nbfc_only_3y", "_all_3y > 0 AND _nbfc_3y = _all_3y"),
        _percent("perc_unsecured_from_nbfc_3y", "count_unsecured_loans_from_nbfc_3y", "_usl_3y"),
        _percent("perc_secured_from_bank_3y", "count_secured_loans_from_bank_3y", "_secured_3y"),
        _percent("perc_accounts_from_pvt_bank_3y", "_pvt_3y", "_all_3y"),
        _percent("perc_accounts_from_pub_bank_3y", "_pub_3y", "_all_3y"),
        _percent("perc_pl_from_pvt_bank_3y", "_pvt_pl_3y", "_pl_3y"),
        _percent("perc_pl_from_pub_bank_3y", "_pub_pl_3y", "_pl_3y"),
        _percent("perc_pl_from_formal_bank_3y", "_pvt_pl_3y + _pub_pl_3y", "_pl_3y"),
    ),
)
