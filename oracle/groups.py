"""DuckDB text of every feature group, written from the feature definitions.

Each group is (aggregates, derived): name -> SQL over `r` or `q`, name -> SQL over the
aggregates. Doubles are rounded to 6 digits.
"""

from __future__ import annotations

from oracle.rows import AL, CC, CL, GL, HL, PL, SEC, SPL, STPL, USL, USL_NAMED

Group = tuple[dict[str, str], dict[str, str]]


def n(where: str) -> str:
    return f"count(*) FILTER (WHERE {where})"


def yes(where: str) -> str:
    return f"CAST(coalesce(bool_or({where}), false) AS INTEGER)"


def agg(fn: str, value: str, where: str | None = None, zero: bool = False) -> str:
    out = f"{fn}({value})" + (f" FILTER (WHERE {where})" if where else "")
    return real(f"coalesce({out}, 0)" if zero else out)


def real(value: str) -> str:
    """Six digits. Means of twentieths often end in an exact 5 at the seventh digit, where the last
    bit of the sum would decide; the small shift moves such ties off the edge."""
    return f"round(CAST({value} AS DOUBLE) + 1e-9, 6) + 0.0"


def exact(value: str) -> str:
    """Unrounded helper for derived features."""
    return f"CAST({value} AS DOUBLE)"


def top(value: str, where: str) -> str:
    return agg("max", value, where, zero=True)


def tot(value: str, where: str) -> str:
    return agg("sum", value, where, zero=True)


def over(num: str, den: str, times: str = "") -> str:
    return real(f"CASE WHEN {den} > 0 THEN ({num})::DOUBLE / {den} {times} END")


def when(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def g01() -> Group:
    other = f"NOT (({GL}) OR ({AL}) OR ({HL}) OR ({CC}) OR ({SEC}) OR ({USL_NAMED}))"
    ever = "mso IS NOT NULL"
    a = {
        "count_of_tradelines_opened_last_6m": n("mso <= 6"),
        "count_of_tradelines_opened_last_12m": n("mso <= 12"),
        "count_of_tradelines_opened_last_6m_lt_10000": n("mso <= 6 AND amt < 10000"),
        "count_of_tradelines_opened_last_12m_lt_20000": n("mso <= 12 AND amt < 20000"),
        "count_of_tradelines_opened_last_6m_personal_loan": n(f"mso <= 6 AND {PL}"),
        "count_of_tradelines_opened_last_1y_personal_loan": n(f"mso <= 12 AND {PL}"),
        "count_of_tradelines_opened_last_3y_personal_loan": n(f"mso <= 36 AND {PL}"),
        "count_of_tradelines_opened_last_3y_cc": n(f"mso <= 36 AND {CC}"),
        "CountBureauActivePersonalLoanAccounts": n(f"live AND {PL}"),
        "countoftradelines_unsecured": n(USL),
        "countlessthan30KPlinLast24Months": n(f"{PL} AND mso <= 24 AND amt <= 30000"),
        "countBureauGoldLoansGreaterThan2L": n("a = '191' AND amt > 200000"),
        "CountBureauActiveSTPLAccounts": n(f"live AND {STPL} AND amt <= 30000"),
        "BureauActiveTradelines": n("live"),
        "active_usl": n(f"live AND {USL}"),
        "active_cc": n(f"live AND {CC}"),
        "active_hl": n(f"live AND {HL}"),
        "active_al": n(f"live AND {AL}"),
        "active_gl": n(f"live AND {GL}"),
        "active_other_loans": n(f"live AND {other}"),
        "loan_flag": yes(
            f"{ever} AND ((a IN ('168', '195') AND orig_loan_am >= 200000) OR "
            f"(a = '5' AND orig_loan_am >= 50000) OR ({PL} AND orig_loan_am >= 200000) OR "
            "(a = '221' AND orig_loan_am >= 300000))"
        ),
        "tot_pls": n(f"{ever} AND {PL}"),
        "max_pl_loan_amount": agg("max", "amt", f"{ever} AND {PL}"),
        "tot_cc": n(f"{ever} AND {CC}"),
        "max_cc_loan_amount": agg("max", "amt", f"{ever} AND {CC}"),
        "tot_tradelines": n(ever),
        "bureaage_months": agg("max", "mso"),
    }
    d = {
        "pl_thickness": "CASE WHEN tot_pls = 0 THEN 'No PL' "
        "WHEN tot_pls <= 2 AND max_pl_loan_amount < 100000 THEN 'Thin PL' "
        "WHEN tot_pls > 2 AND max_pl_loan_amount >= 100000 THEN 'Thick PL' ELSE 'Medium PL' END",
        "cc_thickness": "CASE WHEN tot_cc = 0 THEN 'No CC' "
        "WHEN tot_cc = 1 AND max_cc_loan_amount < 100000 THEN 'Thin CC' "
        "WHEN tot_cc >= 2 AND max_cc_loan_amount >= 100000 THEN 'Thick CC' ELSE 'Medium CC' END",
        "bureaage": "CASE WHEN bureaage_months > 0 AND bureaage_months <= 12 THEN '<1Y' "
        "WHEN bureaage_months > 12 AND bureaage_months <= 24 THEN '1-2Y' "
        "WHEN bureaage_months > 24 AND bureaage_months <= 60 THEN '2-5Y' "
        "WHEN bureaage_months > 60 THEN '>5Y' ELSE 'Unknown' END",
        "bur_cohort": "CASE WHEN bureaage_months >= 18 AND tot_tradelines >= 3 THEN 'Thick' "
        "ELSE 'Thin' END",
    }
    return a, d


def g02a() -> Group:
    other = f"NOT (({GL}) OR ({AL}) OR ({HL}) OR ({CC}) OR ({SPL}) OR ({USL_NAMED}))"
    a = {
        "maxLoanAmountAllAccountsExceptGLandCC": agg("max", "amt", f"NOT ({GL}) AND NOT ({CC})"),
        "MaxLoanAmountInactiveSTPL": top("amt", "stplq AND dead0"),
        "MaxLoanAmountActiveSTPL": top("amt", "stplq AND live0"),
        "MaxLoanAmountTotalSTPL": top("amt", "stplq"),
        "MaxLoanAmountActivePersonalLoan": top("amt", f"{PL} AND live0"),
        "TotalLoanAmtOnActivePLAccounts": tot("amt", f"{PL} AND live0"),
        "sumloanamount_personalloan": tot("amt", PL),
        "max_loanamount_sl": top("amt", SEC),
        "max_loanamount_usl": top("amt", USL),
        "max_loanamount_cc": top("amt", CC),
        "max_loanamount_gl": top("amt", GL),
        "max_loanamount_hl": top("amt", HL),
        "max_loanamount_al": top("amt", AL),
        "max_loanamount_others": top("amt", other),
        "max_loanamount": agg("max", "amt"),
        "max_credit_limit": agg("max", "amt", f"{CC} AND live0"),
        "active_total_cc_credit_limit": tot("amt", f"{CC} AND live0"),
        "total_active_exposure": tot("amt", "live0"),
        "sumloanamount_personalloan_lt_50K": tot("amt", f"{PL} AND amt <= 50000"),
    }
    d = {
        "ratio_max_pl_to_max_loanamount": over("MaxLoanAmountActivePersonalLoan", "max_loanamount"),
        "ratio_active_pl_sum_to_max_loan": over("TotalLoanAmtOnActivePLAccounts", "max_loanamount"),
        "flag_stpl_only": when("MaxLoanAmountTotalSTPL > 0 AND max_loanamount <= 30000"),
        "flag_high_value_hl": when("max_loanamount_hl >= 2500000"),
        "flag_has_large_pl": when("MaxLoanAmountActivePersonalLoan >= 500000"),
        "max_loanamount_usl_vs_sl_ratio": over("max_loanamount_usl", "max_loanamount_sl"),
        "flag_stpl_active_and_inactive": when(
            "MaxLoanAmountActiveSTPL > 0 AND MaxLoanAmountInactiveSTPL > 0"
        ),
        "flag_pure_unsecured_customer": when(
            "max_loanamount_usl > 0 AND max_loanamount_sl = 0 AND max_loanamount_hl = 0 "
            "AND max_loanamount_al = 0 AND max_loanamount_gl = 0"
        ),
    }
    return a, d


def g02b() -> Group:
    bands = [(25000, 24), (50000, 24), (100000, 24), (100000, 12), (100000, 6), (10000, 6),
             (50000, 12)]
    a = {
        f"CreditLimit_{t}_Vintage_{v}": agg(
            "sum", "amt", f"{CC} AND amt >= {t} AND mso >= 0 AND mso <= {v}"
        )
        for t, v in bands
    }
    return a, {}


def g02c() -> Group:
    a = {
        "highest_credit_gold_loan_5_years": top("amt", f"{GL} AND mso <= 60"),
        "highest_credit_consumer_loan_3_years": top("amt", f"{CL} AND mso <= 36"),
        "highest_credit_personal_loan_3_years": top("amt", f"{PL} AND mso <= 36"),
        "highest_credit_housing_loan": top("amt", f"{HL} AND mso IS NOT NULL"),
        "highest_credit_unsecured_3_years": top("amt", f"{USL} AND mso <= 36"),
        "highest_credit_al_3_years": top("amt", f"{AL} AND mso <= 36"),
        "highest_credit_cc_3_years": top("amt", f"{CC} AND mso <= 36"),
        "highest_credit_pl_5_years": top("amt", f"{PL} AND mso <= 60"),
        "highest_credit_any_5_years": top("amt", "mso <= 60"),
        "highest_credit_gl_3_years": top("amt", f"{GL} AND mso <= 36"),
        "flag_ever_had_hl": yes(f"{HL} AND mso IS NOT NULL"),
        "flag_ever_had_gl_gt_1L": yes(f"{GL} AND mso IS NOT NULL AND amt > 100000"),
    }
    d = {
        "ratio_highest_pl_3y_to_gl_3y": over(
            "highest_credit_personal_loan_3_years", "highest_credit_gl_3_years"
        )
    }
    return a, d


def g02d() -> Group:
    a = {
        "total_loan_amt_in_last12_mon": tot("amt", "mso <= 12"),
        "total_loan_amt_3_years": tot("amt", "mso <= 36"),
        "mean_credit_unsecured_in_3_years": agg("avg", "amt", f"{USL} AND mso <= 36"),
        "total_loan_amt_pl_12m": tot("amt", f"{PL} AND mso <= 12"),
        "total_loan_amt_pl_3_years": tot("amt", f"{PL} AND mso <= 36"),
        "total_loan_amt_unsecured_12m": tot("amt", f"{USL} AND mso <= 12"),
        "total_loan_amt_unsecured_3y": tot("amt", f"{USL} AND mso <= 36"),
        "total_loan_amt_secured_3_years": tot("amt", f"{SEC} AND mso <= 36"),
        "mean_credit_pl_in_3_years": agg("avg", "amt", f"{PL} AND mso <= 36"),
        "mean_credit_all_in_12m": agg("avg", "amt", "mso <= 12"),
    }
    d = {
        "ratio_unsecured_to_total_vol_3y": over(
            "total_loan_amt_unsecured_3y", "total_loan_amt_3_years"
        ),
        "ratio_12m_to_3y_volume": over("total_loan_amt_in_last12_mon", "total_loan_amt_3_years"),
    }
    return a, d


def g03a() -> Group:
    rb = "CASE WHEN bal_now > 0 THEN bal_now ELSE 0 END"
    a = {
        "total_active_outstanding_debt": agg("sum", rb, "live"),
        "currentbalancedue": agg("sum", rb),
        "TotalOutstandingOnActiveSTPL": agg("sum", rb, "live AND stplq"),
        "curr_CL_agg_bal": agg("sum", rb, f"live AND {CL}"),
        "curr_PL_agg_bal": agg("sum", rb, f"live AND {PL}"),
        "curr_HL_agg_bal": agg("sum", rb, "live AND a = '195'"),
        "curr_CC_agg_bal": agg("sum", rb, f"live AND {CC}"),
        "max_agg_card_bal": agg("max", rb, CC),
    }
    return a, {}


def g03b() -> Group:
    a = {f"past_due_freq_last_{w}m": agg("avg", f"share{w}") for w in (3, 6, 12)}
    a |= {f"past_due_freq_cc_last_{w}m": agg("avg", f"share{w}", CC) for w in (3, 6, 12)}
    a |= {
        f"past_due_freq_pl_last_{w}m": agg("avg", f"share{w}", f"live AND {PL}")
        for w in (3, 6, 12)
    }
    a |= {
        "past_due_freq_stpl_last_12m": agg("avg", "share12", STPL),
        "past_due_freq_usl_last_12m": agg("avg", "share12", USL),
    }
    a |= {f"avg_cc_utilization_last_{w}m": agg("avg", f"cavg{w}") for w in (3, 6, 12, 36)}
    a |= {f"max_cc_utilization_last_{w}m": agg("max", f"cmax{w}") for w in (3, 6, 12, 36)}
    a |= {
        "total_past_due_active": agg("sum", "pdu", "live"),
        "total_past_due_all": agg("sum", "pdu"),
        "max_past_due_single_account": agg("max", "pdu"),
        "count_accounts_with_past_due": n("pdu > 0"),
        "count_cc_with_past_due": n(f"live AND {CC} AND pdu > 0"),
        "flag_any_past_due": yes("pdu > 0"),
        "flag_consistent_revolver": f"CAST(coalesce({exact('avg(share12)')} > 0.5, false) "
        "AS INTEGER)",
    }
    return a, {}


def g04() -> Group:
    sets = {"onactive": "live", "_gt_100k": "amt > 100000", "_unsecured": USL, "_pl": PL,
            "_cc": CC, "_active_pl": f"{PL} AND live"}
    a = {"meanbureauage": agg("avg", "mso")}
    a |= {f"meanbureauage{k}": agg("avg", "mso", v) for k, v in sets.items()}
    a |= {
        "bureage_overall": agg("max", "mso"),
        "bureage_pl": agg("max", "mso", PL),
        "bureage_cc": agg("max", "mso", CC),
        "burage_unsecured": agg("max", "mso", USL),
        "maxbureauage_gt_100k": agg("max", "mso", "amt > 100000"),
        "minbureauage": agg("min", "mso"),
        "minbureauage_active": agg("min", "mso", "live"),
        "count_accounts_gt_60m": n("mso > 60"),
        "count_accounts_gt_24m": n("mso > 24"),
        "age_range_months": real("max(mso) - min(mso)"),
        "ratio_mean_to_max_age": over("avg(mso)", "max(mso)"),
    }
    return a, {}


def g05() -> Group:
    nbf, pvt, pub = "l = 'NBF'", "l = 'PVT'", "l = 'PUB'"
    bank = "l IN ('PVT', 'PUB', 'FOR', 'RRB', 'SFB', 'COB')"
    ever = "mso IS NOT NULL"

    def pct(part: str, whole: str) -> str:
        return over(n(part), n(whole), "* 100")

    y3, y5 = "mso <= 36", "mso <= 60"
    a = {
        "no_of_CL_taken_from_nbfc_5_years": n(f"{CL} AND {nbf} AND {y5}"),
        "no_of_CL_taken_from_nbfc_3_years": n(f"{CL} AND {nbf} AND {y3}"),
        "no_of_nbfc_lt_10k_12m": n(f"{nbf} AND mso <= 12 AND amt < 10000"),
        "count_accounts_Pvt_bank": n(f"{pvt} AND {ever}"),
        "count_accounts_Pvt_bank_last24m": n(f"{pvt} AND mso <= 24"),
        "count_pl_Pvt_bank": n(f"{pvt} AND {PL} AND {ever}"),
        "count_pl_Pvt_bank_last24m": n(f"{pvt} AND {PL} AND mso <= 24"),
        "count_accounts_nbfc_alltime": n(f"{nbf} AND {ever}"),
        "count_accounts_nbfc_last24m": n(f"{nbf} AND mso <= 24"),
        "count_pl_nbfc_last24m": n(f"{nbf} AND {PL} AND mso <= 24"),
        "count_accounts_pub_bank": n(f"{pub} AND {ever}"),
        "count_accounts_mfi": n(f"l = 'MFI' AND {ever}"),
        "count_accounts_sfb": n(f"l = 'SFB' AND {ever}"),
        "flag_any_nbfc_last12m": yes(f"{nbf} AND mso <= 12"),
        "count_secured_loans_from_nbfc_3y": n(f"{nbf} AND {SEC} AND {y3}"),
        "count_unsecured_loans_from_nbfc_3y": n(f"{nbf} AND {USL} AND {y3}"),
        "count_secured_loans_from_bank_3y": n(f"{bank} AND {SEC} AND {y3}"),
        "count_unsecured_loans_from_bank_3y": n(f"{bank} AND {USL} AND {y3}"),
        "perc_PL_taken_from_nbfc_5_years": pct(f"{nbf} AND {PL} AND {y5}", f"{PL} AND {y5}"),
        "perc_CC_taken_from_prb_5_years": pct(f"{pvt} AND {CC} AND {y5}", f"{CC} AND {y5}"),
        "perc_PL_taken_from_nbfc_3_years": pct(f"{nbf} AND {PL} AND {y3}", f"{PL} AND {y3}"),
        "perc_CC_taken_from_prb_3_years": pct(f"{pvt} AND {CC} AND {y3}", f"{CC} AND {y3}"),
        "perc_accounts_from_nbfc_3y": pct(f"{nbf} AND {y3}", y3),
        "perc_accounts_from_bank_3y": pct(f"{bank} AND {y3}", y3),
        "ratio_nbfc_to_bank_count_3y": over(n(f"{nbf} AND {y3}"), n(f"{bank} AND {y3}")),
        "flag_nbfc_only_3y": when(f"{n(y3)} > 0 AND {n(f'{nbf} AND {y3}')} = {n(y3)}"),
        "perc_unsecured_from_nbfc_3y": pct(f"{nbf} AND {USL} AND {y3}", f"{USL} AND {y3}"),
        "perc_secured_from_bank_3y": pct(f"{bank} AND {SEC} AND {y3}", f"{SEC} AND {y3}"),
        "perc_accounts_from_pvt_bank_3y": pct(f"{pvt} AND {y3}", y3),
        "perc_accounts_from_pub_bank_3y": pct(f"{pub} AND {y3}", y3),
        "perc_pl_from_pvt_bank_3y": pct(f"{pvt} AND {PL} AND {y3}", f"{PL} AND {y3}"),
        "perc_pl_from_pub_bank_3y": pct(f"{pub} AND {PL} AND {y3}", f"{PL} AND {y3}"),
        "perc_pl_from_formal_bank_3y": pct(
            f"l IN ('PVT', 'PUB') AND {PL} AND {y3}", f"{PL} AND {y3}"
        ),
    }
    return a, {}


def g06a() -> Group:
    sets = {"cl": CL, "cc": CC, "pl": PL, "gl": GL, "hl": HL, "al": AL, "stpl": STPL,
            "any_active": "live", "nbfc": "l = 'NBF'",
            "pl_or_stpl": f"({PL} OR {STPL})"}
    a = {f"months_from_last_{k}": agg("min", "mso", v) for k, v in sets.items()}
    a |= {
        "months_from_last_any": agg("min", "mso"),
        "flag_pl_opened_last_3m": yes(f"{PL} AND mso <= 3"),
        "flag_cc_opened_last_6m": yes(f"{CC} AND mso <= 6"),
        "flag_any_opened_last_1m": yes("mso <= 1"),
        "count_products_ever": "count(DISTINCT CASE WHEN mso IS NOT NULL THEN a END)",
    }
    return a, {}


def g06b() -> Group:
    ever = "mso IS NOT NULL"
    mcf = "a IN ('167', '169', '170')"
    a = {
        "hasActiveTradeLineInLast12Months": yes("mso <= 12 AND live"),
        "hasActiveTradeLineInLast24Months": yes("mso <= 24 AND live"),
        "has_taken_PL_ever": yes(f"{PL} AND {ever}"),
        "has_taken_pl_5yrs": yes(f"{PL} AND mso <= 60"),
        "has_active_credit_card_flag": yes(f"{CC} AND live"),
        "mcf_user": yes(f"{mcf} AND {ever}"),
        "has_active_pl_flag": yes(f"{PL} AND live"),
        "has_active_stpl_flag": yes(f"{STPL} AND live"),
        "has_active_gl_flag": yes(f"{GL} AND live"),
        "has_active_hl_flag": yes(f"{HL} AND live"),
        "has_taken_hl_ever": yes(f"{HL} AND {ever}"),
        "has_taken_gl_ever": yes(f"{GL} AND {ever}"),
        "has_taken_cc_ever": yes(f"{CC} AND {ever}"),
        "has_taken_stpl_ever": yes(f"{STPL} AND {ever}"),
        "mcf_active_user": yes(f"{mcf} AND live"),
        "has_p2p_loan_ever": yes(f"a IN ('245', '246', '247') AND {ever}"),
        "has_taken_pl_last_12m": yes(f"{PL} AND mso <= 12"),
        "has_active_al_flag": yes(f"{AL} AND live"),
        "has_taken_al_ever": yes(f"{AL} AND {ever}"),
        "has_active_usl_flag": yes(f"{USL} AND live"),
        "has_taken_usl_ever": yes(f"{USL} AND {ever}"),
        "has_only_secured_credit": when(
            f"{n(f'{SEC} AND {ever}')} > 0 AND {n(f'{USL} AND {ever}')} = 0"
        ),
        "has_both_pl_and_cc": when(f"{n(f'{PL} AND {ever}')} > 0 AND {n(f'{CC} AND {ever}')} > 0"),
        "has_multiple_active_pl": when(f"{n(f'{PL} AND live')} >= 2"),
    }
    return a, {}


def g07() -> Group:
    def accounts(source: str, hit: str, where: str | None = None) -> str:
        keep = f"{source} IS NOT NULL" + (f" AND {where}" if where else "")
        return f"CAST(sum(CAST({source} {hit} AS INTEGER)) FILTER (WHERE {keep}) AS BIGINT)"

    a = {
        "max_dpd": agg("max", "dever"),
        "max_dpd_usl": agg("max", "dever", USL),
        "max_dpd_usl_gt50k": agg("max", "dever", f"{USL} AND amt > 50000"),
        "max_dpd_CC": agg("max", "dever", CC),
        "max_dpd_HL": agg("max", "dever", HL),
        "max_dpd_GL": agg("max", "dever", GL),
        "max_dpd_AL": agg("max", "dever", AL),
        "max_dpd_pl": agg("max", "dever", PL),
        "max_dpd_in_3_years": agg("max", "d36"),
        "max_dpd_in_12_months": agg("max", "d12"),
        "max_dpd_in_last_3_15_mon": agg("max", "d3_15"),
        "max_dpd_pl_12m": agg("max", "d12", PL),
        "max_dpd_pl_3y": agg("max", "d36", PL),
        "no_of_dpd_in_12_months": accounts("d12", "> 0"),
        "no_of_dpd30_in_12_months": accounts("d12", ">= 30"),
        "no_of_dpd60_in_12_months": accounts("d12", ">= 60"),
        "no_of_dpd90_in_12_months": accounts("d12", ">= 90"),
        "no_of_dpd_in_36_months": accounts("d36", "> 0"),
        "no_of_dpd30_pl_12m": accounts("d12", ">= 30", PL),
        "no_of_dpd_pl_36m": accounts("d36", "> 0", PL),
    }
    for w in (3, 6, 12):
        for lo, hi in ((10, 30), (30, 60), (60, 90)):
            a[f"is_{lo}to{hi}_last{w}_months"] = yes(f"d{w} >= {lo} AND d{w} < {hi}")
    for x in (180, 90, 60, 30):
        a[f"is_dpd_{x}"] = yes(f"dever >= {x}")
        a[f"is_dpd_{x}_last12m"] = yes(f"d12 >= {x}")
    a |= {
        "is_dpd_180_last36m": yes("d36 >= 180"),
        "is_dpd_90_last36m": yes("d36 >= 90"),
        "months_since_last_dpd30": agg("min", "far30"),
        "MostRecentDPDGT15Month": agg("min", "far15"),
        "MostRecentDPDGT0Month": agg("min", "far0"),
        "current_dpd": agg("max", "dnow", "live"),
        "current_dpd_due": agg("sum", "CASE WHEN due_raw > 0 THEN due_raw ELSE 0 END", "live"),
    }
    return a, {}


def g08a() -> Group:
    a = {f"payments_{w}_month": agg("sum", f"p{w}") for w in (3, 6, 12)}
    a |= {f"frequency_of_payments_{w}m": f"CAST(sum(pn{w}) AS BIGINT)" for w in (3, 6, 12)}
    for label, where in (("CreditCard", f"live AND {CC}"), ("PersonalLoan", f"live AND {PL}")):
        for w, suffix in ((36, ""), (12, "_12m"), (6, "_6m")):
            for side in ("max", "min"):
                name = f"{side.title()}RepaymentOnActive{label}Accounts{suffix}"
                a[name] = agg(side, f"p{side}{w}", where)
    parts = {"": "true", "cc_": f"live AND {CC}", "pl_": f"live AND {PL}",
             "stpl_": f"live AND {STPL}", "pl_gt30k_": f"live AND {PL} AND amt > 30000"}
    for part, where in parts.items():
        for w in (3, 6, 12):
            a[f"no_of_missed_payments_{part}last_{w}m"] = n(f"pl{w} <= 0 AND {where}")
    for part in ("", "stpl_", "pl_gt30k_"):
        for w in (3, 12):
            name = f"flag_missed_{part or 'payment_'}last_{w}m"
            a[name] = yes(f"pl{w} <= 0 AND {parts[part]}")
    a |= {
        "max_payment_last_12m": agg("max", "pmax12"),
        "mean_payment_last_12m": over("sum(p12)", "sum(pn12)"),
        "ratio_payment_3m_to_12m": over("sum(p3)", "sum(p12)"),
    }
    return a, {}


def g08b() -> Group:
    pct = "(1 - bal_now / amt)"
    a = {
        "RepaymentPercentageTotalSTPL": agg("avg", pct, STPL),
        "RepaymentPercentageActiveSTPL": agg("avg", pct, f"{STPL} AND live"),
        "Paid_ratio_unsecured": agg("avg", pct, USL),
        "RepaymentPercentageTotalPL": agg("avg", pct, PL),
        "RepaymentPercentageActivePL": agg("avg", pct, f"{PL} AND live"),
        "repayment_pct_all": agg("avg", pct),
        "repayment_pct_active": agg("avg", pct, "live"),
        "min_repayment_pct_active": agg("min", pct, "live"),
        "max_repayment_pct_active": agg("max", pct, "live"),
        "flag_fully_repaid_pl": yes(f"{PL} AND {pct} >= 1"),
        "flag_balance_grown_stpl": yes(f"{STPL} AND {pct} < 0"),
        "flag_balance_grown_pl": yes(f"{PL} AND {pct} < 0"),
        "count_stpl_fully_repaid": n(f"{STPL} AND {pct} >= 1"),
        "count_pl_fully_repaid": n(f"{PL} AND {pct} >= 1"),
        "ratio_repayment_pl_vs_stpl": over(
            f"avg({pct}) FILTER (WHERE {PL} AND live)",
            f"(avg({pct}) FILTER (WHERE {STPL} AND live))",
        ),
    }
    return a, {}


def g09() -> Group:
    owes = "coalesce(bal_now >= 0.08 * amt AND live, false)"

    def owed(product: str = "true") -> str:
        return agg("sum", f"CASE WHEN {owes} AND {product} THEN emi_final ELSE 0 END")

    a = {
        "obligations": owed(),
        "count_obligating_accounts": n(owes),
        **{f"obligations_{k}m": agg("sum", f"owed{k}") for k in (6, 12, 24)},
        "Max_obligations_paid_last12months": agg("max", "omax"),
        "mean_obligations_paid_last12months": agg("avg", "olast"),
        "obligations_pl": owed(PL),
        "obligations_hl": owed("a IN ('58', '195')"),
        "obligations_cc": owed(CC),
        "ratio_obligations_change_12m": over(
            f"sum(CASE WHEN {owes} THEN emi_final ELSE 0 END)", "sum(owed12)"
        ),
    }
    return a, {}


def g10() -> Group:
    a = {
        "suit_filed_willful_dflt": yes("is_suit OR is_wilful"),
        "wo": yes("is_wo"),
        **{f"wo_{y}_year" + "s" * (y > 1): yes(f"is_wo AND since_wo <= {12 * y}")
           for y in (5, 3, 1)},
        "flag_wilful_default": yes("is_wilful"),
        "flag_suit_filed": yes("is_suit"),
        "flag_settled": yes("is_settled"),
        "flag_restructured": yes("is_restr"),
        "flag_post_wo_settled": yes("is_post"),
        "flag_wo_active": yes("is_wo AND live"),
        "flag_wo_pl": yes(f"is_wo AND {PL}"),
        "flag_wo_stpl": yes(f"is_wo AND {STPL}"),
        "flag_wo_usl": yes(f"is_wo AND {USL}"),
        "count_wo_accounts": n("is_wo"),
        "count_suit_accounts": n("is_suit"),
        "total_charge_off_am": agg("sum", "wo_total", "is_wo"),
        "max_charge_off_am": agg("max", "wo_total", "is_wo"),
        "total_principal_wo_am": agg("sum", "wo_princ", "is_wo"),
        "max_principal_wo_am": agg("max", "wo_princ", "is_wo"),
        "total_settled_am": agg("sum", "settled", "is_settled"),
        "max_settled_am": agg("max", "settled", "is_settled"),
        "flag_partial_recovery": yes("is_settled AND settled < wo_total"),
        "months_since_last_wo": agg("min", "since_wo", "is_wo"),
        "months_since_last_suit": agg("min", "since_suit", "is_suit"),
    }
    d = {
        "ratio_principal_to_total_wo": over("total_principal_wo_am", "total_charge_off_am"),
        "ratio_settled_to_wo": over("total_settled_am", "total_charge_off_am"),
        "net_loss_am": real("total_charge_off_am - coalesce(total_settled_am, 0)"),
    }
    return a, d


def g12() -> Group:
    un = "p IN ('13', '11', '18', '8', '7')"
    a = {
        "total_enquiries": n("mse IS NOT NULL"),
        **{f"enquiry_in_last_{w}m": n(f"mse <= {w}") for w in (3, 6, 12, 24)},
        **{f"enquiry_pl_last_{w}m": n(f"p = '13' AND mse <= {w}") for w in (6, 12)},
        **{f"enquiry_cc_last_{w}m": n(f"p = '7' AND mse <= {w}") for w in (6, 12)},
        **{f"enquiry_unsecured_last_{w}m": n(f"{un} AND mse <= {w}") for w in (6, 12)},
        "enquiry_secured_last_12m": n(
            "p IN ('1', '2', '4', '5', '10', '14', '16') AND mse <= 12"
        ),
        **{f"enquiry_nbfc_last_{w}m": n(f"l = 'NBF' AND mse <= {w}") for w in (6, 12)},
        "enquiry_pvt_bank_last_12m": n("l = 'PVT' AND mse <= 12"),
        "months_since_last_enquiry": agg("min", "mse"),
        "months_since_last_pl_enquiry": agg("min", "mse", "p = '13'"),
        "months_since_last_cc_enquiry": agg("min", "mse", "p = '7'"),
        "flag_enquiry_last_1m": yes("mse <= 1"),
        "flag_pl_enquiry_last_3m": yes("p = '13' AND mse <= 3"),
        "flag_nbfc_enquiry_last_6m": yes("l = 'NBF' AND mse <= 6"),
        "ratio_unsecured_to_total_enq": over(n(f"{un} AND mse <= 12"), n("mse <= 12")),
        "ratio_nbfc_to_total_enq": over(n("l = 'NBF' AND mse <= 12"), n("mse <= 12")),
    }
    return a, {}


ACCOUNT_GROUPS = {
    "grp01_portfolio_counts": g01,
    "grp02a_loan_amount_exposure": g02a,
    "grp02b_credit_card_limits": g02b,
    "grp02c_highest_credit_signals": g02c,
    "grp02d_loan_volume_over_time": g02d,
    "grp03a_outstanding_balance": g03a,
    "grp03b_credit_utilization": g03b,
    "grp04_bureau_vintage": g04,
    "grp05_lender_mix": g05,
    "grp06a_recency_credit_activity": g06a,
    "grp06b_credit_behaviour_flags": g06b,
    "grp07_delinquency": g07,
    "grp08a_payment_behaviour": g08a,
    "grp08b_repayment_ratio": g08b,
    "grp09_obligations": g09,
    "grp10_severe_risk": g10,
}
ENQUIRY_GROUPS = {"grp12_enquiries": g12}
