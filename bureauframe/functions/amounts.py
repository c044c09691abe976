"""Instalment estimates and obligations, as SQL expressions."""

from __future__ import annotations

from bureauframe.functions import codes

# Monthly instalment as a share of the sanctioned amount, by product code.
INSTALMENT_RATES = (
    (codes.PERSONAL, 0.03),
    (codes.CARD, 0.05),
    (codes.HOME_MORTGAGE, 0.01),
    (("173", "189"), 0.05),
    (("47",), 0.025),
)
DEFAULT_INSTALMENT_RATE = 0.01
# These products pay monthly interest on the running balance.
INTEREST_ONLY_CODES = ("177", "199")
INTEREST_ONLY_RATE = 0.13 / 12
# A reported instalment above this share of the loan is a data error; an account
# still owes when its balance reaches this share of the loan.
MAX_INSTALMENT_SHARE = 0.9
MIN_BALANCE_SHARE = 0.08


def imputed_instalment(acct: str, loan: str, balance: str) -> str:
    branches = " ".join(
        f"WHEN {codes.one_of(acct, product)} THEN {share}D * {loan}"
        for product, share in INSTALMENT_RATES
    )
    return (
        f"CASE {branches} WHEN {codes.one_of(acct, INTEREST_ONLY_CODES)} "
        f"THEN {INTEREST_ONLY_RATE}D * {balance} ELSE {DEFAULT_INSTALMENT_RATE}D * {loan} END"
    )


def instalment(reported: str, acct: str, loan: str, balance: str) -> str:
    """Reported instalment when plausible, else the imputed one."""
    plausible = f"({loan} IS NULL OR {reported} <= {MAX_INSTALMENT_SHARE}D * {loan})"
    return (
        f"CASE WHEN {reported} > 0 AND {plausible} THEN {reported} "
        f"ELSE {imputed_instalment(acct, loan, balance)} END"
    )


def still_owes(balance: str, loan: str, is_open: str) -> str:
    return f"coalesce({balance} >= {MIN_BALANCE_SHARE}D * {loan} AND {is_open}, false)"


def open_on(opened: str, closed: str, day: str) -> str:
    return f"({opened} <= {day} AND ({closed} IS NULL OR {closed} > {day}))"
