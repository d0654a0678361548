"""The public scalar functions applied to whole staged tables.

Each view evaluates one function on every row of the table it is meant for
(cards, loans, accounts), so it is exercised at full data size and can be
checked column by column against SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.config import Config
from bankmart.functions import macros


def fn_safe_divide(stg_credit_cards: DataFrame) -> DataFrame:
    """balance / limit per card, 0 for a zero or missing limit (6 places)."""
    ratio = macros.safe_divide("current_balance", "credit_limit")
    return stg_credit_cards.select(
        "card_id", "current_balance", "credit_limit",
        F.round(ratio, 6).cast("decimal(38,6)").alias("balance_to_limit"))


def fn_delinquency_bucket(stg_loans: DataFrame) -> DataFrame:
    return stg_loans.select("loan_id", "loan_status",
                            macros.delinquency_bucket("loan_status").alias("delinquency_bucket"))


def fn_utilization_risk(stg_credit_cards: DataFrame) -> DataFrame:
    return stg_credit_cards.select(
        "card_id", macros.utilization_risk("current_balance", "credit_limit")
        .alias("utilization_risk"))


def fn_months_since(stg_loans: DataFrame, cfg: Config) -> DataFrame:
    return stg_loans.select("loan_id", "origination_date",
                            macros.months_since("origination_date", cfg.today())
                            .alias("months_since"))


def fn_days_since(stg_accounts: DataFrame, cfg: Config) -> DataFrame:
    return stg_accounts.select("account_id", "opened_date",
                               macros.days_since("opened_date", cfg.today()).alias("days_since"))


def fn_surrogate_key(stg_accounts: DataFrame) -> DataFrame:
    """Key over (customer, account, closing date); open accounts hash the text NULL."""
    return stg_accounts.select(
        "account_id", "customer_id", "closed_date",
        macros.surrogate_key("customer_id", "account_id", "closed_date").alias("surrogate_key"))
