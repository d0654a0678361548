"""Staging: one projection + filter per raw table (clean, type, derive flags).

Each function is a pure ``DataFrame -> DataFrame`` transform, so Catalyst
inlines it into whatever reads it, prunes the columns nobody uses and pushes
filters down to the scan. No ``current_timestamp()`` here: the load time is
stamped only when a model is written (see ``bankmart.plans.pipeline``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.config import Config
from bankmart.functions import columns as C
from bankmart.functions import rules as R


def stg_customers(raw: DataFrame, cfg: Config) -> DataFrame:
    today = cfg.today()
    first, last = C.proper_case(C.clean("first_name")), C.proper_case(C.clean("last_name"))
    since = C.as_date("created_at")
    return raw.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        first.alias("first_name"),
        last.alias("last_name"),
        # plain concatenation: a missing part makes the whole name null
        F.concat(first, F.lit(" "), last).alias("full_name"),
        C.clean_lower("email").alias("email"),
        C.clean("phone").alias("phone"),
        C.clean_upper("customer_segment").alias("customer_segment"),
        C.clean_upper("acquisition_channel").alias("acquisition_channel"),
        C.clean_upper("state").alias("state"),
        C.clean_upper("zip_code").alias("zip_code"),
        since.alias("customer_since_date"),
        C.as_timestamp_ntz("updated_at").alias("updated_at"),
        C.flag(C.clean_upper("customer_segment") == "PREMIUM").alias("is_premium_customer"),
        C.flag(since >= C.years_before(today)).alias("is_new_customer"),
        C.days_between(since, today).alias("customer_tenure_days"),
    )


def stg_accounts(raw: DataFrame, cfg: Config) -> DataFrame:
    today = cfg.today()
    status, acct_type = C.clean_upper("account_status"), C.clean_upper("account_type")
    opened = C.as_date("opened_date")
    return raw.where(F.col("account_id").isNotNull()).select(
        "account_id",
        "customer_id",
        acct_type.alias("account_type"),
        status.alias("account_status"),
        C.clean_upper("currency_code").alias("currency_code"),
        C.money("balance").alias("balance"),
        C.money("available_balance").alias("available_balance"),
        C.rate("interest_rate").alias("interest_rate"),
        opened.alias("opened_date"),
        C.as_date("closed_date").alias("closed_date"),
        C.as_timestamp_ntz("updated_at").alias("updated_at"),
        C.flag(status == "ACTIVE").alias("is_active"),
        # closed needs both the status and a recorded closing date
        C.flag((status == "CLOSED") & F.col("closed_date").isNotNull()).alias("is_closed"),
        R.account_category(acct_type).alias("account_category"),
        C.days_between(opened, today).alias("account_age_days"),
    )


def stg_transactions(raw: DataFrame, cfg: Config) -> DataFrame:
    txn_type, status = C.clean_upper("transaction_type"), C.clean_upper("status")
    amount = C.money("amount")
    txn_date = C.as_date("transaction_date")
    return (
        raw.where(F.col("transaction_id").isNotNull()
                  & (F.col("transaction_date").cast("date") >= cfg.start()))
        .select(
            "transaction_id",
            "account_id",
            txn_type.alias("transaction_type"),
            status.alias("transaction_status"),
            C.clean_upper("channel").alias("channel"),
            C.clean("merchant_category_code").alias("merchant_category_code"),
            C.clean("description").alias("description"),
            R.signed_amount(txn_type, amount).alias("amount"),
            F.abs(amount).alias("amount_abs"),
            txn_date.alias("transaction_date"),
            C.month_start(txn_date).alias("transaction_month"),
            C.year_start(txn_date).alias("transaction_year"),
            C.day_of_week_sunday0(txn_date).alias("day_of_week"),
            C.as_date("posted_date").alias("posted_date"),
            C.as_timestamp_ntz("created_at").alias("created_at"),
            C.flag(status == "POSTED").alias("is_posted"),
            C.flag(txn_type == "REVERSAL").alias("is_reversal"),
            C.flag(txn_type == "FEE").alias("is_fee"),
        )
    )


def stg_loans(raw: DataFrame, cfg: Config) -> DataFrame:
    today = cfg.today()
    status = C.clean_upper("loan_status")
    principal, outstanding = C.money("principal_amount"), C.money("outstanding_balance")
    paid_down = principal - outstanding
    return raw.where(F.col("loan_id").isNotNull()).select(
        "loan_id",
        "customer_id",
        C.clean_upper("loan_type").alias("loan_type"),
        status.alias("loan_status"),
        principal.alias("principal_amount"),
        outstanding.alias("outstanding_balance"),
        C.rate("interest_rate").alias("interest_rate"),
        C.money("monthly_payment").alias("monthly_payment"),
        paid_down.cast(C.AMOUNT_SUM).alias("amount_paid_down"),
        C.pct(paid_down, principal).alias("pct_paid_down"),
        C.as_date("origination_date").alias("origination_date"),
        C.as_date("maturity_date").alias("maturity_date"),
        C.as_date("last_payment_date").alias("last_payment_date"),
        C.as_timestamp_ntz("updated_at").alias("updated_at"),
        # prefix match: an unlisted DELINQUENT_* status is delinquent yet 9_UNKNOWN
        R.is_delinquent(status).alias("is_delinquent"),
        C.flag(status == "CHARGED_OFF").alias("is_charged_off"),
        C.flag(status == "PAID_OFF").alias("is_paid_off"),
        R.risk_tier(status).alias("risk_tier"),
        C.months_between_boundaries(C.as_date("origination_date"), today).alias("loan_age_months"),
    )


def stg_credit_cards(raw: DataFrame, cfg: Config) -> DataFrame:
    today = cfg.today()
    limit, balance = C.money("credit_limit"), C.money("current_balance")
    return raw.where(F.col("card_id").isNotNull()).select(
        "card_id",
        "customer_id",
        C.clean_upper("card_status").alias("card_status"),
        C.clean_upper("card_product").alias("card_product"),
        C.clean_upper("rewards_program").alias("rewards_program"),
        limit.alias("credit_limit"),
        balance.alias("current_balance"),
        C.money("minimum_payment_due").alias("minimum_payment_due"),
        C.money("last_payment_amount").alias("last_payment_amount"),
        C.money("annual_fee").alias("annual_fee"),
        C.rate("interest_rate").alias("interest_rate"),
        C.pct(balance, limit).alias("utilization_rate_pct"),
        (limit - balance).cast(C.AMOUNT_SUM).alias("available_credit"),
        C.as_date("opened_date").alias("opened_date"),
        C.as_date("closed_date").alias("closed_date"),
        C.as_date("last_payment_date").alias("last_payment_date"),
        C.as_date("statement_close_date").alias("statement_close_date"),
        C.as_timestamp_ntz("updated_at").alias("updated_at"),
        C.flag(C.clean_upper("card_status") == "ACTIVE").alias("is_active"),
        # banded on the exact ratio, not on the rounded percentage
        R.utilization_band(balance, limit).alias("utilization_risk"),
        C.months_between_boundaries(C.as_date("opened_date"), today).alias("card_age_months"),
    )

