"""Intermediate layer: per-customer roll-ups and the customer x account view.

Every roll-up is a ``groupBy(customer_id)`` with partial (map-side)
aggregation, so a customer holding a third of all accounts is reduced to one
row per map task before the shuffle. The roll-ups come out hash-partitioned
by customer_id and the left joins that assemble the customer record reuse
that partitioning: only the customers side is exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.functions import columns as C


def _sum(c) -> F.Column:
    """Exact sum of a 2-place decimal, accumulated as long cents."""
    return C.from_units(F.sum(C.units(F.col(c) if isinstance(c, str) else c)))


def _count_if(cond) -> F.Column:
    """count(CASE WHEN cond THEN 1 END): null conditions are not counted."""
    return F.count(F.when(cond, F.lit(1)))


def avg_exact(c: str, places: int = 6, scale: int = 2) -> F.Column:
    """Average of a decimal column, rounded once, half away from zero."""
    return C.exact_avg(C.from_units(F.sum(C.units(c, scale)), scale), F.count(c), places, scale)


def account_summary(stg_accounts: DataFrame) -> DataFrame:
    return stg_accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_accounts"),
        _count_if(F.col("is_active")).alias("active_accounts"),
        _sum("balance").alias("total_deposit_balance"),
        C.from_units(F.sum(F.when(F.col("account_type") == "CHECKING", C.units("balance"))
                           .otherwise(0))).alias("checking_balance"),
        C.from_units(F.sum(F.when(F.col("account_type") == "SAVINGS", C.units("balance"))
                           .otherwise(0))).alias("savings_balance"),
        F.min("opened_date").alias("first_account_date"),
        F.max("opened_date").alias("latest_account_date"),
    )


def loan_summary(stg_loans: DataFrame) -> DataFrame:
    return stg_loans.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_loans"),
        _count_if(~F.col("is_paid_off") & ~F.col("is_charged_off")).alias("active_loans"),
        _sum("outstanding_balance").alias("total_loan_balance"),
        _sum("principal_amount").alias("total_loan_originated"),
        _count_if(F.col("is_delinquent")).alias("delinquent_loans"),
        _count_if(F.col("is_charged_off")).alias("charged_off_loans"),
        F.max("origination_date").alias("latest_loan_date"),
    )


def card_summary(stg_credit_cards: DataFrame) -> DataFrame:
    return stg_credit_cards.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_cards"),
        _count_if(F.col("is_active")).alias("active_cards"),
        _sum("credit_limit").alias("total_credit_limit"),
        _sum("current_balance").alias("total_card_balance"),
        avg_exact("utilization_rate_pct").alias("avg_utilization_rate"),
        F.max(C.flag_int(F.col("utilization_risk") == "HIGH")).alias("has_high_utilization"),
    )


CUSTOMER_IDENTITY = ("customer_id", "full_name", "customer_segment", "acquisition_channel",
                     "state", "customer_since_date", "customer_tenure_days",
                     "is_premium_customer", "is_new_customer")


def int_customer_accounts(stg_customers: DataFrame, stg_accounts: DataFrame) -> DataFrame:
    """One row per customer x account (inner join: accounts of unknown customers drop).

    This is row-level output, so nothing can be pre-aggregated; a customer
    with a huge share of accounts is handled by AQE's skew-join split of the
    accounts side.
    """
    c = stg_customers.select(*CUSTOMER_IDENTITY)
    a = stg_accounts.select(
        "customer_id", "account_id", "account_type", "account_category", "account_status",
        F.col("is_active").alias("account_is_active"),
        F.col("opened_date").alias("account_opened_date"),
        "account_age_days", "currency_code", "balance", "available_balance", "interest_rate",
    )
    return c.join(a, "customer_id").select(
        *CUSTOMER_IDENTITY,
        "account_id", "account_type", "account_category", "account_status",
        "account_is_active", "account_opened_date", "account_age_days", "currency_code",
        "balance", "available_balance", "interest_rate",
        C.days_between("customer_since_date", "account_opened_date").alias("days_to_account_open"),
        # several accounts (or none) may open on the customer's first day
        C.flag(F.col("account_opened_date") == F.col("customer_since_date"))
        .alias("is_first_account"),
    )


def int_customer_financials(stg_customers: DataFrame, accounts: DataFrame,
                            loans: DataFrame, cards: DataFrame) -> DataFrame:
    """Customer-grain financial record; ``accounts``/``loans``/``cards`` are the summaries."""
    zero = F.lit(0)

    def z(c: str):
        return F.coalesce(F.col(c), zero)

    joined = (stg_customers.select(*CUSTOMER_IDENTITY)
              .join(accounts, "customer_id", "left")
              .join(loans, "customer_id", "left")
              .join(cards, "customer_id", "left"))
    has = lambda c: F.when(z(c) > 0, 1).otherwise(0)
    return joined.select(
        *CUSTOMER_IDENTITY,
        z("total_accounts").alias("total_accounts"),
        z("active_accounts").alias("active_accounts"),
        z("total_deposit_balance").cast(C.AMOUNT_SUM).alias("total_deposit_balance"),
        z("checking_balance").cast(C.AMOUNT_SUM).alias("checking_balance"),
        z("savings_balance").cast(C.AMOUNT_SUM).alias("savings_balance"),
        "first_account_date",
        z("total_loans").alias("total_loans"),
        z("active_loans").alias("active_loans"),
        z("total_loan_balance").cast(C.AMOUNT_SUM).alias("total_loan_balance"),
        z("total_loan_originated").cast(C.AMOUNT_SUM).alias("total_loan_originated"),
        z("delinquent_loans").alias("delinquent_loans"),
        z("charged_off_loans").alias("charged_off_loans"),
        z("total_cards").alias("total_cards"),
        z("active_cards").alias("active_cards"),
        z("total_credit_limit").cast(C.AMOUNT_SUM).alias("total_credit_limit"),
        z("total_card_balance").cast(C.AMOUNT_SUM).alias("total_card_balance"),
        z("avg_utilization_rate").cast(C.MONEY_AVG).alias("avg_utilization_rate"),
        z("has_high_utilization").cast("int").alias("has_high_utilization"),
        (z("total_deposit_balance") + z("total_loan_balance") + z("total_card_balance"))
        .cast(C.AMOUNT_SUM).alias("total_relationship_value"),
        (has("active_accounts") + has("active_loans") + has("active_cards"))
        .cast("int").alias("product_depth"),
        ((z("delinquent_loans") > 0) | (z("charged_off_loans") > 0)
         | (z("has_high_utilization") == 1)).alias("has_risk_flag"),
    )
