"""Finance marts: loan, card and deposit portfolios, delinquency roll-forward.

Each portfolio groups a product table by product keys plus the owner's
segment. The segment comes from a join on customer_id: both sides are
shuffled once by the customer, a customer who owns a large share of the rows
is split by AQE's skew join (a partial aggregation follows the join, so the
split needs no further exchange), and one aggregation by the visible keys
ends the plan. Averages are (sum, count) pairs divided once at the end,
exactly. Money and rates are summed as exact integer units (cents, 1/10000)
in long arithmetic and turned back into decimals once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.functions import columns as C


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _segments(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select("customer_id", "customer_segment")


def _rollup(facts: DataFrame, stg_customers: DataFrame, keys: list[str],
            measures: list[F.Column]) -> DataFrame:
    """Attach the owner's segment and aggregate once by the keys."""
    return facts.join(_segments(stg_customers), "customer_id").groupBy(*keys).agg(*measures)


def loan_portfolio(stg_loans: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Loans by type, risk tier, status and segment.

    The status is a grouping key although the combined mart does not show
    it: statuses that share the tier 9_UNKNOWN give several rows with equal
    visible keys there.
    """
    measures = [
        F.count("loan_id").alias("loan_count"),
        F.sum(C.units("principal_amount")).alias("total_originated"),
        F.sum(C.units("outstanding_balance")).alias("total_outstanding"),
        F.sum(C.units("amount_paid_down")).alias("total_paid_down"),
        F.sum(C.units("interest_rate", 4)).alias("rate_sum"),
        F.count("interest_rate").alias("rate_n"),
        F.sum("loan_age_months").alias("age_sum"), F.count("loan_age_months").alias("age_n"),
        F.sum(F.when(F.col("is_delinquent"), C.units("outstanding_balance")).otherwise(0))
        .alias("delinquent_balance"),
        F.sum(F.when(F.col("is_charged_off"), C.units("outstanding_balance")).otherwise(0))
        .alias("charged_off_balance"),
        _count_if(F.col("is_delinquent")).alias("delinquent_count"),
        _count_if(F.col("is_charged_off")).alias("charged_off_count"),
    ]
    keys = ["loan_type", "risk_tier", "loan_status"]
    merged = _rollup(stg_loans, stg_customers, [*keys, "customer_segment"], measures)
    return merged.select(
        *keys, "customer_segment",
        F.col("loan_count").cast("bigint").alias("loan_count"),
        C.from_units("total_originated").alias("total_originated"),
        C.from_units("total_outstanding").alias("total_outstanding"),
        C.from_units("total_paid_down").alias("total_paid_down"),
        C.exact_avg(C.from_units("rate_sum", 4), "rate_n", 8, 4).alias("avg_interest_rate"),
        (F.col("age_sum").cast("double") / C.nonzero(F.col("age_n")).cast("double"))
        .alias("avg_loan_age_months"),
        C.from_units("delinquent_balance").alias("delinquent_balance"),
        C.from_units("charged_off_balance").alias("charged_off_balance"),
        F.col("delinquent_count").cast("bigint").alias("delinquent_count"),
        F.col("charged_off_count").cast("bigint").alias("charged_off_count"),
    )


def card_portfolio(stg_credit_cards: DataFrame, stg_customers: DataFrame) -> DataFrame:
    measures = [
        F.count("card_id").alias("card_count"),
        F.sum(C.units("credit_limit")).alias("total_credit_limit"),
        F.sum(C.units("current_balance")).alias("total_outstanding_balance"),
        F.sum(C.units("available_credit")).alias("total_available_credit"),
        F.sum(C.units("utilization_rate_pct")).alias("util_sum"),
        F.count("utilization_rate_pct").alias("util_n"),
        F.sum(C.units("annual_fee")).alias("total_annual_fees"),
        _count_if(F.col("is_active")).alias("active_cards"),
        _count_if(F.col("utilization_risk") == "HIGH").alias("high_utilization_cards"),
    ]
    keys = ["card_product", "utilization_risk"]
    merged = _rollup(stg_credit_cards, stg_customers, ["customer_segment", *keys], measures)
    return merged.select(
        "customer_segment", *keys,
        F.col("card_count").cast("bigint").alias("card_count"),
        C.from_units("total_credit_limit").alias("total_credit_limit"),
        C.from_units("total_outstanding_balance").alias("total_outstanding_balance"),
        C.from_units("total_available_credit").alias("total_available_credit"),
        C.exact_avg(C.from_units("util_sum"), "util_n", 6, 2).alias("avg_utilization_rate"),
        C.from_units("total_annual_fees").alias("total_annual_fees"),
        F.col("active_cards").cast("bigint").alias("active_cards"),
        F.col("high_utilization_cards").cast("bigint").alias("high_utilization_cards"),
    )


def deposit_portfolio(stg_accounts: DataFrame, stg_customers: DataFrame) -> DataFrame:
    measures = [
        F.count("account_id").alias("account_count"),
        _count_if(F.col("is_active")).alias("active_accounts"),
        F.sum(C.units("balance")).alias("total_balance"), F.count("balance").alias("balance_n"),
        F.sum(C.units("available_balance")).alias("total_available"),
        F.sum(C.units("interest_rate", 4)).alias("rate_sum"),
        F.count("interest_rate").alias("rate_n"),
    ]
    keys = ["account_type", "account_category"]
    merged = _rollup(stg_accounts, stg_customers, ["customer_segment", *keys], measures)
    return merged.select(
        "customer_segment", *keys,
        F.col("account_count").cast("bigint").alias("account_count"),
        F.col("active_accounts").cast("bigint").alias("active_accounts"),
        C.from_units("total_balance").alias("total_balance"),
        C.exact_avg(C.from_units("total_balance"), "balance_n", 6, 2).alias("avg_balance"),
        C.from_units("total_available").alias("total_available"),
        C.exact_avg(C.from_units("rate_sum", 4), "rate_n", 8, 4).alias("avg_interest_rate"),
    )


# The tiers pivoted into the delinquency roll-forward.
ROLL_FORWARD_TIERS = (
    ("1_CURRENT", "current_count"),
    ("2_DPD_30", "dpd_30_count"),
    ("3_DPD_60", "dpd_60_count"),
    ("4_DPD_90", "dpd_90_count"),
    ("5_CHARGED_OFF", "charged_off_count"),
)


def delinquency_summary(loan_portfolio_df: DataFrame) -> DataFrame:
    """Loan counts per tier side by side, per loan type and segment."""
    tier = F.col("risk_tier")
    counts = [F.sum(F.when(tier == t, F.col("loan_count")).otherwise(0)).cast("bigint").alias(name)
              for t, name in ROLL_FORWARD_TIERS]
    agg = loan_portfolio_df.groupBy("loan_type", "customer_segment").agg(
        *counts,
        F.sum("total_outstanding").cast(C.AMOUNT_SUM).alias("total_outstanding"),
        F.sum("delinquent_balance").cast(C.AMOUNT_SUM).alias("total_delinquent_balance"),
    )
    return agg.withColumn("delinquency_rate_pct",
                          C.pct("total_delinquent_balance", "total_outstanding"))


PORTFOLIO_COLUMNS = ("portfolio_type", "product", "customer_segment", "sub_category",
                     "record_count", "outstanding_balance", "avg_interest_rate",
                     "delinquent_balance", "delinquent_count", "utilization_rate")


def _typed_null(dtype: str) -> F.Column:
    return F.lit(None).cast(dtype)


def mart_portfolio_performance(loans: DataFrame, cards: DataFrame,
                               deposits: DataFrame) -> DataFrame:
    """Loan, card and deposit portfolios stacked into one table (union by name)."""
    loan_rows = loans.select(
        F.lit("LOAN").alias("portfolio_type"), F.col("loan_type").alias("product"),
        "customer_segment", F.col("risk_tier").alias("sub_category"),
        F.col("loan_count").alias("record_count"),
        F.col("total_outstanding").alias("outstanding_balance"),
        "avg_interest_rate", "delinquent_balance", "delinquent_count",
        _typed_null(C.MONEY_AVG).alias("utilization_rate"),
    )
    card_rows = cards.select(
        F.lit("CREDIT_CARD").alias("portfolio_type"), F.col("card_product").alias("product"),
        "customer_segment", F.col("utilization_risk").alias("sub_category"),
        F.col("card_count").alias("record_count"),
        F.col("total_outstanding_balance").alias("outstanding_balance"),
        _typed_null(C.RATE_AVG).alias("avg_interest_rate"),
        _typed_null(C.AMOUNT_SUM).alias("delinquent_balance"),
        _typed_null("bigint").alias("delinquent_count"),
        F.col("avg_utilization_rate").alias("utilization_rate"),
    )
    deposit_rows = deposits.select(
        F.lit("DEPOSIT").alias("portfolio_type"), F.col("account_type").alias("product"),
        "customer_segment", F.col("account_category").alias("sub_category"),
        F.col("account_count").alias("record_count"),
        F.col("total_balance").alias("outstanding_balance"),
        "avg_interest_rate",
        _typed_null(C.AMOUNT_SUM).alias("delinquent_balance"),
        _typed_null("bigint").alias("delinquent_count"),
        _typed_null(C.MONEY_AVG).alias("utilization_rate"),
    )
    return loan_rows.unionByName(card_rows).unionByName(deposit_rows)
