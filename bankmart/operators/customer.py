"""Customer 360: 12-month transaction activity joined onto the financial record.

Transactions are the only large fact. They are filtered to the rolling year
and collapsed to one row per account *before* the join with accounts; the
active months travel as a bit mask that later steps merge by OR, so the
path has three exchanges (account, accounts, customer) and every one moves at
most a row per account. A hot account is reduced map-side by partial
aggregation, a hot customer by the partial aggregation after the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.config import Config
from bankmart.functions import columns as C
from bankmart.functions import rules as R


# Months from the start of the window that one 64-bit mask holds.
MASK_MONTHS = 62


def txn_activity_12m(stg_transactions: DataFrame, stg_accounts: DataFrame,
                     cfg: Config) -> DataFrame:
    """Per customer: posted, non-reversal transactions of the last year.

    The window is ``>= today - 1 year`` with no upper bound (future-dated
    rows count), so up to 13 calendar months can be active. Transactions on
    unknown accounts drop out (inner join).
    """
    t = stg_transactions
    recent = t.where((F.col("transaction_date") >= C.years_before(cfg.today()))
                     & F.col("is_posted") & ~F.col("is_reversal"))
    # amounts are summed as exact cents (long arithmetic), turned back into
    # decimals once at the end
    amount_if = lambda kind: F.when(F.col("transaction_type") == kind,
                                    C.units("amount_abs")).otherwise(0)
    first = C.month_start(C.years_before(cfg.today()))
    month = C.months_between_boundaries(first, "transaction_date")
    near = F.col("transaction_date") < F.add_months(first, MASK_MONTHS)
    per_account = recent.groupBy("account_id").agg(
        F.count("transaction_id").alias("n"),
        F.sum(amount_if("DEBIT")).alias("spend"),
        F.sum(amount_if("FEE")).alias("fees"),
        F.max("transaction_date").alias("last_date"),
        F.bit_or(F.when(near, F.call_function("shiftleft", F.lit(1).cast("bigint"), month))).alias("months"),
    )
    owners = stg_accounts.select("account_id", "customer_id")
    per_owner = per_account.join(owners, "account_id").select(
        "customer_id", "n", "spend", "fees", "last_date", "months", F.lit(0).alias("far_months"))
    # Months that the mask does not reach (more than four years ahead) are
    # counted as distinct (customer, month) rows. The filter reaches the scan, so a
    # table without such dates costs its row-group statistics only.
    far = (recent.where(F.col("transaction_date") >= F.add_months(first, MASK_MONTHS))
           .select("account_id", "transaction_month").distinct().join(owners, "account_id")
           .select("customer_id", "transaction_month").distinct()
           .select("customer_id", F.lit(0).cast("bigint").alias("n"),
                   F.lit(0).cast("bigint").alias("spend"), F.lit(0).cast("bigint").alias("fees"),
                   F.lit(None).cast("date").alias("last_date"),
                   F.lit(None).cast("bigint").alias("months"), F.lit(1).alias("far_months")))
    return per_owner.unionByName(far).groupBy("customer_id").agg(
        F.sum("n").cast("bigint").alias("total_transactions_12m"),
        C.from_units(F.sum("spend")).alias("total_spend_12m"),
        C.from_units(F.sum("fees")).alias("total_fees_12m"),
        F.max("last_date").alias("last_transaction_date"),
        (F.coalesce(F.bit_count(F.bit_or("months")), F.lit(0))
         + F.coalesce(F.sum("far_months"), F.lit(0)))
        .cast("bigint").alias("active_months_12m"),
    )


FINANCIAL_PROFILE = (
    "customer_id", "full_name", "customer_segment", "acquisition_channel", "state",
    "customer_since_date", "customer_tenure_days", "is_premium_customer", "is_new_customer",
    "total_accounts", "active_accounts", "total_deposit_balance", "checking_balance",
    "savings_balance", "total_loans", "active_loans", "total_loan_balance", "total_cards",
    "active_cards", "total_credit_limit", "total_card_balance", "avg_utilization_rate",
    "total_relationship_value", "product_depth", "has_risk_flag",
)


def mart_customer_360(financials: DataFrame, activity: DataFrame, cfg: Config) -> DataFrame:
    """One row per staged customer: profile, activity, score and segments."""
    months = F.coalesce(F.col("active_months_12m"), F.lit(0))
    tenure, depth = F.col("customer_tenure_days"), F.col("product_depth")
    joined = financials.select(*FINANCIAL_PROFILE).join(activity, "customer_id", "left")
    return joined.select(
        *FINANCIAL_PROFILE,
        F.coalesce("total_transactions_12m", F.lit(0)).cast("bigint").alias("total_transactions_12m"),
        F.coalesce("total_spend_12m", F.lit(0)).cast(C.AMOUNT_SUM).alias("total_spend_12m"),
        F.coalesce("total_fees_12m", F.lit(0)).cast(C.AMOUNT_SUM).alias("total_fees_12m"),
        "last_transaction_date",
        months.cast("bigint").alias("active_months_12m"),
        R.engagement_score(months, depth, F.col("total_deposit_balance"),
                           F.col("is_premium_customer")).alias("engagement_score"),
        R.lifecycle_stage(tenure, months, depth).alias("lifecycle_stage"),
        R.ltv_tier(F.col("total_relationship_value")).alias("ltv_tier"),
        R.churn_risk(months, tenure).alias("churn_risk"),
        C.days_between("last_transaction_date", cfg.today()).alias("days_since_last_txn"),
    )
