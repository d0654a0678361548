"""Business classification rules as Column expressions.

Searched CASE chains become ``F.when`` chains: the first true branch wins,
a null condition is not true and falls through to the next branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankmart.functions.columns import flag, ratio_at_least

# Thresholds and labels of the classifiers.
HIGH_UTILIZATION = "0.90"
MEDIUM_UTILIZATION = "0.70"
ONBOARDING_DAYS = 90
LTV_TIER_1, LTV_TIER_2, LTV_TIER_3 = 100000, 25000, 5000
ENGAGEMENT_CAP = 100
ENGAGEMENT_POINTS_PER_ACTIVE_MONTH = 5
ENGAGEMENT_POINTS_PER_PRODUCT = 15
ENGAGEMENT_POINTS_HIGH_DEPOSITS = 20
ENGAGEMENT_HIGH_DEPOSIT_BALANCE = 10000
ENGAGEMENT_POINTS_PREMIUM = 10

RISK_TIER_BY_STATUS = (
    ("CURRENT", "1_CURRENT"),
    ("DELINQUENT_30", "2_DPD_30"),
    ("DELINQUENT_60", "3_DPD_60"),
    ("DELINQUENT_90", "4_DPD_90"),
    ("CHARGED_OFF", "5_CHARGED_OFF"),
    ("PAID_OFF", "0_PAID_OFF"),
)
UNKNOWN_RISK_TIER = "9_UNKNOWN"
DELINQUENT_PREFIX = "DELINQUENT"

ACCOUNT_CATEGORIES = (
    (("CHECKING", "SAVINGS", "MONEY_MARKET"), "DEPOSIT"),
    (("CD",), "TERM_DEPOSIT"),
    (("INVESTMENT",), "INVESTMENT"),
)
OTHER_ACCOUNT_CATEGORY = "OTHER"

CREDIT_TYPES = ("CREDIT", "INTEREST")   # amount made positive
DEBIT_TYPES = ("DEBIT", "FEE")          # amount made negative


def risk_tier(status: Column) -> Column:
    """Ordered delinquency tier of an (already standardised) loan status."""
    expr = None
    for value, tier in RISK_TIER_BY_STATUS:
        expr = F.when(status == value, tier) if expr is None else expr.when(status == value, tier)
    return expr.otherwise(UNKNOWN_RISK_TIER)


def is_delinquent(status: Column) -> Column:
    """Any status starting with DELINQUENT, including ones without a tier."""
    return flag(status.startswith(DELINQUENT_PREFIX))


def account_category(account_type: Column) -> Column:
    expr = None
    for types, category in ACCOUNT_CATEGORIES:
        cond = account_type.isin(*types)
        expr = F.when(cond, category) if expr is None else expr.when(cond, category)
    return expr.otherwise(OTHER_ACCOUNT_CATEGORY)


def signed_amount(txn_type: Column, amount: Column) -> Column:
    """Credits positive, debits negative, anything else as recorded."""
    return (F.when(txn_type.isin(*CREDIT_TYPES), F.abs(amount))
             .when(txn_type.isin(*DEBIT_TYPES), -F.abs(amount))
             .otherwise(amount))


def utilization_band(balance: Column, limit: Column) -> Column:
    """HIGH at >= 90 % of the limit, MEDIUM at >= 70 %, else LOW.

    A zero or null limit has no ratio and is LOW; a negative limit is compared
    on the true quotient (the inequality flips with the sign).
    """
    return (F.when(ratio_at_least(balance, limit, HIGH_UTILIZATION), "HIGH")
             .when(ratio_at_least(balance, limit, MEDIUM_UTILIZATION), "MEDIUM")
             .otherwise("LOW"))


def engagement_score(active_months: Column, product_depth: Column,
                     deposit_balance: Column, is_premium: Column) -> Column:
    """0-100: points for active months, products, high deposits and premium."""
    raw = (active_months * ENGAGEMENT_POINTS_PER_ACTIVE_MONTH
           + product_depth * ENGAGEMENT_POINTS_PER_PRODUCT
           + F.when(deposit_balance > ENGAGEMENT_HIGH_DEPOSIT_BALANCE,
                    ENGAGEMENT_POINTS_HIGH_DEPOSITS).otherwise(0)
           + F.when(is_premium, ENGAGEMENT_POINTS_PREMIUM).otherwise(0))
    return F.least(F.lit(ENGAGEMENT_CAP), raw).cast("int")


def lifecycle_stage(tenure_days: Column, active_months: Column, product_depth: Column) -> Column:
    """First match wins: new customers are onboarding whatever their activity."""
    return (F.when(tenure_days <= ONBOARDING_DAYS, "ONBOARDING")
             .when(active_months == 0, "DORMANT")
             .when(active_months <= 3, "AT_RISK")
             .when((product_depth >= 2) & (active_months >= 9), "LOYAL")
             .otherwise("ACTIVE"))


def ltv_tier(relationship_value: Column) -> Column:
    return (F.when(relationship_value >= LTV_TIER_1, "TIER_1_HIGH_VALUE")
             .when(relationship_value >= LTV_TIER_2, "TIER_2_MID_VALUE")
             .when(relationship_value >= LTV_TIER_3, "TIER_3_STANDARD")
             .otherwise("TIER_4_LOW_VALUE"))


def churn_risk(active_months: Column, tenure_days: Column) -> Column:
    return (F.when((active_months == 0) & (tenure_days > ONBOARDING_DAYS), "HIGH")
             .when(active_months <= 2, "MEDIUM")
             .otherwise("LOW"))
