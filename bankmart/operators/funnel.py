"""GTM marts over the customer 360: acquisition cohorts, channels, LTV mix.

All three are aggregations of the customer-grain mart into a handful of
groups (month x channel x segment at most), each a single shuffle of
partially aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.functions import columns as C
from bankmart.functions.rules import ONBOARDING_DAYS


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _avg_exact(c: str) -> F.Column:
    return C.exact_avg(F.sum(c), F.count(c), 6, 2)


def _stage() -> F.Column:
    return F.col("lifecycle_stage")


def _tenure() -> F.Column:
    return F.col("customer_tenure_days")


def _high_churn() -> F.Column:
    return F.col("churn_risk") == "HIGH"


def acquisition_cohorts(customer_360: DataFrame) -> DataFrame:
    """Customers by acquisition month, channel and segment.

    activation_rate_pct counts customers past onboarding among those with
    more than 90 days of tenure; since onboarding is exactly "tenure <= 90",
    the rate is always 100.00 or null. Kept as defined.
    """
    cohorts = customer_360.groupBy(
        C.month_start("customer_since_date").alias("cohort_month"),
        "acquisition_channel", "customer_segment",
    ).agg(
        F.count("customer_id").alias("new_customers"),
        _count_if(F.col("product_depth") >= 2).alias("multi_product_customers"),
        _count_if(_stage() == "ONBOARDING").alias("in_onboarding"),
        _count_if(_stage() == "DORMANT").alias("dormant"),
        _count_if(_stage() == "AT_RISK").alias("at_risk"),
        _count_if(_stage() == "ACTIVE").alias("active"),
        _count_if(_stage() == "LOYAL").alias("loyal"),
        _avg_exact("total_relationship_value").alias("avg_relationship_value"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        F.sum("total_spend_12m").cast(C.AMOUNT_SUM).alias("cohort_total_spend"),
        _count_if((_stage() != "ONBOARDING") & (_tenure() > ONBOARDING_DAYS)).alias("_activated"),
        _count_if(_tenure() > ONBOARDING_DAYS).alias("_seasoned"),
        _count_if(_high_churn()).alias("_high_churn"),
    )
    return cohorts.select(
        "cohort_month", "acquisition_channel", "customer_segment", "new_customers",
        "multi_product_customers", "in_onboarding", "dormant", "at_risk", "active", "loyal",
        "avg_relationship_value", "avg_engagement_score", "cohort_total_spend",
        C.count_pct("_activated", "_seasoned").alias("activation_rate_pct"),
        C.count_pct("_high_churn", "new_customers").alias("churn_risk_rate_pct"),
    )


def channel_summary(customer_360: DataFrame) -> DataFrame:
    """Per acquisition channel; the two rates are not rounded (6 places kept)."""
    agg = customer_360.groupBy("acquisition_channel").agg(
        F.count("customer_id").alias("total_customers"),
        _avg_exact("total_relationship_value").alias("avg_ltv"),
        F.avg("customer_tenure_days").alias("avg_tenure_days"),
        F.avg("product_depth").alias("avg_product_depth"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        _count_if(_stage() == "LOYAL").alias("_loyal"),
        _count_if(_high_churn()).alias("_high_churn"),
    )
    return agg.select(
        "acquisition_channel", "total_customers", "avg_ltv", "avg_tenure_days",
        "avg_product_depth", "avg_engagement_score",
        C.count_pct("_loyal", "total_customers", 6).alias("loyal_rate_pct"),
        C.count_pct("_high_churn", "total_customers", 6).alias("high_churn_rate_pct"),
    )


def ltv_distribution(customer_360: DataFrame) -> DataFrame:
    return customer_360.groupBy("ltv_tier", "customer_segment", "acquisition_channel").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("total_relationship_value").cast(C.AMOUNT_SUM).alias("total_value"),
        _avg_exact("total_relationship_value").alias("avg_value"),
        F.avg("customer_tenure_days").alias("avg_tenure_days"),
        F.avg("product_depth").alias("avg_product_depth"),
    )


FUNNEL_COLUMNS = ("record_type", "cohort_month", "acquisition_channel", "customer_segment",
                  "new_customers", "multi_product_customers", "active", "loyal", "dormant",
                  "at_risk", "activation_rate_pct", "churn_risk_rate_pct",
                  "avg_relationship_value", "avg_engagement_score", "cohort_total_spend")


def mart_acquisition_funnel(customer_360: DataFrame) -> DataFrame:
    """Cohort rows and channel rows in one table, from ONE pass over the customers.

    The two row kinds are aggregations of the same input at two grains, so
    they are computed as grouping sets ((month, channel, segment), (channel))
    of a single aggregate: each customer row feeds both grains before the
    map-side partial aggregation, and there is one shuffle instead of two
    independent computations of the customer 360. ``grouping_id() = 0``
    marks the cohort grain. The month is rendered as text; the channel rows
    carry the unrounded churn rate and nulls where a column has no meaning.
    """
    grain = customer_360.withColumn("cohort_month", C.month_start("customer_since_date"))
    agg = grain.groupingSets(
        [["cohort_month", "acquisition_channel", "customer_segment"], ["acquisition_channel"]],
        "cohort_month", "acquisition_channel", "customer_segment",
    ).agg(
        F.grouping_id().alias("_gid"),
        F.count("customer_id").alias("_n"),
        _count_if(F.col("product_depth") >= 2).alias("_multi"),
        _count_if(_stage() == "ACTIVE").alias("_active"),
        _count_if(_stage() == "LOYAL").alias("_loyal"),
        _count_if(_stage() == "DORMANT").alias("_dormant"),
        _count_if(_stage() == "AT_RISK").alias("_at_risk"),
        _count_if((_stage() != "ONBOARDING") & (_tenure() > ONBOARDING_DAYS)).alias("_activated"),
        _count_if(_tenure() > ONBOARDING_DAYS).alias("_seasoned"),
        _count_if(_high_churn()).alias("_high_churn"),
        _avg_exact("total_relationship_value").alias("_avg_value"),
        F.avg("engagement_score").alias("_avg_score"),
        F.sum("total_spend_12m").cast(C.AMOUNT_SUM).alias("_spend"),
    )
    cohort = F.col("_gid") == 0
    only_cohort = lambda c: F.when(cohort, c)
    return agg.select(
        F.when(cohort, F.lit("ACQUISITION_COHORT")).otherwise(F.lit("CHANNEL_SUMMARY"))
        .alias("record_type"),
        only_cohort(F.col("cohort_month").cast("string")).alias("cohort_month"),
        "acquisition_channel",
        only_cohort(F.col("customer_segment")).alias("customer_segment"),
        F.col("_n").alias("new_customers"),
        only_cohort(F.col("_multi")).alias("multi_product_customers"),
        only_cohort(F.col("_active")).alias("active"),
        only_cohort(F.col("_loyal")).alias("loyal"),
        only_cohort(F.col("_dormant")).alias("dormant"),
        only_cohort(F.col("_at_risk")).alias("at_risk"),
        only_cohort(C.count_pct("_activated", "_seasoned")).alias("activation_rate_pct"),
        F.when(cohort, C.count_pct("_high_churn", "_n").cast("decimal(38,6)"))
        .otherwise(C.count_pct("_high_churn", "_n", 6)).alias("churn_risk_rate_pct"),
        F.col("_avg_value").alias("avg_relationship_value"),
        F.col("_avg_score").alias("avg_engagement_score"),
        only_cohort(F.col("_spend")).alias("cohort_total_spend"),
    )
