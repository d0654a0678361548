"""Governance mart: completeness scorecards, certified KPI catalog, count tie-out.

The scorecards are global aggregates (one pass per table, partial
aggregation, no collect). The tie-out counts two relations in a single
aggregation over their tagged union, so no join is needed to put the two
counts side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart.functions import columns as C


def _nulls(c: str) -> F.Column:
    return F.count(F.when(F.col(c).isNull(), F.lit(1)))


def _complete(*cols: str) -> F.Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return F.count(F.when(cond, F.lit(1)))


def _scorecard(df: DataFrame, entity: str, null_counts: dict[str, str],
               required: tuple[str, ...]) -> DataFrame:
    agg = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[_nulls(c).alias(name) for name, c in null_counts.items()],
        _complete(*required).alias("_complete"),
    )
    return agg.select(
        F.lit(entity).alias("entity"), "total_records", *null_counts,
        C.count_pct("_complete", "total_records").alias("completeness_score_pct"),
    )


def dq_customers(stg_customers: DataFrame) -> DataFrame:
    return _scorecard(stg_customers, "CUSTOMERS", {
        "null_pk_count": "customer_id", "null_email_count": "email",
        "null_segment_count": "customer_segment", "null_channel_count": "acquisition_channel",
        "null_date_count": "customer_since_date",
    }, ("customer_id", "email", "customer_segment"))


def dq_accounts(stg_accounts: DataFrame) -> DataFrame:
    return _scorecard(stg_accounts, "ACCOUNTS", {
        "null_pk_count": "account_id", "null_fk_count": "customer_id",
        "null_balance_count": "balance", "null_type_count": "account_type",
        "null_status_count": "account_status",
    }, ("account_id", "customer_id", "balance"))


def dq_loans(stg_loans: DataFrame) -> DataFrame:
    return _scorecard(stg_loans, "LOANS", {
        "null_pk_count": "loan_id", "null_fk_count": "customer_id",
        "null_balance_count": "outstanding_balance", "null_rate_count": "interest_rate",
        "null_risk_tier_count": "risk_tier",
    }, ("loan_id", "customer_id", "outstanding_balance"))


SCORECARD_COLUMNS = ("entity", "total_records", "null_pk_count", "completeness_score_pct")


def dq_scorecard(*scorecards: DataFrame) -> DataFrame:
    """The entity scorecards stacked on their common columns.

    The key null count is always 0 here: staging already dropped null keys.
    """
    out = None
    for sc in scorecards:
        part = sc.select(*SCORECARD_COLUMNS)
        out = part if out is None else out.unionByName(part)
    return out


# The certified KPI catalog (name, definition, source mart,
# calculation logic, domain, status), in catalog order.
KPI_CATALOG = (
    ("TOTAL_ACTIVE_CUSTOMERS",
     "Count of customers with at least one active account and a transaction in the last 12 months.",
     "mart_customer_360", "lifecycle_stage != DORMANT", "GTM", "CERTIFIED"),
    ("CUSTOMER_CHURN_RATE",
     "Percentage of customers classified as DORMANT or AT_RISK out of total active customer base.",
     "mart_customer_360", "churn_risk IN (HIGH, MEDIUM)", "GTM", "CERTIFIED"),
    ("AVG_RELATIONSHIP_VALUE",
     "Average total relationship value (deposits + loans + card balances) per active customer.",
     "mart_customer_360", "total_relationship_value", "FINANCE", "CERTIFIED"),
    ("PORTFOLIO_DELINQUENCY_RATE",
     "Percentage of total outstanding loan balance that is 30+ days past due.",
     "mart_portfolio_performance", "delinquent_balance / outstanding_balance", "FINANCE",
     "CERTIFIED"),
    ("PRODUCT_DEPTH",
     "Average number of distinct product types (deposits, loans, cards) held per active customer.",
     "mart_customer_360", "product_depth", "GTM", "CERTIFIED"),
    ("CUSTOMER_ACQUISITION_CHANNEL_MIX",
     "Distribution of new customer acquisitions by channel (DIGITAL, BRANCH, REFERRAL, etc.).",
     "mart_customer_360", "acquisition_channel", "GTM", "CERTIFIED"),
    ("CREDIT_UTILIZATION_RATE",
     "Average credit card utilization rate (current balance / credit limit) across active cards.",
     "mart_portfolio_performance", "avg_utilization_rate", "FINANCE", "CERTIFIED"),
    ("DATA_COMPLETENESS_SCORE",
     "Percentage of records across all source entities meeting minimum completeness requirements.",
     "mart_kpi_governance", "completeness_score_pct", "GOVERNANCE", "CERTIFIED"),
)

KPI_SCHEMA = T.StructType([T.StructField(n, T.StringType(), False) for n in (
    "kpi_name", "kpi_definition", "source_mart", "calculation_logic", "domain", "status")])


def kpi_catalog(spark: SparkSession) -> DataFrame:
    """The eight certified KPI definitions as a (constant) relation."""
    return spark.createDataFrame(list(KPI_CATALOG), KPI_SCHEMA)


def sttm_reconciliation(source: DataFrame, mart: DataFrame,
                        check_name: str = "CUSTOMER_COUNT_TIE_OUT") -> DataFrame:
    """Row count of the staged source vs the mart, with variance and PASS/FAIL."""
    tagged = (source.select(F.lit(1).alias("_src"), F.lit(0).alias("_mart"))
              .unionByName(mart.select(F.lit(0).alias("_src"), F.lit(1).alias("_mart"))))
    counts = tagged.agg(F.coalesce(F.sum("_src"), F.lit(0)).cast("bigint").alias("source_count"),
                        F.coalesce(F.sum("_mart"), F.lit(0)).cast("bigint").alias("mart_count"))
    return counts.select(
        F.lit(check_name).alias("check_name"), "source_count", "mart_count",
        (F.col("source_count") - F.col("mart_count")).alias("variance"),
        F.when(F.col("source_count") == F.col("mart_count"), "PASS").otherwise("FAIL")
        .alias("status"),
    )


GOVERNANCE_COLUMNS = ("record_type", "dimension", "value_1", "value_2", "value_3")


def mart_kpi_governance(scorecards: list[DataFrame], catalog: DataFrame,
                        recon: DataFrame) -> DataFrame:
    """Scorecard, KPI and tie-out rows, every value rendered as text."""
    text = lambda c: F.col(c).cast("string")
    parts = [sc.select(F.lit("DQ_SCORECARD").alias("record_type"),
                       F.col("entity").alias("dimension"),
                       text("total_records").alias("value_1"),
                       text("completeness_score_pct").alias("value_2"),
                       text("null_pk_count").alias("value_3"))
             for sc in scorecards]
    parts.append(catalog.select(F.lit("KPI_DEFINITION").alias("record_type"),
                                F.col("kpi_name").alias("dimension"),
                                F.col("kpi_definition").alias("value_1"),
                                F.col("source_mart").alias("value_2"),
                                F.col("status").alias("value_3")))
    parts.append(recon.select(F.lit("STTM_RECON").alias("record_type"),
                              F.col("check_name").alias("dimension"),
                              text("source_count").alias("value_1"),
                              text("mart_count").alias("value_2"),
                              F.col("status").alias("value_3")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
