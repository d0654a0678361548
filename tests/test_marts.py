"""Mart invariants and fixture facts on the driver's sf0.001 tables."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankmart.config import FIXTURE_CONFIG
from bankmart.plans.project import Project
from bankmart.sources import fixtures


@pytest.fixture(scope="module")
def project(spark, sf_small):
    return Project(fixtures.raw_tables(spark, sf_small), FIXTURE_CONFIG)


def test_raw_table_sizes(project):
    counts = {name: df.count() for name, df in project.raw.items()}
    assert counts == {"customers": 150, "accounts": 750, "transactions": 6000, "loans": 375,
                      "credit_cards": 375}


def test_customer_360_one_row_per_customer(project):
    c360 = project.mart_customer_360
    assert c360.count() == project.stg_customers.count() == 150
    assert c360.select("customer_id").distinct().count() == 150


def test_customer_360_distributions(project):
    c360 = project.mart_customer_360
    stages = {r[0]: r[1] for r in c360.groupBy("lifecycle_stage").count().collect()}
    assert stages == {"ACTIVE": 65, "AT_RISK": 7, "DORMANT": 4, "LOYAL": 72, "ONBOARDING": 2}
    tiers = {r[0]: r[1] for r in c360.groupBy("ltv_tier").count().collect()}
    assert tiers == {"TIER_1_HIGH_VALUE": 56, "TIER_2_MID_VALUE": 92, "TIER_3_STANDARD": 2}
    churn = {r[0]: r[1] for r in c360.groupBy("churn_risk").count().collect()}
    assert churn == {"HIGH": 4, "MEDIUM": 2, "LOW": 144}
    depth = {r[0]: r[1] for r in c360.groupBy("product_depth").count().collect()}
    assert depth == {0: 1, 1: 6, 2: 43, 3: 100}
    agg = c360.agg(F.sum("total_relationship_value").alias("trv"),
                   F.sum("total_spend_12m").alias("spend"),
                   F.min("engagement_score").alias("lo"), F.max("engagement_score").alias("hi"),
                   F.sum(F.when(F.col("engagement_score") == 100, 1).otherwise(0)).alias("capped"),
                   ).first()
    assert agg.trv == Decimal("13603340.70") and agg.spend == Decimal("41836049.03")
    assert 0 <= agg.lo and agg.hi <= 100 and agg.capped == 100


def test_first_account_same_day_rule(project):
    assert project.int_customer_accounts.where("is_first_account").count() == 1


def test_loan_portfolio_keeps_hidden_status_key(project):
    lp = project.loan_portfolio
    assert lp.count() == 145
    assert lp.agg(F.sum("loan_count")).first()[0] == 375
    dupes = (project.mart_portfolio_performance.where("portfolio_type = 'LOAN'")
             .groupBy("product", "customer_segment", "sub_category").count()
             .where("count > 1").count())
    assert dupes == 14


def test_portfolio_counts_tie_to_joined_rows(project):
    mpp = project.mart_portfolio_performance
    per_type = {r[0]: r[1] for r in mpp.groupBy("portfolio_type").agg(F.sum("record_count")).collect()}
    joined = lambda df: df.join(project.stg_customers.select("customer_id"), "customer_id").count()
    assert per_type == {"LOAN": joined(project.stg_loans),
                        "CREDIT_CARD": joined(project.stg_credit_cards),
                        "DEPOSIT": joined(project.stg_accounts)}


def test_funnel_invariants(project):
    cohorts = project.acquisition_cohorts
    assert cohorts.agg(F.sum("new_customers")).first()[0] == 150
    rates = {r[0] for r in cohorts.select("activation_rate_pct").distinct().collect()}
    assert rates <= {Decimal("100.00"), None}             # implied by the onboarding rule
    funnel = project.mart_acquisition_funnel
    kinds = {r[0]: r[1] for r in funnel.groupBy("record_type").count().collect()}
    assert kinds["CHANNEL_SUMMARY"] == 5 and kinds["ACQUISITION_COHORT"] == cohorts.count()


def test_governance_rows(project):
    gov = {(r.record_type, r.dimension): r for r in project.mart_kpi_governance.collect()}
    assert len(gov) == 12
    assert gov[("DQ_SCORECARD", "CUSTOMERS")].value_1 == "150"
    assert gov[("DQ_SCORECARD", "CUSTOMERS")].value_3 == "0"   # staging already dropped null keys
    recon = gov[("STTM_RECON", "CUSTOMER_COUNT_TIE_OUT")]
    assert (recon.value_1, recon.value_2, recon.value_3) == ("150", "150", "PASS")
    assert sum(1 for k in gov if k[0] == "KPI_DEFINITION") == 8


def test_recon_fails_on_mismatch(spark, project):
    from bankmart.operators.governance import sttm_reconciliation

    row = sttm_reconciliation(project.stg_customers, project.mart_customer_360.limit(140)).first()
    assert (row.source_count, row.mart_count, row.variance, row.status) == (150, 140, 10, "FAIL")


def test_activity_prefers_pre_aggregation(project):
    """The 12-month activity never joins raw transactions to accounts row by row."""
    plan = project.txn_activity_12m._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join Inner")
    assert "Aggregate [account_id" in plan[join_at:]
