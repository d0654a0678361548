"""Output contracts: the columns of every model, in order."""

from __future__ import annotations

import pytest

from bankmart.config import FIXTURE_CONFIG
from bankmart.operators import checks, funnel, governance, portfolio
from bankmart.plans.project import Project
from bankmart.sources import fixtures, schemas

CONTRACTS = {
    "stg_customers": "customer_id first_name last_name full_name email phone customer_segment "
                     "acquisition_channel state zip_code customer_since_date updated_at "
                     "is_premium_customer is_new_customer customer_tenure_days",
    "stg_accounts": "account_id customer_id account_type account_status currency_code balance "
                    "available_balance interest_rate opened_date closed_date updated_at is_active "
                    "is_closed account_category account_age_days",
    "stg_transactions": "transaction_id account_id transaction_type transaction_status channel "
                        "merchant_category_code description amount amount_abs transaction_date "
                        "transaction_month transaction_year day_of_week posted_date created_at "
                        "is_posted is_reversal is_fee",
    "stg_loans": "loan_id customer_id loan_type loan_status principal_amount outstanding_balance "
                 "interest_rate monthly_payment amount_paid_down pct_paid_down origination_date "
                 "maturity_date last_payment_date updated_at is_delinquent is_charged_off "
                 "is_paid_off risk_tier loan_age_months",
    "stg_credit_cards": "card_id customer_id card_status card_product rewards_program "
                        "credit_limit current_balance minimum_payment_due last_payment_amount "
                        "annual_fee interest_rate utilization_rate_pct available_credit "
                        "opened_date closed_date last_payment_date statement_close_date "
                        "updated_at is_active utilization_risk card_age_months",
    "int_customer_accounts": "customer_id full_name customer_segment acquisition_channel state "
                             "customer_since_date customer_tenure_days is_premium_customer "
                             "is_new_customer account_id account_type account_category "
                             "account_status account_is_active account_opened_date "
                             "account_age_days currency_code balance available_balance "
                             "interest_rate days_to_account_open is_first_account",
    "int_customer_financials": "customer_id full_name customer_segment acquisition_channel state "
                               "customer_since_date customer_tenure_days is_premium_customer "
                               "is_new_customer total_accounts active_accounts "
                               "total_deposit_balance checking_balance savings_balance "
                               "first_account_date total_loans active_loans total_loan_balance "
                               "total_loan_originated delinquent_loans charged_off_loans "
                               "total_cards active_cards total_credit_limit total_card_balance "
                               "avg_utilization_rate has_high_utilization "
                               "total_relationship_value product_depth has_risk_flag",
    "mart_customer_360": "customer_id full_name customer_segment acquisition_channel state "
                         "customer_since_date customer_tenure_days is_premium_customer "
                         "is_new_customer total_accounts active_accounts total_deposit_balance "
                         "checking_balance savings_balance total_loans active_loans "
                         "total_loan_balance total_cards active_cards total_credit_limit "
                         "total_card_balance avg_utilization_rate total_relationship_value "
                         "product_depth has_risk_flag total_transactions_12m total_spend_12m "
                         "total_fees_12m last_transaction_date active_months_12m "
                         "engagement_score lifecycle_stage ltv_tier churn_risk "
                         "days_since_last_txn",
    "mart_acquisition_funnel": " ".join(funnel.FUNNEL_COLUMNS),
    "mart_portfolio_performance": " ".join(portfolio.PORTFOLIO_COLUMNS),
    "mart_kpi_governance": " ".join(governance.GOVERNANCE_COLUMNS),
    "delinquency_summary": "loan_type customer_segment current_count dpd_30_count dpd_60_count "
                           "dpd_90_count charged_off_count total_outstanding "
                           "total_delinquent_balance delinquency_rate_pct",
    "dq_scorecard": " ".join(governance.SCORECARD_COLUMNS),
    "chk_unique": " ".join(checks.RESULT_COLUMNS),
    "chk_not_null": " ".join(checks.RESULT_COLUMNS),
    "chk_accepted_values": " ".join(checks.RESULT_COLUMNS),
    "chk_relationships": " ".join(checks.RESULT_COLUMNS),
    "chk_freshness": " ".join(checks.FRESHNESS_COLUMNS),
}


@pytest.fixture(scope="module")
def project(spark, sf_small):
    return Project(fixtures.raw_tables(spark, sf_small), FIXTURE_CONFIG)


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_columns_in_order(project, name):
    assert project.model(name).columns == CONTRACTS[name].split()


def test_every_key_has_unique_and_not_null_tests():
    declared = {(type(t).__name__, t.table, t.column) for t in schemas.SOURCE_TESTS}
    for table, key in schemas.PRIMARY_KEYS.items():
        assert ("Unique", table, key) in declared and ("NotNull", table, key) in declared
