"""The model graph: every model as a lazily built DataFrame.

``Project`` wires the pure transforms of ``bankmart.operators`` together.
Nothing runs until an action; a model used by several others is one Python
object, so Catalyst sees one subplan (and reuses its exchanges). Any model
can be replaced by a stored table through ``overrides`` — the pipeline does
this after writing a table so downstream models read the table instead of
recomputing it (a table boundary that also cuts lineage).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from bankmart.config import Config
from bankmart.operators import (checks, customer, function_views, funnel, governance,
                                portfolio, rollups, staging)
from bankmart.sources import schemas
from bankmart.sources.raw import RawTables


class Project:
    def __init__(self, raw: RawTables, cfg: Config | None = None,
                 overrides: Mapping[str, DataFrame] | None = None):
        self.raw = raw
        self.cfg = cfg or Config()
        self.overrides = dict(overrides or {})

    @property
    def spark(self) -> SparkSession:
        return self.raw.customers.sparkSession

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    MODEL_NAMES = (
        "stg_customers", "stg_accounts", "stg_transactions", "stg_loans", "stg_credit_cards",
        "account_summary", "loan_summary", "card_summary", "int_customer_accounts",
        "int_customer_financials", "txn_activity_12m", "mart_customer_360",
        "acquisition_cohorts", "channel_summary", "ltv_distribution", "mart_acquisition_funnel",
        "loan_portfolio", "card_portfolio", "deposit_portfolio", "delinquency_summary",
        "mart_portfolio_performance", "dq_customers", "dq_accounts", "dq_loans",
        "dq_scorecard", "kpi_catalog", "sttm_reconciliation", "mart_kpi_governance",
    )

    def register_views(self, prefix: str = "") -> list[str]:
        """Register every model as a temp view (``<prefix><model>``) for SQL users.

        Views are lazy: a query on one runs the model's plan, nothing is built.
        """
        names = []
        for name in self.MODEL_NAMES:
            self.model(name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def _pick(self, name: str, build) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        return build()

    # --- staging ----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._pick("stg_customers",
                          lambda: staging.stg_customers(self.raw.customers, self.cfg))

    @cached_property
    def stg_accounts(self) -> DataFrame:
        return self._pick("stg_accounts",
                          lambda: staging.stg_accounts(self.raw.accounts, self.cfg))

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return self._pick("stg_transactions",
                          lambda: staging.stg_transactions(self.raw.transactions, self.cfg))

    @cached_property
    def stg_loans(self) -> DataFrame:
        return self._pick("stg_loans", lambda: staging.stg_loans(self.raw.loans, self.cfg))

    @cached_property
    def stg_credit_cards(self) -> DataFrame:
        return self._pick("stg_credit_cards",
                          lambda: staging.stg_credit_cards(self.raw.credit_cards, self.cfg))

    # --- intermediate -----------------------------------------------------
    @cached_property
    def account_summary(self) -> DataFrame:
        return rollups.account_summary(self.stg_accounts)

    @cached_property
    def loan_summary(self) -> DataFrame:
        return rollups.loan_summary(self.stg_loans)

    @cached_property
    def card_summary(self) -> DataFrame:
        return rollups.card_summary(self.stg_credit_cards)

    @cached_property
    def int_customer_accounts(self) -> DataFrame:
        return self._pick("int_customer_accounts", lambda: rollups.int_customer_accounts(
            self.stg_customers, self.stg_accounts))

    @cached_property
    def int_customer_financials(self) -> DataFrame:
        return self._pick("int_customer_financials", lambda: rollups.int_customer_financials(
            self.stg_customers, self.account_summary, self.loan_summary, self.card_summary))

    # --- customer 360 and GTM ---------------------------------------------
    @cached_property
    def txn_activity_12m(self) -> DataFrame:
        return customer.txn_activity_12m(self.stg_transactions, self.stg_accounts, self.cfg)

    @cached_property
    def mart_customer_360(self) -> DataFrame:
        return self._pick("mart_customer_360", lambda: customer.mart_customer_360(
            self.int_customer_financials, self.txn_activity_12m, self.cfg))

    @cached_property
    def acquisition_cohorts(self) -> DataFrame:
        return funnel.acquisition_cohorts(self.mart_customer_360)

    @cached_property
    def channel_summary(self) -> DataFrame:
        return funnel.channel_summary(self.mart_customer_360)

    @cached_property
    def ltv_distribution(self) -> DataFrame:
        return funnel.ltv_distribution(self.mart_customer_360)

    @cached_property
    def mart_acquisition_funnel(self) -> DataFrame:
        return self._pick("mart_acquisition_funnel",
                          lambda: funnel.mart_acquisition_funnel(self.mart_customer_360))

    # --- finance ----------------------------------------------------------
    @cached_property
    def loan_portfolio(self) -> DataFrame:
        return portfolio.loan_portfolio(self.stg_loans, self.stg_customers)

    @cached_property
    def card_portfolio(self) -> DataFrame:
        return portfolio.card_portfolio(self.stg_credit_cards, self.stg_customers)

    @cached_property
    def deposit_portfolio(self) -> DataFrame:
        return portfolio.deposit_portfolio(self.stg_accounts, self.stg_customers)

    @cached_property
    def delinquency_summary(self) -> DataFrame:
        return portfolio.delinquency_summary(self.loan_portfolio)

    @cached_property
    def mart_portfolio_performance(self) -> DataFrame:
        return self._pick("mart_portfolio_performance",
                          lambda: portfolio.mart_portfolio_performance(
                              self.loan_portfolio, self.card_portfolio, self.deposit_portfolio))

    # --- governance -------------------------------------------------------
    @cached_property
    def dq_customers(self) -> DataFrame:
        return governance.dq_customers(self.stg_customers)

    @cached_property
    def dq_accounts(self) -> DataFrame:
        return governance.dq_accounts(self.stg_accounts)

    @cached_property
    def dq_loans(self) -> DataFrame:
        return governance.dq_loans(self.stg_loans)

    @cached_property
    def dq_scorecard(self) -> DataFrame:
        return governance.dq_scorecard(self.dq_customers, self.dq_accounts, self.dq_loans)

    @cached_property
    def kpi_catalog(self) -> DataFrame:
        return governance.kpi_catalog(self.spark)

    @cached_property
    def sttm_reconciliation(self) -> DataFrame:
        return governance.sttm_reconciliation(self.stg_customers, self.mart_customer_360)

    @cached_property
    def mart_kpi_governance(self) -> DataFrame:
        return self._pick("mart_kpi_governance", lambda: governance.mart_kpi_governance(
            [self.dq_customers, self.dq_accounts, self.dq_loans], self.kpi_catalog,
            self.sttm_reconciliation))

    # --- data tests -------------------------------------------------------
    def _test_tables(self) -> dict[str, DataFrame]:
        tables = dict(self.raw.items())
        tables["mart_customer_360"] = self.mart_customer_360
        return tables

    @cached_property
    def src_row_counts(self) -> DataFrame:
        return checks.source_row_counts(dict(self.raw.items()))

    @cached_property
    def chk_unique(self) -> DataFrame:
        return checks.unique(self._test_tables(), schemas.SOURCE_TESTS + schemas.MART_TESTS)

    @cached_property
    def chk_not_null(self) -> DataFrame:
        return checks.not_null(self._test_tables(), schemas.SOURCE_TESTS + schemas.MART_TESTS)

    @cached_property
    def chk_accepted_values(self) -> DataFrame:
        return checks.accepted_values(self._test_tables(),
                                      schemas.SOURCE_TESTS + schemas.MART_TESTS)

    @cached_property
    def chk_relationships(self) -> DataFrame:
        return checks.relationships(dict(self.raw.items()), schemas.SOURCE_TESTS)

    @cached_property
    def chk_freshness(self) -> DataFrame:
        return checks.freshness(dict(self.raw.items()), schemas.FRESHNESS_TESTS, self.cfg)

    # --- public functions over whole tables --------------------------------
    @cached_property
    def fn_safe_divide(self) -> DataFrame:
        return function_views.fn_safe_divide(self.stg_credit_cards)

    @cached_property
    def fn_delinquency_bucket(self) -> DataFrame:
        return function_views.fn_delinquency_bucket(self.stg_loans)

    @cached_property
    def fn_utilization_risk(self) -> DataFrame:
        return function_views.fn_utilization_risk(self.stg_credit_cards)

    @cached_property
    def fn_months_since(self) -> DataFrame:
        return function_views.fn_months_since(self.stg_loans, self.cfg)

    @cached_property
    def fn_days_since(self) -> DataFrame:
        return function_views.fn_days_since(self.stg_accounts, self.cfg)

    @cached_property
    def fn_days_since_today(self) -> DataFrame:
        """The same with "today" left open: the date of the query, whatever the run is pinned to."""
        return function_views.fn_days_since(self.stg_accounts, replace(self.cfg, as_of=None))

    @cached_property
    def fn_surrogate_key(self) -> DataFrame:
        return function_views.fn_surrogate_key(self.stg_accounts)

    def all_tests(self) -> DataFrame:
        """Every declared source and mart test, one row each, in one DataFrame."""
        return checks.all_tests(self._test_tables(), schemas.SOURCE_TESTS + schemas.MART_TESTS)

    def source_tests(self) -> dict[str, DataFrame]:
        """Only the raw-source tests (what a source test run executes)."""
        raw = dict(self.raw.items())
        specs = schemas.SOURCE_TESTS
        return {"unique": checks.unique(raw, specs), "not_null": checks.not_null(raw, specs),
                "accepted_values": checks.accepted_values(raw, specs),
                "relationships": checks.relationships(raw, specs)}
