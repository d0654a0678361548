"""The pre-aggregating plans equal the plain join-then-aggregate formulations.

Random data with the cases the fixture does not have: duplicated account and
customer keys (joins that multiply rows), null keys, null amounts, and one
key holding a large share of the rows.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankmart.config import Config
from bankmart.functions import columns as C
from bankmart.operators import customer, portfolio, staging
from bankmart.sources import schemas

CFG = Config(as_of=dt.date(2024, 6, 15), start_date="2020-01-01")

accounts_st = st.lists(st.tuples(st.sampled_from(["A1", "A2", "A3", "A4", None]),
                                 st.sampled_from(["C1", "C2", "C3", None])),
                       min_size=1, max_size=12)
txns_st = st.lists(st.tuples(
    st.sampled_from(["A1", "A1", "A1", "A2", "A3", "A9", None]),          # A1 is hot
    st.sampled_from(["DEBIT", "FEE", "CREDIT", "REVERSAL"]),
    st.sampled_from(["POSTED", "POSTED", "PENDING"]),
    st.one_of(st.none(), st.integers(-50000, 50000)),
    st.integers(-500, 200)), min_size=0, max_size=60)


def _accounts(spark, rows):
    return staging.stg_accounts(spark.createDataFrame(
        [(a, c, "CHECKING", "ACTIVE", "USD", Decimal("1.00"), Decimal("1.00"),
          Decimal("0.0100"), dt.date(2020, 1, 1), None, None) for a, c in rows],
        schemas.ACCOUNTS), CFG)


def _naive_activity(t, a):
    recent = t.where((F.col("transaction_date") >= C.years_before(CFG.today()))
                     & F.col("is_posted") & ~F.col("is_reversal"))
    joined = recent.join(a.select("account_id", "customer_id"), "account_id")
    kind = lambda k: F.when(F.col("transaction_type") == k, F.col("amount_abs")).otherwise(0)
    return joined.groupBy("customer_id").agg(
        F.count("transaction_id").cast("bigint").alias("total_transactions_12m"),
        F.sum(kind("DEBIT")).cast(C.AMOUNT_SUM).alias("total_spend_12m"),
        F.sum(kind("FEE")).cast(C.AMOUNT_SUM).alias("total_fees_12m"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.countDistinct("transaction_month").alias("active_months_12m"))


@settings(max_examples=15, deadline=None)
@given(accounts_st, txns_st)
def test_activity_equals_join_then_aggregate(spark, account_rows, txn_rows):
    a = _accounts(spark, account_rows)
    raw = [(f"t{i}", acct, typ, status, None if amt is None else Decimal(amt) / 100,
            CFG.as_of + dt.timedelta(days=off), None, None)
           for i, (acct, typ, status, amt, off) in enumerate(txn_rows)]
    t = staging.stg_transactions(spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], "ATM", "0001", "x", r[4], r[5], r[5], None) for r in raw],
        schemas.TRANSACTIONS), CFG)
    built = Counter(tuple(r) for r in customer.txn_activity_12m(t, a, CFG).collect())
    naive = Counter(tuple(r) for r in _naive_activity(t, a).collect())
    assert built == naive


loans_st = st.lists(st.tuples(
    st.sampled_from(["C1", "C1", "C1", "C2", "C3", None]),
    st.sampled_from(["AUTO", "PERSONAL"]),
    st.sampled_from(["CURRENT", "DELINQUENT_30", "DELINQUENT_120", "CHARGED_OFF", None]),
    st.one_of(st.none(), st.integers(0, 10**7)),
    st.one_of(st.none(), st.integers(0, 10**7)),
    st.one_of(st.none(), st.integers(0, 3000))), min_size=0, max_size=40)
customers_st = st.lists(st.tuples(st.sampled_from(["C1", "C2", "C3", "C4"]),
                                  st.sampled_from(["RETAIL", "PREMIUM", None])),
                        min_size=1, max_size=8)


def _naive_loan_portfolio(loans, custs):
    j = loans.join(custs.select("customer_id", "customer_segment"), "customer_id")
    return j.groupBy("loan_type", "risk_tier", "loan_status", "customer_segment").agg(
        F.count("loan_id").cast("bigint").alias("loan_count"),
        F.sum("principal_amount").cast(C.AMOUNT_SUM).alias("total_originated"),
        F.sum("outstanding_balance").cast(C.AMOUNT_SUM).alias("total_outstanding"),
        F.sum("amount_paid_down").cast(C.AMOUNT_SUM).alias("total_paid_down"),
        C.exact_avg(F.sum("interest_rate"), F.count("interest_rate"), 8, 4)
        .alias("avg_interest_rate"),
        F.avg("loan_age_months").alias("avg_loan_age_months"),
        F.sum(F.when(F.col("is_delinquent"), F.col("outstanding_balance")).otherwise(0))
        .cast(C.AMOUNT_SUM).alias("delinquent_balance"),
        F.sum(F.when(F.col("is_charged_off"), F.col("outstanding_balance")).otherwise(0))
        .cast(C.AMOUNT_SUM).alias("charged_off_balance"),
        F.count(F.when(F.col("is_delinquent"), 1)).cast("bigint").alias("delinquent_count"),
        F.count(F.when(F.col("is_charged_off"), 1)).cast("bigint").alias("charged_off_count"))


@settings(max_examples=15, deadline=None)
@given(loans_st, customers_st)
def test_loan_portfolio_equals_join_then_aggregate(spark, loan_rows, cust_rows):
    custs = staging.stg_customers(spark.createDataFrame(
        [(c, "a", "b", "e", "p", seg, "DIGITAL", "co", "1", dt.date(2020, 1, 1), None)
         for c, seg in cust_rows], schemas.CUSTOMERS), CFG)
    loans = staging.stg_loans(spark.createDataFrame(
        [(f"L{i}", c, typ, status, None if p is None else Decimal(p) / 100,
          None if o is None else Decimal(o) / 100,
          None if r is None else Decimal(r) / 10000, Decimal("1.00"),
          dt.date(2020, 1 + i % 12, 1), None, None, None)
         for i, (c, typ, status, p, o, r) in enumerate(loan_rows)], schemas.LOANS), CFG)
    built = Counter(tuple(r) for r in portfolio.loan_portfolio(loans, custs).collect())
    naive = Counter(tuple(r) for r in _naive_loan_portfolio(loans, custs).collect())
    assert built == naive


keys_st = st.lists(st.sampled_from(["k1", "k1", "k1", "k2", "k3", "k4", None]),
                   min_size=0, max_size=40)


@settings(max_examples=15, deadline=None)
@given(keys_st, keys_st, keys_st)
def test_stacked_checks_equal_plain_ones(spark, child_keys, parent_keys, other_keys):
    from bankmart.operators import checks

    frame = lambda ks: spark.createDataFrame([(k,) for k in ks], "k string")
    tables = {"child": frame(child_keys), "parent": frame(parent_keys),
              "other": frame(other_keys)}
    rel_specs = [schemas.Relationship("child", "k", "parent", "k"),
                 schemas.Relationship("other", "k", "parent", "k"),
                 schemas.Relationship("parent", "k", "child", "k")]
    got = {(r.table_name, r.failures) for r in checks.relationships(tables, rel_specs).collect()}
    want = set()
    for t in rel_specs:
        parent_set = {k for k in {"child": child_keys, "parent": parent_keys,
                                  "other": other_keys}[t.to_table] if k is not None}
        rows = {"child": child_keys, "parent": parent_keys, "other": other_keys}[t.table]
        want.add((t.table, sum(1 for k in rows if k is not None and k not in parent_set)))
    assert got == want

    uq_specs = [schemas.Unique(name, "k") for name in tables]
    got = {r.table_name: r.failures for r in checks.unique(tables, uq_specs).collect()}
    for name, ks in (("child", child_keys), ("parent", parent_keys), ("other", other_keys)):
        counts = Counter(k for k in ks if k is not None)
        assert got[name] == sum(1 for n in counts.values() if n > 1)


c360_st = st.lists(st.tuples(
    st.sampled_from(["DIGITAL", "BRANCH", None]),
    st.sampled_from(["RETAIL", "PREMIUM", None]),
    st.one_of(st.none(), st.dates(dt.date(2023, 1, 1), dt.date(2024, 6, 1))),
    st.sampled_from(["ONBOARDING", "ACTIVE", "LOYAL", "AT_RISK", "DORMANT"]),
    st.sampled_from(["HIGH", "MEDIUM", "LOW"]),
    st.integers(-10, 400), st.integers(0, 3), st.integers(0, 100),
    st.integers(0, 10**8), st.integers(0, 10**6)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(c360_st)
def test_funnel_grouping_sets_equal_union_of_aggregations(spark, rows):
    from bankmart.operators import funnel

    df = spark.createDataFrame(
        [(f"C{i}", ch, seg, since, stage, churn, tenure, depth, score,
          Decimal(trv) / 100, Decimal(spend) / 100)
         for i, (ch, seg, since, stage, churn, tenure, depth, score, trv, spend)
         in enumerate(rows)],
        "customer_id string, acquisition_channel string, customer_segment string, "
        "customer_since_date date, lifecycle_stage string, churn_risk string, "
        "customer_tenure_days int, product_depth int, engagement_score int, "
        "total_relationship_value decimal(38,2), total_spend_12m decimal(38,2)")
    one_pass = Counter(tuple(r) for r in funnel.mart_acquisition_funnel(df).collect())
    cohorts, channels = funnel.acquisition_cohorts(df), funnel.channel_summary(df)
    null = lambda t: F.lit(None).cast(t)
    union = cohorts.select(
        F.lit("ACQUISITION_COHORT").alias("record_type"),
        F.col("cohort_month").cast("string").alias("cohort_month"), "acquisition_channel",
        "customer_segment", "new_customers", "multi_product_customers", "active", "loyal",
        "dormant", "at_risk", "activation_rate_pct",
        F.col("churn_risk_rate_pct").cast("decimal(38,6)").alias("churn_risk_rate_pct"),
        "avg_relationship_value", "avg_engagement_score", "cohort_total_spend",
    ).unionByName(channels.select(
        F.lit("CHANNEL_SUMMARY").alias("record_type"), null("string").alias("cohort_month"),
        "acquisition_channel", null("string").alias("customer_segment"),
        F.col("total_customers").alias("new_customers"),
        *[null("bigint").alias(c) for c in ("multi_product_customers", "active", "loyal",
                                            "dormant", "at_risk")],
        null("decimal(38,2)").alias("activation_rate_pct"),
        F.col("high_churn_rate_pct").alias("churn_risk_rate_pct"),
        F.col("avg_ltv").alias("avg_relationship_value"), "avg_engagement_score",
        null("decimal(38,2)").alias("cohort_total_spend")))
    assert one_pass == Counter(tuple(r) for r in union.collect())
