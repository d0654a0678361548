"""Physical-plan properties: pushdown, pruning, no Python UDFs, pre-aggregation."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from bankmart.config import FIXTURE_CONFIG, Config
from bankmart.plans.project import Project
from bankmart.sources import fixtures, raw, schemas


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, sf_small):
    """The fixture's raw tables written as Parquet, read back like production data."""
    root = tempfile.mkdtemp(prefix="bankmart-raw-")
    for name, df in fixtures.raw_tables(spark, sf_small).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return Project(raw.read_parquet(spark, root), FIXTURE_CONFIG)


def formatted(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _scan_of(df, marker: str) -> str:
    """The formatted-explain block of the Parquet scan whose text mentions ``marker``."""
    blocks = formatted(df).split("\n\n")
    for b in (blk.strip() for blk in blocks):
        if b.startswith("(") and "Scan parquet" in b.splitlines()[0] and marker in b:
            return b
    raise AssertionError(f"no scan with {marker}")


def test_transaction_filters_reach_parquet(landed):
    scan = _scan_of(landed.txn_activity_12m, "transaction_date")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    assert "GreaterThanOrEqual(transaction_date,2000-01-01)" in pushed      # start date
    assert "GreaterThanOrEqual(transaction_date,2000-11-05)" in pushed      # 12-month window
    assert "IsNotNull(transaction_id)" in pushed


def test_transaction_scan_reads_only_used_columns(landed):
    scan = _scan_of(landed.txn_activity_12m, "transaction_date")
    read = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    cols = set(re.findall(r"(?:^|,)(\w+):", read))
    assert cols == {"transaction_id", "account_id", "transaction_type", "status", "amount",
                    "transaction_date"}


def test_partition_pruning_on_landed_dates(spark):
    root = tempfile.mkdtemp(prefix="bankmart-part-")
    rows = [(f"T{i}", "A1", "DEBIT", "POSTED", " x", "0001", "d", Decimal("1.00"),
             dt.date(2021 + i % 3, 6, 1), dt.date(2021 + i % 3, 6, 2), None) for i in range(9)]
    df = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    df.write.partitionBy("transaction_date").parquet(f"{root}/transactions")
    t = spark.read.schema(schemas.TRANSACTIONS).parquet(f"{root}/transactions")
    from bankmart.operators.staging import stg_transactions

    staged = stg_transactions(t, Config(as_of=dt.date(2024, 1, 1), start_date="2022-01-01"))
    scan = _scan_of(staged, "transactions")
    assert re.search(r"PartitionFilters: \[.*transaction_date.*2022-01-01", scan)
    assert staged.count() == 6


@pytest.mark.parametrize("name", list(E.QUERY_NAMES))
def test_no_python_in_any_plan(spark, sf_small, name):
    plan = plan_of(E.queries()[name](spark, sf_small))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF"):
        assert node not in plan


def test_portfolio_is_one_aggregation_after_the_join(landed):
    """The owner's segment is joined to the rows themselves; one aggregation ends the plan."""
    for name in ("loan_portfolio", "card_portfolio", "deposit_portfolio"):
        plan = optimized(landed.model(name))
        assert plan.count("Aggregate [") == 1 and plan.index("Aggregate [") < plan.index("Join Inner"), name


def test_hot_customer_of_a_portfolio_is_split(spark):
    """One customer has a third of the loans: AQE splits the join, without a further exchange."""
    n = 60_000
    loans = spark.range(n).select(
        F.col("id").alias("loan_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("customer_id"),
        F.repeat(F.md5(F.col("id").cast("string")), 20).alias("loan_type"))
    customers = spark.range(500).select(F.concat(F.lit("c"), F.col("id")).alias("customer_id"),
                                        F.lit("RETAIL").alias("customer_segment")).union(
        spark.createDataFrame([("hot", "VIP")], "customer_id string, customer_segment string"))
    from bankmart.operators import portfolio
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0b",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = portfolio._rollup(loans, customers, ["customer_segment"],
                               [F.count("loan_id").alias("n"), F.max("loan_type").alias("m")])
        assert {r.customer_segment: r.n for r in df.collect()} == {"RETAIL": n - n // 3, "VIP": n // 3}
        plan = plan_of(df)
        assert "skew=true" in plan
        final = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")]
        assert len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", final)) <= 3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_relationship_check_is_one_aggregation(landed):
    """All four tests in one aggregation per (test, key); no join at all."""
    plan = optimized(landed.chk_relationships)
    assert "Join" not in plan.replace("Join Inner, (c_nationkey", "")   # fixture's geo join
    assert plan.count("Aggregate [test_ix#") == 1


def test_unique_tests_share_one_aggregation(landed):
    plan = optimized(landed.chk_unique)
    assert plan.count("Aggregate [test_ix#") == 1


def test_mart_checks_scan_the_stored_mart(spark, sf_small):
    """Tie-out, mart tests and funnel read the mart's files, none of its columns folds away."""
    for name in E.FROM_STORED_MART:
        df = E.queries()[name](spark, sf_small)
        assert any("mart_customer_360" in f for f in df.inputFiles()), name


def test_column_checks_are_one_aggregate_per_table(landed):
    plan = optimized(landed.chk_not_null)
    # 5 raw tables + the mart: one global aggregate each
    assert plan.count("Aggregate [count(") == 6


def test_nothing_is_hinted_broadcast(spark, sf_small):
    """Neither a model nor the fixture mapping hints a broadcast."""
    assert "strategy=broadcast" not in optimized(E.queries()["mart_customer_360"](spark, sf_small))
    derived = fixtures.raw_tables(spark, sf_small).customers
    assert "strategy=broadcast" not in optimized(derived)


def test_hot_customer_is_split_by_aqe(spark):
    """One customer owns two thirds of all accounts: the row-level join is skew-split."""
    from bankmart.operators import rollups, staging

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        cfg = Config(as_of=dt.date(2024, 1, 1))
        cust = spark.createDataFrame(
            [(f"C{i}", "a", "b", "e", "p", "RETAIL", "DIGITAL", "co", "1", dt.date(2020, 1, 1), None)
             for i in range(50)], schemas.CUSTOMERS)
        accts = spark.createDataFrame(
            [(f"A{i}", "C0" if i % 3 else f"C{i % 50}", "CHECKING", "ACTIVE", "USD", Decimal("1"),
              Decimal("1"), Decimal("0.01"), dt.date(2021, 1, 1), None, None) for i in range(30000)],
            schemas.ACCOUNTS).repartition(8)
        df = rollups.int_customer_accounts(staging.stg_customers(cust, cfg),
                                           staging.stg_accounts(accts, cfg))
        plan = df._jdf.queryExecution().executedPlan()
        assert plan.executeCollect() is not None
        final = plan.toString()
        assert "isFinalPlan=true" in final
        # sort-merge, or shuffled hash when AQE measured small partitions: split either way
        assert "SortMergeJoin(skew=true)" in final or "ShuffledHashJoin(skew=true)" in final
        assert df.count() == 30000
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_bucketed_landing_removes_account_shuffles(spark, sf_small):
    """Transactions and accounts bucketed by account_id: the (account, month)
    aggregation and the join with accounts need no shuffle."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spark.sql("CREATE DATABASE IF NOT EXISTS bucketed_raw")
        for name, df in fixtures.raw_tables(spark, sf_small).items():
            writer = df.write.mode("overwrite").format("parquet")
            if name in ("transactions", "accounts"):
                writer = writer.bucketBy(8, "account_id").sortBy("account_id")
            writer.saveAsTable(f"bucketed_raw.{name}")
        project = Project(raw.read_catalog(spark, "bucketed_raw"), FIXTURE_CONFIG)
        plan = plan_of(project.txn_activity_12m)
        keys = [re.sub(r"#\d+", "", k) for k in
                re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]
        assert all(not k.startswith("account_id") for k in keys), keys
        assert len(keys) == 2
        plain = Project(fixtures.raw_tables(spark, sf_small), FIXTURE_CONFIG).txn_activity_12m
        assert sorted(project.txn_activity_12m.collect()) == sorted(plain.collect())
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_COMPUTE = ("Project [", "Filter ", "HashAggregate", "SortMergeJoin", "BroadcastHashJoin",
            "ShuffledHashJoin",
            "Sort [", "Expand ", "ObjectHashAggregate", "SortAggregate")


@pytest.mark.parametrize("name", ["mart_customer_360", "mart_portfolio_performance",
                                  "mart_acquisition_funnel", "mart_kpi_governance",
                                  "chk_accepted_values", "stg_customers", "stg_transactions"])
def test_compute_stays_in_whole_stage_codegen(spark, sf_small, name):
    """Every compute operator of the executed (final adaptive) plan is code-generated."""
    df = E.project(spark, sf_small).model(name)
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    final = plan.toString().split("== Initial Plan ==")[0]
    outside = [line for line in final.splitlines()
               if line.strip().lstrip(":").strip().lstrip("+-").strip().startswith(_COMPUTE)]
    assert outside == []
