"""Data tests: each check must report exactly the planted violations."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest

from bankmart.config import FIXTURE_CONFIG
from bankmart.operators import checks
from bankmart.plans.project import Project
from bankmart.sources import fixtures, schemas


@pytest.fixture(scope="module")
def project(spark, sf_small):
    return Project(fixtures.raw_tables(spark, sf_small), FIXTURE_CONFIG)


def failures(df):
    return {(r.table_name, r.column_name): r.failures for r in df.collect()}


def test_unique(project):
    got = failures(project.chk_unique)
    assert len(got) == 7
    # two line items share (order, line, part, supplier): one duplicated id
    assert got[("transactions", "transaction_id")] == 1
    assert got[("customers", "email")] == 0
    assert sum(got.values()) == 1


def test_not_null(project):
    got = failures(project.chk_not_null)
    assert len(got) == 36
    assert got[("customers", "email")] == 7
    assert got[("transactions", "transaction_id")] == 16
    assert sum(got.values()) == 23


def test_accepted_values_on_raw_values(project):
    got = failures(project.chk_accepted_values)
    assert got == {
        ("customers", "customer_segment"): 104, ("customers", "acquisition_channel"): 0,
        ("accounts", "account_type"): 293, ("accounts", "account_status"): 516,
        ("transactions", "transaction_type"): 1707, ("transactions", "status"): 5313,
        ("loans", "loan_type"): 63, ("loans", "loan_status"): 83,
        ("credit_cards", "card_status"): 248,
        ("mart_customer_360", "lifecycle_stage"): 0, ("mart_customer_360", "ltv_tier"): 0,
        ("mart_customer_360", "churn_risk"): 0,
    }
    statuses = {r.status for r in project.chk_accepted_values.collect()}
    assert statuses == {"PASS", "FAIL"}


def test_relationships(project):
    got = failures(project.chk_relationships)
    assert got == {("accounts", "customer_id"): 0, ("transactions", "account_id"): 144,
                   ("loans", "customer_id"): 0, ("credit_cards", "customer_id"): 0}


def test_null_keys_pass_relationships_and_unique(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), (None,), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    tables = {"child": child, "parent": parent}
    rel = checks.relationships(tables, [schemas.Relationship("child", "k", "parent", "k")]).first()
    assert rel.failures == 1 and rel.status == "FAIL"
    uq = checks.unique(tables, [schemas.Unique("child", "k"), schemas.Unique("parent", "k")])
    assert {r.table_name: r.failures for r in uq.collect()} == {"child": 1, "parent": 1}
    av = checks.accepted_values(tables, [schemas.AcceptedValues("child", "k", ("a",))]).first()
    assert av.failures == 1                              # 'x' fails, nulls pass


@pytest.mark.parametrize("hours,status", [(0, "PASS"), (24, "PASS"), (36, "WARN"),
                                          (48, "WARN"), (72, "ERROR")])
def test_freshness(project, hours, status):
    cfg = dataclasses.replace(FIXTURE_CONFIG, checked_at=dt.datetime.combine(
        FIXTURE_CONFIG.as_of, dt.time()) + dt.timedelta(hours=hours))
    df = checks.freshness(dict(project.raw.items()), schemas.FRESHNESS_TESTS, cfg)
    rows = {r.table_name: r for r in df.collect()}
    assert set(rows) == {"customers", "accounts", "transactions", "loans", "credit_cards"}
    assert {r.status for r in rows.values()} == {status}
    assert rows["customers"].age_seconds == hours * 3600


def test_freshness_empty_table_is_error(spark):
    empty = spark.createDataFrame([], "updated_at timestamp_ntz")
    row = checks.freshness({"t": empty}, [schemas.Freshness("t", "updated_at")],
                           FIXTURE_CONFIG).first()
    assert row.status == "ERROR" and row.max_loaded_at is None


def test_source_row_counts(project):
    got = {r.table_name: r.row_count for r in project.src_row_counts.collect()}
    assert got == {"customers": 150, "accounts": 750, "transactions": 6000, "loans": 375,
                   "credit_cards": 375}


def test_source_tests_only(project):
    tests = project.source_tests()
    assert tests["not_null"].count() == 29 and tests["unique"].count() == 6
    assert tests["accepted_values"].count() == 9 and tests["relationships"].count() == 4


def test_all_tests_in_one_result(project):
    rows = project.all_tests().collect()
    kinds = {}
    for r in rows:
        kinds[r.test] = kinds.get(r.test, 0) + 1
    assert kinds == {"not_null": 36, "accepted_values": 12, "unique": 7, "relationships": 4}
    assert sum(1 for r in rows if r.status == "FAIL") == 12


def test_unique_counts_duplicated_values(spark):
    """Planted duplicates, including a hot value and nulls; one lazy plan, no broadcast."""
    rows = [("hot",)] * 500 + [(f"k{i}",) for i in range(300)] + [("k7",), ("k9",), (None,)] * 2
    df = spark.createDataFrame(rows, "k string")
    assert checks.unique({"t": df}, [schemas.Unique("t", "k")]).first().failures == 3


def test_a_tampered_mart_fails_its_tests(project):
    """Tie-out and mart tests see the mart they are given, not the customers it was made from."""
    from pyspark.sql import functions as F

    from bankmart.plans.project import Project

    mart = project.mart_customer_360
    doubled = mart.unionByName(mart.where(F.col("customer_id") == "C000000001"))
    missing = mart.where(F.col("customer_id") != "C000000001")
    nulled = mart.withColumn("ltv_tier", F.when(F.col("customer_id") != "C000000001", F.col("ltv_tier")))

    def graph(df):
        return Project(project.raw, project.cfg, {"mart_customer_360": df})

    assert graph(mart).sttm_reconciliation.first().status == "PASS"
    for df, variance in ((doubled, -1), (missing, 1)):
        row = graph(df).sttm_reconciliation.first()
        assert (row.status, row.variance) == ("FAIL", variance)

    def status(checked, column):
        return {r.status for r in checked.collect()
                if r.table_name == "mart_customer_360" and r.column_name == column}

    assert status(graph(doubled).chk_unique, "customer_id") == {"FAIL"}
    assert status(graph(mart).chk_unique, "customer_id") == {"PASS"}
    assert status(graph(nulled).chk_not_null, "ltv_tier") == {"FAIL"}
