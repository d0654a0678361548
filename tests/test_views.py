"""Catalog views of the staging and intermediate models: equal to the DataFrames, read by other sessions."""

from __future__ import annotations

import dataclasses
import datetime as dt
import tempfile
from decimal import Decimal

import pytest

from bankmart.config import FIXTURE_CONFIG, Config
from bankmart.plans import pipeline, views
from bankmart.plans.project import Project
from bankmart.sources import fixtures, raw, schemas

VIEWS = list(views.UPSTREAM)
DAY, STAMP = dt.date(2001, 10, 31), dt.datetime(2001, 10, 31, 13, 5)


def odd_rows(name):
    """Rows of every awkward value of a raw table: nulls, spaces, signs, zero and negative divisors."""
    texts = [None, "", "  mary-jane o'neil ", "ÉLAN \\ vital", "active", " Closed", "PREMIUM ", "checking", "cd",
             "delinquent_30", "DELINQUENT_999", "fee", "reversal", "posted", "paid_off", "interest", "d'arc/smith"]
    moneys = [None, "0", "0.01", "-5.55", "70", "90", "100", "89.99", "-100", "123456789.99"]
    dates = [None, DAY, dt.date(2000, 2, 29), dt.date(2001, 11, 5), dt.date(2000, 11, 5), dt.date(1999, 12, 31)]
    schema, rows = schemas.RAW_SCHEMAS[name], []
    for i in range(60):
        row = []
        for j, f in enumerate(schema.fields):
            kind = f.dataType.simpleString()
            pick = i + (i // 7) * j
            if f.name == schemas.PRIMARY_KEYS[name]:
                row.append(None if i % 20 == 7 else f"k{i}")
            elif f.name.endswith("_id"):
                row.append(f"k{i % 9}")
            elif kind == "string":
                row.append(texts[pick % len(texts)])
            elif kind.startswith("decimal"):
                row.append(None if (v := moneys[pick % (len(moneys) - (kind == "decimal(8,4)"))]) is None else Decimal(v))
            else:
                row.append(dates[pick % len(dates)] if kind == "date" else STAMP)
        rows.append(tuple(row))
    return rows


@pytest.fixture(scope="module")
def odd_root(spark):
    root = tempfile.mkdtemp(prefix="bankmart-odd-")
    for name, schema in schemas.RAW_SCHEMAS.items():
        spark.createDataFrame(odd_rows(name), schema).write.mode("overwrite").parquet(f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def landed(spark, sf_small):
    root = tempfile.mkdtemp(prefix="bankmart-views-")
    return raw.land(fixtures.raw_tables(spark, sf_small), root), root


def same(view, model):
    kept = view.drop(pipeline.LOAD_TIMESTAMP)
    assert [(f.name, f.dataType) for f in kept.schema.fields] == [(f.name, f.dataType) for f in model.schema.fields]
    assert model.count() > 0 and kept.exceptAll(model).count() == 0 and model.exceptAll(kept).count() == 0


def test_views_equal_the_models_in_another_session(spark, landed):
    tables, _ = landed
    cfg = dataclasses.replace(FIXTURE_CONFIG, schema_prefix="viewed")
    built = pipeline.build(spark, tables, cfg, select=["staging", "intermediate"]).built
    other = spark.newSession()
    other.conf.set("spark.sql.ansi.enabled", "false")      # a view keeps the mode it was made in
    for name in VIEWS:
        assert built[name] == pipeline.view_name(cfg, name)
        frame = other.table(built[name])
        assert frame.columns[-1] == pipeline.LOAD_TIMESTAMP
        spark_side = spark.table(built[name])
        same(spark_side, Project(tables, cfg).model(name))
        assert frame.drop(pipeline.LOAD_TIMESTAMP).count() == spark_side.count()
    listed = {r.viewName for r in other.sql("SHOW VIEWS IN viewed_intermediate").collect()}
    assert {"int_customer_accounts", "int_customer_financials"} <= listed
    assert not {"stg_loans"} & {t.name for t in other.catalog.listTables("viewed_intermediate") if not t.isTemporary}


@pytest.mark.parametrize("name", VIEWS)
def test_views_equal_the_models_on_odd_rows(spark, odd_root, name):
    cfg = dataclasses.replace(FIXTURE_CONFIG, schema_prefix="oddviews", start_date="2000-02-29")
    tables = raw.read_parquet(spark, odd_root)
    same(spark.table(pipeline.publish_view(spark, tables, cfg, name)), Project(tables, cfg).model(name))


def test_view_over_catalog_tables_and_the_current_date(spark, odd_root):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_named")
    for name in schemas.RAW_SCHEMAS:
        spark.read.parquet(f"{odd_root}/{name}").write.mode("overwrite").saveAsTable(f"raw_named.{name}")
    tables, cfg = raw.read_catalog(spark, "raw_named"), Config(schema_prefix="named")
    for name in VIEWS:
        same(spark.table(pipeline.publish_view(spark, tables, cfg, name)),
             Project(tables, cfg).model(name)) if name != "stg_transactions" else \
            pipeline.publish_view(spark, tables, cfg, name)
    lenient = raw.read_catalog(spark, "raw_named", lenient=True)
    assert "try_cast(" in views.view_text("stg_loans", cfg, lenient.relations, {}, lenient.lenient)
    # rows that land later are seen by the view
    before = spark.table("named_staging.stg_loans").count()
    spark.read.parquet(f"{odd_root}/loans").write.mode("append").saveAsTable("raw_named.loans")
    assert spark.newSession().table("named_staging.stg_loans").count() == 2 * before


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, landed):
    tables, _ = landed
    cfg = dataclasses.replace(FIXTURE_CONFIG, schema_prefix="pushed")
    name = pipeline.publish_view(spark, tables, cfg, "stg_transactions")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(spark.sql(f"SELECT transaction_id FROM {name} WHERE account_id = 'A1'"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(account_id,A1)" in plan and "GreaterThanOrEqual(transaction_date,2000-01-01)" in plan
    read = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert set(read.removeprefix("struct<").rstrip(">").split(",")) == {
        "transaction_id:string", "account_id:string", "transaction_date:date"}


def test_missing_upstream_is_created_and_replacing_keeps_readers(spark, landed):
    tables, _ = landed
    cfg = dataclasses.replace(FIXTURE_CONFIG, schema_prefix="lonely")
    built = pipeline.build(spark, tables, cfg, select=["int_customer_accounts"]).built
    assert built == {"int_customer_accounts": "lonely_intermediate.int_customer_accounts"}
    staged = {r.viewName for r in spark.sql("SHOW VIEWS IN lonely_staging").collect()}
    assert {"stg_customers", "stg_accounts"} <= staged and "stg_loans" not in staged
    held = spark.table(built["int_customer_accounts"])
    n = held.count()
    later = dataclasses.replace(cfg, as_of=dt.date(2002, 1, 1))
    pipeline.build(spark, tables, later, select=["staging"])           # replaced below the reader
    assert held.count() == n
    days = spark.table(built["int_customer_accounts"]).selectExpr("max(customer_tenure_days)").first()[0]
    assert days == Project(tables, later).stg_customers.join(
        tables.accounts, "customer_id").selectExpr("max(customer_tenure_days)").first()[0]


def test_command_line_leaves_views_behind(spark, landed):
    from bankmart.__main__ import main

    _, root = landed
    common = ["--raw-root", root, "--as-of", "2001-11-05", "--start-date", "2000-01-01", "--env", "prod"]
    assert main(["run", "--select", "staging", "intermediate", *common]) == 0
    other = spark.newSession()
    for layer, names in (("staging", set(views.STAGING)), ("intermediate", set(views.INTERMEDIATE))):
        own = {r.viewName for r in other.sql(f"SHOW VIEWS IN dbt_prod_{layer}").collect() if not r.isTemporary}
        assert own == names
    assert other.table("dbt_prod_intermediate.int_customer_financials").count() == 150


def test_governance_without_a_stored_mart_builds_it_first(spark, landed):
    tables, _ = landed
    cfg = dataclasses.replace(FIXTURE_CONFIG, schema_prefix="alone")
    built = pipeline.build(spark, tables, cfg, select=["marts.governance"])
    assert list(built.built) == ["mart_customer_360", "mart_kpi_governance"]
    plan = built.frames["mart_kpi_governance"]._jdf.queryExecution().analyzed().toString()
    assert "alone_gtm.mart_customer_360" in plan
    # a lost row of the stored mart is seen
    whole = spark.table("alone_gtm.mart_customer_360")
    pipeline.publish_table(spark, whole.where("customer_id <> (SELECT max(customer_id) FROM alone_gtm.mart_customer_360)"),
                           "alone_gtm.mart_customer_360")
    again = pipeline.build(spark, tables, cfg, select=["marts.governance"])
    assert list(again.built) == ["mart_kpi_governance"]
    rows = again.frames["mart_kpi_governance"].where("record_type = 'STTM_RECON'").collect()
    assert {r.value_3 for r in rows} == {"FAIL"}


def test_landed_files_are_split_without_a_shuffle(spark):
    root = tempfile.mkdtemp(prefix="bankmart-land-")
    tables = fixtures.raw_tables(spark, "/root/testdata/sf0.1")
    landed = raw.land(tables, root)
    assert landed.transactions.rdd.getNumPartitions() >= 8
    assert "Exchange" not in plan_of(tables.transactions)
