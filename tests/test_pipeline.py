"""Build paths: layer selection, namespaces, views vs tables, seeds, entry points."""

from __future__ import annotations

import dataclasses
import os
import tempfile

import pytest

import __spark_entry__ as E
from bankmart.config import FIXTURE_CONFIG
from bankmart.plans import pipeline
from bankmart.sources import fixtures


def test_selectors():
    names = lambda sel: [m.name for m in pipeline.select_models(sel)]
    assert names(["staging"]) == ["stg_customers", "stg_accounts", "stg_transactions",
                                  "stg_loans", "stg_credit_cards"]
    assert names(["marts.gtm"]) == ["mart_customer_360", "mart_acquisition_funnel"]
    assert names(["marts.finance"]) == ["mart_portfolio_performance"]
    assert names(["marts"]) == ["mart_customer_360", "mart_acquisition_funnel",
                                "mart_portfolio_performance", "mart_kpi_governance"]
    assert names(["tag:governance"]) == []                # no model carries a tag
    assert len(names(None)) == 11


def test_layer_databases():
    cfg = dataclasses.replace(FIXTURE_CONFIG, env="prod")
    assert pipeline.layer_database(cfg, "marts.finance") == "dbt_prod_finance"
    assert pipeline.layer_database(cfg, "staging") == "dbt_prod_staging"
    named = dataclasses.replace(cfg, schema_prefix="analytics_prod")
    assert pipeline.layer_database(named, "marts.gtm") == "analytics_prod_gtm"


def test_build_writes_tables_and_views(spark, sf_small):
    raw = fixtures.raw_tables(spark, sf_small)
    res = pipeline.build(spark, raw, FIXTURE_CONFIG, select=["staging", "marts"])
    assert res.built["mart_customer_360"] == "dbt_dev_gtm.mart_customer_360"
    assert res.built["mart_portfolio_performance"] == "dbt_dev_finance.mart_portfolio_performance"
    assert res.built["mart_kpi_governance"] == "dbt_dev_governance.mart_kpi_governance"
    assert res.built["stg_loans"] == "stg_loans"          # a view
    c360 = spark.table("dbt_dev_gtm.mart_customer_360")
    assert pipeline.LOAD_TIMESTAMP in c360.columns and c360.count() == 150
    assert spark.table("stg_loans").count() == 375
    # the funnel read the stored customer 360 table
    funnel = spark.table("dbt_dev_gtm.mart_acquisition_funnel")
    assert funnel.where("record_type = 'CHANNEL_SUMMARY'").count() == 5
    gov = spark.table("dbt_dev_governance.mart_kpi_governance")
    assert gov.where("record_type = 'STTM_RECON' AND value_3 = 'PASS'").count() == 1
    # a second build replaces, not appends
    pipeline.build(spark, raw, FIXTURE_CONFIG, select=["marts.finance"])
    assert spark.table("dbt_dev_finance.mart_portfolio_performance").count() == \
        res.frames["mart_portfolio_performance"].count()


def test_governance_alone_reads_stored_customer_360(spark, sf_small):
    raw = fixtures.raw_tables(spark, sf_small)
    pipeline.build(spark, raw, FIXTURE_CONFIG, select=["mart_customer_360"])
    res = pipeline.build(spark, raw, FIXTURE_CONFIG, select=["marts.governance"])
    plan = res.frames["mart_kpi_governance"]._jdf.queryExecution().analyzed().toString()
    assert "mart_customer_360" in plan


def test_dry_run_writes_nothing(spark, sf_small):
    raw = fixtures.raw_tables(spark, sf_small)
    cfg = dataclasses.replace(FIXTURE_CONFIG, env="dry")
    res = pipeline.build(spark, raw, cfg, select=["marts.finance"], write=False)
    assert res.built == {"mart_portfolio_performance": "mart_portfolio_performance"}
    assert not spark.catalog.databaseExists("dry_finance")


def test_seed_load(spark):
    folder = tempfile.mkdtemp(prefix="bankmart-seed-")
    path = os.path.join(folder, "customers.csv")
    with open(path, "w") as fh:
        fh.write("customer_id,first_name,last_name,email,phone,customer_segment,"
                 "acquisition_channel,state,zip_code,created_at,updated_at\n"
                 "Z1,ada,lovelace,a@b.c,555,RETAIL,DIGITAL,NY,01234,2020-02-02,2024-01-01\n"
                 "Z2,alan,turing,t@b.c,556,PREMIUM,BRANCH,NJ,07001,2021-03-03,2024-01-02\n")
    target = pipeline.load_seed(spark, path, FIXTURE_CONFIG)
    rows = spark.table(target).orderBy("customer_id").collect()
    assert [r.zip_code for r in rows] == ["01234", "07001"]      # text, leading zero kept
    assert str(rows[0].updated_at) == "2024-01-01 00:00:00"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert "lifecycle_stage" in df.columns


@pytest.mark.parametrize("name", ["mart_customer_360", "chk_relationships"])
def test_queries_are_lazy(spark, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    assert df.isStreaming is False and len(df.columns) > 0


def test_command_line_run_and_test(spark, sf_small):
    from bankmart.__main__ import main

    root = tempfile.mkdtemp(prefix="bankmart-cli-")
    for name, df in fixtures.raw_tables(spark, sf_small).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    common = ["--raw-root", root, "--as-of", "2001-11-05", "--start-date", "2000-01-01",
              "--env", "cli"]
    assert main(["run", "--select", "marts.finance", *common]) == 0
    assert spark.table("dbt_cli_finance.mart_portfolio_performance").count() > 0
    assert main(["test", "--sources-only", *common]) == 1        # planted violations fail
    assert main(["freshness", *common]) == 0
    assert main(["freshness", "--checked-at", "2001-11-07T01:00", *common]) == 1   # 49 h: ERROR


def test_failed_build_keeps_previous_table(spark):
    """A job that fails while writing leaves the published table untouched."""
    from pyspark.sql import functions as F

    good = spark.range(5).withColumn("v", F.lit("first"))
    pipeline.publish_table(spark, good, "pub_test.t")
    bad = spark.range(5).withColumn("v", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        pipeline.publish_table(spark, bad, "pub_test.t")
    assert {r.v for r in spark.table("pub_test.t").collect()} == {"first"}
    newer = spark.range(3).withColumn("v", F.lit("second"))
    for _ in range(3):
        pipeline.publish_table(spark, newer, "pub_test.t")
    assert spark.table("pub_test.t").count() == 3
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/pub_test.db/t"
    fs, root = pipeline._hadoop_fs(spark, folder)
    versions = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    assert len(versions) == pipeline.KEEP_VERSIONS


def test_customer_360_files_are_clustered(spark, sf_small):
    from pyspark.sql import functions as F

    raw = fixtures.raw_tables(spark, sf_small)
    pipeline.build(spark, raw, FIXTURE_CONFIG, select=["mart_customer_360"])
    rows = (spark.table("dbt_dev_gtm.mart_customer_360")
            .select(F.input_file_name().alias("f"), "customer_segment").collect())
    by_file = {}
    for r in rows:
        by_file.setdefault(r.f, []).append(r.customer_segment)
    for segments in by_file.values():          # file order is the sorted order
        assert segments == sorted(segments)


def test_command_line_tests_read_the_built_mart(spark, sf_small):
    from bankmart.__main__ import main

    root = tempfile.mkdtemp(prefix="bankmart-cli2-")
    for name, df in fixtures.raw_tables(spark, sf_small).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    common = ["--raw-root", root, "--as-of", "2001-11-05", "--start-date", "2000-01-01",
              "--env", "cli2"]
    assert main(["run", "--select", "mart_customer_360", *common]) == 0
    # corrupt the stored mart: a duplicated customer must make the unique test fail
    stored = spark.table("dbt_cli2_gtm.mart_customer_360")
    pipeline.publish_table(spark, stored.unionByName(stored.limit(1)), "dbt_cli2_gtm.mart_customer_360")
    from bankmart.plans.project import Project
    from bankmart.sources import raw as raw_mod

    project = Project(raw_mod.read_parquet(spark, root), FIXTURE_CONFIG,
                      {"mart_customer_360": spark.table("dbt_cli2_gtm.mart_customer_360")})
    got = {(r.table_name, r.column_name): r.failures for r in project.chk_unique.collect()}
    assert got[("mart_customer_360", "customer_id")] == 1
    assert main(["test", *common]) == 1


def test_unpinned_run_on_old_data(spark, sf_small):
    """Default settings (today's date, start 2022-01-01) on 1995-2001 data: no
    transaction survives staging, and every mart still builds."""
    from bankmart.config import Config

    raw = fixtures.raw_tables(spark, sf_small)
    cfg = Config(env="nowdate")
    res = pipeline.build(spark, raw, cfg, write=False)
    assert res.frames["stg_transactions"].count() == 0
    c360 = res.frames["mart_customer_360"]
    assert c360.count() == 150
    assert c360.where("active_months_12m <> 0 OR lifecycle_stage <> 'DORMANT'").count() == 0
    assert res.frames["mart_kpi_governance"].count() == 12
    assert res.frames["mart_acquisition_funnel"].count() > 0


def test_models_as_sql_views(spark, sf_small):
    from bankmart.plans.project import Project

    project = Project(fixtures.raw_tables(spark, sf_small), FIXTURE_CONFIG)
    names = project.register_views(prefix="v_")
    assert "v_mart_customer_360" in names and len(names) == len(Project.MODEL_NAMES)
    rows = spark.sql("SELECT lifecycle_stage, count(*) AS n FROM v_mart_customer_360 "
                     "GROUP BY lifecycle_stage").collect()
    assert sum(r.n for r in rows) == 150


def test_republish_same_schema_moves_location(spark):
    from pyspark.sql import functions as F

    first = pipeline.publish_table(spark, spark.range(2).withColumn("v", F.lit("a")), "pub2.t")
    second = pipeline.publish_table(spark, spark.range(4).withColumn("v", F.lit("b")), "pub2.t")
    location = spark.sql("DESCRIBE TABLE EXTENDED pub2.t").where("col_name = 'Location'").first()
    assert location.data_type.rstrip("/").endswith(second.rsplit("/", 1)[1]) and first != second
    assert spark.table("pub2.t").count() == 4


def test_checkpoint_folder_only_for_local_sessions():
    from bankmart.session import checkpoint_dir

    class Ctx:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def getConf(self):
            return {"spark.master": self.master}

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master):
            self.sparkContext = Ctx(master)

    local = Session("local[4]")
    folder = checkpoint_dir(local)
    assert folder and folder == local.sparkContext.folder and os.path.isdir(folder)
    cluster = Session("yarn")
    assert checkpoint_dir(cluster) is None and cluster.sparkContext.folder is None


def test_command_line_seed(spark):
    from bankmart.__main__ import main

    folder = tempfile.mkdtemp(prefix="bankmart-cliseed-")
    path = os.path.join(folder, "seed.csv")
    with open(path, "w") as fh:
        fh.write("customer_id,first_name,last_name,email,phone,customer_segment,"
                 "acquisition_channel,state,zip_code,created_at,updated_at\n"
                 "S1,ada,lovelace,a@b.c,555,RETAIL,DIGITAL,NY,01234,2020-02-02,2024-01-01\n")
    assert main(["seed", "--path", path, "--env", "cliseed"]) == 0
    assert spark.table("dbt_cliseed_seeds.raw_customers").count() == 1
