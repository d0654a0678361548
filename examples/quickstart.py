"""End to end on the smallest test tables: build every model, run the data tests.

  python examples/quickstart.py [sf_dir]

Uses a local session with a scratch warehouse; on a cluster, take the
session from spark-submit and raw tables from ``bankmart.sources.raw``.
"""

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bankmart.config import FIXTURE_CONFIG  # noqa: E402
from bankmart.plans import pipeline  # noqa: E402
from bankmart.plans.project import Project  # noqa: E402
from bankmart.session import local_session  # noqa: E402
from bankmart.sources import fixtures  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(4, warehouse=tempfile.mkdtemp(prefix="bankmart-example-"),
                          extra={"spark.sql.catalogImplementation": "in-memory"})
    raw = fixtures.raw_tables(spark, sf_dir)

    result = pipeline.build(spark, raw, FIXTURE_CONFIG)          # views + four mart tables
    for model, target in result.built.items():
        print(f"built {model:28s} -> {target}")

    spark.sql("""
        SELECT lifecycle_stage, count(*) AS customers, round(avg(engagement_score), 1) AS score
        FROM dbt_dev_gtm.mart_customer_360 GROUP BY lifecycle_stage ORDER BY customers DESC
    """).show()
    spark.table("dbt_dev_governance.mart_kpi_governance").where(
        "record_type <> 'KPI_DEFINITION'").show(truncate=False)

    # data tests against the built marts
    built = {"mart_customer_360": spark.table("dbt_dev_gtm.mart_customer_360")}
    tests = Project(raw, FIXTURE_CONFIG, built).all_tests()
    tests.where("status = 'FAIL'").orderBy("test", "table_name", "column_name").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
