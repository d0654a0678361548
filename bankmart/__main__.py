"""Command line: ``python -m bankmart <command>`` (or spark-submit this module).

  run        build models:  --select staging marts.finance ... (default: all)
  test       run the declared data tests, print one row per test
  freshness  source freshness (PASS / WARN / ERROR per table)
  seed       load the customer seed CSV:  --path customers.csv

Raw tables come from ``--raw-root`` (Parquet folders ``<root>/<table>``) or,
by default, from the catalog database ``--raw-database`` (raw_banking).
The session is the one spark-submit provides (``getOrCreate``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from bankmart.config import DEFAULT_START_DATE, Config
from bankmart.plans import pipeline
from bankmart.plans.project import Project
from bankmart.session import configure
from bankmart.sources import raw
from bankmart.sources.schemas import FRESHNESS_TESTS, SOURCE_NAME


def _config(args) -> Config:
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
    checked = dt.datetime.fromisoformat(args.checked_at) if args.checked_at else None
    return Config(as_of=as_of, start_date=args.start_date, env=args.env,
                  schema_prefix=args.schema_prefix, checked_at=checked)


def _raw(spark, args):
    if args.raw_root:
        return raw.read_parquet(spark, args.raw_root)
    return raw.read_catalog(spark, args.raw_database)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="bankmart")
    parser.add_argument("command", choices=("run", "test", "freshness", "seed"))
    parser.add_argument("--select", nargs="*", default=None)
    parser.add_argument("--env", default="dev")
    parser.add_argument("--schema-prefix", default=None,
                        help="prefix of the layer databases (default: --env)")
    parser.add_argument("--as-of", default=None, help="YYYY-MM-DD; default: today")
    parser.add_argument("--start-date", default=DEFAULT_START_DATE)
    parser.add_argument("--checked-at", default=None,
                        help="freshness reference time, YYYY-MM-DDTHH:MM; default: now "
                             "(midnight of --as-of when given)")
    parser.add_argument("--raw-root", default=None)
    parser.add_argument("--raw-database", default=SOURCE_NAME)
    parser.add_argument("--path", default=None, help="seed CSV for 'seed'")
    parser.add_argument("--sources-only", action="store_true", help="'test': skip mart tests")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"bankmart-{args.command}").getOrCreate())
    cfg = _config(args)

    if args.command == "seed":
        if not args.path:
            parser.error("seed needs --path")
        print(pipeline.load_seed(spark, args.path, cfg))
        return 0

    tables = _raw(spark, args)
    if args.command == "run":
        result = pipeline.build(spark, tables, cfg, select=args.select)
        for model, target in result.built.items():
            print(f"{model} -> {target}")
        return 0

    # mart tests check the built mart when it exists (else it is computed)
    overrides = {}
    for spec in pipeline.MODELS:
        if spec.materialized != "table":
            continue
        stored = f"{pipeline.layer_database(cfg, spec.layer)}.{spec.name}"
        if spark.catalog.tableExists(stored):
            overrides[spec.name] = spark.table(stored).drop(pipeline.LOAD_TIMESTAMP)
    project = Project(tables, cfg, overrides)
    if args.command == "freshness":
        from bankmart.operators.checks import freshness

        rows = freshness(dict(tables.items()), FRESHNESS_TESTS, cfg).collect()
        for r in rows:
            print(f"{r.status:5s} {r.table_name} newest={r.max_loaded_at} age_s={r.age_seconds}")
        return 1 if any(r.status == "ERROR" for r in rows) else 0

    results = (project.source_tests() if args.sources_only else {"all": project.all_tests()})
    failed = 0
    for df in results.values():
        for r in df.collect():       # one row per declared test: small
            failed += r.status == "FAIL"
            print(f"{r.status:4s} {r.test}({r.table_name}.{r.column_name}) failures={r.failures}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
