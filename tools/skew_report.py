"""Measure how a hot key spreads over tasks, from Spark's event log.

The transactions derived from the driver's line items are skewed on purpose:
every third row is re-booked to one account (and so one customer). The
12-month activity is then run twice:

* as built (``bankmart.operators.customer.txn_activity_12m``): pre-aggregate
  per (account, month) map-side, then join the accounts;
* naively: join every transaction to its account first, then aggregate.

For each run the event log (written to a fresh scratch folder) gives, per
stage, the shuffle records read by the busiest task and by all tasks.

Usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from bankmart.config import FIXTURE_CONFIG  # noqa: E402
from bankmart.functions import columns as C  # noqa: E402
from bankmart.operators import customer, staging  # noqa: E402
from bankmart.session import local_session  # noqa: E402
from bankmart.sources import fixtures  # noqa: E402


def naive_activity(stg_txn, stg_acct, cfg):
    """Join first, aggregate after (the plain formulation)."""
    recent = stg_txn.where((F.col("transaction_date") >= C.years_before(cfg.today()))
                           & F.col("is_posted") & ~F.col("is_reversal"))
    joined = recent.join(stg_acct.select("account_id", "customer_id"), "account_id")
    return joined.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions_12m"),
        F.countDistinct("transaction_month").alias("active_months_12m"))


def stage_stats(log_dir: str) -> list[tuple[int, int, int, int]]:
    """(stage id, tasks, max shuffle records read by one task, total) per stage."""
    path = sorted(glob.glob(f"{log_dir}/*"))[-1]
    per_stage: dict[int, list[int]] = {}
    for line in open(path):
        event = json.loads(line)
        if event.get("Event") != "SparkListenerTaskEnd":
            continue
        metrics = event.get("Task Metrics") or {}
        read = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
        per_stage.setdefault(event["Stage ID"], []).append(read)
    return [(sid, len(v), max(v), sum(v)) for sid, v in sorted(per_stage.items()) if sum(v)]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    for label in ("pre-aggregated (as built)", "join first (naive)"):
        log_dir = tempfile.mkdtemp(prefix="run-skew-")
        spark = local_session(8, shuffle_partitions=32, app_name="skew-report", extra={
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        })
        # measure the plan as written: no broadcast, no partition coalescing,
        # no runtime skew split
        for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"),
                           ("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
                           ("spark.sql.adaptive.skewJoin.enabled", "false"),
                           ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
            spark.conf.set(key, value)
        raw = fixtures.raw_tables(spark, sf_dir)
        hot = raw.transactions.withColumn(
            "account_id", F.when(F.abs(F.hash("transaction_id")) % 3 == 0, F.lit("A0"))
            .otherwise(F.col("account_id")))
        txn = staging.stg_transactions(hot, FIXTURE_CONFIG)
        acct = staging.stg_accounts(raw.accounts, FIXTURE_CONFIG)
        if label.startswith("pre"):
            df = customer.txn_activity_12m(txn, acct, FIXTURE_CONFIG)
        else:
            df = naive_activity(txn, acct, FIXTURE_CONFIG)
        rows = df.count()
        spark.stop()
        print(f"== {label}: {rows} customers")
        print("   stage  tasks  busiest task (shuffle records)  all tasks  busiest share")
        for sid, n, top, total in stage_stats(log_dir):
            print(f"   {sid:5d}  {n:5d}  {top:30d}  {total:9d}  {top / total:13.1%}")


if __name__ == "__main__":
    main()
