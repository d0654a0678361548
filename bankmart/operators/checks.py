"""Declared data tests as distributed checks: each returns one row per test.

* not_null and accepted_values: fused, one scan and one global aggregation
  per table for all of its tests (partial aggregation, no collect); their
  failures count offending rows (not distinct values).
* unique: all tests in one ``groupBy(test, key)`` with map-side counting, so
  a value shared by a third of the rows is a single partial count per task;
  nulls are ignored.
* relationships: no join; child and parent keys of all tests are stacked
  and one aggregation per (test, key) counts child rows and notes a parent,
  both sides reduced map-side; null child keys pass.
* freshness: max(loaded_at) per table against the run's reference time.

Result rows: (test, table_name, column_name, failures, status). Checks look
at the raw, untrimmed values (so ' retail' is not an accepted segment),
except the mart tests which look at the built mart.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.config import Config
from bankmart.sources.schemas import (AcceptedValues, Freshness, NotNull, Relationship,
                                      Unique)

RESULT_COLUMNS = ("test", "table_name", "column_name", "failures", "status")


def _status(failures: F.Column) -> F.Column:
    return F.when(failures == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _result(test: str, table: str, column: str, failures: F.Column) -> list[F.Column]:
    return [F.lit(test).alias("test"), F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures")]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", _status(F.col("failures")))


_COLUMN_KINDS = (NotNull, AcceptedValues)


def _per_test_rows(counted: DataFrame, tests: list, kind: str | None,
                   measure: str) -> DataFrame:
    """One-row aggregate with a column per test -> one result row per test.

    ``kind`` names the test kind; None takes it from each test's type.
    """
    rows = F.array(*[F.struct(*_result(kind or kind_name(type(t)), t.table, t.column,
                                       F.col(f"{measure}{i}")))
                     for i, t in enumerate(tests)])
    return counted.select(F.inline(rows))


def _violation(t) -> F.Column:
    c = F.col(t.column)
    if isinstance(t, NotNull):
        return c.isNull()
    return c.isNotNull() & ~c.isin(*t.values)   # accepted values: nulls pass


def column_tests(tables: Mapping[str, DataFrame], specs: Iterable) -> DataFrame:
    """All not_null and accepted_values tests: ONE aggregation per table.

    Every test of a table is a conditional count in the same global
    aggregate, so the table is scanned once whatever the number of tests
    (partial counts per task, one small merge), and the one-row result is
    unpivoted into one row per test.
    """
    by_table: dict[str, list] = {}
    for s in specs:
        if isinstance(s, _COLUMN_KINDS):
            by_table.setdefault(s.table, []).append(s)
    parts = []
    for table, tests in by_table.items():
        counted = tables[table].agg(*[F.count(F.when(_violation(t), F.lit(1))).alias(f"m{i}")
                                      for i, t in enumerate(tests)])
        parts.append(_per_test_rows(counted, tests, None, "m"))
    return _union(parts)


def kind_name(kind: type) -> str:
    return {NotNull: "not_null", AcceptedValues: "accepted_values", Unique: "unique",
            Relationship: "relationships"}[kind]


def not_null(tables: Mapping[str, DataFrame], specs: Iterable) -> DataFrame:
    return column_tests(tables, [s for s in specs if isinstance(s, NotNull)])


def accepted_values(tables: Mapping[str, DataFrame], specs: Iterable) -> DataFrame:
    return column_tests(tables, [s for s in specs if isinstance(s, AcceptedValues)])


def all_tests(tables: Mapping[str, DataFrame], specs: Iterable) -> DataFrame:
    """Every declared test in one result: fused column tests, unique, relationships."""
    specs = list(specs)
    parts = [column_tests(tables, specs)]
    if any(isinstance(s, Unique) for s in specs):
        parts.append(unique(tables, specs))
    if any(isinstance(s, Relationship) for s in specs):
        parts.append(relationships(tables, specs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique(tables: Mapping[str, DataFrame], specs: Iterable) -> DataFrame:
    """Failures = number of distinct non-null values that occur more than once.

    All tests share ONE aggregation: each test's keys are tagged with the test's
    number and stacked, counted per (test, key) with partial aggregation, and the
    duplicated keys are counted per test in one global aggregate. The same lazy
    plan serves every input size; a value shared by many rows is one partial
    count per task.
    """
    tests = [s for s in specs if isinstance(s, Unique)]
    stacked = None
    for i, t in enumerate(tests):
        keys = (tables[t.table].select(F.lit(i).alias("test_ix"),
                                       F.col(t.column).cast("string").alias("k"))
                .where(F.col("k").isNotNull()))
        stacked = keys if stacked is None else stacked.unionByName(keys)
    dupes = stacked.groupBy("test_ix", "k").count().where(F.col("count") > 1)
    counted = dupes.agg(*[F.count(F.when(F.col("test_ix") == i, F.lit(1))).alias(f"d{i}")
                          for i in range(len(tests))])
    return _union([_per_test_rows(counted, tests, "unique", "d")])


def relationships(tables: Mapping[str, DataFrame], specs: Iterable) -> DataFrame:
    """Failures = child rows whose non-null key is missing from the parent.

    No join: the child keys and the parent keys of every test are tagged
    (test number, side) and stacked, and ONE aggregation per (test, key)
    counts the child rows and notes whether a parent row exists. Both sides
    are reduced map-side before the single shuffle (a hot child key or a
    duplicated parent key becomes one row per task), and the optimizer has
    no join to move below the aggregation. Null child keys pass.
    """
    tests = [s for s in specs if isinstance(s, Relationship)]
    stacked = None
    for i, t in enumerate(tests):
        child = tables[t.table].select(F.lit(i).alias("test_ix"),
                                       F.col(t.column).cast("string").alias("k"),
                                       F.lit(1).alias("child"))
        parent = tables[t.to_table].select(F.lit(i).alias("test_ix"),
                                           F.col(t.to_column).cast("string").alias("k"),
                                           F.lit(0).alias("child"))
        for part in (child, parent):
            part = part.where(F.col("k").isNotNull())
            stacked = part if stacked is None else stacked.unionByName(part)
    per_key = stacked.groupBy("test_ix", "k").agg(
        F.sum("child").alias("child_rows"),
        F.min("child").alias("min_side"))          # 0 when a parent row exists
    orphans = per_key.where(F.col("min_side") == 1)
    counted = orphans.agg(*[
        F.coalesce(F.sum(F.when(F.col("test_ix") == i, F.col("child_rows"))), F.lit(0))
        .alias(f"o{i}") for i in range(len(tests))])
    return _union([_per_test_rows(counted, tests, "relationships", "o")])


FRESHNESS_COLUMNS = ("table_name", "loaded_at_field", "max_loaded_at", "checked_at",
                     "age_seconds", "status")


def freshness(tables: Mapping[str, DataFrame], specs: Iterable[Freshness],
              cfg: Config) -> DataFrame:
    """PASS / WARN / ERROR by the age of the newest row; an empty table is ERROR."""
    warn_s, error_s = cfg.freshness_warn_hours * 3600, cfg.freshness_error_hours * 3600
    parts = []
    for t in specs:
        newest = tables[t.table].agg(
            F.max(F.col(t.loaded_at_field).cast("timestamp_ntz")).alias("max_loaded_at"))
        parts.append(newest.select(
            F.lit(t.table).alias("table_name"), F.lit(t.loaded_at_field).alias("loaded_at_field"),
            "max_loaded_at", cfg.now().alias("checked_at")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    age = F.expr("timestampdiff(SECOND, max_loaded_at, checked_at)")
    return out.withColumn("age_seconds", age).withColumn(
        "status",
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_s), "ERROR")
         .when(F.col("age_seconds") > warn_s, "WARN")
         .otherwise("PASS"))


def source_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every raw table (one global count each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
