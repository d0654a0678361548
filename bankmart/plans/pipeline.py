"""Build the project: select layers or models, materialise them in order.

* Staging and intermediate models are catalog views, kept as Spark SQL text
  (``bankmart.plans.views``): other sessions read them, and each read runs over the raw
  tables as they are then. ``CREATE OR REPLACE VIEW`` swaps the text in one step, so
  readers never miss a view; a view that another one reads is created first, also when it
  was not selected and does not exist yet. Raw tables that are plans only
  (``raw.from_frames``) have no name to put in a text: their view models are session
  temp views. Marts are tables, fully replaced on every build.
* Every model and seed is in the database of its layer, ``<schema>_<layer>``
  (``dbt_dev_staging``, ``dbt_dev_gtm``, ``dbt_prod_finance``, ...).
* The load timestamp column is stamped only here, when a model is
  materialised; the model functions stay deterministic.
* A mart that reads another mart reads the *written* table, not a recomputed
  plan: the write is the boundary between the two jobs, which also cuts the
  lineage that a lost executor would otherwise have to replay. If it was neither
  selected nor built before, it is built first: a tie-out never counts a plan against itself.
* Before writing, the initial shuffle partition count is sized from the raw
  input's byte size when the session leaves it unset (AQE then coalesces).
* A table is published only after its job has committed: each build writes
  a new version folder under the warehouse, and the table is then pointed at
  it (metadata only). A job that fails, for instance after losing executors
  beyond the retry limit, leaves the previous version of the table in place.
  Older versions than the previous one are removed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.config import Config
from bankmart.plans import views
from bankmart.plans.project import Project
from bankmart.plans.sizing import input_bytes
from bankmart.sources.raw import RawTables, read_seed_customers

LOAD_TIMESTAMP = "dbt_loaded_at"


@dataclass(frozen=True)
class ModelSpec:
    name: str
    layer: str            # staging, intermediate, marts.gtm, marts.finance, marts.governance
    materialized: str     # view | table
    reads_tables: tuple[str, ...] = ()   # marts it reads as stored tables
    # columns each written file is sorted by (no shuffle): readers filtering
    # on them skip row groups by their min/max statistics
    cluster_by: tuple[str, ...] = ()


# Build order: a model only follows the models it depends on.
MODELS: tuple[ModelSpec, ...] = (
    ModelSpec("stg_customers", "staging", "view"),
    ModelSpec("stg_accounts", "staging", "view"),
    ModelSpec("stg_transactions", "staging", "view"),
    ModelSpec("stg_loans", "staging", "view"),
    ModelSpec("stg_credit_cards", "staging", "view"),
    ModelSpec("int_customer_accounts", "intermediate", "view"),
    ModelSpec("int_customer_financials", "intermediate", "view"),
    ModelSpec("mart_customer_360", "marts.gtm", "table",
              cluster_by=("customer_segment", "acquisition_channel", "lifecycle_stage")),
    ModelSpec("mart_acquisition_funnel", "marts.gtm", "table", ("mart_customer_360",)),
    ModelSpec("mart_portfolio_performance", "marts.finance", "table"),
    ModelSpec("mart_kpi_governance", "marts.governance", "table", ("mart_customer_360",)),
)
BY_NAME = {m.name: m for m in MODELS}


def layer_database(cfg: Config, layer: str) -> str:
    """``marts.finance`` -> ``<schema>_finance``; ``staging`` -> ``<schema>_staging``."""
    return cfg.database(layer.split(".")[-1])


def select_models(selectors: Iterable[str] | None) -> list[ModelSpec]:
    """Models matching any selector, in build order.

    A selector is a model name, a layer (``staging``, ``intermediate``,
    ``marts``, ``marts.gtm`` ...) or ``tag:<t>``; no model carries a tag, so
    a tag selects nothing. ``None`` selects everything.
    """
    if selectors is None:
        return list(MODELS)
    chosen = []
    sel = list(selectors)
    for m in MODELS:
        for s in sel:
            if s.startswith("tag:"):
                continue
            if s == m.name or m.layer == s or m.layer.startswith(s + "."):
                chosen.append(m)
                break
    return chosen


def with_load_timestamp(df: DataFrame) -> DataFrame:
    return df.withColumn(LOAD_TIMESTAMP, F.current_timestamp())


# The value that this module set, by session: a later build sizes anew.
_SIZED: dict[int, str] = {}


def size_initial_partitions(spark: SparkSession, raw: RawTables,
                            target_bytes: int = 128 * 1024 * 1024) -> int | None:
    """Set AQE's initial shuffle partition count from the raw input size.

    Only when the session did not configure it; a value set by an earlier
    build is replaced. Uses the size of the
    relations the raw tables read (file sizes for Parquet), so nothing is
    read; see ``bankmart.plans.sizing``.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = spark.conf.get(key, None)
    if current and current != _SIZED.get(id(spark)):
        return None
    total = sum(input_bytes(df) for _, df in raw.items())
    parallelism = spark.sparkContext.defaultParallelism
    n = max(parallelism, -(-total // target_bytes))
    spark.conf.set(key, str(n))
    _SIZED[id(spark)] = str(n)
    return n


KEEP_VERSIONS = 2   # the published one and the one before it


def _warehouse_root(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _prune_versions(spark: SparkSession, folder: str, keep: int, current: str) -> None:
    """Delete version folders beyond the newest ``keep``; never the current one."""
    fs, root = _hadoop_fs(spark, folder)
    if not fs.exists(root):
        return
    versions = sorted(st.getPath().getName() for st in fs.listStatus(root)
                      if st.isDirectory() and st.getPath().getName().startswith("v="))
    for name in versions[:-max(keep, 1)]:
        if name != current:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), True)


def publish_table(spark: SparkSession, df: DataFrame, target: str,
                  keep_versions: int = KEEP_VERSIONS) -> str:
    """Write ``df`` as a new version of table ``target``, then switch the table to it.

    The data job writes to ``<warehouse>/<db>/<table>/v=<build>``; only when
    it has committed does the table move to the new folder: with an unchanged
    schema by ``ALTER TABLE ... SET LOCATION`` (readers never see the table
    missing). A changed schema takes a new external table entry: the old one is dropped and
    the new one created, and a reader between the two finds no table. No data is
    touched by the switch. Returns the version folder.
    """
    db, table = target.split(".", 1)
    folder = f"{_warehouse_root(spark)}/{db}.db/{table}"
    name = f"v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"   # sorts by time
    version = f"{folder}/{name}"
    df.write.mode("errorifexists").parquet(version)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    shape = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    if spark.catalog.tableExists(target) and shape(spark.table(target).schema) == shape(df.schema):
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{version}'")
        spark.catalog.refreshTable(target)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        spark.catalog.createTable(target, path=version, source="parquet")
    _prune_versions(spark, folder, keep_versions, name)
    return version


def view_name(cfg: Config, model: str) -> str:
    return f"{layer_database(cfg, BY_NAME[model].layer)}.{model}"


def publish_view(spark: SparkSession, raw: RawTables, cfg: Config, model: str) -> str:
    """Create or replace the catalog view of a view model; returns its name.

    Views that it reads and that do not exist are created before it.
    """
    names = {m: view_name(cfg, m) for m in views.UPSTREAM}
    for upstream in views.UPSTREAM[model]:
        if not spark.catalog.tableExists(names[upstream]):
            publish_view(spark, raw, cfg, upstream)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {names[model].split('.')[0]}")
    query = views.view_text(model, cfg, raw.relations, names, raw.lenient)
    spark.sql(f"CREATE OR REPLACE VIEW {names[model]} AS "
              f"SELECT *, current_timestamp() AS {LOAD_TIMESTAMP} FROM ({query})")
    return names[model]


@dataclass
class BuildResult:
    built: dict[str, str] = field(default_factory=dict)   # model -> view/table name
    frames: dict[str, DataFrame] = field(default_factory=dict)


def build(spark: SparkSession, raw: RawTables, cfg: Config | None = None,
          select: Iterable[str] | None = None, write: bool = True) -> BuildResult:
    """Materialise the selected models; returns where each one went.

    With ``write=False`` nothing is written (tables become temp views too),
    which is handy for dry runs and tests.
    """
    cfg = cfg or Config()
    chosen = select_models(select)
    result = BuildResult()
    if not chosen:
        return result
    if write:
        missing = {u for m in chosen for u in m.reads_tables if not spark.catalog.tableExists(
            f"{layer_database(cfg, BY_NAME[u].layer)}.{u}")}
        chosen = [m for m in MODELS if m in chosen or m.name in missing]
    if write:
        size_initial_partitions(spark, raw)
    overrides: dict[str, DataFrame] = {}
    for spec in chosen:
        project = Project(raw, cfg, overrides)
        for upstream in spec.reads_tables:
            if upstream not in overrides and write:
                stored = f"{layer_database(cfg, BY_NAME[upstream].layer)}.{upstream}"
                overrides[upstream] = spark.table(stored).drop(LOAD_TIMESTAMP)
                project = Project(raw, cfg, overrides)
        df = project.model(spec.name)
        if spec.materialized == "table" and write:
            target = f"{layer_database(cfg, spec.layer)}.{spec.name}"
            out = with_load_timestamp(df)
            if spec.cluster_by:
                out = out.sortWithinPartitions(*spec.cluster_by)
            publish_table(spark, out, target)
            overrides[spec.name] = spark.table(target).drop(LOAD_TIMESTAMP)
            result.built[spec.name] = target
        elif write and raw.relations:
            result.built[spec.name] = publish_view(spark, raw, cfg, spec.name)
        else:
            with_load_timestamp(df).createOrReplaceTempView(spec.name)
            result.built[spec.name] = spec.name
        result.frames[spec.name] = df
    return result


def load_seed(spark: SparkSession, path: str, cfg: Config | None = None,
              name: str = "raw_customers") -> str:
    """Load the customer seed CSV as a table in ``<schema>_seeds``."""
    cfg = cfg or Config()
    target = f"{cfg.database('seeds')}.{name}"
    publish_table(spark, read_seed_customers(spark, path), target)
    return target
