"""Run configuration: the "now" of a run, the transaction start date, the target.

Every age, tenure and rolling window depends on the current date. Models take
it from ``Config`` instead of calling ``current_date()`` directly, so a run can
be pinned (tests, backfills, reproducible reports) or left floating.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The project's run variable and freshness policy.
DEFAULT_START_DATE = "2022-01-01"
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48


@dataclass(frozen=True)
class Config:
    """Immutable run settings.

    as_of       the business date treated as "today"; None = current_date()
                of the query (views re-evaluate it when read).
    start_date  transactions dated before it are dropped in staging.
    env         target name (dev, prod).
    schema_prefix  the target schema, prefix of every layer's database; default:
                ``dbt_<env>`` (``<schema>_<layer>``, e.g. ``dbt_dev_staging``).
    checked_at  timestamp used by source freshness; None = midnight of
                ``as_of`` when pinned, else current_timestamp().
    """

    as_of: dt.date | None = None
    start_date: str = DEFAULT_START_DATE
    env: str = "dev"
    schema_prefix: str | None = None
    checked_at: dt.datetime | None = None
    freshness_warn_hours: int = FRESHNESS_WARN_HOURS
    freshness_error_hours: int = FRESHNESS_ERROR_HOURS
    layer_databases: dict[str, str] = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self):
        # accept ISO text for the dates, keep real date/datetime objects inside
        if isinstance(self.as_of, str):
            object.__setattr__(self, "as_of", dt.date.fromisoformat(self.as_of))
        if isinstance(self.checked_at, str):
            object.__setattr__(self, "checked_at", dt.datetime.fromisoformat(self.checked_at))
        dt.date.fromisoformat(self.start_date)          # fail early on a malformed start

    def today(self) -> Column:
        """The as-of date as a DATE column."""
        if self.as_of is None:
            return F.current_date()
        return F.lit(self.as_of)

    def now(self) -> Column:
        """The freshness reference point as a TIMESTAMP_NTZ column."""
        if self.checked_at is not None:
            return F.lit(self.checked_at).cast("timestamp_ntz")
        if self.as_of is not None:
            return F.lit(self.as_of).cast("timestamp_ntz")
        return F.current_timestamp().cast("timestamp_ntz")

    def start(self) -> Column:
        return F.lit(self.start_date).cast("date")

    def database(self, layer: str) -> str:
        """Database (schema) name for a layer, e.g. ``dbt_dev_staging``."""
        return self.layer_databases.get(layer, f"{self.schema_prefix or f'dbt_{self.env}'}_{layer}")


# The pinned settings used with the driver's test tables (see FIXTURES.md):
# the fixture dates run from 1995 to 2001, so "today" and the start variable
# are moved accordingly.
FIXTURE_AS_OF = dt.date(2001, 11, 5)
FIXTURE_START_DATE = "2000-01-01"
FIXTURE_CONFIG = Config(as_of=FIXTURE_AS_OF, start_date=FIXTURE_START_DATE)
