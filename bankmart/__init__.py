"""bankmart: retail-banking staging, roll-ups, marts and data-quality checks on Spark."""

from bankmart.config import FIXTURE_CONFIG, Config  # noqa: F401

__version__ = "0.1.0"
