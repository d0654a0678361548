"""Raw sources: schemas, declared tests, readers and the driver-table fixtures."""

from bankmart.sources.raw import RawTables  # noqa: F401
