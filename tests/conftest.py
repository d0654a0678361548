from __future__ import annotations

import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from bankmart.config import Config  # noqa: E402
from bankmart.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="bankmart-wh-")
    session = local_session("*", shuffle_partitions=8, app_name="bankmart-tests",
                            warehouse=warehouse,
                            extra={"spark.sql.catalogImplementation": "in-memory"})
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_of_other_modules(request):
    """Session temp views that another module's tests have left would be listed beside the views of every database."""
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for found in session.catalog.listTables():
            if found.isTemporary:
                session.catalog.dropTempView(found.name)


@pytest.fixture(scope="session")
def sf_small() -> str:
    return SF_SMALL


@pytest.fixture
def cfg() -> Config:
    return Config(as_of=dt.date(2024, 6, 15), start_date="2022-01-01")
