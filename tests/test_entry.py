"""The driver adapter: inputs that change are read anew, nothing is swallowed."""

from __future__ import annotations

import shutil
import tempfile

import pytest

import __spark_entry__ as E


def test_replaced_input_is_read_again(spark, sf_small):
    folder = tempfile.mkdtemp(prefix="bankmart-in-")
    for t in E.DRIVER_TABLES:
        shutil.copyfile(f"{sf_small}/{t}.parquet", f"{folder}/{t}.parquet")
    query = E.queries()["src_row_counts"]

    def customers():
        return {r.table_name: r.row_count for r in query(spark, folder).collect()}["customers"]

    before = customers()
    shutil.copyfile("/root/testdata/sf0.01/customer.parquet", f"{folder}/customer.parquet")
    assert customers() == 10 * before


def test_no_shared_folder_fails_clearly(spark, sf_small, monkeypatch):
    monkeypatch.setattr(E, "checkpoint_dir", lambda _: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        E.stored_project(spark, f"{sf_small}/../sf0.001")
