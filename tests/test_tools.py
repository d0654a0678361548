"""The comparison tool's pandas path treats missing values alike and sorts rows."""

from __future__ import annotations

import importlib.util
from pathlib import Path

import pandas as pd

ROOT = Path(__file__).resolve().parents[1]


def _tool():
    spec = importlib.util.spec_from_file_location("compare_oracle",
                                                  ROOT / "tools" / "compare_oracle.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_pandas_rows_normalise_missing_values_and_order():
    tool = _tool()
    a = pd.DataFrame({"b": [2.5, None], "a": ["x", None]})
    b = pd.DataFrame({"a": [None, "x"], "b": [float("nan"), 2.5]})
    assert tool.pandas_rows(a) == tool.pandas_rows(b)
    c = pd.DataFrame({"a": ["x", None], "b": [2.0, None]})
    assert tool.pandas_rows(a) != tool.pandas_rows(c)
