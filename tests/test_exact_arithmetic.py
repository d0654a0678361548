"""Property tests: rounded ratios and averages are exact, in Spark and in the oracle SQL."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Context, Decimal

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankmart.functions import columns as C
from bankmart.functions import rules as R
from oracle import sql as O

CTX = Context(prec=80)
cents = st.integers(min_value=-10**13, max_value=10**13)


def to_money(c: int) -> Decimal:
    return Decimal(c).scaleb(-2)


def half_up(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP, context=CTX)


def expected_pct(n: Decimal, d: Decimal, places: int = 2):
    if d == 0:
        return None
    return half_up(CTX.divide(n * 100, d), places)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(cents, cents), min_size=1, max_size=150))
def test_pct_matches_decimal_math(spark, pairs):
    rows = [(i, to_money(a), to_money(b)) for i, (a, b) in enumerate(pairs)]
    rows.append((len(rows), to_money(2469), to_money(100)))          # 24.69 % exactly
    df = spark.createDataFrame(rows, "i int, n decimal(18,2), d decimal(18,2)")
    got = {r.i: r.p for r in df.select("i", C.pct("n", "d").alias("p")).collect()}
    for i, n, d in rows:
        assert got[i] == expected_pct(n, d), (n, d)

    con = duckdb.connect()
    con.register("t", df.toPandas())
    duck = dict(con.sql(f"SELECT i, {O.pct('n', 'd')} FROM t").fetchall())
    for i, n, d in rows:
        assert duck[i] == expected_pct(n, d), (n, d)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(cents, min_size=1, max_size=40), min_size=1, max_size=20))
def test_exact_avg_matches_decimal_math(spark, groups):
    rows = [(g, to_money(v)) for g, vals in enumerate(groups) for v in vals]
    df = spark.createDataFrame(rows, "g int, x decimal(18,2)")
    got = {r.g: r.a for r in df.groupBy("g").agg(
        C.exact_avg(F.sum("x"), F.count("x"), 6, 2).alias("a")).collect()}
    con = duckdb.connect()
    con.register("t", df.toPandas())
    duck = dict(con.sql(f"SELECT g, {O.avg_exact('x')} FROM t GROUP BY g").fetchall())
    for g, vals in enumerate(groups):
        total = sum((to_money(v) for v in vals), Decimal(0))
        want = half_up(CTX.divide(total, Decimal(len(vals))), 6)
        assert got[g] == want and duck[g] == want


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(cents, cents), min_size=1, max_size=150))
def test_threshold_tests_are_exact(spark, pairs):
    rows = [(i, to_money(b), to_money(lim)) for i, (b, lim) in enumerate(pairs)]
    # ratios sitting exactly on the thresholds
    rows += [(len(rows) + k, to_money(v * 9), to_money(v * 10)) for k, v in enumerate((7, 13))]
    rows += [(len(rows) + k, to_money(v * 7), to_money(v * 10)) for k, v in enumerate((3, 11))]
    df = spark.createDataFrame(rows, "i int, b decimal(18,2), l decimal(18,2)")
    got = {r.i: r.band for r in df.select(
        "i", R.utilization_band(F.col("b"), F.col("l")).alias("band")).collect()}
    for i, b, lim in rows:
        if lim == 0:
            want = "LOW"
        else:
            r = CTX.divide(b, lim)
            want = "HIGH" if r >= Decimal("0.90") else "MEDIUM" if r >= Decimal("0.70") else "LOW"
        assert got[i] == want, (b, lim)
