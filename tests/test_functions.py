"""Column helpers, business rules and the public functions on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bankmart.functions import columns as C
from bankmart.functions import macros as G
from bankmart.functions import rules as R


def one(spark, expr, schema, *rows):
    df = spark.createDataFrame(list(rows), schema)
    return [r[0] for r in df.select(expr).collect()]


def test_proper_case_breaks_at_punctuation(spark):
    got = one(spark, C.proper_case("n"), "n string",
              ("mary-jane o'brien mc.donald",), ("NATION_0",), (None,), ("élan VITAL-josé",),
              ("a-  b",), ("x-",), ("anne\tmarie",))
    assert got == ["Mary-Jane O'brien Mc.Donald", "Nation_0", None, "Élan Vital-José",
                   "A-  B", "X-", "Anne\tMarie"]


def test_trim_removes_spaces_only(spark):
    got = one(spark, C.clean_upper("s"), "s string", ("  retail ",), ("\tretail",))
    assert got == ["RETAIL", "\tRETAIL"]


def test_month_boundaries_not_whole_months(spark):
    got = one(spark, C.months_between_boundaries("a", "b"), "a date, b date",
              (dt.date(2024, 1, 31), dt.date(2024, 2, 1)),
              (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
              (dt.date(2023, 12, 15), dt.date(2024, 1, 14)),
              (dt.date(2024, 3, 1), dt.date(2024, 1, 1)))
    assert got == [1, 0, 1, -2]


def test_day_of_week_sunday_is_zero(spark):
    got = one(spark, C.day_of_week_sunday0("d"), "d date",
              (dt.date(2024, 3, 3),), (dt.date(2024, 3, 9),))
    assert got == [0, 6]


def test_month_start_stays_a_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),)], "d date")
    out = df.select(C.month_start("d").alias("m"), C.month_start("d").cast("string").alias("s"))
    assert out.schema["m"].dataType.simpleString() == "date"
    assert out.first()["s"] == "2024-03-01"


def test_year_before_leap_day(spark):
    got = one(spark, C.years_before("d"), "d date", (dt.date(2024, 2, 29),))
    assert got == [dt.date(2023, 2, 28)]


def test_pct_rounds_half_away_from_zero(spark):
    schema = "n decimal(18,3), d decimal(18,3)"
    rows = [(Decimal("2.345"), Decimal("100")), (Decimal("-2.345"), Decimal("100")),
            (Decimal("1"), Decimal("0")), (None, Decimal("1")), (Decimal("1"), Decimal("3"))]
    got = one(spark, C.pct("n", "d", 2, 3, 3), schema, *rows)
    assert got == [Decimal("2.35"), Decimal("-2.35"), None, None, Decimal("33.33")]


def test_exact_avg_single_rounding(spark):
    # 32 values summing to an odd number of cents: the exact mean ends in 5 at the 7th place
    df = spark.createDataFrame([(Decimal("0.01"),)] + [(Decimal("0.00"),)] * 31, "x decimal(18,2)")
    got = df.agg(C.exact_avg(F.sum("x"), F.count("x"), 6, 2).alias("a")).first()["a"]
    assert got == Decimal("0.000313")  # 0.0003125 rounded half up


def test_safe_divide(spark):
    schema = "n decimal(18,2), d decimal(18,2)"
    got = one(spark, G.safe_divide("n", "d"), schema,
              (Decimal("5"), Decimal("2")), (Decimal("5"), Decimal("0")), (Decimal("5"), None),
              (None, Decimal("2")))
    assert got[0] == Decimal("2.5") and got[1] == 0 and got[2] == 0 and got[3] is None
    got = one(spark, G.safe_divide("n", "d", default=-1), schema, (Decimal("5"), Decimal("0")))
    assert got == [-1]


def test_utilization_bands_on_exact_thresholds(spark):
    schema = "b decimal(18,2), l decimal(18,2)"
    rows = [(Decimal("90.00"), Decimal("100.00")), (Decimal("89.99"), Decimal("100.00")),
            (Decimal("70.00"), Decimal("100.00")), (Decimal("69.99"), Decimal("100.00")),
            (Decimal("10.00"), Decimal("0.00")), (None, Decimal("100.00")),
            (Decimal("10.00"), None), (Decimal("-95.00"), Decimal("-100.00")),
            (Decimal("10.00"), Decimal("-100.00"))]
    got = one(spark, R.utilization_band(F.col("b"), F.col("l")), schema, *rows)
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW", "LOW", "HIGH", "LOW"]
    assert one(spark, G.utilization_risk("b", "l"), schema, *rows) == got


def test_risk_tier_and_delinquency_prefix(spark):
    rows = [("CURRENT",), ("DELINQUENT_30",), ("DELINQUENT_60",), ("DELINQUENT_90",),
            ("CHARGED_OFF",), ("PAID_OFF",), ("DELINQUENT_120",), (None,), ("current",)]
    tiers = one(spark, G.delinquency_bucket("s"), "s string", *rows)
    assert tiers == ["1_CURRENT", "2_DPD_30", "3_DPD_60", "4_DPD_90", "5_CHARGED_OFF",
                     "0_PAID_OFF", "9_UNKNOWN", "9_UNKNOWN", "9_UNKNOWN"]
    delinquent = one(spark, R.is_delinquent(F.col("s")), "s string", *rows)
    assert delinquent == [False, True, True, True, False, False, True, False, False]


def test_account_category(spark):
    got = one(spark, R.account_category(F.col("t")), "t string",
              ("CHECKING",), ("MONEY_MARKET",), ("CD",), ("INVESTMENT",), ("BROKERAGE",), (None,))
    assert got == ["DEPOSIT", "DEPOSIT", "TERM_DEPOSIT", "INVESTMENT", "OTHER", "OTHER"]


def test_signed_amount(spark):
    rows = [("CREDIT", Decimal("-5.00")), ("INTEREST", Decimal("5.00")), ("DEBIT", Decimal("5.00")),
            ("FEE", Decimal("-5.00")), ("TRANSFER", Decimal("-5.00")), (None, Decimal("5.00"))]
    got = one(spark, R.signed_amount(F.col("t"), F.col("a")), "t string, a decimal(18,2)", *rows)
    assert got == [Decimal("5.00"), Decimal("5.00"), Decimal("-5.00"), Decimal("-5.00"),
                   Decimal("-5.00"), Decimal("5.00")]


def test_engagement_score_is_capped(spark):
    schema = "m long, d int, bal decimal(38,2), p boolean"
    got = one(spark, R.engagement_score(F.col("m"), F.col("d"), F.col("bal"), F.col("p")), schema,
              (13, 3, Decimal("20000"), True), (0, 0, Decimal("10000"), False),
              (2, 1, Decimal("10000.01"), True))
    assert got == [100, 0, 10 + 15 + 20 + 10]


def test_lifecycle_order(spark):
    schema = "t int, m long, d int"
    rows = [(90, 12, 3), (-5, 0, 0), (91, 0, 3), (91, 3, 3), (91, 9, 2), (91, 9, 1),
            (None, 0, 0), (None, 10, 2)]
    got = one(spark, R.lifecycle_stage(F.col("t"), F.col("m"), F.col("d")), schema, *rows)
    assert got == ["ONBOARDING", "ONBOARDING", "DORMANT", "AT_RISK", "LOYAL", "ACTIVE",
                   "DORMANT", "LOYAL"]


def test_churn_and_ltv(spark):
    got = one(spark, R.churn_risk(F.col("m"), F.col("t")), "m long, t int",
              (0, 91), (0, 90), (0, None), (2, 500), (3, 500))
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "MEDIUM", "LOW"]
    got = one(spark, R.ltv_tier(F.col("v")), "v decimal(38,2)",
              (Decimal("100000"),), (Decimal("99999.99"),), (Decimal("25000"),),
              (Decimal("5000"),), (Decimal("4999.99"),), (Decimal("-1"),))
    assert got == ["TIER_1_HIGH_VALUE", "TIER_2_MID_VALUE", "TIER_2_MID_VALUE",
                   "TIER_3_STANDARD", "TIER_4_LOW_VALUE", "TIER_4_LOW_VALUE"]


def test_months_and_days_since(spark):
    today = F.lit(dt.date(2024, 6, 15))
    got = one(spark, G.months_since("d", today), "d date", (dt.date(2024, 5, 31),))
    assert got == [1]
    got = one(spark, G.days_since("d", today), "d date", (dt.date(2024, 6, 1),))
    assert got == [14]


def test_surrogate_key_renders_null(spark):
    import hashlib

    got = one(spark, G.surrogate_key("a", "b"), "a string, b string", ("x", None), (None, None))
    assert got == [hashlib.md5(b"x|NULL").hexdigest(), hashlib.md5(b"NULL|NULL").hexdigest()]


def test_flag_never_null(spark):
    got = one(spark, C.flag(F.col("x") == "A"), "x string", ("A",), ("B",), (None,))
    assert got == [True, False, False]


def test_config_accepts_iso_text():
    import datetime as _dt

    import pytest as _pytest

    from bankmart.config import Config

    cfg = Config(as_of="2024-06-15", checked_at="2024-06-16T01:00")
    assert cfg.as_of == _dt.date(2024, 6, 15)
    assert cfg.checked_at == _dt.datetime(2024, 6, 16, 1, 0)
    with _pytest.raises(ValueError):
        Config(start_date="15/06/2024")


def test_proper_case_delimiters(spark):
    """A fixed list of delimiters breaks words; marks, both apostrophes and '=' do not."""
    cases = {"mary-jane": "Mary-Jane", "o'brien": "O'brien", "d\u2019angelo": "D\u2019angelo",
             "a=b": "A=b", "rene\u0301e": "Rene\u0301e", "JEAN-luc  PAUL": "Jean-Luc  Paul",
             "x_y/z": "X_Y/Z", "tab\tname": "Tab\tName", "\u00e9lan (jr.)": "\u00c9lan (Jr.)", "": ""}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "x string, want string")
    for r in df.select("want", C.proper_case("x").alias("got")).collect():
        assert r.got == r.want
