"""Scalar column helpers, all built from JVM-side Spark expressions.

Each helper pins down a semantic that differs between SQL dialects (month
differences, day-of-week numbering, title case, rounding of ratios) so the
models read like the business rules instead of like dialect workarounds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "ColumnOrName", "MONEY", "RATE", "AMOUNT_SUM", "MONEY_AVG", "RATE_AVG",
    "col", "clean_upper", "clean_lower", "clean", "proper_case", "money", "rate", "nonzero",
    "pct", "count_pct", "exact_avg", "units", "from_units", "ratio_at_least", "flag", "flag_int", "as_date",
    "as_timestamp_ntz", "days_between", "months_between_boundaries", "month_start",
    "year_start", "day_of_week_sunday0", "years_before",
]

ColumnOrName = Column | str

MONEY = "decimal(18,2)"
RATE = "decimal(8,4)"
AMOUNT_SUM = "decimal(38,2)"   # sums and derived amounts/percentages
MONEY_AVG = "decimal(38,6)"    # averages of 2-decimal values
RATE_AVG = "decimal(38,8)"     # averages of 4-decimal rates


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -----------------------------------------------------------------

def clean_upper(c: ColumnOrName) -> Column:
    """upper(trim(x)); trim removes spaces only."""
    return F.upper(F.trim(col(c)))


def clean_lower(c: ColumnOrName) -> Column:
    return F.lower(F.trim(col(c)))


def clean(c: ColumnOrName) -> Column:
    return F.trim(col(c))


# The characters after which a new word starts (white space and
# these signs). Others, such as an apostrophe of either kind, an equals sign or a combining mark,
# stay inside a word. The space itself is initcap's own word break.
WORD_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>\t\n\r\f\v"
_WORD_BREAK = r"""([!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>\t\n\r\f\x0B])"""


def proper_case(c: ColumnOrName) -> Column:
    """Title case that also breaks words at punctuation: 'mary-jane' -> 'Mary-Jane'.

    Spark's initcap only breaks at spaces: a space is put after every other
    delimiter, initcap capitalises, and the added spaces are taken out again.
    Case is Unicode's ('élan' -> 'Élan'); an apostrophe does not
    break a word ("o'brien" -> "O'brien"), nor does a combining mark.
    """
    spaced = F.regexp_replace(F.lower(col(c)), _WORD_BREAK, "$1 ")
    return F.regexp_replace(F.initcap(spaced), _WORD_BREAK + " ", "$1")


# --- numbers --------------------------------------------------------------

def money(c: ColumnOrName) -> Column:
    return col(c).cast(MONEY)


def rate(c: ColumnOrName) -> Column:
    return col(c).cast(RATE)


def nonzero(c: ColumnOrName) -> Column:
    """nullif(x, 0): a zero divisor becomes null instead of an ANSI error."""
    c = col(c)
    return F.when(c != 0, c)


def _as_decimal(c: Column, int_digits: int, scale: int) -> Column:
    return c.cast(f"decimal({int_digits + scale},{scale})")


def pct(num: ColumnOrName, den: ColumnOrName, places: int = 2, num_scale: int = 2,
        den_scale: int = 2) -> Column:
    """round(num / nullif(den, 0) * 100, places), exact half-away-from-zero.

    The operands are narrowed before dividing so Spark keeps 14+ fractional
    digits in the quotient; the final round is then exact for any realistic
    magnitudes (Spark would otherwise keep only 6 digits for wide decimals
    and round twice).
    """
    n = _as_decimal(col(num), 22, num_scale) * 100
    d = _as_decimal(nonzero(den), 22, den_scale)
    return F.round(n / d, places).cast(f"decimal(38,{places})")


def count_pct(num: ColumnOrName, den: ColumnOrName, places: int = 2) -> Column:
    """round(count_a * 100.0 / nullif(count_b, 0), places) for integer counts."""
    return pct(num, den, places, num_scale=0, den_scale=0)


def exact_avg(total: ColumnOrName, count: ColumnOrName, places: int, total_scale: int) -> Column:
    """sum / count rounded half-up to ``places``; null when count is 0."""
    n = _as_decimal(col(total), 22, total_scale)
    d = _as_decimal(nonzero(count), 20, 0)
    return F.round(n / d, places).cast(f"decimal(38,{places})")


def units(c: ColumnOrName, scale: int = 2) -> Column:
    """A decimal with ``scale`` places as an exact count of its smallest unit (cents).

    Summing these longs is exact and much cheaper than summing decimals: a
    decimal sum is widened past 18 digits, where Spark leaves its compact
    64-bit representation for BigDecimal arithmetic. The capacity is that of
    a long: a group's sum of cents up to about 9.2e18 (9.2e16 in money). Under
    ANSI mode, which ``configure`` sets, a sum beyond it fails and never wraps.
    """
    return (col(c) * (10 ** scale)).cast("long")


def from_units(total: ColumnOrName, scale: int = 2) -> Column:
    """A sum of ``units`` back as decimal(38, scale), exactly."""
    return (col(total).cast("decimal(38,0)") / (10 ** scale)).cast(f"decimal(38,{scale})")


def ratio_at_least(num: ColumnOrName, den: ColumnOrName, threshold: str) -> Column:
    """num / den >= threshold, decided without dividing; null when den is 0/null.

    Comparing by multiplication keeps ratios that sit exactly on a threshold
    (0.70, 0.90) exact, and handles a negative divisor by flipping the sign.
    """
    from decimal import Decimal

    n, d = col(num), col(den)
    t = F.lit(Decimal(threshold))
    return (F.when(d > 0, n >= t * d)
             .when(d < 0, n <= t * d))


# --- booleans -------------------------------------------------------------

def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: null conditions give false."""
    return F.coalesce(cond, F.lit(False))


def flag_int(cond: Column) -> Column:
    """1 when cond holds, else 0 (null counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# --- dates ----------------------------------------------------------------

def as_date(c: ColumnOrName) -> Column:
    return col(c).cast("date")


def as_timestamp_ntz(c: ColumnOrName) -> Column:
    return col(c).cast("timestamp_ntz")


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of day boundaries from start to end (end - start)."""
    return F.datediff(col(end), col(start))


def months_between_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Month boundaries crossed from start to end: 31 Jan -> 1 Feb = 1.

    Not Spark's datediff(month, ...), which counts whole months (that pair
    would give 0).
    """
    s, e = col(start), col(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def month_start(c: ColumnOrName) -> Column:
    """First day of the month, still a DATE."""
    return F.trunc(col(c), "MM")


def year_start(c: ColumnOrName) -> Column:
    return F.trunc(col(c), "YEAR")


def day_of_week_sunday0(c: ColumnOrName) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark's dayofweek starts at 1)."""
    return F.dayofweek(col(c)) - 1


def years_before(c: ColumnOrName, years: int = 1) -> Column:
    """Same calendar day n years earlier, as a DATE (29 Feb -> 28 Feb)."""
    return F.add_months(col(c), -12 * years)
