"""Column expressions; all of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CLASSES, COMMODITIES, EPSILON, STABLE_BAND, V2_BOUNDS


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def missing_as_null(x) -> Column:
    """NaN becomes NULL: in Spark NaN is larger than every number and aggregates keep it."""
    return F.nullif(col(x).cast("double"), F.lit(float("nan")))


def numeric(x) -> Column:
    """The number that a value of any type holds; NULL where it holds none."""
    return missing_as_null(col(x).try_cast("double"))


def safe_div(a, b) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(col(a), col(b))


def pct_change(a, b) -> Column:
    return (safe_div(a, b) - 1) * 100


# --- text ---------------------------------------------------------------


#: White space of any script, as a class of Java's expressions (whose \\s knows ASCII alone).
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def stripped(x) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(col(x), rf"\A{SPACE}+|{SPACE}+\z", "")


def normal_text(x) -> Column:
    """Runs of white space as one blank, none at the ends; missing as empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(x), F.lit("")), rf"{SPACE}+", " "))


def parse_price(x) -> Column:
    """Digits of a text as a number: signs, separators and decimal points fall away."""
    return F.nullif(F.regexp_replace(col(x), "[^0-9]", ""), F.lit("")).cast("double")


def is_roman(x) -> Column:
    return F.coalesce(stripped(x).rlike(r"(?i)\A[IVXLCDM]+\z"), F.lit(False))


def commodity_of(x, names: dict[str, str] = COMMODITIES) -> Column:
    pairs = [F.lit(v) for pair in names.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), col(x))


# --- calendar -----------------------------------------------------------


def calendar_parts(date="date") -> dict[str, Column]:
    d = col(date)
    return {
        "is_observed_source": F.lit(1),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
        "year": F.year(d),
        "month": F.month(d),
        "week_of_year": F.weekofyear(d),
        "day_of_week": F.weekday(d),
    }


def quarter(date="date") -> Column:
    return F.quarter(col(date))


def cycles() -> dict[str, Column]:
    out = {}
    for name, source, period in (("month", "month", 12), ("week", "week_of_year", 52), ("dow", "day_of_week", 7)):
        angle = 2 * F.pi() * F.col(source) / period
        out |= {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
    return out


def month_bucket(date="date") -> Column:
    return F.trunc(col(date), "MM")


# --- engineered features --------------------------------------------------


def gap_pct(a, b) -> Column:
    return (col(a) / (col(b) + EPSILON) - 1) * 100


def engineered() -> dict[str, Column]:
    return {
        "price_zscore_30d": (F.col("price_idr") - F.col("rolling_mean_30d")) / (F.col("rolling_std_30d") + EPSILON),
        "ma_gap_7_30_pct": gap_pct("rolling_mean_7d", "rolling_mean_30d"),
        "lag_gap_1_7_pct": gap_pct("price_lag_1d", "price_lag_7d"),
        "lag_gap_7_30_pct": gap_pct("price_lag_7d", "price_lag_30d"),
        "momentum_gap_7_30_pct": F.col("price_change_7d_pct") - F.col("price_change_30d_pct"),
        "volatility_x_momentum": F.col("volatility_30d_pct") * F.col("price_change_7d_pct"),
    }


# --- labels ---------------------------------------------------------------


def label_bounds(x, low, high) -> Column:
    """Below ``low`` Deflation, above ``high`` Inflation, else (missing too) Stable."""
    v = col(x)
    return F.when(v > high, "Inflation").when(v < low, "Deflation").otherwise("Stable")


def label_training(x, band: float = STABLE_BAND) -> Column:
    return label_bounds(x, -band, band)


def label_diagnostics(x, band: float = STABLE_BAND) -> Column:
    """As ``label_training``, but missing stays missing."""
    return F.when(col(x).isNotNull(), label_training(x, band))


def label_v2(x) -> Column:
    return label_bounds(x, *V2_BOUNDS)


def best_class(probabilities: dict[str, Column]) -> Column:
    """The class of the largest probability; ties go by the order of the classes."""
    top = F.greatest(*(probabilities[c] for c in CLASSES))
    return reduce(lambda out, c: F.when(probabilities[c] == top, c).otherwise(out), reversed(CLASSES), F.lit(None).cast("string"))


def all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def share(condition) -> Column:
    return F.avg(condition.cast("double"))
