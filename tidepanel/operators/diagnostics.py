"""Quality diagnostics of a panel: tidy frames, one aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLASSES, DEFAULT_LAGS, DEFAULT_LEADS, PRICE_FEATURES, STABLE_BAND, TARGET_VALUES, TIERS, Lag, Lead
from ..functions import calendar as C
from ..functions import exprs as E
from .runs import CHUNK_DAYS, day_gaps, longest_runs

STATS = ["price_idr", "price_change_1d_pct", "price_change_7d_pct", "price_change_30d_pct", "target_7d_inflation_pct", "target_30d_inflation_pct"]


def with_columns(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that the frame lacks, as missing values."""
    return frame.withColumns({c: F.lit(None).cast("double") for c in columns if c not in frame.columns})


def _keyed(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("commodity").isNotNull())


def canonical_overall(frame: DataFrame) -> DataFrame:
    """One row: rows, dates, null, invalid (null included) and non-positive prices."""
    price = E.numeric("price_idr")
    return frame.agg(
        F.count("*").alias("row_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_if(F.col("price_idr").isNull() | F.isnan(F.col("price_idr").try_cast("double"))).alias("null_prices"),
        F.count_if(price.isNull()).alias("invalid_prices"),
        F.count_if(price <= 0).alias("non_positive_prices"),
    )


def canonical_by_commodity(frame: DataFrame) -> DataFrame:
    return _keyed(frame).groupBy("commodity").agg(F.count("*").alias("rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def unexpected_commodities(frame: DataFrame, allowed) -> DataFrame:
    return frame.where(F.col("commodity").isNotNull() & ~F.col("commodity").isin(list(allowed))).select("commodity").distinct()


def gap_metrics(frame: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Observation counts, spans and gaps between distinct dates of each commodity."""
    gaps = day_gaps(_keyed(frame), "commodity", chunk_days)
    over = lambda n: F.coalesce(F.sum(F.when(F.col("gap") > n, F.col("n"))), F.lit(0)).alias(f"gap_gt_{n}_count")
    zero = lambda x, name: F.coalesce(x, F.lit(0.0)).alias(name)
    out = gaps.groupBy("commodity").agg(
        F.sum("n").alias("observation_count"),
        (F.max("last_day") - F.min("first_day") + 1).cast("bigint").alias("span_days"),
        zero(F.percentile("gap", F.lit(0.5), F.col("n")), "gap_median"),
        zero(F.percentile("gap", F.lit(0.9), F.col("n")), "gap_p90"),
        zero(F.max("gap").cast("double"), "gap_max"),
        *(over(n) for n in (1, 3, 7, 30)),
    )
    return out.withColumn("missing_day_ratio", (F.col("span_days") - F.col("observation_count")) / F.col("span_days"))


def strict_mask() -> Column:
    return E.all_present(PRICE_FEATURES)


def model_mask() -> Column:
    return E.all_present(TIERS["critical"])


def _feature_columns() -> dict[str, Column]:
    usable = {"strict": strict_mask(), "model": model_mask()}
    out = {"row_count": F.count("*")} | {f"{c}_non_null_rate": E.share(F.col(c).isNotNull()) for c in PRICE_FEATURES}
    for n, m in usable.items():
        out |= {f"{n}_feature_usable_rows": F.count_if(m), f"{n}_feature_usable_rate": E.share(m)}
    out |= {f"{t}_all_non_null_rate": E.share(E.all_present(columns)) for t, columns in TIERS.items()}
    return out | {f"{t}_{c}_non_null_rate": E.share(F.col(c).isNotNull()) for t, columns in TIERS.items() for c in columns}


def _target_columns() -> dict[str, Column]:
    out = {"row_count": F.count("*"), "strict_feature_usable_rows": F.count_if(strict_mask()), "model_feature_usable_rows": F.count_if(model_mask())}
    for h, c in TARGET_VALUES.items():
        there = F.col(c).isNotNull()
        out |= {f"target_{h}d_non_null_rate": E.share(there), f"target_{h}d_rows": F.count_if(there), f"strict_overlap_{h}d_rows": F.count_if(there & strict_mask()), f"trainable_rows_{h}d": F.count_if(there & model_mask())}
    return out


def _distribution_columns() -> dict[str, Column]:
    """Exact quantiles hold a commodity's distinct values in one task: as many as it has days, at most."""
    out = {}
    for c in STATS:
        x = E.numeric(c)
        out |= {f"{c}_count": F.count(x), f"{c}_min": F.min(x), f"{c}_p50": F.percentile(x, F.lit(0.5)), f"{c}_p90": F.percentile(x, F.lit(0.9)), f"{c}_max": F.max(x), f"{c}_mean": F.avg(x)}
    for k in ("1d", "7d", "30d"):
        a = F.abs(E.numeric(f"price_change_{k}_pct"))
        median = F.percentile(a, F.lit(0.5))
        out |= {f"max_abs_change_{k}": F.max(a), f"max_to_median_{k}": F.when(median > 0, F.max(a) / median)}
    return out


def _jump_columns(threshold: float) -> dict[str, Column]:
    return {"structural_jump_count": F.count_if(F.abs(E.numeric("price_change_1d_pct")) > threshold)}


def _window_columns() -> dict[str, Column]:
    usable = F.col("usable") & F.col("target").isNotNull()
    day = F.when(usable, F.col("date"))
    return {"first_date": F.min(day), "last_date": F.max(day), "usable_rows": F.count_if(usable), "span_days": F.coalesce(F.datediff(F.max(day), F.min(day)) + 1, F.lit(0))}


def _balance_columns() -> dict[str, Column]:
    count = {c: F.count_if(F.col("label") == c) for c in CLASSES}
    total = F.count("label")
    out = {"labelled_rows": total, "classes_present": sum((F.when(n > 0, 1).otherwise(0) for n in count.values()), F.lit(0))}
    for c, n in count.items():
        out |= {f"{c.lower()}_count": n, f"{c.lower()}_ratio": F.coalesce(E.safe_div(n, total), F.lit(0.0))}
    return out


def _grouped(frame: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    return frame.groupBy(*keys).agg(*(x.alias(n) for n, x in columns.items()))


def _by_commodity(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return _grouped(with_columns(_keyed(frame), PRICE_FEATURES + list(TARGET_VALUES.values()) + ["price_idr"]), ["commodity"], columns)


def feature_coverage(frame: DataFrame) -> DataFrame:
    """Non-null rates of features, tiers and usable rows of each commodity, in one aggregate."""
    return _by_commodity(frame, _feature_columns())


def profile(frame: DataFrame, jump: float = 8.0) -> DataFrame:
    """Coverage, targets, distribution and jumps of each commodity, all in one aggregate."""
    return _by_commodity(frame, _feature_columns() | _target_columns() | _distribution_columns() | _jump_columns(jump))


def first_valid_dates(frame: DataFrame) -> DataFrame:
    """commodity, feature, first_valid_date (null if there is none)."""
    own = with_columns(_keyed(frame), PRICE_FEATURES)
    wide = own.groupBy("commodity").agg(*(F.min(F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in PRICE_FEATURES))
    return wide.unpivot("commodity", PRICE_FEATURES, "feature", "first_valid_date")


def target_coverage(frame: DataFrame) -> DataFrame:
    return _by_commodity(frame, _target_columns())


def usable_totals(coverage: DataFrame) -> DataFrame:
    """One row: strict, model and trainable rows of all commodities, from ``target_coverage`` or ``profile``."""
    totals = ["strict_feature_usable_rows", "model_feature_usable_rows", *(f"trainable_rows_{h}d" for h in TARGET_VALUES)]
    return coverage.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_total") for c in totals))


def coverage(frame: DataFrame) -> DataFrame:
    """Feature and target coverage side by side; columns that both have get _x and _y."""
    features, targets = feature_coverage(frame), target_coverage(frame)
    keys = ["commodity", "row_count"]
    both = (set(features.columns) & set(targets.columns)) - set(keys)
    named = lambda f, end: f.select(*(F.col(c).alias(c + end if c in both else c) for c in f.columns))
    return named(features, "_x").join(named(targets, "_y"), keys, "full_outer")


def _by_horizon(frame: DataFrame) -> DataFrame:
    """A row for each row and horizon with its target as ``target``: a narrow expansion, no shuffle."""
    own = with_columns(_keyed(frame), PRICE_FEATURES + list(TARGET_VALUES.values()))
    pairs = F.explode(F.array(*(F.struct(F.lit(f"{h}d").alias("horizon"), F.col(c).alias("target")) for h, c in TARGET_VALUES.items())))
    return own.select("commodity", "date", model_mask().alias("usable"), pairs.alias("x")).select("commodity", "date", "usable", "x.horizon", "x.target")


def _labelled(frame: DataFrame, band: float) -> DataFrame:
    return _by_horizon(frame).withColumn("label", F.when(F.col("usable"), E.label_diagnostics("target", band)))


def training_windows(frame: DataFrame) -> DataFrame:
    return _grouped(_by_horizon(frame), ["commodity", "horizon"], _window_columns())


def class_balance(frame: DataFrame, band: float = STABLE_BAND, overall: bool = False) -> DataFrame:
    """Class counts and ratios of usable rows by commodity and horizon, or by horizon alone."""
    return _grouped(_labelled(frame, band), ["horizon"] if overall else ["commodity", "horizon"], _balance_columns())


def horizon_profile(frame: DataFrame, band: float = STABLE_BAND) -> DataFrame:
    """Training windows and class balance of each commodity and horizon, in one aggregate."""
    return _grouped(_labelled(frame, band), ["commodity", "horizon"], _window_columns() | _balance_columns())


def match_quality(frame: DataFrame, lags: dict[str, Lag] | None = None, leads: dict[str, Lead] | None = None, overall: bool = False) -> DataFrame:
    """How lags and targets found their rows: exactly, within the slack, or not.

    Only dates matter, so repeated keys don't disturb it.
    """
    lags = {k: x for k, x in (lags or DEFAULT_LAGS).items() if k != "1d"}
    leads = leads or DEFAULT_LEADS
    today = C.day()
    found = {f"lag_{k}": (C.matched_lag_day(x), today - x.days) for k, x in lags.items()} | {f"target_{k}": (C.matched_lead_day(x), today + x.days) for k, x in leads.items()}
    own = _keyed(frame).where(F.col("date").isNotNull())
    marked = own.select("commodity", *(F.struct((m == want).alias("exact"), m.isNotNull().alias("hit")).alias(k) for k, (m, want) in found.items()))
    long = marked.select("commodity", F.explode(F.array(*(F.struct(F.lit(k).alias("field"), F.col(k).alias("m")) for k in found))).alias("x")).select("commodity", "x.field", "x.m.*")
    exact, hit = F.coalesce("exact", F.lit(False)), F.col("hit")
    keys = ["field"] if overall else ["commodity", "field"]
    counts = {"exact": F.count_if(exact), "tolerance": F.count_if(hit & ~exact), "no_match": F.count_if(~hit)}
    return long.groupBy(*keys).agg(F.count("*").alias("rows"), *(c.alias(f"{n}_count") for n, c in counts.items()), *((c / F.count("*")).alias(f"{n}_ratio") for n, c in counts.items()))


def distribution_summary(frame: DataFrame) -> DataFrame:
    """Count, min, p50, p90, max, mean of prices, changes and targets, and extremes of the changes."""
    return _by_commodity(frame, _distribution_columns())


def flat_runs(frame: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """The longest run of equal prices in rows: 1 without a repeat, 0 without a price; a missing price breaks a run."""
    runs = longest_runs(_keyed(frame), "commodity", E.numeric("price_idr"), chunk_days)
    return runs.select("commodity", F.when(F.col("n_values") == 0, 0).otherwise(F.col("longest")).cast("bigint").alias("max_flatline_segment_days"))


def structural_jumps(frame: DataFrame, threshold: float = 8.0) -> DataFrame:
    return _by_commodity(frame, _jump_columns(threshold))


def section_columns() -> dict[str, list[str]]:
    """Columns of the sections that ``profile`` and ``horizon_profile`` hold."""
    own = {"features": _feature_columns(), "targets": _target_columns(), "distribution": _distribution_columns() | _jump_columns(8.0), "windows": _window_columns(), "balance": _balance_columns()}
    return {name: list(columns) for name, columns in own.items()}
