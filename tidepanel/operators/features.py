"""Panel to features to targets, labels and the time split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_LAGS, DEFAULT_LEADS, DEFAULT_ROLLING, MODEL_FEATURES, STABLE_BAND, TARGET_CLASSES, TARGET_VALUES
from ..functions import calendar as C
from ..functions import exprs as E
from .checks import require_columns, require_input_contract, unique_day
from .quantiles import exact_quantiles


def _complete(given, default: dict, what: str) -> dict:
    """An empty or missing choice is the default; another must name just the default's keys."""
    if not given:
        return default
    if set(given) != set(default):
        raise ValueError(f"{what} needs the keys {sorted(default)}, not {sorted(given)}")
    return given


def canonical(panel: DataFrame) -> DataFrame:
    """date, commodity, price_idr with proper types; rows without a commodity are left out."""
    return panel.where(F.col("commodity").isNotNull()).select(F.col("date").cast("date").alias("date"), "commodity", E.missing_as_null("price_idr").alias("price_idr"))


def _with_chunks(panel: DataFrame, chunk_days: int, back: int, ahead: int) -> DataFrame:
    """Copies of rows for each chunk of days whose frames may reach them."""
    d = C.day()
    first = F.floor((d - F.lit(ahead)) / chunk_days).cast("int")
    last = F.floor((d + F.lit(back)) / chunk_days).cast("int")
    # A row without a date has no day to be sent to; it keeps one copy, in a chunk of its own.
    return panel.withColumn("_chunk", F.explode_outer(F.sequence(first, last)))


def feature_ready(panel: DataFrame, lags=None, rolling=None, leads=None, check: bool = True, chunk_days: int | None = None) -> DataFrame:
    """Calendar parts, lags, changes and trailing statistics; with ``leads`` the forward targets too.

    One exchange, one sort and one window serve all of them. ``check`` asserts
    that no (date, commodity) repeats: the same window counts the rows of each
    day, and a second one is an error when the rows are computed (for an error
    at once there is ``checks.require_unique_keys``). ``chunk_days`` splits each
    commodity's history into chunks (with the few weeks that frames reach
    copied over), for panels of few commodities and long histories.
    """
    require_columns(panel, ["date", "commodity", "price_idr"])
    lags, rolling = _complete(lags, DEFAULT_LAGS, "lags"), _complete(rolling, DEFAULT_ROLLING, "rolling")
    base = canonical(panel)
    keys = C.KEYS
    if chunk_days:
        back = max([x.days + x.slack for x in lags.values()] + [x.days for x in rolling.values()])
        ahead = max([x.days + x.slack for x in (leads or DEFAULT_LEADS).values()])
        # A row serves the frames of rows up to ``back`` days later and ``ahead`` days earlier.
        base, keys = _with_chunks(base, chunk_days, back, ahead), (*C.KEYS, "_chunk")
    windows = {f"price_lag_{k}": C.asof_lag("price_idr", lags[k], keys) for k in ("1d", "7d", "30d")}
    windows |= {f"rolling_{k}": C.trailing_mean("price_idr", rolling[k], keys) for k in ("mean_7d", "mean_30d")}
    windows["rolling_std_30d"] = C.trailing_std("price_idr", rolling["std_30d"], keys)
    windows |= {f"_future_{h}": C.asof_lead("price_idr", x, keys) for h, x in (leads or {}).items()}
    if check:
        windows["_same_day"] = F.count("*").over(C.frame(0, 0, keys))
    out = base.select("*", *(c.alias(n) for n, c in windows.items()))
    if check:
        out = out.where(unique_day("_same_day")).drop("_same_day")
    if chunk_days:
        out = out.where(F.floor(C.day() / chunk_days).eqNullSafe(F.col("_chunk")))
    changes = {f"price_change_{k}_pct": E.pct_change("price_idr", f"price_lag_{k}") for k in ("1d", "7d", "30d")}
    ratios = {"price_vs_ma30_pct": E.pct_change("price_idr", "rolling_mean_30d"), "volatility_30d_pct": E.safe_div("rolling_std_30d", "rolling_mean_30d") * 100}
    targets = {f"target_{h}_inflation_pct": E.pct_change(f"_future_{h}", "price_idr") for h in leads or {}}
    made = E.calendar_parts() | {k: F.col(k) for k in windows if k.startswith("price_lag")} | changes | {k: F.col(k) for k in windows if k.startswith("rolling")} | ratios | targets
    return out.select("date", "commodity", "price_idr", *(c.alias(n) for n, c in made.items()))


def training_targets(frame: DataFrame, leads=None) -> DataFrame:
    """Add target_<h>_inflation_pct: the change to the first observation in the horizon's days."""
    require_columns(frame, ["date", "commodity", "price_idr"])
    leads = _complete(leads, DEFAULT_LEADS, "leads")
    own = frame.where(F.col("commodity").isNotNull())
    futures = {h: C.asof_lead("price_idr", x) for h, x in leads.items()}
    return own.select("*", *(E.pct_change(c, "price_idr").alias(f"target_{h}_inflation_pct") for h, c in futures.items()))


def training_ready(panel: DataFrame, lags=None, rolling=None, leads=None, check: bool = True, chunk_days: int | None = None) -> DataFrame:
    """Features and targets from one window."""
    return feature_ready(panel, lags, rolling, _complete(leads, DEFAULT_LEADS, "leads"), check, chunk_days)


def base_features(frame: DataFrame) -> DataFrame:
    """Row-local model features of a feature-ready frame; nothing looks at another row, so one row scores as a batch does."""
    require_input_contract(frame)
    clean = frame.withColumns({c: E.missing_as_null(c) for c, t in frame.dtypes if t in ("double", "float")})
    return clean.withColumns(E.cycles() | E.engineered())


def model_columns(frame: DataFrame) -> DataFrame:
    require_columns(frame, MODEL_FEATURES)
    return frame.select(*MODEL_FEATURES)


def attach_targets(frame: DataFrame, band: float = STABLE_BAND) -> DataFrame:
    require_columns(frame, TARGET_VALUES.values())
    return frame.withColumns({TARGET_CLASSES[h]: E.label_training(E.missing_as_null(v), band) for h, v in TARGET_VALUES.items()})


def split_cutoffs(frame: DataFrame, train: float = 0.70, valid: float = 0.85) -> DataFrame:
    """One row: the last dates of train and validation, by position among the distinct dates.

    Positions are floor(n x share) in double arithmetic. The ranks run over
    distinct dates alone, which are as few as days.
    """
    dates = frame.where(F.col("date").isNotNull()).select("date").distinct()
    ranked = dates.select("date", (F.row_number().over(Window.orderBy("date")) - 1).alias("_i"))
    n = dates.agg(F.count("*").alias("_n"))
    at = lambda s: F.floor(F.col("_n") * F.lit(float(s)))
    return ranked.crossJoin(F.broadcast(n)).agg(F.max(F.when(F.col("_i") == at(train), F.col("date"))).alias("train_end"), F.max(F.when(F.col("_i") == at(valid), F.col("date"))).alias("valid_end"))


def time_split(frame: DataFrame, target: str = "target_7d_class", train: float = 0.70, valid: float = 0.85) -> DataFrame:
    """Add split: train up to the first cutoff, valid up to the second, test after it."""
    require_columns(frame, [target])
    joined = frame.crossJoin(F.broadcast(split_cutoffs(frame, train, valid)))
    split = F.when(F.col("date") <= F.col("train_end"), "train").when(F.col("date") <= F.col("valid_end"), "valid").otherwise("test")
    return joined.withColumn("split", split).drop("train_end", "valid_end")


def quantile_bounds(frame: DataFrame, value: str, stable_share: float, split: str = "train") -> tuple[float | None, float | None]:
    """(low, high): exact quantiles of the train rows that leave ``stable_share`` between them, computed at once."""
    tail = (1 - stable_share) / 2
    # Each counting round reads the values; the windows behind them are computed once.
    values = frame.where(F.col("split") == split).select(value).persist()
    try:
        low, high = exact_quantiles(values, {value: [tail, 1 - tail]})[value]
    finally:
        values.unpersist()
    return low, high


def label_by_quantiles(frame: DataFrame, value: str, stable_share: float, out: str) -> DataFrame:
    """Without train rows nothing lies beyond a bound, so all is Stable."""
    low, high = (F.lit(x).cast("double") for x in quantile_bounds(frame, value, stable_share))
    return frame.withColumn(out, E.label_bounds(value, low, high))


def high_vol_regime(frame: DataFrame, value: str = "volatility_30d_pct") -> DataFrame:
    """Add high_vol_regime: 1 where volatility is at least its commodity's upper quartile, else (missing too) 0.

    The quartile is an aggregate of its own joined back, so a commodity with
    very many rows is no single window partition.
    """
    quartile = frame.where(F.col("commodity").isNotNull()).groupBy("commodity").agg(F.percentile(value, F.lit(0.75)).alias("_q75"))
    joined = frame.join(quartile, "commodity", "left")
    return joined.withColumn("high_vol_regime", F.coalesce(F.col(value) >= F.col("_q75"), F.lit(False)).cast("int")).drop("_q75")
