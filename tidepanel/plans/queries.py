"""Named queries over panels derived from the transaction tables, and the same in DuckDB SQL.

The panel of most queries has o_orderpriority as commodity and the day's
highest o_totalprice as price, missing on days of the month that 17 divides.
Window means and deviations are rounded, for sums depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CHANGES, CLASSES, CYCLES, DEFAULT_LAGS, DEFAULT_LEADS, DEFAULT_ROLLING, ENGINEERED, LAGS, PRICE_FEATURES, TARGET_VALUES, TIERS, DiagnosticsConfig
from ..functions import calendar as C
from ..functions import exprs as E
from ..operators import analytics as A
from ..operators import diagnostics as D
from ..operators import features as P
from ..operators import gate
from ..operators import models as M
from ..operators.checks import duplicate_pairs
from ..operators.grouped import grouped_quantiles
from ..sources import panels
from ..sources.panels import orders_panel, table, with_gaps

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _r(x, n: int = 6):
    return F.round(x, n)


def rounded(frame: DataFrame, n: int = 6) -> DataFrame:
    return frame.select(*(F.round(c, n).alias(c) if t == "double" else F.col(c) for c, t in frame.dtypes))


# --- shared parts of the plans -------------------------------------------------


def panel(spark, sf):
    return with_gaps(orders_panel(spark, sf))


def ready(spark, sf):
    """Features and targets; keys are unique by construction of the panel."""
    return P.training_ready(panel(spark, sf), check=False)


def labelled(spark, sf):
    return P.attach_targets(ready(spark, sf))


def scored(spark, sf):
    """An error frame without a model: the trailing 7-day change's label predicts the forward label."""
    frame = P.high_vol_regime(labelled(spark, sf)).where("target_7d_inflation_pct is not null and price_change_7d_pct is not null")
    confidence = F.abs("price_change_7d_pct") / (F.abs("price_change_7d_pct") + 1)
    return A.error_frame(frame, F.col("target_7d_class"), E.label_training("price_change_7d_pct"), confidence)


# --- shared parts of the SQL ---------------------------------------------------

PANEL = """panel AS (SELECT o_orderpriority AS commodity, CAST(o_orderdate AS DATE) AS date,
  CASE WHEN day(CAST(o_orderdate AS DATE)) % 17 <> 0 THEN max(o_totalprice) END AS price_idr
  FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1, CAST(o_orderdate AS DATE))"""


def _frame(a: str, b: str) -> str:
    return f"(PARTITION BY commodity ORDER BY date RANGE BETWEEN {a} AND {b})"


def _back(a: int, b: int) -> str:
    return _frame(f"INTERVAL {a} DAY PRECEDING", f"INTERVAL {b} DAY PRECEDING")


def _trail(n: int) -> str:
    return _frame(f"INTERVAL {n} DAY PRECEDING", "CURRENT ROW")


def _ahead(a: int, b: int) -> str:
    return _frame(f"INTERVAL {a} DAY FOLLOWING", f"INTERVAL {b} DAY FOLLOWING")


def _pct(a: str, b: str) -> str:
    return f"({a} / nullif({b}, 0) - 1) * 100"


WINDOWS = f"""windows AS (SELECT *,
  last_value(price_idr) OVER {_back(1, 1)} AS price_lag_1d,
  last_value(price_idr) OVER {_back(8, 7)} AS price_lag_7d,
  last_value(price_idr) OVER {_back(32, 30)} AS price_lag_30d,
  avg(price_idr) OVER {_trail(7)} AS rolling_mean_7d,
  avg(price_idr) OVER {_trail(30)} AS rolling_mean_30d,
  stddev_samp(price_idr) OVER {_trail(30)} AS rolling_std_30d,
  first_value(price_idr) OVER {_ahead(7, 10)} AS future_7d,
  first_value(price_idr) OVER {_ahead(30, 37)} AS future_30d FROM panel)"""

CALENDAR = """1 AS is_observed_source, CAST(day(date) = 1 AS INTEGER) AS is_month_start,
  CAST(date = last_day(date) AS INTEGER) AS is_month_end, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(week(date) AS INTEGER) AS week_of_year, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week"""

READY = f"""ready AS (SELECT date, commodity, price_idr, {CALENDAR}, price_lag_1d, price_lag_7d, price_lag_30d,
  {_pct('price_idr', 'price_lag_1d')} AS price_change_1d_pct, {_pct('price_idr', 'price_lag_7d')} AS price_change_7d_pct,
  {_pct('price_idr', 'price_lag_30d')} AS price_change_30d_pct, rolling_mean_7d, rolling_mean_30d, rolling_std_30d,
  {_pct('price_idr', 'rolling_mean_30d')} AS price_vs_ma30_pct, rolling_std_30d / nullif(rolling_mean_30d, 0) * 100 AS volatility_30d_pct,
  {_pct('future_7d', 'price_idr')} AS target_7d_inflation_pct, {_pct('future_30d', 'price_idr')} AS target_30d_inflation_pct FROM windows)"""


def _label(x: str, low="-1.0", high="1.0") -> str:
    return f"CASE WHEN {x} > {high} THEN 'Inflation' WHEN {x} < {low} THEN 'Deflation' ELSE 'Stable' END"


LABELLED = f"""labelled AS (SELECT *, {_label('target_7d_inflation_pct')} AS target_7d_class,
  {_label('target_30d_inflation_pct')} AS target_30d_class FROM ready)"""
SPLIT = """days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM panel)),
  cuts AS (SELECT max(CASE WHEN i = floor(n * CAST(0.70 AS DOUBLE)) THEN date END) AS a, max(CASE WHEN i = floor(n * CAST(0.85 AS DOUBLE)) THEN date END) AS b FROM days),
  split AS (SELECT labelled.*, CASE WHEN date <= a THEN 'train' WHEN date <= b THEN 'valid' ELSE 'test' END AS split FROM labelled, cuts)"""
REGIME = """quartiles AS (SELECT commodity AS c, quantile_cont(volatility_30d_pct, 0.75) AS q FROM ready GROUP BY 1),
  regime AS (SELECT labelled.*, CAST(coalesce(volatility_30d_pct >= q, false) AS INTEGER) AS high_vol_regime FROM labelled JOIN quartiles ON c = commodity)"""
ERRORS = f"""scored AS (SELECT *, target_7d_class AS true_class, {_label('price_change_7d_pct')} AS pred_class,
  abs(price_change_7d_pct) / (abs(price_change_7d_pct) + 1) AS confidence FROM regime
  WHERE target_7d_inflation_pct IS NOT NULL AND price_change_7d_pct IS NOT NULL),
  errors AS (SELECT *, CAST(true_class = pred_class AS INTEGER) AS is_correct, 1 - CAST(true_class = pred_class AS INTEGER) AS is_error FROM scored)"""


def sql(select: str, *parts: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


def on_panel(select: str) -> str:
    return sql(select, PANEL)


def on_windows(select: str) -> str:
    return sql(select, PANEL, WINDOWS)


def on_ready(select: str) -> str:
    return sql(select, PANEL, WINDOWS, READY)


def on_labels(select: str) -> str:
    return sql(select, PANEL, WINDOWS, READY, LABELLED)


def on_split(select: str) -> str:
    return sql(select, PANEL, WINDOWS, READY, LABELLED, SPLIT)


def on_errors(select: str) -> str:
    return sql(select, PANEL, WINDOWS, READY, LABELLED, REGIME, ERRORS)


# --- calendar operators ----------------------------------------------------------


def _lag_query(key: str, spark, sf):
    return panel(spark, sf).select("date", "commodity", C.asof_lag("price_idr", DEFAULT_LAGS[key]).alias("lag_price"))


@query(on_windows("SELECT date, commodity, price_lag_1d AS lag_price FROM windows"))
def calendar_lag_exact_1d(spark, sf):
    return _lag_query("1d", spark, sf)


@query(on_windows("SELECT date, commodity, price_lag_7d AS lag_price FROM windows"))
def calendar_lag_7d(spark, sf):
    return _lag_query("7d", spark, sf)


@query(on_windows("SELECT date, commodity, price_lag_30d AS lag_price FROM windows"))
def calendar_lag_30d(spark, sf):
    return _lag_query("30d", spark, sf)


def _lead_query(key: str, spark, sf):
    future = panel(spark, sf).withColumn("future_price", C.asof_lead("price_idr", DEFAULT_LEADS[key]))
    return future.select("date", "commodity", "future_price", E.pct_change("future_price", "price_idr").alias("target"))


@query(on_windows(f"SELECT date, commodity, future_7d AS future_price, {_pct('future_7d', 'price_idr')} AS target FROM windows"))
def forward_target_7d(spark, sf):
    return _lead_query("7d", spark, sf)


@query(on_windows(f"SELECT date, commodity, future_30d AS future_price, {_pct('future_30d', 'price_idr')} AS target FROM windows"))
def forward_target_30d(spark, sf):
    return _lead_query("30d", spark, sf)


@query(on_windows("SELECT date, commodity, round(rolling_mean_7d, 6) AS value FROM windows"))
def rolling_mean_7d(spark, sf):
    return panel(spark, sf).select("date", "commodity", _r(C.trailing_mean("price_idr", DEFAULT_ROLLING["mean_7d"]), 6).alias("value"))


@query(on_windows("SELECT date, commodity, round(rolling_mean_30d, 6) AS value FROM windows"))
def rolling_mean_30d(spark, sf):
    return panel(spark, sf).select("date", "commodity", _r(C.trailing_mean("price_idr", DEFAULT_ROLLING["mean_30d"]), 6).alias("value"))


@query(on_windows("SELECT date, commodity, round(rolling_std_30d, 4) AS value FROM windows"))
def rolling_std_30d(spark, sf):
    return panel(spark, sf).select("date", "commodity", _r(C.trailing_std("price_idr", DEFAULT_ROLLING["std_30d"]), 4).alias("value"))


@query(on_ready("SELECT date, commodity, price_change_1d_pct, price_change_7d_pct, price_change_30d_pct FROM ready"))
def price_change_pct(spark, sf):
    return ready(spark, sf).select("date", "commodity", *CHANGES)


@query(on_ready("SELECT date, commodity, round(price_vs_ma30_pct, 4) AS price_vs_ma30_pct, round(volatility_30d_pct, 4) AS volatility_30d_pct FROM ready"))
def volatility_30d(spark, sf):
    return rounded(ready(spark, sf).select("date", "commodity", "price_vs_ma30_pct", "volatility_30d_pct"), 4)


@query(on_panel(f"SELECT date, commodity, {CALENDAR} FROM panel"))
def calendar_parts(spark, sf):
    return panel(spark, sf).select("date", "commodity", *(c.alias(n) for n, c in E.calendar_parts().items()))


def _rounded_list(columns, n=6):
    return ", ".join(f"round({c}, {n}) AS {c}" for c in columns)


_KEYS = "date, commodity, price_idr, is_observed_source, is_month_start, is_month_end, year, month, week_of_year, day_of_week"


@query(on_ready(f"SELECT {_KEYS}, {_rounded_list(PRICE_FEATURES)} FROM ready"))
def feature_ready(spark, sf):
    out = P.feature_ready(panel(spark, sf))
    return out.select(*(F.round(c, 6).alias(c) if c in PRICE_FEATURES else F.col(c) for c in out.columns))


@query(on_ready(f"SELECT {_KEYS}, {_rounded_list([*PRICE_FEATURES, *TARGET_VALUES.values()])} FROM ready"))
def training_ready(spark, sf):
    out = P.training_ready(panel(spark, sf))
    return out.select(*(F.round(c, 6).alias(c) if c in [*PRICE_FEATURES, *TARGET_VALUES.values()] else F.col(c) for c in out.columns))


@query(on_ready(f"SELECT date, commodity, {_rounded_list([*LAGS, *TARGET_VALUES.values()])} FROM ready"))
def training_ready_chunked(spark, sf):
    """The same windows with each history split into chunks of days, for long histories of few commodities."""
    out = P.training_ready(panel(spark, sf), check=False, chunk_days=180)
    return out.select("date", "commodity", *(F.round(c, 6).alias(c) for c in [*LAGS, *TARGET_VALUES.values()]))


# --- row-local features and labels -------------------------------------------------

_ANGLES = {"month": "month / 12", "week": "week_of_year / 52", "dow": "day_of_week / 7"}
_CYCLE_SQL = ", ".join(f"round({f}(2 * pi() * {a}), 6) AS {n}_{f}" for n, a in _ANGLES.items() for f in ("sin", "cos"))


@query(on_ready(f"SELECT date, commodity, {_CYCLE_SQL} FROM ready"))
def cyclical_features(spark, sf):
    return rounded(P.base_features(ready(spark, sf)).select("date", "commodity", *CYCLES))


@query(
    on_ready(
        """SELECT date, commodity, round((price_idr - rolling_mean_30d) / (rolling_std_30d + 1e-6), 4) AS price_zscore_30d,
  round((rolling_mean_7d / (rolling_mean_30d + 1e-6) - 1) * 100, 4) AS ma_gap_7_30_pct, round((price_lag_1d / (price_lag_7d + 1e-6) - 1) * 100, 4) AS lag_gap_1_7_pct,
  round((price_lag_7d / (price_lag_30d + 1e-6) - 1) * 100, 4) AS lag_gap_7_30_pct, round(price_change_7d_pct - price_change_30d_pct, 4) AS momentum_gap_7_30_pct,
  round(volatility_30d_pct * price_change_7d_pct, 4) AS volatility_x_momentum FROM ready"""
    )
)
def engineered_gaps(spark, sf):
    return rounded(P.base_features(ready(spark, sf)).select("date", "commodity", *ENGINEERED), 4)


@query(on_labels("SELECT date, commodity, target_7d_class, target_30d_class FROM labelled"))
def label_training(spark, sf):
    return labelled(spark, sf).select("date", "commodity", "target_7d_class", "target_30d_class")


@query(on_ready(f"SELECT date, commodity, CASE WHEN target_7d_inflation_pct IS NOT NULL THEN {_label('target_7d_inflation_pct')} END AS label FROM ready"))
def label_diagnostics(spark, sf):
    return ready(spark, sf).select("date", "commodity", E.label_diagnostics("target_7d_inflation_pct").alias("label"))


@query(on_ready(f"SELECT date, commodity, {_label('target_30d_inflation_pct', '-1.4153', '2.0380')} AS label FROM ready"))
def label_fixed_v2(spark, sf):
    return ready(spark, sf).select("date", "commodity", E.label_v2("target_30d_inflation_pct").alias("label"))


@query(
    on_split(
        f"""SELECT date, commodity, split, {_label('target_30d_inflation_pct', 'low', 'high')} AS label
  FROM split, (SELECT quantile_cont(target_30d_inflation_pct, CAST(0.3 AS DOUBLE)) AS low, quantile_cont(target_30d_inflation_pct, CAST(0.7 AS DOUBLE)) AS high FROM split WHERE split = 'train')"""
    )
)
def label_quantile_band(spark, sf):
    split = P.time_split(labelled(spark, sf))
    return P.label_by_quantiles(split, "target_30d_inflation_pct", 0.40, "label").select("date", "commodity", "split", "label")


@query(on_split("SELECT date, commodity, split FROM split"))
def time_split(spark, sf):
    return P.time_split(labelled(spark, sf)).select("date", "commodity", "split")


@query(on_errors("SELECT date, commodity, high_vol_regime FROM regime"))
def high_vol_regime(spark, sf):
    return P.high_vol_regime(labelled(spark, sf)).select("date", "commodity", "high_vol_regime")


# --- ingest ------------------------------------------------------------------------


@query("SELECT o_orderkey, TRY_CAST(nullif(regexp_replace(CASE WHEN o_orderkey % 11 = 0 THEN '-' ELSE format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) END, '[^0-9]', '', 'g'), '') AS DOUBLE) AS price FROM orders")
def parse_price_text(spark, sf):
    text = F.when(F.col("o_orderkey") % 11 == 0, "-").otherwise(F.format_number(F.floor("o_totalprice"), 0))
    return table(spark, sf, "orders").select("o_orderkey", E.parse_price(text).alias("price"))


@query(
    "SELECT l_orderkey, l_linenumber, field, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_discount AS discount, l_tax AS tax FROM lineitem) ON quantity, discount, tax INTO NAME field VALUE value)"
)
def wide_to_long(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return rows.unpivot(["l_orderkey", "l_linenumber"], ["quantity", "discount", "tax"], "field", "value")


# --- diagnostics ---------------------------------------------------------------------


@query("SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS commodity, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    rows = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("commodity"))
    return duplicate_pairs(rows)


@query(on_panel("SELECT commodity, count(*) AS rows, min(date) AS min_date, max(date) AS max_date FROM panel GROUP BY 1"))
def canonical_summary(spark, sf):
    return D.canonical_by_commodity(panel(spark, sf))


@query(on_panel("SELECT count(*) AS row_count, min(date) AS min_date, max(date) AS max_date, count(*) FILTER (WHERE price_idr IS NULL) AS null_prices, count(*) FILTER (WHERE price_idr IS NULL) AS invalid_prices, count(*) FILTER (WHERE price_idr <= 0) AS non_positive_prices FROM panel"))
def canonical_overall(spark, sf):
    return D.canonical_overall(panel(spark, sf))


@query(on_panel("SELECT DISTINCT commodity FROM panel WHERE commodity NOT IN ('1-URGENT', '2-HIGH')"))
def unexpected_commodities(spark, sf):
    return D.unexpected_commodities(panel(spark, sf), ("1-URGENT", "2-HIGH"))


_GAPS = """SELECT commodity, count(*) AS observation_count, CAST(max(d) - min(d) + 1 AS BIGINT) AS span_days,
  coalesce(quantile_cont(CAST(gap AS DOUBLE), 0.5), 0.0) AS gap_median, round(coalesce(quantile_cont(CAST(gap AS DOUBLE), 0.9), 0.0), 6) AS gap_p90, coalesce(CAST(max(gap) AS DOUBLE), 0.0) AS gap_max,
  count(*) FILTER (WHERE gap > 1) AS gap_gt_1_count, count(*) FILTER (WHERE gap > 3) AS gap_gt_3_count, count(*) FILTER (WHERE gap > 7) AS gap_gt_7_count, count(*) FILTER (WHERE gap > 30) AS gap_gt_30_count,
  round(CAST(max(d) - min(d) + 1 - count(*) AS DOUBLE) / (max(d) - min(d) + 1), 6) AS missing_day_ratio
  FROM (SELECT commodity, d, d - lag(d) OVER (PARTITION BY commodity ORDER BY d) AS gap FROM (SELECT DISTINCT commodity, date - DATE '1970-01-01' AS d FROM panel)) GROUP BY 1"""


@query(on_panel(_GAPS))
def gap_metrics(spark, sf):
    return rounded(D.gap_metrics(panel(spark, sf)))


_STRICT, _MODEL = (" AND ".join(f"{c} IS NOT NULL" for c in columns) for columns in (PRICE_FEATURES, TIERS["critical"]))


def _rate(cond: str) -> str:
    return f"round(avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END), 6)"


_COVERAGE = (
    "SELECT commodity, count(*) AS row_count, "
    + ", ".join(f"{_rate(f'{c} IS NOT NULL')} AS {c}_non_null_rate" for c in PRICE_FEATURES)
    + "".join(f", count(*) FILTER (WHERE {m}) AS {n}_feature_usable_rows, {_rate(m)} AS {n}_feature_usable_rate" for n, m in (("strict", _STRICT), ("model", _MODEL)))
    + "".join(f", {_rate(' AND '.join(f'{c} IS NOT NULL' for c in cs))} AS {t}_all_non_null_rate" for t, cs in TIERS.items())
    + "".join(f", {_rate(f'{c} IS NOT NULL')} AS {t}_{c}_non_null_rate" for t, cs in TIERS.items() for c in cs)
    + " FROM ready GROUP BY 1"
)


@query(on_ready(_COVERAGE))
def feature_coverage(spark, sf):
    return rounded(D.feature_coverage(ready(spark, sf)))


@query(on_ready(" UNION ALL ".join(f"SELECT commodity, '{c}' AS feature, min(CASE WHEN {c} IS NOT NULL THEN date END) AS first_valid_date FROM ready GROUP BY 1" for c in PRICE_FEATURES)))
def first_valid_dates(spark, sf):
    return D.first_valid_dates(ready(spark, sf))


_TARGETS = (
    f"SELECT commodity, count(*) AS row_count, count(*) FILTER (WHERE {_STRICT}) AS strict_feature_usable_rows, count(*) FILTER (WHERE {_MODEL}) AS model_feature_usable_rows"
    + "".join(
        f", {_rate(f'{c} IS NOT NULL')} AS target_{h}d_non_null_rate, count({c}) AS target_{h}d_rows, count(*) FILTER (WHERE {c} IS NOT NULL AND {_STRICT}) AS strict_overlap_{h}d_rows, count(*) FILTER (WHERE {c} IS NOT NULL AND {_MODEL}) AS trainable_rows_{h}d"
        for h, c in TARGET_VALUES.items()
    )
    + " FROM ready GROUP BY 1"
)


@query(on_ready(_TARGETS))
def target_coverage(spark, sf):
    return rounded(D.target_coverage(ready(spark, sf)))


_HORIZON = " UNION ALL ".join(f"SELECT commodity, date, '{h}d' AS horizon, {c} AS target, ({_MODEL}) AS usable FROM ready" for h, c in TARGET_VALUES.items())


@query(
    on_ready(
        f"""SELECT commodity, horizon, min(date) FILTER (WHERE usable AND target IS NOT NULL) AS first_date, max(date) FILTER (WHERE usable AND target IS NOT NULL) AS last_date,
  count(*) FILTER (WHERE usable AND target IS NOT NULL) AS usable_rows,
  CAST(coalesce(max(date) FILTER (WHERE usable AND target IS NOT NULL) - min(date) FILTER (WHERE usable AND target IS NOT NULL) + 1, 0) AS INTEGER) AS span_days FROM ({_HORIZON}) GROUP BY 1, 2"""
    )
)
def training_windows(spark, sf):
    return D.training_windows(ready(spark, sf))


def _balance_sql(keys: str) -> str:
    counts = {c: f"count(*) FILTER (WHERE label = '{c}')" for c in CLASSES}
    present = " + ".join(f"CASE WHEN {n} > 0 THEN 1 ELSE 0 END" for n in counts.values())
    each = "".join(f", {n} AS {c.lower()}_count, round(coalesce(CAST({n} AS DOUBLE) / nullif(count(label), 0), 0.0), 6) AS {c.lower()}_ratio" for c, n in counts.items())
    label = f"CASE WHEN usable AND target IS NOT NULL THEN {_label('target')} END"
    return f"SELECT {keys}, count(label) AS labelled_rows, CAST({present} AS INTEGER) AS classes_present{each} FROM (SELECT *, {label} AS label FROM ({_HORIZON})) GROUP BY {keys}"


@query(on_ready(_balance_sql("commodity, horizon")))
def class_balance(spark, sf):
    return rounded(D.class_balance(ready(spark, sf)))


@query(on_ready(_balance_sql("horizon")))
def class_balance_overall(spark, sf):
    return rounded(D.class_balance(ready(spark, sf), overall=True))


_MATCHES = {"lag_7d": ("max", _back(8, 7), "date - 7"), "lag_30d": ("max", _back(32, 30), "date - 30"), "target_7d": ("min", _ahead(7, 10), "date + 7"), "target_30d": ("min", _ahead(30, 37), "date + 30")}
_MATCH_ROWS = " UNION ALL ".join(f"SELECT commodity, '{k}' AS field, {f}(date) OVER {w} AS hit, {want} AS want FROM panel" for k, (f, w, want) in _MATCHES.items())


def _match_sql(keys: str) -> str:
    kinds = {"exact": "hit = want", "tolerance": "hit <> want", "no_match": "hit IS NULL"}
    counts = "".join(f", count(*) FILTER (WHERE {c}) AS {n}_count, round(CAST(count(*) FILTER (WHERE {c}) AS DOUBLE) / count(*), 6) AS {n}_ratio" for n, c in kinds.items())
    return f"SELECT {keys}, count(*) AS rows{counts} FROM ({_MATCH_ROWS}) GROUP BY {keys}"


@query(on_panel(_match_sql("commodity, field")))
def match_quality(spark, sf):
    return rounded(D.match_quality(panel(spark, sf)))


@query(on_panel(_match_sql("field")))
def match_quality_overall(spark, sf):
    return rounded(D.match_quality(panel(spark, sf), overall=True))


_STATS_SQL = ", ".join(f"count({c}) AS {c}_count, round(min({c}), 4) AS {c}_min, round(quantile_cont({c}, 0.5), 4) AS {c}_p50, round(quantile_cont({c}, 0.9), 4) AS {c}_p90, round(max({c}), 4) AS {c}_max, round(avg({c}), 4) AS {c}_mean" for c in D.STATS)
_EXTREMES_SQL = ", ".join(f"round(max(abs(price_change_{k}_pct)), 4) AS max_abs_change_{k}, round(max(abs(price_change_{k}_pct)) / nullif(median(abs(price_change_{k}_pct)), 0), 4) AS max_to_median_{k}" for k in ("1d", "7d", "30d"))


@query(on_ready(f"SELECT commodity, {_STATS_SQL}, {_EXTREMES_SQL} FROM ready GROUP BY 1"))
def distribution_summary(spark, sf):
    return rounded(D.distribution_summary(ready(spark, sf)), 4)


_FLAT_PANEL = "flat AS (SELECT o_orderpriority AS commodity, CAST(o_orderdate AS DATE) AS date, floor(max(o_totalprice) / 100000) AS price_idr FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2)"


@query(
    sql(
        """SELECT commodity, CAST(CASE WHEN sum(prices) = 0 THEN 0 ELSE max(repeats) + 1 END AS BIGINT) AS max_flatline_segment_days FROM (
  SELECT commodity, island, count(*) FILTER (WHERE same) AS repeats, count(price_idr) AS prices FROM (
  SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY commodity ORDER BY date) AS island FROM (
  SELECT *, coalesce(price_idr = lag(price_idr) OVER (PARTITION BY commodity ORDER BY date), false) AS same FROM flat)) GROUP BY 1, 2) GROUP BY 1""",
        _FLAT_PANEL,
    )
)
def flatline_runs(spark, sf):
    coarse = orders_panel(spark, sf).withColumn("price_idr", F.floor(F.col("price_idr") / 100000).cast("double"))
    return D.flat_runs(coarse)


@query(on_ready("SELECT commodity, count(*) FILTER (WHERE abs(price_change_1d_pct) > 8.0) AS structural_jump_count FROM ready GROUP BY 1"))
def structural_jumps(spark, sf):
    return D.structural_jumps(ready(spark, sf))


def _rule(rule: str, subject: str, value: str, warn: str, fail: str, above: bool, source: str) -> str:
    """Rows of one rule in SQL; ``source`` is a parenthesized select."""
    return f"SELECT '{rule}' AS rule, {subject} AS subject, CAST({value} AS DOUBLE) AS value, CAST({warn} AS DOUBLE) AS warn_bound, CAST({fail} AS DOUBLE) AS fail_bound, {str(above).lower()} AS above FROM {source}"


_WINDOW_ROWS = f"SELECT commodity, horizon, coalesce(max(date) FILTER (WHERE usable AND target IS NOT NULL) - min(date) FILTER (WHERE usable AND target IS NOT NULL) + 1, 0) AS span_days FROM ({_HORIZON}) GROUP BY 1, 2"
_FLAT_ROWS = """SELECT commodity, CASE WHEN sum(prices) = 0 THEN 0 ELSE max(repeats) + 1 END AS flat FROM (SELECT commodity, island, count(*) FILTER (WHERE same) AS repeats, count(price_idr) AS prices FROM (
  SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY commodity ORDER BY date) AS island FROM (
  SELECT *, coalesce(price_idr = lag(price_idr) OVER (PARTITION BY commodity ORDER BY date), false) AS same FROM panel)) GROUP BY 1, 2) GROUP BY 1"""
_EXTREME_ROWS = "SELECT commodity, abs(quantile_cont(price_change_1d_pct, 0.9)) AS p90, count(*) FILTER (WHERE abs(price_change_1d_pct) > 8.0) AS jumps, " + ", ".join(
    f"max(abs(price_change_{k}_pct)) / nullif(median(abs(price_change_{k}_pct)), 0) AS ratio_{k}" for k in ("1d", "7d", "30d")
) + " FROM ready GROUP BY 1"
_TOTALS = "SELECT " + ", ".join(f"coalesce(sum(trainable_rows_{h}d), 0) AS t{h}" for h in (7, 30)) + f" FROM ({_TARGETS})"
_RULE_ROWS = [
    _rule("null_prices", "'all'", "avg(CASE WHEN price_idr IS NULL THEN 1.0 ELSE 0.0 END)", "NULL", "0.01", True, "panel"),
    _rule("non_positive_prices", "'all'", "avg(CASE WHEN price_idr <= 0 THEN 1.0 ELSE 0.0 END)", "NULL", "0.0", True, "panel"),
    _rule("duplicates", "'all'", "count(*)", "NULL", "0", True, "(SELECT date, commodity FROM panel GROUP BY 1, 2 HAVING count(*) > 1)"),
    _rule("unexpected", "'all'", "count(DISTINCT commodity)", "NULL", "0", True, "(SELECT commodity FROM panel WHERE commodity NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))"),
    _rule("missing_days", "commodity", "missing_day_ratio", "0.35", "0.6", True, f"({_GAPS})"),
    *(_rule("critical_feature", f"commodity || ' {f}'", f"{f}_non_null_rate", "0.55", "0.35", False, f"({_COVERAGE})") for f in TIERS["critical"]),
    _rule("model_rows", "commodity", "model_feature_usable_rate", "0.4", "NULL", False, f"({_COVERAGE})"),
    *(_rule("target_rate_low", f"commodity || ' {h}d'", f"target_{h}d_non_null_rate", "0.25", "NULL", False, f"({_TARGETS})") for h in (7, 30)),
    *(_rule("target_rate_least", f"commodity || ' {h}d'", f"target_{h}d_non_null_rate", "NULL", "0.2", False, f"({_TARGETS})") for h in (7, 30)),
    *(_rule("trainable", f"commodity || ' {h}d'", f"trainable_rows_{h}d", "NULL", n, False, f"({_TARGETS})") for h, n in ((7, "20"), (30, "12"))),
    *(_rule("trainable_total", f"'{h}d'", f"t{h}", "NULL", n, False, f"({_TOTALS})") for h, n in ((7, "50"), (30, "30"))),
    _rule("span", "commodity || ' ' || horizon", "span_days", "NULL", "CASE WHEN horizon = '7d' THEN 45 ELSE 60 END", False, f"({_WINDOW_ROWS})"),
    _rule("classes", "commodity || ' ' || horizon", "classes_present", "NULL", "2", False, f"({_balance_sql('commodity, horizon')})"),
    *(_rule("class_ratio", f"commodity || ' ' || horizon || ' {c}'", f"{c.lower()}_ratio", "0.05", "0.01", False, f"({_balance_sql('commodity, horizon')})") for c in CLASSES),
    _rule("tolerance", "field", "tolerance_ratio", "0.5", "0.8", True, f"({_match_sql('field')})"),
    _rule("no_match", "field", "no_match_ratio", "0.8", "NULL", True, f"({_match_sql('field')})"),
    _rule("p90_change", "commodity", "p90", "50.0", "150.0", True, f"({_EXTREME_ROWS})"),
    *(_rule("max_to_median", f"commodity || ' {k}'", f"ratio_{k}", "20.0", "50.0", True, f"({_EXTREME_ROWS})") for k in ("1d", "7d", "30d")),
    _rule("flat", "commodity", "flat", "21", "45", True, f"({_FLAT_ROWS})"),
    _rule("jumps", "commodity", "CASE WHEN jumps > 0 THEN ratio_1d END", "8.0", "15.0", True, f"({_EXTREME_ROWS})"),
]
_BEYOND = "coalesce(CASE WHEN above THEN value > {b} ELSE value < {b} END, false)"
_VERDICT = f"CASE WHEN {_BEYOND.format(b='fail_bound')} THEN 'FAIL' WHEN {_BEYOND.format(b='warn_bound')} THEN 'WARN' ELSE 'PASS' END"


@query(on_ready(f"SELECT rule, subject, round(value, 4) AS value, warn_bound, fail_bound, above, {_VERDICT} AS verdict FROM ({' UNION ALL '.join(_RULE_ROWS)})"))
def readiness_rules(spark, sf):
    config = DiagnosticsConfig(allowed_commodities=("1-URGENT", "2-HIGH", "3-MEDIUM"))
    return rounded(gate.judged(panel(spark, sf), ready(spark, sf), config), 4)


# --- analytics ------------------------------------------------------------------------


@query(on_ready(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS missing_pct FROM ready" for c in ["price_idr", *PRICE_FEATURES])))
def missing_summary(spark, sf):
    return rounded(A.missing_summary(ready(spark, sf).select("price_idr", *PRICE_FEATURES)))


@query(on_ready(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std, round(min({c}), 3) AS min, round(quantile_cont({c}, 0.25), 3) AS p25, round(quantile_cont({c}, 0.5), 3) AS p50, round(quantile_cont({c}, 0.75), 3) AS p75, round(max({c}), 3) AS max FROM ready" for c in ("price_idr", "price_lag_7d", "price_change_7d_pct"))))
def describe_panel(spark, sf):
    return rounded(A.describe(ready(spark, sf), ["price_idr", "price_lag_7d", "price_change_7d_pct"]), 3)


_CORR = ["price_idr", *PRICE_FEATURES, *TARGET_VALUES.values()]


@query(on_ready(" UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM ready" for i, a in enumerate(_CORR) for b in _CORR[i + 1 :])))
def correlation_matrix(spark, sf):
    return rounded(A.correlation_matrix(ready(spark, sf), _CORR))


@query(on_ready("SELECT CAST(date_trunc('month', date) AS DATE) AS month, commodity, round(avg(price_idr), 4) AS mean_price_idr, round(avg(target_7d_inflation_pct), 4) AS mean_target_7d_inflation_pct FROM ready GROUP BY 1, 2"))
def monthly_mean_price(spark, sf):
    return rounded(A.monthly_means(ready(spark, sf), ["price_idr", "target_7d_inflation_pct"]), 4)


@query(on_split("SELECT split, target_7d_class AS label, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY split) * 100, 6) AS share_pct FROM split GROUP BY 1, 2"))
def class_share_by_split(spark, sf):
    return rounded(A.class_share(P.time_split(labelled(spark, sf)), "target_7d_class", ["split"]))


@query(on_ready("SELECT commodity, round(avg(price_idr), 4) AS mean_price_idr, round(stddev_samp(price_idr), 4) AS std_price_idr, round(avg(target_7d_inflation_pct), 4) AS mean_target_7d_inflation_pct, round(stddev_samp(target_7d_inflation_pct), 4) AS std_target_7d_inflation_pct FROM ready GROUP BY 1"))
def volatility_summary(spark, sf):
    return rounded(A.volatility_summary(ready(spark, sf), ["price_idr", "target_7d_inflation_pct"]), 4)


@query("SELECT count(DISTINCT o_orderpriority) AS n_commodities, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_dates FROM orders")
def distinct_counts(spark, sf):
    return table(spark, sf, "orders").agg(F.countDistinct("o_orderpriority").alias("n_commodities"), F.countDistinct(F.to_date("o_orderdate")).alias("n_dates"))


_BANDS = {"band_1": 1.0, "band_2": 2.0, "band_2_5": 2.5}
_SCHEMES = " UNION ALL ".join(f"SELECT split, '{n}' AS scheme, {_label('target_30d_inflation_pct', f'-{b}', str(b))} AS label FROM split" for n, b in _BANDS.items())


@query(on_split("SELECT scheme, split, " + ", ".join(f"{_rate(f'label = {chr(39)}{c}{chr(39)}').replace('round(', 'round(100 * ')} AS {c.lower()}_pct" for c in CLASSES) + f" FROM ({_SCHEMES}) GROUP BY 1, 2"))
def label_scheme_summary(spark, sf):
    frame = P.time_split(labelled(spark, sf)).withColumns({n: E.label_training("target_30d_inflation_pct", b) for n, b in _BANDS.items()})
    return rounded(A.label_scheme_summary(frame, {n: n for n in _BANDS}))


@query(on_split("SELECT commodity, " + ", ".join(f"round(avg(CASE WHEN split = '{s}' THEN CASE WHEN target_7d_class = 'Stable' THEN 1.0 ELSE 0.0 END END) * 100, 6) AS {s}" for s in ("train", "valid", "test")) + " FROM split GROUP BY 1"))
def stable_share_pivot(spark, sf):
    return rounded(A.stable_share_pivot(P.time_split(labelled(spark, sf)), "target_7d_class"))


_ERROR = "count(*) AS n, round(avg(is_correct), 6) AS accuracy, round(avg(is_error), 6) AS error_rate, round(avg(confidence), 6) AS mean_confidence"


@query(on_errors(f"SELECT commodity, {_ERROR}, round(avg(volatility_30d_pct), 4) AS mean_volatility, round(avg(high_vol_regime), 6) AS high_vol_share FROM errors GROUP BY 1"))
def error_by_commodity(spark, sf):
    extra = {"mean_volatility": _r(F.avg("volatility_30d_pct"), 4), "high_vol_share": F.avg("high_vol_regime")}
    return rounded(A.error_summary(scored(spark, sf), ["commodity"], extra))


@query(on_errors(f"SELECT true_class, {_ERROR} FROM errors GROUP BY 1"))
def error_by_class(spark, sf):
    return rounded(A.error_summary(scored(spark, sf), ["true_class"]))


@query(on_errors(f"SELECT CASE WHEN high_vol_regime = 1 THEN 'High volatility' ELSE 'Normal volatility' END AS regime, {_ERROR} FROM errors GROUP BY 1"))
def error_by_regime(spark, sf):
    return rounded(A.errors_by_regime(scored(spark, sf)))


@query(on_errors(f"SELECT CAST(date_trunc('month', date) AS DATE) AS month, {_ERROR} FROM errors GROUP BY 1 ORDER BY 1 DESC LIMIT 12"))
def monthly_error(spark, sf):
    return rounded(A.monthly_errors(scored(spark, sf)))


@query(on_errors("SELECT commodity, " + ", ".join(f"round(avg(CASE WHEN true_class = '{c}' THEN is_error END), 6) AS {c.lower()}" for c in CLASSES) + " FROM errors GROUP BY 1"))
def commodity_class_matrix(spark, sf):
    return rounded(A.error_matrix(scored(spark, sf)))


@query(on_errors("SELECT date, commodity, true_class, pred_class, confidence, price_idr FROM errors WHERE is_error = 1 ORDER BY confidence DESC, commodity, date LIMIT 15"))
def top_confident_errors(spark, sf):
    return A.top_confident_errors(scored(spark, sf), ["date", "commodity", "true_class", "pred_class", "confidence", "price_idr"])


@query(on_errors("SELECT month, kind, label, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY month, kind), 6) AS share FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, kind, label, count(*) AS n FROM (SELECT date, 'actual' AS kind, true_class AS label FROM errors UNION ALL SELECT date, 'predicted', pred_class FROM errors) GROUP BY 1, 2, 3)"))
def class_share_by_month(spark, sf):
    return rounded(A.class_share_by_month(scored(spark, sf)))


@query(on_errors("SELECT true_class, " + ", ".join(f"count(*) FILTER (WHERE pred_class = '{c}') AS {c.lower()}" for c in CLASSES) + " FROM errors GROUP BY 1"))
def confusion_matrix(spark, sf):
    return A.confusion_matrix(scored(spark, sf))


_REPORT = "k AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}')" for c in CLASSES) + ") v(label)), "
_REPORT += """per AS (SELECT label, count(*) FILTER (WHERE true_class = label AND pred_class = label) AS tp, count(*) FILTER (WHERE pred_class = label) AS pp,
  count(*) FILTER (WHERE true_class = label) AS ap, count(*) AS total FROM k, errors GROUP BY 1),
  m AS (SELECT label, coalesce(CAST(tp AS DOUBLE) / nullif(pp, 0), 0.0) AS p, coalesce(CAST(tp AS DOUBLE) / nullif(ap, 0), 0.0) AS r, coalesce(2.0 * tp / nullif(pp + ap, 0), 0.0) AS f, ap, tp, total FROM per)"""


@query(
    sql(
        """SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, ap AS support FROM m
  UNION ALL SELECT 'accuracy', round(CAST(sum(tp) AS DOUBLE) / max(total), 6), round(CAST(sum(tp) AS DOUBLE) / max(total), 6), round(CAST(sum(tp) AS DOUBLE) / max(total), 6), max(total) FROM m
  UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), max(total) FROM m
  UNION ALL SELECT 'weighted avg', round(sum(p * ap) / max(total), 6), round(sum(r * ap) / max(total), 6), round(sum(f * ap) / max(total), 6), max(total) FROM m""",
        PANEL, WINDOWS, READY, LABELLED, REGIME, ERRORS, _REPORT,
    )
)
def classification_report(spark, sf):
    return rounded(A.classification_report(scored(spark, sf)))


@query(
    on_panel(
        """SELECT bin, round(a + bin * (b - a) / 40, 4) AS low, round(a + (bin + 1) * (b - a) / 40, 4) AS high, n FROM (
  SELECT CAST(least(floor((price_idr - a) / ((b - a) / 40)), 39) AS INTEGER) AS bin, a, b, count(*) AS n
  FROM panel, (SELECT min(price_idr) AS a, max(price_idr) AS b FROM panel) WHERE price_idr IS NOT NULL GROUP BY 1, 2, 3)"""
    )
)
def histogram_bins(spark, sf):
    return rounded(A.histogram(panel(spark, sf), "price_idr"), 4)


@query(on_panel("SELECT commodity, min(price_idr) AS low, round(quantile_cont(price_idr, 0.25), 4) AS q1, round(quantile_cont(price_idr, 0.5), 4) AS median, round(quantile_cont(price_idr, 0.75), 4) AS q3, max(price_idr) AS high FROM panel GROUP BY 1"))
def box_stats(spark, sf):
    return rounded(A.box_stats(panel(spark, sf), "price_idr", "commodity"), 4)


@query("SELECT l_returnflag AS flag, l_linestatus AS status, " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{round(100 * p)}" for p in (0.05, 0.5, 0.9)) + " FROM lineitem GROUP BY 1, 2")
def price_quantiles(spark, sf):
    """Exact quantiles of groups that hold a third of all rows each."""
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), "l_extendedprice")
    return rounded(grouped_quantiles(rows, ["flag", "status"], "l_extendedprice", {"p5": 0.05, "p50": 0.5, "p90": 0.9}), 4)


# --- models ---------------------------------------------------------------------------------

_FOLDS = """placed AS (SELECT date, commodity, row_number() OVER (ORDER BY date, commodity) - 1 AS i, count(*) OVER () AS n FROM panel),
  sized AS (SELECT *, greatest(n // 6, 1) AS size, n - 5 * greatest(n // 6, 1) AS head FROM placed)"""


@query(sql("SELECT date, commodity, CAST(CASE WHEN i < head THEN 0 ELSE (i - head) // size + 1 END AS INTEGER) AS fold FROM sized", PANEL, _FOLDS))
def expanding_folds(spark, sf):
    return M.expanding_folds(panel(spark, sf).select("date", "commodity"), 5)


_IMPUTED = ["price_idr", "price_lag_7d", "rolling_mean_30d", "volatility_30d_pct"]


@query(on_ready("SELECT " + ", ".join(f"round(quantile_cont({c}, 0.5), 4) AS {c}" for c in _IMPUTED) + ", mode(is_month_start) AS is_month_start FROM ready"))
def imputation_values(spark, sf):
    values = M.imputation_values(P.base_features(ready(spark, sf)))
    return rounded(spark.createDataFrame([(*(float(values[c]) for c in _IMPUTED), int(values["is_month_start"]))], ", ".join(f"{c} double" for c in _IMPUTED) + ", is_month_start int"), 4)


@query(
    on_ready(
        "SELECT coalesce(f.commodity, t.commodity) AS commodity, coalesce(f.row_count, t.row_count) AS row_count, f.strict_feature_usable_rows AS strict_feature_usable_rows_x, t.strict_feature_usable_rows AS strict_feature_usable_rows_y, trainable_rows_7d, trainable_rows_30d "
        f"FROM ({_COVERAGE}) f FULL JOIN ({_TARGETS}) t ON f.commodity = t.commodity AND f.row_count = t.row_count"
    )
)
def coverage_outer_join(spark, sf):
    frame = ready(spark, sf)
    both = D.coverage(frame)
    return both.select("commodity", "row_count", "strict_feature_usable_rows_x", "strict_feature_usable_rows_y", "trainable_rows_7d", "trainable_rows_30d")


# --- wide panels for the bench -----------------------------------------------------------

_SUPPLIERS = "panel AS (SELECT CAST(l_suppkey AS VARCHAR) AS commodity, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price_idr FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2)"
_EVENTS = "panel AS (SELECT event_type AS commodity, CAST(ts AS DATE) AS date, max(value) AS price_idr FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)"
_SHORT = f"SELECT date, commodity, {_rounded_list([*LAGS, *TARGET_VALUES.values()])} FROM ready"


def _short(frame):
    return frame.select("date", "commodity", *(F.round(c, 6).alias(c) for c in [*LAGS, *TARGET_VALUES.values()]))


@query(sql(_SHORT, _SUPPLIERS, WINDOWS, READY))
def supplier_training_ready(spark, sf):
    return _short(P.training_ready(panels.lineitem_panel(spark, sf), check=False))


@query(sql(_SHORT, _EVENTS, WINDOWS, READY))
def events_training_ready(spark, sf):
    return _short(P.training_ready(panels.events_panel(spark, sf), check=False))


def _load() -> None:
    """The modules that add their queries here when they are imported."""
    from . import ingest_queries, model_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
