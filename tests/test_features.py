import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from tidepanel.config import ENGINEERED, MODEL_FEATURES, REQUIRED_COLUMNS, Lead
from tidepanel.functions import exprs as E
from tidepanel.operators import checks
from tidepanel.operators import features as P
from tidepanel.operators import quantiles
from tidepanel.plans.queries import panel as orders

SMALL = "/root/testdata/sf0.001"


def panel(spark, days, prices=None, commodity="beras"):
    rows = [(date.fromisoformat(d), commodity, float(p) if p is not None else None) for d, p in zip(days, prices, strict=True)]
    return spark.createDataFrame(rows, "date date, commodity string, price_idr double")


def by_day(frame):
    return {str(r["date"]): r for r in frame.collect()}


def plain_frames(rows):
    """Lags, targets and trailing statistics of one history by looking at every pair of days."""
    out = {}
    for d, p in rows:
        away = sorted(((e - d).days, q) for e, q in rows)
        within = lambda a, b: [q for n, q in away if a <= n <= b]  # noqa: B023, E731
        week, month = ([q for q in within(-n, 0) if q is not None] for n in (7, 30))
        ahead = within(30, 37)
        out[str(d)] = {
            "price_lag_1d": (within(-1, -1) or [None])[-1],
            "price_lag_7d": (within(-8, -7) or [None])[-1],
            "price_lag_30d": (within(-32, -30) or [None])[-1],
            "rolling_mean_7d": sum(week) / len(week) if week else None,
            "rolling_std_30d": float(np.std(month, ddof=1)) if len(month) > 1 else None,
            "target_30d_inflation_pct": (ahead[0] / p - 1) * 100 if ahead and None not in (ahead[0], p) and p else None,
        }
    return out


def test_frames_against_all_pairs_of_days(spark):
    """Histories with holes of every size around the frames' ends, missing and zero prices."""
    rng = random.Random(12)
    for keep in (0.35, 0.8):
        start = date(2023, 11, 20)
        rows = [(start + timedelta(k), rng.choice([None, 0.0, *range(40, 60)])) for k in range(110) if rng.random() < keep]
        rows = [(d, None if p is None else float(p)) for d, p in rows]
        got = by_day(P.training_ready(panel(spark, [str(d) for d, _ in rows], [p for _, p in rows], "gula_pasir")))
        want = plain_frames(rows)
        assert got.keys() == want.keys()
        for d, columns in want.items():
            for c, v in columns.items():
                assert got[d][c] == (None if v is None else pytest.approx(v, abs=1e-6)), (d, c)


def test_own_horizons(spark):
    frame = panel(spark, ["2025-06-01", "2025-06-04", "2025-06-05", "2025-06-20"], [50, 60, 80, 20])
    got = by_day(P.training_targets(frame, {"7d": Lead(3, 0), "30d": Lead(2, 2)}))
    assert got["2025-06-01"]["target_7d_inflation_pct"] == pytest.approx(20.0)
    assert got["2025-06-01"]["target_30d_inflation_pct"] == pytest.approx(20.0)
    assert got["2025-06-04"]["target_7d_inflation_pct"] is None and got["2025-06-05"]["target_30d_inflation_pct"] is None


def test_matched_row_without_price_is_missing(spark):
    got = by_day(P.feature_ready(panel(spark, ["2025-03-01", "2025-03-02", "2025-03-09"], [7, None, 9])))
    assert got["2025-03-09"]["price_lag_7d"] is None


def test_contract_columns_and_zero_price(spark):
    out = P.training_ready(panel(spark, ["2027-11-08", "2027-11-09", "2027-11-10"], [0, 4, 5]))
    assert set(REQUIRED_COLUMNS) <= set(out.columns)
    got = by_day(out)
    assert got["2027-11-09"]["price_change_1d_pct"] is None and got["2027-11-10"]["price_change_1d_pct"] == pytest.approx(25.0)


def test_duplicates_and_wrong_keys_fail(spark):
    frame = panel(spark, ["2026-01-01", "2026-01-01"], [1, 2])
    for chunk_days in (None, 50):
        with pytest.raises(Exception, match="Duplicate .*2026-01-01, beras"):
            P.feature_ready(frame, chunk_days=chunk_days).select("commodity").collect()
    with pytest.raises(ValueError, match="Duplicate"):
        checks.require_unique_keys(frame)
    with pytest.raises(ValueError, match="needs the keys"):
        P.feature_ready(frame, lags={"2d": None})


def gappy(seed=3, n=200):
    rng = np.random.default_rng(seed)
    rows = []
    for c in ("a", "b", "c"):
        for d in sorted(rng.choice(400, n, replace=False)):
            rows.append((date(2024, 1, 1) + timedelta(int(d)), c, None if rng.random() < 0.05 else float(rng.integers(1, 500))))
    return rows


def test_against_pandas(spark):
    rows = gappy()
    frame = spark.createDataFrame(rows, "date date, commodity string, price_idr double")
    got = P.training_ready(frame).toPandas().sort_values(["commodity", "date"]).reset_index(drop=True)
    pdf = pd.DataFrame(rows, columns=["date", "commodity", "price_idr"])
    pdf["date"] = pd.to_datetime(pdf["date"])
    for c, part in pdf.groupby("commodity"):
        part = part.sort_values("date").reset_index(drop=True)
        own = got[got.commodity == c].reset_index(drop=True)
        price = part.set_index("date")["price_idr"]
        for n, f, m in (("rolling_mean_7d", 7, "mean"), ("rolling_mean_30d", 30, "mean"), ("rolling_std_30d", 30, "std")):
            want = getattr(price.rolling(f"{f}D", closed="both", min_periods=2 if m == "std" else 1), m)()
            np.testing.assert_allclose(own[n].to_numpy(float), want.to_numpy(float), rtol=1e-7, atol=1e-6)
        for h, slack, col in ((1, 0, "price_lag_1d"), (7, 1, "price_lag_7d"), (30, 2, "price_lag_30d")):
            left = part.assign(key=part["date"] - pd.Timedelta(days=h))[["key"]]
            want = pd.merge_asof(left, part.rename(columns={"date": "key"}), on="key", tolerance=pd.Timedelta(days=slack))["price_idr"]
            np.testing.assert_allclose(own[col].to_numpy(float), want.to_numpy(float))


def test_chunks_change_nothing(spark):
    frame = spark.createDataFrame(gappy(), "date date, commodity string, price_idr double")
    whole, cut = (P.training_ready(frame, chunk_days=c).select("date", "commodity", "price_lag_30d", "target_30d_inflation_pct", "rolling_mean_7d").toPandas().sort_values(["commodity", "date"]).reset_index(drop=True) for c in (None, 50))
    pd.testing.assert_frame_equal(whole, cut)


def test_one_exchange_one_window(spark):
    frame = spark.createDataFrame(gappy(), "date date, commodity string, price_idr double")
    for check in (False, True):
        plan = P.training_ready(frame, check=check)._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("Window ") == 1
        executed = P.training_ready(frame, check=check)._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning") == 1


def test_row_local_features(spark):
    ready = P.feature_ready(orders(spark, SMALL), check=False)
    out = P.model_columns(P.base_features(ready))
    assert out.columns == MODEL_FEATURES and "high_vol_regime" not in out.columns
    assert not [c for c in out.columns if c.startswith("target_")]
    one = ready.where("price_lag_30d is not null").orderBy("commodity", "date").limit(1)
    row = one.collect()[0]
    single = P.base_features(one).select(*ENGINEERED).collect()[0]
    batch = P.base_features(ready).where((E.col("date") == row["date"]) & (E.col("commodity") == row["commodity"])).select(*ENGINEERED).collect()[0]
    assert single == batch


def test_contract_errors(spark):
    with pytest.raises(ValueError, match="Missing feature-ready"):
        P.base_features(orders(spark, SMALL))
    with pytest.raises(ValueError, match="Target leakage detected"):
        checks.require_no_leakage(["commodity", "target_7d_class"])
    with pytest.raises(ValueError, match="order"):
        checks.require_column_order(MODEL_FEATURES[::-1])
    with pytest.raises(ValueError, match="Unsupported horizon"):
        checks.require_horizon(14)


def test_labels_and_missing(spark):
    frame = spark.createDataFrame([(1.5,), (-1.5,), (1.0,), (None,), (float("nan"),)], "x double").withColumn("x", E.missing_as_null("x"))
    rows = frame.select(E.label_training("x"), E.label_diagnostics("x"), E.label_v2("x")).collect()
    assert [r[0] for r in rows] == ["Inflation", "Deflation", "Stable", "Stable", "Stable"]
    assert [r[1] for r in rows] == ["Inflation", "Deflation", "Stable", None, None]
    assert [r[2] for r in rows] == ["Stable", "Deflation", "Stable", "Stable", "Stable"]


def test_split_uses_double_positions(spark):
    days = [str(date(2026, 1, 1) + timedelta(i)) for i in range(90)]
    frame = panel(spark, days, range(1, 91)).withColumn("target_7d_class", E.label_training("price_idr"))
    counts = {r["split"]: r["count"] for r in P.time_split(frame).groupBy("split").count().collect()}
    assert counts["train"] == int(90 * 0.70) + 1 == 63


def test_ties_go_by_class_order(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.1, 0.2, 0.7)], "d double, s double, i double")
    got = frame.select(E.best_class({"Deflation": F.col("d"), "Stable": F.col("s"), "Inflation": F.col("i")})).collect()
    assert [r[0] for r in got] == ["Deflation", "Stable", "Inflation"]


def test_empty_panel(spark):
    empty = spark.createDataFrame([], "date date, commodity string, price_idr double")
    assert P.training_ready(empty).count() == 0


def test_exact_quantiles(spark, monkeypatch):
    """Ties, missing values, an empty column, and rounds that narrow the search, against numpy."""
    rng = np.random.default_rng(5)
    columns = {"a": rng.normal(size=3000), "b": rng.integers(0, 4, 3000).astype(float), "c": np.where(rng.random(3000) < 0.6, 7.0, rng.exponential(size=3000)), "d": np.full(3000, np.nan)}
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in zip(*columns.values(), strict=True)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for limit, accuracy in ((100_000, 10_000), (3, 10_000), (40, 20)):
        monkeypatch.setattr(quantiles, "LIMIT", limit)
        monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
        got = quantiles.exact_quantiles(frame, dict.fromkeys(columns, shares))
        for c in "abc":
            np.testing.assert_allclose(got[c], np.quantile(columns[c], shares), rtol=1e-12)
        assert got["d"] == [None] * len(shares)


def test_quantile_labels_without_train_rows(spark):
    frame = spark.createDataFrame([("test", 1.0), ("test", None)], "split string, x double")
    assert [r["y"] for r in P.label_by_quantiles(frame, "x", 0.4, "y").collect()] == ["Stable", "Stable"]


def test_chunks_keep_rows_without_a_date(spark):
    rows = [(date(2027, 3, 1) + timedelta(k), "a", float(k)) for k in range(10)] + [(None, "a", 3.0)]
    frame = spark.createDataFrame(rows, "date date, commodity string, price_idr double")
    whole, chunked = (sorted(map(str, P.feature_ready(frame, chunk_days=n).collect())) for n in (None, 5))
    assert len(chunked) == 11 and chunked == whole
