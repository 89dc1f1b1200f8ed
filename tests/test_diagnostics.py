import json
import random
import statistics
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.config import PRICE_FEATURES, TIERS, Bound, DiagnosticsConfig
from tidepanel.operators import analytics as A
from tidepanel.operators import diagnostics as D
from tidepanel.operators import gate
from tidepanel.operators.checks import duplicate_pairs
from tidepanel.sources.artifacts import Files
from tidepanel.sources.sinks import write_diagnostics

SCHEMA = "date date, commodity string, price_idr double"


FIRST = date(2031, 5, 2)
DAYS = 110


def canonical_rows():
    """Two names with a price on every day, of a sawtooth and of squares."""
    return [(FIRST + timedelta(i), c, float(p)) for i in range(DAYS) for c, p in (("beras", 40 + 3 * (i % 9)), ("gula", 900 + i * i % 37))]


#: From which day on each of some features is there.
SINCE = {"price_lag_7d": 7, "price_lag_30d": 31, "rolling_std_30d": 3, "price_change_1d_pct": 36}


def training(spark, constant=None):
    rows = []
    for d, c, p in canonical_rows():
        n = (d - FIRST).days
        features = [2.5 if n >= SINCE.get(f, 0) else None for f in PRICE_FEATURES]
        t = 9.0 if constant == c else (-7.5, 6.0, 0.5, 0.25)[n % 4]
        rows.append((d, c, p, *features, t, t if n >= 25 else None))
    return spark.createDataFrame(rows, SCHEMA + "".join(f", {c} double" for c in PRICE_FEATURES) + ", target_7d_inflation_pct double, target_30d_inflation_pct double")


def usable(columns):
    """Rows of a name with all of these features."""
    return DAYS - max(SINCE.get(c, 0) for c in columns)


def test_gap_metrics(spark):
    """Random days of three names, by plain Python."""
    rng = random.Random(5)
    days = {c: sorted(rng.sample(range(500), n)) for c, n in (("a", 2), ("b", 40), ("c", 200))}
    rows = [(FIRST + timedelta(d), c, 1.0) for c, own in days.items() for d in own]
    got = {r["commodity"]: r for r in D.gap_metrics(spark.createDataFrame(rows + rows[:3], SCHEMA)).collect()}
    for c, own in days.items():
        gaps = [b - a for a, b in zip(own, own[1:], strict=False)]
        r = got[c]
        assert (r["observation_count"], r["span_days"], r["gap_max"]) == (len(own), own[-1] - own[0] + 1, max(gaps))
        assert r["gap_median"] == pytest.approx(statistics.median(gaps)) and r["gap_p90"] == pytest.approx(float(np.quantile(gaps, 0.9)))
        assert [r[f"gap_gt_{n}_count"] for n in (1, 3, 7, 30)] == [sum(g > n for g in gaps) for n in (1, 3, 7, 30)]


def test_single_date_and_empty(spark):
    row = D.gap_metrics(spark.createDataFrame([(date(2026, 1, 1), "beras", 1.0)], SCHEMA)).collect()[0]
    assert (row["span_days"], row["gap_max"], row["missing_day_ratio"]) == (1, 0.0, 0.0)
    empty = spark.createDataFrame([], SCHEMA)
    for f in (D.gap_metrics, D.feature_coverage, D.target_coverage, D.training_windows, D.class_balance, D.match_quality, D.distribution_summary, D.flat_runs):
        assert f(empty).count() == 0


def test_duplicates(spark):
    rows = canonical_rows()
    assert duplicate_pairs(spark.createDataFrame([*rows, rows[0]], SCHEMA)).count() == 1


def test_missing_columns_rate_zero(spark):
    row = D.feature_coverage(spark.createDataFrame(canonical_rows(), SCHEMA)).collect()[0]
    assert row["price_lag_7d_non_null_rate"] == 0.0


def test_coverage_tiers_and_windows(spark):
    frame = training(spark)
    for r in D.feature_coverage(frame).collect():
        assert r["strict_feature_usable_rows"] == usable(PRICE_FEATURES) < r["model_feature_usable_rows"] == usable(TIERS["critical"])
    assert {r["span_days"] for r in D.training_windows(frame).where("horizon = '30d'").collect()} == {DAYS - max(25, DAYS - usable(TIERS["critical"]))}
    assert {r["classes_present"] for r in D.class_balance(frame).collect()} == {3}


def test_match_ratios_sum_to_one(spark):
    for r in D.match_quality(spark.createDataFrame(canonical_rows(), SCHEMA)).collect():
        assert r["exact_ratio"] + r["tolerance_ratio"] + r["no_match_ratio"] == pytest.approx(1.0)


@pytest.mark.parametrize(("prices", "want"), [([1, 2, 3], 1), ([5, 5, 5, 4], 3), ([None, None], 0), ([5, None, 5], 1), ([1, 2, 2, None, 2, 2, 2], 3)])
def test_flat_runs(spark, prices, want):
    rows = [(date(2026, 1, 1) + timedelta(i), "beras", None if p is None else float(p)) for i, p in enumerate(prices)]
    assert D.flat_runs(spark.createDataFrame(rows, SCHEMA)).collect()[0]["max_flatline_segment_days"] == want


def test_gate_fails_on_one_class(spark):
    config = DiagnosticsConfig({"class_ratio": Bound(0.05, 0.05, above=False)})
    found = gate.diagnose(spark.createDataFrame(canonical_rows(), SCHEMA), training(spark, "beras"), config)
    assert found.status is gate.Readiness.FAIL
    assert any("class support too narrow" in x for x in found.failures)


def test_low_target_rate_warns_and_fails(spark):
    """A rate below both bounds is a warning and a failure; one between them only a warning."""
    ready = training(spark).withColumn("target_30d_inflation_pct", F.when(F.datediff("date", F.lit(FIRST)) < 18, F.lit(1.0))).withColumn("target_7d_inflation_pct", F.when(F.datediff("date", F.lit(FIRST)) < 25, F.lit(1.0)))
    found = gate.diagnose(spark.createDataFrame(canonical_rows(), SCHEMA), ready)
    low = lambda lines, h: [x for x in lines if "rate of the target" in x and h in x]
    assert len(low(found.warnings, "30d")) == len(low(found.failures, "30d")) == 2
    assert len(low(found.warnings, "7d")) == 2 and not low(found.failures, "7d")
    totals = found.sections["target_totals"][0]
    assert totals["strict_feature_usable_rows_total"] == 2 * usable(PRICE_FEATURES) and totals["model_feature_usable_rows_total"] == 2 * usable(TIERS["critical"])
    assert found.failures == sorted(set(found.failures)) and found.warnings == sorted(set(found.warnings))


def test_report_files(spark, tmp_path):
    config = DiagnosticsConfig(allowed_commodities=("beras",))
    found = gate.diagnose(spark.createDataFrame(canonical_rows(), SCHEMA), training(spark), config)
    assert any("Unexpected commodities" in x for x in found.failures)
    paths = write_diagnostics(spark, found, f"file://{tmp_path}/reports")
    read = Files(spark).read_text
    assert len(paths) == 7 and all((tmp_path / "reports" / p.rsplit("/", 1)[-1]).exists() for p in paths.values())
    summary = json.loads(read(paths["json"]))
    assert summary["readiness_status"] == "FAIL" and summary["overall"][0]["row_count"] == 2 * DAYS
    assert "## Match quality" in read(paths["markdown"])
    assert "strict_feature_usable_rows_x" in read(paths["coverage_csv"])


@pytest.mark.parametrize("width", [2, 3, 4, 7])
def test_every_pair_is_correlated_once(spark, width):
    rows = [tuple(None if (k * 7 + i * 3) % 11 == 0 else float((k * k * (i + 2)) % 17 + i * k) for i in range(width)) for k in range(60)]
    names = [f"x{i}" for i in range(width)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in A.correlation_matrix(frame, names).collect()}
    expected = frame.toPandas().corr()
    assert sorted(got) == [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    assert all(value == pytest.approx(expected.loc[pair], abs=1e-9) for pair, value in got.items())
    assert not A.correlation_matrix(frame.limit(0), names).collect()
