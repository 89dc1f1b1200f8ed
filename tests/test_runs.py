"""Runs and gaps of long histories, chunk by chunk, against plain Python."""

import random
import statistics
from datetime import date, timedelta
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import diagnostics as D
from tidepanel.operators import runs as R

SCHEMA = "date date, commodity string, price_idr double"
BEGIN = date(1960, 3, 1)


def longest(prices):
    """Missing prices are no run of several rows."""
    lengths = [1 if p is None else len(list(same)) for p, same in groupby(prices)]
    return 0 if all(p is None for p in prices) else max(lengths)


def history(rng, n, stay):
    """Days with gaps; a price stays with the given chance, so runs cross many chunks."""
    day, price, out = rng.randrange(9000), 1.0, []
    for _ in range(n):
        day += rng.choice([1, 1, 1, 1, 2, 5, 40])
        price = price if rng.random() < stay else rng.choice([None, 1.0, 2.0, 3.0])
        out.append((BEGIN + timedelta(day), price))
    return out


@pytest.mark.parametrize("chunk_days", [1, 7, 64, 1024, 10**6])
def test_chunks_change_nothing(spark, chunk_days):
    rng = random.Random(chunk_days)
    names = {"a": history(rng, 900, 0.97), "b": history(rng, 700, 0.5), "c": history(rng, 1, 0.5), "d": [(BEGIN + timedelta(i), None) for i in range(50)], "e": [(BEGIN + timedelta(i), 4.0) for i in range(300)]}
    rows = [(d, c, p) for c, own in names.items() for d, p in own]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r[0]: r[1] for r in D.flat_runs(frame, chunk_days).collect()}
    assert got == {c: longest([p for _, p in own]) for c, own in names.items()}
    gaps = {r["commodity"]: r for r in D.gap_metrics(frame.union(frame), chunk_days).collect()}
    for c, own in names.items():
        between = [(b[0] - a[0]).days for a, b in zip(own, own[1:], strict=False)]
        r = gaps[c]
        assert (r["observation_count"], r["span_days"]) == (len(own), (own[-1][0] - own[0][0]).days + 1)
        assert (r["gap_max"], r["gap_median"]) == (max(between, default=0), statistics.median(between or [0]))
        assert r["gap_p90"] == pytest.approx(float(np.quantile(between or [0], 0.9)))
        assert [r[f"gap_gt_{n}_count"] for n in (1, 3, 7, 30)] == [sum(g > n for g in between) for n in (1, 3, 7, 30)]


def test_one_key_is_many_tasks(spark):
    """One price over 40,000 days is one run, and no task has more than a chunk of it."""
    rows = spark.range(40_000).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit("a").alias("commodity"), F.lit(5.0).alias("price_idr"))
    assert D.flat_runs(rows, 100).first()["max_flatline_segment_days"] == 40_000
    assert D.gap_metrics(rows, 100).first()["observation_count"] == 40_000
    broken = rows.withColumn("price_idr", F.when(F.year("date") != 1950, F.col("price_idr")))
    per_chunk = rows.groupBy(R._chunk(F.unix_date("date"), 100)).count()
    assert per_chunk.agg(F.max("count")).first()[0] == 100
    first = (date(1950, 1, 1) - date(1900, 1, 1)).days
    assert D.flat_runs(broken, 100).first()["max_flatline_segment_days"] == max(first, 40_000 - first - 365)


def test_missing_dates_and_keys(spark):
    rows = [(None, "a", 1.0), (None, "a", 1.0), (BEGIN, "a", 1.0), (None, None, 1.0), (None, "b", None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("_key", F.lit("mine")).withColumn("n", F.lit(1))
    # Rows without a date come after the dated ones, next to which their run may go on.
    assert {r[0]: r[1] for r in D.flat_runs(frame).collect()} == {"a": 3, "b": 0}
    assert [r["observation_count"] for r in D.gap_metrics(frame).collect()] == [1]
    with pytest.raises(ValueError):
        R.day_gaps(frame, "commodity", 0)
