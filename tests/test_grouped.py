import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import analytics as A
from tidepanel.operators import grouped as G

SHARES = {"low": 0.0, "q": 0.25, "mid": 0.5, "most": 0.9, "high": 1.0}


def test_quantiles_of_any_values(spark):
    rng = random.Random(6)
    rows = [("wide", rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300)) for _ in range(700)]
    rows += [("one", 5.0)] * 50 + [("two", 1.0), ("two", 2.0), ("none", None), ("none", float("nan")), ("tiny", 5e-324), ("tiny", 0.0), ("tiny", 1e-323)]
    rows += [("huge", 1.7e308), ("huge", -1.7e308), ("huge", 3.0)] + [(None, float(k % 13)) for k in range(200)] + [("near", 1 + k * 2.0**-52) for k in range(40)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "g string, x double").repartition(6)
    got = {r["g"]: r for r in G.grouped_quantiles(table, ["g"], "x", SHARES).collect()}
    assert set(got) == {g for g, _ in rows} and all(got["none"][n] is None for n in SHARES)
    for g in set(got) - {"none"}:
        values = sorted(x for k, x in rows if k == g)
        for name, p in SHARES.items():
            at = (len(values) - 1) * p
            a, b = values[int(np.floor(at))], values[int(np.ceil(at))]
            want = a if a == b else (1 - (at - np.floor(at))) * a + (at - np.floor(at)) * b
            assert got[g][name] == pytest.approx(want, rel=1e-12, abs=0), (g, name)


def test_one_group_with_very_many_values(spark):
    """The sums of a round stay below a bound; the answer is that of percentile."""
    table = spark.range(0, 300_000, numPartitions=8).select(F.lit("all").alias("g"), F.exp(F.rand(3) * 20).alias("x"))
    table.cache()
    want = table.agg(*(F.percentile("x", F.lit(p)).alias(n) for n, p in SHARES.items())).first()
    got = G.grouped_quantiles(table, ["g"], "x", SHARES).first()
    assert all(got[n] == pytest.approx(want[n], rel=1e-12) for n in SHARES)
    table.unpersist()


def test_infinite_values_and_empty_frames(spark):
    with pytest.raises(Exception, match="infinite"):
        G.grouped_quantiles(spark.createDataFrame([("a", float("inf"))], "g string, x double"), ["g"], "x", SHARES).collect()
    assert G.grouped_quantiles(spark.createDataFrame([], "g string, x double"), ["g"], "x", SHARES).collect() == []


def test_boxes_of_groups(spark):
    rows = [("a", k * k % 101 + 0.5) for k in range(300)] + [("b", 4.0), ("c", None), (None, 1.0), (None, 2.0)]
    table = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: tuple(r)[1:] for r in A.box_stats(table, "x", "g").collect()}
    own = np.array([x for g, x in rows if g == "a"])
    assert got["a"] == pytest.approx(tuple(np.quantile(own, [0, 0.25, 0.5, 0.75, 1])))
    assert got["b"] == (4.0,) * 5 and got["c"] == (None,) * 5 and got[None] == (1.0, 1.25, 1.5, 1.75, 2.0)
    assert A.box_stats(table.limit(0), "x", "g").count() == 0
    by_itself = {r["x"]: r["median"] for r in A.box_stats(table.where("g = 'b'"), "x", "x").collect()}
    assert by_itself == {4.0: 4.0}
