import random

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import checks, importance
from tidepanel.operators import positions as P
from tidepanel.operators.features import attach_targets, base_features
from tidepanel.operators.models import evaluate
from tidepanel.plans.model_queries import fixed_model
from tidepanel.plans.queries import ready

RNG = random.Random(8)


def test_positions_are_dense_and_follow_the_order(spark):
    values = [(RNG.choice([None, 1, 2, 3]), RNG.random()) for _ in range(500)]
    table = spark.createDataFrame(values, "a int, b double").repartition(7)
    rows = P.with_positions(table, "a", "b").collect()
    assert sorted(r["position"] for r in rows) == list(range(500))
    by = [(r["a"], r["b"]) for r in sorted(rows, key=lambda r: r["position"])]
    assert by == sorted(values, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert P.with_positions(table.limit(0), "a").collect() == []
    with pytest.raises(ValueError):
        P.with_positions(table, "a", name="b")


def test_one_key_is_no_one_task(spark):
    """Rows that all tie on the first key still spread by the second, and stay dense."""
    table = spark.range(5000).select(F.lit(1).alias("a"), F.col("id").alias("b"))
    rows = P.with_positions(table.repartition(5), "a", "b").where("position <> b")
    assert rows.count() == 0


def test_rows_of_files(spark, tmp_path):
    spark.range(1000).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t")).select("*", P.file_order()[0].alias("f"), P.file_order()[1].alias("r"))
    assert P.with_positions(table, "f", "r").where("position <> id").count() == 0


def test_join_by_position(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "x int, t string")
    right = spark.createDataFrame([(k,) for k in (30, 10, 20, 40)], "y int")
    got = {r["position"]: (r["t"], r["y"]) for r in P.join_by_position(left, right, ["x"], ["y"]).collect()}
    assert got == {0: ("a", 10), 1: ("b", 20), 2: ("c", 30), 3: (None, 40)}
    assert P.join_by_position(left, right, ["x"], ["y"], "inner").count() == 3
    with pytest.raises(ValueError, match="Both"):
        P.join_by_position(left, left, ["x"], ["x"])


def test_bad_prices_by_their_rows(spark):
    rows = [(f"2024-01-{d:02d}", "a", "x" if d % 2 else str(d)) for d in range(1, 29)]
    table = spark.createDataFrame(rows, "date string, commodity string, price_idr string").repartition(4)
    assert [r["position"] for r in checks.bad_price_rows(table).collect()] == list(range(0, 20, 2))
    with pytest.raises(ValueError, match=r"14 rows, the first at \[0, 2, 4, 6, 8, 10, 12, 14, 16, 18\]"):
        checks.validate_canonical(table, False, ["a"])


def plain_position(x, n, key):
    m = importance.side(n)
    while True:
        a, b = x // m, x % m
        for i in range(1, importance.ROUNDS + 1):
            k = (key * importance.KEY_STEP + i * importance.ROUND_STEP + importance.FIRST) % importance.PRIME
            t = (b * importance.MULTIPLY + k) % importance.PRIME
            a, b = b, (a + (t * t + k) % importance.PRIME % m) % m
        x = a * m + b
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 997])
def test_dealt_positions_are_bijections(spark, n):
    got = spark.range(n).select("id", *(importance.dealt_position(F.col("id"), n, F.lit(k)).alias(f"k{k}") for k in range(3))).collect()
    for k in range(3):
        assert sorted(r[f"k{k}"] for r in got) == list(range(n))
        assert all(r[f"k{k}"] == plain_position(r["id"], n, k) for r in got)
    if n > 100:
        assert len({tuple(r[f"k{k}"] for r in got[:20]) for k in range(3)}) == 3


def test_importance_by_dealing_columns_by_hand(spark):
    frame = attach_targets(base_features(ready(spark, "/root/testdata/sf0.001"))).cache()
    model, target = fixed_model(), "target_7d_class"
    columns = ["price_change_7d_pct", "year"]
    scores = {(r["feature"], r["repeat"]): r["macro_f1"] for r in importance.permutation_scores(model, frame, target, columns, 2).collect()}
    assert set(scores) == {(c, k) for c in [None, *columns] for k in (0, 1)}
    base = evaluate(model, frame, target)["macro_f1"]
    assert scores[None, 0] == scores[None, 1] == scores["year", 0] == pytest.approx(base)
    rows = frame.orderBy("date", "commodity").collect()
    dealt = [r.asDict() | {"price_change_7d_pct": rows[plain_position(i, len(rows), 1)]["price_change_7d_pct"]} for i, r in enumerate(rows)]
    by_hand = evaluate(model, spark.createDataFrame(dealt, frame.schema), target)["macro_f1"]
    assert scores["price_change_7d_pct", 1] == pytest.approx(by_hand) and by_hand != pytest.approx(base)
    found = importance.permutation_importance(model, frame, target, columns, 2)
    assert {r["feature"]: r["importance_mean"] for r in found} == {"year": pytest.approx(0.0), "price_change_7d_pct": pytest.approx(base - (scores["price_change_7d_pct", 0] + by_hand) / 2)}
