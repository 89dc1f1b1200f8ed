"""The distributed grower against one of plain loops over rows."""

import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidepanel.operators import boosting as B

RNG = random.Random(70)


def samples(n=240, classes=3):
    rows = []
    for _ in range(n):
        x = [RNG.choice([-1.0, 0.0, 2.5]), round(RNG.uniform(-4, 4), 1), float(RNG.randint(0, 9)), 7.0]
        score = [x[0] + 0.3 * x[2], x[1], 2.0 - abs(x[1])]
        rows.append((x, max(range(classes), key=lambda k: score[k] + RNG.gauss(0, 0.5))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(x, float(y)) for x, y in rows], "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").repartition(3)


def softmax(s):
    top = max(s)
    e = [math.exp(v - top) for v in s]
    return [v / sum(e) for v in e]


def plain(rows, edges, classes, rounds, rate, depth, least):
    """Scores after boosting: every split of every node is tried over its rows."""
    counts = [sum(y == k for _, y in rows) for k in range(classes)]
    scores = [[math.log(min(1 - B.LEAST_PRIOR, max(B.LEAST_PRIOR, c / len(rows)))) for c in counts] for _ in rows]

    def grow(members, residual, left):
        def error(part):
            mean = sum(residual[i] for i in part) / len(part)
            return sum((residual[i] - mean) ** 2 for i in part)

        best = None
        if left:
            whole = error(members)
            for f, cuts in enumerate(edges):
                for e in cuts:
                    low = [i for i in members if rows[i][0][f] <= e]
                    high = [i for i in members if rows[i][0][f] > e]
                    if len(low) >= least and len(high) >= least:
                        gain = whole - error(low) - error(high)
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, low, high)
        if best is None or best[0] <= 1e-9:
            h = sum(abs(residual[i]) * (1 - abs(residual[i])) for i in members)
            value = (classes - 1) / classes * sum(residual[i] for i in members) / h if h > B.TINY else 0.0
            return dict.fromkeys(members, value)
        return grow(best[1], residual, left - 1) | grow(best[2], residual, left - 1)

    for _ in range(rounds):
        p = [softmax(s) for s in scores]
        steps = [grow(list(range(len(rows))), [(y == k) - p[i][k] for i, (_, y) in enumerate(rows)], depth) for k in range(classes)]
        for i, s in enumerate(scores):
            for k in range(classes):
                s[k] += rate * steps[k][i]
    return [softmax(s) for s in scores]


@pytest.mark.parametrize(("rounds", "depth", "least"), [(7, 2, 1), (2, 3, 12)])
def test_scores_of_a_plain_grower(spark, rounds, depth, least, tmp_path):
    rows = samples(120)
    model = B.fit_boosting(frame(spark, rows), 3, B.Options(rounds=rounds, learning_rate=0.3, max_depth=depth, min_samples_leaf=least))
    want = plain(rows, model.edges, 3, rounds, 0.3, depth, least)
    pipeline = PipelineModel(stages=model.stages(spark))
    pipeline.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    table = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "i int, x array<double>").select("i", array_to_vector("x").alias("features"))
    for m in (pipeline, again):
        got = {r["i"]: r for r in m.transform(table).collect()}
        for i, p in enumerate(want):
            assert got[i]["probability"] == pytest.approx(p, abs=1e-9)
            assert got[i]["prediction"] == max(range(3), key=lambda k: got[i]["probability"][k])


def test_it_learns_and_thresholds_are_few(spark):
    rows = samples(600)
    table = frame(spark, rows)
    model = B.fit_boosting(table, 3, B.Options(rounds=15, learning_rate=0.3, subsample=0.7, max_features="sqrt", max_bins=16))
    assert all(len(e) < 16 and e == sorted(set(e)) for e in model.edges) and model.edges[3] == []
    out = PipelineModel(stages=model.stages(spark)).transform(table)
    assert out.where("prediction = label").count() / len(rows) > 0.75
    assert all(f < 3 for r in model.rounds for t in r for f, _ in t.splits.values())


def test_leaves_hold_enough_rows_and_options_are_checked(spark):
    model = B.fit_boosting(frame(spark, samples(150)), 3, B.Options(rounds=2, min_samples_leaf=30, max_depth=4))
    assert all(t.sums[n][0] >= 30 for r in model.rounds for t in r for n in t.leaves())
    for wrong in ({"subsample": 0.0}, {"max_depth": 0}, {"min_samples_leaf": 0}):
        with pytest.raises(ValueError):
            B.Options(**wrong)
    with pytest.raises(ValueError):
        B.fit_boosting(frame(spark, []), 3)


def test_missing_class_and_no_rounds(spark):
    rows = [(x, y % 2) for x, y in samples(80)]
    model = B.fit_boosting(frame(spark, rows), 3, B.Options(rounds=3))
    out = PipelineModel(stages=model.stages(spark)).transform(frame(spark, rows))
    assert out.agg(F.max(F.col("probability")[2])).first()[0] < 0.01
    prior = B.fit_boosting(frame(spark, rows), 2, B.Options(rounds=0))
    share = sum(y for _, y in rows) / len(rows)
    got = PipelineModel(stages=prior.stages(spark)).transform(frame(spark, rows)).select(F.col("probability")[1]).distinct().collect()
    assert [r[0] for r in got] == [pytest.approx(share)]


def test_a_level_is_one_aggregate_of_bounded_sums(spark):
    """One exchange; as many rows as classes x nodes x features x bins at most."""
    table = frame(spark, samples(300))
    edges = B.bin_edges(table.select(vector_to_array("features").alias("x")), F.col("x"), 4, 8)
    state = table.select(B.binned(vector_to_array("features"), edges).alias("bins"), F.col("label").cast("int").alias("label"), F.array(*[F.lit(0.0)] * 3).alias("scores"))
    sums = B.histogram(state, [B.Tree() for _ in range(3)], [{1}, {1}, {1}])
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and sums.count() <= 3 * 4 * 8
    assert sums.where("feature = 0").agg(F.sum("n")).first()[0] == 900
