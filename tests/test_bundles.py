"""Results are made once, and again only where something they depend on changed."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import features as P
from tidepanel.plans.bundles import analysis_bundles
from tidepanel.sources.panels import with_gaps
from tidepanel.sources.stages import NOTE, Stages, files_key, plan_text


def write(spark, path, n, mode="overwrite"):
    rows = spark.range(n).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 3).cast("int")).alias("date"), F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("commodity"), (100 + 9 * F.sin(F.col("id") / 5) + F.col("id") % 7).alias("price_idr"))
    rows.coalesce(1).write.mode(mode).parquet(path)


def training(panel):
    return P.training_ready(with_gaps(panel), check=False)


def run(spark, root, path, **more):
    stages = Stages(spark, root)
    settings = {"kind": "logistic", "params": {"maxIter": 5}, "repeats": 1} | more
    return analysis_bundles(stages, stages.source(path), training, **settings)


def made(found):
    return {name for name, x in found.items() if not x.reused}


def test_only_what_depends_on_a_change_is_made_anew(spark, tmp_path):
    root, path = "file://" + str(tmp_path / "store"), str(tmp_path / "panel")
    write(spark, path, 600)
    first = run(spark, root, path)
    assert made(first) == {"training", "prepared", "relabeling", "model", "evaluation", "explainability"}
    second = run(spark, root, path)
    assert made(second) == set()
    assert second["evaluation"].value == json.loads(json.dumps(first["evaluation"].value, default=str))
    assert second["prepared"].value.count() == first["prepared"].value.count() == 600
    assert second["model"].value.transform(second["prepared"].value).count() == 600
    # Another model: what comes before it stays.
    assert made(run(spark, root, path, params={"maxIter": 6})) == {"model", "evaluation", "explainability"}
    assert made(run(spark, root, path, repeats=2)) == {"explainability"}
    # Another band changes labels; the training rows stay.
    assert made(run(spark, root, path, band=2.0)) == {"prepared", "relabeling", "model", "evaluation", "explainability"}
    assert made(run(spark, root, path, grid={"C": [0.5]}, draws=1, folds=2)) == {"tuning"}
    write(spark, path, 630, "append")
    assert made(run(spark, root, path)) == made(first)
    stages = Stages(spark, root)
    kept = run(spark, root, path)["evaluation"]
    stages.keep_only("evaluation", kept)
    assert stages.keys("evaluation") == [kept.key]


def test_a_second_run_makes_nothing(spark, tmp_path):
    root, path = str(tmp_path / "store"), str(tmp_path / "panel")
    write(spark, path, 60)
    calls = []

    def summary(frame, shares):
        calls.append(1)
        return [r.asDict() for r in frame.groupBy("commodity").count().orderBy("commodity").collect()]

    def dear(frame):
        return frame.groupBy("commodity").agg(F.sum("price_idr").alias("total"))

    def all_of_it():
        stages = Stages(spark, root)
        source = stages.source(path)
        return stages.table("sums", dear, source), stages.values("counts", summary, source, shares=[1])

    before, after = all_of_it(), all_of_it()
    assert calls == [1] and [x.reused for x in before + after] == [False, False, True, True]
    assert after[1].value == [{"commodity": f"c{k}", "count": 20} for k in range(3)]
    assert after[0].value.count() == 3


def test_what_a_stopped_run_left(spark, tmp_path):
    """A write that fails leaves nothing to be found; a folder without its note is made anew."""
    root, path = str(tmp_path / "store"), str(tmp_path / "panel")
    write(spark, path, 60)
    stages = Stages(spark, root)
    source = stages.source(path)

    def broken(frame):
        return frame.select(F.raise_error(F.lit("stopped")).alias("x"))

    with pytest.raises(Exception, match="stopped"):
        stages.table("broken", broken, source)
    assert stages.keys("broken") == [] and os.listdir(tmp_path / "store" / "broken") == []

    def days(frame):
        return frame.select("date").distinct()

    kept = stages.table("days", days, source)
    os.remove(tmp_path / "store" / "days" / kept.key / NOTE)
    again = stages.table("days", days, source)
    assert not again.reused and again.key == kept.key and again.value.count() == 20
    assert stages.table("days", days, source).reused


def test_plans_and_files_tell_what_changed(spark, tmp_path):
    path = str(tmp_path / "panel")
    write(spark, path, 60)
    read = lambda: spark.read.parquet(path)
    one = lambda k: read().withColumn("x", F.transform(F.array("price_idr"), lambda v: v + k)).groupBy("commodity").agg(F.max("x").alias("m"))
    assert plan_text(one(1)) == plan_text(one(1)) != plan_text(one(2))
    key = files_key(spark, path)
    assert key == files_key(spark, path)
    write(spark, path, 3, "append")
    assert key != files_key(spark, path)
    stages = Stages(spark, str(tmp_path / "store"))
    for make in (lambda f: spark.createDataFrame([(1,)], "a int"), lambda f: f.withColumn("r", F.rand())):
        with pytest.raises(ValueError, match="does not say what it holds"):
            stages.table("odd", make, stages.source(path))
