import json

import pytest
from pyspark.sql import functions as F

from tidepanel.config import CLASSES, MODEL_FEATURES
from tidepanel.operators import features as P
from tidepanel.operators import models as M
from tidepanel.operators import service as S
from tidepanel.plans.queries import ready
from tidepanel.sources.artifacts import Files, current
from tidepanel.streaming.scoring import feature_stream, score_stream

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frame(spark):
    return ready(spark, SMALL).cache()


def metadata_of(spark, root):
    return json.loads(Files(spark).read_text(S.metadata_path(current(spark, S.artifact_root(root, 7)))))


@pytest.fixture(scope="module")
def artifacts(frame, tmp_path_factory):
    root = "file://" + str(tmp_path_factory.mktemp("artifacts"))
    S.train_and_save(frame, root, kind="logistic", maxIter=10)
    return root


def test_prediction_records(spark, frame, artifacts):
    service = S.InferenceService(spark, artifacts, 7)
    rows = service.predict(frame.limit(2))
    assert len(rows) == 2
    for r in rows:
        assert set(r) == {"prediction", "probabilities", "horizon", "model_version", "generated_at_utc"}
        assert r["prediction"] in CLASSES and sum(r["probabilities"].values()) == pytest.approx(1.0)


def test_payload_and_unknown_commodity(spark, frame, artifacts):
    row = json.loads(frame.where("price_lag_30d is not null").limit(1).toJSON().collect()[0])
    full = dict.fromkeys(S.REQUIRED_COLUMNS) | row | {"commodity": "never seen", "extra": 1}
    assert len(S.InferenceService(spark, artifacts, 30).predict(json.dumps(full))) == 1
    with pytest.raises(ValueError, match="Missing feature-ready"):
        S.InferenceService(spark, artifacts, 7).predict({"date": "2026-01-01"})


def test_empty_and_missing_input(spark, frame, artifacts):
    service = S.InferenceService(spark, artifacts, 7)
    with pytest.raises(ValueError, match="empty"):
        service.predict(frame.limit(0))
    with pytest.raises(ValueError, match="Missing"):
        service.predict(frame.drop("price_lag_7d"))


def test_classes_come_from_the_model(spark, artifacts):
    """A model with other classes, or with theirs in another order, is refused whatever its metadata says."""
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(S.model_path(current(spark, S.artifact_root(artifacts, 7))))
    metadata = metadata_of(spark, artifacts)
    assert M.model_labels(model) == sorted(CLASSES)
    turned = PipelineModel(stages=[*model.stages[:-1], M.label_stage(CLASSES)])
    with pytest.raises(ValueError, match="classes"):
        S.InferenceService(spark, artifacts, 7, model=turned, metadata=metadata)
    with pytest.raises(ValueError, match="does not say"):
        S.InferenceService(spark, artifacts, 7, model=PipelineModel(stages=model.stages[:-1]), metadata=metadata)


def test_metadata_contract(spark, artifacts):
    metadata = metadata_of(spark, artifacts)
    assert metadata["engineered_feature_columns"] == MODEL_FEATURES and metadata["class_names"] == sorted(CLASSES)
    for change, message in (({"horizon": 30}, "horizon"), ({"input_contract": "x"}, "contract"), ({"class_names": CLASSES}, "classes")):
        with pytest.raises(ValueError, match=message):
            S.InferenceService(spark, artifacts, 7, metadata=metadata | change)
    with pytest.raises(ValueError, match="order"):
        S.InferenceService(spark, artifacts, 7, metadata=metadata | {"engineered_feature_columns": MODEL_FEATURES[::-1]}).predict(ready(spark, SMALL).limit(1))


def test_exact_median_and_mode(spark, frame):
    base = P.base_features(frame)
    values = M.imputation_values(base)
    prices = sorted(r[0] for r in base.where("price_idr is not null").select("price_idr").collect())
    n = len(prices)
    assert values["price_idr"] == pytest.approx((prices[(n - 1) // 2] + prices[n // 2]) / 2)


def test_expanding_folds(spark, frame):
    rows = M.expanding_folds(frame.select("date", "commodity"), 4).orderBy("date", "commodity").collect()
    folds = [r["fold"] for r in rows]
    assert folds == sorted(folds) and max(folds) == 4
    assert {folds.count(k) for k in range(1, 5)} == {len(rows) // 5}


def test_forest_importances_and_cv(spark, frame):
    labelled = P.attach_targets(P.base_features(frame))
    model = M.fit(labelled, "target_7d_class", "forest", numTrees=3, maxDepth=3)
    assert sum(r["importance"] for r in M.tree_importances(model)) == pytest.approx(1.0)
    rows = M.cross_validate(labelled, "target_7d_class", "forest", 2, numTrees=2, maxDepth=2)
    assert set(M.cv_summary(rows)) >= {"macro_f1_mean", "macro_f1_std"}


@pytest.fixture(scope="module")
def parts(frame):
    split = P.time_split(P.attach_targets(P.base_features(frame))).cache()
    return split.where("split = 'train'"), split.where("split = 'valid'")


def test_comparison_coefficients_and_bundle(spark, parts):
    train, valid = parts
    rows = M.compare(train, valid, "target_7d_class", ("logistic", "forest"), logistic={"maxIter": 5}, forest={"numTrees": 2, "maxDepth": 2})
    assert {r["model"] for r in rows} == {"logistic", "forest"} and rows[0]["macro_f1"] >= rows[1]["macro_f1"]
    model = M.fit(train, "target_7d_class", "logistic", maxIter=5)
    found = M.coefficients(model)
    assert [r["feature"] for r in found if r["feature"].startswith("commodity=")] and [r["max_abs"] for r in found] == sorted((r["max_abs"] for r in found), reverse=True)
    assert all(r["max_abs"] == max(abs(r[c]) for c in CLASSES) for r in found)
    bundle = M.evaluation_bundle(model, valid, "target_7d_class")
    assert bundle.metrics["accuracy"] == pytest.approx(bundle.errors.where("is_correct = 1").count() / bundle.errors.count())
    assert sum(r[c.lower()] for r in bundle.confusion for c in CLASSES) == bundle.errors.count()


def test_search_over_forests(spark, parts):
    train, _ = parts
    rows = M.random_search(train, "target_7d_class", "forest", {"n_estimators": [2], "max_depth": [1, 3], "min_samples_leaf": [1], "class_weight": ["balanced"]}, draws=5, folds=2)
    assert len(rows) == 2 and rows[0]["macro_f1_mean"] >= rows[1]["macro_f1_mean"]


def test_unknown_parameters_are_errors(spark, parts):
    train, _ = parts
    for kind, wrong in (("logistic", {"subsample": 0.5}), ("forest", {"C": 1.0}), ("boosting", {"class_weight": "balanced"}), ("logistic", {"solver": "magic"}), ("logistic", {"class_weight": "heavy"}), ("stump", {})):
        with pytest.raises(ValueError, match="Unknown"):
            M.fit(train, "target_7d_class", kind, **wrong)
        with pytest.raises(ValueError, match="Unknown"):
            M.random_search(train, "target_7d_class", kind, {k: [v] for k, v in wrong.items()}, draws=1, folds=2)


@pytest.fixture(scope="module")
def searched(parts):
    train, _ = parts
    sets = [{"C": c, "class_weight": w, "maxIter": 25} for c in (0.05, 20.0) for w in (None, "balanced")]
    return sets, *M.cross_validate_logistic(train, "target_7d_class", sets, 2)


def test_batched_search_scores_like_single_fits(spark, parts, searched):
    """Each set and fold alone, by Spark's own optimizer."""
    sets, scores, _ = searched
    for k in (1, 2):
        alone = M.cross_validate(parts[0], "target_7d_class", "logistic", 2, **sets[k])
        for a, b in zip(alone, scores[k], strict=True):
            assert a["fold"] == b["fold"] and a["accuracy"] == pytest.approx(b["accuracy"], abs=0.03) and a["macro_f1"] == pytest.approx(b["macro_f1"], abs=0.03)


def test_a_search_takes_the_passes_of_one_fit(spark, parts, searched):
    sets, _, passes = searched
    slowest = max(M.cross_validate_logistic(parts[0], "target_7d_class", [p], 2)[1] for p in sets[2:])
    assert passes <= slowest + 5


def test_expanding_folds_keep_rows_without_a_date(spark, frame):
    some = frame.select("date", "commodity").limit(20)
    lost = some.withColumn("date", F.when(F.col("commodity") != "1-URGENT", F.col("date")))
    rows = M.expanding_folds(lost, 4).collect()
    assert len(rows) == 20 and {r["fold"] for r in rows if r["date"] is None} <= {max(r["fold"] for r in rows), max(r["fold"] for r in rows) - 1}


def test_context_views_and_stream_scores(spark, frame, artifacts, caplog):
    service = S.InferenceService(spark, artifacts, 7)
    out = service.predict_with_context(frame, ["commodity", "absent"])
    assert out.columns == ["commodity", "horizon", "prediction", "confidence", "deflation", "stable", "inflation"]
    assert "target_7d_inflation_pct" in caplog.text and out.count() == frame.count()
    row = json.loads(frame.where("price_lag_30d is not null").limit(1).toJSON().collect()[0])
    assert service.predict_one(dict.fromkeys(S.REQUIRED_COLUMNS) | row)["prediction"] in CLASSES
    errors = M.error_frame(service.model, P.attach_targets(P.base_features(frame)), "target_7d_class")
    views = S.monitoring_views(errors)
    assert {k: v.isEmpty() for k, v in views.items()} == dict.fromkeys(views, False)
    assert score_stream(service, frame).columns == service.score(frame).columns


def test_boosting_scores_sum_to_one(spark, parts):
    train, valid = parts
    model = M.fit(train.limit(200), "target_7d_class", "boosting", maxIter=2, maxDepth=2)
    rows = M.predict(model, valid.limit(20)).select("p_deflation", "p_stable", "p_inflation", "confidence").collect()
    assert all(sum(r[:3]) == pytest.approx(1.0) and max(r[:3]) == r["confidence"] for r in rows)
    found = M.tree_importances(model)
    assert sum(r["importance"] for r in found) == pytest.approx(1.0) and found[0]["importance"] > 0


def test_feature_stream_equals_batch(spark, frame, tmp_path):
    rows = frame.where("price_lag_30d is not null").limit(20).select(*S.REQUIRED_COLUMNS)
    rows.write.json(str(tmp_path / "in"))
    stream = feature_stream(spark, str(tmp_path / "in"))
    q = stream.writeStream.format("memory").queryName("features_seen").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
    q.processAllAvailable()
    q.stop()
    got = {tuple(r) for r in spark.table("features_seen").select("date", "commodity", "price_zscore_30d").collect()}
    batch = P.base_features(spark.read.schema(S.PAYLOAD_SCHEMA).json(str(tmp_path / "in")))
    assert got == {tuple(r) for r in batch.select("date", "commodity", "price_zscore_30d").collect()}
