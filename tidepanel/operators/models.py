"""Preprocessing, model families, evaluation, cross-validation, search and importances.

A model is one ``PipelineModel``: SQL for imputation (and scaling), an index
and one-hot code for the commodity, an assembler and a classifier, so that it
is saved, loaded and applied as a whole in the JVM. Imputation values are exact
medians and modes of the training rows.

``boosting`` is multinomial boosting (``boosting.py``), whose trees are Spark's
tree ensembles, one for each class. A search over logistic models fits all of
them in the passes of one (``logistic.py``); permutation importance is one join
and one aggregate (``importance.py``).
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BINARY_FEATURES, CATEGORICAL_FEATURES, CLASSES, MODEL_FEATURES, NUMERIC_FEATURES
from ..functions import exprs as E
from ..sources.shared import forget, written
from . import analytics as A
from .boosting import Options, fit_boosting
from .checks import require_columns, require_no_leakage
from .logistic import Problem, confusions, fit_many
from .quantiles import exact_quantiles

SEED = 42
#: Spark indexes labels in this order, whatever the rows are.
LABELS = sorted(CLASSES)


# --- preprocessing ---------------------------------------------------------------


def imputation_values(train: DataFrame) -> dict[str, object]:
    """Exact medians of numbers, modes of flags and categories (which have few values)."""
    modes = train.agg(*(F.mode(c, True).alias(c) for c in CATEGORICAL_FEATURES + BINARY_FEATURES)).first().asDict()
    medians = {c: v for c, (v,) in exact_quantiles(train, {c: [0.5] for c in NUMERIC_FEATURES}).items()}
    found = modes | medians
    return {c: (found[c] if found[c] is not None else "" if c in CATEGORICAL_FEATURES else 0) for c in MODEL_FEATURES}


def _literal(x) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(x, str) else f"CAST({x!r} AS DOUBLE)"


def preprocessing(train: DataFrame, scale: bool = False) -> list:
    """Stages to a ``features`` vector; unknown commodities become zeros.

    ``scale`` standardizes numbers by mean and population deviation.
    """
    require_columns(train, MODEL_FEATURES)
    require_no_leakage(MODEL_FEATURES)
    values = imputation_values(train)
    filled = {c: f"coalesce({c}{'' if c in CATEGORICAL_FEATURES else ' * 1.0D'}, {_literal(values[c])})" for c in MODEL_FEATURES}
    if scale:
        stats = train.select(*(F.coalesce(F.col(c).cast("double"), F.lit(float(values[c]))).alias(c) for c in NUMERIC_FEATURES))
        row = stats.agg(*(x for c in NUMERIC_FEATURES for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")))).first()
        for c in NUMERIC_FEATURES:
            filled[c] = f"({filled[c]} - {_literal(row[f'm_{c}'] or 0.0)}) / {_literal(row[f's_{c}'] or 1.0)}"
    select = ", ".join(f"{x} AS x_{c}" for c, x in filled.items())
    numbers = [f"x_{c}" for c in BINARY_FEATURES + NUMERIC_FEATURES]
    return [
        SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
        StringIndexer(inputCol="x_commodity", outputCol="i_commodity", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="i_commodity", outputCol="v_commodity", dropLast=True),
        VectorAssembler(inputCols=["v_commodity", *numbers], outputCol="features", handleInvalid="keep"),
    ]


#: What each kind of model takes, with its default.
PARAMETERS = {
    "logistic": {"maxIter": 200, "C": 1.0, "class_weight": None, "solver": "lbfgs"},
    "forest": {"numTrees": 300, "maxDepth": 12, "minInstancesPerNode": 2, "subsamplingRate": 1.0, "featureSubsetStrategy": "auto", "class_weight": None},
    "boosting": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "minInstancesPerNode": 1, "subsamplingRate": 1.0, "featureSubsetStrategy": None},
}
#: Other names of the same parameters.
_ALSO = {"n_estimators": ("numTrees", "maxIter"), "max_iter": ("maxIter",), "learning_rate": ("stepSize",), "max_depth": ("maxDepth",), "min_samples_leaf": ("minInstancesPerNode",), "subsample": ("subsamplingRate",), "max_features": ("featureSubsetStrategy",)}
#: Ways to the same minimum; one optimizer serves them all.
SOLVERS = ("lbfgs", "newton-cg", "saga")


def checked_parameters(kind: str, params: dict) -> dict:
    """The parameters of a kind of model with defaults filled in; one it does not take is an error."""
    if kind not in PARAMETERS:
        raise ValueError(f"Unknown model kind: {kind}")
    known = PARAMETERS[kind]
    out = dict(known)
    for name, value in params.items():
        own = next((x for x in (name, *_ALSO.get(name, ())) if x in known), None)
        if own is None:
            raise ValueError(f"Unknown parameter of {kind}: {name}")
        out[own] = value
    if out.get("solver", "lbfgs") not in SOLVERS or out.get("class_weight") not in (None, "balanced"):
        raise ValueError(f"Unknown value among the parameters of {kind}: {params}")
    return out


def classifier(kind: str, rows: int, **params):
    """The estimator of a logistic or forest model; weights are in ``_weight``."""
    p = checked_parameters(kind, params)
    if kind == "logistic":
        return LogisticRegression(family="multinomial", standardization=False, maxIter=p["maxIter"], regParam=1 / (p["C"] * max(1, rows)), weightCol="_weight")
    if kind == "forest":
        trees = {x: p[x] for x in ("numTrees", "maxDepth", "minInstancesPerNode", "subsamplingRate")}
        return RandomForestClassifier(**trees, featureSubsetStrategy=p["featureSubsetStrategy"] or "all", weightCol="_weight", seed=SEED)
    raise ValueError(f"{kind} is no estimator of Spark ML")


def boosting_options(params: dict) -> Options:
    p = checked_parameters("boosting", params)
    return Options(rounds=p["maxIter"], learning_rate=p["stepSize"], max_depth=p["maxDepth"], min_samples_leaf=p["minInstancesPerNode"], subsample=p["subsamplingRate"], max_features=p["featureSubsetStrategy"], seed=SEED)


def with_class_weights(rows: DataFrame, class_weight: str | None) -> DataFrame:
    """Add _weight: 1, or for "balanced" what gives each class that occurs the same sum."""
    if class_weight is None:
        return rows.withColumn("_weight", F.lit(1.0))
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = reduce(lambda out, k: F.when(F.col("label") == k, sum(n.values()) / (len(n) * n[k])).otherwise(out), n, F.lit(0.0))
    return rows.withColumn("_weight", weight)


def with_label_index(frame: DataFrame, target: str) -> DataFrame:
    return frame.withColumn("label", (F.array_position(F.array(*map(F.lit, LABELS)), F.col(target)) - 1).cast("double"))


def label_stage(labels: list[str] = LABELS) -> IndexToString:
    """Predictions back to classes; it carries the model's own order of classes, wherever the model is saved."""
    return IndexToString(inputCol="prediction", outputCol="prediction_label", labels=list(labels))


def model_labels(model: PipelineModel) -> list[str]:
    """The classes of a model in the order of its probabilities."""
    stages = [s for s in model.stages if isinstance(s, IndexToString)]
    if not stages:
        raise ValueError("The model does not say which classes it has")
    return list(stages[-1].getLabels())


def fit(train: DataFrame, target: str, kind: str = "boosting", **params) -> PipelineModel:
    """Fit preprocessing and model on rows that have the target."""
    p = checked_parameters(kind, params)
    rows = with_label_index(train.where(F.col(target).isNotNull()), target).cache()
    try:
        stages = preprocessing(rows, scale=kind == "logistic")
        if kind == "boosting":
            prepared = Pipeline(stages=stages).fit(rows)
            boosted = fit_boosting(prepared.transform(rows), len(LABELS), boosting_options(params))
            return PipelineModel(stages=[*prepared.stages, *boosted.stages(train.sparkSession), label_stage()])
        weighted = with_class_weights(rows, p["class_weight"])
        return Pipeline(stages=[*stages, classifier(kind, rows.count(), **params), label_stage()]).fit(weighted)
    finally:
        rows.unpersist()


def probabilities(transformed: DataFrame, labels: list[str] = LABELS) -> dict[str, Column]:
    """Probability columns by class name, for a model with its classes in the order of ``labels``."""
    p = F.col("probability") if dict(transformed.dtypes)["probability"].startswith("array") else vector_to_array(F.col("probability"))
    return {k: p[i] for i, k in enumerate(labels)}


def predict(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """The frame's columns with pred_class, confidence and a probability for each class."""
    out = model.transform(frame)
    p = probabilities(out, model_labels(model))
    scored = out.select(*frame.columns, *(p[k].alias(f"p_{k.lower()}") for k in sorted(p)))
    named = {k: F.col(f"p_{k.lower()}") for k in CLASSES}
    return scored.withColumns({"pred_class": E.best_class(named), "confidence": F.greatest(*named.values())})


# --- evaluation --------------------------------------------------------------------


def report_metrics(report: DataFrame) -> dict:
    """accuracy, macro_f1, weighted_f1 and the rows of a classification report."""
    rows = {r["label"]: r.asDict() for r in report.collect()}
    return {"accuracy": rows["accuracy"]["f1"], "macro_f1": rows["macro avg"]["f1"], "weighted_f1": rows["weighted avg"]["f1"], "report": list(rows.values())}


def evaluate(model: PipelineModel, frame: DataFrame, target: str) -> dict:
    """accuracy, macro_f1, weighted_f1 and the report's rows, over rows that have the target."""
    errors = predict(model, frame.where(F.col(target).isNotNull())).withColumnRenamed(target, "true_class")
    return report_metrics(A.classification_report(errors))


def error_frame(model: PipelineModel, frame: DataFrame, target: str) -> DataFrame:
    out = predict(model, frame).withColumnRenamed(target, "true_class")
    correct = (F.col("true_class") == F.col("pred_class")).cast("int")
    return out.withColumns({"is_correct": correct, "is_error": 1 - correct})


@dataclass(frozen=True)
class EvaluationBundle:
    """What an evaluation leaves: figures, small tables as rows, and the error frame (lazy)."""

    target: str
    metrics: dict[str, float]
    report: list[dict]
    confusion: list[dict]
    errors: DataFrame

    def to_dict(self) -> dict:
        return {"target": self.target, "metrics": self.metrics, "report": self.report, "confusion": self.confusion}


def evaluation_bundle(model: PipelineModel, frame: DataFrame, target: str) -> EvaluationBundle:
    """Metrics, report, confusion matrix and error frame of the rows that have the target."""
    found = evaluate(model, frame, target)
    errors = error_frame(model, frame.where(F.col(target).isNotNull()), target)
    confusion = [r.asDict() for r in A.confusion_matrix(errors).orderBy("true_class").collect()]
    return EvaluationBundle(target, {k: v for k, v in found.items() if k != "report"}, found["report"], confusion, errors)


def compare(train: DataFrame, valid: DataFrame, target: str, kinds=("logistic", "forest", "boosting"), **params) -> list[dict]:
    """Scores of each kind on the validation rows, best macro F1 first."""
    rows = [{"model": k} | {m: v for m, v in evaluate(fit(train, target, k, **params.get(k, {})), valid, target).items() if m != "report"} for k in kinds]
    return sorted(rows, key=lambda r: -r["macro_f1"])


def expanding_folds(frame: DataFrame, folds: int = 5) -> DataFrame:
    """Add fold: rows of fold k (from 1) are tested by a model of all rows with a lower fold; 0 is never tested.

    Rows count in the order of date and commodity, n // (folds + 1) to a test
    fold, the rest at the beginning; rows without a date come last. Positions
    come from counts of days, so only days and not rows are ordered in one place.
    """
    per_day = frame.groupBy("date").agg(F.count("*").alias("_n"))
    before = per_day.select(F.col("date").alias("_day"), F.coalesce(F.sum("_n").over(Window.orderBy(F.asc_nulls_last("date")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("date").orderBy("commodity")) - 1
    n = frame.agg(F.count("*").alias("_all"))
    placed = frame.withColumn("_at", within).join(before, F.col("date").eqNullSafe(F.col("_day"))).drop("_day").crossJoin(F.broadcast(n))
    size = F.greatest(F.floor(F.col("_all") / (folds + 1)), F.lit(1))
    first = F.col("_all") - folds * size
    at = F.col("_before") + F.col("_at")
    return placed.withColumn("fold", F.when(at < first, 0).otherwise(F.floor((at - first) / size) + 1).cast("int")).drop("_at", "_before", "_all")


def cross_validate(frame: DataFrame, target: str, kind: str, folds: int = 5, **params) -> list[dict]:
    """Scores of each fold; the frame with its folds is cached once."""
    marked = expanding_folds(frame, folds).cache()
    try:
        out = []
        for k in range(1, folds + 1):
            model = fit(marked.where(F.col("fold") < k), target, kind, **params)
            out.append({"fold": k} | {m: v for m, v in evaluate(model, marked.where(F.col("fold") == k), target).items() if m != "report"})
        return out
    finally:
        marked.unpersist()


def cv_summary(rows: list[dict]) -> dict[str, float]:
    out = {}
    for m in ("accuracy", "macro_f1", "weighted_f1"):
        v = [r[m] for r in rows]
        mean = sum(v) / len(v)
        out |= {f"{m}_mean": mean, f"{m}_std": (sum((x - mean) ** 2 for x in v) / len(v)) ** 0.5}
    return out


def random_search(frame: DataFrame, target: str, kind: str, grid: dict[str, list], draws: int = 20, folds: int = 4, seed: int = SEED) -> list[dict]:
    """Cross-validated scores of drawn parameter sets, best macro F1 first; all sets, where there are fewer than draws.

    Logistic models of all sets and folds are fitted together.
    """
    every = [dict(zip(grid, x, strict=True)) for x in product(*grid.values())]
    chosen = random.Random(seed).sample(every, min(draws, len(every)))
    for p in chosen:
        checked_parameters(kind, p)
    if kind == "logistic":
        scores = cross_validate_logistic(frame, target, chosen, folds)[0]
    else:
        scores = [cross_validate(frame, target, kind, folds, **p) for p in chosen]
    rows = [{"params": p} | cv_summary(s) for p, s in zip(chosen, scores, strict=True)]
    return sorted(rows, key=lambda r: -r["macro_f1_mean"])


def cross_validate_logistic(frame: DataFrame, target: str, sets: list[dict], folds: int) -> tuple[list[list[dict]], int]:
    """Scores of each fold for each set of parameters, and the passes over the rows that fitting all took.

    Preprocessing is learned from each fold's training rows; the prepared rows
    of all folds are written once and each pass reads them.
    """
    marked = expanding_folds(frame, folds).where(F.col(target).isNotNull()).cache()
    parts = []
    for k in range(1, folds + 1):
        train = with_label_index(marked.where(F.col("fold") < k), target)
        own = with_label_index(marked.where(F.col("fold") <= k), target)
        prepared = Pipeline(stages=preprocessing(train, scale=True)).fit(train).transform(own)
        # A one-hot vector is as long as the commodities of its fold, so rows of a fold are alike and folds may differ.
        parts.append(prepared.select(F.lit(k).alias("group"), F.col("label").cast("int").alias("label"), vector_to_array("features").alias("features"), (F.col("fold") == k).alias("tested")))
    width = reduce(lambda a, b: a.unionAll(b), [p.agg(F.max(F.size("features")).alias("w")) for p in parts]).agg(F.max("w")).first()[0]
    padded = F.concat(F.array_repeat(F.lit(0.0), F.lit(width) - F.size("features")), F.col("features"))
    rows = written(reduce(lambda a, b: a.unionAll(b), parts).withColumn("features", padded), "folds")
    try:
        filled = [checked_parameters("logistic", p) for p in sets]
        problems = [Problem(k, p["C"], p["class_weight"], p["maxIter"]) for p in filled for k in range(1, folds + 1)]
        fitted = fit_many(rows.where(~F.col("tested")), problems, len(LABELS))
        found = confusions(rows.where("tested"), problems, fitted, len(LABELS))
    finally:
        marked.unpersist()
        forget(rows)
    scores = [{"fold": p.group} | confusion_metrics(c) for p, c in zip(problems, found, strict=True)]
    return [scores[i * folds : (i + 1) * folds] for i in range(len(sets))], fitted.passes


def confusion_metrics(counts: np.ndarray) -> dict[str, float]:
    """accuracy, macro_f1, weighted_f1 of counts by true and predicted class; a class that never occurs scores 0."""
    hit, true, pred, n = counts.diagonal(), counts.sum(axis=1), counts.sum(axis=0), max(1, counts.sum())
    f1 = 2 * hit / np.maximum(true + pred, 1)
    return {"accuracy": float(hit.sum() / n), "macro_f1": float(f1.mean()), "weighted_f1": float((f1 * true).sum() / n)}


# --- importances ---------------------------------------------------------------------


def feature_names(model: PipelineModel) -> list[str]:
    names = [f"commodity={x}" for x in model.stages[1].labels]
    return names + BINARY_FEATURES + NUMERIC_FEATURES


def _classifier(model: PipelineModel):
    """The stage before the classes' names."""
    return model.stages[-2]


def tree_importances(model: PipelineModel) -> list[dict]:
    """Importances of a forest, or the mean over the classes of boosting."""
    parts = [x.featureImportances.toArray() for x in model.stages if hasattr(x, "featureImportances")]
    return sorted(({"feature": n, "importance": float(sum(p[i] for p in parts) / len(parts))} for i, n in enumerate(feature_names(model))), key=lambda r: -r["importance"])


def coefficients(model: PipelineModel) -> list[dict]:
    """Coefficients of each class and the largest size among them, largest first."""
    matrix = _classifier(model).coefficientMatrix.toArray()
    rows = [{"feature": n} | {k: float(matrix[j, i]) for j, k in enumerate(LABELS)} | {"max_abs": float(abs(matrix[:, i]).max())} for i, n in enumerate(feature_names(model))]
    return sorted(rows, key=lambda r: -r["max_abs"])
