"""Training both horizons to artifacts, and the prediction service over them."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CLASSES, INPUT_CONTRACT, MODEL_FEATURES, MODEL_VERSION, REQUIRED_COLUMNS, STABLE_BAND, TARGET_CLASSES, artifact_root, metadata_path, model_path
from ..sources.artifacts import Files, current, publish
from . import features as P
from . import models as M
from .checks import contract_report, require_column_order, require_columns, require_horizon, require_input_contract, require_no_leakage, require_rows

log = logging.getLogger(__name__)

_NUMBERS = {"year": T.IntegerType(), "month": T.IntegerType(), "week_of_year": T.IntegerType(), "day_of_week": T.IntegerType(), "is_observed_source": T.IntegerType(), "is_month_start": T.IntegerType(), "is_month_end": T.IntegerType()}
PAYLOAD_SCHEMA = T.StructType([T.StructField(c, T.DateType() if c == "date" else T.StringType() if c == "commodity" else _NUMBERS.get(c, T.DoubleType())) for c in REQUIRED_COLUMNS])


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """A feature-ready CSV with the two target columns, by its schema; nothing is inferred."""
    targets = [T.StructField(f"target_{h}d_inflation_pct", T.DoubleType()) for h in (7, 30)]
    with_header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in [*PAYLOAD_SCHEMA.fields, *targets]}
    schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in with_header])
    return spark.read.schema(schema).option("header", True).csv(path)


def payload_frame(spark: SparkSession, payload: str | dict | list[dict]) -> DataFrame:
    """One or more JSON objects as a frame of the input contract; other fields are left out."""
    rows = json.loads(payload) if isinstance(payload, str) else payload
    rows = rows if isinstance(rows, list) else [rows]
    missing = sorted({c for r in rows for c in REQUIRED_COLUMNS if c not in r})
    if missing:
        raise ValueError(f"Missing feature-ready input columns: {missing}")
    text = spark.createDataFrame([(json.dumps(r, default=str),) for r in rows], "payload string")
    return parse_payloads(text, "payload")


def parse_payloads(frame: DataFrame, column: str) -> DataFrame:
    """JSON objects of a text column as rows of the input contract; what is missing or malformed is null."""
    return frame.select(F.from_json(column, PAYLOAD_SCHEMA).alias("x")).select("x.*")


def training_summary(train: DataFrame, target: str) -> DataFrame:
    """label, n, and the first and last date of all train rows: what training logs and its metadata keep."""
    counts = train.groupBy(F.col(target).alias("label")).agg(F.count("*").alias("n"))
    ends = train.agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    return counts.crossJoin(F.broadcast(ends))


def inference_features(frame: DataFrame) -> DataFrame:
    """The model's columns, in their order, of a feature-ready frame."""
    return P.model_columns(P.base_features(frame))


def train_and_save(frame: DataFrame, root: str, horizons=(7, 30), band: float = STABLE_BAND, kind: str = "boosting", **params) -> dict[int, dict]:
    """Fit, evaluate on the validation rows and publish a model with its metadata for each horizon, at a folder or URI."""
    spark = frame.sparkSession
    ready = P.attach_targets(P.base_features(frame), band).cache()
    out = {}
    try:
        for horizon in horizons:
            require_horizon(horizon)
            target = TARGET_CLASSES[horizon]
            split = P.time_split(ready, target).cache()
            require_no_leakage(MODEL_FEATURES)
            train = split.where("split = 'train'")
            model = M.fit(train, target, kind, **params)
            seen = training_summary(train, target).collect()
            start, end = (str(seen[0][c]) if seen else None for c in ("start_date", "end_date"))
            out[horizon] = {
                "input_contract": INPUT_CONTRACT,
                "model_version": MODEL_VERSION,
                "training_timestamp_utc": datetime.now(timezone.utc).isoformat(),
                "class_names": M.model_labels(model),
                "stable_band": band,
                "raw_required_columns": REQUIRED_COLUMNS,
                "engineered_feature_columns": MODEL_FEATURES,
                "target_column": target,
                "horizon": horizon,
                "training_start_date": start,
                "training_end_date": end,
                "training_class_counts": {r["label"]: r["n"] for r in seen},
                "model_type": kind,
                "artifact_name": artifact_root(root, horizon).rsplit("/", 1)[-1],
                "metrics": M.evaluate(model, split.where("split = 'valid'"), target),
            }

            def write(folder: str, model=model, metadata=out[horizon]) -> None:
                model.write().overwrite().save(model_path(folder))
                Files(spark).write_text(metadata_path(folder), json.dumps(metadata, indent=2))

            publish(spark, artifact_root(root, horizon), write)
            split.unpersist()
    finally:
        ready.unpersist()
    return out


def validate_metadata(metadata: dict, horizon: int, classes: list[str] | None = None) -> None:
    if metadata.get("horizon") != horizon:
        raise ValueError(f"Metadata horizon {metadata.get('horizon')} differs from the service horizon {horizon}")
    if metadata.get("input_contract") != INPUT_CONTRACT:
        raise ValueError(f"Input contract mismatch: {metadata.get('input_contract')!r}")
    if classes is not None and list(metadata.get("class_names", [])) != list(classes):
        raise ValueError(f"Model classes {classes} differ from the metadata's {metadata.get('class_names')}")


class InferenceService:
    """Scores feature-ready rows with a horizon's artifact, behind its contract."""

    def __init__(self, spark: SparkSession, root: str, horizon: int = 7, model: PipelineModel | None = None, metadata: dict | None = None):
        require_horizon(horizon)
        self.spark, self.horizon = spark, horizon
        # One version for both, whatever is published meanwhile.
        version = current(spark, artifact_root(root, horizon)) if metadata is None or model is None else ""
        self.metadata = metadata if metadata is not None else json.loads(Files(spark).read_text(metadata_path(version)))
        self.model = model if model is not None else PipelineModel.load(model_path(version))
        validate_metadata(self.metadata, horizon, M.model_labels(self.model))

    def score(self, frame: DataFrame) -> DataFrame:
        """All columns of the rows with prediction, probabilities, horizon and model_version; lazy."""
        require_input_contract(frame)
        ready = P.base_features(frame)
        expected = self.metadata["engineered_feature_columns"]
        require_columns(ready, expected, "engineered feature columns")
        require_column_order(P.model_columns(ready).columns, expected)
        out = M.predict(self.model, ready)
        chance = F.struct(*(F.col(f"p_{c.lower()}").alias(c.lower()) for c in CLASSES))
        return out.select(*frame.columns, F.col("pred_class").alias("prediction"), chance.alias("probabilities"), "confidence", F.lit(self.horizon).alias("horizon"), F.lit(self.metadata["model_version"]).alias("model_version"))

    def predict(self, raw: DataFrame | str | dict | list[dict]) -> list[dict]:
        """Records, ordered by commodity and date; for answers to a caller, not for bulk scoring."""
        frame = raw if isinstance(raw, DataFrame) else payload_frame(self.spark, raw)
        require_rows(frame, "Inference input is empty")
        rows = self.score(frame).orderBy(F.asc_nulls_last("commodity"), F.asc_nulls_last("date")).select("prediction", "probabilities", "horizon", "model_version").collect()
        now = datetime.now(timezone.utc).isoformat()
        return [r.asDict(recursive=True) | {"generated_at_utc": now} for r in rows]

    def predict_with_context(self, frame: DataFrame, context: list[str] | None = None) -> DataFrame:
        """Those context columns that the frame has, then horizon, prediction, confidence and probabilities of each row.

        Other columns outside the input contract are left out, and logged.
        """
        shown = [c for c in context or [] if c in frame.columns]
        if extra := [c for c, status, _ in contract_report(frame.columns, REQUIRED_COLUMNS) if status == "extra" and c not in shown]:
            log.warning("Ignored extra columns: %s", extra)
        return self.score(frame).select(*shown, "horizon", "prediction", "confidence", "probabilities.*")

    def predict_one(self, features: dict) -> dict:
        """The record of one flat object."""
        return self.predict(features)[0]


def monitoring_views(errors: DataFrame) -> dict[str, DataFrame]:
    """The frames behind the monitoring charts of an error frame."""
    from . import analytics as A

    return {
        "monthly_price": A.monthly_means(errors, ["price_idr"]),
        "class_share_by_month": A.class_share_by_month(errors),
        "confusion": A.confusion_matrix(errors),
        "by_commodity": A.error_summary(errors, ["commodity"]),
    }
