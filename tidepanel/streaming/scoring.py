"""Row-local features and scores over a stream: an extra of this engine.

Model features look at no other row, so the batch expressions run unchanged
under Structured Streaming; lags and targets need history and stay in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.features import base_features
from ..operators.service import PAYLOAD_SCHEMA, InferenceService


def feature_stream(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    """Feature-ready JSON files arriving in a folder, with the model features."""
    rows = spark.readStream.schema(PAYLOAD_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return base_features(rows)


def score_stream(service: InferenceService, rows: DataFrame) -> DataFrame:
    return service.score(rows)
