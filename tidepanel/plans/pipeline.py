"""The dataset build: sheet to canonical panel to features to targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.checks import validate_canonical
from ..operators.features import feature_ready, training_ready
from ..sources.artifacts import joined
from ..sources.ingest import canonical_long, parse_wide, top_level_rows
from ..sources.sheets import read_sheet
from ..sources.sinks import write_csv, write_parquet


@dataclass(frozen=True)
class Outputs:
    canonical: DataFrame
    feature_ready: DataFrame
    training_ready: DataFrame


def build_from_wide(frame: DataFrame, require_all: bool = True) -> Outputs:
    """The panel is cached: it is validated first and read by both results."""
    sheet = parse_wide(frame)
    panel = canonical_long(top_level_rows(sheet), sheet).cache()
    validate_canonical(panel, require_all)
    return Outputs(panel, feature_ready(panel, check=False), training_ready(panel, check=False))


def build_dataset(spark: SparkSession, path: str, sheet: str | int = 0) -> Outputs:
    return build_from_wide(read_sheet(spark, path, sheet))


def save_outputs(outputs: Outputs, folder: str, format: str = "csv", single_file: bool = False) -> None:
    """The three frames, ordered by commodity and date; ``single_file`` writes one CSV part each, for people and small panels."""
    for name in ("canonical", "feature_ready", "training_ready"):
        frame = getattr(outputs, name)
        if format == "csv":
            write_csv(frame, joined(folder, f"{name}.csv"), single_file=single_file)
        else:
            write_parquet(frame, joined(folder, f"{name}.parquet"))
