"""Sinks: ordered single files for people, Parquet for engines, reports and JSON."""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gate import Diagnosis
from .artifacts import Files, joined


def _order():
    return F.asc_nulls_last("commodity"), F.asc_nulls_last("date")


def panel_order(frame: DataFrame) -> DataFrame:
    return frame.orderBy(*_order())


def write_csv(frame: DataFrame, path: str, sort: bool = True, single_file: bool = False) -> None:
    """A folder of CSV parts with headers, globally ordered by commodity and date.

    With ``single_file`` one task sorts and writes the rows; a shuffle parts it
    from the work before, which stays parallel.
    """
    if single_file:
        one = frame.repartition(1)
        own = one.sortWithinPartitions(*_order()) if sort else one
    else:
        own = panel_order(frame) if sort else frame
    own.write.mode("overwrite").option("header", True).csv(str(path))


def write_parquet(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(str(path))


def write_engineered(frame: DataFrame, folder: str, version: str = "", format: str = "csv") -> str:
    """The frame with its engineered features (and a version's labels) as ``feature_engineered[_version]``."""
    path = joined(folder, "feature_engineered" + (f"_{version}" if version else "") + f".{format}")
    (write_csv if format == "csv" else write_parquet)(frame, path)
    return path


def csv_text(rows: list[dict]) -> str:
    """Small rows that are on the driver already, as the text of a CSV file."""
    out = io.StringIO(newline="")
    if rows:
        writer = csv.DictWriter(out, list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
    return out.getvalue()


def _coverage(features: list[dict], targets: list[dict]) -> list[dict]:
    """Full outer join on (commodity, row_count); columns that both have get _x and _y."""
    if not features or not targets:
        return features or targets
    keys = ("commodity", "row_count")
    both = (set(features[0]) & set(targets[0])) - set(keys)
    named = lambda r, end: {k + (end if k in both else ""): v for k, v in r.items() if k not in keys}
    blank = {k: None for r, end in ((features[0], "_x"), (targets[0], "_y")) for k in named(r, end)}
    out: dict[tuple, dict] = {}
    for rows, end in ((features, "_x"), (targets, "_y")):
        for r in rows:
            key = tuple(r[k] for k in keys)
            out.setdefault(key, dict(zip(keys, key, strict=True)) | blank).update(named(r, end))
    return [out[k] for k in sorted(out)]


def markdown_report(found: Diagnosis) -> str:
    def table(rows: list[dict], columns: list[str]) -> list[str]:
        show = lambda v: "" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v)
        return ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns), *("| " + " | ".join(show(r.get(c)) for c in columns) + " |" for r in rows), ""]

    s = found.sections
    out = ["# Panel diagnostics", "", f"Readiness: **{found.status.value}**", ""]
    for title, lines in (("Failures", found.failures), ("Warnings", found.warnings)):
        out += [f"## {title}", "", *(f"- {x}" for x in lines or ["none"]), ""]
    overall = s["overall"][0]
    out += ["## Canonical panel", "", *(f"- {k}: {v}" for k, v in overall.items()), ""]
    out += ["## Trainability", "", *table(s["targets"], ["commodity", "row_count", "trainable_rows_7d", "trainable_rows_30d"])]
    out += ["## Feature tiers", "", *table(s["features"], ["commodity", "critical_all_non_null_rate", "important_all_non_null_rate", "auxiliary_all_non_null_rate"])]
    out += ["## Class balance", "", *table(s["balance"], ["commodity", "horizon", "deflation_ratio", "stable_ratio", "inflation_ratio"])]
    out += ["## Match quality", "", *table(s["match"], ["field", "exact_ratio", "tolerance_ratio", "no_match_ratio"])]
    return "\n".join(out)


def write_diagnostics(spark: SparkSession, found: Diagnosis, folder: str) -> dict[str, str]:
    """JSON summary, Markdown report and five CSV files, at a folder or URI; what was written, by name."""
    files = Files(spark)
    files.make_folder(str(folder))
    s = found.sections
    tables = {"gap_csv": s["gaps"], "coverage_csv": _coverage(s["features"], s["targets"]), "windows_csv": s["windows"], "class_balance_csv": s["balance"], "match_quality_csv": s["match_by_commodity"]}
    texts = {"json": ("summary.json", json.dumps(found.to_dict(), indent=2, sort_keys=True)), "markdown": ("report.md", markdown_report(found))}
    texts |= {k: (f"{k.removesuffix('_csv')}.csv", csv_text(rows)) for k, rows in tables.items()}
    for name, text in texts.values():
        files.write_text(joined(folder, name), text)
    return {k: joined(folder, name) for k, (name, _) in texts.items()}
