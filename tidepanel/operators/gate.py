"""The readiness gate: every rule is a row (rule, subject, metric, warn and fail bounds), judged in one expression.

The rules read the small diagnostics frames, so the gate is a plan like any
other; the driver only words the messages of rows that are not fine.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CLASSES, TARGET_VALUES, TIERS, DiagnosticsConfig
from ..sources.shared import written
from . import diagnostics as D
from .checks import duplicate_pairs


class Readiness(str, Enum):
    PASS = "PASS"
    PASS_WITH_WARNINGS = "PASS_WITH_WARNINGS"
    FAIL = "FAIL"


#: What a rule says of its subject; {s} is the subject, {v} the value.
WORDS = {
    "duplicates": "Duplicate (date, commodity) pairs exceed the threshold: {v:.0f}.",
    "null_prices": "Share of null prices is too high: {v:.3f}.",
    "non_positive_prices": "Share of non-positive prices is too high: {v:.3f}.",
    "unexpected": "Unexpected commodities in the canonical panel: {v:.0f}.",
    "missing_days": "{s}: many days without an observation ({v:.3f}).",
    "critical_feature": "{s}: low non-null rate of a critical feature ({v:.3f}).",
    "model_rows": "{s}: few rows have all model features ({v:.3f}).",
    "target_rate_low": "{s}: low non-null rate of the target ({v:.3f}).",
    "target_rate_least": "{s}: non-null rate of the target is below the least one ({v:.3f}).",
    "trainable": "{s}: too few trainable rows ({v:.0f}).",
    "trainable_total": "Too few trainable rows in all for {s} ({v:.0f}).",
    "span": "{s}: trainable rows lie within few days ({v:.0f}).",
    "classes": "{s}: class support too narrow ({v:.0f} classes).",
    "class_ratio": "{s}: class is rare ({v:.3f}).",
    "tolerance": "{s}: many matches only within the tolerance ({v:.3f}).",
    "no_match": "{s}: many rows without a match ({v:.3f}).",
    "p90_change": "{s}: 90th percentile of the 1-day change is extreme ({v:.2f}%).",
    "max_to_median": "{s}: largest change is far above the median ({v:.2f}).",
    "flat": "{s}: long segment of one price ({v:.0f} rows).",
    "jumps": "{s}: price jumps, the largest change {v:.2f} times the median.",
}


def _rows(frame: DataFrame, config: DiagnosticsConfig, *rules) -> DataFrame:
    """rules: (rule, subject, value), the value a column; a rule's name ends before its horizon."""
    made = []
    for rule, subject, value in rules:
        bound = config.bound(rule)
        parts = {"rule": F.lit(rule.split()[0]), "subject": F.lit(subject), "value": value.cast("double"), "warn_bound": F.lit(bound.warn).cast("double"), "fail_bound": F.lit(bound.fail).cast("double"), "above": F.lit(bound.above)}
        made.append(F.struct(*(x.alias(n) for n, x in parts.items())))
    return frame.select(F.explode(F.array(*made)).alias("x")).select("x.*")


def rule_rows(parts: dict[str, DataFrame], config: DiagnosticsConfig) -> DataFrame:
    """rule, subject, value, bounds and verdict (PASS, WARN, FAIL) for every rule and subject.

    parts: overall, duplicates, unexpected (counts), gaps, profile, horizons, match, flat.
    """
    c = F.col("commodity")
    of = lambda what: F.concat(c, F.lit(f" {what}"))
    row_share = lambda x: F.coalesce(F.try_divide(F.col(x), F.col("row_count")), F.lit(0.0))
    horizons = [f"{h}d" for h in TARGET_VALUES]
    profile = parts["profile"]
    frames = [
        _rows(parts["overall"], config, ("null_prices", "all", row_share("null_prices")), ("non_positive_prices", "all", row_share("non_positive_prices"))),
        _rows(parts["duplicates"], config, ("duplicates", "all", F.col("n"))),
        _rows(parts["unexpected"], config, ("unexpected", "all", F.col("n"))),
        _rows(parts["gaps"], config, ("missing_days", c, F.col("missing_day_ratio"))),
        _rows(
            profile,
            config,
            *(("critical_feature", of(f), F.col(f"{f}_non_null_rate")) for f in TIERS["critical"]),
            ("model_rows", c, F.col("model_feature_usable_rate")),
            # A rate below both bounds warns and fails: two rules.
            *((rule, of(h), F.col(f"target_{h}_non_null_rate")) for h in horizons for rule in ("target_rate_low", "target_rate_least")),
            *((f"trainable {h}", of(h), F.col(f"trainable_rows_{h}")) for h in horizons),
            ("p90_change", c, F.abs("price_change_1d_pct_p90")),
            *(("max_to_median", of(k), F.col(f"max_to_median_{k}")) for k in ("1d", "7d", "30d")),
            ("jumps", c, F.when(F.col("structural_jump_count") > 0, F.col("max_to_median_1d"))),
        ),
        _rows(D.usable_totals(profile), config, *((f"trainable_total {h}", h, F.col(f"trainable_rows_{h}_total")) for h in horizons)),
        *(
            _rows(
                parts["horizons"].where(F.col("horizon") == h),
                config,
                (f"span {h}", of(h), F.col("span_days")),
                ("classes", of(h), F.col("classes_present")),
                *(("class_ratio", of(f"{h} {k}"), F.col(f"{k.lower()}_ratio")) for k in CLASSES),
            )
            for h in horizons
        ),
        _rows(parts["match"], config, ("tolerance", F.col("field"), F.col("tolerance_ratio")), ("no_match", F.col("field"), F.col("no_match_ratio"))),
        _rows(parts["flat"], config, ("flat", c, F.col("max_flatline_segment_days"))),
    ]
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    beyond = lambda bound: F.coalesce(F.when(F.col("above"), F.col("value") > F.col(bound)).otherwise(F.col("value") < F.col(bound)), F.lit(False))
    return out.withColumn("verdict", F.when(beyond("fail_bound"), "FAIL").when(beyond("warn_bound"), "WARN").otherwise("PASS"))


@dataclass(frozen=True)
class Diagnosis:
    """Status, messages, and the small frames behind them as lists of rows."""

    status: Readiness
    failures: list[str]
    warnings: list[str]
    sections: dict[str, list[dict[str, Any]]] = field(default_factory=dict)

    def to_dict(self) -> dict[str, Any]:
        return {"readiness_status": self.status.value, "failures": self.failures, "warnings": self.warnings} | self.sections


def rule_frames(canonical: DataFrame, training: DataFrame, config: DiagnosticsConfig) -> dict[str, DataFrame]:
    """The frames that the rules read, lazy; each is as large as the commodities are many.

    What groups alike comes from one aggregate: ``profile`` by commodity,
    ``horizons`` by commodity and horizon.
    """
    unexpected = D.unexpected_commodities(canonical, config.allowed_commodities) if config.allowed_commodities is not None else canonical.select("commodity").limit(0)
    return {
        "overall": D.canonical_overall(canonical),
        "duplicates": duplicate_pairs(canonical).agg(F.count("*").alias("n")),
        "unexpected": unexpected.agg(F.count("*").alias("n")),
        "gaps": D.gap_metrics(canonical),
        "profile": D.profile(training, config.bound("jumps").warn),
        "horizons": D.horizon_profile(training, config.stable_band),
        "flat": D.flat_runs(training),
        "match": D.match_quality(training, overall=True),
    }


def judged(canonical: DataFrame, training: DataFrame, config: DiagnosticsConfig) -> DataFrame:
    """``rule_rows`` of a panel and its features, computed at once: both are read by all rules and computed once.

    The few judged rows are kept in the shared folder.
    """
    canonical, training = canonical.persist(), training.persist()
    try:
        return written(rule_rows(rule_frames(canonical, training, config), config), "rules")
    finally:
        canonical.unpersist()
        training.unpersist()


def section_frames(canonical: DataFrame, training: DataFrame, rules: dict[str, DataFrame], config: DiagnosticsConfig) -> dict[str, DataFrame]:
    """The frames of a diagnosis; most choose columns of those that the rules read."""
    section = D.section_columns()
    profile, horizons = rules["profile"], rules["horizons"]
    return {
        "overall": rules["overall"],
        "by_commodity": D.canonical_by_commodity(canonical),
        "duplicates": rules["duplicates"],
        "unexpected": rules["unexpected"],
        "gaps": rules["gaps"],
        "features": profile.select("commodity", *section["features"]),
        "first_valid": D.first_valid_dates(training),
        "targets": profile.select("commodity", *section["targets"]),
        "target_totals": D.usable_totals(profile),
        "windows": horizons.select("commodity", "horizon", *section["windows"]),
        "balance": horizons.select("commodity", "horizon", *section["balance"]),
        "balance_overall": D.class_balance(training, config.stable_band, overall=True),
        "match_by_commodity": D.match_quality(training),
        "match": rules["match"],
        "distribution": profile.select("commodity", *section["distribution"]).join(rules["flat"], "commodity"),
    }


def _plain(value):
    """Missing as None, dates as text."""
    if value is None or isinstance(value, float) and value != value:
        return None
    return value.isoformat() if hasattr(value, "isoformat") else value


def evaluate(frames: dict[str, DataFrame], config: DiagnosticsConfig) -> tuple[Readiness, list[str], list[str]]:
    got = rule_rows(frames, config).where("verdict <> 'PASS'").collect()
    word = lambda r: WORDS[r["rule"]].format(s=r["subject"], v=r["value"])
    failures, warnings = (sorted({word(r) for r in got if r["verdict"] == v}) for v in ("FAIL", "WARN"))
    return Readiness.FAIL if failures else Readiness.PASS_WITH_WARNINGS if warnings else Readiness.PASS, failures, warnings


def diagnose(canonical: DataFrame, training: DataFrame, config: DiagnosticsConfig | None = None) -> Diagnosis:
    """Everything about a panel and its features. Only per-commodity summaries come to the driver."""
    config = config or DiagnosticsConfig()
    canonical, training = canonical.cache(), training.cache()
    rules = rule_frames(canonical, training, config)
    # Summaries are small, and several sections choose from them.
    for frame in rules.values():
        frame.cache()
    try:
        status, failures, warnings = evaluate(rules, config)
        keys = {"by_commodity": ["commodity"], "gaps": ["commodity"]}
        sections = {}
        for name, frame in section_frames(canonical, training, rules, config).items():
            order = keys.get(name) or [c for c in ("commodity", "horizon", "field", "feature") if c in frame.columns]
            rows = frame.orderBy(*order).collect() if order else frame.collect()
            sections[name] = [{k: _plain(v) for k, v in r.asDict().items()} for r in rows]
        pairs = duplicate_pairs(canonical).orderBy("commodity", "date").limit(20).collect()
        sections["duplicate_examples"] = [{k: _plain(v) for k, v in r.asDict().items()} for r in pairs]
        return Diagnosis(status, failures, warnings, sections)
    finally:
        for frame in rules.values():
            frame.unpersist()
        canonical.unpersist()
        training.unpersist()
