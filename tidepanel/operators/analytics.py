"""Exploratory and error-analysis aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BINARY_FEATURES, CATEGORICAL_FEATURES, CLASSES, TARGET_VALUES, TIME_COLUMNS
from ..functions import exprs as E
from ..sources.shared import forget, written
from .grouped import grouped_quantiles
from .quantiles import exact_quantiles


def numeric_columns(frame: DataFrame) -> list[str]:
    return [c for c, t in frame.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]


def _long(frame: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """One row for each column with its measures, from one global aggregate."""
    names = [f"_{m}_{i}" for i in range(len(columns)) for m in measures]
    values = [f(c) for c in columns for f in measures.values()]
    wide = frame.agg(*(v.alias(n) for v, n in zip(values, names, strict=True)))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"_{m}_{i}").alias(m) for m in measures)) for i, c in enumerate(columns)))
    return wide.select(F.explode(rows).alias("x")).select("x.*")


def missing_summary(frame: DataFrame) -> DataFrame:
    return _long(frame, frame.columns, {"missing_count": lambda c: F.count_if(F.col(c).isNull()), "missing_pct": lambda c: E.share(F.col(c).isNull()) * 100})


def describe(frame: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles (exact), max of each numeric column.

    The quartiles are computed at once (see ``quantiles``), the rest is one lazy aggregate.
    """
    columns = columns or numeric_columns(frame)
    d = lambda c: F.col(c).cast("double")
    found = exact_quantiles(frame, {c: [0.25, 0.5, 0.75] for c in columns})
    q = lambda k: lambda c: F.lit(found[c][k]).cast("double")
    return _long(frame, columns, {"count": F.count, "mean": lambda c: F.avg(d(c)), "std": lambda c: F.stddev_samp(d(c)), "min": lambda c: F.min(d(c)), "p25": q(0), "p50": q(1), "p75": q(2), "max": lambda c: F.max(d(c))})


def correlation_matrix(frame: DataFrame, columns: list[str]) -> DataFrame:
    """column_a, column_b, correlation over rows where both are present; every pair once. An empty frame has no rows.

    Each row becomes one for every column, with that column's value and those of
    the half of the columns that follow it in a circle. So an aggregate has a
    few correlations, small enough for generated code, where one for all pairs
    is too large; a task sends a row a column to the shuffle.
    """
    n = len(columns)
    steps = range(1, n // 2 + 1)
    values = F.array(*(F.col(c).cast("double") for c in columns)).alias("v")
    turned = frame.select(values).select("v", F.explode(F.array(*map(F.lit, range(n)))).alias("at"))
    # Spark's corr skips a row where either is missing.
    y = [F.col("v")[(F.col("at") + k) % n].alias(f"y{k}") for k in range(n // 2 + 1)]
    own = turned.select("at", *y).groupBy("at").agg(*(F.corr("y0", f"y{k}").alias(f"c{k}") for k in steps))
    pairs = F.array(*(F.struct(((F.col("at") + k) % n).alias("with"), F.col(f"c{k}").alias("correlation"), F.lit(k).alias("step")) for k in steps))
    found = own.select("at", F.explode(pairs).alias("p")).select("at", "p.*")
    # Half a circle away, both ends have the pair.
    once = found.where((F.col("step") * 2 < n) | (F.col("at") < F.col("with")))
    names = F.array(*map(F.lit, columns))
    return once.select(names[F.least("at", "with")].alias("column_a"), names[F.greatest("at", "with")].alias("column_b"), "correlation")


def variable_groups(frame: DataFrame) -> dict[str, list[str]]:
    """Columns by role, in the frame's order; what has no other role is a numeric feature."""
    roles = {"categorical": CATEGORICAL_FEATURES, "flag": BINARY_FEATURES, "time": TIME_COLUMNS, "target": list(TARGET_VALUES.values())}
    role = {c: r for r, columns in roles.items() for c in columns}
    out: dict[str, list[str]] = {r: [] for r in (*roles, "numeric")}
    for c in frame.columns:
        out[role.get(c, "numeric")].append(c)
    return out


def monthly_means(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.groupBy(E.month_bucket().alias("month"), "commodity").agg(*(F.avg(c).alias(f"mean_{c}") for c in columns))


def class_share(frame: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Share of each class in per cent, within the groups of ``by`` (or overall)."""
    keys = by or []
    counts = frame.groupBy(*keys, F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    return counts.select(*keys, "label", "n", (F.col("n") / total * 100).alias("share_pct"))


def volatility_summary(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.groupBy("commodity").agg(*(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_samp))))


def label_scheme_summary(frame: DataFrame, schemes: dict[str, str]) -> DataFrame:
    """scheme, split and the per cent of each class, for label columns by scheme name."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("scheme"), F.col(c).alias("label")) for n, c in schemes.items())))
    long = frame.select("split", pairs.alias("x")).select("split", "x.*")
    return long.groupBy("scheme", "split").agg(*((E.share(F.col("label") == k) * 100).alias(f"{k.lower()}_pct") for k in CLASSES))


def stable_share_pivot(frame: DataFrame, label: str, by: str = "commodity") -> DataFrame:
    splits = ["train", "valid", "test"]
    return frame.groupBy(by).agg(*((F.avg(F.when(F.col("split") == s, (F.col(label) == "Stable").cast("double"))) * 100).alias(s) for s in splits))


# --- error analysis: frames with true_class, pred_class, confidence ----------


def error_frame(frame: DataFrame, true: Column, pred: Column, confidence: Column) -> DataFrame:
    out = frame.withColumns({"true_class": true, "pred_class": pred, "confidence": confidence})
    correct = (F.col("true_class") == F.col("pred_class")).cast("int")
    return out.withColumns({"is_correct": correct, "is_error": 1 - correct})


def error_summary(errors: DataFrame, by: list[Column | str], extra: dict[str, Column] | None = None) -> DataFrame:
    return errors.groupBy(*by).agg(F.count("*").alias("n"), F.avg("is_correct").alias("accuracy"), F.avg("is_error").alias("error_rate"), F.avg("confidence").alias("mean_confidence"), *(c.alias(n) for n, c in (extra or {}).items()))


def errors_by_regime(errors: DataFrame) -> DataFrame:
    text = F.when(F.col("high_vol_regime") == 1, "High volatility").otherwise("Normal volatility")
    return error_summary(errors.withColumn("regime", text), ["regime"])


def monthly_errors(errors: DataFrame, months: int = 12) -> DataFrame:
    return error_summary(errors, [E.month_bucket().alias("month")]).orderBy(F.desc("month")).limit(months)


def error_matrix(errors: DataFrame) -> DataFrame:
    """Error rate of each commodity by true class, a column for each class."""
    return errors.groupBy("commodity").agg(*(F.avg(F.when(F.col("true_class") == c, F.col("is_error"))).alias(c.lower()) for c in CLASSES))


def top_confident_errors(errors: DataFrame, columns: list[str], k: int = 15) -> DataFrame:
    return errors.where("is_error = 1").orderBy(F.desc("confidence"), "commodity", "date").select(*columns).limit(k)


def class_share_by_month(errors: DataFrame) -> DataFrame:
    """month, kind (actual, predicted), label, share of the month."""
    month = errors.select(E.month_bucket().alias("month"), F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("label")) for k, c in (("actual", "true_class"), ("predicted", "pred_class"))))).alias("x"))
    counts = month.groupBy("month", "x.kind", "x.label").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("month", "kind")))


def confusion_matrix(errors: DataFrame) -> DataFrame:
    """A row for each true class with a column for each predicted one."""
    return errors.groupBy("true_class").agg(*(F.count_if(F.col("pred_class") == c).alias(c.lower()) for c in CLASSES))


def classification_report(errors: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support: the classes, then accuracy, macro and weighted means.

    All rows come from one small aggregate of true and predicted classes.
    """
    wide = errors.agg(*(e for c in CLASSES for e in (F.count_if((F.col("true_class") == c) & (F.col("pred_class") == c)).alias(f"tp_{c}"), F.count_if(F.col("pred_class") == c).alias(f"pp_{c}"), F.count_if(F.col("true_class") == c).alias(f"ap_{c}"))), F.count("*").alias("total"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    p = {c: zero(F.col(f"tp_{c}"), F.col(f"pp_{c}")) for c in CLASSES}
    r = {c: zero(F.col(f"tp_{c}"), F.col(f"ap_{c}")) for c in CLASSES}
    f = {c: zero(2 * F.col(f"tp_{c}").cast("double"), (F.col(f"pp_{c}") + F.col(f"ap_{c}")).cast("double")) for c in CLASSES}
    total = F.col("total")
    mean = lambda m: sum((m[c] for c in CLASSES[1:]), m[CLASSES[0]]) / len(CLASSES)
    weighted = lambda m: zero(sum((m[c] * F.col(f"ap_{c}") for c in CLASSES[1:]), m[CLASSES[0]] * F.col(f"ap_{CLASSES[0]}")), total)
    accuracy = zero(sum((F.col(f"tp_{c}") for c in CLASSES[1:]), F.col(f"tp_{CLASSES[0]}")), total)
    row = lambda name, a, b, c, n: F.struct(F.lit(name).alias("label"), a.alias("precision"), b.alias("recall"), c.alias("f1"), n.alias("support"))
    rows = [row(c, p[c], r[c], f[c], F.col(f"ap_{c}")) for c in CLASSES]
    rows += [row("accuracy", accuracy, accuracy, accuracy, total), row("macro avg", mean(p), mean(r), mean(f), total), row("weighted avg", weighted(p), weighted(r), weighted(f), total)]
    return wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def histogram(frame: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """bin (from 0), low, high, n over the value's range; the largest value is in the last bin."""
    v = frame.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    ends = v.agg(F.min("v").alias("a"), F.max("v").alias("b"))
    at = F.when(F.col("b") > F.col("a"), F.least(F.floor((F.col("v") - F.col("a")) / ((F.col("b") - F.col("a")) / bins)), F.lit(bins - 1))).otherwise(0).cast("int")
    step = (F.col("b") - F.col("a")) / bins
    counted = v.crossJoin(F.broadcast(ends)).groupBy(at.alias("bin"), "a", "b").agg(F.count("*").alias("n"))
    return counted.select("bin", (F.col("a") + F.col("bin") * step).alias("low"), (F.col("a") + (F.col("bin") + 1) * step).alias("high"), "n")


def box_stats(frame: DataFrame, value: str, by: str) -> DataFrame:
    """Least, largest and exact quartiles of each group, however large a group is; null where it has no value.

    The two columns are written once, as several counts read them; infinite values are an error.
    """
    v = f"{value}_" if value.lower() == by.lower() else value
    own = written(frame.select(by, F.col(value).cast("double").alias(v)), "boxes")
    found = written(grouped_quantiles(own, [by], v, {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}), "box-stats")
    forget(own)
    return found
