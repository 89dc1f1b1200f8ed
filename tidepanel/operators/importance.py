"""Permutation importance in one join and one aggregate.

Rows get dense positions. A repeat deals every column by a keyed bijection of the
positions, so one join by position brings each row the values that all its
columns are dealt; the join serves all repeats. Each row is then scored once for
each column and repeat, with that column's dealt value, and one aggregate counts
true and predicted classes. No rows are sorted for a repeat, and nothing depends
on how rows lie in partitions.

The bijection is a Feistel network on m x m numbers with m^2 >= n, walked until
the result is below n. It is plain arithmetic of whole numbers.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLASSES, MODEL_FEATURES
from .positions import with_positions

#: Fixed values of the network: rounds, a prime below 2^31, multipliers.
ROUNDS, PRIME, MULTIPLY, KEY_STEP, ROUND_STEP, FIRST = 4, 2_147_483_647, 1_103_515_245, 1_000_003, 7_919, 12_345
MAX_WALK = 40


def side(n: int) -> int:
    """The least m with m * m >= n."""
    m = math.isqrt(n)
    return m if m * m >= n else m + 1


def _let(x: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def dealt_position(position: Column, n: int, key: Column) -> Column:
    """Where the row at ``position`` (0 to n - 1) takes its value from: a bijection for each key from 0 on."""
    m = F.lit(max(1, side(n))).cast("long")
    key = key.cast("long")

    def mixed(r: Column, i: Column) -> Column:
        k = (key * KEY_STEP + i * ROUND_STEP + FIRST) % PRIME
        return _let((r * MULTIPLY + k) % PRIME, lambda t: (t * t + k) % PRIME % m)

    def network(x: Column) -> Column:
        start = F.struct(F.call_function("div", x, m).alias("a"), (x % m).alias("b"))
        rounds = F.sequence(F.lit(1).cast("long"), F.lit(ROUNDS).cast("long"))
        return F.aggregate(rounds, start, lambda s, i: F.struct(s["b"].alias("a"), ((s["a"] + mixed(s["b"], i)) % m).alias("b")), lambda s: s["a"] * m + s["b"])

    walk = F.sequence(F.lit(1), F.lit(min(2 * side(n) + 1, MAX_WALK)))
    found = F.aggregate(walk, network(position.cast("long")), lambda x, _: F.when(x < n, x).otherwise(network(x)))
    return _let(found, lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("A position was not dealt")).cast("long")))


def macro_f1(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and macro_f1 of counts (keys, true_class, pred_class, n), over all classes."""
    n = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    scores = []
    for c in CLASSES:
        t, p = F.col("true_class") == c, F.col("pred_class") == c
        scores.append(F.coalesce(2 * n(t & p) / F.nullif(n(t) + n(p), F.lit(0)), F.lit(0.0)))
    return counts.groupBy(*keys).agg((sum(scores[1:], scores[0]) / len(CLASSES)).alias("macro_f1"))


def permutation_scores(model: PipelineModel, frame: DataFrame, target: str, columns: list[str] | None = None, repeats: int = 10, seed: int = 0) -> DataFrame:
    """feature, repeat, macro_f1: scores with that feature dealt anew; of the frame as it is where feature is null.

    Rows without the target are left out. Rows count in the order of date and
    commodity.
    """
    from .models import predict

    columns = list(columns or MODEL_FEATURES)
    carried = list(dict.fromkeys(["date", "commodity", *MODEL_FEATURES, target]))
    placed = with_positions(frame.where(F.col(target).isNotNull()).select(*carried), "date", "commodity")
    n = placed.count()
    dealt = placed.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("_from", dealt_position(F.col("position"), n, F.col("repeat") + seed))
    donors = placed.select(F.col("position").alias("_from"), F.struct(*columns).alias("_dealt"))
    joined = dealt.join(donors.hint("merge"), "_from")
    own = [F.lit(None).cast("string").alias("feature"), *(F.col(c) for c in carried)]
    variants = [F.struct(*own)] + [F.struct(F.lit(c).alias("feature"), *(F.col("_dealt")[x].alias(x) if x == c else F.col(x) for x in carried)) for c in columns]
    scored = predict(model, joined.select("repeat", F.inline(F.array(*variants))))
    counts = scored.groupBy("repeat", "feature", F.col(target).alias("true_class"), "pred_class").agg(F.count("*").alias("n"))
    return macro_f1(counts, ["feature", "repeat"]).select("feature", "repeat", "macro_f1")


def permutation_importance(model: PipelineModel, frame: DataFrame, target: str, columns: list[str] | None = None, repeats: int = 10, seed: int = 0) -> list[dict]:
    """Mean and deviation over the repeats of the macro F1 that is lost when a column is dealt anew, most first."""
    scores = permutation_scores(model, frame, target, columns, repeats, seed)
    by: dict[str | None, list[float]] = {}
    for r in scores.orderBy("repeat").collect():
        by.setdefault(r["feature"], []).append(r["macro_f1"])
    base = by.pop(None, [0.0])[0]
    out = []
    for c, found in by.items():
        mean = sum(base - x for x in found) / len(found)
        out.append({"feature": c, "importance_mean": mean, "importance_std": (sum((base - x - mean) ** 2 for x in found) / len(found)) ** 0.5})
    return sorted(out, key=lambda r: (-r["importance_mean"], r["feature"]))
