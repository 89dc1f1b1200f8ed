"""Exact quantiles of groups of any size: no group's values meet in one task.

Each rank of each group is known to lie in a range of values. A round deals the
values in a range into buckets of equal width, counts them in one aggregate that
is summed up before the shuffle, with each bucket's least and largest value, and
takes the bucket that holds the rank as the next range. A range of one value is
the answer. All groups and ranks move on in one round; a round's sums are at most
``BUCKETS`` rows for an open range. Widths alternate between the values' own scale
and a logarithmic one, so values over many orders of size need few rounds too;
since the least and the largest value always part, every range ends.

Buckets only order: ranks are found by counting, so results are exact whatever
rounding does to a bucket's bounds. Null and NaN are no values, infinite values
are an error. A null group is a group; one without a value has null quantiles.
Empty frames give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import forget, written

BUCKETS = 256
#: A range parts in every round; so many rounds mean a fault.
MAX_ROUNDS = 200


def _bucket(x: Column, low: Column, high: Column) -> Column:
    """0 for the least value to BUCKETS - 1 for the largest; halves, so that no width overflows."""
    width = high / 2 - low / 2
    # No width is left where a scale has one value for both ends; then all between them is one bucket.
    inner = F.least(F.floor(F.try_divide(x / 2 - low / 2, width) * BUCKETS), F.lit(BUCKETS - 1))
    return F.when(x <= low, 0).when(x >= high, BUCKETS - 1).otherwise(F.coalesce(inner, F.lit(0))).cast("int")


def _logarithmic(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def grouped_quantiles(frame: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """The columns ``by``, and for each name of ``shares`` the interpolated quantile of the group's values, as ``percentile`` gives it."""
    keys = [f"_g{k}" for k in range(len(by))]
    x = F.col(value).cast("double")
    rows = frame.select(*(F.col(c).alias(k) for c, k in zip(by, keys, strict=True)), F.when(~F.isnan(x), x).alias("_x"))
    values = rows.where("_x is not null")
    least = F.when(F.max(F.abs("_x")) == float("inf"), F.raise_error(F.lit("Quantiles of infinite values")).cast("double")).otherwise(F.min("_x"))
    groups = written(rows.groupBy(*keys).agg(F.count("_x").alias("_n"), least.alias("_low"), F.max("_x").alias("_high")), "groups")
    at = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in shares.items()}
    wanted = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(a), F.ceil(a)) for a in at.values()))))
    state = written(groups.where("_n > 0").select(*keys, "_low", "_high", F.lit(0).cast("long").alias("_below"), F.explode(wanted).alias("_rank")), "ranks")

    def renamed(right: DataFrame, *more: str) -> tuple[DataFrame, list[str]]:
        """The right side of a join, with other names for what both sides have."""
        both = [*keys, *more]
        return right.withColumnsRenamed({c: f"r{c}" for c in both}), both

    def same(columns: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"r{c}")) for c in columns])

    for k in range(MAX_ROUNDS):
        unknown = state.where("_low < _high")
        if unknown.isEmpty():
            break
        ranges = unknown.select(*keys, "_low", "_high").distinct()
        right, both = renamed(ranges)
        met = values.join(right, same(both) & F.col("_x").between(F.col("_low"), F.col("_high"))).select(*keys, "_low", "_high", "_x")
        scale = _logarithmic if k % 2 else lambda c: c
        inner = _bucket(scale(F.col("_x")), scale(F.col("_low")), scale(F.col("_high")))
        bucket = F.when(F.col("_x") <= F.col("_low"), 0).when(F.col("_x") >= F.col("_high"), BUCKETS - 1).otherwise(inner)
        counted = met.groupBy(*keys, "_low", "_high", bucket.alias("_b")).agg(F.count("*").alias("_c"), F.min("_x").alias("_a"), F.max("_x").alias("_z"))
        # At most BUCKETS rows a range.
        over = Window.partitionBy(*keys, "_low", "_high").orderBy("_b")
        placed = counted.withColumn("_before", F.sum("_c").over(over) - F.col("_c"))
        inside = (F.col("_rank") >= F.col("_below") + F.col("_before")) & (F.col("_rank") < F.col("_below") + F.col("_before") + F.col("_c"))
        right, both = renamed(placed, "_low", "_high")
        nearer = unknown.join(right, same(both) & inside)
        nearer = nearer.select(*keys, F.col("_a").alias("_low"), F.col("_z").alias("_high"), (F.col("_below") + F.col("_before")).alias("_below"), "_rank")
        after = written(state.where("_low = _high").unionByName(nearer), "ranks")
        forget(state)
        state = after
    else:
        raise RuntimeError(f"Quantiles were not found in {MAX_ROUNDS} rounds")
    found = state.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_low"))).alias("_values"))
    right, both = renamed(found)
    joined = groups.join(right, same(both), "left").select(*(F.col(k).alias(c) for k, c in zip(keys, by, strict=True)), "_n", "_values")
    out = []
    for name, a in at.items():
        low, high = (F.try_element_at("_values", f(a)) for f in (F.floor, F.ceil))
        share = a - F.floor(a)
        out.append(F.when(low == high, low).otherwise((1 - share) * low + share * high).alias(name))
    return joined.select(*by, *out)
