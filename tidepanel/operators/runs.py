"""Runs of equal values and gaps between days in histories of any length.

A history is cut into chunks of days, so one key is many tasks. A chunk is told
by a few numbers: its first and last run, its longest one, its first and last
day. Only these are brought together by key, and runs and gaps that cross a
bound are put together there. A chunk holds ``chunk_days`` rows at
most where a key has one row a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as C

CHUNK_DAYS = 1024


def _chunk(day: Column, chunk_days: int) -> Column:
    if chunk_days < 1:
        raise ValueError("A chunk has one day at least")
    return F.floor(day / chunk_days)


def longest_runs(frame: DataFrame, key: str, value: Column, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """``key``, ``n_values`` (rows with a value) and ``longest`` (rows of the longest run of one value) of each key.

    Rows go by date. Rows of one date, and rows without a date (which come last,
    as a chunk of their own), stand in the order of their values, missing ones
    last. A missing value is a run of one row. A null key is a key; an empty frame
    has no rows.
    """
    own = frame.select(F.col(key).alias("_key"), "date", _chunk(C.day(), chunk_days).alias("_chunk"), value.alias("_x"))
    inside = Window.partitionBy("_key", "_chunk").orderBy(F.asc_nulls_last("date"), F.asc_nulls_last("_x"))
    begins = ~F.coalesce(F.col("_x") == F.lag("_x").over(inside), F.lit(False))
    islands = own.withColumn("_begins", begins).withColumn("_run", F.sum(F.col("_begins").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("_key", "_chunk", "_run").agg(F.count("*").alias("_n"), F.first("_x").alias("_x"), F.count("_x").alias("_values"))
    edge = F.struct("_x", "_n")
    chunks = runs.groupBy("_key", "_chunk").agg(F.min_by(edge, "_run").alias("_first"), F.max_by(edge, "_run").alias("_last"), F.max("_n").alias("_longest"), F.sum("_values").alias("_values"), F.count("*").alias("_runs"))
    # The last run is told apart from the first only where a chunk has two.
    side = lambda k, name, more: F.struct(F.lit(k).alias("_side"), F.col(f"{name}._x").alias("_x"), F.col(f"{name}._n").alias("_n"), *more)
    whole = [F.col("_longest"), F.col("_values")]
    none = [F.lit(0).cast("bigint").alias("_longest"), F.lit(0).cast("bigint").alias("_values")]
    sides = F.when(F.col("_runs") > 1, F.array(side(0, "_first", whole), side(1, "_last", none))).otherwise(F.array(side(0, "_first", whole)))
    edges = chunks.select("_key", "_chunk", F.explode(sides).alias("e")).select("_key", "_chunk", "e.*")
    order = Window.partitionBy("_key").orderBy(F.asc_nulls_last("_chunk"), "_side")
    goes_on = (F.col("_side") == 0) & F.coalesce(F.col("_x") == F.lag("_x").over(order), F.lit(False))
    linked = edges.withColumn("_begins", ~goes_on).withColumn("_run", F.sum(F.col("_begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    across = linked.groupBy("_key", "_run").agg(F.sum("_n").alias("_n"), F.max("_longest").alias("_longest"), F.sum("_values").alias("_values"))
    return across.groupBy(F.col("_key").alias(key)).agg(F.sum("_values").alias("n_values"), F.max(F.greatest("_n", "_longest")).alias("longest"))


def day_gaps(frame: DataFrame, key: str, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """``key``, ``gap``, ``n``, ``first_day``, ``last_day``: the distinct days of a key by the days since the one before.

    A key may have several rows of one gap. Their ``n`` sum up to its days, and
    the gap is null for its first day alone. Different gaps are few: k of them
    span k (k + 1) / 2 days at least. Rows without a date count for nothing.
    """
    days = frame.where(F.col("date").isNotNull()).select(F.col(key).alias("_key"), C.day().alias("_d")).distinct().withColumn("_chunk", _chunk(F.col("_d"), chunk_days))
    inside = days.withColumn("_gap", F.col("_d") - F.lag("_d").over(Window.partitionBy("_key", "_chunk").orderBy("_d")))
    counted = inside.groupBy("_key", "_chunk", "_gap").agg(F.count("*").alias("n"), F.min("_d").alias("first_day"), F.max("_d").alias("last_day"))
    # A chunk's first day has no gap yet: it follows the last day of the chunks before.
    before = F.max("last_day").over(Window.partitionBy("_key").orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1))
    gap = F.coalesce(F.col("_gap"), F.col("first_day") - before)
    return counted.select(F.col("_key").alias(key), gap.alias("gap"), "n", "first_day", "last_day")
