"""Exact quantiles of whole columns, without a shuffle of rows and without one task that holds them.

``percentile`` keeps every distinct value of its group in one task, which is
fine for a commodity (as many values as days) and not for a table. Here each
round is one aggregate over all rows that is summed up in the tasks: a sketch
(``percentile_approx``) says between which two values a rank lies, exact
counts say how many rows are below and between them, and once few enough lie
between them these values come to the driver. The sketch only narrows the
search; ranks are found by counting, so the result is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values between the bounds of a rank that may come to the driver, and the points and error of a sketch.
LIMIT, POINTS, ACCURACY = 100_000, 200, 10_000


@dataclass
class _Rank:
    """A rank (from 0) of a column, known to lie from ``low`` to ``high``."""

    column: str
    rank: int
    low: float
    high: float
    between: int
    value: float | None = None


def _sketch(x) -> Column:
    """Approximate values at ``POINTS`` even shares; the shares are one literal, for the sake of the plan's size."""
    return F.percentile_approx(x, F.expr("array(" + ", ".join(f"{k / POINTS}D" for k in range(POINTS + 1)) + ")"), F.lit(ACCURACY))


def _narrow(points: list[float], share: float) -> tuple[float, float]:
    """The values around a share of the rows, two points to each side."""
    at = share * POINTS
    return points[max(0, math.floor(at) - 2)], points[min(POINTS, math.ceil(at) + 2)]


def _round(frame: DataFrame, ranks: list[_Rank]) -> None:
    """One job: place each rank against its bounds, and find it or bring the bounds nearer."""
    wanted = []
    for k, r in enumerate(ranks):
        x = F.col(r.column).cast("double")
        inner = F.when((x > r.low) & (x < r.high), x)
        wanted += [F.count_if(x < r.low).alias(f"below{k}"), F.count_if(x == r.low).alias(f"low{k}"), F.count(inner).alias(f"in{k}")]
        wanted.append((F.collect_list(inner) if r.between <= LIMIT else _sketch(inner)).alias(f"values{k}"))
    row = frame.agg(*wanted).first()
    for k, r in enumerate(ranks):
        at = r.rank - row[f"below{k}"]
        if at < 0:
            # The sketch was too far off: everything below stays open.
            r.low, r.high, r.between = -math.inf, r.low, LIMIT + 1
        elif at < row[f"low{k}"]:
            r.value = r.low
        elif (at := at - row[f"low{k}"]) >= row[f"in{k}"]:
            # Equal to the upper bound, or above it if the sketch was off.
            r.low, r.high, r.between = r.high, math.inf, LIMIT + 1
        elif r.between <= LIMIT:
            r.value = sorted(row[f"values{k}"])[at]
        else:
            r.low, r.high = _narrow(row[f"values{k}"], at / row[f"in{k}"])
            r.between = row[f"in{k}"] * 6 // POINTS + 1


def exact_quantiles(frame: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Interpolated quantiles of each column, as ``percentile`` gives them; None where a column has no value."""
    if not wanted:
        return {}
    x = {c: F.col(c).cast("double") for c in wanted}
    first = frame.agg(*(e for k, c in enumerate(wanted) for e in (F.count(x[c]).alias(f"n{k}"), _sketch(x[c]).alias(f"values{k}")))).first()
    counts = {c: first[f"n{k}"] for k, c in enumerate(wanted)}
    ranks: dict[tuple[str, int], _Rank] = {}
    for k, (c, shares) in enumerate(wanted.items()):
        for p in shares if counts[c] else ():
            at = (counts[c] - 1) * p
            for rank in {math.floor(at), math.ceil(at)}:
                low, high = _narrow(first[f"values{k}"], rank / counts[c])
                ranks.setdefault((c, rank), _Rank(c, rank, low, high, counts[c] * 6 // POINTS + 1))
    while open_ranks := [r for r in ranks.values() if r.value is None]:
        _round(frame, open_ranks)

    def value(c: str, p: float) -> float | None:
        if not counts[c]:
            return None
        at = (counts[c] - 1) * p
        low, high = (ranks[c, f(at)].value for f in (math.floor, math.ceil))
        return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high

    return {c: [value(c, p) for p in shares] for c, shares in wanted.items()}
