"""Many multinomial logistic models fitted in the passes of one.

Models are stacked: a pass over the rows evaluates loss and gradient of every
model that is not done, with one matrix product a batch and group, and one
aggregate adds the sums of all tasks. Each model has its own quasi-Newton search
on the driver, which asks for one point at a time; what a search asks for next
is part of the next pass. So the passes of a whole search are those of its
slowest model, and what moves is models x classes x features numbers a task.

Rows belong to groups (a fold's training rows, say), and each model learns from
one group. The loss is that of the usual penalized likelihood: the mean of the
weighted log losses plus |w|^2 / (2 C n), intercepts not penalized.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A search ends where no part of the gradient exceeds this.
TOLERANCE = 1e-6
MEMORY = 10


@dataclass(frozen=True)
class Problem:
    """A model to fit: the group of its rows, inverse penalty, class weights (None or "balanced"), steps at most."""

    group: int
    C: float = 1.0
    class_weight: str | None = None
    max_iter: int = 200


@dataclass
class Fitted:
    """Coefficients (classes x features) and intercepts of each problem, and the passes over the rows."""

    weights: list[np.ndarray]
    intercepts: list[np.ndarray]
    passes: int


def _search(x: np.ndarray, steps: int) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Limited-memory quasi-Newton steps with halving; yields points, takes (loss, gradient), returns the last point."""
    loss, slope = yield x
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(slope).max() <= TOLERANCE:
            break
        way, shares = -slope, []
        for s, y in reversed(past):
            share = (s @ way) / (s @ y)
            shares.append(share)
            way = way - share * y
        if past:
            s, y = past[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), share in zip(past, reversed(shares), strict=True):
            way = way + s * (share - (y @ way) / (s @ y))
        down = way @ slope
        if down >= 0:
            way, down, past = -slope, -(slope @ slope), []
        size = 1.0 if past else min(1.0, 1 / np.abs(slope).sum())
        while True:
            there, steep = yield x + size * way
            if there <= loss + 1e-4 * size * down:
                break
            size /= 2
            if size < 1e-10:
                return x
        s, y = size * way, steep - slope
        if s @ y > 1e-12:
            past = [*past[1 - MEMORY :], (s, y)]
        x, loss, slope = x + s, there, steep
    return x


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """group, features and labels of each group's rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        for g in np.unique(groups).tolist():
            mine = groups == g
            yield g, x[mine], labels[mine]


def _log_chances(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    z = x @ w.T + b
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _pass(rows: DataFrame, points: dict[int, np.ndarray], problems: list[Problem], balance: dict[int, np.ndarray], classes: int, width: int) -> dict[int, np.ndarray]:
    """Summed loss and gradients (unpenalized) of each point, in one job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for g, x, y in _batches(batches, width):
            for m, point in points.items():
                if problems[m].group != g:
                    continue
                w, b = point[: classes * width].reshape(classes, width), point[classes * width :]
                log_p = _log_chances(x, w, b)
                weight = balance[m][y]
                at = np.arange(len(y))
                rest = np.exp(log_p) * weight[:, None]
                rest[at, y] -= weight
                found = np.concatenate(([-(log_p[at, y] * weight).sum()], (rest.T @ x).ravel(), rest.sum(axis=0)))
                sums[m] = sums[m] + found if m in sums else found
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], names=["model", "sums"])

    out = rows.mapInArrow(run, "model int, sums array<double>").select("model", array_to_vector("sums").alias("v"))
    return {r["model"]: r["s"].toArray() for r in out.groupBy("model").agg(Summarizer.sum(F.col("v")).alias("s")).collect()}


def fit_many(rows: DataFrame, problems: list[Problem], classes: int) -> Fitted:
    """Fit all problems on rows of group (int), label (int from 0) and features (array of doubles)."""
    rows = rows.select(F.col("group").cast("int").alias("group"), F.col("label").cast("int").alias("label"), "features")
    counts = np.zeros((max((p.group for p in problems), default=0) + 1, classes))
    for r in rows.groupBy("group", "label").agg(F.count("*").alias("n")).collect():
        if r["group"] < len(counts):
            counts[r["group"], r["label"]] = r["n"]
    first = rows.select(F.size("features")).first()
    if first is None or any(not counts[p.group].sum() for p in problems):
        raise ValueError("A group without rows cannot be learned from")
    width, balance = first[0], {}
    for m, p in enumerate(problems):
        if p.class_weight not in (None, "balanced") or p.C <= 0:
            raise ValueError(f"Unknown option: {p}")
        n = counts[p.group]
        balance[m] = np.ones(classes) if p.class_weight is None else np.where(n > 0, n.sum() / (np.count_nonzero(n) * np.maximum(n, 1)), 0.0)
    total = {m: counts[p.group].sum() for m, p in enumerate(problems)}
    searches = {m: _search(np.zeros(classes * (width + 1)), p.max_iter) for m, p in enumerate(problems)}
    points = {m: next(s) for m, s in searches.items()}
    done: dict[int, np.ndarray] = {}
    passes = 0
    while points:
        found = _pass(rows, points, problems, balance, classes, width)
        passes += 1
        for m, point in list(points.items()):
            n, penalty = total[m], np.concatenate((point[: classes * width], np.zeros(classes))) / (problems[m].C * total[m])
            try:
                points[m] = searches[m].send((found[m][0] / n + point @ penalty / 2, found[m][1:] / n + penalty))
            except StopIteration as end:
                done[m] = end.value
                del points[m]
    return Fitted([done[m][: classes * width].reshape(classes, width) for m in range(len(problems))], [done[m][classes * width :] for m in range(len(problems))], passes)


def confusions(rows: DataFrame, problems: list[Problem], fitted: Fitted, classes: int) -> np.ndarray:
    """Counts by problem, true and predicted class over the rows of each problem's group, in one pass."""
    width = fitted.weights[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(problems), classes, classes), np.int64)
        for g, x, y in _batches(batches, width):
            for m, p in enumerate(problems):
                if p.group == g:
                    np.add.at(sums[m], (y, _log_chances(x, fitted.weights[m], fitted.intercepts[m]).argmax(axis=1)), 1)
        m, t, p = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(t), pa.array(p), pa.array(sums[m, t, p])], names=["m", "t", "p", "n"])

    rows = rows.select(F.col("group").cast("int").alias("group"), F.col("label").cast("int").alias("label"), "features")
    out = np.zeros((len(problems), classes, classes), np.int64)
    for r in rows.mapInArrow(run, "m long, t long, p long, n long").groupBy("m", "t", "p").agg(F.sum("n").alias("n")).collect():
        out[r["m"], r["t"], r["p"]] = r["n"]
    return out
