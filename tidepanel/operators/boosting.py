"""Multinomial gradient boosting: softmax loss, one regression tree for each class and round.

Features are binned once. A round grows the trees of all classes together, level
by level, and a level is one job: rows carry the gradient and the node of each
class, and (class, node, feature, bin) sums of counts, gradients and hessians are
added up before the shuffle. Only these sums reach the driver, classes x nodes x
features x bins of them, whatever the number of rows; it picks the splits. Leaf
values come from the sums of the last level, so a round has as many jobs as its
trees have levels.

A row's state is its bins, label, and scores. New scores are a projection over
the last table; every few rounds the state is written to the shared folder, so
plans stay short and a lost executor costs a few rounds of projections at most.

The fitted trees become Spark's own tree ensembles, one for each class, so they
score in the JVM and are saved and loaded with the pipeline.

Rows without a label are left out; without any row there is nothing to learn,
which is an error. A class without rows keeps a prior next to zero. Ties between
splits go to the lower feature and then the lower threshold.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import forget, written

#: Thresholds of a feature, rounds between two written states, and a prior for classes without rows.
MAX_BINS, ROUNDS_A_TABLE, LEAST_PRIOR = 32, 6, 1e-7
#: Denominators of leaf values below this give a leaf of zero.
TINY = 1e-150


@dataclass(frozen=True)
class Options:
    """As usual for boosting: ``max_features`` is None (all), "sqrt", "log2" or a number of features to a split."""

    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    min_samples_leaf: int = 1
    subsample: float = 1.0
    max_features: str | int | None = None
    max_bins: int = MAX_BINS
    seed: int = 42

    def __post_init__(self):
        if self.rounds < 0 or self.max_depth < 1 or self.min_samples_leaf < 1 or not 0 < self.subsample <= 1 or self.max_bins < 2:
            raise ValueError(f"Boosting options out of range: {self}")

    def features_of(self, n: int) -> int:
        chosen = {None: n, "sqrt": int(math.sqrt(n)), "log2": int(math.log2(n))}.get(self.max_features, self.max_features)
        if not isinstance(chosen, int):
            raise ValueError(f"Unknown max_features: {self.max_features!r}")
        return max(1, min(n, chosen))


@dataclass
class Tree:
    """Nodes by heap number: the root is 1, the children of i are 2i and 2i + 1."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # node: feature, last bin that goes left
    sums: dict[int, tuple[float, float, float]] = field(default_factory=dict)  # node: rows, gradient, hessian
    gains: dict[int, float] = field(default_factory=dict)

    def leaves(self) -> list[int]:
        return [n for n in self.sums if n not in self.splits]

    def value(self, node: int, classes: int) -> float:
        _, g, h = self.sums[node]
        return (classes - 1) / classes * g / h if h > TINY else 0.0


def bin_edges(frame: DataFrame, features: Column, width: int, max_bins: int = MAX_BINS) -> list[list[float]]:
    """Ascending thresholds of each feature, one less than bins at most: x <= edge goes left.

    Between all neighbouring values where these are few enough, else at even
    shares of the rows. One aggregate with a bounded sketch for each feature.
    """
    shares = F.array(*(F.lit(k / max_bins) for k in range(max_bins + 1)))
    x = frame.select(features.alias("_x"))
    parts = []
    for k in range(width):
        parts += [F.percentile_approx(F.col("_x")[k], shares, F.lit(100 * max_bins)).alias(f"q{k}"), F.approx_count_distinct(F.col("_x")[k]).alias(f"n{k}")]
    row = x.agg(*parts).first()
    few = [k for k in range(width) if (row[f"n{k}"] or 0) <= max_bins]
    values: dict[int, list[float]] = {}
    if few:
        # Sets of about max_bins values; the estimate may be a little off, so their size is looked at again.
        sets = x.agg(*(F.collect_set(F.col("_x")[k]).alias(f"s{k}") for k in few)).first()
        values = {k: sorted(sets[f"s{k}"]) for k in few if len(sets[f"s{k}"]) <= max_bins}
    out = []
    for k in range(width):
        if k in values:
            v = values[k]
            out.append([a + (b - a) / 2 for a, b in zip(v, v[1:], strict=False)])
        else:
            q = sorted(set(row[f"q{k}"] or []))
            out.append(q[:-1][: max_bins - 1] if len(q) <= max_bins else q[1:-1])
    return out


def binned(features: Column, edges: list[list[float]]) -> Column:
    """The number of thresholds below each feature."""
    table = F.array(*(F.array(*map(F.lit, e)).cast("array<double>") for e in edges))
    return F.transform(features, lambda x, i: F.size(F.filter(table[i], lambda e: e < x)))


def _walk(tree: Tree, node: int, bins: Column, at: dict[int, Column], otherwise: Column) -> Column:
    """The column of the leaf that a row comes to; ``otherwise`` where ``at`` has none."""
    if node not in tree.splits:
        return at.get(node, otherwise)
    f, b = tree.splits[node]
    return F.when(bins[f] <= b, _walk(tree, 2 * node, bins, at, otherwise)).otherwise(_walk(tree, 2 * node + 1, bins, at, otherwise))


def chances(scores: list[Column]) -> list[Column]:
    """Softmax."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    raised = [F.exp(s - top) for s in scores]
    total = sum(raised[1:], raised[0])
    return [r / total for r in raised]


def histogram(state: DataFrame, trees: list[Tree], open_nodes: list[set[int]]) -> DataFrame:
    """k, node, feature, bin with n, g, h: the sums of one level, for all classes in one aggregate.

    ``state`` has bins (array), label (int) and scores (array).
    """
    classes = len(trees)
    p = chances([F.col("scores")[k] for k in range(classes)])
    rows = state.select("bins", "label", F.array(*p).alias("_p"))
    none = F.lit(None).cast("int")
    per_class = [
        F.struct(
            F.lit(k).alias("k"),
            _walk(trees[k], 1, F.col("bins"), {n: F.lit(n) for n in open_nodes[k]}, none).alias("node"),
            ((F.col("label") == k).cast("double") - F.col("_p")[k]).alias("g"),
            (F.col("_p")[k] * (1 - F.col("_p")[k])).alias("h"),
        )
        for k in range(classes)
        if open_nodes[k]
    ]
    dealt = rows.select("bins", F.inline(F.array(*per_class))).where("node is not null")
    long = dealt.select("k", "node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
    return long.groupBy("k", "node", "feature", "bin").agg(F.count("*").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_split(n: np.ndarray, g: np.ndarray, h: np.ndarray, features: list[int], least: int) -> tuple[float, int, int, tuple, tuple] | None:
    """gain, feature, bin and the sums of both sides of the split that lowers the squared error most; None if none does.

    The arrays are by feature and bin.
    """
    left_n, left_g, left_h = (np.cumsum(x, axis=1)[:, :-1] for x in (n, g, h))
    all_n, all_g, all_h = n[0].sum(), g[0].sum(), h[0].sum()
    right_n, right_g = all_n - left_n, all_g - left_g
    allowed = (left_n >= least) & (right_n >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, left_g**2 / left_n + right_g**2 / right_n - all_g**2 / all_n, -np.inf)
    mask = np.full(len(n), -np.inf)
    mask[features] = 0
    gain = gain + mask[:, None]
    if not gain.size or not gain.max() > 1e-12 * max(1.0, abs(all_g)):
        return None
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    left = (float(left_n[f, b]), float(left_g[f, b]), float(left_h[f, b]))
    return float(gain[f, b]), int(f), int(b), left, (float(all_n) - left[0], float(all_g) - left[1], float(all_h) - left[2])


def _grown(state: DataFrame, classes: int, width: int, bins: int, options: Options, rng: random.Random) -> list[Tree]:
    """The trees of one round."""
    trees = [Tree() for _ in range(classes)]
    open_nodes: list[set[int]] = [{1} for _ in range(classes)]
    for depth in range(options.max_depth):
        sums = np.zeros((3, classes, 2 << depth, width, bins))
        for r in histogram(state, trees, open_nodes).toLocalIterator():
            sums[:, r["k"], r["node"], r["feature"], r["bin"]] = r["n"], r["g"], r["h"]
        for k, tree in enumerate(trees):
            after: set[int] = set()
            for node in sorted(open_nodes[k]):
                n, g, h = sums[:, k, node]
                tree.sums.setdefault(node, (float(n[0].sum()), float(g[0].sum()), float(h[0].sum())))
                chosen = sorted(rng.sample(range(width), options.features_of(width)))
                if found := best_split(n, g, h, chosen, options.min_samples_leaf):
                    tree.gains[node], f, b, tree.sums[2 * node], tree.sums[2 * node + 1] = found
                    tree.splits[node] = (f, b)
                    after |= {2 * node, 2 * node + 1}
            open_nodes[k] = after
        if not any(open_nodes):
            break
    return trees


def _raised(scores: Column, trees: list[Tree], bins: Column, rate: float) -> Column:
    """The scores after a round."""
    steps = [_walk(t, 1, bins, {n: F.lit(rate * t.value(n, len(trees))) for n in t.leaves()}, F.lit(0.0)) for t in trees]
    return F.array(*(scores[k] + s for k, s in enumerate(steps)))


@dataclass
class Boosted:
    """A fitted model: starting scores of the classes, thresholds, and a list of trees for each round."""

    start: list[float]
    edges: list[list[float]]
    rounds: list[list[Tree]]
    learning_rate: float

    def stages(self, spark: SparkSession) -> list[Transformer]:
        """features to probability (array) and prediction: a tree ensemble for each class, and their softmax."""
        models = [self._ensemble(spark, k) for k in range(len(self.start))]
        raw = [f"({s!r}D + raw_{k})" for k, s in enumerate(self.start)]
        top = f"greatest({', '.join(raw)})" if len(raw) > 1 else raw[0]
        parts = [f"exp({r} - {top})" for r in raw]
        statement = f"SELECT *, array_position(probability, array_max(probability)) - 1.0D AS prediction FROM (SELECT *, transform(array({', '.join(parts)}), x -> x / ({' + '.join(parts)})) AS probability FROM __THIS__)"
        return [*models, SQLTransformer(statement=statement)]

    def _ensemble(self, spark: SparkSession, k: int) -> GBTRegressionModel:
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        of = jvm.org.apache.spark.ml.tree
        regression = jvm.org.apache.spark.ml.regression
        width, classes = len(self.edges), len(self.start)

        def stats(n: float):
            sums = gateway.new_array(jvm.double, 3)
            sums[0], sums[1], sums[2] = float(n), 0.0, 0.0
            return jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(sums, int(n))

        def node(tree: Tree, at: int):
            n = tree.sums.get(at, (0.0, 0.0, 0.0))[0]
            if at not in tree.splits:
                return of.LeafNode(float(tree.value(at, classes)) if at in tree.sums else 0.0, 0.0, stats(n))
            f, b = tree.splits[at]
            split = of.ContinuousSplit(f, float(self.edges[f][b]))
            return of.InternalNode(0.0, 0.0, float(tree.gains[at] / n) if n else 0.0, node(tree, 2 * at), node(tree, 2 * at + 1), split, stats(n))

        grown = [r[k] for r in self.rounds] or [Tree(sums={1: (0.0, 0.0, 0.0)})]
        trees = gateway.new_array(regression.DecisionTreeRegressionModel, len(grown))
        weights = gateway.new_array(jvm.double, len(grown))
        for i, t in enumerate(grown):
            trees[i] = regression.DecisionTreeRegressionModel(f"softmax_tree_{k}_{i}", node(t, 1), width)
            weights[i] = float(self.learning_rate)
        model = GBTRegressionModel(regression.GBTRegressionModel(f"softmax_boost_{k}", trees, weights, width))
        return model.setFeaturesCol("features").setPredictionCol(f"raw_{k}")


def fit_boosting(frame: DataFrame, classes: int, options: Options | None = None, features: str = "features", label: str = "label") -> Boosted:
    """Learn from a vector column and labels 0 to ``classes`` - 1."""
    options = options or Options()
    rows = frame.where(F.col(label).isNotNull()).select(vector_to_array(features).alias("_x"), F.col(label).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        raise ValueError("No labelled rows to learn from")
    start = [math.log(min(1 - LEAST_PRIOR, max(LEAST_PRIOR, counts.get(k, 0) / total))) for k in range(classes)]
    width = rows.select(F.size("_x")).first()[0]
    edges = bin_edges(rows, F.col("_x"), width, options.max_bins)
    bins = max(map(len, edges)) + 1
    first = F.array(*map(F.lit, start))
    state = written(rows.select(binned(F.col("_x"), edges).alias("bins"), "label", first.alias("scores"), F.monotonically_increasing_id().alias("row")), "boosting")
    table, rng, grown = state, random.Random(options.seed), []
    try:
        for k in range(options.rounds):
            share = F.pmod(F.xxhash64("row", F.lit(k), F.lit(options.seed)), F.lit(1 << 30)) < int(options.subsample * (1 << 30))
            trees = _grown(state if options.subsample == 1 else state.where(share), classes, width, bins, options, rng)
            grown.append(trees)
            state = state.withColumn("scores", _raised(F.col("scores"), trees, F.col("bins"), options.learning_rate))
            if (k + 1) % ROUNDS_A_TABLE == 0 and k + 1 < options.rounds:
                before, state = table, written(state, "boosting")
                table = state
                forget(before)
    finally:
        forget(table)
    return Boosted(start, edges, grown, options.learning_rate)
