"""Named queries of preprocessing, scoring and evaluation, and the same in DuckDB SQL.

Scores come from a pipeline with fixed coefficients, so that SQL can say them:
the service, its contract and everything after the model's probabilities run
as they do with a learned model.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..config import BINARY_FEATURES, CLASSES, INPUT_CONTRACT, MODEL_FEATURES, NUMERIC_FEATURES, REQUIRED_COLUMNS, STABLE_BAND, TARGET_VALUES
from ..operators import analytics as A
from ..operators import diagnostics as D
from ..operators import features as P
from ..operators import importance as I
from ..operators import models as M
from ..operators.boosting import Boosted, Tree, binned, histogram
from ..operators.checks import bad_price_rows as bad_prices
from ..operators.positions import join_by_position
from ..operators.service import InferenceService, training_summary
from ..sources.panels import panel_of_orders, table, with_gaps
from ..sources.shared import shared_folder
from ..sources.stages import Stages
from .bundles import BANDS, label_designs, prepared_stages
from .queries import SQL, _ANGLES, _FOLDS, _TARGETS, ERRORS, LABELLED, PANEL, READY, REGIME, SPLIT, WINDOWS, _label, labelled, on_ready, panel, query, ready, rounded, scored, sql

#: Logits of a model with fixed coefficients; missing values count as zero.
_LOGITS = {
    "Deflation": "-0.05 * coalesce(price_change_7d_pct, 0) + 0.01 * coalesce(volatility_30d_pct, 0)",
    "Inflation": "0.05 * coalesce(price_change_7d_pct, 0) - 0.02 * coalesce(momentum_gap_7_30_pct, 0)",
    "Stable": "0.25 - 0.01 * coalesce(price_vs_ma30_pct, 0)",
}
_TOP = "greatest(" + ", ".join(_LOGITS.values()) + ")"
_EXP = {k: f"exp({x} - {_TOP})" for k, x in _LOGITS.items()}
_SUM = "(" + " + ".join(_EXP.values()) + ")"


def fixed_model() -> PipelineModel:
    """A pipeline as ``fit`` makes it, but with known coefficients."""
    chances = ", ".join(f"{_EXP[k]} / {_SUM}" for k in M.LABELS)
    statement = f"SELECT *, array({chances}) AS probability, 0.0D AS prediction FROM __THIS__"
    return PipelineModel(stages=[SQLTransformer(statement=statement), M.label_stage()])


def fixed_service(spark) -> InferenceService:
    metadata = {"horizon": 7, "input_contract": INPUT_CONTRACT, "class_names": M.LABELS, "engineered_feature_columns": MODEL_FEATURES, "model_version": "fixed"}
    return InferenceService(spark, "", 7, fixed_model(), metadata)


_CYCLES = ", ".join(f"{f}(2 * pi() * {a}) AS {n}_{f}" for n, a in _ANGLES.items() for f in ("sin", "cos"))
_FEATURES = f"""features AS (SELECT *, {_CYCLES}, (price_idr - rolling_mean_30d) / (rolling_std_30d + 1e-6) AS price_zscore_30d,
  (rolling_mean_7d / (rolling_mean_30d + 1e-6) - 1) * 100 AS ma_gap_7_30_pct, (price_lag_1d / (price_lag_7d + 1e-6) - 1) * 100 AS lag_gap_1_7_pct,
  (price_lag_7d / (price_lag_30d + 1e-6) - 1) * 100 AS lag_gap_7_30_pct, price_change_7d_pct - price_change_30d_pct AS momentum_gap_7_30_pct,
  volatility_30d_pct * price_change_7d_pct AS volatility_x_momentum FROM labelled)"""
_SCORES = f"""chances AS (SELECT *, {', '.join(f'{_EXP[k]} / {_SUM} AS p_{k.lower()}' for k in CLASSES)} FROM features),
  scores AS (SELECT *, greatest(p_deflation, p_stable, p_inflation) AS confidence, CASE greatest(p_deflation, p_stable, p_inflation) WHEN p_deflation THEN 'Deflation' WHEN p_stable THEN 'Stable' ELSE 'Inflation' END AS prediction FROM chances)"""


def _on_scores(select: str, *more: str) -> str:
    return sql(select, PANEL, WINDOWS, READY, LABELLED, _FEATURES, _SCORES, *more)


_CHANCES = ", ".join(f"round(p_{k.lower()}, 6) AS {k.lower()}" for k in CLASSES)


@query(_on_scores(f"SELECT date, commodity, price_idr, prediction, {_CHANCES}, round(confidence, 6) AS confidence, CAST(7 AS INTEGER) AS horizon, 'fixed' AS model_version FROM scores"))
def service_scores(spark, sf):
    """The inference service over the panel: contract, features, probabilities, the best class."""
    frame = ready(spark, sf).select(*REQUIRED_COLUMNS)
    out = fixed_service(spark).score(frame)
    return rounded(out.select("date", "commodity", "price_idr", "prediction", "probabilities.*", "confidence", "horizon", "model_version"))


@query(_on_scores(f"SELECT commodity, date, CAST(7 AS INTEGER) AS horizon, prediction, round(confidence, 6) AS confidence, {_CHANCES} FROM scores"))
def prediction_context(spark, sf):
    """Predictions beside chosen columns; a column that the frame lacks is left out, as are columns too many."""
    return rounded(fixed_service(spark).predict_with_context(ready(spark, sf), ["commodity", "date", "not there"]))


_FIXED_ERRORS = """errors AS (SELECT *, target_7d_class AS true_class, prediction AS pred_class, CAST(target_7d_class = prediction AS INTEGER) AS is_correct,
  1 - CAST(target_7d_class = prediction AS INTEGER) AS is_error FROM scores)"""


def _fixed_errors(spark, sf):
    return M.error_frame(fixed_model(), P.base_features(labelled(spark, sf)), "target_7d_class")


@query(_on_scores("SELECT date, commodity, true_class, pred_class, is_correct, is_error, round(confidence, 6) AS confidence, round(price_zscore_30d, 4) AS price_zscore_30d FROM errors", _FIXED_ERRORS))
def model_error_frame(spark, sf):
    out = _fixed_errors(spark, sf).select("date", "commodity", "true_class", "pred_class", "is_correct", "is_error", "confidence", F.round("price_zscore_30d", 4).alias("price_zscore_30d"))
    return out.withColumn("confidence", F.round("confidence", 6))


@query(_on_scores("SELECT pred_class, true_class, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM errors GROUP BY 1, 2", _FIXED_ERRORS))
def predicted_distribution(spark, sf):
    """How often each class is predicted for each true one, and how sure."""
    found = _fixed_errors(spark, sf)
    return rounded(found.groupBy("pred_class", "true_class").agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence")))


def _metrics_sql(source: str) -> str:
    """accuracy, macro_f1 and weighted_f1 of each fold of a source with fold, true_class and pred_class."""
    return f"""per AS (SELECT fold, label, count(*) FILTER (WHERE true_class = label AND pred_class = label) AS tp, count(*) FILTER (WHERE pred_class = label) AS pp,
  count(*) FILTER (WHERE true_class = label) AS ap, count(*) AS total FROM {source}, (VALUES {', '.join(f"('{c}')" for c in CLASSES)}) k(label) GROUP BY 1, 2),
  metrics AS (SELECT fold, CAST(sum(tp) AS DOUBLE) / max(total) AS accuracy, avg(coalesce(2.0 * tp / nullif(pp + ap, 0), 0)) AS macro_f1, sum(coalesce(2.0 * tp / nullif(pp + ap, 0), 0) * ap) / max(total) AS weighted_f1 FROM per GROUP BY 1)"""


@query(_on_scores("SELECT round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1 FROM metrics", _FIXED_ERRORS, _metrics_sql("(SELECT 0 AS fold, * FROM errors)")))
def model_metrics(spark, sf):
    found = M.evaluate(fixed_model(), P.base_features(labelled(spark, sf)), "target_7d_class")
    return rounded(spark.createDataFrame([(found["accuracy"], found["macro_f1"], found["weighted_f1"])], "accuracy double, macro_f1 double, weighted_f1 double"))


_TESTED = """folded AS (SELECT date, commodity, CASE WHEN i < head THEN 0 ELSE (i - head) // size + 1 END AS fold FROM sized),
  tested AS (SELECT fold, true_class, pred_class FROM errors JOIN folded USING (date, commodity) WHERE fold > 0)"""


@query(
    sql(
        "SELECT " + ", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std" for m in ("accuracy", "macro_f1", "weighted_f1")) + " FROM metrics",
        PANEL, WINDOWS, READY, LABELLED, REGIME, ERRORS, _FOLDS, _TESTED, _metrics_sql("tested"),
    )
)
def cv_summary(spark, sf):
    """Mean and deviation over expanding folds of the scores of the trailing change's label."""
    folds = M.expanding_folds(ready(spark, sf).select("date", "commodity"), 5)
    tested = scored(spark, sf).join(folds.where("fold > 0"), ["date", "commodity"])
    rows = [M.report_metrics(A.classification_report(tested.where(F.col("fold") == k))) for k in range(1, 6)]
    summary = M.cv_summary(rows)
    return rounded(spark.createDataFrame([tuple(summary.values())], ", ".join(f"{k} double" for k in summary)))


_TRAIN = "train AS (SELECT features.* FROM features JOIN cuts ON date <= a)"
_KINDS = BINARY_FEATURES + NUMERIC_FEATURES


def _filled(c: str) -> str:
    """A feature with its training mode or median where it is missing."""
    return f"CAST(coalesce({c}, (SELECT {'mode' if c in BINARY_FEATURES else 'median'}({c}) FROM train)) AS DOUBLE)"


_FILLED = f"filled AS (SELECT date, commodity, date <= a AS is_train, {', '.join(f'{_filled(c)} AS {c}' for c in _KINDS)} FROM features, cuts)"
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_HOT = ", ".join(f"CAST(commodity = '{p}' AS DOUBLE) AS is_{p[0]}" for p in _PRIORITIES)


def _prepared(spark, sf, scale: bool, digits: int):
    split = P.time_split(P.attach_targets(P.base_features(ready(spark, sf))))
    model = Pipeline(stages=M.preprocessing(split.where("split = 'train'"), scale=scale)).fit(split.where("split = 'train'"))
    v = vector_to_array("features")
    names = [*(f"is_{p[0]}" for p in _PRIORITIES), *_KINDS]
    return model.transform(split).select(F.col("date").alias("day"), F.col("commodity").alias("name"), *(F.round(v[i], digits).alias(n) for i, n in enumerate(names)))


@query(sql(f"SELECT date AS day, commodity AS name, {_HOT}, {', '.join(f'round({c}, 6) AS {c}' for c in _KINDS)} FROM filled", PANEL, WINDOWS, READY, LABELLED, SPLIT, _FEATURES, _TRAIN, _FILLED))
def preprocessed_tree(spark, sf):
    """The features of the tree models: imputed by the train rows' medians and modes, commodities one-hot."""
    return _prepared(spark, sf, False, 6)


_SCALED = ", ".join(f"round(({c} - (SELECT avg({c}) FROM filled WHERE is_train)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM filled WHERE is_train), 3) AS {c}" for c in NUMERIC_FEATURES)


@query(sql(f"SELECT date AS day, commodity AS name, {_HOT}, {', '.join(BINARY_FEATURES)}, {_SCALED} FROM filled", PANEL, WINDOWS, READY, LABELLED, SPLIT, _FEATURES, _TRAIN, _FILLED))
def preprocessed_linear(spark, sf):
    """As for trees, with numbers standardized by the train rows."""
    return _prepared(spark, sf, True, 3)


@query(sql("SELECT target_7d_class AS label, count(*) AS n, (SELECT min(date) FROM split WHERE split = 'train') AS start_date, (SELECT max(date) FROM split WHERE split = 'train') AS end_date FROM split WHERE split = 'train' GROUP BY 1", PANEL, WINDOWS, READY, LABELLED, SPLIT))
def train_class_counts(spark, sf):
    return training_summary(P.time_split(labelled(spark, sf)).where("split = 'train'"), "target_7d_class")


_TOTALS = ["strict_feature_usable_rows", "model_feature_usable_rows", *(f"trainable_rows_{h}d" for h in TARGET_VALUES)]


@query(on_ready("SELECT " + ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}_total" for c in _TOTALS) + f" FROM ({_TARGETS})"))
def usable_row_totals(spark, sf):
    return D.usable_totals(D.target_coverage(ready(spark, sf)))


@query(sql(f"SELECT date, commodity, {_label('target_7d_inflation_pct')} AS true_class, {', '.join(f'round({c}, 4) AS {c}' for c in ('price_zscore_30d', 'volatility_x_momentum'))} FROM features WHERE price_lag_30d IS NOT NULL", PANEL, WINDOWS, READY, LABELLED, _FEATURES))
def base_feature_rows(spark, sf):
    """Row-local features of each row that has a 30-day lag, with its label."""
    rows = P.base_features(labelled(spark, sf)).where("price_lag_30d is not null")
    return rows.select("date", "commodity", F.col("target_7d_class").alias("true_class"), F.round("price_zscore_30d", 4).alias("price_zscore_30d"), F.round("volatility_x_momentum", 4).alias("volatility_x_momentum"))


# --- boosting ---------------------------------------------------------------------

#: Features and thresholds of the fixed trees, and the trees themselves: node to (feature, threshold's number), and rows, gradient, hessian of nodes.
_TREE_FEATURES = ["price_change_7d_pct", "volatility_30d_pct", "momentum_gap_7_30_pct"]
_TREE_EDGES = [[-20.0, 0.0, 15.5], [10.0, 25.0], [-5.0, 5.0]]
_START = [-1.25, -0.75, -0.5]
_RATE = 0.1


def _fixed_trees() -> list[list[Tree]]:
    """Two rounds; the sums of the leaves are whole numbers."""
    first = [
        Tree({1: (0, 1), 2: (1, 0)}, {1: (90, 0, 20), 2: (60, 0, 13), 3: (30, -9, 7), 4: (25, 6, 5), 5: (35, 3, 8)}, {1: 2.0, 2: 1.0}),
        Tree({1: (2, 0)}, {1: (90, 0, 20), 2: (40, 8, 11), 3: (50, -8, 9)}, {1: 1.5}),
        Tree({}, {1: (90, 4, 16)}, {}),
    ]
    second = [
        Tree({1: (1, 1)}, {1: (90, 0, 20), 2: (70, -2, 12), 3: (20, 2, 8)}, {1: 0.5}),
        Tree({1: (0, 2), 3: (2, 1)}, {1: (90, 0, 20), 2: (55, 5, 9), 3: (35, -5, 9), 6: (15, -7, 4), 7: (20, 2, 5)}, {1: 1.0, 3: 0.25}),
        Tree({1: (0, 0)}, {1: (90, 0, 20), 2: (10, 1, 2), 3: (80, -1, 18)}, {1: 0.125}),
    ]
    return [first, second]


def _tree_sql(tree: Tree, node: int = 1) -> str:
    if node not in tree.splits:
        _, g, h = tree.sums[node]
        return f"({_RATE} * 2 / 3 * {g} / {h})"
    f, b = tree.splits[node]
    return f"CASE WHEN coalesce({_TREE_FEATURES[f]}, 0) <= {_TREE_EDGES[f][b]} THEN {_tree_sql(tree, 2 * node)} ELSE {_tree_sql(tree, 2 * node + 1)} END"


_BOOSTED = [f"({s} + {' + '.join(_tree_sql(r[k]) for r in _fixed_trees())})" for k, s in enumerate(_START)]
_BOOSTED_SQL = "raised AS (SELECT date, commodity, " + ", ".join(f"CAST({x} AS DOUBLE) AS s{k}" for k, x in enumerate(_BOOSTED)) + " FROM features), summed AS (SELECT *, exp(s0) + exp(s1) + exp(s2) AS total FROM raised)"


def _vectors(frame):
    assembler = VectorAssembler(inputCols=[f"_{c}" for c in _TREE_FEATURES], outputCol="features")
    return assembler.transform(frame.withColumns({f"_{c}": F.coalesce(F.col(c), F.lit(0.0)) for c in _TREE_FEATURES}))


@query(sql(f"SELECT date, commodity, {', '.join(f'round(exp(s{k}) / total, 6) AS p_{c.lower()}' for k, c in enumerate(M.LABELS))}, CASE greatest(s0, s1, s2) WHEN s0 THEN 0 WHEN s1 THEN 1 ELSE 2 END AS pred_index FROM summed", PANEL, WINDOWS, READY, LABELLED, _FEATURES, _BOOSTED_SQL))
def boosting_scores(spark, sf):
    """Multinomial boosting with known trees over the panel: ensembles, softmax, the best class."""
    model = PipelineModel(stages=Boosted(_START, _TREE_EDGES, _fixed_trees(), _RATE).stages(spark))
    out = model.transform(_vectors(P.base_features(labelled(spark, sf))))
    chances = [F.round(F.col("probability")[k], 6).alias(f"p_{c.lower()}") for k, c in enumerate(M.LABELS)]
    return out.select("date", "commodity", *chances, F.col("prediction").cast("int").alias("pred_index"))


_BIN = " UNION ALL ".join(
    f"SELECT label, {f} AS feature, CAST({' + '.join(f'CAST(coalesce({c}, 0) > {e} AS INTEGER)' for e in _TREE_EDGES[f])} AS INTEGER) AS bin FROM train" for f, c in enumerate(_TREE_FEATURES)
)
_FIRST_LEVEL = f"""train AS (SELECT features.*, list_position({M.LABELS!r}, target_7d_class) - 1 AS label FROM features JOIN cuts ON date <= a),
  priors AS (SELECT k, (SELECT avg(CAST(label = k AS INTEGER)) FROM train) AS p FROM range({len(M.LABELS)}) r(k)), binned AS ({_BIN})"""


@query(sql("SELECT CAST(k AS INTEGER) AS k, feature, bin, count(*) AS n, round(sum(CAST(label = k AS INTEGER) - p), 6) AS g, round(sum(p * (1 - p)), 6) AS h FROM binned, priors GROUP BY 1, 2, 3", PANEL, WINDOWS, READY, LABELLED, SPLIT, _FEATURES, _FIRST_LEVEL))
def boosting_first_sums(spark, sf):
    """Counts, gradients and hessians by class, feature and bin with which boosting begins, over the train rows."""
    split = P.time_split(P.base_features(labelled(spark, sf)))
    train = M.with_label_index(_vectors(split.where("split = 'train'")), "target_7d_class")
    shares = train.agg(*(F.avg((F.col("label") == k).cast("int")).alias(str(k)) for k in range(len(M.LABELS))))
    priors = shares.select(F.array(*(F.log(F.col(str(k))) for k in range(len(M.LABELS)))).alias("scores"))
    state = train.select(binned(vector_to_array("features"), _TREE_EDGES).alias("bins"), F.col("label").cast("int").alias("label")).crossJoin(F.broadcast(priors))
    sums = histogram(state, [Tree() for _ in M.LABELS], [{1} for _ in M.LABELS])
    return rounded(sums.drop("node"))


# --- permutation importance ----------------------------------------------------------

_DEALT = ["price_change_7d_pct", "volatility_30d_pct", "year"]
_REPEATS = 3


def _network_sql() -> str:
    """One pass of the network over x, by columns that use those before them."""
    steps = ["x // m AS a0", "x % m AS b0"]
    for i in range(1, I.ROUNDS + 1):
        k = f"((rep * {I.KEY_STEP} + {i * I.ROUND_STEP + I.FIRST}) % {I.PRIME})"
        steps += [f"(b{i - 1} * {I.MULTIPLY} + {k}) % {I.PRIME} AS t{i}", f"b{i - 1} AS a{i}", f"(a{i - 1} + (t{i} * t{i} + {k}) % {I.PRIME} % m) % m AS b{i}"]
    return f"SELECT rep, position, m, n, a{I.ROUNDS} * m + b{I.ROUNDS} AS x FROM (SELECT *, {', '.join(steps)} FROM {{source}})"


_DEALING = f"""numbered AS (SELECT *, row_number() OVER (ORDER BY date, commodity) - 1 AS position FROM features),
  size AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS m FROM numbered),
  starts AS (SELECT r.rep, position, position AS x, m, n FROM numbered, size, range({_REPEATS}) r(rep)),
  walked AS ({_network_sql().format(source='starts')} UNION ALL {_network_sql().format(source='(SELECT * FROM walked WHERE x >= n)')}),
  donors AS (SELECT rep, walked.position, numbered.* EXCLUDE (position) FROM walked JOIN numbered ON numbered.position = x WHERE x < n)"""
_WHOLE = ["price_change_7d_pct", "volatility_30d_pct", "momentum_gap_7_30_pct", "price_vs_ma30_pct", "year"]


def _variant(c: str | None) -> str:
    columns = ", ".join(f"{'d' if x == c else 'o'}.{x}" for x in _WHOLE)
    return f"SELECT rep, {'NULL' if c is None else repr(c)} AS feature, o.target_7d_class AS true_class, {columns} FROM numbered o JOIN donors d ON d.position = o.position"


_VARIANTS = "variants AS (" + " UNION ALL ".join(map(_variant, [None, *_DEALT])) + ")"
_VARIANT_SCORES = _SCORES.replace("FROM features", "FROM variants") + ", verdicts AS (SELECT {'rep': rep, 'feature': feature} AS fold, true_class, prediction AS pred_class FROM scores)"


@query(sql("SELECT fold.feature AS feature, CAST(fold.rep AS INTEGER) AS repeat, round(macro_f1, 6) AS macro_f1 FROM metrics", PANEL, WINDOWS, READY, LABELLED, _FEATURES, _DEALING, _VARIANTS, _VARIANT_SCORES, _metrics_sql("verdicts")).replace("WITH ", "WITH RECURSIVE ", 1))
def permutation_scores(spark, sf):
    """Macro F1 of a model with known coefficients when a column's values are dealt anew, for each repeat."""
    return rounded(I.permutation_scores(fixed_model(), P.base_features(labelled(spark, sf)), "target_7d_class", _DEALT, _REPEATS))


# --- positions -------------------------------------------------------------------------


@query("SELECT position, date, commodity, price_idr FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_orderpriority AS commodity, CASE WHEN o_orderkey % 83 = 0 THEN 'n/a' END AS price_idr FROM orders) WHERE price_idr IS NOT NULL ORDER BY position LIMIT 10")
def bad_price_rows(spark, sf):
    """Row numbers of the first ten prices that are no numbers."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(F.to_date("o_orderdate").cast("string").alias("date"), F.col("o_orderpriority").alias("commodity"), F.when(k % 83 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price_idr"), "o_orderkey")
    return bad_prices(rows, "o_orderkey").drop("o_orderkey")


@query(
    sql(
        "SELECT position, l.date, l.commodity, r.date AS other_date, r.price_idr AS other_price FROM (SELECT row_number() OVER (ORDER BY date, commodity) - 1 AS position, * FROM panel) l "
        "FULL JOIN (SELECT row_number() OVER (ORDER BY commodity, date) - 1 AS position, * FROM panel WHERE price_idr IS NOT NULL) r USING (position)",
        PANEL,
    )
)
def position_join(spark, sf):
    """Two frames side by side, row by row: the panel in model order and its known prices in panel order."""
    rows = panel(spark, sf)
    other = rows.where("price_idr is not null").select(F.col("date").alias("other_date"), F.col("commodity").alias("other_name"), F.col("price_idr").alias("other_price"))
    return join_by_position(rows.select("date", "commodity"), other, ["date", "commodity"], ["other_name", "other_date"]).drop("other_name")


# --- kept stages ------------------------------------------------------------------------


def training_of_orders(orders):
    return P.training_ready(with_gaps(panel_of_orders(orders)), check=False)


def _kept_stages(spark, sf):
    """Stages over orders in the shared folder; a second query reads what a first one made of the same files."""
    stages = Stages(spark, shared_folder(spark) + "/stages")
    return stages, prepared_stages(stages, stages.source(f"{sf}/orders.parquet"), training_of_orders, "target_7d_class", STABLE_BAND)


@query(sql("SELECT date, commodity, split, target_7d_class, target_30d_class, round(price_zscore_30d, 4) AS price_zscore_30d FROM features JOIN (SELECT date, commodity, split FROM split) USING (date, commodity)", PANEL, WINDOWS, READY, LABELLED, SPLIT, _FEATURES))
def prepared_bundle(spark, sf):
    _, kept = _kept_stages(spark, sf)
    return kept["prepared"].value.select("date", "commodity", "split", "target_7d_class", "target_30d_class", F.round("price_zscore_30d", 4).alias("price_zscore_30d"))


@query(SQL["label_scheme_summary"])
def relabeling_bundle(spark, sf):
    stages, kept = _kept_stages(spark, sf)
    return rounded(stages.table("relabeling", label_designs, kept["prepared"], value="target_30d_inflation_pct", bands=list(BANDS)).value)
