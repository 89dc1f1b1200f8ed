"""The five bundles of an analysis: prepared rows, evaluation, label designs, tuning and explanations.

Each is a stage or a few in a store (``sources/stages.py``): a second run reads
them, and a change makes only what depends on it anew.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import STABLE_BAND, TARGET_CLASSES
from ..functions import exprs as E
from ..operators import analytics as A
from ..operators import features as P
from ..operators import models as M
from ..operators.importance import permutation_importance
from ..sources.stages import Kept, Stages

#: Bands of the label designs that are compared, in per cent to each side.
BANDS = (1.0, 2.0, 2.5)
#: Changes when what an eager stage calls gives other results.
VERSION = 1


def prepared_rows(training: DataFrame, target: str, band: float) -> DataFrame:
    """Model features, labels and the split of training-ready rows."""
    return P.time_split(P.attach_targets(P.base_features(training), band), target)


def label_designs(prepared: DataFrame, value: str, bands: list[float]) -> DataFrame:
    """scheme, split and per cent of each class for bands of each width."""
    names = {f"band_{b:g}".replace(".", "_"): b for b in bands}
    return A.label_scheme_summary(prepared.withColumns({n: E.label_training(value, b) for n, b in names.items()}), {n: n for n in names})


def fitted(prepared: DataFrame, target: str, kind: str, params: dict, version: int) -> PipelineModel:
    return M.fit(prepared.where("split = 'train'"), target, kind, **params)


def evaluated(prepared: DataFrame, model: PipelineModel, target: str, split: str, version: int) -> dict:
    return M.evaluation_bundle(model, prepared.where(F.col("split") == split), target).to_dict()


def tuned(prepared: DataFrame, target: str, kind: str, grid: dict, draws: int, folds: int, version: int) -> list[dict]:
    return M.random_search(prepared.where("split = 'train'"), target, kind, grid, draws, folds)


def explained(prepared: DataFrame, model: PipelineModel, target: str, split: str, repeats: int, version: int) -> dict:
    """Permutation importances, and the model's own: coefficients or those of its trees."""
    own = M.tree_importances(model) if any(hasattr(s, "featureImportances") for s in model.stages) else M.coefficients(model)
    return {"permutation": permutation_importance(model, prepared.where(F.col("split") == split), target, repeats=repeats), "model": own}


def prepared_stages(stages: Stages, source: Kept, training, target: str, band: float) -> dict[str, Kept]:
    out = {"training": stages.table("training", training, source)}
    return out | {"prepared": stages.table("prepared", prepared_rows, out["training"], target=target, band=band)}


def analysis_bundles(stages: Stages, source: Kept, training, horizon: int = 7, band: float = STABLE_BAND, kind: str = "boosting", params: dict | None = None, grid: dict | None = None, draws: int = 15, folds: int = 4, repeats: int = 10) -> dict[str, Kept]:
    """training, prepared, relabeling, model, evaluation, explainability, and with a grid tuning.

    ``training(frame of the source)`` gives training-ready rows, lazily. Only
    the evaluation and what explains it depend on the model; only tuning
    depends on the grid.
    """
    target, value = TARGET_CLASSES[horizon], f"target_{horizon}d_inflation_pct"
    out = prepared_stages(stages, source, training, target, band)
    rows = out["prepared"]
    out["relabeling"] = stages.table("relabeling", label_designs, rows, value=value, bands=list(BANDS))
    model = out["model"] = stages.model("model", fitted, rows, target=target, kind=kind, params=params or {}, version=VERSION)
    out["evaluation"] = stages.values("evaluation", evaluated, rows, model, target=target, split="valid", version=VERSION)
    out["explainability"] = stages.values("explainability", explained, rows, model, target=target, split="valid", repeats=repeats, version=VERSION)
    if grid is not None:
        out["tuning"] = stages.values("tuning", tuned, rows, target=target, kind=kind, grid=grid, draws=draws, folds=folds, version=VERSION)
    return out
