"""Tune, evaluate and store a model from a model frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.functions.fixed_values import TEST_CUTOFF, TREES
from matchlab.operators import model as M
from matchlab.operators.frame import PREDICTORS
from matchlab.operators.metrics import forecast_metrics
from matchlab.operators.resample import time_split
from matchlab.session import cut
from matchlab.sources.tables import log_experiment

MODEL_PATH, WORKFLOW_PATH, LOG_PATH = "model", "workflow", "experiments_log"


@dataclass
class Trained:
    metrics: DataFrame
    predictions: DataFrame
    params: dict
    model: PipelineModel
    test_metrics: DataFrame
    importance: DataFrame


def train(
    model_frame: DataFrame,
    cutoff: str = TEST_CUTOFF,
    grid: DataFrame | None = None,
    trees: int = TREES,
    out: str | None = None,
    feature_set: str = "all differentials",
    predictors: Sequence[str] = PREDICTORS,
    **tune_args,
) -> Trained:
    """Rolling-origin grid search before the cutoff, final fit, scores from the cutoff on.

    With ``out`` the fitted model, the unfitted workflow and a line in the experiment log are written.
    """
    spark = model_frame.sparkSession
    data = cut(model_frame)
    past, test = time_split(data, F.lit(cutoff).cast("date"))
    grid = M.param_table(spark) if grid is None else grid
    metrics, predictions = M.tune(past, grid, predictors, trees=trees, **tune_args)
    metrics = cut(metrics)
    params = M.best_params(metrics, grid)
    pipeline = M.build_pipeline(predictors, params=params, trees=trees)
    fitted = M.fit(pipeline, past, predictors)
    if out:
        M.save_model(fitted, f"{out}/{MODEL_PATH}")
        M.save_model(pipeline, f"{out}/{WORKFLOW_PATH}")
        log_experiment(
            spark,
            f"{out}/{LOG_PATH}",
            algorithm="gbt",
            feature_set=feature_set,
            resample_scheme=f"{tune_args.get('folds', M.FOLDS)} cv folds",
            logloss=M.show_best(metrics).first()["mean"],
        )
    return Trained(
        metrics, predictions, params, fitted, forecast_metrics(M.score(fitted, test)), M.importance(fitted, data)
    )
