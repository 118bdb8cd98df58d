"""The scheduled batch job re-expressed: raw stage -> feature stage -> grid -> run log.

Each hand-off is a Parquet table in the shared folder (S5, S6), so a stage
can be re-run alone and a lost executor only recomputes the current stage.
Run selection (A6) reads the run log back (S8) and loads the chosen model
(S10).
"""

from __future__ import annotations

import posixpath

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.operators.select import best_run
from tonality.operators.split import holdout_split, holdout_split_exact
from tonality.operators.train import LOGISTIC_GRID, train_logistic_grid
from tonality.plans.features import preprocess
from tonality.sources.runs import log_runs, search_runs
from tonality.sources.stages import (new_stage_root, read_features, read_raw, save_model, write_features,
                                     write_raw)
from tonality.sources.text_files import load_labelled_dirs

EXPERIMENT = "review-logistic-grid"


def build_features(spark: SparkSession, reviews: DataFrame, max_words: int = 10000,
                   max_len: int = 100, fit_on: str = "all", stage_root: str | None = None) -> tuple[DataFrame, str]:
    """S5 -> preprocess -> S6.  Returns the feature stage (read back) and its root."""
    root = stage_root or new_stage_root(spark)
    write_raw(reviews.select("doc_id", "value", "label"), root)
    feats, _ = preprocess(read_raw(spark, root), max_words=max_words, max_len=max_len, fit_on=fit_on)
    write_features(feats, root)
    return read_features(spark, root), root


def train_and_log(spark: SparkSession, features: DataFrame, experiment: str = EXPERIMENT,
                  grid=LOGISTIC_GRID, root: str | None = None, parallelism: int = 2,
                  test_size: float = 0.2, seed: int = 42, save_models: bool = True,
                  exact_share: bool = False, predictions_path: str | None = None) -> DataFrame:
    """M1 + M3 + S7: fits the grid on the hash-split train rows, logs one run per config,
    and returns the logged runs of ``experiment`` (S8).

    ``exact_share`` holds out exactly ``ceil(test_size * n)`` rows, for two or three passes over the keys."""
    split = (holdout_split_exact if exact_share else holdout_split)(features, "doc_id", test_size, seed)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    model_dir = posixpath.join(root, "artifacts", experiment) if (save_models and root) else None
    runs = train_logistic_grid(train, test, grid, parallelism, model_dir, predictions_path=predictions_path)
    root = log_runs(runs, experiment, root)
    return search_runs(spark, experiment, root)


def best_model(spark: SparkSession, experiment: str = EXPERIMENT, root: str | None = None):
    """A6 + S10: the best logged run and its model (or ``(None, None)``).

    Only the one selected row - a run id and a path - reaches the driver.
    """
    best = best_run(search_runs(spark, experiment, root), by=["experiment"]) \
        .join(search_runs(spark, experiment, root).select("run_id", "model_path"), "run_id")
    row = best.select("run_id", "model_path").first()
    if row is None or row.model_path is None:
        return None, None
    from pyspark.ml.classification import LogisticRegressionModel
    return row.run_id, PipelineModel(stages=[LogisticRegressionModel.load(row.model_path)])


def promote(spark: SparkSession, target: str, experiment: str = EXPERIMENT, root: str | None = None):
    """Saves the best run's model once more, at ``target`` (the copy that serving loads); its run id."""
    run_id, model = best_model(spark, experiment, root)
    if model is not None:
        save_model(model, target)
    return run_id


def train_from_text_dirs(spark: SparkSession, data_root: str, classes=None, experiment: str = EXPERIMENT,
                         root: str | None = None, max_words: int = 10000, max_len: int = 100,
                         grid=LOGISTIC_GRID, seed: int = 42):
    """The reference's training script as one Spark job chain.

    ``data_root/<class>/*.txt`` (default ``pos`` = 1, ``neg`` = 0) -> one row
    per line with its label (S1, S2, U1) -> raw and feature stages (S5, S6; the
    split hashes keys, so no shuffled order K1 is needed) -> the grid (M1, M3) -> run log (S7) -> best run
    and its model (A6, S10).  Returns ``(runs, best_run_id, best_model)``.
    """
    reviews = load_labelled_dirs(spark, data_root, classes).select("doc_id", "value", "label")
    feats, _ = build_features(spark, reviews, max_words, max_len)
    root = root or posixpath.join(new_stage_root(spark, "tracking"))
    runs = train_and_log(spark, feats, experiment, grid, root, seed=seed)
    run_id, model = best_model(spark, experiment, root)
    return runs, run_id, model
