"""Model training on encoded tables, split by calendar year."""

from __future__ import annotations

from pyspark.sql import DataFrame

from urbanflow import schema as S
from urbanflow.operators import models as M
from urbanflow.operators import search as R
from urbanflow.operators.projection import feature_names, split_by_year
from urbanflow.session import materialize


def model_table(
    encoded: DataFrame, target: str = S.VOLUME, date: str = S.DATE, years: dict[str, int] = S.SPLIT_YEARS,
    keys: list[str] = (), features: list[str] | None = None,
) -> DataFrame:
    """(split, keys, features, label) of an encoded table that still carries its date.

    It is written once: fits, trials and scores all read it again.
    """
    features = features or feature_names(encoded, target, [date, *keys])
    return materialize(M.assemble(split_by_year(encoded, date, years), features, target, ["split", *keys]))


def baseline_tree(table: DataFrame) -> DataFrame:
    """One row: the errors of the baseline tree on train, val and test."""
    splits = ["train", "val", "test"]
    found = M.errors_of_models(table, {0: R.tree_family(M.BASELINE_TREE)}, splits, R.SINGLE)[0]
    return table.sparkSession.createDataFrame([tuple(found.get(f"{s}_rmse") for s in splits)], "train_rmse double, val_rmse double, test_rmse double")


def tuned(table: DataFrame, family: R.Family, grid: dict[str, list], draws: int, scored: dict[str, list[str]] = R.SINGLE,
          metric: str = "val_rmse", parallelism: int = 1) -> tuple[DataFrame, DataFrame]:
    """(leaderboard, summary) of a random search and the refit of its winner."""
    points = R.param_sampler(table.sparkSession, grid, draws)
    trials = R.random_search(table, points, family, scored, parallelism)
    return R.trial_leaderboard(trials, metric), R.refit_best(table, trials, family, scored, metric)


def tuned_tree(table: DataFrame, grid: dict = R.TREE_GRID, draws: int = R.TREE_DRAWS) -> tuple[DataFrame, DataFrame]:
    return tuned(table, R.tree_family, grid, draws)


def tuned_forest(table: DataFrame, grid: dict = R.FOREST_GRID, draws: int = R.FOREST_DRAWS) -> tuple[DataFrame, DataFrame]:
    return tuned(table, R.forest_family, grid, draws)


def tuned_ensemble(table: DataFrame, grid: dict = R.ENSEMBLE_GRID, draws: int = R.ENSEMBLE_DRAWS) -> tuple[DataFrame, DataFrame]:
    return tuned(table, R.ensemble_family, grid, draws, R.MEMBERS, "val_rmse_ensemble")
