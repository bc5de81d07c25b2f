"""Random search over parameter grids, the trial table and the final refit."""

from __future__ import annotations

from collections.abc import Callable
from math import prod

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.operators import models as M
from urbanflow.operators.combine import train_val_union
from urbanflow.operators.positions import row_numbers
from urbanflow.operators.trees import Growth

# The grids and the number of draws.
TREE_GRID = {
    "max_depth": [5, 10, 15, 20, None],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 4, 8],
    "max_features": ["sqrt", "log2", None, 0.8],
}
FOREST_GRID = {
    "n_estimators": [200, 300, 400, 500, 600],
    "max_depth": [None, 10, 15, 20, 30],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 4, 8],
    "max_features": ["sqrt", "log2", 0.8],
}
ENSEMBLE_GRID = {
    "rf_n_estimators": [200, 300, 400, 500, 600],
    "rf_max_depth": [10, 12, 15, None],
    "rf_min_samples_split": [2, 5, 10],
    "rf_min_samples_leaf": [1, 2, 4],
    "rf_max_features": ["sqrt", "log2", 0.8],
    "xgb_n_estimators": [300, 400, 500, 600],
    "xgb_learning_rate": [0.05, 0.1, 0.2],
    "xgb_max_depth": [6, 8, 10],
    "xgb_subsample": [0.8, 0.9, 1.0],
    "xgb_colsample_bytree": [0.8, 0.9, 1.0],
    "xgb_reg_lambda": [0.8, 1.0, 1.5],
}
TREE_DRAWS, FOREST_DRAWS, ENSEMBLE_DRAWS = 15, 20, 15


def _point_type(values: list) -> str:
    kinds = {type(v) for v in values if v is not None}
    return "string" if str in kinds else ("double" if float in kinds else "int")


def param_sampler(spark: SparkSession, grid: dict[str, list], n: int, seed: int = M.SEED) -> DataFrame:
    """`n` distinct points of the grid as (trial_id, one typed column per parameter).

    A point is its number in mixed radix, so the grid is a range, not a product of tables; the points with the
    smallest hashes of (number, seed) are drawn. A grid with no more than `n` points is returned whole.
    """
    total = prod(len(v) for v in grid.values())
    drawn = spark.range(total).orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n).collect()
    rows = []
    for trial, row in enumerate(drawn):
        rest, point = row["id"], []
        for values in grid.values():
            rest, digit = divmod(rest, len(values))
            point.append(values[digit])
        rows.append((trial, *[_typed(v, grid[name]) for name, v in zip(grid, point)]))
    kinds = [f"{name} {_point_type(values)}" for name, values in grid.items()]
    return spark.createDataFrame(rows, ", ".join(["trial_id int", *kinds]))


def _typed(value: object, values: list) -> object:
    if value is None:
        return None
    kind = _point_type(values)
    return str(value) if kind == "string" else (float(value) if kind == "double" else int(value))


def trial_leaderboard(trials: DataFrame, metric: str = "val_rmse", tie: str = "trial_id") -> DataFrame:
    """All trials with their rank from 0, best first; equal errors are ranked by the tie column. No task ranks them all."""
    return row_numbers(trials, [F.col(metric).asc_nulls_last(), F.col(tie)], "rank").orderBy("rank")


def best_trial(trials: DataFrame, metric: str = "val_rmse", tie: str = "trial_id") -> DataFrame:
    """The trial with the smallest error, the lowest tie value among equals (a top-1, not a sort)."""
    return trials.orderBy(F.col(metric).asc_nulls_last(), F.col(tie)).limit(1)


# A family turns one parameter record into the members of a model, by name.
Family = Callable[[dict], dict[str, Growth]]


def tree_family(params: dict) -> dict[str, Growth]:
    return {"prediction": M.decision_tree(params)}


def forest_family(params: dict) -> dict[str, Growth]:
    return {"prediction": M.random_forest(params)}


def ensemble_family(params: dict) -> dict[str, Growth]:
    """Forest and boosting side by side; parameters carry the prefixes rf_ and xgb_."""
    rf = {k.removeprefix("rf_"): v for k, v in params.items() if k.startswith("rf_")}
    xgb = {k.removeprefix("xgb_"): v for k, v in params.items() if k.startswith("xgb_")}
    return {"pred_rf": M.random_forest(rf), "pred_xgb": M.boosted_trees(xgb)}


# The errors of a trial, each with the members whose mean it judges; the last one is that of the whole model.
SINGLE = {"rmse": ["prediction"]}
MEMBERS = {"rmse_rf": ["pred_rf"], "rmse_xgb": ["pred_xgb"], "rmse_ensemble": ["pred_rf", "pred_xgb"]}


def random_search(
    table: DataFrame, points: DataFrame, family: Family, scored: dict[str, list[str]] = SINGLE, parallelism: int = 1,
    folder: str | None = None, at_once: int | None = None,
) -> DataFrame:
    """One row per trial: its parameters and the errors on the train and val splits.

    `table` is assembled and has a `split` column; pass a written table (`materialize`). `at_once` trials are grown in one
    job, all by default. With a `folder`, finished trials are appended to a table there and a search that was ended goes
    on with the others; points that differ from those written under their trial number are an error.
    """
    spark = table.sparkSession
    records = [row.asDict() for row in points.orderBy("trial_id").collect()]
    names = [f"{s}_{name}" for s in ("train", "val") for name in scored]
    kinds = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields] + [f"{n} double" for n in names])
    data, done = train_val_union(table), {}
    if folder:
        for row in _finished(spark, folder, kinds):
            done[row["trial_id"]] = row
        for record in records:
            row = done.get(record["trial_id"])
            if row and any(row[k] != v for k, v in record.items()):
                raise ValueError(f"{folder} holds another trial {record['trial_id']}")
    rest = [r for r in records if r["trial_id"] not in done]
    rows = [tuple(done[r["trial_id"]].values()) for r in records if r["trial_id"] in done]
    step = at_once or max(len(rest), 1)
    for i in range(0, len(rest), step):
        wave = rest[i : i + step]
        trials = {r["trial_id"]: family(_params(r)) for r in wave}
        errors = M.errors_of_models(data, trials, ["train", "val"], scored, parallelism)
        new = [(*r.values(), *[errors[r["trial_id"]].get(n) for n in names]) for r in wave]
        if folder:
            spark.createDataFrame(new, kinds).write.mode("append").parquet(folder)
        rows += new
    return spark.createDataFrame(sorted(rows, key=lambda r: r[0]), kinds)


def _params(record: dict) -> dict:
    return {k: _untyped(v) for k, v in record.items() if k != "trial_id"}


def _finished(spark: SparkSession, folder: str, kinds: str) -> list[dict]:
    try:
        return [r.asDict() for r in spark.read.schema(kinds).parquet(folder).collect()]
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _untyped(value: object) -> object:
    """Feature shares travel as text next to 'sqrt' and 'log2'."""
    if isinstance(value, str):
        try:
            return float(value)
        except ValueError:
            return value
    return value


def refit_best(
    table: DataFrame, trials: DataFrame, family: Family, scored: dict[str, list[str]] = SINGLE, metric: str = "val_rmse"
) -> DataFrame:
    """Summary of the best trial by validation error, refitted on train and val and scored on them and on test.

    One row: the parameters, `train_val_<metric>` and `test_<metric>` of the whole model. The test split selects nothing.
    """
    best = best_trial(trials, metric).first().asDict()
    errors = {f"{s}_{name}" for s in ("train", "val") for name in scored}
    record = {k: v for k, v in best.items() if k not in errors}
    renamed = table.withColumn("split", F.when(F.col("split") == "test", "test").otherwise("train_val"))
    name = list(scored)[-1]
    found = M.errors_of_models(renamed, {0: family(_params(record))}, ["train_val", "test"], {name: scored[name]})[0]
    outs = [f"train_val_{name}", f"test_{name}"]
    fields = [f for f in trials.schema.fields if f.name in record]
    kinds = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + [f"{o} double" for o in outs])
    row = (*[record[f.name] for f in fields], *[found.get(o) for o in outs])
    return table.sparkSession.createDataFrame([row], kinds)


def feature_set_comparison(
    tables: dict[str, DataFrame], points: DataFrame, family: Family, scored: dict[str, list[str]] = SINGLE, metric: str = "val_rmse"
) -> DataFrame:
    """The same search on several feature sets; one summary row per set."""
    summaries = None
    for name, table in tables.items():
        trials = random_search(table, points, family, scored)
        summary = refit_best(table, trials, family, scored, metric).withColumn("feature_set", F.lit(name))
        summaries = summary if summaries is None else summaries.unionByName(summary)
    return summaries
