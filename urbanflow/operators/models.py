"""Regressors on encoded tables, and their error per split.

Models are described by a `Growth` and grown by `urbanflow.operators.trees`, in which every knob has its usual meaning.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.functions.numbers import mean_of_two
from urbanflow.operators import trees as G
from urbanflow.operators.reduce import vector_of
from urbanflow.session import drop_table, ensure_checkpoint_dir

SEED = 42

# The settings of the first decision tree.
BASELINE_TREE = {"max_depth": 5, "min_samples_split": 20, "min_samples_leaf": 8, "max_features": 0.8}


def assemble(df: DataFrame, features: list[str], target: str, keep: list[str] = ()) -> DataFrame:
    """(kept columns, features, label): what a fit reads."""
    kept = [col_q(c) for c in keep]
    return df.select(*kept, vector_of(features).alias("features"), col_q(target).cast("double").alias("label"))


def assemble_sparse(df: DataFrame, features: list[str], levels: str, target: str, keep: list[str] = ()) -> DataFrame:
    """As `assemble`, with the sparse vector of `one_hot_sparse` after the plain features."""
    kept = [col_q(c) for c in keep]
    plain = df.select(*kept, vector_of(features).alias("__plain"), col_q(levels).alias("__levels"), col_q(target).cast("double").alias("label"))
    joined = VectorAssembler(inputCols=["__plain", "__levels"], outputCol="features").transform(plain)
    return joined.select(*kept, "features", "label")


def _depth(params: dict, default: int | None = None) -> int | None:
    depth = params.get("max_depth", default)
    return None if depth is None else int(depth)


def decision_tree(params: dict = BASELINE_TREE, seed: int = SEED) -> G.Growth:
    """A single tree on all rows."""
    return G.Growth(
        depth=_depth(params), least_split=int(params.get("min_samples_split", 2)), least_leaf=int(params.get("min_samples_leaf", 1)),
        columns=params.get("max_features"), max_bins=int(params.get("max_bins", G.MAX_BINS)), seed=seed,
    )


def random_forest(params: dict, seed: int = SEED) -> G.Growth:
    """The mean of trees on bootstraps: a row's count in each is a Poisson draw."""
    return G.Growth(
        trees=int(params.get("n_estimators", 100)), depth=_depth(params), least_split=int(params.get("min_samples_split", 2)),
        least_leaf=int(params.get("min_samples_leaf", 1)), columns=params.get("max_features", 1.0),
        max_bins=int(params.get("max_bins", G.MAX_BINS)), bootstrap=True, seed=seed,
    )


def boosted_trees(params: dict, seed: int = SEED) -> G.Growth:
    """Gradient boosting on squared error, from the mean label: a tree adds `learning_rate` times its fit of what is left.

    A leaf is worth sum / (rows + `reg_lambda`), and splits are chosen by the same measure; `colsample_bytree` draws the
    columns of a tree, `subsample` its rows.
    """
    return G.Growth(
        trees=int(params.get("n_estimators", 100)), depth=_depth(params, 6), tree_columns=float(params.get("colsample_bytree", 1.0)),
        penalty=float(params.get("reg_lambda", 1.0)), share=float(params.get("subsample", 1.0)), rate=float(params.get("learning_rate", 0.3)),
        max_bins=int(params.get("max_bins", G.MAX_BINS)), seed=seed,
    )


def fit(growth: G.Growth, train: DataFrame, prediction: str = "prediction") -> G.Trees:
    """Grow a model on an assembled table."""
    ensure_checkpoint_dir(train.sparkSession)
    return G.fit_trees(growth, train, prediction)


def average_ensemble(forest: G.Trees, boosted: G.Trees, table: DataFrame) -> DataFrame:
    """Both members' predictions and their mean on the same rows: chained transforms, no join."""
    both = boosted.transform(forest.transform(table))
    members = F.col(forest.prediction), F.col(boosted.prediction)
    return both.withColumn("prediction", mean_of_two(*members))


def rmse_by_split(
    df: DataFrame, label: str = "label", predictions: dict[str, str] | None = None, split: str = "split"
) -> DataFrame:
    """Root mean squared error per split, one column per prediction, from one aggregate."""
    predictions = predictions or {"rmse": "prediction"}
    errors = []
    for out, column in predictions.items():
        gap = col_q(label) - col_q(column)
        errors.append(F.sqrt(F.avg(gap * gap)).alias(out))
    return df.groupBy(col_q(split)).agg(F.count(F.lit(1)).alias("rows"), *errors)


def errors_of_models(
    table: DataFrame, trials: dict[int, dict[str, G.Growth]], splits: list[str], outputs: dict[str, list[str]], parallelism: int = 1
) -> dict[int, dict[str, float]]:
    """{trial: {split_output: error}}: every trial's members are grown on the first split and scored on all of `splits`.

    `outputs` maps an error to the members whose mean it judges. A table whose different feature vectors fit a task is
    scored for all trials in one job; another is fitted trial by trial, `parallelism` at a time, each fit spread over the cluster.
    """
    ensure_checkpoint_dir(table.sparkSession)
    rows = table.where(F.col("split").isin(splits))
    first = rows.select("features").first()
    if first is None or not trials:
        return {trial: {} for trial in trials}
    if G.small_enough(rows, first["features"].size):
        groups = G.Groups.of(rows, splits)
        found: dict[int, dict[str, float]] = {trial: {} for trial in trials}
        for r in G.errors_in_tasks(groups, trials, splits, outputs).collect():
            found[r["trial"]][f"{r['part']}_{r['output']}"] = (r["squares"] / r["rows"]) ** 0.5
        drop_table(groups.table)
        return found

    def run(trial: int) -> dict[str, float]:
        said = rows
        for member, growth in trials[trial].items():
            said = fit(growth, rows.where(F.col("split") == splits[0]), member).transform(said)
        means = {output: sum(map(col_q, members[1:]), col_q(members[0])) / len(members) for output, members in outputs.items()}
        said = said.withColumns({f"__{output}": mean for output, mean in means.items()})
        errors = rmse_by_split(said, predictions={output: f"__{output}" for output in outputs}).collect()
        return {f"{r['split']}_{output}": r[output] for r in errors for output in outputs}

    with ThreadPoolExecutor(parallelism) as pool:
        return dict(zip(trials, pool.map(inheritable_thread_target(table.sparkSession)(run), trials)))
