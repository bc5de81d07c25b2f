from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from urbanflow.operators import cluster as K
from urbanflow.operators import models as M
from urbanflow.operators import search as R
from urbanflow.plans.exploration import cluster_rows
from urbanflow.plans.modelling import baseline_tree, model_table, tuned
from urbanflow.session import materialize
from urbanflow.workload import learning


@pytest.fixture(scope="module")
def table(spark):
    """A step in x plus noise, over the three split years and one year that belongs to none."""
    rng = np.random.default_rng(1)
    n = 800
    data = pd.DataFrame({"k": range(n), "x.1": rng.random(n), "other/2": rng.random(n), "year": rng.choice([2021, 2022, 2023, 2024], n)})
    data["y"] = np.where(data["x.1"] > 0.5, 100.0, 10.0) + rng.normal(size=n)
    df = spark.createDataFrame(data).withColumn("Date", F.make_date("year", F.lit(6), F.lit(15))).drop("year")
    return model_table(df, "y", keys=["k"])


def test_model_table(table):
    assert table.columns == ["split", "k", "features", "label"]
    assert {r["split"] for r in table.select("split").distinct().collect()} == {"train", "val", "test"}
    assert table.first()["features"].size == 2


def test_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    with pytest.raises(Exception, match="missing value in feature x"):
        M.assemble(df, ["x"], "y").collect()


def test_growths_of_parameters():
    tree = M.decision_tree()
    assert (tree.trees, tree.depth, tree.least_split, tree.least_leaf, tree.columns, tree.bootstrap, tree.seed) == (1, 5, 20, 8, 0.8, False, 42)
    forest = M.random_forest({"n_estimators": 3, "max_depth": None, "max_features": "sqrt"})
    assert (forest.trees, forest.depth, forest.columns, forest.bootstrap, forest.rate) == (3, None, "sqrt", True, None)
    boosted = M.boosted_trees({"reg_lambda": 0.8, "colsample_bytree": 0.9, "subsample": 0.7, "learning_rate": 0.1})
    assert (boosted.penalty, boosted.tree_columns, boosted.share, boosted.rate, boosted.depth, boosted.trees) == (0.8, 0.9, 0.7, 0.1, 6, 100)


def test_baseline_learns_the_step(table):
    row = baseline_tree(table).first()
    assert list(row.asDict()) == ["train_rmse", "val_rmse", "test_rmse"]
    assert row["train_rmse"] < 45  # the error without splits; of two columns one is drawn per node
    assert all(0.5 < v < 60 for v in row)


def test_rmse_by_split(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 0.0, 3.0)], "split string, label double, prediction double")
    got = {r["split"]: (r["rows"], r["rmse"]) for r in M.rmse_by_split(df).collect()}
    assert got == {"a": (2, pytest.approx(0.5**0.5)), "b": (1, 3.0)}


def test_ensemble_is_the_mean_of_its_members(table):
    params = {"rf_n_estimators": 2, "rf_max_depth": 3, "xgb_n_estimators": 3, "xgb_max_depth": 2, "xgb_learning_rate": 0.1, "xgb_reg_lambda": 1.0}
    fitted = [M.fit(growth, table.where("split = 'train'"), name) for name, growth in R.ensemble_family(params).items()]
    scored = M.average_ensemble(*fitted, table)
    gap = scored.agg(F.max(F.abs(F.col("prediction") - (F.col("pred_rf") + F.col("pred_xgb")) / 2))).first()[0]
    assert gap == 0 and scored.count() == table.count()


def test_param_sampler(spark):
    grid = {"depth": [5, None], "share": ["sqrt", None, 0.8], "rate": [0.1, 0.2]}
    a, b = (R.param_sampler(spark, grid, 7).collect() for _ in range(2))
    assert a == b and len({r[1:] for r in a}) == 7
    assert {f.name: f.dataType.simpleString() for f in R.param_sampler(spark, grid, 2).schema} == {
        "trial_id": "int", "depth": "int", "share": "string", "rate": "double",
    }
    everything = R.param_sampler(spark, grid, 100).collect()
    assert len(everything) == 12 == len({r[1:] for r in everything})
    assert R.param_sampler(spark, grid, 7, seed=1).collect() != a
    assert R.param_sampler(spark, R.ENSEMBLE_GRID, 15).count() == 15


def test_best_trial_ties_and_types(spark):
    trials = spark.createDataFrame(
        [(0, 10, 2.0), (1, None, 1.0), (2, 5, 1.0), (3, 7, None)], "trial_id int, max_depth int, val_rmse double"
    )
    assert tuple(R.best_trial(trials).first()) == (1, None, 1.0)
    board = R.trial_leaderboard(trials).collect()
    assert [(r["trial_id"], r["rank"]) for r in board] == [(1, 0), (2, 1), (0, 2), (3, 3)]
    assert trials.schema["max_depth"].dataType.simpleString() == "int"


@pytest.mark.parametrize("parallelism", [1, 3])
def test_search_and_refit(table, parallelism):
    grid = {"max_depth": [1, None], "min_samples_leaf": [1, 8], "max_features": [None, 0.8]}
    board, summary = tuned(table, R.tree_family, grid, 4, parallelism=parallelism)
    rows, best = board.collect(), summary.first()
    assert len(rows) == 4 and [r["val_rmse"] for r in rows] == sorted(r["val_rmse"] for r in rows)
    assert best["trial_id"] == rows[0]["trial_id"] and best["max_depth"] == rows[0]["max_depth"]
    assert 0 < best["train_val_rmse"] < 60 and 0 < best["test_rmse"] < 60


def test_ensemble_search_scores_members(table):
    grid = {"rf_n_estimators": [2], "rf_max_depth": [2, None], "xgb_n_estimators": [2], "xgb_max_depth": [2], "xgb_learning_rate": [0.1]}
    points = R.param_sampler(table.sparkSession, grid, 2)
    trials = R.random_search(table, points, R.ensemble_family, R.MEMBERS)
    assert [c for c in trials.columns if "rmse" in c] == [f"{s}_{m}" for s in ("train", "val") for m in R.MEMBERS]
    summary = R.refit_best(table, trials, R.ensemble_family, R.MEMBERS, "val_rmse_ensemble")
    assert summary.columns[-2:] == ["train_val_rmse_ensemble", "test_rmse_ensemble"]


def test_feature_sets_are_compared(spark, table):
    halves = {"all": table, "fewer": table.where("k % 2 = 0")}
    out = R.feature_set_comparison(halves, R.param_sampler(spark, {"n_estimators": [2], "max_depth": [2]}, 1), R.forest_family)
    assert sorted(r["feature_set"] for r in out.collect()) == ["all", "fewer"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    points = np.vstack([rng.normal(size=(60, 3)), rng.normal(size=(40, 3)) + 8])
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "k int, x double, y double, z double")


def test_elbow(blobs):
    curve = {r["k"]: r["inertia"] for r in K.kmeans_elbow(blobs, ["x", "y"], range(1, 5), parallelism=2).collect()}
    data = blobs.toPandas()[["x", "y"]].to_numpy()
    assert curve[1] == pytest.approx(((data - data.mean(axis=0)) ** 2).sum())
    assert curve[1] > 3 * curve[2] and curve[2] > curve[4]


def _curve(df, **options):
    return [(r["k"], r["inertia"]) for r in K.kmeans_elbow(df, df.columns, range(1, 6), **options).collect()]


def test_elbow_of_a_large_table_moves_all_centers_together(spark, monkeypatch):
    """MLlib chooses the first centres only, and its curve stays as it is. One file: its choice depends on the order of the rows."""
    rows = materialize(spark.range(0, 1500, 1, 1).select((F.rand(5) * 9).alias("x"), (F.rand(6) * 4).alias("y.1"), F.randn(7).alias("z")))
    expected, asked, fit = _curve(rows, max_iter=30), [], K._fit
    monkeypatch.setattr(K, "_fit", lambda points, k, seed, max_iter: asked.append((k, max_iter)) or fit(points, k, seed, max_iter))
    monkeypatch.setattr(K, "LARGE", 0)
    monkeypatch.setattr(K, "FIRST_ASIDE", 3)
    found = _curve(rows, max_iter=30)
    assert asked == [(k, 0) for k in range(2, 6)]
    assert [k for k, _ in found] == [1, 2, 3, 4, 5]
    assert [i for _, i in found] == pytest.approx([i for _, i in expected], rel=1e-6)


def test_points_set_aside_change_no_inertia(spark, monkeypatch):
    """Far from the origin and with many ties; points are handed on in small blocks."""
    rows = materialize(spark.range(0, 900, 1, 2).select((F.rand(5) * 9 + 1000).alias("x"), F.floor(F.rand(6) * 4).cast("int").alias("y")))
    starts = {k: np.array([[1000.0 + 2 * j, j % 3] for j in range(k)]) for k in (2, 3, 5)}
    points, found = rows.select("x", F.col("y").cast("double")), []
    monkeypatch.setattr(K, "BLOCK", 16)
    for first in (2, 1000):
        monkeypatch.setattr(K, "FIRST_ASIDE", first)
        found.append(K._inertias(points, dict(starts), 25))
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_elbow_of_equal_points_on_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(K, "LARGE", 0)
    same = spark.range(20).select(F.lit(2.0).alias("x"), F.lit(3.0).alias("y"))
    assert [r["inertia"] for r in K.kmeans_elbow(same, ["x", "y"], range(1, 4)).collect()] == [0, 0, 0]
    with pytest.raises(Exception, match="missing value in feature y"):
        K.kmeans_elbow(same.withColumn("y", F.expr("nullif(y, 3)")), ["x", "y"], range(2, 3))


def test_clusters_of_rows(blobs):
    found = cluster_rows(blobs, ["x", "y", "z"])
    rows = found.rows.toPandas().sort_values("k")
    assert len(rows) == 100
    assert rows["Cluster"].iloc[:60].nunique() == 1 and rows["Cluster"].iloc[60:].nunique() == 1
    centers = K.cluster_centers(found.rows, ["pc1", "pc2"], found.model).toPandas().set_index("Cluster")
    means = rows.groupby("Cluster")[["pc1", "pc2"]].mean()
    np.testing.assert_allclose(centers.to_numpy(), means.to_numpy(), atol=1e-6)
    profile = K.cluster_profile(found.rows, ["x", "y"]).toPandas()
    assert len(profile) == 4 and profile["n"].sum() == 200


SEARCHES = {
    "random_search": (R.FOREST_GRID, R.FOREST_DRAWS), "tree_search": (R.TREE_GRID, R.TREE_DRAWS),
    "refit_best": (R.ENSEMBLE_GRID, R.ENSEMBLE_DRAWS), "feature_set_comparison": (R.FOREST_GRID, R.FOREST_DRAWS),
}


@pytest.mark.parametrize("name", SEARCHES)
def test_registered_searches_draw_from_the_reference_grids(spark, monkeypatch, name):
    """With families that grow a stump, so that only the points are seen."""
    grid, draws = SEARCHES[name]
    tried = []

    def family(params):
        tried.append(params)
        members = ("pred_rf", "pred_xgb") if name == "refit_best" else ("prediction",)
        return {member: M.decision_tree({"max_depth": 1}) for member in members}

    for kind in ("tree_family", "forest_family", "ensemble_family"):
        monkeypatch.setattr(R, kind, family)
    entry.queries()[name](spark, "/root/testdata/sf0.001").collect()
    sets, refits = (2, 2) if name == "feature_set_comparison" else (1, int(name == "refit_best"))
    assert len(tried) == sets * draws + refits
    assert all(params[key] in values for params in tried for key, values in grid.items())


def test_registered_models_have_reference_sizes():
    points = (learning.FOREST, R.FOREST_GRID), ({f"xgb_{k}": v for k, v in learning.BOOSTED.items()}, R.ENSEMBLE_GRID)
    for point, grid in (*points, (learning.ENSEMBLE, R.ENSEMBLE_GRID)):
        assert all(value in grid[key] for key, value in point.items())
