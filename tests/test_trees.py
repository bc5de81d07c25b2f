"""Grown trees against plain recursion, growth by levels against growth in one task, and searches that go on."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from urbanflow.operators import models as M
from urbanflow.operators import search as R
from urbanflow.operators import trees as G
from urbanflow.session import materialize


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    n = 400
    x = np.column_stack([rng.random(n), rng.integers(0, 12, n), rng.integers(0, 2, n), rng.normal(size=n), rng.integers(0, 2, n)]).astype(float)
    y = 40 * x[:, 0] + 3 * x[:, 1] + 25 * x[:, 2] * (x[:, 1] > 5) + rng.normal(size=n) * 5
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rng = np.random.default_rng(9)
    frame = pd.DataFrame({"k": range(len(y)), "split": rng.choice(["train", "val", "test"], len(y), p=[0.6, 0.2, 0.2]), "x": x.tolist(), "label": y})
    rows = spark.createDataFrame(frame).repartition(7)
    return materialize(rows.select("k", "split", array_to_vector("x").alias("features"), "label"))


def plain_tree(x, y, depth, least_split, least_leaf, penalty=0.0):
    """A function from rows to values, by trying every threshold of every column at every node."""
    if len(y) < least_split or len(y) < 2 * least_leaf or depth == 0 or y.min() == y.max():
        value = y.sum() / (len(y) + penalty)
        return lambda rows: np.full(len(rows), value)
    best = None
    for f in range(x.shape[1]):
        own = np.unique(x[:, f])
        for a, b in zip(own[:-1], own[1:]):
            left = x[:, f] <= a
            n, m = left.sum(), (~left).sum()
            if n >= least_leaf and m >= least_leaf:
                gain = y[left].sum() ** 2 / (n + penalty) + y[~left].sum() ** 2 / (m + penalty)
                if best is None or gain > best[0] * (1 + 1e-12):
                    best = gain, f, (a + b) / 2
    if best is None or (penalty and best[0] <= y.sum() ** 2 / (len(y) + penalty)):
        value = y.sum() / (len(y) + penalty)
        return lambda rows: np.full(len(rows), value)
    _, f, at = best
    left = x[:, f] <= at
    one, other = (plain_tree(x[s], y[s], depth - 1, least_split, least_leaf, penalty) for s in (left, ~left))
    return lambda rows: np.where(rows[:, f] <= at, one(rows), other(rows))


def frame_of(table):
    rows = table.toPandas().sort_values("k")
    return np.stack([v.toArray() for v in rows["features"]]), rows["label"].to_numpy(), rows["split"].to_numpy()


@pytest.mark.parametrize("least_split", [2, 5, 10, 20])
@pytest.mark.parametrize("least_leaf", [1, 2, 4, 8])
def test_limits_are_exact(data, least_split, least_leaf):
    x, y = data
    growth = M.decision_tree({"min_samples_split": least_split, "min_samples_leaf": least_leaf, "max_depth": 12, "max_features": None})
    values = G.values_in_task(x, 1024)
    tree = G.grow(values.bins(x), values, y - y.mean(), np.ones(len(y)), growth, 0, G.root_uid(growth, 0))
    want = plain_tree(x, y - y.mean(), 12, least_split, least_leaf)(x)
    np.testing.assert_allclose(G.tree_values(tree, x), want, atol=1e-9)
    feature, _, left, _, rows = tree
    inner = feature >= 0
    assert rows[inner].min() >= least_split and rows[~inner].min() >= least_leaf
    assert (rows[inner] == rows[left[inner]] + rows[left[inner] + 1]).all()


def test_boosting_equals_plain_rounds(table):
    x, y, split = frame_of(table)
    train = split == "train"
    growth = M.boosted_trees({"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "reg_lambda": 1.5})
    said = np.full(len(y), y[train].mean())
    for _ in range(4):
        said += 0.3 * plain_tree(x[train], (y - said)[train], 3, 2, 1, 1.5)(x)
    got = M.fit(growth, table.where("split = 'train'")).transform(table).orderBy("k").toPandas()
    np.testing.assert_allclose(got["prediction"], said, atol=1e-8)


GROWTHS = [
    M.decision_tree({"max_depth": 6, "min_samples_leaf": 3, "max_features": None}),
    M.random_forest({"n_estimators": 30, "max_features": "sqrt", "min_samples_split": 6}),
    M.boosted_trees({"n_estimators": 12, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.7}),
]


@pytest.mark.parametrize("growth", GROWTHS, ids=["tree", "forest", "boosted"])
def test_levels_and_tasks_grow_the_same_trees(table, monkeypatch, growth):
    train = table.where("split = 'train'")
    want = M.fit(growth, train).transform(table).orderBy("k").toPandas()["prediction"]
    monkeypatch.setattr(G, "CELLS_IN_TASK", 5 * 60)
    monkeypatch.setattr(G, "TREES_IN_TASK", 8)
    monkeypatch.setattr(G, "SCORED_BYTES", 4000)
    model = M.fit(growth, train)
    got = model.transform(table).orderBy("k").toPandas()["prediction"]
    np.testing.assert_allclose(got, want, rtol=1e-9)
    nodes = model.nodes()
    assert nodes.select("tree").distinct().count() == growth.trees
    assert nodes.where("feature IS NOT NULL").count() + growth.trees == nodes.where("feature IS NULL").count()


def test_errors_of_one_job_are_those_of_single_fits(table, monkeypatch):
    trials = {3: {"a": GROWTHS[1], "b": GROWTHS[2]}, 5: {"a": GROWTHS[0], "b": GROWTHS[0]}}
    outputs = {"rmse_a": ["a"], "rmse_b": ["b"], "rmse": ["a", "b"]}
    together = M.errors_of_models(table, trials, ["train", "val"], outputs)
    assert set(together[3]) == {f"{s}_{o}" for s in ("train", "val") for o in outputs}
    monkeypatch.setattr(G, "small_enough", lambda blocks, features: False)
    apart = M.errors_of_models(table, trials, ["train", "val"], outputs, parallelism=2)
    for trial, errors in together.items():
        assert errors == pytest.approx(apart[trial])


def test_bootstrap_and_column_draws():
    ids = np.arange(200_000, dtype=np.uint64)
    w = G.row_weights(GROWTHS[1], 0, ids)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and (w != G.row_weights(GROWTHS[1], 1, ids)).any()
    assert abs(G.row_weights(GROWTHS[2], 0, ids).mean() - 0.8) < 0.01
    assert [G.columns_per_node(G.Growth(columns=c), 17) for c in ("sqrt", "log2", None, 0.8, 1.0, 0.01)] == [4, 4, 17, 13, 17, 1]
    assert len(G.tree_features(GROWTHS[2], 0, 10)) == 7
    order = G.drawn_order(np.arange(1000, dtype=np.uint64), np.arange(5))
    assert (np.sort(order, axis=1) == np.arange(5)).all() and len(np.unique(order[:, 0])) == 5


def test_features_of_many_values_are_cut_at_quantiles(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=5000)
    values = G.values_in_task(np.column_stack([x, np.round(x)]), 64)
    assert values.size[0] == 64 and not values.exact[0] and values.exact[1]
    rows = spark.createDataFrame([(v,) for v in np.column_stack([x, np.round(x)]).tolist()], "x array<double>")
    same = G.values_of_table(rows, 2, 64)
    assert same.exact.tolist() == [False, True] and abs(same.size[0] - 64) <= 2
    np.testing.assert_allclose(same.flat[same.start[1] :], np.unique(np.round(x)))


def test_a_search_goes_on_where_it_ended(spark, table, tmp_path, monkeypatch):
    points = R.param_sampler(spark, {"max_depth": [1, 2, 3, None], "min_samples_leaf": [1, 5]}, 6)
    folder = str(tmp_path / "trials")
    fresh = R.random_search(table, points, R.tree_family).collect()
    R.random_search(table, points.where("trial_id < 3"), R.tree_family, folder=folder, at_once=2)
    tried = []

    def family(params):
        tried.append(params)
        return R.tree_family(params)

    again = R.random_search(table, points, family, folder=folder, at_once=2).collect()
    assert again == fresh and len(tried) == 3
    assert R.random_search(table, points, family, folder=folder).collect() == fresh and len(tried) == 3
    other = points.withColumn("min_samples_leaf", F.lit(9))
    with pytest.raises(ValueError, match="another trial"):
        R.random_search(table, other, family, folder=folder)


def test_no_rows_and_one_value(spark, table):
    with pytest.raises(ValueError, match="no rows"):
        M.fit(GROWTHS[0], table.limit(0))
    assert M.errors_of_models(table.limit(0), {0: {"p": GROWTHS[0]}}, ["train"], {"rmse": ["p"]}) == {0: {}}
    flat = table.withColumn("label", F.lit(7.0))
    for growth in GROWTHS:
        assert {r[0] for r in M.fit(growth, flat).transform(table.limit(5)).select(F.round("prediction", 9)).collect()} == {7.0}
    assert M.fit(GROWTHS[0], table.limit(1)).transform(table).count() == table.count()


@pytest.fixture(scope="module")
def repeated(spark):
    """600 rows of 24 feature vectors, of which one has 200 rows."""
    rng = np.random.default_rng(11)
    n = 600
    x = np.column_stack([rng.integers(0, 4, n), rng.integers(0, 3, n) / 7, rng.integers(0, 2, n)]).astype(float)
    x[:200] = x[0]
    y = 10 * x[:, 0] + 90 * x[:, 1] * x[:, 2] + rng.normal(size=n) * 5
    frame = pd.DataFrame({"k": range(n), "split": rng.choice(["train", "val", "test"], n, p=[0.6, 0.2, 0.2]), "x": x.tolist(), "label": y})
    return materialize(spark.createDataFrame(frame).repartition(5).select("k", "split", array_to_vector("x").alias("features"), "label"))


@pytest.mark.parametrize("growth", GROWTHS, ids=["tree", "forest", "boosted"])
def test_rows_of_equal_features_grow_as_groups(repeated, monkeypatch, growth):
    """A table of more rows than a task may hold needs no levels if its vectors are few, and gives the same trees."""
    monkeypatch.setattr(G, "CELLS_IN_TASK", 3 * 60)
    monkeypatch.setattr(G, "ROWS_IN_DEAL", 50)
    train = repeated.where("split = 'train'")

    def levels(*args):
        raise AssertionError("grown by levels")

    with monkeypatch.context() as m:
        m.setattr(G, "grow_by_levels", levels)
        model = M.fit(growth, train)
        got = model.transform(repeated).orderBy("k").toPandas()["prediction"]
        trials = {0: {"p": growth}, 4: {"p": GROWTHS[1]}}
        errors = M.errors_of_models(repeated, trials, ["train", "val"], {"rmse": ["p"]})
    monkeypatch.setattr(G, "small_enough", lambda table, features: False)
    apart = M.fit(growth, train)
    np.testing.assert_allclose(got, apart.transform(repeated).orderBy("k").toPandas()["prediction"], rtol=1e-9)
    for trial, said in M.errors_of_models(repeated, trials, ["train", "val"], {"rmse": ["p"]}).items():
        assert errors[trial] == pytest.approx(said)
    roots = [{r["tree"]: r["rows"] for r in m.nodes().where("node = 0").collect()} for m in (model, apart)]
    assert roots[0] == roots[1]


def test_quantiles_of_groups_count_their_rows():
    rng = np.random.default_rng(5)
    x, count = rng.normal(size=(300, 2)), rng.integers(1, 9, 300).astype(float)
    groups, rows = G.values_in_task(x, 32, count), G.values_in_task(np.repeat(x, count.astype(int), axis=0), 32)
    np.testing.assert_array_equal(groups.flat, rows.flat)
    want = np.unique(np.quantile(np.repeat(x[:, 0], count.astype(int)), np.arange(1, 33) / 32, method="higher"))
    np.testing.assert_array_equal(rows.flat[: rows.size[0]], want)


def test_vectors_are_scored_once(repeated, monkeypatch):
    model = M.fit(GROWTHS[0], repeated)
    scored = []
    plain = G.Trees._scored
    monkeypatch.setattr(G.Trees, "_scored", lambda self, rows: scored.append(rows.count()) or plain(self, rows))
    assert model.transform(repeated).count() == 600 and scored == [repeated.select("features").toPandas()["features"].map(str).nunique()]


def test_a_model_of_missing_labels_says_nothing(repeated):
    unknown = repeated.withColumn("label", F.when(F.col("k") != 3, F.col("label")))
    said = M.fit(GROWTHS[0], unknown).transform(repeated)
    assert said.where("prediction IS NULL").count() == 600


def test_trees_that_differ_only_in_where_they_end_are_grown_once(monkeypatch):
    """Of random limits, each model says what a tree of its own says; before, every model grew its own."""
    draws = np.random.default_rng(3)
    x = np.unique(draws.integers(0, 6, (400, 4)).astype(float), axis=0)
    label = x[:, 0] * x[:, 1] - x[:, 2] + draws.normal(size=len(x))
    rows = draws.integers(1, 5, len(x)).astype(float)
    held = G.Held(x, np.stack([rows, label, rows * 0.1], axis=1)[:, None, :])
    limits = [(None, 2, 1, None), (3, 2, 1, None), (None, 12, 1, 1.0), (6, 30, 1, 4 / 4), (0, 2, 1, None), (None, 2, 3, None), (5, 2, 1, 0.5)]
    models = {str(i): G.Growth(trees=2, depth=d, least_split=s, least_leaf=leaf, columns=c) for i, (d, s, leaf, c) in enumerate(limits)}
    values = G.values_in_task(x, G.MAX_BINS, rows)
    grow, calls = G.grow_groups, []
    monkeypatch.setattr(G, "grow_groups", lambda *a: calls.append(a) or grow(*a))
    said = {(name, tree): G.ended_values(arrays, models[name])[G.tree_leaves(arrays, x)]
            for names, tree, arrays in G._grown_models(held, models, 0, 2, 0.5, iter(())) for name in names}
    assert len(calls) == 2 * 3  # five models grow alike
    assert set(said) == {(name, tree) for name in models for tree in range(2)}
    y = label - 0.5
    for (name, tree), found in said.items():
        own = grow(values.bins(x), values, rows, rows, rows * y, rows * (y * y + 0.1), models[name], tree, G.root_uid(models[name], tree))
        assert np.allclose(found, G.tree_values(own, x), rtol=0, atol=1e-9), name
