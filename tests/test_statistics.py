from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from urbanflow.operators import bins as B
from urbanflow.operators import quantiles as Q
from urbanflow.operators import reduce as D
from urbanflow.operators import statistics as X

PROBS = {"a": 0.0, "q1": 0.25, "m": 0.5, "p9": 0.9, "z": 1.0}


def frame(kind: str, n: int = 4000) -> pd.DataFrame:
    rng = np.random.default_rng(7)
    hot = rng.random(n) < 0.6
    key = np.where(hot, "hot", rng.choice(list("abc"), n))
    values = {
        "normal": rng.normal(size=n),
        "ties": rng.integers(0, 5, n).astype(float),
        "mostly_one": np.where(rng.random(n) < 0.9, 3.0, rng.normal(size=n) * 100),
        "tailed": np.exp(rng.normal(size=n) * 12),
        "constant": np.full(n, 2.5),
    }[kind]
    return pd.DataFrame({"k": key, "v": values})


@pytest.mark.parametrize("kind", ["normal", "ties", "mostly_one", "tailed", "constant"])
@pytest.mark.parametrize("cell_rows, grid", [(10**6, 1000), (50, 20)])
def test_exact_quantiles_match_numpy(spark, kind, cell_rows, grid):
    data = frame(kind)
    df = spark.createDataFrame(data).repartition(7)
    got = Q.exact_quantiles(df, ["k"], "v", PROBS, cell_rows, grid).toPandas().set_index("k")
    for key, part in data.groupby("k"):
        assert got.loc[key, "n"] == len(part)
        expected = np.quantile(part["v"], list(PROBS.values()))
        assert got.loc[key, list(PROBS)].to_numpy(float) == pytest.approx(expected, rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("cell_rows", [10**6, 2])
def test_quantile_edges(spark, cell_rows):
    rows = [("one", 4.0), ("four", 1.0), ("four", 2.0), ("four", 3.0), ("four", 4.0), ("none", None), (None, 1.0), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["n"], r["x"], r["y"], r["z"]) for r in Q.exact_quantiles(df, ["k"], "v", {"x": 0.25, "y": 0.5, "z": 0.75}, cell_rows, 20).collect()}
    assert got == {"one": (1, 4.0, 4.0, 4.0), "four": (4, 1.75, 2.5, 3.25)}


def test_quantiles_without_groups(spark):
    df = spark.createDataFrame(frame("normal", 1000))
    for cells in (10**6, 100):
        got = Q.exact_quantiles(df, [], "v", {"m": 0.5}, cells, 20).collect()
        assert [(r["n"], round(r["m"], 12)) for r in got] == [(1000, round(float(np.median(frame("normal", 1000)["v"])), 12))]


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"x.y": rng.normal(size=101), "n": rng.integers(0, 9, 101), "t": rng.choice(["u", "v", "w"], 101, p=[0.6, 0.3, 0.1])})
    data.loc[3:7, "x.y"] = np.nan
    got = X.describe_columns(spark.createDataFrame(data)).toPandas().set_index("column")
    expected = data.describe(include="all")
    for c in ("x.y", "n"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got.loc[c, ours] == pytest.approx(expected.loc[theirs, c]), (c, ours)
    assert (got.loc["t", "count"], got.loc["t", "unique"], got.loc["t", "top"], got.loc["t", "freq"]) == (101, 3, *expected.loc[["top", "freq"], "t"])
    approximate = X.describe_columns(spark.createDataFrame(data), ["n"], approx=True).first()
    assert approximate["q50"] in set(data["n"])


def correlated(columns: int) -> pd.DataFrame:
    rng = np.random.default_rng(11)
    data = pd.DataFrame(rng.normal(size=(300, columns)), columns=[f"c.{i}" for i in range(columns)])
    data["c.1"] = data["c.0"] * 2 + 1e6 + rng.normal(size=300)
    data["c.2"] = 7.25
    data.loc[data.index % 3 == 0, "c.0"] = np.nan
    return data


@pytest.mark.parametrize("columns", [4, 14])
def test_correlations_match_pandas(spark, columns):
    data = correlated(columns)
    long = X.corr_matrix(spark.createDataFrame(data).repartition(5))
    got = long.toPandas().pivot(index="x", columns="y", values="r")
    expected = data.corr()
    assert len(long.collect()) == columns * columns
    np.testing.assert_allclose(got.loc[expected.index, expected.columns].to_numpy(float), expected.to_numpy(), atol=1e-9)
    assert got.loc["c.2"].isna().all()


def test_correlation_of_one_row_and_target(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert [r["r"] for r in X.corr_matrix(one).collect()] == [None] * 4
    data = correlated(6)
    got = [(r["feature"], r["r"]) for r in X.target_correlation(spark.createDataFrame(data), "c.1").collect()]
    expected = data.corr()["c.1"].drop("c.1").sort_values(ascending=False)
    assert [f for f, _ in got] == list(expected.index)
    assert got[0][1] == pytest.approx(expected.iloc[0]) and got[-1] == ("c.2", None)


@pytest.mark.parametrize("values", [[0.0, 0.1, 0.2, 0.30000000000000004, 1.0, 0.95, None, float("nan")], [3.0, 3.0], [0.0, 1.0] + [i / 20 for i in range(21)]])
def test_histogram_matches_numpy(spark, values):
    got = B.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v").collect()
    clean = [v for v in values if v is not None and not math.isnan(v)]
    counts, edges = np.histogram(clean, 20)
    assert [r["rows"] for r in got] == list(counts)
    assert [r["left_edge"] for r in got] == pytest.approx(list(edges[:-1])) and got[-1]["right_edge"] == pytest.approx(edges[-1])


def test_hexbin_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=500), rng.integers(0, 40, 500).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0)], "x double, y double")
    got = {(r["lattice"], r["ix"], r["iy"]): r["rows"] for r in B.hexbin_density(df, "x", "y").collect()}
    pad = 1e-9 * (x.max() - x.min())
    u = (x - x.min() + pad) / ((x.max() - x.min() + 2 * pad) / 30)
    w = (y - y.min()) / ((y.max() - y.min()) / 17)
    expected: dict = {}
    for a, b in zip(u, w):
        near = (a - round(a)) ** 2 + 3 * (b - round(b)) ** 2
        shifted = (a - math.floor(a) - 0.5) ** 2 + 3 * (b - math.floor(b) - 0.5) ** 2
        cell = (1, round(a), round(b)) if near < shifted else (2, math.floor(a), math.floor(b))
        expected[cell] = expected.get(cell, 0) + 1
    assert got == expected and sum(got.values()) == 500
    flat = B.hexbin_density(spark.createDataFrame([(2.0, 0.0)] * 3, "x double, y double"), "x", "y").collect()
    assert [r["rows"] for r in flat] == [3]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 10, "grid": 20}])
def test_box_stats(spark, options):
    rows = [("a", float(v)) for v in [*range(1, 12), 100]] + [("b", 5.0), (None, 1.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    a, b = B.box_stats(df, ["k"], "v", **options).collect()
    q1, median, q3 = np.quantile([*range(1, 12), 100], [0.25, 0.5, 0.75])
    assert tuple(a) == ("a", 12, 1.0, q1, median, q3, 11.0, 1)
    assert tuple(b) == ("b", 1, 5.0, 5.0, 5.0, 5.0, 5.0, 0)
    assert [tuple(r) for r in B.box_outliers(df, ["k"], "v", **options).collect()] == [("a", 100.0)]


def test_box_stats_of_many_columns(spark):
    df = spark.createDataFrame([(i % 2, float(i), float(-i)) for i in range(40)], "g int, x double, `y.z` double")
    got = {(r["g"], r["column"]): r["median"] for r in B.box_stats_unpivot(df, "g", ["x", "y.z"]).collect()}
    assert got == {(0, "x"): 19.0, (1, "x"): 20.0, (0, "y.z"): -19.0, (1, "y.z"): -20.0}


def test_standardize_and_components(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=400)
    data = pd.DataFrame({"a": base, "b.c": base * 3 + rng.normal(size=400), "d": rng.normal(size=400) + 9, "flat": 4.0})
    df = spark.createDataFrame(data)
    scaled = D.standardize(df, ["a", "b.c", "d", "flat"]).toPandas()
    expected = (data - data.mean()) / data.std(ddof=0).replace(0, 1)
    np.testing.assert_allclose(scaled.to_numpy(), expected.to_numpy(), atol=1e-9)
    scores = D.pca_scores(D.standardize(df, ["a", "b.c", "d"]), ["a", "b.c", "d"]).toPandas()
    z = expected[["a", "b.c", "d"]].to_numpy()
    values, vectors = np.linalg.eigh(z.T @ z)
    for j, name in ((2, "pc1"), (1, "pc2")):
        axis = vectors[:, j] * np.sign(vectors[np.abs(vectors[:, j]).argmax(), j])
        np.testing.assert_allclose(scores[name], z @ axis, atol=1e-8)
    assert scores["pc1"].var() > scores["pc2"].var()


@pytest.mark.parametrize("extra", [0, 12])
def test_far_off_and_infinite_values(spark, extra):
    """Rows of a pair alone decide its correlation, in narrow and wide tables alike."""
    rows = [(1e8 + i, float(i * i % 7), float("inf") if i == 3 else float(i)) for i in range(10)] + [(0.0, None, 1.0)] * 1000
    data = pd.DataFrame([(*r, *[float(k)] * extra) for k, r in enumerate(rows)], columns=["a", "b", "c", *[f"e{i}" for i in range(extra)]])
    schema = ", ".join(f"{c} double" for c in data.columns)
    values = [tuple(None if v is None or v != v else float(v) for v in r) for r in data.itertuples(index=False)]
    got = {(r.x, r.y): r.r for r in X.corr_matrix(spark.createDataFrame(values, schema), ["a", "b", "c", *data.columns[3:]]).collect()}
    present = data.iloc[:10]
    assert got["a", "b"] == pytest.approx(np.corrcoef(present["a"] - 1e8, present["b"].astype(float))[0, 1], abs=1e-6)
    assert got["a", "c"] is None and got["c", "c"] is None and got["a", "a"] == 1.0
