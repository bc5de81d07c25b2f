"""Queries of the clustering, the models and the searches.

Fitted models have no SQL; their rows are checked by the tests. Where an operator does not depend on how a
prediction was made, it is fed with group means of the training year, which SQL can state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.functions import dates as D
from urbanflow.functions.numbers import mean_of_two
from urbanflow.operators import cluster as K
from urbanflow.operators import models as M
from urbanflow.operators import search as R
from urbanflow.operators.encode import encode_temporal, level_index, one_hot, one_hot_sparse
from urbanflow.operators.projection import split_by_year
from urbanflow.plans.exploration import SCORES, cluster_rows, score_table
from urbanflow.plans.modelling import baseline_tree, model_table
from urbanflow.session import join_lookup, materialize
from urbanflow.workload import tables as T
from urbanflow.workload.registry import query
from urbanflow.workload.stats import box_sql, rounded

# Key sets of the group-mean predictors; one trial each.
TRIAL_KEYS = [["area"], ["road"], ["weather"], ["roadwork"], ["area", "weather"], ["road", "weather", "roadwork"]]


def labelled(spark, sf) -> DataFrame:
    facts = T.facts(spark, sf).withColumn("label", F.col("volume"))
    return split_by_year(facts, "d", T.YEARS)


def with_group_means(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Predict the mean label of the training rows that share the keys."""
    means = df.where("split = 'train'").groupBy(*keys).agg(F.avg("label").alias(out))
    return join_lookup(df, means, keys, "left")


def mean_trials(spark, sf) -> DataFrame:
    """(trial_id, keys, train_rmse, val_rmse, test_rmse) of the group-mean predictors, scored in one job."""
    rows = materialize(labelled(spark, sf).select("split", "label", "area", "road", "weather", "roadwork"))
    for i, keys in enumerate(TRIAL_KEYS):
        rows = with_group_means(rows, keys, f"p{i}")
    errors = M.rmse_by_split(rows, predictions={f"e{i}": f"p{i}" for i in range(len(TRIAL_KEYS))})
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("trial_id"), F.lit("+".join(keys)).alias("keys"), F.round(f"e{i}", 4).alias("e"))
        for i, keys in enumerate(TRIAL_KEYS)
    ]))
    long = errors.select("split", cells.alias("c")).select("split", "c.*")
    wide = long.groupBy("trial_id", "keys").pivot("split", list(T.YEARS)).agg(F.max("e"))
    return wide.select("trial_id", "keys", *[F.col(s).alias(f"{s}_rmse") for s in T.YEARS])


LABELLED = f"""{T.FACTS}, rows AS (SELECT *, CASE year(d) WHEN 1998 THEN 'train' WHEN 1999 THEN 'val'
  WHEN 2000 THEN 'test' END AS split FROM facts WHERE year(d) IN (1998, 1999, 2000))"""


def _trial_sql(i: int, keys: list[str]) -> str:
    names = ", ".join(keys)
    rmse = "round(sqrt(avg(power(volume - p, 2)) FILTER (WHERE split = '{s}')), 4) AS {s}_rmse"
    return f"""SELECT {i} AS trial_id, '{"+".join(keys)}' AS keys, {", ".join(rmse.format(s=s) for s in T.YEARS)}
      FROM rows LEFT JOIN (SELECT {names}, avg(volume) AS p FROM rows WHERE split = 'train' GROUP BY {names}) USING ({names})"""


TRIALS = f"""{LABELLED}, trials AS ({" UNION ALL ".join(_trial_sql(i, k) for i, k in enumerate(TRIAL_KEYS))})"""


@query(
    "rmse_by_split",
    f"""WITH {LABELLED}, m AS (SELECT area, avg(volume) AS p FROM rows WHERE split = 'train' GROUP BY area)
        SELECT split, count(*) AS rows, round(sqrt(avg(power(volume - p, 2))), 4) AS rmse
        FROM rows LEFT JOIN m USING (area) GROUP BY split""",
)
def _(spark, sf):
    return rounded(M.rmse_by_split(with_group_means(labelled(spark, sf), ["area"], "prediction")), 4)


@query(
    "attach_predictions",
    f"""WITH {LABELLED}, a AS (SELECT area, avg(volume) AS pa FROM rows WHERE split = 'train' GROUP BY area),
        w AS (SELECT weather, avg(volume) AS pw FROM rows WHERE split = 'train' GROUP BY weather)
        SELECT k, round(pa, 6) AS p_area, round(pw, 6) AS p_weather, round((pa + pw) / 2, 6) AS prediction
        FROM rows LEFT JOIN a USING (area) LEFT JOIN w USING (weather)""",
)
def _(spark, sf):
    both = with_group_means(with_group_means(labelled(spark, sf), ["area"], "p_area"), ["weather"], "p_weather")
    mean = mean_of_two(F.col("p_area"), F.col("p_weather"))
    return rounded(both.select("k", "p_area", "p_weather", mean.alias("prediction")), 6)


@query(
    "trial_leaderboard",
    f"WITH {TRIALS} SELECT *, row_number() OVER (ORDER BY val_rmse NULLS LAST, trial_id) - 1 AS rank FROM trials",
)
def _(spark, sf):
    return R.trial_leaderboard(mean_trials(spark, sf))


@query("best_trial", f"WITH {TRIALS} SELECT * FROM trials ORDER BY val_rmse NULLS LAST, trial_id LIMIT 1")
def _(spark, sf):
    return R.best_trial(mean_trials(spark, sf))


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("pca_2d")
def _(spark, sf):
    lines = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_COLUMNS)
    return score_table(lines, LINE_COLUMNS)


# On two standardised columns the axes are known: (1, 1) and (1, -1), the stronger one by the sign of the correlation.
# Price and charge are strongly correlated, so the axes are well separated.
@query(
    "pca_two_columns",
    """WITH c AS (SELECT *, l_extendedprice * (1 - l_discount) AS charge FROM lineitem),
       z AS (SELECT l_orderkey, l_linenumber, l_partkey, corr(l_extendedprice, charge) OVER () AS r,
         (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS a,
         (charge - avg(charge) OVER ()) / stddev_pop(charge) OVER () AS b FROM c)
       SELECT l_orderkey, l_linenumber, l_partkey, round(abs(a + sign(r) * b) / sqrt(2), 5) AS first,
         round(abs(a - sign(r) * b) / sqrt(2), 5) AS second FROM z""",
)
def _(spark, sf):
    charge = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("charge")
    lines = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", charge)
    scores = [F.round(F.abs(c), 5).alias(out) for c, out in (("pc1", "first"), ("pc2", "second"))]
    return score_table(lines, ["l_extendedprice", "charge"]).select("l_orderkey", "l_linenumber", "l_partkey", *scores)


@query(
    "kmeans_inertia_of_one",
    """SELECT 1 AS k, round(count(*) * (var_pop(l_quantity) + var_pop(l_discount)), 2) AS inertia FROM lineitem""",
)
def _(spark, sf):
    return rounded(K.kmeans_elbow(T.table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], range(1, 2)), 2)


# Two far-apart groups, so that SQL can state what the clustering finds.
GROUP_CASE = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"
GROUPED = f"SELECT *, {GROUP_CASE} AS g, l_quantity + 1000 * {GROUP_CASE} AS x FROM lineitem"


def _two_groups(spark, sf) -> DataFrame:
    lines = T.table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", F.expr(f"l_quantity + 1000 * {GROUP_CASE}").alias("x"), "l_discount")


@query("kmeans_two_groups", f'SELECT l_orderkey, l_linenumber, l_partkey, CAST(g AS INTEGER) AS "Cluster" FROM ({GROUPED})')
def _(spark, sf):
    lines = _two_groups(spark, sf)
    found = K.kmeans_assign(lines, ["x", "l_discount"], K.kmeans_fit(lines, ["x", "l_discount"]))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "Cluster")


@query(
    "centers_of_two_groups",
    f'SELECT CAST(g AS INTEGER) AS "Cluster", round(avg(x), 4) AS x, round(avg(l_discount), 4) AS l_discount FROM ({GROUPED}) GROUP BY g',
)
def _(spark, sf):
    lines = _two_groups(spark, sf)
    columns = ["x", "l_discount"]
    return rounded(K.cluster_centers(lines, columns, K.kmeans_fit(lines, columns)), 4)


# Distances are computed to six digits or better, so the curve is compared by its logarithm.
@query(
    "elbow_of_two_groups",
    f"""WITH l AS ({GROUPED}), parts AS (SELECT count(*) * (var_pop(x) + var_pop(l_discount)) AS i FROM l GROUP BY g)
        SELECT 1 AS k, round(log10(count(*) * (var_pop(x) + var_pop(l_discount))), 4) AS inertia FROM l
        UNION ALL SELECT 2, round(log10(sum(i)), 4) FROM parts""",
)
def _(spark, sf):
    curve = K.kmeans_elbow(_two_groups(spark, sf), ["x", "l_discount"], range(1, 3))
    return curve.select("k", F.round(F.log10("inertia"), 4).alias("inertia"))


@query("kmeans_elbow")
def _(spark, sf):
    return K.kmeans_elbow(score_table(materialize(T.traffic(spark, sf))), SCORES, range(1, 11), parallelism=4)


@query("kmeans_assign")
def _(spark, sf):
    return cluster_rows(materialize(T.traffic(spark, sf))).rows.select("k", *SCORES, "Cluster")


@query("cluster_centers")
def _(spark, sf):
    found = cluster_rows(materialize(T.traffic(spark, sf)))
    return K.cluster_centers(found.rows, SCORES, found.model)


@query("cluster_profile")
def _(spark, sf):
    return K.cluster_profile(cluster_rows(materialize(T.traffic(spark, sf))).rows, S.MEASURES)


PROFILED = ["x", "l_discount"]


@query(
    "profile_of_two_groups",
    box_sql(
        " UNION ALL ".join(f"SELECT CAST(g AS INTEGER) AS \"Cluster\", '{c}' AS \"column\", {c} AS value FROM ({GROUPED})" for c in PROFILED),
        '"Cluster", "column"',
        "value",
    ),
)
def _(spark, sf):
    lines = _two_groups(spark, sf)
    found = K.kmeans_assign(lines, PROFILED, K.kmeans_fit(lines, PROFILED))
    return rounded(K.cluster_profile(found, PROFILED), 6)


def _encoded_facts(spark, sf) -> DataFrame:
    """Facts as numbers, with date and key riding along: cyclic columns and three one-hot groups."""
    facts = T.facts(spark, sf).drop("road").withColumn("day_of_week", D.day_name(F.col("d")))
    return one_hot(encode_temporal(facts, "d", passthrough=("d",)), ["weather", "area", "roadwork"])


def _modelled(spark, sf, features: list[str] | None = None) -> DataFrame:
    return model_table(_encoded_facts(spark, sf), "volume", "d", T.YEARS, ["k"], features)


ONE_HOT = {
    "weather": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "area": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "roadwork": ["F", "O", "P"],
}
TESTS = [f"{c} = '{v}'" for c, values in ONE_HOT.items() for v in values]
ONE_HOT_NAMES = [f"{c}_{v}" for c, values in ONE_HOT.items() for v in values]


def tree_sql(name: str, source: str, y: str, depth: int, least_split: int = 2, least_leaf: int = 1, penalty: float = 0) -> str:
    """Tables that grow a tree of `TESTS` on the training rows of `source`; `name` has its rows and the value `p` of their leaf."""
    tables = [f"{name}_0 AS (SELECT *, 1 AS node FROM {source})"]
    chosen = " ".join(f"WHEN {j} THEN {t}" for j, t in enumerate(TESTS))
    for d in range(depth):
        candidates = " UNION ALL ".join(
            f"""SELECT node, {j} AS f, count(*) AS n, count(*) FILTER ({t}) AS n1, sum({y}) AS s, sum({y}) FILTER ({t}) AS s1, sum({y}) FILTER (NOT ({t})) AS s0,
                max({y}) > min({y}) AS differ FROM {name}_{d} WHERE split = 'train' GROUP BY node"""
            for j, t in enumerate(TESTS)
        )
        gain = f"s1 * s1 / (n1 + {penalty}) + s0 * s0 / (n - n1 + {penalty}) - s * s / (n + {penalty})"
        tables += [
            f"{name}_c{d} AS ({candidates})",
            f"""{name}_b{d} AS (SELECT node, f FROM {name}_c{d} WHERE n >= {least_split} AND n1 >= {least_leaf} AND n - n1 >= {least_leaf} AND differ
                AND {f"{gain} > 0" if penalty else "true"} QUALIFY row_number() OVER (PARTITION BY node ORDER BY {gain} DESC) = 1)""",
            f"""{name}_{d + 1} AS (SELECT r.* REPLACE (2 * r.node + CASE WHEN (CASE f {chosen} END) THEN 1 ELSE 0 END AS node)
                FROM {name}_{d} r LEFT JOIN {name}_b{d} b ON r.node = b.node)""",
        ]
    value = f"SELECT node, sum({y}) / (count(*) + {penalty}) AS p FROM {name}_{depth} WHERE split = 'train' GROUP BY node"
    return ", ".join([*tables, f"{name} AS (SELECT r.* EXCLUDE (node), v.p FROM {name}_{depth} r JOIN ({value}) v ON r.node = v.node)"])


def boosted_sql(rounds: int, depth: int, rate: float, penalty: float) -> str:
    """Tables of so many rounds of boosting; the last one has the prediction as `said`."""
    tables = [f"{LABELLED}, g0 AS (SELECT *, (SELECT avg(volume) FROM rows WHERE split = 'train') AS said FROM rows), h0 AS (SELECT *, volume - said AS gap FROM g0)"]
    for i in range(rounds):
        tables.append(tree_sql(f"t{i}", f"h{i}", "gap", depth, penalty=penalty))
        tables.append(f"g{i + 1} AS (SELECT * EXCLUDE (p, gap) REPLACE (said + {rate} * p AS said) FROM t{i})")
        tables.append(f"h{i + 1} AS (SELECT *, volume - said AS gap FROM g{i + 1})")
    return ", ".join(tables)


# Seven digits first: they drop what the order of a sum does, so that four digits round alike.
LEAF = "round(round({0}, 7), 4) AS prediction"


def _leaves(scored: DataFrame) -> DataFrame:
    return rounded(rounded(scored.select("k", "split", "prediction"), 7), 4)


def _tree_query(name: str, params: dict) -> None:
    sql = tree_sql("grown", "rows", "volume", params["max_depth"], params.get("min_samples_split", 2), params.get("min_samples_leaf", 1))

    @query(name, f"WITH {LABELLED}, {sql} SELECT k, split, {LEAF.format('p')} FROM grown")
    def _(spark, sf):
        table = _modelled(spark, sf, ONE_HOT_NAMES)
        return _leaves(M.fit(M.decision_tree(params), table.where("split = 'train'")).transform(table))


_tree_query("tree_stump", {"max_depth": 1})
_tree_query("tree_of_depth_three", {"max_depth": 3})
# Limits that bind on the driver tables: a leaf minimum alone would allow more splits.
_tree_query("tree_with_split_minimum", {"max_depth": 4, "min_samples_split": 200, "min_samples_leaf": 20})


def _boosted_query(name: str, rounds: int, depth: int, rate: float, penalty: float) -> None:
    @query(name, f"WITH {boosted_sql(rounds, depth, rate, penalty)} SELECT k, split, {LEAF.format('said')} FROM g{rounds}")
    def _(spark, sf):
        table = _modelled(spark, sf, ONE_HOT_NAMES)
        growth = M.boosted_trees({"n_estimators": rounds, "max_depth": depth, "learning_rate": rate, "reg_lambda": penalty})
        return _leaves(M.fit(growth, table.where("split = 'train'")).transform(table))


_boosted_query("boosted_stumps", 2, 1, 0.2, 1.0)
_boosted_query("boosted_trees_of_depth_two", 2, 2, 0.1, 1.5)


@query("tree_nodes", f"""WITH {LABELLED}, {tree_sql("grown", "rows", "volume", 2)}
    SELECT round(round(p, 7), 4) AS value, count(*) AS rows FROM grown WHERE split = 'train' GROUP BY p""")
def _(spark, sf):
    """The leaves of a tree from its node table."""
    table = _modelled(spark, sf, ONE_HOT_NAMES)
    nodes = M.fit(M.decision_tree({"max_depth": 2}), table.where("split = 'train'")).nodes()
    return rounded(rounded(nodes.where("feature IS NULL").select("value", "rows"), 7), 4)


SPARSE = tree_sql("grown", "rows", "volume", 3)


@query("one_hot_sparse", f"WITH {LABELLED}, {SPARSE} SELECT k, split, {LEAF.format('p')} FROM grown")
def _(spark, sf):
    """The tree of depth three again, from one sparse vector of all levels instead of a column each."""
    facts = split_by_year(T.facts(spark, sf), "d", T.YEARS)
    columns = list(ONE_HOT)
    vectors = one_hot_sparse(facts, columns, level_index(facts, columns))
    table = materialize(M.assemble_sparse(vectors, [], "levels", "volume", ["split", "k"]))
    return _leaves(M.fit(M.decision_tree({"max_depth": 3}), table.where("split = 'train'")).transform(table))


# A point from the middle of the reference grids for the queries that fit one model.
FOREST = {"n_estimators": 400, "max_depth": 15, "min_samples_split": 5, "min_samples_leaf": 2, "max_features": "sqrt"}
BOOSTED = {"n_estimators": 400, "learning_rate": 0.1, "max_depth": 8, "subsample": 0.9, "colsample_bytree": 0.9, "reg_lambda": 1.0}
ENSEMBLE = {f"rf_{k}": v for k, v in FOREST.items()} | {f"xgb_{k}": v for k, v in BOOSTED.items()}


@query("decision_tree")
def _(spark, sf):
    return baseline_tree(_modelled(spark, sf))


def _scored(model, table: DataFrame) -> DataFrame:
    return model.transform(table).select("k", "split", "label", "prediction")


@query("random_forest")
def _(spark, sf):
    table = _modelled(spark, sf)
    return _scored(M.fit(M.random_forest(FOREST), table.where("split = 'train'")), table)


@query("boosted_trees")
def _(spark, sf):
    table = _modelled(spark, sf)
    return _scored(M.fit(M.boosted_trees(BOOSTED), table.where("split = 'train'")), table)


@query("average_ensemble")
def _(spark, sf):
    table = _modelled(spark, sf)
    train = table.where("split = 'train'")
    members = R.ensemble_family(ENSEMBLE)
    both = M.average_ensemble(*[M.fit(growth, train, name) for name, growth in members.items()], table)
    return M.rmse_by_split(both, predictions={"rmse_rf": "pred_rf", "rmse_xgb": "pred_xgb", "rmse_ensemble": "prediction"})


@query("random_search")
def _(spark, sf):
    return R.random_search(_modelled(spark, sf), R.param_sampler(spark, R.FOREST_GRID, R.FOREST_DRAWS), R.forest_family)


@query("tree_search")
def _(spark, sf):
    return R.trial_leaderboard(R.random_search(_modelled(spark, sf), R.param_sampler(spark, R.TREE_GRID, R.TREE_DRAWS), R.tree_family))


@query("refit_best")
def _(spark, sf):
    table = _modelled(spark, sf)
    trials = R.random_search(table, R.param_sampler(spark, R.ENSEMBLE_GRID, R.ENSEMBLE_DRAWS), R.ensemble_family, R.MEMBERS)
    return R.refit_best(table, trials, R.ensemble_family, R.MEMBERS, "val_rmse_ensemble")


@query("feature_set_comparison")
def _(spark, sf):
    encoded = _encoded_facts(spark, sf)
    names = [c for c in encoded.columns if c not in ("k", "d", "volume")]
    sets = {"all": names, "filtered": [c for c in names if not c.startswith("roadwork_")]}
    tables = {name: model_table(encoded, "volume", "d", T.YEARS, ["k"], cols) for name, cols in sets.items()}
    return R.feature_set_comparison(tables, R.param_sampler(spark, R.FOREST_GRID, R.FOREST_DRAWS), R.forest_family)
