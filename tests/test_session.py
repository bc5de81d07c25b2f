"""Materialisation and lookups on empty and odd inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from urbanflow import session
from urbanflow.operators import aggregates as A
from urbanflow.operators import bins as B
from urbanflow.operators import quantiles as Q
from urbanflow.operators import statistics as X
from urbanflow.operators.combine import dedup_keep_first, enrich_left_join
from urbanflow.session import join_lookup, materialize


def empty_frames(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, t string, v double")
    return [
        df.where("k > 5"),
        df.where(F.lit(False)),
        spark.createDataFrame([], df.schema),
        df.where("k > 5").groupBy("k", "t").agg(F.sum("v").alias("v")),
        df.join(df.where("k > 5").select("k"), "k").select("k", "t", "v"),
    ]


def test_empty_inputs(spark):
    left = spark.createDataFrame([(1,)], "k int")
    for df in empty_frames(spark):
        assert materialize(df).count() == 0
        assert [tuple(r) for r in join_lookup(left, df, ["k"]).collect()] == [(1, None, None)]
        assert Q.exact_quantiles(df, ["t"], "v", {"m": 0.5}).count() == 0
        assert Q.exact_quantiles(df, [], "v", {"m": 0.5}).count() == 0
        assert B.box_stats(df, ["t"], "v").count() == 0
        assert [r["rows"] for r in B.histogram(df, "v").collect()] == [0] * 20
        assert B.hexbin_density(df, "v", "v").count() == 0
        assert A.mixed_profile(df, ["t"], ["v"], [], ["k"]).count() == 0
        assert [r["r"] for r in X.corr_matrix(df, ["k", "v"]).collect()] == [None] * 4


def test_materialize_keeps_types_and_names(spark):
    df = spark.range(3).select(
        F.col("id").alias("a b/c.d"), F.expr("TIMESTAMP_NTZ'2022-01-01 00:00:01'").alias("t"), F.array("id").alias("l"),
        F.lit(None).cast("string").alias("n"),
    )
    back = materialize(df)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_checkpoint_folder_is_the_named_one_or_below_the_warehouse(spark):
    class Context:
        folder = None

        def getCheckpointDir(self):  # noqa: N802
            return self.folder

        def setCheckpointDir(self, folder):  # noqa: N802
            self.folder = folder

    class Session:
        def __init__(self, **conf):
            self.sparkContext, self.conf = Context(), {"spark.sql.warehouse.dir": "s3://w", "spark.checkpoint.dir": None, **conf}

    for conf, folder in (({}, "s3://w/checkpoints"), ({"spark.checkpoint.dir": "hdfs://c"}, "hdfs://c")):
        session_ = Session(**conf)
        session_.conf = type("Conf", (), {"get": lambda self, key, default=None, c=session_.conf: c.get(key) or default})()
        session.ensure_checkpoint_dir(session_)
        assert session_.sparkContext.folder == folder

    apart = Session()
    apart.sparkContext.master = "spark://host:7077"
    apart.conf = type("Conf", (), {"get": lambda self, key, default=None: {"spark.sql.warehouse.dir": "file:/w"}.get(key, default)})()
    with pytest.warns(UserWarning, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(apart)


def test_tables_are_removed(spark):
    table = materialize(spark.range(3).toDF("a"))
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(path)
    session.drop_table(table)
    assert not files.exists(path)


@pytest.fixture
def hot(spark):
    """Two thirds of the rows share one key."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("o"),
        (F.col("id") * 37 % 101).cast("double").alias("v"),
    )


def test_hot_key_is_reduced_before_it_is_shuffled(spark, hot):
    """Rows that reach the shuffle: one per key and task for the first row, one per key, value and task for modes."""
    reduced = [dedup_keep_first(hot, ["k"], ["o"]), A.group_mode(hot, ["k"], "v"), A.group_sum(hot, ["k"], "v")]
    for df in reduced:
        plan = df._jdf.queryExecution().executedPlan().toString()
        before = plan.split("Exchange hashpartitioning")[-1]
        assert "Partial" in before or "partial_" in before
    assert reduced[0].where("k = 0").first()["o"] == 0
    assert reduced[0].count() == 50


def test_lookup_beyond_the_limit_gives_the_same_rows(spark, hot, monkeypatch):
    lookup = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 50).alias("t"))
    broadcast = enrich_left_join(hot, lookup, "k")
    monkeypatch.setattr(join_lookup, "__defaults__", ("left", 0))
    shuffled = enrich_left_join(hot, lookup, "k")
    assert broadcast.count() == shuffled.count() == 30_000
    assert broadcast.exceptAll(shuffled).count() == 0
