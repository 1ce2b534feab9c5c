"""Joins with hot keys, checked against plain joins."""

import pytest
from pyspark.sql import functions as F

from farelens.operators.joins import Bucketed, co_join, hot_keys, hot_share, spread_join
from farelens.session import shared_dir
from farelens.sources.stored import stored_buckets


@pytest.fixture
def skewed(spark):
    """A third of the rows share key 'hot', another part has no key."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(
            F.lit("k"), (F.col("id") % 1500).cast("string"))).alias("k"))


@pytest.fixture
def right(spark):
    keys = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 1500, 2)] + [(None, 9)]
    return spark.createDataFrame(keys, "k string, v int")


def test_hot_key_is_found(spark, skewed):
    found = skewed.select(hot_keys(skewed, ["k"], 0.005).alias("h")).first()["h"]
    hot = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert hot in found and len(found) <= 200


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, right, how):
    want = skewed.join(right, ["k"], how)
    got = spread_join(skewed, right, ["k"], how, ["id"]).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_key_reaches_every_slice(spark, skewed, right):
    joined = spread_join(skewed, right, ["k"], "left", ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct()
        assert parts.count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_of_a_hot_key_are_repeated_by_its_share(spark, skewed, right):
    """A key with a third of the rows and a share of 1/9 gets three slices, not all."""
    joined = spread_join(skewed, right, ["k"], "inner", ["id"], share=0.111)
    repeated = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence(0" in repeated
    hot = spread_join(spark.range(9).withColumn("k", F.lit("hot")), right, ["k"], "inner", ["id"],
                      sample=skewed, share=0.111)
    assert hot.count() == 18


@pytest.fixture
def buckets(spark, tmp_path_factory):
    """Two tables in the same buckets, one of their keys hot."""
    left = lambda s, d: s.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 1500).cast("string"))).alias("k"))
    right = lambda s, d: s.range(1600).select(F.when(F.col("id") > 1597, "hot").when(
        F.col("id") > 1590, None).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias(
        "k"), F.col("id").alias("v"))
    name = str(tmp_path_factory.mktemp("b"))
    return stored_buckets({"l": left, "r": right}, ("k",), spark, name), left(spark, 0), right(spark, 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_buckets_join_like_plain_tables(buckets, how):
    found, left, right = buckets
    want = left.join(right, ["k"], how)
    got = co_join(found["l"], found["r"], how, ["id"]).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert found["l"].hot.select("k").distinct().collect() == [("hot",)]
    assert found["l"].rows().count() == 3000 and found["r"].rows().count() == 1600


def test_buckets_meet_without_a_shuffle(spark, buckets):
    found, *_ = buckets
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grouped = found["r"].map(lambda df: df.groupBy("k").agg(F.max("v").alias("v")))
        for right in (found["r"], grouped):
            cold = co_join(Bucketed(("k",), found["l"].cold), Bucketed(("k",), right.cold), "left",
                           ["id"])
            plan = cold._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_of_other_buckets_are_refused(buckets):
    found, left, _ = buckets
    with pytest.raises(ValueError, match="same buckets"):
        co_join(found["l"], Bucketed(("id",), left), "inner", ["id"])


def test_right_and_full_joins_are_refused(skewed, right):
    with pytest.raises(ValueError):
        spread_join(skewed, right, ["k"], "full", ["id"])


def test_hot_share_follows_the_partitions():
    assert hot_share(4) == 1 / 16 and hot_share(10 ** 6) == 1 / 2000


def test_shared_folder_is_needed_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        shared_dir(Session())
