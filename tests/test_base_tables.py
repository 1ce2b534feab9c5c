"""Base tables: joins in buckets of some of their keys, and stored without a shuffle."""

import pytest
from pyspark.sql import functions as F

from farelens import bindings as B
from farelens.operators import prep
from farelens.operators.joins import Bucketed, co_joined
from farelens.registry import base
from farelens.session import co_located
from farelens.sources import stored as stored_module
from farelens.sources.stored import stored, stored_buckets


def _rows(n, step):
    return lambda spark, d: spark.range(n).select(
        F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 31 != 0, F.concat(
            F.lit("k"), (F.col("id") % 200).cast("string"))).alias("k"),
        (F.col("id") % step).alias("a"), F.col("id"))


@pytest.fixture
def tables(spark, tmp_path_factory):
    builds = {"one": _rows(900, 7), "two": _rows(300, 7), "three": _rows(200, 5)}
    found = stored_buckets(builds, ("k",), spark, str(tmp_path_factory.mktemp("b")))
    two, three = (found[n].map(lambda df, n=n: df.groupBy("k", "a").agg(F.max("id").alias(n)))
                  for n in ("two", "three"))
    plain = [build(spark, "") for build in builds.values()]
    return found["one"], two, three, plain


def _twice(one, two, three):
    first = co_joined(one, two, "inner", ["id"], ["k", "a"])
    return co_joined(first, three, "left", ["id"], ["a", "k"])


def test_two_joins_in_a_row_equal_plain_joins(spark, tables):
    one, two, three, (left, right, last) = tables
    want = left.join(right.groupBy("k", "a").agg(F.max("id").alias("two")), ["k", "a"]).join(
        last.groupBy("k", "a").agg(F.max("id").alias("three")), ["k", "a"], "left")
    with co_located(spark):
        got = _twice(one, two, three).rows().select(*want.columns)
        assert one.hot.count() == 225
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_buckets_of_some_keys_meet_without_a_shuffle(spark, tables):
    cold = [Bucketed(("k",), table.cold) for table in tables[:3]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with co_located(spark):
            plan = _twice(*cold).rows()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_must_hold_those_of_the_buckets(tables):
    with pytest.raises(ValueError, match="same buckets"):
        co_joined(tables[0], tables[1], "inner", ["id"], ["a"])


def test_a_frame_out_of_a_join_is_stored_as_it_is(spark, tmp_path, monkeypatch):
    plans, write = [], stored_module.write_table

    def seen(df, *args, **how):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *args, **how)

    monkeypatch.setattr(stored_module, "write_table", seen)
    for even in (True, False):
        stored(f"t{even}", _rows(50, 3), spark, str(tmp_path), even=even)
    assert "Exchange" in plans[0] and "Exchange" not in plans[1]


def test_extracts_share_one_table_in_buckets(spark, tmp_path, monkeypatch):
    """Sales, trips and loyalty records are the same line items; rows at the border of a year and
    without a day are as in the plain extracts."""
    d = str(tmp_path)
    spark.range(400).selectExpr(
        "id AS l_orderkey", "id % 37 AS l_partkey", "id % 41 AS l_suppkey", "1 AS l_linenumber",
        "5D AS l_quantity", "100D AS l_extendedprice", "0.1D AS l_discount", "0.2D AS l_tax",
        "'N' AS l_returnflag", "'b' AS p_brand", "'LARGE' AS p_type", "3 AS p_size",
        "9D AS p_retailprice", "'O' AS o_orderstatus", "'2-HIGH' AS o_orderpriority",
        "id % 5 AS c_custkey", "'c' AS c_name", "'BUILDING' AS c_mktsegment",
        "IF(id % 3 = 0, 'ASIA', IF(id % 7 = 0, NULL, 'AFRICA')) AS ORIGEN",
        "IF(id % 2 = 0, 'AFRICA', 'AMERICA') AS DESTINO",
        "IF(id % 11 = 0, NULL, date_add(DATE'1995-12-28', CAST(id % 8 AS INT))) AS FECHA_CORRIDA",
        "date_add(DATE'1995-12-28', CAST(id % 8 - id % 5 AS INT)) AS FECHA_OPERACION",
    ).write.parquet(f"{d}/star")
    monkeypatch.setattr(B, "_joined_star", lambda s, x: s.read.parquet(f"{x}/star"))
    written, write = [], stored_module._written
    monkeypatch.setattr(stored_module, "_written", lambda *a: written.append(a[1]) or write(*a))
    for got, want in ((base.sales, base.extracted_sales), (base.trips, base.extracted_trips),
                      (base.loyalty, base.extracted_loyalty)):
        rows = got(spark, d).collect()
        assert rows and sorted(map(str, rows)) == sorted(map(str, want(spark, d).collect()))
    assert written == ["lines"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with co_located(spark):
            found = {name: Bucketed(x.keys, x.cold)
                     for name, x in base.by_route_day(spark, d).items()}
            plan = prep.co_join_loyalty(prep.co_join_trips(
                found["sales"], found["trips"]), found["loyalty"]).rows()
            assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _lines(spark, path):
    spark.range(300).selectExpr(
        "id", "IF(id % 3 = 0, 'ASIA', 'AFRICA') AS ORIGEN",
        "IF(id % 2 = 0, 'AFRICA', 'AMERICA') AS DESTINO",
        "date_add(DATE'1995-12-28', CAST(id % 8 AS INT)) AS FECHA_CORRIDA",
        "date_add(DATE'1995-12-28', CAST(id % 8 - id % 5 AS INT)) AS FECHA_OPERACION",
    ).write.parquet(path)
    return lambda s, x: s.read.parquet(path)


def test_lines_of_the_routes_do_without_the_whole_star(spark, tmp_path, monkeypatch):
    """Only these line items are written, unless the star is there; the rows are the same."""
    monkeypatch.setattr(B, "_joined_star", _lines(spark, str(tmp_path / "star")))
    written, write = [], stored_module.write_table
    monkeypatch.setattr(stored_module, "write_table",
                        lambda df, *a, **how: written.append(df.count()) or write(df, *a, **how))
    first = sorted(map(str, B.route_lines(spark, str(tmp_path / "a")).collect()))
    assert 0 < len(first) < 300 and written == [len(first)]
    stored("star", B._joined_star, spark, str(tmp_path / "b"), even=False)
    assert sorted(map(str, B.route_lines(spark, str(tmp_path / "b")).collect())) == first
    assert written == [len(first), 300]


def test_routes_are_chosen_before_the_parts_are_joined(spark, tmp_path, monkeypatch):
    """Line items of other routes are not shuffled for their part."""
    d, seen = str(tmp_path), {}
    for name, columns in B.TABLES.items():
        spark.createDataFrame([], columns).write.parquet(f"{d}/{name}.parquet")
    monkeypatch.setattr(B, "stored", lambda name, build, s, x, **how: seen.setdefault(
        name, build(s, x)))
    B.route_lines(spark, d)
    plan = seen["route_lines"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("p_partkey") < plan.index("AFRICA-AMERICA") < plan.index("o_orderkey")
