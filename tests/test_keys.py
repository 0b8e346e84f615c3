import re

from pyspark.sql import functions as F

from shelfline.operators.dims import dim_store
from shelfline.operators.keys import dense_key

from .conftest import plan_of
from .fixtures import retailers, stores


def numbered(df, order_by):
    return [tuple(r) for r in dense_key(df, order_by, "key").orderBy("key").collect()]


def test_keys_are_dense_and_in_order(spark, settings):
    # Without merging of small partitions the ranges really are spread over several tasks.
    settings(adaptive__coalescePartitions__enabled="false")
    df = spark.range(5000).select(F.concat(F.lit("P"), (F.col("id") * 7919 % 5000).cast("string")).alias("p"))
    got = numbered(df, ["p"])
    assert [key for key, _ in got] == list(range(1, 5001))
    assert [p for _, p in got] == sorted(f"P{i}" for i in range(5000))


def test_copies_of_one_key_are_spread_and_numbered_the_same_each_time(spark, settings):
    settings(adaptive__coalescePartitions__enabled="false")
    hot = F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id"))
    df = spark.range(3000).select(hot.alias("k"), F.col("id").alias("attribute"))
    got = numbered(df.repartition(5), ["k"])
    expected = sorted((500 if i % 3 == 0 else i, i) for i in range(3000))
    assert got == [(n, *row) for n, row in enumerate(expected, 1)]
    ranges = dense_key(df, ["k"], "key").select(F.spark_partition_id().alias("part"), "k")
    assert ranges.filter("k = 500").select("part").distinct().count() > 1


def test_no_task_holds_the_table(spark):
    df = dense_key(spark.range(1000).withColumnRenamed("id", "k"), ["k"], "key")
    plan = plan_of(df)
    # The rows are read and numbered in place. Only their count per range is brought together.
    assert "Join" not in plan and "Exchange" not in plan.split("Subquery")[0]
    assert plan.count("+- Window") == plan.count("SinglePartition") == 1


def test_a_small_numbered_dimension_is_broadcast(spark):
    dim = dense_key(spark.range(5000).select(F.col("id").alias("k"), F.lit("a").alias("x")), ["k"], "key")
    sales = spark.range(0, 5_000_000).select((F.col("id") % 5000).alias("k"))
    assert re.search(r"BroadcastHashJoin[^\n]*BuildRight", plan_of(sales.join(dim, "k")))


def test_empty_table(spark):
    assert numbered(spark.createDataFrame([], "p STRING"), ["p"]) == []


def test_general_trade_is_numbered_after_modern_trade(spark):
    dim = dim_store(stores(spark, "Z1", "Z2"), retailers(spark, "A2", "A1"))
    rows = {r.store_id: r for r in dim.collect()}
    assert {i: r.store_key for i, r in rows.items()} == {"Z1": 1, "Z2": 2, "A1": 3, "A2": 4}
    assert rows["Z1"].store_type == "Modern Trade" and rows["Z1"].distributor_id is None
    assert rows["A1"].store_type == "Kiosk" and rows["A1"].chain is None


def test_general_trade_starts_at_one_without_modern_trade(spark):
    dim = dim_store(stores(spark, "Z").filter("false"), retailers(spark, "A", "B"))
    assert sorted(r.store_key for r in dim.collect()) == [1, 2]
