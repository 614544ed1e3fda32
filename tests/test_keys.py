"""Surrogate keys."""

import os

from pyspark.sql import functions as F

from tidemark.operators.keys import assign_keys


def test_arrival_order_is_gap_free_and_not_shuffled(spark):
    rows = spark.range(0, 1000, numPartitions=7)
    keyed = assign_keys(rows, "key", start=50)
    got = keyed.orderBy("key").collect()
    assert [r.key for r in got] == list(range(51, 1051))
    assert [r.id for r in got] == list(range(1000))
    assert keyed.columns == ["key", "id"]


def test_given_order(spark):
    rows = spark.range(0, 5000, numPartitions=5).select((F.lit(4999) - F.col("id")).alias("n"))
    got = assign_keys(rows, "key", order_by=["n"]).collect()
    assert sorted((r.key, r.n) for r in got) == [(n + 1, n) for n in range(5000)]


def test_hot_and_equal_rows_spread_over_ranges(spark):
    # A third of all rows are copies of one row.
    copies = spark.range(20000).select(F.lit("hot").alias("name"))
    others = spark.range(40000).select(F.concat(F.lit("n"), "id").alias("name"))
    staging = f"{spark.conf.get('spark.checkpoint.dir')}/hot"
    keyed = assign_keys(copies.union(others), "key", order_by=["name"], staging=staging)
    assert keyed.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first() == (1, 60000, 60000)
    hot = keyed.where("name = 'hot'").agg(F.min("key"), F.max("key"), F.count("key")).first()
    assert hot[2] == 20000 and hot[1] - hot[0] == 19999
    # AQE may merge small ranges, so ask for the split without it.
    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")
    plain.conf.set("spark.sql.shuffle.partitions", "6")
    stored = plain.read.parquet(f"{staging}/ordered")
    parts = (
        stored.repartitionByRange("name", "_part", "_position")
        .where("name = 'hot'")
        .groupBy(F.spark_partition_id())
        .count()
        .collect()
    )
    assert len(parts) >= 2
    assert max(r["count"] for r in parts) < 15000


def test_no_rows(spark):
    assert assign_keys(spark.range(0), "key", order_by=["id"]).count() == 0


def test_offsets_are_the_only_broadcast(spark):
    plan = assign_keys(spark.range(100), "key", order_by=["id"])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("BroadcastExchange") == 1
    assert "Python" not in text


def test_one_write_for_stable_input(spark, tmp_path):
    """Rows read from files are sorted and written once; of two writes one is removed."""
    spark.range(3000).selectExpr("id % 7 AS n", "'x' AS same").write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    for stable in (True, False):
        staging = f"{tmp_path}/stable-{stable}"
        keyed = assign_keys(rows, "key", order_by=["n"], staging=staging, stable_input=stable)
        got = [(r.key, r.n) for r in keyed.orderBy("key").collect()]
        assert [k for k, _ in got] == list(range(1, 3001))
        assert [n for _, n in got] == sorted(n for _, n in got)
        assert os.listdir(staging) == ["ordered"]
