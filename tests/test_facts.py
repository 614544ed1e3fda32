"""Joins and aggregates against plain Python loops."""

from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import facts

LINE = schemas.pick(
    schemas.ORDER_LINE,
    ["order_number", "customer_id", "order_datetime", "product_id", "unit_price", "quantity"],
)
SMALL = dict(max_size=12)
ids = st.sampled_from(["a", "b", "a ", None])
numbers = st.sampled_from([1, 2, None])
line = st.tuples(
    numbers,
    st.sampled_from(["2020-01-02 03:04:05", "someday", None]),
    st.integers(1, 3),
    st.sampled_from([None, 3, 2_000_000_000]),
    ids,
    st.sampled_from([None, 1, 5]),
)


def frames(spark, lines, products, customers):
    order = ["customer_id", "order_datetime", "order_number", "unit_price", "product_id", "quantity"]
    s = spark.createDataFrame(
        [dict(zip(order, row)) for row in lines], LINE
    )
    p = spark.createDataFrame(list(enumerate(products)), "product_key bigint, product_id string")
    c = spark.createDataFrame(list(enumerate(customers)), "customer_key bigint, customer_id bigint")
    return s, p, c


def loops(lines, products, customers):
    for customer, when, number, price, product, quantity in lines:
        for pk, p in enumerate(products):
            for ck, c in enumerate(customers):
                if product is not None and customer is not None and (p, c) == (product, customer):
                    total = None if price is None or quantity is None else price * quantity
                    day = date(2020, 1, 2) if when and when[0] == "2" else None
                    yield (number, ck, pk, day, price, quantity, total), (product, customer)


def total(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


@settings(max_examples=10, deadline=None)
@given(
    st.lists(line, **SMALL),
    st.lists(ids, **SMALL),
    st.lists(numbers, **SMALL),
    st.sampled_from([facts.NO_SALT, facts.Salting(3), facts.Salting(1, [(4, ["a"]), (2, ["b"])])]),
    st.sampled_from([facts.NO_SALT, facts.Salting(2), facts.Salting(2, [(4, [1])])]),
)
def test_against_loops(spark, lines, products, customers, by_product, by_customer):
    s, p, c = frames(spark, lines, products, customers)
    expected = list(loops(lines, products, customers))
    fact = facts.fact_sales_orders(
        s, p, c, product_salting=by_product, customer_salting=by_customer
    )
    assert [f.name for f in fact.schema] == schemas.FACT_SALES_ORDER.names
    assert [f.dataType for f in fact.schema] == [f.dataType for f in schemas.FACT_SALES_ORDER]
    got = [tuple(r) for r in fact.collect()]
    assert sorted(got, key=repr) == sorted((row for row, _ in expected), key=repr)

    groups = {}
    for row, key in expected:
        groups.setdefault(key, []).append(row)
    want = [
        (*key, total(r[5] for r in rows), total(r[6] for r in rows)) for key, rows in groups.items()
    ]
    sales = facts.fact_customer_sales(s, p, c)
    assert [(f.name, f.dataType) for f in sales.schema] == [
        (f.name, f.dataType) for f in schemas.FACT_CUSTOMER_SALES
    ]
    assert sorted((tuple(r) for r in sales.collect()), key=repr) == sorted(want, key=repr)

    by_key = {}
    for row, _ in expected:
        by_key.setdefault(row[1:3], []).append(row)
    want = [(*k, total(r[5] for r in rows), total(r[6] for r in rows)) for k, rows in by_key.items()]
    assert sorted((tuple(r) for r in facts.customer_sales(fact).collect()), key=repr) == sorted(
        want, key=repr
    )


def test_date_name(spark):
    fact = facts.fact_sales_orders(*frames(spark, [], [], []), date_name="order_date")
    assert fact.columns[3] == "order_date"


@pytest.fixture
def stored(spark, tmp_path):
    lines = [(1, "2020-01-02 03:04:05", 1, 3, "a", 1)]
    for name, frame in zip("spc", frames(spark, lines, ["a"], [1])):
        frame.write.parquet(f"{tmp_path}/{name}")
    return [spark.read.parquet(f"{tmp_path}/{name}") for name in "spc"]


def test_aggregate_reads_only_what_it_needs(spark, stored):
    plan = facts.fact_customer_sales(*stored)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "PushedFilters: [IsNotNull(customer_id), IsNotNull(product_id)]" in plan or (
        "PushedFilters: [IsNotNull(product_id), IsNotNull(customer_id)]" in plan
    )
    assert "ReadSchema: struct<customer_id:bigint,product_id:string,unit_price:int,quantity:int>" in plan


def test_aggregate_spreads_hot_keys(spark, hot_lines):
    """A hot pair is one row after partial sums; a hot customer's pairs fill half of the tasks."""
    session, lines, products, customers = hot_lines
    session.conf.set("spark.sql.shuffle.partitions", "64")
    # Customer 7 has half of all lines, with any product, and a pair of it a third of them.
    lines = lines.withColumns(
        {
            "customer_id": F.expr("CASE WHEN order_number % 2 = 0 THEN 7 ELSE customer_id END"),
            "product_id": F.expr("CASE WHEN order_number % 3 = 0 THEN '0' ELSE product_id END"),
        }
    )
    products = products.union(products.where("product_id < '2'"))
    hot = facts.hot_keys(lines, ["product_id", "customer_id"], 64)
    assert [keys for _, keys in hot["customer_id"]] == [[7]]
    salting = {
        "product_salting": facts.Salting(1, hot["product_id"]),
        "customer_salting": facts.Salting(1, hot["customer_id"]),
    }
    want = lines.join(products, "product_id").join(customers, "customer_id")
    want = want.groupBy("product_id", "customer_id").agg(F.sum("quantity").alias("n"))
    want = {(r.product_id, r.customer_id): r.n for r in want.collect()}
    for options in ({}, salting):
        made = facts.fact_customer_sales(lines, products, customers, **options)
        assert {(r.product_id, r.customer_id): r.total_quantity for r in made.collect()} == want
        plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # Sums in part before the first shuffle; after it there are pairs only.
        assert "partial_sum(quantity" in plan and "BroadcastHashJoin" not in plan
    session.conf.set("spark.sql.adaptive.enabled", "false")
    tasks = made.where("customer_id = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 24


def test_aggregate_shuffles_once_with_small_dimensions(spark, stored):
    lines, products, customers = stored
    made = facts.fact_customer_sales(lines, products, customers)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("BroadcastHashJoin") == 2


def test_fact_plan_reads_only_what_it_needs(spark, stored):
    plan = facts.fact_sales_orders(*stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<product_key:bigint,product_id:string>" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


@pytest.fixture
def hot_lines(spark, tmp_path):
    """300,000 lines, a third on one product, in a session that broadcasts nothing."""
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    }.items():
        session.conf.set(name, value)
    session.range(300000, numPartitions=8).selectExpr(
        "id AS order_number",
        "id % 1000 AS customer_id",
        "'2020-01-01 00:00:00' AS order_datetime",
        "CASE WHEN id % 3 = 0 THEN '0' ELSE CAST(id % 5000 AS STRING) END AS product_id",
        "1 AS unit_price",
        "1 AS quantity",
    ).write.parquet(f"{tmp_path}/s")
    lines = session.read.parquet(f"{tmp_path}/s")
    products = session.range(5000).selectExpr("id AS product_key", "CAST(id AS STRING) AS product_id")
    customers = session.range(1000).selectExpr("id AS customer_key", "id AS customer_id")
    return session, lines, products, customers


def test_hot_product_is_split(hot_lines):
    """With a third of the lines on one product, AQE splits its partition."""
    _, lines, products, customers = hot_lines
    fact = facts.fact_sales_orders(lines, products, customers)
    assert len(fact.toArrow()) == 300000
    assert "skewed" in fact._jdf.queryExecution().executedPlan().toString()


def test_hot_keys(spark):
    # 3000 rows; on 12 partitions a share is 250 rows.
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id < 1000 THEN 'hot' WHEN id < 1500 THEN 'warm' WHEN id < 1990 THEN 'mild' "
        "WHEN id < 2900 THEN CAST(id AS STRING) END AS name"
    )
    named = rows.where("name IS NOT NULL").count()
    assert named == 2900
    # hot fills 4.1 partitions, warm 2.07 and mild 2.03.
    assert facts.hot_keys(rows, ["name"], 12) == {"name": [(4, ["mild", "warm"]), (8, ["hot"])]}
    assert facts.hot_keys(rows, ["name"], 1) == {"name": []}
    assert facts.hot_keys(rows.where("false"), ["name"], 12) is None
    both = rows.withColumn("other", F.lit(7)).union(rows.selectExpr("NULL", "NULL"))
    assert facts.hot_keys(both, ["name", "other"], 12) == {
        "name": [(4, ["mild", "warm"]), (8, ["hot"])],
        "other": [(16, [7])],
    }


def test_salts_spread_a_hot_key(spark):
    salting = {"product_id": facts.Salting(1, [(8, ["hot"])])}
    lines = spark.range(8000).selectExpr("id", "'hot' AS product_id")
    parts = facts._join_input(lines, salting, spread=True).groupBy("_product_id_salt").count()
    assert parts.count() == 8
    assert all(800 < r["count"] < 1200 for r in parts.collect())
    products = spark.createDataFrame([("hot",), ("cold",)], "product_id string")
    copies = facts._join_input(products, salting, spread=False).groupBy("product_id").count()
    assert {r.product_id: r["count"] for r in copies.collect()} == {"hot": 8, "cold": 1}


def test_late_rows_leave_the_join_state(spark, tmp_path):
    """With a bound on lateness, rows behind the watermark are removed from the state."""
    shapes = {
        "s": T.StructType([*LINE.fields, T.StructField("at", T.TimestampType())]),
        "p": T.StructType.fromDDL("product_key bigint, product_id string, at timestamp"),
        "c": T.StructType.fromDDL("customer_key bigint, customer_id bigint, at timestamp"),
    }
    day = lambda n: datetime(2024, 1, n)

    def send(n, line, product, customer):
        for name, rows in (("s", line), ("p", product), ("c", customer)):
            frame = spark.createDataFrame(rows, shapes[name])
            frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    def line(order, when):
        return {"customer_id": 1, "order_number": order, "product_id": "a", "unit_price": 2, "quantity": 3, "at": when}

    def run():
        frames = [spark.readStream.schema(shapes[n]).parquet(f"{tmp_path}/{n}") for n in "spc"]
        fact = facts.fact_sales_orders(*frames, late=facts.Lateness("at", "1 hour", "2 hours"))
        query = (
            fact.writeStream.format("parquet")
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .option("path", f"{tmp_path}/out")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sum(o["numRowsRemoved"] for p in query.recentProgress for o in p["stateOperators"])

    send(1, [line(1, day(1))], [(1, "a", day(1))], [(1, 1, day(1))])
    run()
    send(2, [line(2, day(3)), line(3, day(1))], [(2, "a", day(3))], [(2, 1, day(3))])
    removed = run()
    send(3, [line(4, day(5)), line(5, day(1))], [(3, "a", day(5))], [(3, 1, day(5))])
    removed += run()
    assert removed > 0
    got = spark.read.parquet(f"{tmp_path}/out").select("order_number", "product_key", "customer_key")
    got = sorted(map(tuple, got.collect()))
    # Each line meets the versions of its own day; order 5 comes too late.
    assert got == [(1, 1, 1), (2, 2, 2), (3, 1, 1), (4, 3, 3)]
