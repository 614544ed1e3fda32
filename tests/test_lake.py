"""Datasets as streams: restarts, retries, late rows, refreshes, options."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import facts
from tidemark.plans.retail import retail_datasets
from tidemark.session import own_session, short_shuffles, stream_settings
from tidemark.sources.bus import CAPTURED_TABLES, message_stream
from tidemark.streaming import files
from tidemark.streaming.lake import JOINED, KEYED, RECOMPUTED, Dataset, Lake, conform

SMALL = {"spark.sql.shuffle.partitions": "2"}


class Bus:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        for table in CAPTURED_TABLES:
            self.send(table)

    def send(self, table, *afters):
        rows = [
            (None, None if a is None else json.dumps({"payload": {"after": a}}).encode())
            for a in afters
        ]
        frame = self.spark.createDataFrame(rows, "key binary, value binary")
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/bus/{table}")

    def order(self, number, product, customer=1, price=3):
        products = json.dumps([{"id": product, "price": price, "qty": 2}])
        self.send(
            "sales_orders",
            {
                "order_number": number,
                "customer_id": customer,
                "order_datetime": "1534928698",
                "ordered_products": products,
            },
        )

    def lake(self, database, settings=SMALL, **options):
        sources = {
            t: (lambda s, t=t: message_stream(s, "parquet", {}, path=f"{self.root}/bus/{t}"))
            for t in CAPTURED_TABLES
        }
        datasets = retail_datasets(sources, **{"product_salt": 2, "customer_salt": 2, **options})
        return Lake(self.spark, f"{self.root}/lake", database, datasets, settings=settings)


@pytest.fixture
def bus(spark, tmp_path):
    return Bus(spark, str(tmp_path))


def measured(lake):
    return json.loads(files.read_text(lake.spark, lake._pinned_path("fact_sales_orders")))["measured"]


def numbers(lake):
    rows = lake.read("fact_sales_orders").collect()
    return sorted((r.order_number, r.product_key, r.customer_key) for r in rows)


def test_retail_story(bus, database):
    """One bus through six updates, each with a lake object of its own."""
    # A line comes before its product and its customer.
    bus.order(1, "a")
    bus.lake(database).update()
    assert numbers(bus.lake(database)) == []
    # All lines on one key fill both of the two partitions.
    hot = {"hot_products": [[2, ["a"]]], "hot_customers": [[2, [1]]]}
    assert measured(bus.lake(database)) == hot

    bus.send("products", {"product_id": "a"}, {"product_id": "b"})
    bus.send("customers", {"customer_id": 1})
    bus.lake(database).update()
    assert numbers(bus.lake(database)) == [(1, 1, 1)]

    # Nothing new: nothing is added, also where the catalog has been lost.
    bus.spark.sql(f"DROP DATABASE {database} CASCADE")
    bus.lake(database).update()
    assert numbers(bus.lake(database)) == [(1, 1, 1)]

    # A second version of the product gives the line again; deletes add nothing.
    bus.send("products", {"product_id": "a", "product_name": "new"}, None)
    bus.send("customers", None)
    bus.lake(database).update()
    assert numbers(bus.lake(database)) == [(1, 1, 1), (1, 3, 1)]

    # A new line meets both versions.
    bus.order(2, "a", price=5)
    lake = bus.lake(database)
    lake.update()
    assert numbers(lake) == [(1, 1, 1), (1, 3, 1), (2, 1, 1), (2, 3, 1)]
    (sales,) = lake.read("fact_customer_sales").collect()
    assert tuple(sales) == ("a", 1, 8, 32)
    batch = facts.fact_sales_orders(
        *[lake.read(n) for n in ("sales_orders_cleansed", "dim_products", "dim_customers")]
    )
    assert sorted(batch.collect()) == sorted(lake.read("fact_sales_orders").collect())
    by_key = facts.customer_sales(batch)
    assert sorted(by_key.collect()) == sorted(lake.read("customer_sales").collect())

    # A full refresh keeps guarded raw rows and builds the rest again.
    raw_files = set(files.child_names(lake.spark, lake._path("sales_orders_raw")))
    lake.refresh(full=True)
    assert set(files.child_names(lake.spark, lake._path("sales_orders_raw"))) == raw_files
    assert len(numbers(lake)) == 4
    keys = [r.product_key for r in lake.read("dim_products").collect()]
    assert sorted(keys) == [1, 2, 3]


def test_many_micro_batches(bus, database):
    """Bounded reads give the same rows, however the batches fall."""
    for number in range(4):
        bus.order(number, "ab"[number % 2])
    bus.send("products", {"product_id": "b"})
    bus.send("products", {"product_id": "a"})
    bus.send("customers", {"customer_id": 1})
    lake = bus.lake(database, read_options={"maxFilesPerTrigger": "1"})
    lake.update()
    keys = {r.product_id: r.product_key for r in lake.read("dim_products").collect()}
    assert sorted(keys.values()) == [1, 2]
    assert numbers(lake) == [(n, keys["ab"[n % 2]], 1) for n in range(4)]


def test_two_join_state_operators(spark, tmp_path):
    shapes = {
        "s": schemas.ORDER_LINE,
        "p": schemas.DIM_PRODUCT,
        "c": schemas.DIM_CUSTOMER,
    }
    frames = []
    for name, shape in shapes.items():
        spark.createDataFrame([], shape).write.parquet(f"{tmp_path}/{name}")
        frames.append(spark.readStream.schema(shape).parquet(f"{tmp_path}/{name}"))
    fact = facts.fact_sales_orders(
        *frames,
        product_salting=facts.Salting(2),
        customer_salting=facts.Salting(1, [(2, [7])]),
    )
    query = (
        fact.writeStream.format("noop")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    operators = [o["operatorName"] for o in query.lastProgress["stateOperators"]]
    assert operators == ["symmetricHashJoin"] * 2


def test_pinned_settings_may_not_change_under_a_checkpoint(spark, tmp_path, database):
    spark.range(3).select(F.col("id").alias("n")).write.parquet(f"{tmp_path}/in")

    def lake(salt):
        dataset = Dataset("kept", source(spark, f"{tmp_path}/in"), pinned={"salt": salt})
        return Lake(spark, f"{tmp_path}/lake", database, [dataset], settings=SMALL)

    lake(2).update()
    with pytest.raises(ValueError, match="full refresh"):
        lake(3).update()
    lake(3).refresh(full=True)
    assert lake(3).read("kept").count() == 3


def test_catalog_entries(bus, database, spark):
    lake = bus.lake(database)
    lake.update()
    detail = {
        r.col_name: r.data_type
        for r in spark.sql(f"DESCRIBE EXTENDED {database}.dim_products").collect()
    }
    assert detail["Comment"] == "Product dimension"
    assert "quality=gold" in detail["Table Properties"]
    assert "trigger.interval=60 seconds" in detail["Table Properties"]
    guarded = spark.sql(f"SHOW TBLPROPERTIES {database}.sales_orders_raw").collect()
    assert {r.key: r.value for r in guarded}["reset.allowed"] == "false"
    assert lake.read("dim_products").schema == schemas.DIM_PRODUCT
    assert spark.sql(f"SELECT * FROM {database}.fact_sales_orders LIMIT 5").count() == 0


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, database):
    dataset = Dataset(
        "d", lambda s: None, kind=KEYED, key="k", order_by=["v"],
        schema=schemas.struct(k=schemas.LONG, v=schemas.STRING),
    )
    lake = Lake(spark, str(tmp_path), database, [dataset])
    files.make_folder(spark, lake._path("d"))
    write = lake._keyed_batch(dataset)
    first = spark.createDataFrame([("b",), ("a",)], "v string")
    second = spark.createDataFrame([("c",)], "v string")
    write(first, 0)
    write(spark.createDataFrame([], "v string"), 1)
    write(second, 2)
    before = sorted(lake._files(spark.read, "d").collect())
    assert [tuple(r) for r in before] == [(1, "a"), (2, "b"), (3, "c")]
    write(second, 2)
    write(first, 0)
    assert sorted(lake._files(spark.read, "d").collect()) == before
    assert files.child_names(spark, f"{tmp_path}/staging") == []


def test_lost_checkpoint_is_noticed(spark, tmp_path, database):
    spark.range(3).select(F.col("id").alias("n")).write.parquet(f"{tmp_path}/in")
    dataset = Dataset(
        "d", source(spark, f"{tmp_path}/in"), kind=KEYED, key="k",
        schema=schemas.struct(k=schemas.LONG, n=schemas.LONG),
    )
    lake = Lake(spark, f"{tmp_path}/lake", database, [dataset], settings=SMALL)
    lake.update()
    files.delete(spark, lake._checkpoint("d"))
    with pytest.raises(ValueError, match="no checkpoint"):
        lake.update()


def source(spark, path):
    return lambda s: message_stream(
        s, "parquet", {}, path=path, schema=schemas.struct(n=schemas.LONG)
    )


def test_temporary_and_sql_datasets(spark, tmp_path, database):
    spark.range(5).select(F.col("id").alias("n")).write.parquet(f"{tmp_path}/in")
    datasets = [
        Dataset("arrivals", source(spark, f"{tmp_path}/in"), temporary=True),
        Dataset(
            "numbered", "SELECT n FROM arrivals WHERE n > 0", ["arrivals"], kind=KEYED, key="id",
            order_by=["n"], schema=schemas.struct(id=schemas.LONG, n=schemas.LONG), temporary=True,
        ),
        Dataset("doubled", "SELECT id, n * 2 AS n FROM numbered", ["numbered"]),
        Dataset(
            "largest", lambda s, d: d.agg(F.max("n").alias("n")), ["doubled"], kind=RECOMPUTED,
            temporary=True,
        ),
        Dataset("again", "SELECT n + 1 AS n FROM largest", ["largest"], kind=RECOMPUTED),
    ]
    lake = Lake(spark, f"{tmp_path}/lake", database, datasets, settings=SMALL)
    for _ in range(3):
        lake.update()
        assert [r.n for r in lake.read("again").collect()] == [9]
    got = sorted(tuple(r) for r in lake.read("doubled").collect())
    assert got == [(i, 2 * i) for i in range(1, 5)]
    names = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    assert names == {"doubled", "again"}
    assert len(files.child_names(spark, lake._path("again"))) == 2


def test_continuous_run(spark, tmp_path, database):
    spark.range(3).select(F.col("id").alias("n")).write.parquet(f"{tmp_path}/in")
    dataset = Dataset("copied", source(spark, f"{tmp_path}/in"), trigger="1 seconds")
    lake = Lake(spark, f"{tmp_path}/lake", database, [dataset], settings=SMALL)
    (query,) = lake.start()
    try:
        query.processAllAvailable()
        spark.range(3, 5).select(F.col("id").alias("n")).write.mode("append").parquet(
            f"{tmp_path}/in"
        )
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.n for r in lake.read("copied").collect()) == [0, 1, 2, 3, 4]


def test_declared_schema(spark):
    rows = spark.createDataFrame([(1, "2")], "a int, b string")
    cast = conform(rows, schemas.struct(b=schemas.LONG, a=schemas.STRING))
    assert [tuple(r) for r in cast.collect()] == [(2, "1")]
    assert cast.columns == ["b", "a"]
    for declared in (schemas.struct(a=schemas.LONG), schemas.struct(a=schemas.LONG, c=schemas.LONG)):
        with pytest.raises(ValueError):
            conform(rows, declared)


def test_dataset_lists_are_checked(spark, tmp_path, database):
    a, b = Dataset("a", "SELECT 1"), Dataset("b", "SELECT * FROM a", ["a"])
    with pytest.raises(ValueError, match="before it"):
        Lake(spark, str(tmp_path), database, [b, a])
    with pytest.raises(ValueError, match="repeat"):
        Lake(spark, str(tmp_path), database, [a, a])
    with pytest.raises(ValueError, match="kind"):
        Dataset("c", "SELECT 1", kind="table")
    with pytest.raises(ValueError, match="key"):
        Dataset("c", "SELECT 1", kind=KEYED)
    with pytest.raises(ValueError, match="schema"):
        Dataset("c", "SELECT 1", kind=KEYED, key="k")


def test_lake_leaves_the_session_alone(spark, tmp_path, database):
    before = {r.key: r.value for r in spark.sql("SET").collect()}
    lake = Lake(spark, str(tmp_path), database, [])
    after = {r.key: r.value for r in spark.sql("SET").collect()}
    assert before == after
    assert lake.session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in lake.session.conf.get("spark.sql.streaming.stateStore.providerClass")


def spread_of(lake, key, value):
    """Over how many salts the lake's join spreads a key."""
    hot = dict(measured(lake))[key]
    return max((n for n, keys in hot if value in keys), default=1)


def test_hot_key_after_an_empty_first_update(bus, database):
    lake = bus.lake(database)
    lake.update()
    assert files.read_text(lake.spark, lake._pinned_path("fact_sales_orders")) is None
    assert lake.read("fact_sales_orders").count() == 0
    for number in range(20):
        bus.order(number, "a", customer=number)
    bus.send("products", {"product_id": "a"})
    bus.send("customers", *({"customer_id": n} for n in range(20)))
    lake.update()
    assert spread_of(lake, "hot_products", "a") == 2
    assert len(numbers(lake)) == 20


def test_start_measures_what_is_there(bus, database):
    for number in range(20):
        bus.order(number, "a", customer=number)
    bus.send("products", {"product_id": "a"})
    bus.send("customers", *({"customer_id": n} for n in range(20)))
    lake = bus.lake(database)
    queries = lake.start()
    try:
        assert spread_of(lake, "hot_products", "a") == 2
        assert len(numbers(lake)) == 20
    finally:
        for query in queries:
            query.stop()


def test_rebuild_measures_anew(bus, database):
    bus.order(1, "b", customer=1)
    bus.order(2, "c", customer=2)
    bus.send("products", {"product_id": "a"}, {"product_id": "b"}, {"product_id": "c"})
    bus.send("customers", *({"customer_id": n} for n in range(30)))
    lake = bus.lake(database, settings={"spark.sql.shuffle.partitions": "4"})
    lake.update()
    assert spread_of(lake, "hot_products", "a") == 1
    for number in range(3, 30):
        bus.order(number, "a", customer=number)
    lake.update()
    before = numbers(lake)
    with pytest.raises(ValueError, match="read by other streams"):
        lake.rebuild("dim_products")
    lake.rebuild("fact_sales_orders")
    assert spread_of(lake, "hot_products", "a") == 4
    assert numbers(lake) == before and len(before) == 29
    assert lake.read("customer_sales").count() == 29


def test_start_stops_together(spark, tmp_path, database):
    spark.range(3).write.parquet(f"{tmp_path}/in")

    def broken(session):
        raise RuntimeError("no such source")

    datasets = [Dataset("good", source(spark, f"{tmp_path}/in")), Dataset("bad", broken)]
    lake = Lake(spark, f"{tmp_path}/lake", database, datasets, settings=SMALL)
    with pytest.raises(RuntimeError):
        lake.start()
    assert not [q for q in lake.session.streams.active if q.name == "good"]


def test_changed_schema(spark, tmp_path, database):
    spark.range(3).selectExpr("id AS n").write.parquet(f"{tmp_path}/in")

    def lake(extra, comment, **properties):
        columns = ["n", *extra]
        kept = Dataset(
            "kept",
            lambda s: source(spark, f"{tmp_path}/in")(s).selectExpr(*columns),
            comment=comment,
            properties=properties,
        )
        summed = Dataset(
            "summed", lambda s, rows: rows.selectExpr(*columns), ["kept"], kind=RECOMPUTED, comment=comment,
            properties=properties,
        )
        return Lake(spark, f"{tmp_path}/lake", database, [kept, summed], settings=SMALL)

    def described(name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").collect()
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{name}").collect()}
        return next(r.data_type for r in rows if r.col_name == "Comment"), properties

    lake([], "one", quality="gold", keeper="a").update()
    lake([], "it's two", quality="silver").update()
    for name in ("kept", "summed"):
        comment, properties = described(name)
        assert comment == "it's two" and properties["quality"] == "silver" and "keeper" not in properties
    with pytest.raises(ValueError, match="full refresh"):
        lake(["n + 1 AS more"], "three").update()
    lake(["n + 1 AS more"], "three").refresh(full=True)
    assert sorted(map(tuple, lake(["n + 1 AS more"], "").read("summed").collect())) == [(0, 1), (1, 2), (2, 3)]


def test_recomputed_table_takes_a_new_column(spark, tmp_path, database):
    def lake(columns):
        dataset = Dataset("table", lambda s: s.range(2).selectExpr(*columns), kind=RECOMPUTED)
        return Lake(spark, f"{tmp_path}/lake", database, [dataset], settings=SMALL)

    lake(["id"]).update()
    lake(["id", "id * 2 AS twice"]).update()
    assert sorted(map(tuple, lake(["id"]).read("table").collect())) == [(0, 0), (1, 2)]


def test_a_failed_version_is_not_the_one_kept(spark, tmp_path, database):
    dataset = Dataset("table", lambda s: s.range(2), kind=RECOMPUTED)
    lake = Lake(spark, f"{tmp_path}/lake", database, [dataset], settings=SMALL)
    lake.update()
    reader = lake.read("table")
    # What a run leaves that dies before the table points to its version.
    spark.range(9).write.parquet(f"{lake._path('table')}/version-000000000001")
    lake.update()
    assert reader.count() == 2 and lake.read("table").count() == 2
    names = sorted(files.child_names(spark, lake._path("table")))
    assert names == ["version-000000000000", "version-000000000002"]


def test_output_partitions_bound_the_files(bus, database):
    for number in range(12):
        bus.order(number, "ab"[number % 2], customer=number)
    bus.send("products", {"product_id": "a"}, {"product_id": "b"})
    bus.send("customers", *({"customer_id": n} for n in range(12)))
    lake = bus.lake(database, output_partitions=1)
    lake.update()
    assert len(numbers(lake)) == 12
    for name in ("sales_orders_cleansed", "fact_sales_orders"):
        found = [f for f in files.child_names(lake.spark, lake._path(name)) if f.endswith(".parquet")]
        assert len(found) == 1


def test_null_rows_in_the_lake(bus, database):
    bus.send("customers", {"customer_id": 1}, None)
    bus.spark.createDataFrame([(None, b'{"payload": {"aft')], "key binary, value binary").write.mode(
        "append"
    ).parquet(f"{bus.root}/bus/customers")
    lake = bus.lake(database, keep_null_rows=True)
    lake.update()
    assert sorted(str(r.customer_id) for r in lake.read("customers_cleansed").collect()) == ["1", "None", "None"]


def test_joined_rows_in_any_order(spark, tmp_path, database):
    """Each combination once, however rows of three inputs come."""
    root = f"{tmp_path}/a b%20c"
    bus = Bus(spark, root)
    steps = [
        lambda: bus.order(1, "a"),
        lambda: bus.send("customers", {"customer_id": 1}),
        lambda: (bus.order(2, "b"), bus.send("products", {"product_id": "a"})),
        lambda: (
            bus.order(3, "a"),
            bus.send("products", {"product_id": "a"}, {"product_id": "b"}),
            bus.send("customers", {"customer_id": 1}),
        ),
    ]
    for step in steps:
        step()
        lake = bus.lake(database)
        lake.update()
        lines, products, customers = (
            lake.read(n) for n in ("sales_orders_cleansed", "dim_products", "dim_customers")
        )
        want = lines.join(products, "product_id").join(customers, "customer_id")
        want = want.select("order_number", "product_key", "customer_key").collect()
        assert numbers(lake) == sorted(map(tuple, want))
    assert len(want) == 2 * 2 + 2 + 2 * 2


def test_fact_has_no_state_beside_the_tables(spark, tmp_path, database):
    """Its batches join stored files; one that runs again, written or not, comes once."""
    bus = Bus(spark, str(tmp_path))
    for number in (1, 2):
        bus.order(number, "a")
        bus.send("products", {"product_id": "a"})
        bus.send("customers", {"customer_id": 1})
        lake = bus.lake(database)
        lake.update()
    before = numbers(lake)
    assert len(before) == 2 * 2 * 2
    assert not files.exists(spark, f"{lake._checkpoint('fact_sales_orders')}/state")

    folder = f"{lake._checkpoint('fact_sales_orders')}/commits"
    last = max(int(n) for n in files.child_names(spark, folder) if n.isdigit())
    for written in (True, False):
        files.delete(spark, f"{folder}/{last}")
        if not written:
            for end in ("", ".parquet"):
                files.delete(spark, f"{lake._path('fact_sales_orders')}/batch-{last:012d}{end}")
        lake = bus.lake(database)
        lake.update()
        assert numbers(lake) == before


def test_joined_batch_trusts_the_tables(spark, tmp_path, database):
    """A batch joins every file its inputs list and none twice, whatever the stream tells of them."""
    bus = Bus(spark, str(tmp_path))
    bus.order(1, "a")
    bus.send("products", {"product_id": "a"})
    bus.send("customers", {"customer_id": 1})
    lake = bus.lake(database)
    lake.update()
    before = numbers(lake)
    assert len(before) == 1
    write = lake._joined_batch(lake.datasets["fact_sales_orders"], {})
    nothing = spark.createDataFrame([], "input string")
    write(nothing, 7)
    assert numbers(lake) == before
    files.delete(spark, lake._notes_path("fact_sales_orders"))
    write(nothing, 8)
    assert numbers(lake) == before * 2


def test_joins_read_stored_streams(spark, tmp_path, database):
    made = Dataset("made", "SELECT 1 AS n", kind=RECOMPUTED)
    shape = schemas.struct(n=schemas.LONG)
    joined = Dataset("joined", "SELECT n FROM made", ["made"], kind=JOINED, schema=shape)
    with pytest.raises(ValueError, match="joins stored streams"):
        Lake(spark, f"{tmp_path}/lake", database, [made, joined])


def test_lines_of_an_order_stay_together(bus, database):
    """Rows that repeat their order's lists lie side by side, so the files compress."""
    products = json.dumps([{"id": str(n), "price": n, "qty": 2} for n in range(5)])
    rows = [
        {"order_number": n, "customer_id": 1, "order_datetime": "1534928698", "ordered_products": products}
        for n in range(40)
    ]
    bus.send("sales_orders", *rows)
    lake = bus.lake(database, output_partitions=1)
    lake.update()
    name = lake._path("sales_orders_cleansed")
    (found,) = [f for f in files.child_names(lake.spark, name) if f.endswith(".parquet")]
    numbered = [r.order_number for r in lake.spark.read.parquet(f"{name}/{found}").collect()]
    assert len(numbered) == 200
    assert sum(a != b for a, b in zip(numbered, numbered[1:])) == 39


def test_batch_work_of_a_lake(spark):
    """More and smaller tasks than cores, compressed tables."""
    settings = stream_settings(spark)
    cores = spark.sparkContext.defaultParallelism
    assert int(settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 16 * cores
    assert settings["spark.sql.parquet.compression.codec"] == "zstd"


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for n in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n}


def test_few_files_come_without_a_shuffle(bus, database):
    lake = bus.lake(database, output_partitions=2)
    name, before = "sales_orders_cleansed", _shuffle_files(bus.spark)
    made = lake._few_batch(lake.datasets[name])
    lines = bus.spark.range(0, 1000, 1, 8).selectExpr("id AS order_number", "'p' AS product_id")
    made(lines, 0)
    found = files.child_names(bus.spark, f"{lake._path(name)}/batch-000000000000")
    assert len([n for n in found if n.endswith(".parquet")]) == 2
    rows = bus.spark.read.parquet(f"{lake._path(name)}/batch-000000000000")
    assert sorted(r.order_number for r in rows.collect()) == list(range(1000))
    # A batch that runs again.
    made(lines, 0)
    assert files.child_names(bus.spark, lake._path(name)) == ["batch-000000000000"]
    assert _shuffle_files(bus.spark) == before


def test_a_table_with_a_log_of_its_files_goes_on_with_it(bus, database):
    """One that was filled before, by a sink that notes its files."""
    bus.order(1, "a", customer=1)
    bus.lake(database).update()
    bus.order(2, "a", customer=1)
    lake = bus.lake(database, output_partitions=1)
    lake.update()
    assert files.exists(bus.spark, f"{lake._path('sales_orders_cleansed')}/_spark_metadata")
    assert sorted(r.order_number for r in lake.read("sales_orders_cleansed").collect()) == [1, 2]


def test_dimensions_are_broadcast_by_what_they_hold(spark, tmp_path):
    """Files of a few kilobytes may hold many rows, each copied to its salts."""
    outer = own_session(spark, {"spark.sql.autoBroadcastJoinThreshold": "512k"})
    session = own_session(outer, stream_settings(outer))

    def join(n):
        id_of = {"products": "CAST(id AS STRING)", "customers": "id"}
        for side, key in id_of.items():
            name = side[:-1]
            rows = spark.range(n).selectExpr(f"id AS {name}_key", f"{key} AS {name}_id", "'x' AS a", "'y' AS b", "'z' AS c")
            rows.write.mode("overwrite").parquet(f"{tmp_path}/{side}", compression="zstd")
        lines = spark.range(20_000).selectExpr(
            "id AS order_number", "'2020-01-01' AS order_datetime", "1 AS unit_price", "2 AS quantity",
            f"CAST(id % {n} AS STRING) AS product_id", f"id % {n} AS customer_id",
        )
        lines.write.mode("overwrite").parquet(f"{tmp_path}/lines")
        read = [session.read.parquet(f"{tmp_path}/{t}") for t in ("lines", "products", "customers")]
        fact = facts.fact_sales_orders(*read, product_salting=facts.Salting(4), customer_salting=facts.Salting(4))
        assert len(fact.collect()) == 20_000
        return fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    assert "BroadcastExchange" not in join(60_000)
    assert join(100).count("BroadcastHashJoin") == 2


def test_a_lake_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    for session in (own_session(spark, stream_settings(spark)), short_shuffles(spark)):
        before = _shuffle_files(spark)
        own = session.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        own.write.mode("overwrite").parquet(f"{tmp_path}/rows")
        assert not _shuffle_files(spark) - before
        assert sorted(session.read.parquet(f"{tmp_path}/rows").collect()) == sorted(rows.collect())
