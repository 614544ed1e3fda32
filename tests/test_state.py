"""Tables merged in place, messages once, rules, and joins with the version of a time."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import current, facts, incremental, once, validity
from tidemark.operators.expectations import DROP, FAIL, QUARANTINE, WARN, Rule
from tidemark.plans.retail import current_datasets, incremental_datasets, retail_datasets
from tidemark.sources.bus import message_stream
from tidemark.streaming import files
from tidemark.streaming.buckets import Buckets
from tidemark.streaming.lake import MERGED, ONCE, Dataset, Lake

SMALL = {"spark.sql.shuffle.partitions": "2"}
COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]
MESSAGE = schemas.pick(schemas.BUS_MESSAGE, COLUMNS)


class Bus:
    """One folder of messages per captured table, each with its place on the bus."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        for table in ("customers", "products", "sales_orders"):
            self.send(table, [])

    def send(self, table, rows):
        """Rows of (key, value, offset) or (key, value, offset, seconds)."""
        made = [
            (
                None if r[0] is None else json.dumps({"payload": r[0]}).encode(),
                r[1] if r[1] is None or isinstance(r[1], bytes) else json.dumps({"payload": r[1]}).encode(),
                table,
                0,
                r[2],
                r[3] if len(r) > 3 else r[2],
            )
            for r in rows
        ]
        frame = self.spark.createDataFrame(
            made, "key binary, value binary, topic string, partition int, offset long, seconds long"
        )
        frame = frame.withColumn("timestamp", F.timestamp_seconds("seconds")).select(*COLUMNS)
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/bus/{table}")

    def source(self, table):
        return lambda s: message_stream(s, "parquet", {}, path=f"{self.root}/bus/{table}", schema=MESSAGE)

    def lake(self, database, pick, more=(), **options):
        sources = {t: self.source(t) for t in ("customers", "products", "sales_orders")}
        chosen = [d for d in retail_datasets(sources, **options) if d.name in pick]
        return Lake(self.spark, f"{self.root}/lake", database, [*chosen, *more], settings=SMALL)


@pytest.fixture
def bus(spark, tmp_path):
    return Bus(spark, tmp_path)


# -- current state ---------------------------------------------------------


def change(op, number, name=None):
    row = {"customer_id": number, "customer_name": name}
    return {"op": op, "before": row if op == "d" else None, "after": None if op == "d" else row}


def customers_lake(bus, database, buckets=8):
    more = [d for d in current_datasets(buckets=buckets) if d.name == "current_customers"]
    return bus.lake(database, ["customers_raw"], more)


def names(lake):
    return {r.customer_id: r.customer_name for r in lake.read("current_customers").collect()}


def test_last_writer_whatever_the_order(bus, database, spark):
    key = lambda n: {"customer_id": n}
    history = []
    for n in range(40):
        history.append((key(n), change("c", n, f"a{n}"), n * 10))
        history.append((key(n), change("u", n, f"b{n}"), n * 10 + 1))
        if n % 3 == 0:
            history.append((key(n), change("d", n), n * 10 + 2))
            history.append((key(n), None, n * 10 + 3))
        if n % 6 == 0:
            history.append((key(n), change("c", n, f"again{n}"), n * 10 + 4))
    want = {n: f"again{n}" if n % 6 == 0 else f"b{n}" for n in range(40) if n % 6 == 0 or n % 3}
    random.Random(4).shuffle(history)
    for part in (history[:30], history[30:60], history[60:], history[:50]):
        bus.send("customers", part)
        lake = customers_lake(bus, database)
        lake.update()
    assert names(lake) == want
    # What does not parse, or has no key, changes nothing.
    bus.send("customers", [(key(1), b"{", 900), (None, change("u", 2, "x"), 901), ({"other": 1}, None, 902)])
    lake.update()
    assert names(lake) == want
    # Deleted keys are kept, apart from the rest.
    store = Buckets(spark, lake._path("current_customers"))
    assert store.rows("rows").count() == 40
    assert set(store.rows("rows").where(current.DELETED).select("customer_id").toPandas().customer_id) == set(range(40)) - set(want)


def test_one_bucket_for_one_change(bus, database, spark):
    bus.send("customers", [({"customer_id": n}, change("c", n, "a"), n) for n in range(200)])
    lake = customers_lake(bus, database)
    lake.update()
    store = Buckets(spark, lake._path("current_customers"))
    before = store.listing()
    assert len(before["sections"]["rows"]["buckets"]) == 8
    bus.send("customers", [({"customer_id": 7}, change("u", 7, "new"), 1000)])
    lake.update()
    after = store.listing()
    old, new = (x["sections"]["rows"]["buckets"] for x in (before, after))
    changed = [b for b in new if new[b] != old[b]]
    assert len(changed) == 1 and names(lake)[7] == "new" and len(names(lake)) == 200
    # The replaced copy stays for readers until the next change, all else is shared.
    data = files.child_names(spark, f"{lake._path('current_customers')}/data")
    assert len(data) == 2


def test_a_batch_that_runs_again_changes_nothing(bus, database, spark):
    bus.send("customers", [({"customer_id": n}, change("c", n, "a"), n) for n in range(20)])
    lake = customers_lake(bus, database)
    lake.update()
    dataset = lake.datasets["current_customers"]
    store = Buckets(spark, lake._path("current_customers"))
    listing = store.listing()
    batch = dataset.build(spark, lake.read("customers_raw").limit(3))
    lake._merged_batch(dataset)(batch, listing["batch"])
    assert store.listing() == listing
    # A run that failed before its listing is written over.
    orphan = f"{store.path}/data/rows-000000000009-dead"
    batch.write.parquet(orphan)
    bus.send("customers", [({"customer_id": 1}, change("u", 1, "b"), 99)])
    lake.update()
    assert names(lake)[1] == "b" and not files.exists(spark, orphan)


def test_hot_key_is_reduced_before_the_shuffle(spark, capsys):
    rows = spark.range(1000, numPartitions=4).selectExpr("1L AS customer_id", "id AS offset", "'x' AS name", "false AS _deleted")
    current.LastWriter(["customer_id"]).latest(rows).explain()
    plan = capsys.readouterr().out
    assert plan.index("partial_max_by") > plan.index("Exchange")


def test_messages_are_parsed_once(spark, capsys):
    messages = spark.createDataFrame([], "key string, value string, offset long")
    current.keyed_changes(messages, schemas.pick(schemas.CUSTOMER, ["customer_id"]), schemas.CUSTOMER).explain()
    assert capsys.readouterr().out.count("from_json") == 2


def test_merged_datasets_are_no_streams(bus, database):
    lake = customers_lake(bus, database)
    with pytest.raises(ValueError, match="no stream"):
        lake.stream("current_customers")
    assert lake.read("current_customers").columns == schemas.CUSTOMER.names
    assert names(lake) == {}


def test_full_refresh_of_merged(bus, database):
    bus.send("customers", [({"customer_id": n}, change("c", n, "a"), n) for n in range(5)])
    lake = customers_lake(bus, database)
    lake.update()
    lake.refresh(full=True)
    assert names(lake) == dict.fromkeys(range(5), "a")


# -- incremental sales -----------------------------------------------------


def order(number, product, customer, price, quantity):
    after = {
        "order_number": number,
        "customer_id": customer,
        "order_datetime": "1534928698",
        "ordered_products": json.dumps([{"id": product, "price": price, "qty": quantity}]),
    }
    return ({"order_number": number}, {"op": "c", "after": after}, number)


def test_incremental_equals_recomputed(bus, database, spark):
    draw = random.Random(9)
    pick = [f"{t}_{k}" for t in ("sales_orders", "customers", "products") for k in ("raw", "cleansed")]
    pick += ["dim_products", "dim_customers", "fact_customer_sales"]
    number, offset = 0, 0
    for step in range(5):
        lines, customers, products = [], [], []
        for _ in range(40):
            number += 1
            hot = draw.random() < 0.4
            product = None if number == 17 else "p0" if hot else f"p{draw.randrange(9)}"
            lines.append(order(number, product, draw.randrange(12), draw.choice([None, 3, 2_000_000_000]), draw.randrange(5)))
        for n in range(12):
            # Some come late, some several times, some in each step, one never.
            if n and draw.random() < 0.4:
                offset += 1
                customers.append(({"customer_id": n}, change("u", n, "x"), offset))
        for n in range(9):
            if n != 5 and draw.random() < 0.4:
                offset += 1
                products.append(({"product_id": f"p{n}"}, {"op": "u", "after": {"product_id": f"p{n}"}}, offset))
        for table, rows in (("sales_orders", lines), ("customers", customers), ("products", products)):
            if step != 3 or table == "products":
                bus.send(table, rows)
        lake = bus.lake(database, pick, incremental_datasets(grid=3))
        lake.update()
        got = lake.read("customer_sales_incremental").collect()
        assert sorted(got, key=repr) == sorted(lake.read("fact_customer_sales").collect(), key=repr)
    assert got


def rows_of(spark, lines=(), products=(), customers=()):
    return incremental.sales_changes(
        spark.createDataFrame(list(lines), "product_id string, customer_id long, unit_price int, quantity int"),
        spark.createDataFrame([(p,) for p in products], "product_id string"),
        spark.createDataFrame([(c,) for c in customers], "customer_id long"),
    )


def test_a_cell_takes_as_many_tasks_as_it_needs(spark, tmp_path):
    store, totals = Buckets(spark, f"{tmp_path}/totals"), incremental.SalesTotals(1)
    new, _ = totals.merge(store, rows_of(spark, [("p", 1, 2, 3)], ["p"], [1]))
    assert set(new) == {"products", "customers", "pairs"}
    for rows in new.values():
        plan = rows._jdf.queryExecution().analyzed().toString()
        assert "RebalancePartitions" in plan and "RepartitionByExpression" not in plan


def test_pairs_are_written_between_their_shuffles(spark, tmp_path):
    store, totals = Buckets(spark, f"{tmp_path}/totals"), incremental.SalesTotals(2)
    new, _ = totals.merge(store, rows_of(spark, [("p", 1, 2, 3), ("q", 1, 2, 3)], ["p"], [1]))
    plan = new["pairs"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert sorted((r.product_id, r.of_products, r.of_customers) for r in new["pairs"].collect()) == [("p", 1, 1), ("q", 0, 1)]


def test_only_touched_cells_are_written(spark, tmp_path):
    store, totals = Buckets(spark, f"{tmp_path}/totals"), incremental.SalesTotals(4)
    products, customers = [f"p{i}" for i in range(20)], list(range(20))
    every = [(p, c, 2, 3) for p in products for c in customers]

    def merged(batch_id, **new):
        old = store.listing()["sections"]
        store.commit(batch_id, *totals.merge(store, rows_of(spark, **new)))
        now = store.listing()["sections"]
        return {s: [b for b in now[s]["buckets"] if now[s]["buckets"][b] != old.get(s, {"buckets": {}})["buckets"].get(b)] for s in now}

    first = merged(0, lines=every, products=products, customers=customers)
    assert len(first["pairs"]) == 16
    line = merged(1, lines=[("p3", 5, 2, 3)])
    assert len(line["pairs"]) == 1 and line["products"] == line["customers"] == []
    # A version touches a row or a column of the grid.
    version = merged(2, products=["p3"])
    assert len(version["pairs"]) == 4 and len(version["products"]) == 1 and version["customers"] == []
    version = merged(3, customers=[5])
    assert len(version["pairs"]) == 4 and len(version["customers"]) == 1
    got = {(r.product_id, r.customer_id): (r.total_quantity, r.sale_amount) for r in totals.view(store).collect()}
    assert got["p3", 5] == (2 * 2 * 6, 2 * 2 * 12) and got["p3", 6] == (6, 12) and got["p4", 5] == (6, 12)
    assert got["p4", 6] == (3, 6) and len(got) == 400


# -- once ------------------------------------------------------------------


def raw_lake(bus, database):
    return bus.lake(database, ["sales_orders_raw"], exactly_once=True)


def offsets(lake):
    return sorted(r.offset for r in lake.read("sales_orders_raw").collect())


def test_replays_add_nothing(bus, database, spark):
    some = [({"n": n}, {"op": "c", "after": {"order_number": n}}, n) for n in range(30)]
    bus.send("sales_orders", some[:10])
    raw_lake(bus, database).update()
    # The same again, some twice in a batch, and new ones between them.
    bus.send("sales_orders", some[5:20] + some[5:20])
    raw_lake(bus, database).update()
    bus.send("sales_orders", some)
    lake = raw_lake(bus, database)
    lake.update()
    assert offsets(lake) == list(range(30))
    rows = lake.read("sales_orders_raw")
    assert rows.columns == COLUMNS
    assert all(json.loads(r.value)["payload"]["after"]["order_number"] == r.offset for r in rows.collect())
    # A batch that runs again after its folder is there.
    batch = rows.limit(4)
    lake._once_batch(lake.datasets["sales_orders_raw"])(batch, 1)
    assert offsets(lake) == list(range(30))


def test_repeats_go_in_waves(bus, database, monkeypatch):
    monkeypatch.setattr("tidemark.streaming.lake._WAVE", 7)
    some = [({"n": n}, {"op": "c", "after": {"order_number": n}}, n) for n in range(40)]
    bus.send("sales_orders", some[::3])
    raw_lake(bus, database).update()
    for part in (some[:25], some[20:] + some[5:8], some[30:]):
        bus.send("sales_orders", part)
    lake = raw_lake(bus, database)
    lake.update()
    assert offsets(lake) == list(range(40))


def test_repeats_go_without_a_shuffle_of_values(spark):
    import random

    deal, place = random.Random(5), ["_part", "_position"]
    rows = [
        ("t", 0, deal.choice([None, *range(9000)]), f"v{i}", i // 9000, i % 9000) for i in range(20_000)
    ]
    names = "topic string, partition int, offset long, value string, _part long, _position long"
    arrived = spark.createDataFrame(rows, names)
    stored = spark.range(2500, 5000).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    found = once.repeats(arrived, stored, place)
    gone = once.dropped(arrived, found, place)
    kept = once.without(arrived, gone, place)
    want, seen = [], set(range(2500, 5000))
    for row in rows:
        if row[2] is None or row[2] not in seen:
            want.append(row)
            seen.add(row[2])
    assert Counter(map(tuple, kept.collect())) == Counter(want)
    # The told rows and the places are apart, so that the plan below is that of the values alone.
    told = spark.createDataFrame([], gone.schema)
    plan = once.without(arrived, told, place)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_messages_without_a_place_are_kept(bus, database, spark):
    frame = spark.createDataFrame(
        [(b"k", b"v", "sales_orders", 0, None)] * 3, "key binary, value binary, topic string, partition int, offset long"
    ).withColumn("timestamp", F.lit(None).cast("timestamp"))
    frame.write.mode("append").parquet(f"{bus.root}/bus/sales_orders")
    lake = raw_lake(bus, database)
    lake.update()
    assert lake.read("sales_orders_raw").count() == 3


def test_lost_checkpoint_and_repair(bus, database, spark):
    some = [({"n": n}, {"op": "c", "after": {"order_number": n}}, n) for n in range(12)]
    bus.send("sales_orders", some[:8])
    lake = raw_lake(bus, database)
    lake.update()
    source = spark.read.schema(MESSAGE).parquet(f"{bus.root}/bus/sales_orders")
    text = source.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})
    assert lake.repair("sales_orders_raw", text) == 0
    # Messages that the stream has not seen, in a source that gives some twice.
    bus.send("sales_orders", some[6:] + some[6:])
    text = spark.read.schema(MESSAGE).parquet(f"{bus.root}/bus/sales_orders").withColumns(
        {c: F.col(c).cast("string") for c in ("key", "value")}
    )
    assert lake.repair("sales_orders_raw", text) == 4
    assert offsets(lake) == list(range(12))
    # They then come on the stream as well.
    lake.update()
    assert offsets(lake) == list(range(12))


def test_streams_read_once_tables(bus, database):
    lake = bus.lake(database, ["sales_orders_raw", "sales_orders_cleansed"], exactly_once=True)
    some = [order(n, "p", 1, 2, 3) for n in range(6)]
    bus.send("sales_orders", some)
    lake.update()
    bus.send("sales_orders", [*some, order(7, "p", 1, 2, 3)])
    lake.update()
    assert lake.read("sales_orders_cleansed").count() == 7


def test_state_shrinks_behind_the_watermark(spark, tmp_path, database):
    bus = Bus(spark, tmp_path)
    kept = once.first_deliveries(bus.source("customers")(spark).withColumn("value", F.lit(1)), delay="10 seconds")
    query = (
        kept.writeStream.format("memory").queryName(database).outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/check").start()
    )
    try:
        states = []
        for base in (0, 0, 1000, 2000):
            bus.send("customers", [({"n": n}, None, base + n, 100 + base + n % 5) for n in range(50)])
            query.processAllAvailable()
            states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    finally:
        query.stop()
    assert Counter(r.offset for r in spark.table(database).collect()) == Counter(
        [*range(50), *range(1000, 1050), *range(2000, 2050)]
    )
    assert max(states) <= 100 and states[-1] <= 50


def test_stored_offsets_are_pruned(spark, tmp_path, capsys):
    spark.range(10).selectExpr("'t' AS topic", "0 AS partition", "id AS offset", "'v' AS value").write.parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s")
    arrived = stored.selectExpr("*", "1 AS _part", "offset AS _position").where("offset > 7")
    once.repeats(arrived, stored, ["_part", "_position"]).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(offset,8), LessThanOrEqual(offset,9)" in plan
    assert "value" not in plan


# -- rules -----------------------------------------------------------------

RULES = [
    Rule("cheap", "unit_price < 10", WARN),
    Rule("some", "quantity > 0", DROP),
    Rule("known", "product_id IS NOT NULL", QUARANTINE),
    Rule("few", "quantity < 100", QUARANTINE),
]


def test_rules(bus, database):
    lake = bus.lake(database, ["sales_orders_raw", "sales_orders_cleansed"], order_rules=RULES)
    lines = [(1, "a", 5, 5), (2, "a", 50, 5), (3, "a", 5, 0), (4, None, 5, 5), (5, None, 50, 500), (6, "a", None, None), (7, None, 5, 0)]
    bus.send("sales_orders", [order(n, p, 1, price, q) for n, p, price, q in lines[:4]])
    lake.update()
    assert lake.quarantine("sales_orders_cleansed").count() == 1
    bus.send("sales_orders", [order(n, p, 1, price, q) for n, p, price, q in lines[4:]])
    lake.update()
    kept = lake.read("sales_orders_cleansed")
    assert kept.columns == schemas.ORDER_LINE.names
    assert sorted(r.order_number for r in kept.collect()) == [1, 2]
    apart = {r.order_number: r.broken_rules for r in lake.quarantine("sales_orders_cleansed").collect()}
    # A null counts as broken, and quarantine wins over drop.
    assert apart == {
        4: ["known"], 5: ["cheap", "known", "few"], 6: ["cheap", "some", "few"], 7: ["some", "known"],
    }
    counts = {(r.rule, r.action): (r.checked, r.broken) for r in lake.rule_counts("sales_orders_cleansed").collect()}
    assert counts == {("cheap", WARN): (7, 3), ("some", DROP): (7, 3), ("known", QUARANTINE): (7, 3), ("few", QUARANTINE): (7, 2)}
    # A batch of nothing but bad rows, and then a good one.
    bus.send("sales_orders", [order(8, None, 1, 1, 1)])
    lake.update()
    bus.send("sales_orders", [order(9, "a", 1, 1, 1)])
    lake.update()
    assert sorted(r.order_number for r in lake.read("sales_orders_cleansed").collect()) == [1, 2, 9]
    lake.refresh(full=True)
    assert sorted(lake.quarantine("sales_orders_cleansed").select("order_number").toPandas().order_number) == [4, 5, 6, 7, 8]


def test_failing_rule_writes_nothing(bus, database):
    rules = [*RULES, Rule("stop", "order_number <> 3", FAIL)]
    lake = bus.lake(database, ["sales_orders_raw", "sales_orders_cleansed"], order_rules=rules)
    bus.send("sales_orders", [order(n, "a", 1, 1, 1) for n in range(5)])
    with pytest.raises(Exception, match="rules broken: stop"):
        lake.update()
    assert lake.read("sales_orders_cleansed").count() == 0
    assert lake.rule_counts("sales_orders_cleansed").count() == 0


def test_rules_keep_one_parse(spark, capsys):
    from tidemark.operators import cleanse, expectations

    messages = spark.createDataFrame([], "key string, value string")
    plain = cleanse.cleanse_orders(messages)
    plain.explain()
    once_parsed = capsys.readouterr().out.count("from_json")
    rows = expectations.observed(expectations.judged(plain, RULES), RULES, "counts")
    rows.where(F.col("_state") != "dropped").explain()
    assert capsys.readouterr().out.count("from_json") == once_parsed


def test_bad_datasets():
    with pytest.raises(ValueError, match="unknown action"):
        Rule("r", "true", "shout")
    with pytest.raises(ValueError, match="says how"):
        Dataset("d", "SELECT 1", kind=MERGED, schema=schemas.CUSTOMER)
    with pytest.raises(ValueError, match="rules are for stored streams"):
        Dataset("d", "SELECT 1", kind=ONCE, rules=RULES)


# -- validity --------------------------------------------------------------

DAY = 86_400


def history(draw, keys=20):
    """Successive intervals per key, from hours to unbounded."""
    out = []
    for k in range(keys):
        at = draw.choice([None, 0, 5 * DAY])
        for _ in range(draw.randrange(1, 9)):
            length = draw.choice([3600, DAY, 40 * DAY, 900 * DAY, 30_000 * DAY, None])
            end = None if length is None else (at or 0) + length
            out.append((k, at, end, len(out)))
            if end is None:
                break
            at = end + draw.choice([0, 0, DAY])
    return out


def held(versions, key, at):
    return [v for k, a, b, v in versions if k == key and (a is None or at >= a) and (b is None or at < b)]


def salted():
    return facts.Salting(2, [(8, [0])])


@pytest.mark.parametrize("salting", [facts.NO_SALT, salted()])
def test_as_of_join(spark, salting):
    draw = random.Random(5)
    versions = history(draw)
    lines = [(n, draw.choice([0, 0, 0, *range(25), None]), draw.choice([0, -1, 3600, 41 * DAY, draw.randrange(2000 * DAY), draw.randrange(60_000 * DAY), None])) for n in range(3000)]
    lines += lines[:50]
    left = spark.createDataFrame(lines, "line long, k long, at long")
    right = spark.createDataFrame(versions, "k long, since long, until long, v long")
    got = validity.as_of_join(left, right, "k", "at", "since", "until", salting=salting)
    assert got.columns == ["k", "line", "at", "v"]
    want = [(k, n, at, v) for n, k, at in lines if None not in (k, at) for v in held(versions, k, at)]
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_successive(spark):
    rows = [(1, None, None, "a"), (1, 10, None, "b"), (1, 30, 20, "inverted"), (1, 40, 50, "c"), (1, 40, None, "d"), (2, 5, 9, "e"), (2, 7, 8, "f")]
    frame = spark.createDataFrame(rows, "k long, since long, until long, name string")
    got = {tuple(r) for r in validity.successive(frame, "k", "since", "until").collect()}
    assert got == {(1, None, 10, "a"), (1, 10, 30, "b"), (1, 40, None, "d"), (2, 5, 7, "e"), (2, 7, 8, "f")}


def test_no_versions(spark):
    left = spark.createDataFrame([(1, 1, 1)], "line long, k long, at long")
    right = spark.createDataFrame([], "k long, since long, until long, v long")
    assert validity.as_of_join(left, right, "k", "at", "since", "until").collect() == []


def test_as_of_plan_and_hot_key(spark, capsys):
    """A plain equi-join, a few copies of a version, and a hot key on many tasks."""
    versions = [(k, 0, None, k) for k in range(50)]
    right = spark.createDataFrame(versions, "k long, since long, until long, v long")
    left = spark.range(20_000).selectExpr("id AS line", "if(id % 2 = 0, 0, id % 50) AS k", "id AS at")
    session_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        hot = facts.hot_keys(left, ["k"], 64)["k"]
        got = validity.as_of_join(left, right, "k", "at", "since", "until", salting=facts.Salting(1, hot))
        got.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tasks = got.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks >= 12
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", session_threshold)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_copies_of_a_version_are_bounded(spark):
    draw = random.Random(2)
    rows = [(0, a, a + draw.randrange(1, 10 ** draw.randrange(1, 11))) for a in range(500)]
    frame = spark.createDataFrame(rows, "k long, since long, until long")
    sizes = frame.select(F.size(validity._slots(F.col("since"), F.col("until"), DAY)).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= validity.RATIO + 1
