"""Running totals of hot groups, top rows, roll-ups with sketches, and reconciling."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import facts, reconcile, rollup
from tidemark.operators.running import running, top_of_groups
from tidemark.operators.sessions import Sessions
from tidemark.streaming.buckets import Buckets


@pytest.fixture
def wide(spark):
    """A session of many partitions without broadcasts."""
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }.items():
        session.conf.set(name, value)
    return session


def test_running(wide):
    draw = random.Random(1)
    rows = [(draw.choice([1, 1, 1, 2, 3, None]), draw.choice([*range(40), None]), draw.choice([*range(9), None])) for _ in range(2000)]
    rows += [(4, None, None), (5, 1, None), (5, 2, 7)]
    frame = wide.createDataFrame(rows, "k long, at long, v long")
    got = running(frame, "k", ["at", "v"], totals={"sum": "v"}, previous={"was": "v", "since": "at"}).collect()
    groups = defaultdict(list)
    for k, at, v in rows:
        groups[k].append((at is not None, at or 0, v is not None, v or 0))
    want = []
    for k, items in groups.items():
        total, before = None, (None, None)
        for n, (has_at, at, has_v, v) in enumerate(sorted(items), start=1):
            at, v = at if has_at else None, v if has_v else None
            total = total if v is None else v + (total or 0)
            want.append((k, at, v, n, total, before[1], before[0]))
            before = (at, v)
    assert Counter(map(tuple, got)) == Counter(want)


def test_running_spreads_a_hot_group(wide, tmp_path):
    """A customer with half of all lines lies in many ranges; nothing but carried sums is broadcast."""
    rows = wide.range(40_000).selectExpr("if(id % 2 = 0, 7, id % 500) AS k", "id AS at", "1L AS v")
    path = f"{tmp_path}/placed"
    got = running(rows, "k", ["at"], totals={"sum": "v"}, previous={"was": "at"}, staging=path)
    assert wide.read.parquet(path).where("k = 7").select("_part").distinct().count() >= 14
    tasks = got.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 6
    hot = got.where("k = 7")
    assert hot.agg(F.max("rank"), F.max("sum"), F.count_if(F.col("was").isNull())).first() == (20_080, 20_080, 1)
    assert hot.where("rank <> sum").count() == 0


def test_running_of_nothing(spark):
    assert running(spark.createDataFrame([], "k long, at long, v long"), "k", ["at"]).collect() == []


def test_top_of_groups(wide, capsys):
    rows = wide.range(5000).selectExpr("id % 3 AS g", "id % 100 AS v", "id")
    made = top_of_groups(rows, ["g"], [F.desc("v"), "id"], 4)
    made.explain()
    plan = capsys.readouterr().out
    # Groups are cut to k rows before they are shuffled.
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    want = []
    for g in range(3):
        some = sorted(((-(i % 100), i) for i in range(5000) if i % 3 == g))[:4]
        want += [(g, -v, i, n) for n, (v, i) in enumerate(some, start=1)]
    assert sorted(map(tuple, made.collect())) == sorted(want)


def test_rollup(spark):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]), draw.randrange(4), draw.choice([*range(3000), None]), draw.randrange(9)) for _ in range(8000)]
    frame = spark.createDataFrame(rows, "x string, y long, who long, n long")
    # Cells of two halves, put together without their rows.
    halves = [frame.where("n < 4"), frame.where("n >= 4")]
    cells = [rollup.base_cells(h, ["x", "y"], {"n": "n"}, "who") for h in halves]
    made = rollup.rolled_up(cells[0].unionByName(cells[1]), ["x", "y"], ["n"])
    both = rollup.with_exact(made, rollup.exact_distinct(frame, ["x", "y"], "who", "people"), ["x", "y"])
    got = {(r.level, r.x, r.y): r for r in both.collect()}
    groups = defaultdict(list)
    for x, y, who, n in rows:
        for level, at in ((0, (None, None)), (1, (x, None)), (2, (x, y))):
            groups[level, *at].append((who, n))
    assert set(got) == set(groups)
    for at, items in groups.items():
        people = {w for w, _ in items if w is not None}
        assert (got[at].row_count, got[at].n, got[at].people) == (len(items), sum(n for _, n in items), len(people))
        assert abs(got[at].estimate - len(people)) <= max(1, 0.1 * len(people))


def test_differences(spark):
    draw = random.Random(6)
    source = [(n, draw.choice(["x", "y", None]), draw.randrange(3)) for n in range(300)] + [(5, "x", 1)] * 4
    stored = [r for r in source if r[0] % 50 != 7]
    stored += [r for r in source if r[0] % 60 == 9] + [(5, "x", 1)] * 2 + [(1000, None, 0)]
    stored = [(a, b, c + 10) if a == 33 else (a, b, c) for a, b, c in stored]
    names = "a long, b string, c long"
    ours, theirs = (spark.createDataFrame(r, names).repartition(3) for r in (stored, source))
    got = {tuple(r)[:3]: r.surplus for r in reconcile.differences(ours, theirs, ["a", "b", "c"], ["a"], 16).collect()}
    want = Counter(stored)
    want.subtract(source)
    assert got == {r: n for r, n in want.items() if n}
    assert reconcile.differences(ours, ours.repartition(5), ["a", "b", "c"], ["a"]).collect() == []
    assert reconcile.differences(ours.limit(0), theirs, ["a", "b", "c"], ["a"]).agg(F.sum("surplus")).first()[0] == -len(source)


def test_only_buckets_that_differ_are_counted(spark, capsys):
    source = spark.range(10_000).selectExpr("id AS a", "id % 7 AS b")
    stored = source.where("a <> 1234")
    made = reconcile.differences(stored, source, ["a", "b"], ["a"], 256)
    made.explain()
    # One bucket is asked for; the filter stands below the only shuffle.
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.rindex("Exchange") < plan.index("Filter", plan.index("Exchange"))
    assert [tuple(r) for r in made.collect()] == [(1234, 1234 % 7, -1)]


# -- sessions --------------------------------------------------------------


def islands(events, gap):
    out = defaultdict(list)
    for key, at, n in sorted(e for e in events if None not in e[:2]):
        if out[key] and at - out[key][-1][1] <= gap:
            begin, _, count, total = out[key][-1]
            out[key][-1] = (begin, at, count + 1, total + n)
        else:
            out[key].append((at, at, 1, n))
    return {(k, *run) for k, runs in out.items() for run in runs}


@pytest.mark.parametrize("lateness", [None, 500])
def test_sessions(spark, tmp_path, lateness):
    draw = random.Random(8)
    merge = Sessions("k", {"total": "n"}, gap=20, lateness=lateness, buckets=4)
    store, seen, late, newest = Buckets(spark, f"{tmp_path}/s"), [], Counter(), None
    for batch_id in range(4):
        base = batch_id * 400
        batch = [(draw.choice([0, 0, 0, *range(12), None]), draw.choice([None, *range(base, base + 900)]), draw.randrange(5)) for _ in range(150)]
        batch += [(0, 3, 1), (0, 3, 1)]
        frame = spark.createDataFrame(batch, "k long, at long, n long")
        store.commit(batch_id, *merge.merge(store, frame))
        for k, at, n in batch:
            if lateness is not None and newest is not None and None not in (k, at) and at < newest - lateness:
                late[k, at] += 1
            else:
                seen.append((k, at, n))
        newest = max([newest or 0, *(at for k, at, _ in batch if None not in (k, at))])
        got = merge.view(store).select("k", "started", "ended", "events", "total").collect()
        assert len(got) == len(set(got)) and set(map(tuple, got)) == islands(seen, 20)
    if lateness is None:
        assert merge.late(store) is None
    else:
        kept = Counter()
        for r in merge.late(store).collect():
            kept[r.k, r.at] += r.events
        assert late and kept == late


def test_sessions_of_a_hot_key_and_touched_buckets(spark, tmp_path):
    merge = Sessions("k", gap=5, buckets=8)
    store = Buckets(spark, f"{tmp_path}/s")
    hot = spark.range(20_000).selectExpr("1L AS k", "id AS at")
    store.commit(0, *merge.merge(store, hot.union(spark.range(100).selectExpr("id + 10 AS k", "id AS at"))))
    assert merge.view(store).where("k = 1").collect()[0][1:] == (0, 19_999, 20_000)
    before = store.listing()["sections"]["sessions"]["buckets"]
    store.commit(1, *merge.merge(store, spark.range(1).selectExpr("1L AS k", "20003L AS at")))
    after = store.listing()["sections"]["sessions"]["buckets"]
    assert sum(before[b] != after[b] for b in after) == 1
    assert merge.view(store).where("k = 1").collect()[0][1:] == (0, 20_003, 20_001)
    # Nothing to merge leaves the table as it is.
    store.commit(2, *merge.merge(store, hot.limit(0)))
    assert merge.view(store).count() == 101


def test_unmatched_lines_in_batch(spark):
    lines = spark.createDataFrame(
        [(1, "a", "2020-01-01"), (2, "a", "2020-03-01"), (3, None, "2020-01-01"), (4, "b", "2020-01-01"), (5, "a", None)],
        "n long, product_id string, at string",
    ).withColumn("at", F.col("at").cast("timestamp"))
    products = spark.createDataFrame([("a", "2020-01-05"), ("a", "2020-01-06"), (None, "2020-01-01")], "product_id string, timestamp string")
    products = products.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    made = facts.unmatched_lines(lines, products, at="at", delay="1 day", within="10 days")
    assert sorted(r.n for r in made.collect()) == [2, 3, 4]
