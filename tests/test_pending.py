"""Lines that wait for versions within a bound, kept as files."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from tidemark import schemas
from tidemark.operators import facts, pending
from tidemark.plans import catalogue
from tidemark.streaming import files
from tidemark.streaming.lake import BOUNDED, Dataset, Lake

BOUND = pending.Bound("at", "time", delay="3 days", within="10 days")
LINE, VERSION = "n long, product_id string, at timestamp", "product_id string, time timestamp"
START = datetime(2020, 1, 1)


def day(number):
    return None if number is None else START + timedelta(days=number)


def arrivals(spark, lines, versions):
    lines = [(n, product, day(at)) for n, product, at in lines]
    versions = [(product, day(time)) for product, time in versions]
    return BOUND.arrivals(spark.createDataFrame(lines, LINE), spark.createDataFrame(versions, VERSION))


def unmatched(spark, lines, versions):
    return facts.unmatched_lines(
        lines, versions, at=BOUND.at, delay=BOUND.delay, within=BOUND.within, time=BOUND.time
    )


@pytest.fixture
def lake(spark, tmp_path, database):
    return lambda: Lake(
        spark,
        f"{tmp_path}/lake",
        database,
        [
            Dataset("lines", lambda spark: spark.readStream.schema(LINE).parquet(f"{tmp_path}/l"), temporary=True),
            Dataset("versions", lambda spark: spark.readStream.schema(VERSION).parquet(f"{tmp_path}/v"), temporary=True),
            Dataset(
                "orphans",
                unmatched,
                ["lines", "versions"],
                kind=BOUNDED,
                bound=BOUND,
                schema=schemas.struct(
                    n=schemas.LONG, product_id=schemas.STRING, at=spark.createDataFrame([], LINE).schema["at"].dataType
                ),
            ),
        ],
        settings={"spark.sql.shuffle.partitions": "2"},
    )


def found(spark, path):
    if not files.child_names(spark, path):
        return []
    return sorted(r.n for r in spark.read.option("recursiveFileLookup", "true").parquet(path).collect())


class Model:
    """The same rules, row by row."""

    def __init__(self):
        self.mark, self.newest, self.lines, self.versions, self.out = None, {}, [], [], []

    def batch(self, lines, versions):
        in_time = lambda t: t is not None and (self.mark is None or t > self.mark)
        self.lines += [line for line in lines if in_time(line[2])]
        self.versions += [v for v in versions if in_time(v[1])]
        for side, times in (("l", [x[2] for x in lines]), ("v", [x[1] for x in versions])):
            times = [t for t in times if t is not None]
            if times:
                self.newest[side] = max([*times, self.newest.get(side, min(times))])
        if len(self.newest) == 2:
            mark = min(self.newest.values()) - 3
            self.mark = mark if self.mark is None else max(mark, self.mark)
        for line in list(self.lines):
            if self.mark is not None and line[2] + 10 <= self.mark:
                self.lines.remove(line)
                if not any(p == line[1] and abs(t - line[2]) <= 10 for p, t in self.versions):
                    self.out.append(line[0])


@pytest.mark.parametrize("folders", [64, 1])
def test_batches_give_what_the_rules_say(spark, lake, tmp_path, monkeypatch, folders):
    monkeypatch.setattr(pending, "_FOLDERS", folders)
    rng, model = random.Random(folders), Model()
    run, path = lake(), f"{tmp_path}/lake/tables/orphans"
    write = run._bounded_batch(run.datasets["orphans"], {})
    for batch in range(7):
        near = lambda: rng.choice([batch * 8 + rng.randrange(-12, 9), None] if rng.random() < 0.1 else [batch * 8 + rng.randrange(-12, 9)])
        lines = [(batch * 100 + n, rng.choice(["a", "b", "c", "d", None]), near()) for n in range(12)]
        versions = [(rng.choice("abce"), near()) for _ in range(3)]
        if batch == 0:
            versions = []
        if batch == 3:
            lines = []
        write(arrivals(spark, lines, versions), batch)
        model.batch(lines, versions)
        assert found(spark, path) == sorted(model.out)
        # The last two notes' folders, and no other, are kept.
        assert len(files.child_names(spark, f"{tmp_path}/lake/joined/orphans")) <= 2
    assert model.out and len(model.out) < 70
    if folders == 1:
        assert len(files.child_names(spark, f"{tmp_path}/lake/pending/orphans")) <= 4


def test_bounded_batch_runs_again(spark, lake, tmp_path, monkeypatch):
    run, path = lake(), f"{tmp_path}/lake/tables/orphans"
    write = run._bounded_batch(run.datasets["orphans"], {})
    write(arrivals(spark, [(1, "a", 0), (2, "b", 0), (3, None, 0), (4, "a", None)], [("b", 5), (None, 0)]), 0)
    assert found(spark, path) == []
    last = arrivals(spark, [(5, "a", 400)], [("c", 400)])

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as broken:
        broken.setattr(run, "_append", stop)
        with pytest.raises(OSError):
            write(last, 1)
    assert found(spark, path) == []
    for _ in range(2):
        write(last, 1)
        assert found(spark, path) == [1, 3]
    # Nothing waits any longer but the line that has just come.
    write(arrivals(spark, [], [("a", 401)]), 2)
    write(arrivals(spark, [(6, "a", 450)], [("a", 450)]), 3)
    assert found(spark, path) == [1, 3]


def test_bounded_stream(spark, lake, tmp_path):
    """Versions that come after their lines, over two lake objects, then a table that streams may read."""
    send = lambda rows, to: rows.write.mode("append").parquet(f"{tmp_path}/{to}")
    send(spark.createDataFrame([(n, p, day(0)) for n, p in enumerate("abc")], LINE), "l")
    send(spark.createDataFrame([("a", day(1))], VERSION), "v")
    lake().update()
    send(spark.createDataFrame([(9, "z", day(500))], LINE), "l")
    send(spark.createDataFrame([("b", day(2)), ("z", day(500))], VERSION), "v")
    last = lake()
    last.update()
    assert [r.n for r in last.read("orphans").collect()] == [2]
    assert last.stream("orphans").isStreaming
    # The rows that wait are files; Spark's join keeps none of them one by one.
    assert not files.exists(spark, f"{tmp_path}/lake/checkpoints/orphans/state")


def test_orphan_lines_keep_no_join_state(spark, monkeypatch):
    roots = []
    monkeypatch.setattr(catalogue._Replay, "close", lambda run: roots.append(run.root))
    rows = catalogue.CATALOGUE["orphan_lines_stream"].run(spark, f"{TESTDATA}/sf0.001")
    lines = spark.read.parquet(f"{TESTDATA}/sf0.001/lineitem.parquet")
    parts = spark.read.parquet(f"{TESTDATA}/sf0.001/part.parquet").where("p_size % 10 = 0")
    assert rows.count() == lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).count()
    assert files.exists(spark, f"{roots[0]}/lake/checkpoints/orphan_lines/offsets")
    assert not files.exists(spark, f"{roots[0]}/lake/checkpoints/orphan_lines/state")


def test_bounded_dataset_says_how():
    with pytest.raises(ValueError, match="bound"):
        Dataset("x", unmatched, ["a", "b"], kind=BOUNDED, schema=schemas.ORDER_LINE)
    with pytest.raises(ValueError, match="two inputs"):
        Dataset("x", unmatched, ["a"], kind=BOUNDED, bound=BOUND, schema=schemas.ORDER_LINE)
