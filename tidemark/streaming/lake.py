"""Datasets, and the lake that keeps them up to date.

A dataset is a table, a function (or a SELECT) that builds it from other
datasets, and a few options.  Streams append and remember what they have read;
recomputed tables are built anew from complete inputs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import expectations, once
from tidemark.operators.expectations import Rule
from tidemark.operators.keys import assign_keys, with_places
from tidemark.operators.pending import Bound, Pending
from tidemark.session import own_session, stream_settings
from tidemark.streaming import files
from tidemark.streaming.buckets import Buckets

STREAM = "stream"
KEYED = "keyed"
ONCE = "once"
MERGED = "merged"
JOINED = "joined"
BOUNDED = "bounded"
RECOMPUTED = "recomputed"


@dataclass(frozen=True)
class Dataset:
    """One table of a lake.

    ``build`` is called with the session and one frame per input, or is a SELECT
    that names the inputs.  ``kind`` is

    - ``stream``: inputs are streams, new rows are appended;
    - ``keyed``: as ``stream``, and rows get the surrogate key column ``key``,
      in the order ``order_by`` within a micro-batch;
    - ``once``: as ``stream``, but a row whose ``identity`` columns are stored
      already, or came before in its micro-batch, is left out;
    - ``merged``: inputs are streams, each micro-batch is merged into a table that
      changes in place, as ``merge`` says (``LastWriter``, ``SalesTotals``); it is
      read with ``Lake.read``, has no entry in the catalog, and no stream reads it;
    - ``joined``: ``build`` is an inner join of its inputs, which are stored streams,
      with nothing but selections and projections besides.  A micro-batch appends
      what its new rows bring: ``build`` is called with complete frames, once per
      input that has new rows, with these in its place.  The inputs' own files are
      the join's state, and each batch notes which of them it has read; it takes all
      that there are, as limits in ``read_options`` only bound streams;
    - ``bounded``: two streams wait for each other as ``bound`` says; a row of the
      first one is appended, or not, once its time has come.  ``build`` is called
      then, with the rows that fall due in a micro-batch and all rows of the second
      stream that may belong to them, and says what to append;
    - ``recomputed``: inputs are complete tables, the result replaces the last.

    ``schema`` is checked against the built columns.  ``trigger`` is the interval
    for continuous running.  ``reset_allowed=False`` keeps the table through a
    full refresh.  A ``temporary`` stream is a view only; other temporary
    datasets are stored but not put in the catalog.  ``read_options`` go to the
    streaming reads of the inputs, e.g. ``maxFilesPerTrigger``.  ``pinned``
    settings may only change with a full refresh.  ``measure`` is called like
    ``build``, with the complete inputs, before the first start; ``build`` gets
    the dict it returns (plain JSON values) as keywords, until a full refresh or
    ``Lake.rebuild``.  If it returns None there is nothing to measure yet:
    updates leave the dataset empty, and a continuous run starts it without.

    ``rules`` are checked on the rows of a stream as they are written.  Those in
    quarantine are read with ``Lake.quarantine``, the counts of each rule with
    ``Lake.rule_counts``.

    ``output_partitions`` bounds the number of files that the micro-batch of a
    stream or a join adds: all tasks write, and so many then read that again and
    write it to the end.  With ``rules``, and in a stream's table from before this,
    a shuffle does it, in which rows that are equal in the columns ``together`` stay
    next to each other, so that what they repeat compresses.  ``stable_input`` is
    that of ``assign_keys`` for a keyed dataset.
    """

    name: str
    build: Callable[..., DataFrame] | str
    inputs: Sequence[str] = ()
    kind: str = STREAM
    schema: T.StructType | None = None
    key: str | None = None
    order_by: Sequence[str] | None = None
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    trigger: str = "60 seconds"
    reset_allowed: bool = True
    temporary: bool = False
    read_options: Mapping[str, str] = field(default_factory=dict)
    pinned: Mapping[str, int | str] = field(default_factory=dict)
    measure: Callable[..., dict | None] | None = None
    output_partitions: int | None = None
    together: Sequence[str] = ()
    stable_input: bool = False
    identity: Sequence[str] = once.IDENTITY
    merge: object | None = None
    bound: Bound | None = None
    rules: Sequence[Rule] = ()

    def __post_init__(self):
        if self.kind not in (STREAM, KEYED, ONCE, MERGED, JOINED, BOUNDED, RECOMPUTED):
            raise ValueError(f"{self.name}: unknown kind {self.kind!r}")
        if (self.kind == MERGED) != (self.merge is not None):
            raise ValueError(f"{self.name}: a merged dataset, and no other, says how")
        if (self.kind == BOUNDED) != (self.bound is not None):
            raise ValueError(f"{self.name}: a bounded dataset, and no other, has a bound")
        if self.kind == BOUNDED and len(self.inputs) != 2:
            raise ValueError(f"{self.name}: a bounded dataset has two inputs")
        if self.rules and (self.kind != STREAM or self.temporary):
            raise ValueError(f"{self.name}: rules are for stored streams")
        if self.kind in (ONCE, MERGED, JOINED, BOUNDED) and self.temporary:
            raise ValueError(f"{self.name}: {self.kind} datasets are stored")
        if (self.kind == KEYED) != (self.key is not None):
            raise ValueError(f"{self.name}: a keyed dataset, and no other, names its key")
        if self.kind in (KEYED, MERGED, JOINED, BOUNDED) and self.schema is None:
            raise ValueError(f"{self.name}: a {self.kind} dataset declares its schema")


def conform(rows: DataFrame, schema: T.StructType | None) -> DataFrame:
    """``rows`` with the columns of ``schema``, cast; other columns are an error."""
    if schema is None:
        return rows
    if set(rows.columns) != set(schema.names):
        raise ValueError(f"built columns {rows.columns}, declared {schema.names}")
    return rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


class Lake:
    """Datasets stored under ``root``, a folder that all executors share.

    ``root`` needs a file system with atomic folder renames, such as HDFS or an
    object store with a hierarchical namespace.

    Datasets are built in a session of the lake, with ``settings`` on top of the
    SQL settings of ``spark``; the default suits stateful streams.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        database: str,
        datasets: Sequence[Dataset],
        *,
        settings: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.session = own_session(
            spark, stream_settings(spark) if settings is None else settings
        )
        self.root = root.rstrip("/")
        self.database = database
        self.datasets = {d.name: d for d in datasets}
        if len(self.datasets) != len(datasets):
            raise ValueError("dataset names repeat")
        self._levels = _levels(datasets)
        for dataset in datasets:
            if dataset.kind == JOINED:
                for other in map(self.datasets.get, dataset.inputs):
                    if other.kind in (MERGED, RECOMPUTED) or other.temporary:
                        raise ValueError(f"{dataset.name} joins stored streams, which {other.name} is not")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    # -- reading -----------------------------------------------------------

    def table_name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def read(self, name: str) -> DataFrame:
        """All rows of a dataset as of now."""
        return self._read(self.spark, name)

    def quarantine(self, name: str) -> DataFrame:
        """The rows that rules have kept out of a dataset, with the names of those they break."""
        schema = T.StructType([*self._stored_schema(name).fields, _BROKEN_FIELD])
        reader = self.spark.read.option("recursiveFileLookup", "true").schema(schema)
        path = self._quarantine_path(name)
        files.make_folder(self.spark, path)
        return reader.parquet(path).withColumnRenamed(expectations.BROKEN, "broken_rules")

    def rule_counts(self, name: str) -> DataFrame:
        """``rule``, ``action``, ``checked`` and ``broken`` of each rule of a dataset, over all batches."""
        path = self._counts_path(name)
        kind = "rule string, action string, checked bigint, broken bigint"
        files.make_folder(self.spark, path)
        found = self.spark.read.schema(kind).json(path)
        return found.groupBy("rule", "action").agg(
            F.sum("checked").alias("checked"), F.sum("broken").alias("broken")
        )

    def repair(self, name: str, source: DataFrame) -> int:
        """Add the messages of a complete ``source`` that a ``once`` dataset lacks; how many.

        Its query must not be running.  Readers get them as new rows.
        """
        dataset = self.datasets[name]
        if dataset.kind != ONCE:
            raise ValueError(f"{name} is not of kind {ONCE!r}")
        if any(q.name == name for q in self.session.streams.active):
            raise ValueError(f"stop the query of {name} first")
        files.make_folder(self.spark, self._path(name))
        stored = self._files(self.spark.read, name)
        absent = once.missing(conform(source, stored.schema), stored, dataset.identity)
        tag = uuid.uuid4().hex
        staging = f"{self.root}/staging/{name}-{tag}"
        absent.write.parquet(staging)
        added = self.spark.read.schema(stored.schema).parquet(staging).count()
        if added:
            files.publish(self.spark, staging, f"{self._path(name)}/repair-{tag}")
        files.delete(self.spark, staging)
        return added

    def stream(self, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
        """The rows of a dataset as they are added."""
        if self._is_view(name):
            return self.session.table(name)
        reader = self.session.readStream.options(**(options or {}))
        if self.datasets[name].kind == MERGED:
            raise ValueError(f"{name} changes in place, so it is no stream")
        if self.datasets[name].temporary:
            return self._files(reader, name)
        return reader.table(self.table_name(name))

    # -- running -----------------------------------------------------------

    def update(self) -> None:
        """Bring every dataset up to date with what its sources hold now, then stop."""
        for level in self._levels:
            queries = []
            try:
                for dataset in level:
                    query = self._start(dataset, availableNow=True)
                    if query is not None:
                        queries.append(query)
                for query in queries:
                    query.awaitTermination()
            finally:
                for query in queries:
                    query.stop()
            self.recompute(level)

    def start(self) -> list[StreamingQuery]:
        """Run all streams at their intervals until stopped.

        Recomputed tables change only when ``recompute`` is called.  If a dataset
        has still to be measured, the lake is first brought up to date, so that
        the measurement covers what the sources hold now.
        """
        if any(self._unmeasured(d) for d in self.datasets.values()):
            self.update()
        queries: list[StreamingQuery] = []
        try:
            for level in self._levels:
                for dataset in level:
                    query = self._start(dataset, wait=False, processingTime=dataset.trigger)
                    if query is not None:
                        queries.append(query)
        except BaseException:
            for query in queries:
                query.stop()
            raise
        return queries

    def rebuild(self, name: str) -> None:
        """Clear one stream and build it again from its inputs, measured anew.

        Recomputed tables that read it follow.  Its query must not be running,
        and no other stream may read it, as that one would see its rows twice.
        """
        dataset = self.datasets[name]
        readers = [d for d in self.datasets.values() if name in d.inputs]
        if dataset.kind == RECOMPUTED or any(d.kind != RECOMPUTED for d in readers):
            raise ValueError(f"{name} is read by other streams, or is no stream")
        if any(q.name == name for q in self.session.streams.active):
            raise ValueError(f"stop the query of {name} first")
        self._clear(dataset)
        query = self._start(dataset, availableNow=True)
        if query is not None:
            query.awaitTermination()
        self.recompute(readers)

    def recompute(self, datasets: Sequence[Dataset] | None = None) -> None:
        """Build the recomputed ones among ``datasets`` (default: all) anew."""
        for dataset in self.datasets.values() if datasets is None else datasets:
            if dataset.kind == RECOMPUTED:
                self._replace(dataset)

    def refresh(self, *, full: bool = False) -> None:
        """Update; a full refresh first clears every table that allows it."""
        if full:
            for dataset in reversed(list(self.datasets.values())):
                if dataset.reset_allowed:
                    self._clear(dataset)
        self.update()

    # -- internals ---------------------------------------------------------

    def _path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def _is_view(self, name: str) -> bool:
        dataset = self.datasets[name]
        return dataset.temporary and dataset.kind == STREAM

    def _read(self, session: SparkSession, name: str) -> DataFrame:
        dataset = self.datasets[name]
        if self._is_view(name) or (dataset.temporary and dataset.kind == RECOMPUTED):
            return self.session.table(name)
        if dataset.temporary:
            return self._files(session.read, name)
        if dataset.kind == MERGED:
            rows = dataset.merge.view(Buckets(session, self._path(name)))
            if rows is None:
                return session.createDataFrame([], dataset.schema)
            return conform(rows, dataset.schema)
        session.catalog.refreshTable(self.table_name(name))
        return session.read.table(self.table_name(name))

    def _files(self, reader, name: str) -> DataFrame:
        reader = reader.option("recursiveFileLookup", "true")
        return reader.schema(self._stored_schema(name)).parquet(self._path(name))

    def _stored_schema(self, name: str) -> T.StructType:
        declared = self.datasets[name].schema
        return self.spark.table(self.table_name(name)).schema if declared is None else declared

    def _quarantine_path(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def _counts_path(self, name: str) -> str:
        return f"{self.root}/rules/{name}"

    def _built(self, dataset: Dataset, measured: dict) -> DataFrame:
        if dataset.kind == RECOMPUTED:
            frames = [self._read(self.session, i) for i in dataset.inputs]
        else:
            frames = [self.stream(i, dataset.read_options) for i in dataset.inputs]
        return self._build(self.session, dataset, frames, measured)

    def _build(
        self, session: SparkSession, dataset: Dataset, frames: Sequence[DataFrame], measured: dict
    ) -> DataFrame:
        if callable(dataset.build):
            return dataset.build(session, *frames, **measured)
        for name, frame in zip(dataset.inputs, frames):
            frame.createOrReplaceTempView(name)
        rows = session.sql(dataset.build)
        for name in dataset.inputs:
            if not self._is_view(name):
                session.catalog.dropTempView(name)
        return rows

    def _start(
        self, dataset: Dataset, *, wait: bool = True, **trigger
    ) -> StreamingQuery | None:
        """Start a stream; with ``wait`` not before it can be measured."""
        if dataset.kind == RECOMPUTED:
            return None
        if self._is_view(dataset.name):
            rows = conform(self._built(dataset, {}), dataset.schema)
            rows.createOrReplaceTempView(dataset.name)
            return None
        measured = self._pinned(dataset, wait)
        if dataset.kind == JOINED:
            return self._start_joined(dataset, measured, trigger)
        if dataset.kind == BOUNDED:
            return self._start_bounded(dataset, measured, trigger)
        rows = self._built(dataset, measured or {})
        if dataset.kind in (STREAM, ONCE):
            rows = conform(rows, dataset.schema)
        if measured is None:
            self._create(dataset, rows.schema)
            return None
        few = dataset.output_partitions is not None and dataset.kind == STREAM and not dataset.rules
        # A table that has a log of its files shows no others, so it goes on with it.
        few = few and not files.exists(self.spark, f"{self._path(dataset.name)}/_spark_metadata")
        if dataset.output_partitions is not None and dataset.kind == STREAM and not few:
            # A shuffle, as fewer partitions without one would run the whole
            # stateful stage in as few tasks.
            rows = rows.repartition(dataset.output_partitions, *dataset.together)
        writer = (
            rows.writeStream.queryName(dataset.name)
            .outputMode("append")
            .option("checkpointLocation", self._checkpoint(dataset.name))
            .trigger(**trigger)
        )
        if dataset.kind == KEYED:
            self._check_batches(dataset)
            files.make_folder(self.spark, self._path(dataset.name))
            self._create(dataset, dataset.schema, recursiveFileLookup="true")
            return writer.foreachBatch(self._keyed_batch(dataset)).start()
        if dataset.kind == MERGED:
            return writer.foreachBatch(self._merged_batch(dataset)).start()
        if dataset.kind == ONCE or dataset.rules or few:
            self._check_batches(dataset)
            files.make_folder(self.spark, self._path(dataset.name))
            self._create(dataset, rows.schema, recursiveFileLookup="true")
            write = self._once_batch if dataset.kind == ONCE else self._few_batch if few else self._checked_batch
            return writer.foreachBatch(write(dataset)).start()
        self._create(dataset, rows.schema)
        return writer.format("parquet").toTable(self.table_name(dataset.name))

    def _start_joined(
        self, dataset: Dataset, measured: dict | None, trigger: dict
    ) -> StreamingQuery | None:
        """A stream that runs a batch whenever an input has got files."""
        self._check_batches(dataset)
        files.make_folder(self.spark, self._path(dataset.name))
        self._create(dataset, dataset.schema, recursiveFileLookup="true")
        if measured is None:
            return None
        arrived = [
            self.stream(name, dataset.read_options).select(F.lit(name).alias("input"))
            for name in dataset.inputs
        ]
        return (
            reduce(DataFrame.unionByName, arrived)
            .writeStream.queryName(dataset.name)
            .outputMode("append")
            .option("checkpointLocation", self._checkpoint(dataset.name))
            .trigger(**trigger)
            .foreachBatch(self._joined_batch(dataset, measured))
            .start()
        )

    def _joined_batch(self, dataset: Dataset, measured: dict):
        """What new rows add to the join of all rows so far.

        Old and new rows of A, B and C give a'BC + (A+a')b'C + (A+a')(B+b')c'
        beyond ABC, so each new combination comes once.  New is every file that an
        input's table lists and no earlier batch has noted; what a later batch of
        the stream announces may thus be joined already, and is noted then.
        """
        path, notes = self._path(dataset.name), self._notes_path(dataset.name)
        session = own_session(self.session, {})

        def write(batch: DataFrame, batch_id: int) -> None:
            name = _batch_name(batch_id)
            if {name, f"{name}.parquet"} & set(files.child_names(session, path)):
                # The batch was written, but its commit was not recorded.
                return
            noted = sorted(n for n in files.child_names(session, notes) if n < name)
            known = {i: [] for i in dataset.inputs}
            if noted:
                known = json.loads(files.read_text(session, f"{notes}/{noted[-1]}"))
            # Names alone, from the tables' own listings; no row leaves the executors.
            listed = {i: map(unquote, self._read(session, i).inputFiles()) for i in dataset.inputs}
            new = {i: sorted(set(listed[i]) - set(known[i])) for i in dataset.inputs}
            now = {i: known[i] + new[i] for i in dataset.inputs}
            if not any(new.values()):
                return
            parts = []
            for place, changed in enumerate(dataset.inputs):
                read = [
                    new[i] if i == changed else (now if at < place else known)[i]
                    for at, i in enumerate(dataset.inputs)
                ]
                if all(read):
                    frames = [
                        session.read.schema(self._stored_schema(i)).parquet(*found)
                        for i, found in zip(dataset.inputs, read)
                    ]
                    rows = self._build(session, dataset, frames, measured)
                    parts.append(conform(rows, dataset.schema))
            # Files that no other batch will name are noted before their rows appear.
            files.write_text(session, f"{notes}/{name}", json.dumps(now))
            if parts:
                self._append(session, dataset, reduce(DataFrame.unionByName, parts), name)
            for old in noted[:-1]:
                files.delete(session, f"{notes}/{old}")

        return write

    def _append(self, session: SparkSession, dataset: Dataset, rows: DataFrame, name: str) -> None:
        """Make the rows of a batch visible by one rename."""
        path = self._path(dataset.name)
        staging = f"{self.root}/staging/{dataset.name}-{uuid.uuid4().hex}"
        ready, made = self._written(session, dataset, rows, staging)
        if len(made) == 1:
            # Many small batches need no folder each.
            files.publish(session, f"{ready}/{made[0]}", f"{path}/{name}.parquet")
        else:
            files.publish(session, ready, f"{path}/{name}")
        files.delete(session, staging)

    def _written(
        self, session: SparkSession, dataset: Dataset, rows: DataFrame, staging: str
    ) -> tuple[str, list[str]]:
        """The folder below ``staging`` that ``rows`` are written to, and its files.

        A shuffle to few files would hold the rows as they are in memory, lists of an
        order once for each of its lines, beside all shuffles that they come from.
        """
        ready, bound = f"{staging}/rows", dataset.output_partitions
        rows.write.parquet(ready)
        made = [n for n in files.child_names(session, ready) if n.endswith(".parquet")]
        if bound is not None and len(made) > bound:
            every, ready = ready, f"{staging}/few"
            session.read.schema(rows.schema).parquet(every).coalesce(bound).write.parquet(ready)
            files.delete(session, every)
            made = [n for n in files.child_names(session, ready) if n.endswith(".parquet")]
        return ready, made

    def _start_bounded(
        self, dataset: Dataset, measured: dict | None, trigger: dict
    ) -> StreamingQuery | None:
        """One stream of both inputs, so that a batch takes each message once."""
        self._check_batches(dataset)
        files.make_folder(self.spark, self._path(dataset.name))
        self._create(dataset, dataset.schema, recursiveFileLookup="true")
        if measured is None:
            return None
        inputs = [self.stream(name, dataset.read_options) for name in dataset.inputs]
        return (
            dataset.bound.arrivals(*inputs)
            .writeStream.queryName(dataset.name)
            .outputMode("append")
            .option("checkpointLocation", self._checkpoint(dataset.name))
            .trigger(**trigger)
            .foreachBatch(self._bounded_batch(dataset, measured))
            .start()
        )

    def _bounded_batch(self, dataset: Dataset, measured: dict):
        path, notes = self._path(dataset.name), self._notes_path(dataset.name)
        session = own_session(self.session, {})

        def write(batch: DataFrame, batch_id: int) -> None:
            name = _batch_name(batch_id)
            if {name, f"{name}.parquet"} & set(files.child_names(session, path)):
                # The batch was written, but its commit was not recorded.
                return
            noted = sorted(n for n in files.child_names(session, notes) if n < name)
            last = files.read_text(session, f"{notes}/{noted[-1]}") if noted else None
            waiting = self._pending_path(dataset.name)
            pending = Pending(session, waiting, dataset.bound, batch.schema, last)
            now = pending.take(batch, name)
            due = pending.due(now)
            note = pending.kept(now, name)
            # A batch that runs again before its rows appear starts from the note before.
            files.write_text(session, f"{notes}/{name}", note)
            if due is not None:
                rows = self._build(session, dataset, due, measured)
                self._append(session, dataset, conform(rows, dataset.schema), name)
            pending.tidy(note)
            for old in noted[:-1]:
                files.delete(session, f"{notes}/{old}")

        return write

    def _keyed_batch(self, dataset: Dataset):
        path, root = self._path(dataset.name), self.root

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            name = _batch_name(batch_id)
            published = files.child_names(spark, path)
            if name in published:
                # The batch was written, but its commit was not recorded.
                return
            earlier = [n for n in published if n < name]
            start = 0
            if earlier:
                # Keys grow from batch to batch, so the last one holds the highest.
                last = spark.read.schema(f"{dataset.key} bigint").parquet(f"{path}/{max(earlier)}")
                start = last.agg({dataset.key: "max"}).first()[0]
            staging = f"{root}/staging/{dataset.name}-{uuid.uuid4().hex}"
            keyed = assign_keys(
                batch,
                dataset.key,
                order_by=dataset.order_by,
                start=start,
                staging=staging,
                stable_input=dataset.stable_input,
            )
            if not keyed.isEmpty():
                conform(keyed, dataset.schema).write.parquet(f"{staging}/keyed")
                files.publish(spark, f"{staging}/keyed", f"{path}/{name}")
            files.delete(spark, staging)

        return write

    def _once_batch(self, dataset: Dataset):
        """Rows are written with their places first; only where some repeat, they are written again."""
        path, place = self._path(dataset.name), ["_part", "_position"]

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            name = _batch_name(batch_id)
            if name in files.child_names(spark, path):
                return
            staging = f"{self.root}/staging/{dataset.name}-{uuid.uuid4().hex}"
            placed = with_places(batch, batch.columns)
            placed.write.parquet(f"{staging}/arrived")
            arrived = spark.read.schema(placed.schema).parquet(f"{staging}/arrived")
            stored = self._files(spark.read, dataset.name)
            found = once.repeats(arrived, stored, place, dataset.identity)
            found.write.parquet(f"{staging}/repeats")
            found = spark.read.schema(found.schema).parquet(f"{staging}/repeats")
            ready = f"{staging}/arrived"
            if not found.isEmpty():
                ready = f"{staging}/kept"
                gone = once.dropped(arrived, found, place, dataset.identity)
                gone.write.parquet(f"{staging}/dropped")
                gone = spark.read.schema(gone.schema).parquet(f"{staging}/dropped")
                for low, high in once.waves(arrived, place[0], _WAVE):
                    within = F.col(place[0]).between(low, high)
                    kept = once.without(arrived.where(within), gone.where(within), place)
                    kept.select(*batch.columns).write.mode("append").parquet(ready)
            files.publish(spark, ready, f"{path}/{name}")
            files.delete(spark, staging)

        return write

    def _few_batch(self, dataset: Dataset):
        """Rows in no more files than asked for."""
        path = self._path(dataset.name)

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            name = _batch_name(batch_id)
            if not {name, f"{name}.parquet"} & set(files.child_names(spark, path)):
                self._append(spark, dataset, batch, name)

        return write

    def _checked_batch(self, dataset: Dataset):
        """Good rows, rows in quarantine and counts, out of one pass over the batch."""
        path, apart = self._path(dataset.name), self._quarantine_path(dataset.name)
        state = expectations.STATE

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            name = _batch_name(batch_id)
            if name in files.child_names(spark, path):
                return
            staging = f"{self.root}/staging/{dataset.name}-{uuid.uuid4().hex}"
            counted = Observation()
            rows = expectations.observed(
                expectations.judged(batch, dataset.rules), dataset.rules, counted
            )
            written = rows.where(F.col(state) != expectations.DROPPED)
            if dataset.output_partitions is not None:
                written = written.repartition(dataset.output_partitions, *dataset.together)
            written.write.partitionBy(state).parquet(staging)
            counts = counted.get
            told = [
                {"rule": r.name, "action": r.action, "checked": counts["rows"], "broken": counts[r.name]}
                for r in dataset.rules
            ]
            lines = "\n".join(map(json.dumps, told))
            files.write_text(spark, f"{self._counts_path(dataset.name)}/{name}.json", lines)
            # The good rows come last: with them the batch counts as written.
            made = files.child_names(spark, staging)
            if f"{state}={expectations.QUARANTINED}" in made:
                files.delete(spark, f"{apart}/{name}")
                files.publish(spark, f"{staging}/{state}={expectations.QUARANTINED}", f"{apart}/{name}")
            if f"{state}={expectations.KEPT}" in made:
                files.publish(spark, f"{staging}/{state}={expectations.KEPT}", f"{path}/{name}")
            else:
                files.make_folder(spark, f"{path}/{name}")
            files.delete(spark, staging)

        return write

    def _merged_batch(self, dataset: Dataset):
        path = self._path(dataset.name)

        def write(batch: DataFrame, batch_id: int) -> None:
            store = Buckets(batch.sparkSession, path)
            if store.listing()["batch"] >= batch_id:
                # The batch was merged, but its commit was not recorded.
                return
            sections, live = dataset.merge.merge(store, batch)
            store.commit(batch_id, sections, live)

        return write

    def _replace(self, dataset: Dataset) -> None:
        rows = conform(self._built(dataset, {}), dataset.schema)
        path = self._path(dataset.name)
        before = sorted(files.child_names(self.spark, path))
        number = int(before[-1].split("-")[1]) + 1 if before else 0
        version = f"{path}/version-{number:012d}"
        rows.write.parquet(version)
        if dataset.temporary:
            self.session.read.schema(rows.schema).parquet(version).createOrReplaceTempView(
                dataset.name
            )
            kept = before[-1:]
        else:
            # Readers see the last version until the table points to this one.
            last = self._location(dataset)
            kept = [] if last is None else [last.rstrip("/").rsplit("/", 1)[-1]]
            self._create(dataset, rows.schema, path=version)
            table = self.table_name(dataset.name)
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        # Keep the version that readers may still be on, and no other: a newer
        # one is what a failed run has left.
        for old in before:
            if old not in kept:
                files.delete(self.spark, f"{path}/{old}")

    def _location(self, dataset: Dataset) -> str | None:
        """Where the catalog says the table's files are."""
        table = self.table_name(dataset.name)
        if not self.spark.catalog.tableExists(table):
            return None
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
        return described.where("col_name = 'Location'").first()["data_type"]

    def _create(self, dataset: Dataset, schema: T.StructType, path: str | None = None, **options):
        """Put the table in the catalog, or bring its entry up to date.

        A recomputed table takes a changed schema; for a stream that is an error,
        as the rows it has are of the old one.
        """
        table = self.table_name(dataset.name)
        if dataset.temporary:
            return
        exists = self.spark.catalog.tableExists(table)
        if exists and not _same_columns(self.spark.table(table).schema, schema):
            if dataset.kind != RECOMPUTED:
                raise ValueError(
                    f"{table} holds {self.spark.table(table).schema.simpleString()}, but "
                    f"{schema.simpleString()} is built; a full refresh starts it over"
                )
            # The table is external, so its files stay.
            self.spark.sql(f"DROP TABLE {table}")
            exists = False
        if not exists:
            self.spark.catalog.createTable(
                table,
                path=path or self._path(dataset.name),
                source="parquet",
                schema=schema,
                description=dataset.comment,
                **options,
            )
        else:
            self.spark.sql(f"COMMENT ON TABLE {table} IS {_literal(dataset.comment)}")
        properties = {
            **dataset.properties,
            "reset.allowed": str(dataset.reset_allowed).lower(),
            "trigger.interval": dataset.trigger,
        }
        gone = self._set_properties(table) - set(properties)
        pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        names = f"{_literal(_OWN)} = {_literal(json.dumps(sorted(properties)))}"
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs}, {names})")
        if gone:
            keys = ", ".join(map(_literal, sorted(gone)))
            self.spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({keys})")

    def _set_properties(self, table: str) -> set[str]:
        """The properties that this lake has set before."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == _OWN).collect()
        return set(json.loads(rows[0]["value"])) if rows else set()

    def _clear(self, dataset: Dataset) -> None:
        if self._is_view(dataset.name):
            return
        if not dataset.temporary and dataset.kind != MERGED:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(dataset.name)}")
        files.delete(self.spark, self._path(dataset.name))
        files.delete(self.spark, self._checkpoint(dataset.name))
        files.delete(self.spark, self._pinned_path(dataset.name))
        files.delete(self.spark, self._quarantine_path(dataset.name))
        files.delete(self.spark, self._counts_path(dataset.name))
        files.delete(self.spark, self._notes_path(dataset.name))
        files.delete(self.spark, self._pending_path(dataset.name))

    def _notes_path(self, name: str) -> str:
        """Where a join notes the files of its inputs that it has read, or that wait."""
        return f"{self.root}/joined/{name}"

    def _pending_path(self, name: str) -> str:
        """The rows that wait in a bounded dataset."""
        return f"{self.root}/pending/{name}"

    def _pinned_path(self, name: str) -> str:
        return f"{self.root}/pinned/{name}.json"

    def _unmeasured(self, dataset: Dataset) -> bool:
        path = self._pinned_path(dataset.name)
        return dataset.measure is not None and not files.exists(self.spark, path)

    def _pinned(self, dataset: Dataset, wait: bool) -> dict | None:
        """What was measured for the dataset; its pinned settings are checked.

        None if there is nothing to measure yet and the dataset can ``wait``.
        """
        path = self._pinned_path(dataset.name)
        given = json.loads(json.dumps(dict(dataset.pinned)))
        text = files.read_text(self.spark, path)
        if text is None:
            measured = {}
            if dataset.measure is not None:
                complete = [self._read(self.session, i) for i in dataset.inputs]
                measured = dataset.measure(self.session, *complete)
            if measured is None:
                if wait:
                    return None
                measured = {}
            text = json.dumps({"given": given, "measured": measured})
            files.write_text(self.spark, path, text)
        stored = json.loads(text)
        if stored["given"] != given:
            raise ValueError(
                f"{dataset.name} was started with {stored['given']}, not {given}: its join state "
                "would miss matches; go back to those settings or do a full refresh"
            )
        return stored["measured"]

    def _check_batches(self, dataset: Dataset) -> None:
        started = files.exists(self.spark, f"{self._checkpoint(dataset.name)}/offsets")
        if not started and files.child_names(self.spark, self._path(dataset.name)):
            raise ValueError(
                f"{dataset.name} has rows but no checkpoint: new batches would pass for old ones"
            )


_BROKEN_FIELD = T.StructField(expectations.BROKEN, T.ArrayType(T.StringType()))
# Rows that a batch of a ``once`` dataset is cleared of repeats at a time.
_WAVE = 32_000_000
# The property that names those which a lake has set itself.
_OWN = "tidemark.properties"


def _literal(text: str) -> str:
    escaped = str(text).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Equal names and types; a file table has all its columns nullable."""
    plain = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return plain(a) == plain(b)


def _batch_name(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def _levels(datasets: Sequence[Dataset]) -> list[list[Dataset]]:
    """Datasets grouped so that each comes after all of its inputs."""
    level: dict[str, int] = {}
    for dataset in datasets:
        unknown = [i for i in dataset.inputs if i not in level]
        if unknown:
            raise ValueError(f"{dataset.name}: list {unknown} before it")
        level[dataset.name] = 1 + max((level[i] for i in dataset.inputs), default=-1)
    groups: list[list[Dataset]] = [[] for _ in range(1 + max(level.values(), default=-1))]
    for dataset in datasets:
        groups[level[dataset.name]].append(dataset)
    return groups
