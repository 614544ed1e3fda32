"""Two inputs that wait for each other within a bound of event time, kept as files.

A batch's rows are written once, under ``path``, in a folder of their own; small
notes, one per batch, name the folders with the span of their times.  A row of the
first input (a line) falls due once nothing within the bound can come for it any
more.  Only then is it joined, with what has come of the second input, so no row
is looked up one by one and the work of a batch is that of batch joins.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming import files

_SIDE, _LATE, _LINE, _VERSION = "_side", "late", "line", "version"
# Folders beyond this number are made one.
_FOLDERS = 64


@dataclass(frozen=True)
class Bound:
    """How two streams wait for each other.

    A line (at its ``at``) and a version (at its ``time``) belong together if they
    are at most ``within`` apart.  The mark stands ``delay`` behind the newest event
    of either stream, whichever is older; rows that come at or behind the mark of
    the batches before are dropped, as are rows without a time.  A line falls due
    when the mark has reached ``within`` after it.  Versions are kept twice
    ``within``, as long as lines that they may match wait.  ``delay`` and ``within``
    are intervals such as ``1 hour``.
    """

    at: str
    time: str
    delay: str
    within: str

    def arrivals(self, lines: DataFrame, versions: DataFrame) -> DataFrame:
        """The rows of both streams as one stream."""
        nothing = lambda rows: F.lit(None).cast(rows.schema)
        theirs = nothing(versions).alias(_VERSION)
        return lines.select(F.struct(*lines.columns).alias(_LINE), theirs).unionByName(
            versions.select(nothing(lines).alias(_LINE), F.struct(*versions.columns).alias(_VERSION))
        )


class Pending:
    """What waits, under ``path``; ``note`` is what the batch before has noted, if any."""

    def __init__(self, spark: SparkSession, path: str, bound: Bound, schema: T.StructType, note: str | None):
        self.spark, self.path, self.bound, self.schema = spark, path, bound, schema
        self.last = {"mark": None, "newest": {}, "folders": []} if note is None else json.loads(note)

    def take(self, batch: DataFrame, name: str) -> dict:
        """Keep the rows of a batch (of ``arrivals``); what there is and the mark after it."""
        at, time = F.col(f"{_LINE}.{self.bound.at}"), F.col(f"{_VERSION}.{self.bound.time}")
        event = F.coalesce(at, time)
        late = event.isNull()
        if self.last["mark"] is not None:
            late = late | (event <= _moment(self.last["mark"]))
        side = F.when(F.coalesce(late, F.lit(True)), _LATE)
        side = side.when(F.col(_LINE).isNotNull(), _LINE).otherwise(_VERSION)
        folder = f"{name}-{uuid.uuid4().hex}"
        batch.withColumn(_SIDE, side).write.partitionBy(_SIDE).parquet(f"{self.path}/{folder}")
        files.delete(self.spark, f"{self.path}/{folder}/{_SIDE}={_LATE}")
        newest, kept = dict(self.last["newest"]), self._described(folder)
        for side, span in kept["spans"].items():
            newest[side] = max(newest.get(side, span["mark"]), span["mark"])
        mark = self.last["mark"]
        if len(newest) == 2:
            mark = max([min(newest.values()), *([] if mark is None else [mark])])
        return {"mark": mark, "newest": newest, "folders": [*self.last["folders"], kept]}

    def due(self, now: dict) -> tuple[DataFrame, DataFrame] | None:
        """The lines that have fallen due since the batch before, and all versions for them."""
        if now["mark"] is None or now["mark"] == self.last["mark"]:
            return None
        mark = now["mark"]
        lines = [f for f in now["folders"] if _LINE in f["spans"] and f["spans"][_LINE]["first_due"] <= mark]
        if not lines:
            return None
        rows = self._rows(lines, _LINE)
        falls_due = self._falls_due()
        rows = rows.where(falls_due <= _moment(mark))
        if self.last["mark"] is not None:
            rows = rows.where(falls_due > _moment(self.last["mark"]))
        return rows, self._rows(now["folders"], _VERSION)

    def kept(self, now: dict, name: str) -> str:
        """The note of the batch: without what nothing waits for, in few folders."""
        mark, kept = now["mark"], []
        oldest = None if mark is None else self._oldest(mark)
        for folder in now["folders"]:
            spans = dict(folder["spans"])
            if mark is not None and _LINE in spans and spans[_LINE]["last_due"] <= mark:
                del spans[_LINE]
            if oldest is not None and _VERSION in spans and spans[_VERSION]["last"] < oldest:
                del spans[_VERSION]
            if spans:
                kept.append({"name": folder["name"], "spans": spans})
        if len(kept) > _FOLDERS:
            kept = self._as_one(kept, name, mark, oldest)
        return json.dumps({**now, "folders": kept})

    def tidy(self, note: str) -> None:
        """Delete the folders that neither ``note`` nor the one before it names."""
        used = {f["name"] for n in (self.last, json.loads(note)) for f in n["folders"]}
        for name in files.child_names(self.spark, self.path):
            if name not in used:
                files.delete(self.spark, f"{self.path}/{name}")

    def _as_one(self, folders: list[dict], name: str, mark: int | None, oldest: int | None) -> list[dict]:
        folder, column = f"{name}-{uuid.uuid4().hex}", {_LINE: self._falls_due(), _VERSION: F.col(self.bound.time)}
        for side in (_LINE, _VERSION):
            rows = self._rows(folders, side)
            if mark is not None and side == _LINE:
                rows = rows.where(column[side] > _moment(mark))
            if oldest is not None and side == _VERSION:
                rows = rows.where(column[side] >= _moment(oldest))
            if side == _VERSION:
                rows = rows.distinct()
            rows = rows.select(F.struct(*rows.columns).alias(side))
            rows.write.parquet(f"{self.path}/{folder}/{_SIDE}={side}")
        made = self._described(folder)
        return [made] if made["spans"] else []

    def _described(self, folder: str) -> dict:
        """A folder with, for each input that has rows in it, the span of their times."""
        delay, within = (F.expr(f"INTERVAL {i}") for i in (self.bound.delay, self.bound.within))
        found = {"name": folder, "spans": {}}
        for side, event in ((_LINE, self.bound.at), (_VERSION, self.bound.time)):
            if f"{_SIDE}={side}" not in files.child_names(self.spark, f"{self.path}/{folder}"):
                continue
            spans = {"last": F.max(event), "mark": F.max(event) - delay}
            if side == _LINE:
                spans |= {"first_due": F.min(event) + within, "last_due": F.max(event) + within}
            columns = [F.unix_micros(c.cast("timestamp")).alias(n) for n, c in spans.items()]
            span = self._rows([{"name": folder, "spans": {side: {}}}], side).agg(*columns).first()
            if span["last"] is not None:
                found["spans"][side] = span.asDict()
        return found

    def _rows(self, folders: list[dict], side: str) -> DataFrame:
        kind = self.schema[side].dataType
        paths = [f"{self.path}/{f['name']}/{_SIDE}={side}" for f in folders if side in f["spans"]]
        if not paths:
            return self.spark.createDataFrame([], kind)
        stored = T.StructType([T.StructField(side, kind)])
        return self.spark.read.schema(stored).parquet(*paths).select(f"{side}.*")

    def _falls_due(self) -> Column:
        return F.col(self.bound.at) + F.expr(f"INTERVAL {self.bound.within}")

    def _oldest(self, mark: int) -> int:
        """Versions before this match no line that waits or may come."""
        within = self.bound.within
        moment = f"timestamp_micros({mark}) - INTERVAL {within} - INTERVAL {within}"
        return self.spark.sql(f"SELECT unix_micros({moment})").first()[0]


def _moment(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))
