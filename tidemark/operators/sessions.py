"""Sessions of a key: runs of events with no gap above a bound, kept as events come."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.streaming.buckets import BUCKET, Buckets, bucket_of

_CLOCK = "_newest"


def merged_runs(spans: DataFrame, by: Sequence[str], gap: int, sums: Sequence[str]) -> DataFrame:
    """``started`` to ``ended`` spans of each ``by``, those at most ``gap`` apart made one."""
    before = Window.partitionBy(*by).orderBy("started", "ended")
    reached = F.max("ended").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("started") - reached <= gap, 0).otherwise(1)
    numbered = spans.withColumn("_opens", opens).withColumn(
        "_run", F.sum("_opens").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy(*by, "_run").agg(
        F.min("started").alias("started"),
        F.max("ended").alias("ended"),
        *(F.sum(c).alias(c) for c in sums),
    ).drop("_run")


@dataclass(frozen=True)
class Sessions:
    """Merges events (``key``, ``at`` in epoch seconds, ``sums``) into stored sessions.

    A session gets ``started``, ``ended``, ``events`` and the sums; an event
    between two sessions joins them, whenever it comes.  With ``lateness``, an
    event that is more seconds than that behind the newest of earlier batches
    does not change them any more: it goes to a section of its own, which
    ``late`` reads.  Events without a key or time are left out.

    Events are summed per key and time map-side, and then to runs within slices
    of time of a key, so a hot key's events spread over its slices and only its
    runs meet; the buckets of the batch's keys are read and written, no other.
    """

    key: str
    sums: Mapping[str, str] = field(default_factory=dict)
    gap: int = 1800
    lateness: int | None = None
    buckets: int = 64

    def merge(self, store: Buckets, batch: DataFrame) -> tuple[dict[str, DataFrame], dict[str, Column]]:
        names = ["events", *self.sums]
        events = batch.where(F.col(self.key).isNotNull() & F.col("at").isNotNull())
        events = events.groupBy(self.key, "at").agg(
            F.count(F.lit(1)).alias("events"), *(F.sum(c).alias(name) for name, c in self.sums.items())
        )
        events = store.staged(events.withColumn(BUCKET, bucket_of([self.key], self.buckets)))
        newest = events.agg(F.max("at")).first()[0]
        if newest is None:
            return {}, {}
        made: dict[str, DataFrame] = {}
        clock = store.rows("clock")
        known = None if clock is None else clock.first()[_CLOCK]
        made["clock"] = store.spark.range(1).select(
            F.lit(newest if known is None else max(known, newest)).cast("bigint").alias(_CLOCK),
            F.lit(0).alias(BUCKET),
        )
        if self.lateness is not None and known is not None:
            behind = F.col("at") < known - self.lateness
            late, events = events.where(behind), events.where(~behind)
            made |= self._rewritten(store, "late", late, lambda rows: rows)
        spans = events.select(
            BUCKET,
            self.key,
            F.floor(F.col("at") / (64 * max(1, self.gap))).alias("_slice"),
            F.col("at").alias("started"),
            F.col("at").alias("ended"),
            *names,
        )
        runs = merged_runs(spans, [BUCKET, self.key, "_slice"], self.gap, names).drop("_slice")
        joined = lambda rows: merged_runs(rows, [BUCKET, self.key], self.gap, names)
        return made | self._rewritten(store, "sessions", store.staged(runs), joined), {}

    def _rewritten(self, store: Buckets, section: str, new: DataFrame, merge) -> dict[str, DataFrame]:
        """The touched buckets of a section with the new rows in them."""
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
        if not touched:
            return {}
        before = store.rows(section, touched)
        both = new if before is None else new.unionByName(before)
        return {section: merge(both.repartition(BUCKET))}

    def view(self, store: Buckets) -> DataFrame | None:
        """The sessions as they are now."""
        rows = store.rows("sessions")
        return None if rows is None else rows.drop(BUCKET)

    def late(self, store: Buckets) -> DataFrame | None:
        """The events that came too late, summed per key and time."""
        rows = store.rows("late")
        return None if rows is None else rows.drop(BUCKET)
