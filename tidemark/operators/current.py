"""The current row of each key, out of creates, updates and deletes in any order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleanse import explode_kept
from tidemark.schemas import STRING, struct
from tidemark.streaming.buckets import BUCKET, Buckets, bucket_of

DELETED = "_deleted"


def keyed_changes(
    messages: DataFrame, keys: T.StructType, row: T.StructType, order: Sequence[str] = ("offset",)
) -> DataFrame:
    """Change messages as ``keys``, the other columns of ``row``, ``order`` and ``_deleted``.

    The key comes from the message's key, so a tombstone, which has no value, is
    a delete too.  A message that does not parse, or without a key, gives no row.
    Key and value are parsed once each.  ``order`` are columns of the message that
    grow with each change of a key; the messages of a key share a bus partition,
    so its offset does.
    """
    envelope = struct(payload=struct(after=row, op=STRING))
    parsed = messages.select(
        F.from_json(F.col("key"), struct(payload=keys))["payload"].alias("_key"),
        F.from_json(F.col("value"), envelope)["payload"].alias("_change"),
        F.col("value").isNull().alias("_empty"),
        *order,
    )
    after = F.col("_change.after")
    gone = F.col("_empty") | (F.coalesce(F.col("_change.op"), F.lit("")) == "d")
    has_key = F.lit(True)
    for name in keys.names:
        has_key = has_key & F.col(f"_key.{name}").isNotNull()
    others = [f.name for f in row.fields if f.name not in keys.names]
    change = F.struct(
        *(F.col(f"_key.{n}").alias(n) for n in keys.names),
        *(F.when(~gone, after[n]).alias(n) for n in others),
        *(F.col(c) for c in order),
        gone.alias(DELETED),
    )
    wanted = F.when(has_key & (gone | after.isNotNull()), change)
    return explode_kept(parsed, wanted, "_row").select("_row.*")


@dataclass(frozen=True)
class LastWriter:
    """Merges changes so that the row of the highest ``order`` stays, per key.

    Deletes stay as well, apart from the rows that readers get, so a change that
    arrives after the delete that follows it does not bring its key back.  Each
    batch is reduced to one row per key map-side first, so a hot key sends one
    row per task; only the buckets of changed keys are read and written.
    """

    keys: Sequence[str]
    order: Sequence[str] = ("offset",)
    buckets: int = 64

    def latest(self, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """One row per key."""
        held = [*by, *self.keys]
        others = [c for c in rows.columns if c not in held]
        newest = F.max_by(F.struct(*others), F.struct(*self.order)).alias("_newest")
        return rows.groupBy(*held).agg(newest).select(*held, "_newest.*")

    def merge(self, store: Buckets, batch: DataFrame) -> tuple[dict[str, DataFrame], dict[str, Column]]:
        """The new rows of the buckets that a batch touches, and which of them are live."""
        changed = store.staged(
            self.latest(batch).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        )
        # At most as many numbers as there are buckets.
        touched = [r[0] for r in changed.select(BUCKET).distinct().collect()]
        if not touched:
            return {}, {}
        before = store.rows("rows", touched)
        both = changed if before is None else changed.unionByName(before)
        merged = self.latest(both.repartition(BUCKET), [BUCKET])
        return {"rows": merged}, {"rows": ~F.col(DELETED)}

    def view(self, store: Buckets) -> DataFrame | None:
        """The current rows, without what the merge needs."""
        rows = store.rows("rows", live_only=True)
        return None if rows is None else rows.drop(BUCKET, DELETED, *self.order)
