"""Ranks, running totals and previous values of groups that may be larger than a task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keys import write_with_places
from tidemark.session import scratch_dir

_PART, _POSITION = "_part", "_position"


def running(
    rows: DataFrame,
    key: str,
    order_by: Sequence[str],
    *,
    rank: str = "rank",
    totals: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    staging: str | None = None,
) -> DataFrame:
    """``rows`` with their place in the order of their group, and what came before (batch only).

    ``rank`` counts from 1, ``totals`` maps new columns to those that they add up
    so far, ``previous`` to those whose value in the row before they hold (null in
    the first row).  Rows that tie are ordered by a hash of all their columns, so
    only equal ones may swap.  Null keys form a group; null values add nothing.

    Rows are range-sorted by key and order, so a group lies in as many ranges as
    its size asks for, and written.  Each range then counts for itself, and what
    a group carries over from earlier ranges - at most one group per range - is
    summed and broadcast.  Equal rows stay in one range.
    """
    totals, previous = dict(totals or {}), dict(previous or {})
    columns = rows.columns
    order = [key, *order_by, F.xxhash64(*columns)]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    path = staging or scratch_dir(rows.sparkSession, "running")
    placed = write_with_places(ordered, columns, path)

    # One row for each group in each range.
    last = F.max_by(F.struct(*(F.col(c) for c in previous.values())), _POSITION) if previous else F.lit(None)
    parts = placed.groupBy(F.col(key).alias("_key"), _PART).agg(
        F.count(F.lit(1)).alias("_n"),
        *(F.sum(c).alias(f"_sum_{name}") for name, c in totals.items()),
        last.alias("_last"),
    )
    by_part = Window.partitionBy("_key").orderBy(_PART)
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        "_key",
        F.col(_PART).alias("_in"),
        F.sum("_n").over(earlier).alias("_before"),
        *(F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in totals),
        F.lag("_last").over(by_part).alias("_last"),
    )
    # Only the first group of a range can have begun in an earlier one.
    carried = F.broadcast(carried.where("_before > 0"))

    inside = Window.partitionBy(_PART, key).orderBy(_POSITION)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = placed.select(
        "*",
        F.row_number().over(inside).alias("_rank"),
        *(F.sum(c).over(so_far).alias(f"_sum_{name}") for name, c in totals.items()),
        *(F.lag(c).over(inside).alias(f"_was_{name}") for name, c in previous.items()),
    )
    joined = counted.join(
        carried, (F.col(_PART) == F.col("_in")) & F.col(key).eqNullSafe(F.col("_key")), "left"
    )
    nothing = F.lit(0)
    add = lambda a, b: F.when(F.col(a).isNull(), F.col(b)).when(F.col(b).isNull(), F.col(a)).otherwise(F.col(a) + F.col(b))
    return joined.select(
        *columns,
        (F.col("_rank") + F.coalesce("_before", nothing)).cast("bigint").alias(rank),
        *(add(f"_sum_{name}", f"_before_{name}").alias(name) for name in totals),
        *(
            F.when(F.col("_rank") == 1, F.col("_last").getField(c)).otherwise(F.col(f"_was_{name}")).alias(name)
            for name, c in previous.items()
        ),
    )


def top_of_groups(rows: DataFrame, group: Sequence[str], order_by: Sequence, k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group in the given order, with their rank from 1.

    The order should tell all rows apart; among equal ones any may come first.
    Spark limits each group before the shuffle as well as after it, so a task
    hands on ``k`` rows of a group at most, however large that is.
    """
    window = Window.partitionBy(*group).orderBy(*order_by)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
