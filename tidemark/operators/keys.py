"""Surrogate keys: distinct, gap-free bigints for all rows of a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.streaming import files

_PART, _POSITION = "_part", "_position"


def assign_keys(
    rows: DataFrame,
    key: str,
    *,
    order_by=None,
    start: int = 0,
    staging: str | None = None,
    stable_input: bool = False,
) -> DataFrame:
    """Put column ``key`` with start+1, start+2, ... in front of ``rows``.

    Without ``order_by`` keys follow the input partitions and nothing is
    shuffled.  With it, keys follow that order: a range shuffle sorts the rows
    over many tasks.

    The rows are written to ``staging`` (a fresh folder of the scratch root by
    default) together with their place in the partition before any key is given
    out.  A lost executor then cannot lead to other places, hence other keys,
    for part of the rows.  The result reads from ``staging``, which whoever owns
    that folder removes when the result is no longer read.

    Rows that tie in ``order_by`` are told apart by their arrival place, so they
    are first written in arrival order; that copy goes once they are sorted.
    With ``stable_input`` this first write is left out.  It says that each task
    of the input always meets its rows in the same order, as where files are
    read and parsed without a shuffle.
    """
    spark = rows.sparkSession
    columns = rows.columns
    staging = staging or scratch_dir(spark, "keys")

    if order_by is None:
        placed = write_with_places(rows, columns, f"{staging}/arrival")
    else:
        # The arrival place parts rows that tie, copies included, so one hot
        # key spreads over as many ranges as its size asks for.
        order = [*order_by, _PART, _POSITION]
        if stable_input:
            arrived = with_places(rows, columns)
        else:
            arrived = write_with_places(rows, columns, f"{staging}/arrival")
        ordered = arrived.repartitionByRange(*order).sortWithinPartitions(*order)
        placed = write_with_places(ordered, columns, f"{staging}/ordered")
        files.delete(spark, f"{staging}/arrival")

    # One row per written partition: a count bounded by the number of tasks,
    # whatever the size of the data.
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    number = F.col("_offset") + F.col(_POSITION) + F.lit(start + 1).cast("bigint")
    return placed.join(F.broadcast(offsets), _PART).select(number.alias(key), *columns)


def with_places(rows: DataFrame, columns) -> DataFrame:
    """``columns`` and where each row is: ``_part``, the task, and ``_position`` in it."""
    # The generated id holds the partition in its upper bits and counts from
    # zero in the lower 33.
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    return rows.select(
        *columns,
        F.shiftright("_id", 33).alias(_PART),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias(_POSITION),
    )


def write_with_places(rows: DataFrame, columns, path: str) -> DataFrame:
    """``rows`` written with their places, and read from there."""
    placed = with_places(rows, columns)
    placed.write.parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)
