"""Versions that hold for a time, and joins with the one that held at a given time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.facts import NO_SALT, Salting

DAY = 86_400
RATIO = 16
# Widths of time buckets: 1, 16, 256, 4096 and 65536 days; longer intervals are in no bucket.
LEVELS = 5

_LEVEL, _BUCKET, _SALT = "_level", "_bucket", "_salt"


def successive(versions: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Versions of which at most one holds at any time, per key.

    Each holds from ``start`` (null: always) until its own ``end`` or the start of
    the next version, whichever comes first.  Of versions that start together
    the one that ends last stays; those that hold for no time go.  Versions of
    one key are sorted in one task but never held together.
    """
    others = [c for c in versions.columns if c not in (key, start, end)]
    order = [F.col(start).asc_nulls_first(), F.col(end).asc_nulls_last(), F.xxhash64(F.lit(0), *others)]
    following = F.lead(start).over(Window.partitionBy(key).orderBy(*order))
    holds = versions.withColumn(end, F.least(F.col(end), following))
    return holds.where(F.col(end).isNull() | F.col(start).isNull() | (F.col(start) < F.col(end)))


def _slot(level: int):
    return lambda bucket: F.struct(F.lit(level).alias(_LEVEL), bucket.cast("bigint").alias(_BUCKET))


def _slots(start: Column, end: Column, base: int) -> Column:
    """The buckets of an interval, at the finest level where it needs at most ``RATIO`` + 1 of them."""
    slots = F.array(F.struct(F.lit(LEVELS).alias(_LEVEL), F.lit(0).cast("bigint").alias(_BUCKET)))
    for level in reversed(range(LEVELS)):
        width = base * RATIO**level
        first, last = F.floor(start / width), F.floor((end - 1) / width)
        fits = start.isNotNull() & end.isNotNull() & (end - start <= RATIO * width)
        # Outside of the condition the sequence must still be a short one.
        buckets = F.sequence(F.when(fits, first).otherwise(0), F.when(fits, last).otherwise(0))
        at_level = F.transform(buckets, _slot(level))
        slots = F.when(fits, at_level).otherwise(slots)
    return slots


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    *,
    salting: Salting = NO_SALT,
    base: int = DAY,
) -> DataFrame:
    """``rows`` joined with the versions of their key that hold at ``at`` (batch only).

    ``at``, ``start`` and ``end`` are whole numbers, e.g. epoch seconds; a version
    holds from ``start`` up to but not including ``end``, null being unbounded.
    Rows without a version, or without a time, give nothing; ``start`` and ``end``
    are dropped.

    Both sides meet in time buckets of their key, so it is a plain equi-join with
    a condition.  A short interval lies in narrow buckets and a long one in wide
    ones, so no version has more than ``RATIO`` + 1 copies, and the lines of a key
    with many versions part by time.  Rows have a copy for each level that some
    version uses, at most ``LEVELS`` + 1 and only one where all versions are
    unbounded.  What no bucket parts is spread by ``salting``, see ``hot_keys``.
    """
    spread = salting.count(key)
    sides = versions.where(F.col(key).isNotNull()).select(
        "*", F.explode(_slots(F.col(start), F.col(end), base)).alias("_slot")
    )
    sides = sides.select(*versions.columns, "_slot.*")
    # At most LEVELS + 1 numbers.
    used = sorted(r[0] for r in sides.select(_LEVEL).distinct().collect())
    if salting.used:
        sides = sides.withColumn(_SALT, F.explode(F.sequence(F.lit(0), spread - 1)))
    where = [
        F.struct(
            F.lit(level).alias(_LEVEL),
            (F.floor(F.col(at) / (base * RATIO**level)) if level < LEVELS else F.lit(0))
            .cast("bigint")
            .alias(_BUCKET),
        )
        for level in used or [LEVELS]
    ]
    slots = rows.columns
    marked = rows
    if salting.used:
        marked = marked.withColumn(_SALT, F.pmod(F.xxhash64(*rows.columns), spread).cast("int"))
    if len(where) == 1:
        marked = marked.withColumns({_LEVEL: where[0][_LEVEL], _BUCKET: where[0][_BUCKET]})
    else:
        marked = marked.withColumn("_slot", F.explode(F.array(*where)))
        marked = marked.select(*slots, *([_SALT] if salting.used else []), "_slot.*")
    on: Sequence[str] = [key, _LEVEL, _BUCKET, *([_SALT] if salting.used else [])]
    joined = marked.join(sides, list(on))
    timed = F.col(at).isNotNull()
    holds = timed & (F.col(start).isNull() | (F.col(at) >= F.col(start))) & (
        F.col(end).isNull() | (F.col(at) < F.col(end))
    )
    return joined.where(holds).drop(_LEVEL, _BUCKET, _SALT, start, end)


def fact_sales_as_of(
    lines: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    *,
    product_salting: Salting = NO_SALT,
    customer_salting: Salting = NO_SALT,
) -> DataFrame:
    """Order lines with the keys of the product and customer versions valid at their time.

    Both dimensions come with ``valid_from`` and ``valid_to`` in epoch seconds,
    made successive by ``successive``; lines with an ``ordered_at`` of the kind.
    """
    p = products.select("product_key", "product_id", "valid_from", "valid_to")
    c = customers.select("customer_key", "customer_id", "valid_from", "valid_to")
    sold = as_of_join(
        lines, p, "product_id", "ordered_at", "valid_from", "valid_to", salting=product_salting
    )
    sold = as_of_join(
        sold, c, "customer_id", "ordered_at", "valid_from", "valid_to", salting=customer_salting
    )
    return sold.select(
        "order_number",
        "customer_key",
        "product_key",
        F.timestamp_seconds("ordered_at").cast("date").alias("order_datetime"),
        "unit_price",
        "quantity",
        (F.col("unit_price").cast("bigint") * F.col("quantity")).alias("total_price"),
    )
