"""The gold layer: the order-line fact and the two sales aggregates.

Dimensions keep every version of a row under its own key, so a line joins to
each version of its product and of its customer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT_SEED = 20


@dataclass(frozen=True)
class Salting:
    """How the rows of each key spread over the partitions of a streaming join.

    ``hot`` holds (salts, keys) pairs for the keys that were found to hold many
    rows; every other key gets ``base`` salts.
    """

    base: int = 1
    hot: Sequence[tuple[int, Sequence]] = ()

    @property
    def used(self) -> bool:
        return self.base > 1 or bool(self.hot)

    def count(self, key: str) -> Column:
        """The number of salts of a row's key."""
        chosen = F.lit(self.base)
        for salts, keys in self.hot:
            chosen = F.when(F.col(key).isin(list(keys)), F.lit(max(salts, self.base))).otherwise(
                chosen
            )
        return chosen


NO_SALT = Salting()


@dataclass(frozen=True)
class Lateness:
    """A bound on the state of the streaming joins.

    ``column`` is an event time that all three inputs carry.  Rows that come
    more than ``delay`` behind the latest one are dropped, and a line matches a
    dimension row only if their times are at most ``within`` apart; matches
    beyond that are lost.  In return a row leaves the join state once no row
    within the bound can come any more.  Both are intervals such as ``1 hour``.
    """

    column: str
    delay: str
    within: str

    def mark(self, rows: DataFrame) -> DataFrame:
        return rows.withWatermark(self.column, self.delay)

    def join(self, lines: DataFrame, rows: DataFrame, keys: list[str], side: str) -> DataFrame:
        """``lines`` joined with a dimension within the bound; its time is dropped."""
        theirs, within = f"_{side}_time", F.expr(f"INTERVAL {self.within}")
        rows = rows.withColumnsRenamed({self.column: theirs, **{k: f"_{side}_{k}" for k in keys}})
        on = F.col(theirs).between(F.col(self.column) - within, F.col(self.column) + within)
        for key in keys:
            on = on & (F.col(key) == F.col(f"_{side}_{key}"))
        return lines.join(rows, on).drop(theirs, *(f"_{side}_{k}" for k in keys))


def hot_keys(rows: DataFrame, keys: Sequence[str], partitions: int) -> dict[str, list] | None:
    """For each of ``keys``, the values with the rows of two or more average partitions (batch only).

    Each comes with the number of partitions that it would fill, rounded up to a
    power of two.  There are at most ``partitions / 2`` such values of a key, and
    their numbers add up to at most twice ``partitions``.  All keys are counted
    in one pass.  Without any rows nothing is known, and the result is None.
    """
    tag = F.coalesce(*(F.when(F.col(k).isNotNull(), F.lit(k)) for k in keys))
    counts = (
        rows.groupingSets([[k] for k in keys], *keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(tag.isNotNull())
        .withColumn("tag", tag)
    )
    # Totals come from the same exchange of partial counts, one row per key.
    totals = counts.groupBy("tag").agg(F.sum("rows").alias("all_rows"))
    hot = counts.join(F.broadcast(totals), "tag")
    hot = hot.where(F.col("rows") * partitions >= 2 * F.col("all_rows"))
    found: dict[str, dict[int, list]] = {k: {} for k in keys}
    for row in hot.orderBy("tag", *keys).toLocalIterator():
        fills = math.ceil(math.log2(row["rows"] * partitions / row["all_rows"]))
        found[row["tag"]].setdefault(2**fills, []).append(row[row["tag"]])
    if not any(found.values()) and rows.isEmpty():
        return None
    return {k: sorted(v.items()) for k, v in found.items()}


def fact_sales_orders(
    lines: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    *,
    date_name: str = "order_datetime",
    product_salting: Salting = NO_SALT,
    customer_salting: Salting = NO_SALT,
    late: Lateness | None = None,
) -> DataFrame:
    """Order lines with the keys of their product and customer.

    Works on three batch or three streaming frames.  On streams both joins keep
    what they have seen, so a line that comes before its product is given out
    when the product arrives.

    A batch join leaves hot keys to AQE, which splits skewed partitions.  A
    streaming join hashes each key to one state partition for ever, so there
    salting spreads the lines of a key over several, and copies the dimension
    rows of that key to each of them.

    ``late`` bounds the join state of streams; see ``Lateness``.
    """
    if late is not None:
        lines, products, customers = map(late.mark, (lines, products, customers))
    salting = {"product_id": product_salting, "customer_id": customer_salting}
    product_keys = _keys("product_id", product_salting)
    customer_keys = _keys("customer_id", customer_salting)
    times = [] if late is None else [late.column]
    # Salts of a batch hash the row, so it has no more columns than the fact needs.
    wanted = ["order_number", "order_datetime", "unit_price", "quantity", *salting, *times]
    lines = lines.select(*dict.fromkeys(wanted))
    s = _join_input(lines, salting, spread=True)
    p = _join_input(products, {"product_id": product_salting}, spread=False)
    c = _join_input(customers, {"customer_id": customer_salting}, spread=False)
    s = s.select(
        "order_number",
        F.col("order_datetime").try_cast("date").alias(date_name),
        "unit_price",
        "quantity",
        *product_keys,
        *customer_keys,
        *times,
    )
    p = p.select("product_key", *product_keys, *times)
    c = c.select("customer_key", *customer_keys, *times)
    if late is None:
        joined = s.join(p, product_keys, "inner").join(c, customer_keys, "inner")
    else:
        joined = late.join(late.join(s, p, product_keys, "p"), c, customer_keys, "c")
    return joined.select(
        "order_number",
        "customer_key",
        "product_key",
        date_name,
        "unit_price",
        "quantity",
        (F.col("unit_price").cast("bigint") * F.col("quantity")).alias("total_price"),
    )


def fact_customer_sales(
    lines: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    *,
    product_salting: Salting = NO_SALT,
    customer_salting: Salting = NO_SALT,
) -> DataFrame:
    """Quantity and amount sold per product and customer (batch only).

    The sums over the three-way join equal the sums over the lines alone times
    the number of versions on either side.  So lines are summed first, partly
    before any shuffle, which leaves one row per pair however hot it is, and no
    line is multiplied by versions.

    The pairs then meet the numbers of versions.  AQE broadcasts a side that is
    measured to be small, so that the sums are the only shuffle; else it splits
    skewed partitions.  Salts, measured with ``hot_keys``, spread the pairs of a
    hot product over the customers' hashes, and the other way round, also where
    AQE is off; the price is as many copies of one row of the dimension.
    """
    amount = F.col("unit_price").cast("bigint") * F.col("quantity")
    pairs = lines.groupBy("product_id", "customer_id").agg(
        F.sum("quantity").alias("quantity"), F.sum(amount).alias("amount")
    )
    salts = {
        _salt(key): F.pmod(F.xxhash64(other), salting.count(key)).cast("int")
        for key, other, salting in (
            ("product_id", "customer_id", product_salting),
            ("customer_id", "product_id", customer_salting),
        )
        if salting.used
    }
    p = _versions(products, "product_id", "product_versions", product_salting)
    c = _versions(customers, "customer_id", "customer_versions", customer_salting)
    sold = pairs.withColumns(salts).join(p, _keys("product_id", product_salting))
    sold = sold.join(c, _keys("customer_id", customer_salting))
    times = F.col("product_versions") * F.col("customer_versions")
    return sold.select(
        "product_id",
        "customer_id",
        (F.col("quantity") * times).alias("total_quantity"),
        (F.col("amount") * times).alias("sale_amount"),
    )


def unmatched_lines(
    lines: DataFrame, products: DataFrame, *, at: str, delay: str, within: str, time: str = "timestamp"
) -> DataFrame:
    """Order lines that no version of their product came for (two streams, or two batch frames).

    A line (at its ``at``) and a version (at its ``time``) belong together if they
    are at most ``within`` apart.  On streams a line is given out once no version
    within the bound can come any more, that is when both watermarks, ``delay``
    behind the newest event of either, have passed it; then it leaves the state,
    as matched ones do.  Lines without a product are unmatched, those without a
    time are left out.

    On two streams each row goes through the state of Spark's join, one by one.  A
    lake's dataset of kind ``bounded`` keeps them as files and calls this with
    batch frames.
    """
    columns, theirs = lines.columns, "_product_time"
    s = lines.where(F.col(at).isNotNull())
    s = s.withColumn("_product", F.coalesce("product_id", F.lit("")))
    p = products.where(F.col("product_id").isNotNull() & F.col(time).isNotNull()).select(
        F.col(time).alias(theirs), F.coalesce("product_id", F.lit("")).alias("_sold")
    )
    if lines.isStreaming:
        s, p = s.withWatermark(at, delay), p.withWatermark(theirs, delay)
    else:
        p = p.distinct()
    near = F.expr(f"{theirs} >= {at} - INTERVAL {within} AND {theirs} <= {at} + INTERVAL {within}")
    on = (F.col("_product") == F.col("_sold")) & near
    if not lines.isStreaming:
        return s.join(p, on, "left_anti").select(columns)
    return s.join(p, on, "left_outer").where(F.col("_sold").isNull()).select(columns)


def _versions(rows: DataFrame, key: str, name: str, salting: Salting) -> DataFrame:
    """The number of rows of each key, once for each of its salts."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    if not salting.used:
        return counts
    salts = F.explode(F.sequence(F.lit(0), salting.count(key) - 1))
    return counts.select(key, name, salts.alias(_salt(key)))


def customer_sales(fact: DataFrame) -> DataFrame:
    """Quantity and amount sold per pair of surrogate keys (batch only)."""
    return fact.groupBy("customer_key", "product_key").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("total_price").alias("sale_amount")
    )


def _join_input(rows: DataFrame, salting: dict[str, Salting], *, spread: bool) -> DataFrame:
    """``rows`` ready to join on the keys of ``salting``.

    With ``spread`` each row gets one salt per key, otherwise it is copied to
    all salts of its key.  On a stream, which is read straight from a table or
    the bus, salts are drawn at random, so even identical rows part; a task that
    runs again reads the same rows in the same order and draws the same salts.
    A batch frame may come out of a shuffle, so there the row's content decides.
    """
    columns = rows.columns
    for seed, (key, salts) in enumerate(salting.items(), start=_SALT_SEED):
        if rows.isStreaming:
            rows = _without_nulls(rows, key)
        if not salts.used:
            continue
        count = salts.count(key)
        if not spread:
            salt = F.explode(F.sequence(F.lit(0), count - 1))
        elif rows.isStreaming:
            salt = F.floor(F.rand(seed) * count)
        else:
            salt = F.pmod(F.xxhash64(F.lit(seed), *columns), count)
        rows = rows.withColumn(_salt(key), salt)
        if spread:
            # Never NULL by its type either, see below.
            rows = rows.withColumn(_salt(key), F.coalesce(F.col(_salt(key)).cast("int"), F.lit(0)))
    return rows


def _without_nulls(rows: DataFrame, key: str) -> DataFrame:
    """Rows that have the key, in a column that is never NULL by its type.

    An inner join drops the others anyway.  Join state has a fixed schema, and
    without this the key would count as nullable in micro-batches that bring no
    rows on this side and as not nullable in the rest.
    """
    never = F.lit("" if isinstance(rows.schema[key].dataType, T.StringType) else 0)
    typed = never.cast(rows.schema[key].dataType)
    return rows.where(F.col(key).isNotNull()).withColumn(key, F.coalesce(F.col(key), typed))


def _salt(key: str) -> str:
    return f"_{key}_salt"


def _keys(key: str, salting: Salting) -> list[str]:
    return [key, _salt(key)] if salting.used else [key]
