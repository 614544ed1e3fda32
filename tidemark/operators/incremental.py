"""Sales per product and customer, kept from changes instead of computed anew.

The total of a pair is S * P * C: the sum over its lines, times the versions of
its product, times those of its customer.  A batch brings dS, dP and dC, and

    (S+dS)(P+dP)(C+dC) - SPC = dS P C  +  (S+dS) dP C  +  (S+dS)(P+dP) dC

so only pairs with new lines, pairs of a product with new versions, and pairs of
such a customer change.  Each pair is stored with its three factors, in a grid
of buckets: one row of the grid per share of the products, one column per share
of the customers.  New lines touch their cells, a product's version one row of
cells, a customer's one column.  Versions are counted in buckets by key, where a
new pair looks its factors up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.buckets import BUCKET, Buckets, bucket_of

_SIDES = {"products": "product_id", "customers": "customer_id"}


def sales_changes(lines: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """New rows of all three inputs as one frame (batch or streaming); rows without a key give none."""
    none = lambda kind: F.lit(None).cast(kind)
    sold = lines.where("product_id IS NOT NULL AND customer_id IS NOT NULL").select(
        F.lit("lines").alias("kind"),
        "product_id",
        "customer_id",
        F.col("quantity").cast("bigint").alias("quantity"),
        (F.col("unit_price").cast("bigint") * F.col("quantity")).alias("amount"),
        none("bigint").alias("versions"),
    )
    sides = [
        rows.where(F.col(key).isNotNull()).select(
            F.lit(side).alias("kind"),
            (F.col(key) if key == "product_id" else none("string")).alias("product_id"),
            (F.col(key) if key == "customer_id" else none("bigint")).alias("customer_id"),
            none("bigint").alias("quantity"),
            none("bigint").alias("amount"),
            F.lit(1).cast("bigint").alias("versions"),
        )
        for (side, key), rows in zip(_SIDES.items(), (products, customers), strict=True)
    ]
    return sold.unionByName(sides[0]).unionByName(sides[1])


@dataclass(frozen=True)
class SalesTotals:
    """Merges ``sales_changes`` into stored totals, on ``grid`` x ``grid`` cells.

    A batch is summed per pair or key map-side first, so a hot pair sends one
    row per task.  Pairs are summed and joined by their keys and written by as many
    tasks as a cell's size asks for; the grid only says how much a batch rewrites.
    """

    grid: int = 16

    def merge(self, store: Buckets, batch: DataFrame) -> tuple[dict[str, DataFrame], dict[str, Column]]:
        sums = (F.sum(c).alias(c) for c in ("quantity", "amount", "versions"))
        changes = batch.groupBy("kind", "product_id", "customer_id").agg(*sums)
        row, column = (bucket_of([k], self.grid) for k in _SIDES.values())
        changes = store.staged(changes.withColumns({"at_products": row, "at_customers": column}))

        touched = self._cells(changes)
        if not touched:
            return {}, {}
        new, factors = {}, {}
        for side, key in _SIDES.items():
            factors[side], changed = self._versions(store, changes, side, key)
            if changed:
                new[side] = factors[side].where(F.col(BUCKET).isin(changed)).hint("rebalance", BUCKET)
        lines = changes.where("kind = 'lines'").select(
            (F.col("at_products") * self.grid + F.col("at_customers")).alias(BUCKET),
            "product_id",
            "customer_id",
            "quantity",
            "amount",
            *(F.lit(None).cast("bigint").alias(f"of_{side}") for side in _SIDES),
        )
        before = store.rows("pairs", touched)
        both = lines if before is None else lines.unionByName(before)
        pairs = both.groupBy(BUCKET, "product_id", "customer_id").agg(
            F.sum("quantity").alias("quantity"),
            F.sum("amount").alias("amount"),
            *(F.max(f"of_{side}").alias(f"of_{side}") for side in _SIDES),
        )
        for side, key in _SIDES.items():
            now = factors[side].select(key, F.col("versions").alias("_now"))
            found = F.coalesce("_now", f"of_{side}", F.lit(0).cast("bigint"))
            # Written after each join, so that no more than two shuffles of the pairs are kept.
            pairs = store.staged(pairs.join(now, key, "left").withColumn(f"of_{side}", found).drop("_now"))
        order = [BUCKET, "product_id", "customer_id", "quantity", "amount", *(f"of_{s}" for s in _SIDES)]
        new["pairs"] = pairs.select(*order).hint("rebalance", BUCKET)
        return new, {"pairs": (F.col("of_products") > 0) & (F.col("of_customers") > 0)}

    def view(self, store: Buckets) -> DataFrame | None:
        """Quantity and amount of each pair whose product and customer are there."""
        rows = store.rows("pairs", live_only=True)
        if rows is None:
            return None
        times = F.col("of_products") * F.col("of_customers")
        return rows.select(
            "product_id",
            "customer_id",
            (F.col("quantity") * times).alias("total_quantity"),
            (F.col("amount") * times).alias("sale_amount"),
        )

    def _cells(self, changes: DataFrame) -> list[int]:
        """The cells a batch touches; no more numbers than cells reach the driver."""
        places = changes.select("kind", "at_products", "at_customers")
        cells = set()
        for side in _SIDES:
            places = places.withColumn(
                f"at_{side}", F.when(F.col("kind").isin("lines", side), F.col(f"at_{side}"))
            )
        every = range(self.grid)
        for r in places.distinct().collect():
            rows = every if r.at_products is None else [r.at_products]
            columns = every if r.at_customers is None else [r.at_customers]
            cells.update(i * self.grid + j for i in rows for j in columns)
        return sorted(cells)

    def _versions(self, store: Buckets, changes: DataFrame, side: str, key: str):
        """Versions per key now, of all keys that the batch names, and the buckets that change."""
        named = changes.where(F.col("kind").isin("lines", side))
        places = named.groupBy(f"at_{side}").agg(F.max(F.col("kind") == side).alias("new")).collect()
        added = changes.where(F.col("kind") == side).select(
            F.col(f"at_{side}").alias(BUCKET), key, "versions"
        )
        before = store.rows(side, [r[0] for r in places])
        both = added if before is None else added.unionByName(before)
        counts = both.groupBy(BUCKET, key).agg(F.sum("versions").alias("versions"))
        return counts, [r[0] for r in places if r.new]
