"""Sums and numbers of distinct values per level, from stored partial results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 2 ** 12 registers: the estimate's standard error is some 1.6 percent.
SKETCH_SIZE = 12


def base_cells(
    rows: DataFrame, dimensions: Sequence[str], sums: Mapping[str, str], distinct: str, size: int = SKETCH_SIZE
) -> DataFrame:
    """One row per cell of all dimensions: ``row_count``, ``sums``, and a ``sketch`` of ``distinct``.

    This is what a table stores; the cells of several days or lakes can be put
    together and rolled up without the rows they came from.
    """
    return rows.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.sum(c).alias(name) for name, c in sums.items()),
        F.hll_sketch_agg(distinct, F.lit(size)).alias("sketch"),
    )


def rolled_up(cells: DataFrame, dimensions: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Cells added up from the last dimension to the first; ``level`` counts the dimensions in use.

    Sketches are merged, so the ``estimate`` of distinct values needs no rows; the
    dimensions that are not in use are null.
    """
    used = F.lit(len(dimensions)) - F.bit_count(F.grouping_id())
    return cells.rollup(*dimensions).agg(
        used.cast("int").alias("level"),
        F.sum("row_count").alias("row_count"),
        *(F.sum(c).alias(c) for c in sums),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"),
    )


def exact_distinct(rows: DataFrame, dimensions: Sequence[str], distinct: str, name: str) -> DataFrame:
    """The exact number of distinct values at each level, next to the estimates.

    Each value counts once per cell before the levels are made, and nulls do not count.
    """
    pairs = rows.select(*dimensions, distinct).distinct()
    used = F.lit(len(dimensions)) - F.bit_count(F.grouping_id())
    return pairs.rollup(*dimensions).agg(
        used.cast("int").alias("level"), F.count_distinct(distinct).alias(name)
    )


def with_exact(estimates: DataFrame, exact: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Both side by side."""
    renamed = exact.withColumnsRenamed({c: f"_{c}" for c in [*dimensions, "level"]})
    same = F.col("level") == F.col("_level")
    for c in dimensions:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return estimates.join(renamed, same).drop("_level", *(f"_{c}" for c in dimensions))
