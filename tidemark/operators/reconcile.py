"""What a table has too many or too few of, compared with its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def _hashed(rows: DataFrame, columns: Sequence[str], key: Sequence[str], buckets: int) -> DataFrame:
    return rows.select(
        *columns,
        F.xxhash64(*columns).alias("_hash"),
        F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("_bucket"),
    )


def digests(rows: DataFrame, columns: Sequence[str], key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of the key its number of rows and two sums over their hashes, whatever their order."""
    hashed = _hashed(rows, columns, key, buckets)
    other = F.xxhash64(F.lit("again"), *columns)
    wide = lambda c: c.cast("decimal(20,0)")
    return hashed.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(wide(F.col("_hash"))).alias("_sum"),
        F.sum(wide(other)).alias("_other"),
    )


def differences(
    stored: DataFrame, source: DataFrame, columns: Sequence[str], key: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """The rows, by ``columns``, that the two hold a different number of times, and how many too many.

    ``surplus`` is what ``stored`` has more than ``source``, negative where it
    has less.  Both are first summed to a digest per bucket of ``key``; only the
    buckets whose digests differ - at most ``buckets`` numbers come to the driver
    - are counted row by row, without the rest being shuffled.  Counts are summed
    map-side, so a row that repeats often is no burden.
    """
    ours = digests(stored, columns, key, buckets)
    theirs = digests(source, columns, key, buckets).withColumnsRenamed(
        {c: f"{c}_there" for c in ("_bucket", "_rows", "_sum", "_other")}
    )
    joined = ours.join(theirs, F.col("_bucket") == F.col("_bucket_there"), "full_outer")
    same = F.lit(True)
    for c in ("_rows", "_sum", "_other"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_there"))
    differ = [r[0] for r in joined.where(~same).select(F.coalesce("_bucket", "_bucket_there")).collect()]
    sides = [
        _hashed(rows, columns, key, buckets).where(F.col("_bucket").isin(differ)).select(*columns, F.lit(n).alias("_n"))
        for rows, n in ((stored, 1), (source, -1))
    ]
    counted = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("_n").alias("surplus"))
    return counted.where("surplus <> 0")
