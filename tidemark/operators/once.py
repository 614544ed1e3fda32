"""Bus messages once each, however often the bus delivers them.

A message is known by its topic, partition and offset.  ``first_deliveries``
drops repeats on the stream as far as its watermark reaches back; ``repeats``
compares a batch with all that is stored, exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDENTITY = ("topic", "partition", "offset")

# Words of 64 positions that lie together in a row of ``dropped``.
_BLOCK = 64


def first_deliveries(
    messages: DataFrame, *, delay: str, time: str = "timestamp", identity: Sequence[str] = IDENTITY
) -> DataFrame:
    """A stream without the repeats that come within ``delay`` of event time.

    The state holds the identities since the watermark and forgets them behind
    it.  As Spark drops any row behind the watermark, repeated or not, this is
    for buses whose messages do not come later than that; ``missing`` finds what
    a late producer lost.
    """
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(identity))


def missing(source: DataFrame, stored: DataFrame, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """The messages of a complete source that are not stored (batch only), once each.

    Identities alone are compared; a value is read for the rows that are missing.
    """
    absent = (
        source.select(*identity).join(stored.select(*identity), list(identity), "left_anti").distinct()
    )
    kept = source.join(absent, list(identity), "left_semi")
    others = [c for c in source.columns if c not in identity]
    # Deliveries of a message are equal but for their time.
    first = F.min_by(F.struct(*others), F.xxhash64(*others)).alias("_first")
    return kept.groupBy(*identity).agg(first).select(*identity, "_first.*").select(*source.columns)


def repeats(arrived: DataFrame, stored: DataFrame, place: Sequence[str], identity: Sequence[str] = IDENTITY):
    """Identities of ``arrived`` that are stored, or that it holds several times.

    Gives ``identity``, ``_seen`` (stored already) and ``_first`` (the least
    ``place`` among the arrived).  Only identities are read; of the stored ones
    those between the least and greatest that arrived, which parquet's
    statistics prune, so a batch of new messages reads next to nothing.  Rows
    with a null in their identity are no repeats.
    """
    last = identity[-1]
    low, high = arrived.agg(F.min(last), F.max(last)).first()
    known = F.lit(True)
    for name in identity:
        known = known & F.col(name).isNotNull()
    here = arrived.where(known).select(*identity, F.struct(*place).alias("_place"))
    there = stored.where(known & F.col(last).between(F.lit(low), F.lit(high))).select(
        *identity, F.lit(None).cast(here.schema["_place"].dataType).alias("_place")
    )
    grouped = here.unionByName(there).groupBy(*identity)
    found = grouped.agg(
        F.min("_place").alias("_first"),
        F.count("_place").alias("_arrived"),
        (F.count(F.lit(1)) > F.count("_place")).alias("_seen"),
    )
    return found.where("_arrived > 1 OR (_seen AND _arrived = 1)").select(*identity, "_first", "_seen")


def dropped(arrived: DataFrame, found: DataFrame, place: Sequence[str], identity: Sequence[str] = IDENTITY):
    """Which rows of ``arrived`` go: all that ``repeats`` found, but first ones that are not stored.

    ``place`` is a part and a position in it.  A row tells of a block of positions of
    a part, in ``_words`` of 64 bits by their number.  Only identities and places are
    shuffled.
    """
    part, position = place
    joined = arrived.select(*identity, *place).join(found, list(identity))
    gone = joined.where(F.col("_seen") | (F.struct(*place) != F.col("_first")))
    one = F.expr(f"shiftleft(1L, CAST({position} % 64 AS INT))")
    words = gone.groupBy(part, F.floor(F.col(position) / 64).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    entry = F.struct((F.col("_word") % _BLOCK).alias("key"), F.col("_bits").alias("value"))
    return words.groupBy(part, F.floor(F.col("_word") / _BLOCK).alias("_block")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_words")
    )


def without(arrived: DataFrame, gone: DataFrame, place: Sequence[str]) -> DataFrame:
    """``arrived`` without the rows that ``dropped`` tells of.

    What it tells, some bytes for 64 rows at most, is broadcast, as a join on the
    identity would shuffle the values.
    """
    part, position = place
    word = F.floor(F.col(position) / 64)
    told = gone.withColumnsRenamed({part: "_of"})
    on = (F.col(part) == F.col("_of")) & (F.floor(word / _BLOCK) == F.col("_block"))
    bits = F.coalesce(F.element_at("_words", word % _BLOCK), F.lit(0).cast("bigint"))
    bit = F.expr(f"shiftright(_bits, CAST({position} % 64 AS INT))").bitwiseAND(F.lit(1).cast("bigint"))
    joined = arrived.join(F.broadcast(told), on, "left").withColumn("_bits", bits)
    return joined.where(bit == 0).select(*arrived.columns)


def waves(arrived: DataFrame, part: str, rows: int) -> list[tuple[int, int]]:
    """Ranges of parts of at most ``rows`` rows, or one part; a number for each part reaches the driver."""
    found: list[tuple[int, int]] = []
    held = 0
    for at, n in arrived.groupBy(part).count().orderBy(part).toLocalIterator():
        if found and held + n <= rows:
            found[-1], held = (found[-1][0], at), held + n
        else:
            found, held = [*found, (at, at)], n
    return found
