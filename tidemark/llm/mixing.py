"""Mixing sources to target weights by weighted fair queueing.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and
share the total size; a target stops at ``repeat`` times its source's size, and
what is left over is shared again by weight.

Queue: each document's ``repeat`` possible copies stand in their source's
shuffled order, one pass after the other, and get as virtual finish time the
source's tokens up to and with them, over its target.  All copies are
range-sorted by finish time, and those within the total budget are taken.

Running sums go over range partitions: a task sums its own rows, and one row
per task and source carries the offsets, so a hot source spreads over as many
tasks as its size asks for.  Every shuffled table is written before its
partition numbers are used, so a lost executor cannot change them.

Decisions go back to the texts by file and place (``rows``), without a shuffle.

Null texts have size zero and are never taken, nor are other texts without a
word.  A very long text is a row like any other; only its words are counted.  Rows of the same document id, size and source are told apart by their
place only, so their results may swap; reruns give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.rows import address, stored, with_numbers
from tidemark.llm.tables import column, map_arrow, small, staged
from tidemark.operators.keys import assign_keys

WEIGHTS = (1, 2, 3)
REPEAT = 3
SEED = "mix"
# Sources are joined by a broadcast up to this many, some 100 MB, and by a shuffle
# of narrow rows beyond; texts take part in neither.
BROADCAST_SOURCES = 500_000
_WORD = r"[^\x20\x09-\x0D]+"


def _running(rows: DataFrame, order: list, value: str, group: str | None = None) -> DataFrame:
    """Range-sort; add ``part`` and ``run``, the sum of ``value`` in the task so far, per group."""
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType(
        [*rows.schema.fields, StructField("part", IntegerType()), StructField("run", LongType())]
    )
    at = rows.columns.index(value)
    by = rows.columns.index(group) if group else None

    def run(batches):
        part, carried, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            total = np.cumsum(batch.column(at).to_numpy(zero_copy_only=False)) + carried
            if by is not None:
                keys = batch.column(by).to_numpy(zero_copy_only=False)
                begins = np.concatenate(([last is None or keys[0] != last], keys[1:] != keys[:-1]))
                before = np.concatenate(([carried], total[:-1]))
                start = np.flatnonzero(begins)
                base = np.zeros(n, np.int64)
                base[start] = np.diff(np.concatenate(([0], before[start])))
                total = total - np.cumsum(base)
                last = keys[-1]
            carried = int(total[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(total, pa.int64())],
                schema.names,
            )

    return map_arrow(ordered, run, schema)


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """``source``, ``source_no``, ``source_size`` and ``target`` from ``source`` and ``size`` rows.

    Only sums reach the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = assign_keys(totals, "source_no", order_by=order)
    turns = F.array(*(F.lit(w) for w in weights))
    ranked = staged(
        ranked.select(
            "source",
            "source_no",
            "source_size",
            F.get(turns, ((F.col("source_no") - 1) % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * repeat).alias("most"),
        ),
        "mix-sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        before = level
        full = F.col("weight") * F.lit(level) > F.col("most")
        spent, left = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        # A level never falls, so sources that are full stay full.
        level = max(level, (total - spent) / left) if left else level
    target = F.least(F.col("weight") * F.lit(level), F.col("most").cast("double"))
    return ranked.select("source", "source_no", "source_size", target.alias("target"))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, seed: str, carried) -> DataFrame:
    """``doc`` (a struct of ``carried``), ``source``, ``size`` and ``shuffle``, without the text."""
    identity = F.coalesce(column(doc_id).cast("string"), F.lit(""))
    drawn = F.md5(F.concat(F.lit(f"{seed}|"), identity).cast("binary"))
    return docs.select(
        F.struct(*carried).alias("doc"),
        column(source).alias("source"),
        F.coalesce(F.regexp_count(column(text), F.lit(_WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.conv(F.substring(drawn, 1, 15), 16, 10).cast("bigint").alias("shuffle"),
    )


def _taken(sized: DataFrame, weights, repeat: int) -> DataFrame:
    """``doc``, ``size``, ``source_size``, ``target`` and ``copies`` of each row of ``_sized``.

    A source's copies finish in the order of pass, shuffle, size and place, so
    what the budget takes of it is all up to one cut point.  The last copy taken,
    one row per source, says for every document how many of its copies are.
    """
    rows = staged(sized.withColumn("place", F.monotonically_increasing_id()), "mix-rows")
    targets = staged(source_targets(rows, weights, repeat), "mix-targets")

    slim = rows.select("source", "size", "shuffle", "place")
    numbered = slim.join(
        small(targets.select("source", "source_no"), BROADCAST_SOURCES),
        slim.source.eqNullSafe(targets.source),
    ).select("source_no", "size", "shuffle", "place")
    lines = staged(
        _running(numbered, ["source_no", "shuffle", "size", "place"], "size", "source_no"), "mix-lines"
    )
    # One row for each source in each task.
    parts = lines.groupBy("part", "source_no").agg(F.sum("size").alias("in_part"))
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)))
    parts = staged(
        parts.join(targets.drop("source"), "source_no").drop("in_part"), "mix-offsets"
    )
    queued = lines.where("size > 0").join(parts, ["part", "source_no"])

    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    copies = queued.select(
        "place",
        "source_no",
        "size",
        "shuffle",
        F.explode(F.sequence(F.lit(1), F.lit(repeat))).alias("pass_no"),
        "source_size",
        "target",
        (F.col("before") + F.col("run")).alias("done"),
    )
    finish = ((F.col("pass_no") - 1) * F.col("source_size") + F.col("done")) / F.col("target")
    copies = copies.select(finish.alias("finish"), "source_no", "shuffle", "size", "place", "pass_no")
    sorted_copies = staged(
        _running(copies, ["finish", "source_no", "shuffle", "size", "place", "pass_no"], "size"),
        "mix-queue",
    )
    # One row for each task.
    sums = sorted_copies.groupBy("part").agg(F.sum("size").alias("in_part"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("in_part").over(ahead), F.lit(0)).alias("ahead"))
    last = F.max(F.struct("pass_no", "shuffle", "size", "place")).alias("last")
    cuts = (
        sorted_copies.join(F.broadcast(sums), "part")
        .where(F.col("ahead") + F.col("run") <= budget)
        .groupBy("source_no")
        .agg(last)
    )
    cuts = staged(
        targets.join(cuts, "source_no", "left").select(
            F.col("source").alias("cut_source"), "source_size", "target", "last"
        ),
        "mix-cuts",
    )
    here = F.struct("shuffle", "size", "place")
    there = F.struct(*(F.col("last")[c].alias(c) for c in ("shuffle", "size", "place")))
    whole = F.col("last.pass_no") - F.when(here <= there, 0).otherwise(1)
    taken = F.when((F.col("size") > 0) & F.col("last").isNotNull(), whole).otherwise(0)
    return rows.join(
        small(cuts, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("cut_source"))
    ).select("doc", "size", "source_size", "target", taken.cast("bigint").alias("copies"))


def mix_report(
    docs: DataFrame,
    doc_id: str = "doc_id",
    *,
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    repeat: int = REPEAT,
    seed: str = SEED,
) -> DataFrame:
    """How many words the mix takes of each document."""
    sized = _sized(docs, doc_id, text, source, seed, [column(doc_id).alias("doc_id")])
    return _taken(sized, weights, repeat).select(
        "doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    repeat: int = REPEAT,
    seed: str = SEED,
) -> DataFrame:
    """The documents that the mix takes, with ``copies``, how often each is to be read.

    An input column ``copies`` is replaced.  Texts are read twice, to be counted
    and to be given out, and not shuffled.
    """
    table = stored(docs, "mix-input")
    sized = _sized(table, doc_id, text, source, seed, address(table))
    decided = _taken(sized, weights, repeat).where("copies > 0").select("doc.*", "copies")
    # A power of two, so that no number lies across two words.
    bits = 1 << (max(1, repeat.bit_length()) - 1).bit_length()
    rows = with_numbers(table, staged(decided, "mix-decided"), "copies", bits, "mix")
    kept = [F.col("doc").getField(c).alias(c) for c in table.columns if c != "copies"]
    return rows.where("copies > 0").select(*kept, F.col("copies").cast("bigint").alias("copies"))
