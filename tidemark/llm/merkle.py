"""A Merkle manifest of a dataset, with a proof for every row.

Rows are leaves, hashed by content.  Within a group (a source) they are ranked
by id; every 16 consecutive nodes become one until one is left, the group's
subroot.  Subroots, in the order of their groups, become the root likewise.

1. ``leaves`` hashes each row; ``ranked`` range-sorts the hashes and numbers
   them within their group.  A task numbers its own rows; what rows of a group
   lie in earlier tasks is one number per task, the only thing broadcast.
2. ``rolled_up`` nests nodes by the digits of their rank.  The lowest digit is
   grouped away first, then the next, until a block of 16 ** ``DIGITS`` nodes is
   one row; blocks are ranked already, so the same goes on with one node per
   block until every group has a single one.  No row holds more than a block.
3. ``proofs`` goes the other way: a transform over a block's nested structs gives
   each node its siblings, level by level, and an explode gives one row each.
   Leaves are not joined with anything: only blocks, one row for up to 256 nodes
   below, are joined with the path above them.

Ranks are dense, so a block 0 that is not full is its group's only one, and a
full one is hashed the same whether others follow or not: no counts are needed.

Null values are hashed as ``-``.  Null ids come first in their group, the null
group first of all.  Rows of the same id are ordered by hash; equal rows are
leaves each.  An empty table has no leaves and no root.  Texts are hashed where
they are read and not shuffled, however long; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.tables import column, map_arrow, staged

FAN_OUT = 16
DIGITS = 2
BLOCK = FAN_OUT**DIGITS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The one group that subroots are in.
_ALL = "all"


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def _hash_of(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """Each value as its UTF-8 byte count, a colon and the value; nulls as a dash."""
    texts = [v.cast("string") for v in values]
    return digest(
        *(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)
    )


def leaves(
    rows: DataFrame,
    *,
    columns: Sequence[str] = COLUMNS,
    key: str = "doc_id",
    group: str = "source",
    other: dict[str, Column] | None = None,
) -> DataFrame:
    """``group``, ``key``, ``leaf`` and ``seen`` of each row.

    ``seen`` is the hash of the row as found later, with the values of ``other``
    in place of its own; null where all are null, that is where nothing differs.
    """
    own = {c: column(c) for c in columns}
    seen = F.lit(None).cast("string")
    if other:
        changed = reduce(or_, (v.isNotNull() for v in other.values()))
        now = {c: F.coalesce(other[c], own[c]) if c in other else own[c] for c in columns}
        seen = F.when(changed, leaf_hash(list(now.values())))
    return rows.select(
        column(group).alias("group"),
        column(key).alias("key"),
        leaf_hash(list(own.values())).alias("leaf"),
        seen.alias("seen"),
    )


def _numbered(rows: DataFrame, group: str) -> DataFrame:
    """``part`` and ``at``: the task of sorted rows, and their place among those of their group in it."""
    schema = StructType([*rows.schema.fields, StructField("part", IntegerType()), StructField("at", LongType())])
    by = rows.columns.index(group)

    def run(batches):
        part, open_at, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            # Null groups compare as equal here, and as other than any value.
            keys = batch.column(by).dictionary_encode(null_encoding="encode")
            codes = keys.indices.to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            counts = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
            first, final = batch.column(by)[0].as_py(), batch.column(by)[n - 1].as_py()
            if last == (first,):
                counts[: begins[1] if len(begins) > 1 else n] += open_at
            open_at, last = int(counts[-1]) + 1, (final,)
            made = [pa.array(np.full(n, part, np.int32)), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    return map_arrow(rows, run, schema)


def ranked(rows: DataFrame, order: Sequence[Column | str], label: str) -> DataFrame:
    """Rows with ``rank``, counted from 0 within their ``group`` (null is one) in the given order.

    The sorted rows are written before any number is used, so a lost executor
    cannot lead to other ranks.
    """
    by = [F.col("group").asc_nulls_first(), *order]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = staged(_numbered(ordered, "group"), label)
    # One row for each task and group in it, and after the filter one per task at
    # most: only the first group of a task can have begun in an earlier one.
    counts = placed.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select(
        F.col("group").alias("g"), F.col("part").alias("p"), F.sum("n").over(before).alias("carried")
    ).where("carried > 0")
    joined = placed.join(
        F.broadcast(carried), (F.col("part") == F.col("p")) & F.col("group").eqNullSafe(F.col("g")), "left"
    )
    rank = F.col("at") + F.coalesce("carried", F.lit(0))
    return joined.select(*rows.columns, rank.alias("rank"))


def rolled_up(nodes: DataFrame, label: str) -> DataFrame:
    """Blocks of ``group``, ``rank``, ``node`` and ``item``: ``group``, ``block``, ``tree`` and ``top``.

    ``tree`` has the runs of a block, each with its own node and its children
    (``node`` and ``item``), in order.  ``top`` is the block's node: levels go on
    while the group has several nodes.
    """
    digits = nodes.select(
        "group",
        F.floor(F.col("rank") / BLOCK).cast("bigint").alias("block"),
        (F.floor(F.col("rank") / FAN_OUT) % FAN_OUT).cast("int").alias("run"),
        (F.col("rank") % FAN_OUT).cast("int").alias("digit"),
        "node",
        "item",
    )
    # Both groupings use this one shuffle.
    dealt = digits.repartition("group", "block")
    runs = dealt.groupBy("group", "block", "run").agg(
        F.sort_array(F.collect_list(F.struct("digit", "node", "item"))).alias("children")
    )
    runs = runs.withColumn("node", _hash_of(F.col("children.node")))
    blocks = runs.groupBy("group", "block").agg(
        F.sort_array(F.collect_list(F.struct("run", "node", "children"))).alias("tree")
    )
    first = F.element_at("tree", 1)
    top = (
        F.when(_single(F.col("tree")) & (F.col("block") == 0), first["children"][0]["node"])
        .when((F.size("tree") == 1) & (F.col("block") == 0), first["node"])
        .otherwise(_hash_of(F.col("tree.node")))
    )
    return staged(blocks.select("group", "block", "tree", top.alias("top")), label)


def _single(tree: Column) -> Column:
    return (F.size(tree) == 1) & (F.size(F.element_at(tree, 1)["children"]) == 1)


def _rounds(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Blocks of nodes, blocks of their tops and so on, until every group has one."""
    rounds = [rolled_up(nodes, f"{label}-0")]
    # One number comes to the driver per round, and a round has a 256th of the rows.
    while (rounds[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = rounds[-1].select(
            "group", F.col("block").alias("rank"), F.col("top").alias("node"), F.struct("block").alias("item")
        )
        rounds.append(rolled_up(above, f"{label}-{len(rounds)}"))
    return rounds


@dataclass
class Manifest:
    """The stored blocks, lowest first, of rows and of subroots; ``root`` is None without rows."""

    rows: list[DataFrame]
    subroots: list[DataFrame]
    root: str | None


def manifest(hashed: DataFrame) -> Manifest:
    """The tree over the ``leaves`` of a table."""
    order = [F.col("key").asc_nulls_first(), "leaf", F.col("seen").asc_nulls_first()]
    low = ranked(hashed, order, "merkle-leaves")
    rows = _rounds(
        low.select("group", "rank", F.col("leaf").alias("node"), F.struct("key", "seen").alias("item")),
        "merkle-rows",
    )
    # One subroot per group.  They form a group themselves, ranked by their group.
    named = rows[-1].select(
        F.lit(_ALL).alias("group"), F.col("group").alias("name"), F.col("top").alias("node")
    )
    order = [F.col("name").asc_nulls_first()]
    high = ranked(named, order, "merkle-groups")
    subroots = _rounds(high.select("group", "rank", "node", F.struct("name").alias("item")), "merkle-roots")
    top = subroots[-1].select("top").first()
    return Manifest(rows, subroots, None if top is None else top[0])


def _entry(nodes: Column, at: Column) -> Column:
    """The siblings of one node of a run, those before it and those after it."""
    return F.struct(
        F.array_join(F.slice(nodes, 1, at), "").alias("before"),
        F.array_join(F.slice(nodes, at + 2, F.lit(FAN_OUT)), "").alias("after"),
    )


def _expanded(blocks: DataFrame, carried: Sequence[str]) -> DataFrame:
    """One row per node below: ``group``, ``node``, ``item``, ``path`` and ``carried`` columns.

    ``blocks`` has their path; a node's own starts at its level and ends at the root.
    """
    only = F.col("block") == 0
    none = F.slice(F.col("path"), 1, 0)
    tree, whole = F.col("tree"), _single(F.col("tree")) & only
    short = (F.size("tree") == 1) & only

    def of_run(run: Column, j: Column) -> Column:
        nodes = run["children"]["node"]
        above = F.concat(F.when(short, none).otherwise(F.array(_entry(F.col("tree.node"), j))), F.col("path"))
        return F.transform(
            run["children"],
            lambda child, i: F.struct(
                child["node"].alias("node"),
                child["item"].alias("item"),
                F.concat(F.when(whole, none).otherwise(F.array(_entry(nodes, i))), above).alias("path"),
            ),
        )

    each = F.explode_outer(F.flatten(F.transform(tree, of_run))).alias("one")
    return blocks.select("group", *carried, each).select(
        "group", *carried, "one.node", "one.item", "one.path"
    )


def _down(top: DataFrame, lower: list[DataFrame], carried: Sequence[str]) -> DataFrame:
    """Paths of the lowest nodes: ``top`` is the last round with its ``path``, ``lower`` those before."""
    made = _expanded(top, carried)
    for below in reversed(lower):
        above = made.select(
            F.col("group").alias("g"), F.col("item.block").alias("b"), "path", *carried
        )
        blocks = below.join(above, (F.col("block") == F.col("b")) & F.col("group").eqNullSafe(F.col("g")))
        made = _expanded(blocks.drop("g", "b"), carried)
    return made


def proofs(tree: Manifest) -> DataFrame:
    """``group``, ``key``, ``leaf``, ``seen``, ``path``, ``subroot`` and ``root`` of every row.

    ``path`` holds, level by level up to the root, the siblings before and after
    the node, as hex digests side by side.
    """
    empty = F.array().cast("array<struct<before:string,after:string>>")
    groups = _down(tree.subroots[-1].withColumn("path", empty), tree.subroots[:-1], [])
    named = groups.select(F.col("item.name").alias("g"), "path", F.col("node").alias("subroot"))
    tops = tree.rows[-1].join(named, F.col("group").eqNullSafe(F.col("g"))).drop("g")
    each = _down(tops, tree.rows[:-1], ["subroot"])
    return each.select(
        "group",
        "item.key",
        F.col("node").alias("leaf"),
        "item.seen",
        "path",
        "subroot",
        F.lit(tree.root).cast("string").alias("root"),
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        path, leaf, lambda node, level: digest(level["before"], node, level["after"])
    )


def proof_hash(path: Column) -> Column:
    """The digest of a proof's siblings, level by level, left to right."""
    sides = F.transform(path, lambda level: F.concat(level["before"], level["after"]))
    return _hash_of(sides)


def lower_cased(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def merkle_report(docs: DataFrame, *, tamper_every: int = 5) -> DataFrame:
    """Proofs of all documents, and whether they hold after some texts were lower-cased.

    Those whose crc32 of the id is divisible by ``tamper_every`` are; the rest is as it was.
    """
    hit = F.crc32(column("doc_id").cast("string").cast("binary")) % tamper_every == 0
    hashed = leaves(docs, other={"text": F.when(hit, lower_cased(column("text")))})
    rows = proofs(manifest(hashed))
    rows = rows.withColumn("folded_root", folded(F.coalesce("seen", "leaf"), F.col("path")))
    return rows.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
