"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint has a bit set where over half of its word shingles'
64-bit hashes have it.  Distinct fingerprints are laid into tiles by the
population counts of their four 16-bit parts.  A pair within the radius differs
by no more than the radius in the sum of these counts, so tile pairs beyond it
are skipped; all others are compared exactly, by exclusive-or and bit counts
over numpy arrays.  A tile of many fingerprints is split into blocks.  A task
holds one block and streams what is compared with it, so its memory is bounded
whatever the data; the work grows with the square of the number of distinct
fingerprints, over a constant of about one in seventy pairs.

A task links the fingerprints of its block among themselves before it gives out
links: at most one per fingerprint it has seen, never all pairs of a group.

Null and empty texts have the fingerprint zero and link like any other.
Repeated rows share a fingerprint.  A component without any doc_id has none.
A very long text is hashed whole, some thousand shingles at a time.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.components import connected_components
from tidemark.llm.rows import FILE, ROW, address, stored, with_numbers
from tidemark.llm.tables import column, map_arrow, map_texts, staged

SEED = 42
SHINGLE = 3
RADIUS = 2
BLOCK = 4096
_PARTS, _PART_BITS = 4, 16
_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        pieces = [b" ".join(words)]
    else:
        pieces = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in pieces), np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = hashes[i : i + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc`` (a struct of ``keep``, all columns by default) and ``fp``."""
    make = lambda: lambda texts: ([fingerprint(t) for t in texts],)
    return map_texts(docs, text, [StructField("fp", LongType())], make, keep)


def links(distinct: DataFrame, *, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (``a``, ``b``) that join all fingerprints ``fp`` within the radius.

    ``distinct`` holds each fingerprint once.  Not every pair is given, but the
    pairs given connect whatever all pairs would connect.
    """
    mask = (1 << _PART_BITS) - 1
    count = [
        F.bit_count(F.shiftrightunsigned("fp", i * _PART_BITS).bitwiseAND(F.lit(mask)))
        for i in range(_PARTS)
    ]
    placed = distinct.select("fp", *(c.alias(f"c{i}") for i, c in enumerate(count)))
    tile = lambda cs: sum(c * 17**i for i, c in enumerate(cs))
    placed = placed.select("fp", *(f"c{i}" for i in range(_PARTS)), tile([F.col(f"c{i}") for i in range(_PARTS)]).alias("tile"))

    # One row per tile, 17^4 at most however large the data.
    blocks = placed.groupBy("tile").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")
    )
    home = placed.join(F.broadcast(blocks), "tile").select(
        "tile",
        F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"),
        F.lit(0).alias("guest"),
        "fp",
        "blocks",
        *(f"c{i}" for i in range(_PARTS)),
    )
    # A tile pair is looked at from one side only: guests come from tiles with a
    # smaller offset, and from earlier blocks of the same tile.
    steps = [s for s in product(range(-radius, radius + 1), repeat=_PARTS) if 0 < sum(map(abs, s)) <= radius and s > (0,) * _PARTS]
    offsets = F.array(*(F.lit(tile(s)) for s in steps))
    guests = placed.select("fp", "tile", F.explode(offsets).alias("step"))
    guests = guests.select("fp", (F.col("tile") + F.col("step")).alias("tile"))
    guests = guests.join(F.broadcast(blocks), "tile").select(
        "tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("guest"), "fp"
    )
    earlier = home.where("block > 0 or blocks > 1").where("block < blocks - 1").select(
        "tile",
        F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("guest"),
        "fp",
    )
    dealt = home.select("tile", "block", "guest", "fp").union(guests).union(earlier)
    dealt = dealt.repartition("tile", "block").sortWithinPartitions("tile", "block", "guest")
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    return map_arrow(dealt, lambda batches: _compare(batches, radius), schema)


class _Block:
    """The fingerprints of one block, and which of them belong together."""

    def __init__(self, radius: int):
        self.radius, self.parts, self.ready = radius, [], None
        self.label = None

    def add_home(self, fps: np.ndarray) -> None:
        self.parts.append(fps)

    def _open(self) -> None:
        self.ready = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)
        self.label = np.arange(len(self.ready))
        for guest, home in self._pairs(self.ready):
            self._unite(guest, home)

    def _pairs(self, others: np.ndarray):
        step = max(1, (1 << 21) // max(1, len(self.ready)))
        for i in range(0, len(others), step):
            apart = np.bitwise_count(others[i : i + step, None] ^ self.ready[None, :])
            guest, home = np.nonzero(apart <= self.radius)
            yield guest + i, home

    def _unite(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label[:] = label[label]

    def meet(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One link for each guest that is near a fingerprint of the block."""
        if self.ready is None:
            self._open()
        out_a, out_b = [], []
        if len(self.ready):
            for guest, home in self._pairs(fps):
                if len(guest):
                    first = np.concatenate(([True], guest[1:] != guest[:-1]))
                    lead = home[first][np.cumsum(first) - 1]
                    self._unite(lead, home)
                    out_a.append(fps[guest[first]])
                    out_b.append(self.ready[home[first]])
        empty = np.zeros(0, np.int64)
        return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        if self.ready is None:
            self._open()
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return self.ready[moved], self.ready[self.label[moved]]


def _compare(batches, radius: int):
    def rows(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    key, open_block = None, None
    for batch in batches:
        tile, block, guest, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(fp):
            continue
        group = tile.astype(np.int64) << 32 | block
        cuts = np.flatnonzero((group[1:] != group[:-1]) | (guest[1:] != guest[:-1])) + 1
        for i, j in zip([0, *cuts], [*cuts, len(fp)], strict=True):
            if group[i] != key:
                if open_block is not None:
                    yield rows(*open_block.close())
                key, open_block = group[i], _Block(radius)
            if guest[i]:
                made = open_block.meet(fp[i:j])
                if len(made[0]):
                    yield rows(*made)
            else:
                open_block.add_home(fp[i:j])
    if open_block is not None:
        yield rows(*open_block.close())


def fingerprint_components(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``fp``, ``component`` (its least linked fingerprint) and ``component_id`` (its least doc_id)."""
    known = staged(prints.groupBy("fp").agg(F.min(doc_id).alias("first_id")), "simhash-distinct")
    found = staged(links(known.select("fp")), "simhash-links")
    roots = connected_components(found).select(F.col("node").alias("fp"), "root")
    tied = staged(
        known.join(roots, "fp", "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("component")
        ),
        "simhash-tied",
    )
    least = staged(
        tied.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-least"
    )
    return tied.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint and component."""
    prints = fingerprints(docs, text=text, keep=[doc_id])
    prints = staged(prints.select(F.col(f"doc.`{doc_id}`").alias("doc_id"), "fp"), "simhash")
    classes = staged(fingerprint_components(prints).select("fp", "component_id"), "simhash-classes")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id.

    Ids that are missing come last; of rows with the same id the one with the
    least fingerprint stays, and of those the first in the files.  Only ids,
    fingerprints and addresses are stored and shuffled: texts are read twice, to
    be fingerprinted and to be given out.
    """
    table = stored(docs, "simhash-input")
    slim = table.select(column(doc_id).alias("doc_id"), column(text).alias("text"), *address(table))
    slim = fingerprints(slim, keep=["doc_id", FILE, ROW])
    slim = staged(slim.select("doc.*", "fp"), "simhash")
    classes = staged(fingerprint_components(slim).select("fp", "component"), "simhash-classes")
    # One row per fingerprint before the join, so copies make no key hot.
    order = [F.col("doc_id").isNull().alias("none"), "doc_id"]
    firsts = slim.groupBy("fp").agg(F.min(F.struct(*order, FILE, ROW)).alias("first"))
    least = F.min(F.struct("first.none", "first.doc_id", "fp", f"first.{FILE}", f"first.{ROW}"))
    stays = firsts.join(classes, "fp").groupBy("component").agg(least.alias("first"))
    stays = stays.select(f"first.{FILE}", f"first.{ROW}", F.lit(1).alias("stays"))
    rows = with_numbers(table, staged(stays, "simhash-stays"), "stays", 1, "simhash")
    return rows.where("stays > 0").select(*(F.col("doc").getField(c).alias(c) for c in table.columns))
