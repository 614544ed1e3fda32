"""Benchmark decontamination by a broadcast set of normalised word windows.

Texts are lower-cased (A-Z only) and cut into words.  Each window of ``width``
consecutive words of a benchmark item goes into a set that is broadcast; an
item with fewer words, but not none, is one window.  Every window of a document
is looked up by a 64-bit hash, and a hit is then verified word by word.

The set's size is measured before it is broadcast.  A benchmark above
``block_bytes`` is cut into blocks; the documents then pass once per block,
staged in between, and carry their hits along, so the broadcast stays bounded
and nothing is lost.

Null and empty texts have no words and no hits.  An item without an id marks
words but is not counted.  Repeated items count once, repeated documents each.
An empty benchmark leaves every document clean.  A very long text is looked
through whole, by one task.  Columns of the input stay in ``doc``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.tables import column, map_arrow, map_texts, packed, slices, staged

WIDTH = 10
BLOCK_BYTES = 16 << 20

# A-Z to a-z; digits, letters and all bytes of non-ASCII characters stay; the
# rest parts words.  One byte each, so offsets hold.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_FIELDS = [
    StructField("n_words", LongType()),
    StructField("cuts", ArrayType(LongType())),
    StructField("items", ArrayType(StringType())),
    StructField("hits", ArrayType(LongType())),
]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class WindowSet:
    """The windows of some benchmark items, by length."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int):
        self.ids: dict[bytes, int] = {}
        self.owners: dict[int, dict[bytes, set]] = {}
        hashes: dict[int, set] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words], np.uint32)
            size = min(width, len(ids))
            at = np.arange(len(ids) - size + 1)
            hashes.setdefault(size, set()).update(_hashes(ids, at, size).tolist())
            owners = self.owners.setdefault(size, {})
            for i in at:
                owner = owners.setdefault(ids[i : i + size].tobytes(), set())
                if item is not None:
                    owner.add(item)
        self.hashes = {n: np.sort(np.fromiter(h, np.uint64)) for n, h in hashes.items()}

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Whether each word is hit, and the ids of the items with occurring windows."""
        hit, items = np.zeros(len(words), bool), set()
        get = self.ids.get
        ids = np.array([get(w, 0) for w in words], np.uint32)
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        for size, known in self.hashes.items():
            if len(ids) < size:
                continue
            at = np.nonzero(unknown[size:] == unknown[:-size])[0]
            if not len(at):
                continue
            found = _hashes(ids, at, size)
            place = np.minimum(np.searchsorted(known, found), len(known) - 1)
            for i in at[known[place] == found]:
                owner = self.owners[size].get(ids[i : i + size].tobytes())
                if owner is not None:
                    hit[i : i + size] = True
                    items |= owner
        return hit, items


def _hashes(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += ids[at + k].astype(np.uint64) * _FACTORS[k % len(_FACTORS)]
    return total


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[DataFrame]:
    items = benchmark.select(
        column(item_id).cast("string").alias("item"), column(text).alias("text")
    ).where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    # Half-full on average, so that a block seldom passes the bound by chance.
    n = 1 if size <= block_bytes else -(-2 * size // block_bytes)
    if n == 1:
        return [items]
    place = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(place == i) for i in range(n)]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``n_words``, ``items`` and ``hits``, ``cuts``.

    ``items`` holds the sorted ids of the items with occurring windows, ``hits``
    the runs of hit words as start and end in turn, and ``cuts`` the same runs
    as byte offsets of the text.
    """
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    names = list(docs.columns if keep is None else keep)
    if len(blocks) == 1:
        return _pass(docs, blocks[0], spark, text, names, width, False)
    frame = docs.select(F.struct(*map(column, names)).alias("doc"), column(text).alias("text"))
    for i, block in enumerate(blocks):
        frame = _pass(frame, block, spark, "text", ["doc", "text"], width, i > 0, earlier=frame)
        frame = staged(frame.select("doc.*", *(f.name for f in _FIELDS)), "decontamination")
    return frame.drop("text")


def _pass(docs, block, spark, text, keep, width, again, earlier=None) -> DataFrame:
    rows = [(r.item, r.text.encode()) for r in block.toLocalIterator()]
    windows = spark.sparkContext.broadcast(WindowSet(rows, width))

    def make():
        known = windows.value

        def work(texts, before=None):
            out = [[], [], [], []]
            for k, value in enumerate(texts):
                words = words_of(value)
                hit, items = known.scan(words)
                if before is not None:
                    for a, b in zip(before[k][0][::2], before[k][0][1::2], strict=True):
                        hit[a:b] = True
                    items |= set(before[k][1])
                runs = _runs(hit)
                cuts = []
                if runs:
                    spans = [m.span() for m in re.finditer(rb"[^ ]+", value.translate(_WORD_BYTES))]
                    cuts = [x for a, b in runs for x in (spans[a][0], spans[b - 1][1])]
                for column_, v in zip(
                    out, (len(words), cuts, sorted(items), [x for r in runs for x in r]), strict=True
                ):
                    column_.append(v)
            return out

        return work

    if not again:
        return map_texts(docs, text, _FIELDS, make, keep)
    return _map_again(earlier, make)


def _map_again(frame: DataFrame, make) -> DataFrame:
    """A further pass over rows that have their hits of earlier blocks beside them."""
    narrowed = frame.select(packed(frame, ["doc", "text"]), "text", "hits", "items")
    schema = StructType([narrowed.schema["doc"], *_FIELDS])
    types = [to_arrow_type(f.dataType) for f in _FIELDS]

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                before = list(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True))
                made = [pa.array(v, t) for v, t in zip(work(texts, before), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], schema.names)

    return map_arrow(narrowed, run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: how many words are hit, and by which items."""
    joined = F.array_join("items", ",")
    places = F.sequence(F.lit(0), F.greatest(F.size("hits") - 2, F.lit(0)), F.lit(2))
    hit = F.when(F.size("hits") == 0, F.lit(0).cast("bigint")).otherwise(
        F.aggregate(
            places, F.lit(0).cast("bigint"),
            lambda a, i: a + F.get("hits", i + 1) - F.get("hits", i),
        )
    )
    return scan(docs, benchmark, keep=[doc_id], **options).select(
        F.col(f"doc.`{doc_id}`").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", remove: str = "documents", **options
) -> DataFrame:
    """``docs`` without what the benchmark holds, columns as given.

    ``remove="documents"`` leaves out every document with a hit;
    ``remove="spans"`` cuts the runs of hit words out of the text instead.
    """
    scanned = scan(docs, benchmark, text=text, **options)
    if remove == "documents":
        return scanned.where(F.size("hits") == 0).select("doc.*")
    if remove != "spans":
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    # Bytes between the cuts, put together again; cuts never part a character.
    raw = F.col(f"doc.`{text}`").cast("binary")
    n = F.floor(F.size("cuts") / 2).cast("int")
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("cuts", 2 * i - 1)).cast("int")
    end = lambda i: F.when(i == n, F.octet_length(raw)).otherwise(F.get("cuts", 2 * i)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.substring(raw, start(i) + 1, end(i) - start(i)).cast("string"),
    )
    cleaned = F.when(F.size("cuts") == 0, F.col(f"doc.`{text}`")).otherwise(F.array_join(pieces, ""))
    return scanned.select(
        *(
            cleaned.alias(text) if name == text else F.col(f"doc.`{name}`").alias(name)
            for name in docs.columns
        )
    )
