"""Small whole numbers decided per row, brought back to rows of files without moving texts.

A row of a stored table is known by its file and its place in it.  What is
decided about rows - stay or go, how often to read - is worked out on narrow
frames with these two columns, packed into 64-bit words per file, and looked up
when the file is read once more.  Texts are not shuffled, whatever the size.

Words are broadcast in waves: a wave has the files of at most ``WAVE_ROWS``
rows (or one file), a few dozen megabytes, and reads those files alone.  With
several waves each is written before the next, so one wave at a time is held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import staged
from tidemark.session import scratch_dir

FILE, ROW = "_file", "_row"
WAVE_ROWS = 1 << 25
_WORD_BITS = 64


def stored(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` as a plain table of parquet files: itself if it is one, else written.

    Anything else between the files and the frame might give other rows, or the
    same in another place, when it is read again.
    """
    plan = docs._jdf.queryExecution().analyzed()
    # SubqueryAlias and the like only rename.
    while plan.getClass().getSimpleName() in ("SubqueryAlias", "View") and plan.children().size() == 1:
        plan = plan.children().head()
    is_scan = plan.getClass().getSimpleName() == "LogicalRelation" and "parquet" in plan.toString()
    return docs if is_scan else staged(docs, label)


def address(docs: DataFrame):
    """The address columns of a stored table; they cannot clash with any of its own."""
    meta = docs.metadataColumn("_metadata")
    return [meta.getField("file_path").alias(FILE), meta.getField("row_index").alias(ROW)]


def with_numbers(docs: DataFrame, decisions: DataFrame, name: str, bits: int, label: str) -> DataFrame:
    """The struct ``doc`` of all columns, and ``name``: the number decided for the row, or 0.

    ``docs`` is a ``stored`` table; ``decisions`` has the address and ``name`` of
    each row that has a number, written, and ``bits`` (a power of two) hold it.
    """
    per_word = _WORD_BITS // bits
    decided = decisions.where(F.col(name) > 0).select(
        F.col(FILE),
        F.floor(F.col(ROW) / per_word).cast("bigint").alias("_word"),
        F.expr(f"shiftleft(CAST({name} AS BIGINT), CAST({ROW} % {per_word} * {bits} AS INT))").alias("_bits"),
    )
    words = decided.groupBy(FILE, "_word").agg(F.bit_or("_bits").alias("_bits"))
    words = staged(words, f"{label}-words")
    # One row per file that has any.
    sizes = {r[0]: r[1] * per_word for r in words.groupBy(FILE).agg(F.count(F.lit(1))).collect()}
    waves = _waves(sizes)
    if len(waves) <= 1:
        return _looked_up(docs, words, name, bits)
    path = scratch_dir(docs.sparkSession, f"{label}-waves")
    for files in waves:
        meta = docs.metadataColumn("_metadata").getField("file_path")
        part = _looked_up(docs, words.where(F.col(FILE).isin(files)), name, bits, meta.isin(files))
        part.write.mode("append").option("compression", "zstd").parquet(path)
    rest = _looked_up(docs, words.limit(0), name, bits, ~docs.metadataColumn("_metadata").getField("file_path").isin(list(sizes)))
    rest.write.mode("append").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rest.schema).parquet(path)


def _waves(sizes: dict[str, int]) -> list[Sequence[str]]:
    waves, rows = [], 0
    for file, size in sorted(sizes.items()):
        if not waves or rows + size > WAVE_ROWS:
            waves.append([])
            rows = 0
        waves[-1].append(file)
        rows += size
    return waves


def _looked_up(docs: DataFrame, words: DataFrame, name: str, bits: int, where=None) -> DataFrame:
    per_word = _WORD_BITS // bits
    file, row = address(docs)
    read = docs if where is None else docs.where(where)
    rows = read.select(F.struct(*(docs[_quoted(c)] for c in docs.columns)).alias("doc"), file, row)
    rows = rows.withColumn("_word", F.floor(F.col(ROW) / per_word).cast("bigint"))
    found = rows.join(F.broadcast(words), [FILE, "_word"], "left")
    value = f"CAST(shiftrightunsigned(_bits, CAST({ROW} % {per_word} * {bits} AS INT)) & {(1 << bits) - 1} AS INT)"
    return found.select("doc", F.coalesce(F.expr(value), F.lit(0)).alias(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
