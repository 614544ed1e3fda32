"""Shared pieces: reading, staging, and per-batch work on texts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from tidemark.session import scratch_dir

SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(name: str):
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(frame: DataFrame, names: Sequence[str] | None = None):
    """The named columns (all by default) as one struct ``doc``.

    Columns that an operator adds stand beside the struct, so they cannot clash
    with any column of the input.
    """
    return F.struct(*(column(n) for n in (frame.columns if names is None else names))).alias("doc")


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Write to a fresh folder of the shared scratch root and read it back.

    This cuts the lineage: a lost executor costs no more than a reread.  The
    folder belongs to whoever owns ``spark.checkpoint.dir``, as the returned
    frame reads from it.
    """
    path = scratch_dir(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small(frame: DataFrame, rows: int) -> DataFrame:
    """A stored table of a few numbers a row, marked to be broadcast if it has at most so many rows.

    Beyond that a join with it shuffles both sides, so the other one must hold no texts.
    """
    return F.broadcast(frame) if frame.count() <= rows else frame


def map_arrow(frame: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package sent to the executors first, once per context."""
    context = frame.sparkSession.sparkContext
    if not getattr(context, "_tidemark_sent", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        # The driver serves the archive to executors as they come, so it stays
        # until the driver ends.
        folder = os.path.realpath(tempfile.mkdtemp(prefix="tidemark-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, "tidemark")
        root, name = os.path.split(package)
        context.addPyFile(shutil.make_archive(archive, "zip", root, name))
        context._tidemark_sent = True
    return frame.mapInArrow(run, schema)


def map_texts(
    frame: DataFrame,
    text: str,
    fields: Sequence[StructField],
    make: Callable[[], Callable[[list], Sequence[list]]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns ``doc`` (a struct of ``keep``) and ``fields``, worked out from ``text``.

    ``make`` runs once in each task; what it returns gets some texts as UTF-8
    bytes (None for null) and gives a list of values per field.  Texts come in
    slices of about ``SLICE_BYTES``, which bounds what a worker holds.
    """
    narrowed = frame.select(packed(frame, keep), column(text).alias("text"))
    schema = StructType([narrowed.schema["doc"], *fields])
    types = [to_arrow_type(f.dataType) for f in fields]
    names = schema.names

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                made = [pa.array(v, t) for v, t in zip(work(texts), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names)

    return map_arrow(narrowed, run, schema)


def slices(batch: pa.RecordBatch, text: int):
    """A batch cut so that each part holds about ``SLICE_BYTES`` of its text column, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size + 64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(begin, end - begin)
