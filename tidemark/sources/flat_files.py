"""Flat files of the source database as typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import STRING


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, *, on_error: str = "fail"
) -> DataFrame:
    """One JSON document per line, its fields cast from their text.

    Each field is read as text, so nested JSON stays as it was written, and then
    cast.  ``on_error="null"`` gives NULL for text that does not cast and for
    lines that are not JSON; ``"fail"`` stops.
    """
    texts = T.StructType([T.StructField(f.name, STRING) for f in schema.fields])
    mode = _choose(on_error, fail="FAILFAST", null="PERMISSIVE")
    rows = spark.read.schema(texts).option("mode", mode).json(path)
    return rows.select(
        *[
            (
                F.col(f.name).cast(f.dataType)
                if on_error == "fail"
                else F.col(f.name).try_cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


# Stands for a quoted empty field while a file is read.
_QUOTED_EMPTY = "\x01quoted empty\x01"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    delimiter: str = ",",
    on_error: str = "fail",
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header line and a doubled quote inside quotes.

    An empty field is NULL; ``""`` is the empty text, and an error in a column
    that is not text.  ``multi_line`` allows line breaks inside quotes; a file is
    then read by one task, however large it is.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", delimiter)
        .option("nullValue", "")
        .option("emptyValue", _QUOTED_EMPTY)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", _choose(on_error, fail="FAILFAST", null="PERMISSIVE"))
        .csv(path)
    )
    return rows.select(
        *[
            F.when(F.col(f.name) == _QUOTED_EMPTY, "").otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def _choose(on_error: str, **modes: str) -> str:
    if on_error not in modes:
        raise ValueError(f"on_error is one of {sorted(modes)}, not {on_error!r}")
    return modes[on_error]
