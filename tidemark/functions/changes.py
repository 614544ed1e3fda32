"""Table rows as change events, in the form a capture connector puts on the bus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TEXT = {"ignoreNullFields": "false"}


def encode_changes(
    rows: DataFrame,
    key_columns,
    *,
    op: str | Column = "c",
    columns=None,
    json_columns=(),
    topic: str = "",
) -> DataFrame:
    """One bus message per row: ``key``, ``value`` (bytes) and ``topic``.

    ``op`` is c (create), u (update), r (snapshot) or d (delete), or a column
    holding one of them per row.  A delete carries the row as its before-image
    only.  ``columns`` (default: all) make up the image; ``json_columns`` are written as JSON text inside a JSON string.
    """
    op = F.lit(op) if isinstance(op, str) else op
    image = F.struct(
        *[
            F.to_json(F.col(c), _TEXT).alias(c) if c in json_columns else F.col(c)
            for c in (rows.columns if columns is None else columns)
        ]
    )
    payload = F.struct(
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
    )
    return rows.select(
        _message(F.struct(*key_columns), "Key", topic).alias("key"),
        _message(payload, "Envelope", topic).alias("value"),
        F.lit(topic).alias("topic"),
    )


def tombstones(rows: DataFrame, key_columns, *, topic: str = "") -> DataFrame:
    """The empty messages that follow deletes: a key and no value."""
    return rows.select(
        _message(F.struct(*key_columns), "Key", topic).alias("key"),
        F.lit(None).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def _message(payload: Column, kind: str, topic: str) -> Column:
    schema = F.struct(F.lit("struct").alias("type"), F.lit(f"{topic}.{kind}").alias("name"))
    text = F.to_json(F.struct(schema.alias("schema"), payload.alias("payload")), _TEXT)
    return F.encode(text, "UTF-8")
