"""The raw layer: bus messages as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_text(messages: DataFrame) -> DataFrame:
    """Key and value bytes as UTF-8 text; the connector's other columns stay."""
    return messages.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


def only_topic(messages: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic of a source that subscribes to several."""
    return messages.where(F.col("topic") == topic)
