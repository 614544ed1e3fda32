"""Tables that other pipelines keep, as sources of a lake."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


def table_stream(
    name: str, options: Mapping[str, str] | None = None
) -> Callable[[SparkSession], DataFrame]:
    """The rows of a catalog table as another pipeline adds them.

    Use it as ``build`` of a temporary dataset, which other datasets then name as
    their input.  The table must be one that only grows.
    """
    return lambda spark: spark.readStream.options(**(options or {})).table(name)
