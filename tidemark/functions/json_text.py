"""Column functions for change envelopes held as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import STRING, struct

# Where the changed row is, and the pattern replacements that take
# the quotes off its arrays, in order.
AFTER_PATH = "$.payload.after"
QUOTE_REPLACEMENTS = ((r'"\[', "["), (r'\]"', "]"), (r"\\", ""))


def after_image(value: Column) -> Column:
    """JSON text of the row after the change.

    NULL for a delete, a tombstone and text that is not JSON.  Numbers are
    written anew on the way (``1.50`` becomes ``1.5``).
    """
    return F.get_json_object(value, AFTER_PATH)


def parse_after(value: Column, schema: T.StructType) -> Column:
    """The row after the change, parsed from the whole envelope in one pass."""
    envelope = struct(payload=struct(after=schema))
    return F.from_json(value, envelope)["payload"]["after"]


def json_field(document: Column, name: str) -> Column:
    """One top-level field of a JSON document as text."""
    return F.get_json_object(document, f"$.{name}")


def strip_array_quotes(row: Column) -> Column:
    """Turn arrays held in JSON strings into arrays by text replacement.

    This edits the row as text, so a value that holds a quote, or that starts or
    ends with a square bracket, breaks the document.
    """
    for pattern, replacement in QUOTE_REPLACEMENTS:
        row = F.regexp_replace(row, pattern, replacement)
    return row


def epoch_to_text(seconds: Column) -> Column:
    """Epoch seconds held as text to ``yyyy-MM-dd HH:mm:ss`` in the session zone.

    Text that is not a whole number gives NULL, whatever the ANSI setting.
    """
    return F.from_unixtime(seconds.try_cast("bigint"))


def strings_for(schema: T.StructType, names) -> T.StructType:
    """``schema`` with the named fields as text."""
    return T.StructType(
        [T.StructField(f.name, STRING if f.name in names else f.dataType) for f in schema.fields]
    )
