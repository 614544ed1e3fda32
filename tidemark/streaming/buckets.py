"""Tables that change in place, bucket by bucket.

Rows of a section lie in numbered buckets.  A batch writes the buckets that it
touches anew, in a folder of its own, and then one small listing that says which
folder holds each bucket.  A listing appears by one rename, so readers see all
of a batch or none of it, and a batch that runs again is recognised by it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming import files

BUCKET = "bucket"
# Copies in folder names, as the columns themselves stay in the files.
_FOLDER, _LIVE = "_bucket", "_live"


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """The bucket of a row by its key columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


class Buckets:
    """Sections of bucketed rows under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def listing(self) -> dict:
        """Per section its schema and, per bucket, its folder and what is in it; with the batch."""
        names = sorted(files.child_names(self.spark, f"{self.path}/listings"))
        if not names:
            return {"batch": -1, "sections": {}}
        return json.loads(files.read_text(self.spark, f"{self.path}/listings/{names[-1]}"))

    def rows(
        self, section: str, buckets: Sequence[int] | None = None, *, live_only: bool = False
    ) -> DataFrame | None:
        """The rows of some buckets (default: all); None before the section has any."""
        found = self.listing()["sections"].get(section)
        if found is None:
            return None
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [
            f"{self.path}/data/{at['folder']}/{_FOLDER}={bucket}/{_LIVE}={live}"
            for bucket, at in found["buckets"].items()
            if wanted is None or bucket in wanted
            for live in at["live"]
            if live == "true" or not live_only
        ]
        schema = T.StructType.fromJson(found["schema"])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def staged(self, rows: DataFrame) -> DataFrame:
        """``rows`` written until the batch is committed, and read from there."""
        path = f"{self.path}/staging/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, batch_id: int, sections: Mapping[str, DataFrame], live: Mapping[str, Column]) -> None:
        """Replace the buckets that the sections' rows are in; the rows have a column ``bucket``.

        ``live`` says, where a section has it, which rows readers want; the
        others, such as deleted keys, are kept apart.
        """
        last = self.listing()
        made = {"batch": batch_id, "sections": dict(last["sections"])}
        for section, rows in sections.items():
            # A run that failed may have left a folder of the same batch.
            folder = f"{section}-{batch_id:012d}-{uuid.uuid4().hex[:8]}"
            shown = live.get(section, F.lit(True))
            marked = rows.withColumns({_FOLDER: F.col(BUCKET), _LIVE: F.coalesce(shown, F.lit(False))})
            marked.write.partitionBy(_FOLDER, _LIVE).parquet(f"{self.path}/data/{folder}")
            buckets = dict(made["sections"].get(section, {}).get("buckets", {}))
            for child in files.child_names(self.spark, f"{self.path}/data/{folder}"):
                if child.startswith(f"{_FOLDER}="):
                    inside = files.child_names(self.spark, f"{self.path}/data/{folder}/{child}")
                    states = sorted(n.split("=")[1] for n in inside if n.startswith(f"{_LIVE}="))
                    buckets[child.split("=")[1]] = {"folder": folder, "live": states}
            made["sections"][section] = {"schema": rows.schema.jsonValue(), "buckets": buckets}
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}"
        files.write_text(self.spark, draft, json.dumps(made))
        files.publish(self.spark, draft, f"{self.path}/listings/{batch_id:012d}.json")
        self._tidy(last, made)

    def _tidy(self, last: dict, made: dict) -> None:
        """Keep what this listing and the one before name: readers may still be on that one."""
        used = {
            (at["folder"], bucket)
            for listing in (last, made)
            for section in listing["sections"].values()
            for bucket, at in section["buckets"].items()
        }
        folders = {folder for folder, _ in used}
        for folder in files.child_names(self.spark, f"{self.path}/data"):
            if folder not in folders:
                files.delete(self.spark, f"{self.path}/data/{folder}")
                continue
            for child in files.child_names(self.spark, f"{self.path}/data/{folder}"):
                if child.startswith(f"{_FOLDER}=") and (folder, child.split("=")[1]) not in used:
                    files.delete(self.spark, f"{self.path}/data/{folder}/{child}")
        for name in sorted(files.child_names(self.spark, f"{self.path}/listings"))[:-2]:
            files.delete(self.spark, f"{self.path}/listings/{name}")
        files.delete(self.spark, f"{self.path}/staging")
