"""Bucket-wise access to snapshot tables: which attempt holds each bucket of a version,
and the rows of chosen buckets, read from their folders alone.

A manifest is metadata (one row a bucket); the driver reads it whole, so versions
are compared, and files chosen, before any job touches data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .snapshots import ATTEMPT, BUCKET, MANIFEST_SCHEMA, META, SnapshotTable


@dataclass(frozen=True)
class Layout:
    """Where a version's buckets are."""

    table: SnapshotTable
    version: int
    schema: T.StructType
    attempts: dict[int, str]

    def moved(self, before: "Layout") -> set[int]:
        """Buckets that are not held by the same attempt in both versions."""
        return {b for b in {*self.attempts, *before.attempts} if self.attempts.get(b) != before.attempts.get(b)}

    def rows(self, buckets: Iterable[int]) -> DataFrame:
        """The rows of some buckets: only their folders are listed and scanned."""
        spark, data = self.table.spark, f"{self.table.root}/data"
        paths = [f"{data}/{ATTEMPT}={self.attempts[b]}/{BUCKET}={b}" for b in sorted(buckets) if b in self.attempts]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)


def layout(table: SnapshotTable, version: int) -> Layout:
    """One job over one version's manifest."""
    rows = table.spark.read.schema(MANIFEST_SCHEMA).json(f"{table.root}/_manifests/v={version}").collect()
    meta = next(json.loads(r["meta"]) for r in rows if r["bucket"] == META)
    return Layout(table, version, T.StructType.fromJson(meta["schema"]), {r["bucket"]: r["att"] for r in rows if r["bucket"] != META})
