"""Versioned Parquet tables with all-or-nothing publish.

A table is hash-bucketed by its key.  Each version rewrites only the buckets
its batch touches; a manifest says which attempt's folder holds each bucket::

    <root>/data/att=<version>-<id>/__b=<bucket>/part-*.parquet
    <root>/_manifests/v=<n>/part-*.json   (mv, bucket, att) per bucket, and one row of metadata

* The metadata row holds the table's schema, key columns, bucket count and the
  last batch of every stream.  They are fixed by the first version: a batch is
  cast to the stored types before its keys are hashed, a lossy cast or another
  bucket count or key is refused, and reads use the stored schema.
* Readers take the highest committed manifest: a version is visible only once
  its manifest exists.  Every attempt writes into a folder of its own that
  only its own manifest names, so a writer that fails, or loses a race for a
  version, leaves the committed one as it is.
* Two writers racing for one version cannot both commit: the manifest is
  written with ``errorifexists``.
* A small batch against a huge table reads and rewrites only the buckets of
  its keys.  Manifests are read and written as DataFrames; the driver holds
  one metadata row and, of a version that is read, its buckets and their attempts.

Everything goes through the DataFrame reader and writer, so the same code runs
on any Hadoop-compatible store.
"""

from __future__ import annotations

import functools
import json
import operator
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as M
from ..session import scratch_path, staged

BUCKET, ATTEMPT = "__b", "att"
META = -1  # bucket number of the metadata row
DEFAULT_BUCKETS = 16
_MANIFEST_FILE = re.compile(r"/_manifests/v=(\d+)/part-[^/]*$")
MANIFEST_SCHEMA = "mv bigint, bucket int, att string, meta string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    if buckets <= 1 or not keys:
        return F.lit(0)
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class SnapshotTable:
    """``keys`` and ``buckets`` are needed for a new table; an existing one knows them
    (``keys=()`` and ``buckets=None`` take what is stored, anything else must equal it)."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (), buckets: int | None = None,
                 sort_by: Sequence[str | Column] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.asked = buckets
        self.buckets = (buckets or DEFAULT_BUCKETS) if self.keys else 1
        # Order of rows inside each written file: row-group min/max statistics
        # then let range filters (change windows) skip most of a bucket.
        self.sort_by = list(sort_by)
        version = self.current_version()
        if version is not None:
            self._adopt(self.metadata(version))

    def _adopt(self, meta: Mapping) -> None:
        if self.keys and self.keys != meta["keys"]:
            raise ValueError(f"{self.root}: the table's key is {meta['keys']}, not {self.keys}")
        if self.asked is not None and meta["keys"] and self.asked != meta["buckets"]:
            raise ValueError(f"{self.root}: the table has {meta['buckets']} buckets, not {self.asked}")
        self.keys, self.buckets = meta["keys"], meta["buckets"]

    # -- layout ---------------------------------------------------------------
    def _manifest(self, version: int) -> str:
        return f"{self.root}/_manifests/v={version}"

    def versions(self) -> list[int]:
        """Committed versions, oldest first, from the listing of manifest files
        (no job).  Any of them can be read back."""
        try:
            files = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.root}/_manifests").inputFiles()
        except AnalysisException:
            return []
        return sorted({int(m.group(1)) for f in files if (m := _MANIFEST_FILE.search(f))})

    def current_version(self) -> int | None:
        """Highest committed version."""
        versions = self.versions()
        return versions[-1] if versions else None

    def exists(self) -> bool:
        return self.current_version() is not None

    def entries(self, version: int) -> DataFrame:
        """(bucket, att): which attempt holds each bucket of a version."""
        return (self.spark.read.schema(MANIFEST_SCHEMA).json(self._manifest(version))
                .filter(F.col("bucket") >= 0).select("bucket", "att"))

    def metadata(self, version: int) -> dict:
        """The version's schema, keys, bucket count and stream positions: one row."""
        row = (self.spark.read.schema(MANIFEST_SCHEMA).json(self._manifest(version))
               .filter(F.col("bucket") == META).select("meta").first())
        return json.loads(row["meta"])

    def manifest(self, version: int) -> dict[int, int]:
        """bucket -> version that wrote it, for inspection (one row per bucket)."""
        return {r["bucket"]: int(r["att"].split("-")[0]) for r in self.entries(version).collect()}

    def stream_position(self, stream: str) -> int | None:
        """The last batch of a stream that the table holds."""
        version = self.current_version()
        return None if version is None else self.metadata(version)["streams"].get(stream)

    # -- reading --------------------------------------------------------------
    def read(self, version: int | None = None, buckets: DataFrame | None = None) -> DataFrame | None:
        """A version (default the current one); ``buckets`` (a column ``bucket``) restricts it."""
        v = self.current_version() if version is None else version
        if v is None:
            return None
        schema = T.StructType.fromJson(self.metadata(v)["schema"])
        held = self.entries(v)
        if buckets is not None:
            held = held.join(buckets, "bucket", "left_semi")
        attempts: dict[str, list[int]] = {}                 # the buckets of each attempt still in use
        for r in held.collect():
            attempts.setdefault(r["att"], []).append(r["bucket"])
        if not attempts:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType()),
                               T.StructField(BUCKET, T.IntegerType())])
        files = (self.spark.read.schema(stored).option("basePath", f"{self.root}/data")
                 .parquet(*[f"{self.root}/data/{ATTEMPT}={a}" for a in sorted(attempts)]))
        # The manifest as a filter on the folder columns (one number per bucket): Spark
        # prunes the folders of buckets that a later attempt replaced, and no plan that
        # reads the table broadcasts its manifest again.
        stands = functools.reduce(operator.or_, [(F.col(ATTEMPT) == a) & F.col(BUCKET).isin(b) for a, b in sorted(attempts.items())])
        return files.filter(stands).select(*schema.names)

    # -- writing --------------------------------------------------------------
    def _publish(self, df: DataFrame, version: int, base: int | None, touched: DataFrame | None,
                 streams: Mapping[str, int]) -> int:
        """Write ``df`` as the touched buckets of ``version`` (all, when ``touched`` is None),
        keep the others of ``base``, then commit the manifest."""
        attempt = f"{version}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/data/{ATTEMPT}={attempt}"
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        out = df.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        # Rebalance by bucket: AQE splits a hot bucket over several tasks and
        # packs small buckets, so the write neither skews nor sprays files.
        out = out.hint("rebalance", BUCKET)
        if self.sort_by:
            out = out.sortWithinPartitions(BUCKET, *self.sort_by)
        out.write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
        stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        written = self.spark.read.schema(stored).parquet(path).select(F.col(BUCKET).alias("bucket")).distinct()
        rows = written.withColumn("att", F.lit(attempt))
        if touched is not None:
            if not written.join(touched, "bucket", "left_anti").isEmpty():
                raise RuntimeError(f"{self.root}: rows left the buckets their batch touched; nothing is published")
            if base is not None:
                rows = rows.unionByName(self.entries(base).join(touched, "bucket", "left_anti"))
        meta = {"schema": json.loads(schema.json()), "keys": self.keys, "buckets": self.buckets, "streams": dict(streams)}
        head = self.spark.range(1).select(F.lit(META).alias("bucket"), F.lit(None).cast("string").alias("att"),
                                          F.lit(json.dumps(meta)).alias("meta"))
        (rows.withColumn("meta", F.lit(None).cast("string")).unionByName(head)
         .select(F.lit(version).cast("bigint").alias("mv"), "bucket", "att", "meta")
         .coalesce(1).write.mode("errorifexists").json(self._manifest(version)))
        return version

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Replace the table's contents with ``df`` as a new version."""
        cur = self.current_version()
        if version is None:
            version = 0 if cur is None else cur + 1
        streams = {} if cur is None else self.metadata(cur)["streams"]
        return self._publish(df, version, None, None, streams)

    def apply(self, incoming: DataFrame, fn: Callable[[DataFrame | None, DataFrame], DataFrame],
              stream: tuple[str, int] | None = None) -> int | None:
        """Combine ``incoming`` with the rows of the buckets it touches using
        ``fn(base, incoming)`` and publish the result as a new version.  An
        empty batch publishes nothing.

        The batch is cast to the table's types, written once to the work folder
        and read from there (touched buckets, key joins, counts, rows): its plan
        runs once, and a lost executor does not recompute it.  ``stream`` names
        the stream and batch that the version holds then."""
        cur = self.current_version()
        meta = None if cur is None else self.metadata(cur)
        if meta is not None:
            self._adopt(meta)
            known = {f.name: f.dataType for f in T.StructType.fromJson(meta["schema"]).fields}
            incoming = M.conform(incoming, known)
        batch = staged(incoming, "batch")
        if batch.isEmpty():
            return cur
        touched_path = scratch_path(self.spark, "buckets")
        (batch.select(bucket_of(self.keys, self.buckets).alias("bucket")).distinct()
         .coalesce(1).write.parquet(touched_path))       # a row per bucket at most
        touched = self.spark.read.schema("bucket int").parquet(touched_path)
        base = None if cur is None else self.read(cur, touched)
        out = fn(base, batch)
        streams = dict(meta["streams"]) if meta else {}
        if stream is not None:
            streams[stream[0]] = stream[1]
        return self._publish(out, 0 if cur is None else cur + 1, cur, touched, streams)

    def merge(self, incoming: DataFrame, keys: Sequence[str] | None = None, **merge_kw) -> int | None:
        """Upsert a batch (S9/M2); a missing table is created by the first load
        (S10); an empty batch is a no-op.  ``keys`` name the key of a new table
        that was opened without one."""
        if keys is not None and list(keys) != self.keys:
            if self.exists() and self.keys:
                raise ValueError(f"{self.root}: the table's key is {self.keys}, not {list(keys)}")
            self.keys = list(keys)
        return self.apply(incoming, lambda base, inc: M.merge(base, inc, self.keys, **merge_kw))

    def delete(self, delete_keys: DataFrame) -> int | None:
        """Delete rows by key (M13), rewriting only the buckets of the keys."""
        if not self.exists():
            return None
        return self.apply(delete_keys.select(*self.keys),
                          lambda base, keys: M.delete_by_key(base, keys, self.keys))


def parquet_sink(df: DataFrame, folder: str, name: str) -> str:
    """Write a named Parquet output (``.parquet`` appended if missing)."""
    if not name.endswith(".parquet"):
        name = name + ".parquet"
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path
