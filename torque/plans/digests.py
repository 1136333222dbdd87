"""Reconciliation of two stored tables by digest trees.

Two large tables that should be equal are compared without reading what is equal.
Every stored bucket has leaves (by a hash of the key), and every leaf an order-free
digest of its rows: their number, the exact sum of one 64-bit hash of each row and
the exclusive-or of another.  Digests of an attempt's buckets are computed once,
from the rows of that attempt, and kept beside the table: versions share them, as
they share files.  Digests add up, so a bucket's is that of its leaves.  Buckets
are compared first, then the leaves of those that differ; rows are read only
from the folders of buckets that differ, and joined only in leaves that do.

A digest that is equal by chance hides a difference: 128 bits and a count per leaf.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.broadcast import bounded_broadcast
from ..session import staged
from ..sources.buckets import Layout, layout
from ..sources.snapshots import SnapshotTable, bucket_of

LEAVES = 64
SIDECAR = "_digests"


def leaf_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), *[F.col(k) for k in keys]), F.lit(LEAVES)).cast("int")


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of a row's values; nulls, which Spark's hash passes over, count by their place."""
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def digest_rows(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, n, total, mixed): the digest of the rows of each group.  The aggregates have
    fixed-width state and combine map-side."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_hash(columns, 1).cast("decimal(19,0)")).cast("decimal(38,0)").alias("total"),
        F.bit_xor(row_hash(columns, 2)).alias("mixed"))


def digests(at: Layout) -> DataFrame:
    """(bucket, leaf, n, total, mixed) of a version.  Attempts without stored digests are
    scanned, once; all others come from the sidecar."""
    table = at.table
    held = table.spark.createDataFrame([(a, b) for b, a in at.attempts.items()], "attempt string, bucket int")
    sidecar = SnapshotTable(table.spark, f"{table.root}/{SIDECAR}", ["attempt", "bucket", "leaf"], 1)
    known = sidecar.read()
    done = set() if known is None else {
        r["bucket"] for r in known.select("attempt", "bucket").distinct().join(F.broadcast(held), ["attempt", "bucket"], "left_semi").collect()}
    missing = sorted(set(at.attempts) - done)
    if missing:
        rows = at.rows(missing)
        columns = sorted(rows.columns)
        rows = rows.select(*[F.col(c) for c in columns], bucket_of(table.keys, table.buckets).alias("__bucket"), leaf_of(table.keys).alias("leaf"))
        found = digest_rows(rows, ["__bucket", "leaf"], columns).withColumnRenamed("__bucket", "bucket")
        sidecar.merge(found.join(F.broadcast(held), "bucket"), check_unique=False)
        known = sidecar.read()
    return known.join(F.broadcast(held), ["attempt", "bucket"], "left_semi").drop("attempt")


def _differ(both: DataFrame, *by: str) -> DataFrame:
    """The nodes whose digests, added up for each side, differ."""
    def of(side: int) -> Column:
        return F.struct(*[agg(F.when(F.col("side") == side, F.col(c))).alias(c)
                          for c, agg in (("n", F.sum), ("total", F.sum), ("mixed", F.bit_xor))])
    return both.groupBy(*by).agg(of(1).alias("x"), of(2).alias("y")).filter(~F.col("x").eqNullSafe(F.col("y"))).select(*by)


def differing(a: DataFrame, b: DataFrame) -> tuple[list[int], DataFrame]:
    """(buckets, their leaves) whose digests differ: the tree's nodes from the top down."""
    both = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(2)))
    buckets = sorted(r["bucket"] for r in _differ(both, "bucket").collect())        # a number a bucket at most
    return buckets, staged(_differ(both.filter(F.col("bucket").isin(buckets)), "bucket", "leaf"), "differing-leaves")


def reconcile_digest(a: SnapshotTable, b: SnapshotTable, columns: Sequence[str] | None = None, version_a: int | None = None,
                     version_b: int | None = None) -> DataFrame:
    """(keys, difference, <column>_a, <column>_b): the rows that are not the same in both
    tables: ``added`` (in b only), ``removed`` (in a only) or ``changed``.  The tables share
    key, bucket count and columns; ``columns`` are the ones shown."""
    if a.keys != b.keys or a.buckets != b.buckets:
        raise ValueError(f"the tables must share key and buckets: {a.keys}, {a.buckets} and {b.keys}, {b.buckets}")
    one, two = (layout(t, t.current_version() if v is None else v) for t, v in ((a, version_a), (b, version_b)))
    if {f.name: f.dataType for f in one.schema.fields} != {f.name: f.dataType for f in two.schema.fields}:
        raise ValueError("the tables must have the same columns")
    with ThreadPoolExecutor(max_workers=2) as pool:
        buckets, leaves = differing(*pool.map(digests, (one, two)))
    values = sorted(c for c in one.schema.names if c not in a.keys)

    def rows(at: Layout, name: str) -> DataFrame:
        some = at.rows(buckets).withColumn("bucket", bucket_of(a.keys, a.buckets)).withColumn("leaf", leaf_of(a.keys))
        return some.join(bounded_broadcast(leaves), ["bucket", "leaf"], "left_semi").select(*a.keys, F.struct(*values).alias(name))

    both = rows(one, "a").join(rows(two, "b"), a.keys, "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    difference = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    return both.select(*a.keys, difference.alias("difference"),
                       *[F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in (values if columns is None else columns) for side in "ab"])
