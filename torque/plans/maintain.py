"""Upkeep of the derived tables when any of their sides changes.

The windowed flow derives facts of the sales that changed; a renamed brand, a late
customer, a new rate or a deleted sale never reach a stored fact.  Here the stored
fact and car dimension follow every side by the delta rule of joins: a row of the
join can change only if one of its sides did, so for each side its changed keys
are joined with the stored state of the sides between it and the root, and the
root keys so reached are summed over all sides.

1. Changed keys of a table are read from two of its versions: only buckets that
   differ between the manifests are scanned, and rows that are the same in both
   are no change.  Inserts, updates and deletes are all changes.
2. Keys travel from each side to the root along the foreign keys (brand -> cars
   -> sales): a set of keys that is proven small is broadcast, so the stored child
   streams past it unshuffled, once for all its parents.
3. The view is computed for the reached root keys only and replaces their stored
   rows; reached keys without a row are deleted.  Only buckets of reached keys are
   rewritten.

Each view remembers the versions of its sides that it holds, written after it is
published: a crash in between repeats the same step with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.broadcast import bounded_broadcast
from ..operators.star import Tables, dim_car_detail, fact_sales
from ..session import staged
from ..sources.buckets import Layout, layout
from ..sources.rates import RatesSnapshot
from ..sources.snapshots import SnapshotTable

# (child, foreign key, parent, parent's key)
Edge = tuple[str, str, str, str]

FACT_EDGES: list[Edge] = [
    ("car_sales", "car_id", "cars", "id"), ("cars", "brand_id", "brands", "id"),
    ("car_sales", "customer_id", "customers", "id"), ("customers", "address_city_id", "cities", "id"),
    ("car_sales", "currency_id", "currencies", "id"), ("currencies", "name", "currency_rates", "code")]
DIMENSION_EDGES: list[Edge] = [("cars", "brand_id", "brands", "id"), ("cars", "type_id", "types", "id")]

POSITIONS = "_maintained"


@dataclass(frozen=True)
class View:
    """A derived table: its root side (one row of the view for each of its keys at most),
    the foreign keys below it, and how it is computed from all sides."""

    name: str
    root: str
    root_key: str
    key: str
    edges: Sequence[Edge]
    compute: Callable[[Tables, RatesSnapshot | None], DataFrame]

    @property
    def sides(self) -> list[str]:
        return list(dict.fromkeys([self.root, *[p for _, _, p, _ in self.edges]]))


FACT = View("fact_car_sales_dataset", "car_sales", "id", "sale_id", FACT_EDGES, lambda t, r: fact_sales(t, r, None))
DIMENSION = View("dimension_car_detail", "cars", "id", "id", DIMENSION_EDGES, lambda t, r: dim_car_detail(t, None))


def changed_keys(table: SnapshotTable, before: int | None, after: int) -> DataFrame | None:
    """The keys whose rows differ between two versions (``before=None``: all keys of
    ``after``), or None if no bucket differs."""
    if before is None:
        return table.read(after).select(*table.keys)
    if before == after:
        return None
    old, new = layout(table, before), layout(table, after)
    moved = new.moved(old)
    if not moved:
        return None
    kinds = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}

    def rows(at: Layout, name: str) -> DataFrame:
        held = at.rows(moved)
        return held.select(*table.keys, F.struct(*[
            (F.col(c) if c in held.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in sorted(kinds)]).alias(name))

    both = rows(new, "now").join(rows(old, "then"), table.keys, "full_outer")
    return both.filter(~F.col("now").eqNullSafe(F.col("then"))).select(*table.keys)


def _staged_changes(table: SnapshotTable, before: int | None, after: int) -> DataFrame | None:
    keys = changed_keys(table, before, after)
    return None if keys is None else staged(keys, "changed-keys")


def reached(view: View, tables: Tables, changed: Mapping[str, DataFrame | None]) -> DataFrame | None:
    """Keys of the root side that a change of any side can have changed in the view:
    the root's own changed keys, and those that refer to a changed key through the
    stored sides between."""
    def up(side: str, key: str) -> DataFrame | None:
        own = changed.get(side)
        own = None if own is None else own.select(key)
        parents = [(fk, found) for child, fk, parent, pk in view.edges if child == side
                   if (found := up(parent, pk)) is not None]
        if parents:
            # One pass over the stored side for all its parents: each key set is a look-up.
            rows, hit = tables[side], F.lit(False)
            for i, (fk, keys) in enumerate(parents):
                keys = bounded_broadcast(keys.toDF(f"__k{i}"))
                rows = rows.join(keys, F.col(fk) == F.col(f"__k{i}"), "left")
                hit = hit | F.col(f"__k{i}").isNotNull()
            through = rows.filter(hit).select(key)
            own = through if own is None else own.unionByName(through)
        return None if own is None else staged(own.filter(F.col(key).isNotNull()).distinct(), f"reached-{side}")

    return up(view.root, view.root_key)


def replace_reached(base: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """The stored rows of other keys, and the batch's rows that are there."""
    rows = batch.filter("__there").drop("__there")
    if base is None:
        return rows
    kept = base.join(bounded_broadcast(batch.select(key)), key, "left_anti")
    return kept.select(*rows.columns).unionByName(rows)


def _versions(spark: SparkSession, root: str) -> dict[str, dict[str, int]]:
    """The versions of its sides that each view holds (one row a side)."""
    held, out = SnapshotTable(spark, f"{root}/{POSITIONS}").read(), {}
    for r in [] if held is None else held.collect():
        out.setdefault(r["view"], {})[r["side"]] = r["version"]
    return out


def _follow(spark: SparkSession, root: str, view: View, base_code: str, held: Mapping[str, int], now: Mapping[str, int],
            buckets: int | None) -> int | None:
    """Bring one view from the ``held`` versions of its sides to those of ``now``."""
    sides = {n: SnapshotTable(spark, f"{root}/{n}") for n in view.sides}
    stored = SnapshotTable(spark, f"{root}/{view.name}", schemas.PRIMARY_KEYS[view.name], buckets)
    if held == now:
        return stored.current_version()
    # Sides are read at the versions that are noted, whatever is loaded meanwhile.
    tables = {n: t.read(now[n]) for n, t in sides.items()}
    rates = None
    if "currency_rates" in tables:
        rates = RatesSnapshot(tables["currency_rates"], base_code, n_codes=tables["currency_rates"].count())
    if not held or not stored.exists():
        return stored.write(view.compute(tables, rates))
    # Each side is compared by itself: independent jobs from a few driver threads.
    with ThreadPoolExecutor(max_workers=len(sides)) as pool:
        changed = dict(zip(sides, pool.map(lambda n: _staged_changes(sides[n], held.get(n), now[n]), sides), strict=True))
    new_rates = changed.get("currency_rates")
    if new_rates is not None and not new_rates.filter(F.col("code") == base_code).isEmpty():
        # Every price is stated in the base currency: its change reaches all sales, stored or not.
        keys = staged(tables[view.root].select(view.root_key).unionByName(
            stored.read().select(F.col(view.key).alias(view.root_key))).distinct(), "reached-all")
    else:
        keys = reached(view, tables, changed)
    if keys is not None:
        root_rows = tables[view.root].join(bounded_broadcast(keys), view.root_key, "left_semi")
        rows = view.compute({**tables, view.root: root_rows}, rates).withColumn("__there", F.lit(True))
        batch = keys.toDF(view.key).join(rows, view.key, "left").fillna(False, ["__there"])
        stored.apply(batch.select(*rows.columns), lambda base, b: replace_reached(base, b, view.key))
    return stored.current_version()


def maintain(spark: SparkSession, dest_root: str, base_code: str, views: Sequence[View] = (DIMENSION, FACT),
             buckets: int | None = None) -> dict[str, int | None]:
    """Bring the views of a destination up to the current versions of their sides; a view
    with a side that was never loaded is left out.  Returns the views' versions."""
    held = _versions(spark, dest_root)
    now = {n: SnapshotTable(spark, f"{dest_root}/{n}").current_version() for n in dict.fromkeys(s for v in views for s in v.sides)}
    ready = [v for v in views if all(now[n] is not None for n in v.sides)]
    if not ready:
        return {}
    with ThreadPoolExecutor(max_workers=len(ready)) as pool:
        done = list(pool.map(lambda v: _follow(spark, dest_root, v, base_code, held.get(v.name, {}), {n: now[n] for n in v.sides}, buckets), ready))
    noted = [(v.name, n, now[n]) for v in ready for n in v.sides if held.get(v.name, {}).get(n) != now[n]]
    if noted:
        SnapshotTable(spark, f"{dest_root}/{POSITIONS}", ["view", "side"], 1).merge(
            spark.createDataFrame(noted, "view string, side string, version bigint"))
    return {v.name: n for v, n in zip(ready, done, strict=True)}
