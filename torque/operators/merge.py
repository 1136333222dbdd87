"""Keyed mutation as pure DataFrame functions.

``merge(target, incoming, keys, policies)`` returns the new table; publishing
it (atomically, as a new snapshot version) is the job of
``sources.snapshots``.  Plans are chosen so that the big side, the target, is
not shuffled when the incoming batch is small:

* a batch that replaces whole rows: ``target LEFT ANTI JOIN keys(incoming)``, and
  the batch;
* a batch whose policies need old values: ``target LEFT JOIN incoming`` resolves
  every column in one pass over the target; the rows to insert are the batch's
  without the keys that a pass over the target's key columns finds;
* a batch over the broadcast bounds: its keys split the target (anti and semi
  joins), and touched rows are joined with the batch.

A batch is a stored table before anything else is done with it (``session.once``):
its plan runs once, and the checks for repeated keys and for size read its files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import once
from .broadcast import MAX_BROADCAST_KEY_ROWS, bounded_broadcast, is_small

# Conflict policies (fixed names).
REPLACE = "REPLACE"
CUMULATIVE = "CUMULATIVE"
PROGRESS = "PROGRESS"
SKIP_IF_NULL = "SKIP_IF_NULL"
CONCAT = "CONCAT"
POLICIES = (REPLACE, CUMULATIVE, PROGRESS, SKIP_IF_NULL, CONCAT)

CONCAT_SEPARATOR = ", "
SYNCED_AT = "synced_at"

_IN, _OLD = "__incoming_present", "__t"


def resolve(policy: str, old: Column, new: Column, update_only: bool = False) -> Column:
    """The value a key conflict leaves in a column.

    REPLACE      new value, null included
    CUMULATIVE   new + old; null on either side gives null
    PROGRESS     old value unless it is null (first non-null wins)
    SKIP_IF_NULL new value unless it is null
    CONCAT       old null -> new; new not null -> old || ', ' || new; else old
                 (update-only batches treat CONCAT as REPLACE)
    """
    if policy == REPLACE or (policy == CONCAT and update_only):
        return new
    if policy == CUMULATIVE:
        return new + old
    if policy == PROGRESS:
        return F.coalesce(old, new)
    if policy == SKIP_IF_NULL:
        return F.coalesce(new, old)
    if policy == CONCAT:
        return (F.when(old.isNull(), new)
                .when(new.isNotNull(), F.concat(old, F.lit(CONCAT_SEPARATOR), new))
                .otherwise(old))
    raise ValueError(f"unknown policy {policy!r}; expected one of {POLICIES}")


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _widens(a: T.DataType, b: T.DataType) -> bool:
    """Whether every value of type ``a`` is a value of type ``b``."""
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return _INTEGERS.index(type(a)) <= _INTEGERS.index(type(b))
    if isinstance(a, _INTEGERS) and isinstance(b, T.DecimalType):
        return b.precision - b.scale >= (3, 5, 10, 19)[_INTEGERS.index(type(a))]
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return b.scale >= a.scale and b.precision - b.scale >= a.precision - a.scale
    pairs = ((T.FloatType, T.DoubleType), (T.ByteType, T.DoubleType), (T.ShortType, T.DoubleType),
             (T.IntegerType, T.DoubleType), (T.ByteType, T.FloatType), (T.ShortType, T.FloatType),
             (T.DateType, T.TimestampNTZType), (T.CharType, T.StringType), (T.VarcharType, T.StringType))
    return isinstance(a, T.NullType) or any(isinstance(a, x) and isinstance(b, y) for x, y in pairs)


def conform(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """``df`` with the columns of ``types`` in those types.  A cast that could lose
    values (bigint to int, double to int, text to number) is refused."""
    out = []
    for f in df.schema.fields:
        want = types.get(f.name, f.dataType)
        if f.dataType.simpleString() != want.simpleString() and not _widens(f.dataType, want):
            raise ValueError(f"column {f.name}: {f.dataType.simpleString()} does not fit the table's "
                             f"{want.simpleString()}; cast it explicitly")
        out.append(F.col(f.name).cast(want).alias(f.name))
    return df.select(*out)


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """M5: within one batch the last row per key wins, "last" being the greatest
    ``order`` tuple (an explicit total order; Spark has no row order).

    Written as ``max(struct(order..., row...))`` per key: an aggregation with
    a map-side partial step before the shuffle (sort-based, as the struct
    buffer is not fixed-width), so a key holding a third of the batch leaves
    each map task as one row instead of being sorted in one task, as a
    ``row_number`` window would do.
    Remaining ties are broken by the row's own columns, deterministically.
    """
    keys = list(keys)
    cols = list(df.columns)
    # Order columns lead the struct; every other column follows once, as the
    # tie-breaker and the payload.  Named order columns are not repeated.
    fields, source_of = [], {}
    for i, c in enumerate(order):
        name = f"__o{i}"
        fields.append((F.col(c) if isinstance(c, str) else c).alias(name))
        if isinstance(c, str) and c in cols and c not in source_of:
            source_of[c] = name
    for i, c in enumerate(cols):
        if c not in source_of and c not in keys:
            source_of[c] = f"__c{i}"
            fields.append(F.col(c).alias(source_of[c]))
    whole = _no_null(keys)
    best = df.filter(whole).groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__best"))
    best = best.select(*[(F.col(c) if c in keys else F.col(f"__best.{source_of[c]}")).alias(c) for c in cols])
    if not any(f.nullable for f in df.schema.fields if f.name in keys):
        return best
    return best.unionByName(df.filter(~whole))


def _no_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def fold_batch(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               policies: Mapping[str, str] | None = None, default_policy: str = REPLACE,
               update_only: bool = False) -> DataFrame:
    """One row per key that has the effect of the batch's rows applied one after
    another in ``order`` (a total order), each column by its policy:

    REPLACE      the last value, null included
    CUMULATIVE   the sum; null once any value is null
    PROGRESS     the first value that is not null
    SKIP_IF_NULL the last value that is not null
    CONCAT       all values that are not null, joined in order

    Rows with a null key part match nothing and stay as they are.  First, last
    and sum combine map-side, so a hot key is one row per task; CONCAT's
    result holds every value of its key by its meaning, so its values are
    collected."""
    policies, keys = dict(policies or {}), list(keys)
    if all(policies.get(c, default_policy) == REPLACE for c in df.columns if c not in keys):
        return dedupe_last(df, keys, order)
    place = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)],
                     *[F.col(c).alias(f"r{i}") for i, c in enumerate(df.columns) if c not in keys])
    rows = df.filter(_no_null(keys)).withColumn("__place", place)
    aggs, last = [], F.max("__place")     # all replaced columns come from one row, the last
    field_of = {c: f"r{i}" for i, c in enumerate(df.columns) if c not in keys}
    for c in df.columns:
        if c in keys:
            continue
        policy, v = policies.get(c, default_policy), F.col(c)
        if policy == CONCAT and update_only:
            policy = REPLACE
        if policy == REPLACE:
            value = last[field_of[c]]
        elif policy == CUMULATIVE:
            value = F.when(F.count(v) == F.count(F.lit(1)), F.sum(v))
        elif policy == PROGRESS:
            value = F.min_by(v, F.when(v.isNotNull(), F.col("__place")))
        elif policy == SKIP_IF_NULL:
            value = F.max_by(v, F.when(v.isNotNull(), F.col("__place")))
        elif policy == CONCAT:
            parts = F.collect_list(F.when(v.isNotNull(), F.struct(F.col("__place").alias("p"), v.alias("v"))))
            value = F.when(F.count(v) > 0, F.array_join(F.transform(F.sort_array(parts), lambda x: x["v"]),
                                                        CONCAT_SEPARATOR))
        else:
            raise ValueError(f"unknown policy {policy!r}; expected one of {POLICIES}")
        aggs.append(value.cast(df.schema[c].dataType).alias(c))
    if not aggs:
        return df.filter(_no_null(keys)).distinct().unionByName(df.filter(~_no_null(keys)))
    folded = rows.groupBy(*keys).agg(*aggs).select(*df.columns)
    return folded.unionByName(df.filter(~_no_null(keys)))


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Refuse a batch that holds a key twice: without an order its rows have none."""
    if not df.filter(_no_null(keys)).groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError("the batch repeats a key; pass dedupe_order, the order in which its rows apply")


def _key_condition(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(f"{left}{k}") == F.col(f"{right}{k}")
        cond = c if cond is None else cond & c
    return cond


def _align(df: DataFrame, columns: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    return df.select(*[
        (F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in columns])


def merge(target: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
          policies: Mapping[str, str] | None = None, default_policy: str = REPLACE,
          synced_at: Column | None = None, dedupe_order: Sequence[str | Column] | None = None,
          strategy: str = "split", broadcast_key_rows: int = MAX_BROADCAST_KEY_ROWS,
          check_unique: bool = True) -> DataFrame:
    """Upsert ``incoming`` into ``target`` by ``keys``.

    * Only columns present in ``incoming`` change on a conflict; the others
      keep the target's value (null on a new row).  Incoming columns unknown to
      the target are appended.
    * ``policies`` maps a column to its conflict policy (default REPLACE);
      policies apply to conflicts only, a new row is inserted as it comes.
    * ``synced_at`` (a literal run time, never ``current_timestamp()`` in a
      reproducible job) stamps every inserted or updated row.
    * ``keys=[]`` is a plain append.  A missing target is an initial load.
    * Null key parts never match (SQL equality), so such rows insert.
    * ``dedupe_order`` is the order in which the batch's rows apply: rows of one
      key are folded by the policies first (M5, ``fold_batch``).  Without it a
      batch that repeats a key is refused (``check_unique=False``: the caller
      knows that it does not).
    * ``strategy``: ``split`` (anti + semi joins, target not shuffled for a
      small batch) or ``outer`` (one full outer join, shuffles the target).
    * ``broadcast_key_rows``: the batch keys are broadcast when there are at
      most this many (checked by a bounded count); 0 leaves it to the planner.
    """
    policies = dict(policies or {})
    keys = list(keys)
    if keys:
        if dedupe_order is not None:
            incoming = fold_batch(incoming, keys, dedupe_order, policies, default_policy)
        incoming = once(incoming)
        if dedupe_order is None and check_unique:
            require_unique(incoming, keys)
    if synced_at is not None:
        incoming = incoming.withColumn(SYNCED_AT, synced_at.cast("timestamp_ntz"))
    if target is None:
        return incoming
    if not keys:
        return target.unionByName(incoming, allowMissingColumns=True)

    incoming = conform(incoming, {f.name: f.dataType for f in target.schema.fields})
    t_types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    s_types = {f.name: f.dataType.simpleString() for f in incoming.schema.fields}
    out_cols = list(target.columns) + [c for c in incoming.columns if c not in t_types]
    types = {**s_types, **t_types}
    incoming_cols = set(incoming.columns)
    value_cols = [c for c in out_cols if c not in keys]
    needs_old = any(c not in incoming_cols for c in value_cols if c in t_types) or any(
        policies.get(c, default_policy) != REPLACE for c in value_cols if c in incoming_cols and c in t_types)

    if strategy == "outer":
        return _merge_outer(target, incoming, keys, policies, default_policy, out_cols, types)

    if needs_old and broadcast_key_rows and is_small(incoming, broadcast_key_rows):
        s, o = _sides(incoming, target)
        j = o.join(F.broadcast(s), _key_condition("t_", "s_", keys), "left")
        changed = j.select(*_resolved(out_cols, keys, incoming_cols, set(t_types), types, policies, default_policy, "t_"))
        # The touched keys are keys of the batch; the pass reads the target's key columns only.
        found = target.select(*keys).join(F.broadcast(incoming.select(*keys)), keys, "left_semi")
        return changed.unionByName(_align(incoming.join(found, keys, "left_anti"), out_cols, types))

    inc_keys = bounded_broadcast(incoming.select(*keys), broadcast_key_rows)
    untouched = target.join(inc_keys, keys, "left_anti")
    if not needs_old:
        touched = _align(incoming, out_cols, types)
    else:
        s, o = _sides(incoming, target.join(inc_keys, keys, "left_semi"))
        j = s.join(o, _key_condition("s_", "t_", keys), "left")
        touched = j.select(*_resolved(out_cols, keys, incoming_cols, set(t_types), types, policies, default_policy, "s_"))
    return _align(untouched, out_cols, types).unionByName(touched)


def _sides(incoming: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with prefixed columns and a flag that tells a missing row from nulls."""
    return (incoming.select(*[F.col(c).alias(f"s_{c}") for c in incoming.columns]).withColumn(_IN, F.lit(True)),
            target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns]).withColumn(_OLD, F.lit(True)))


def _resolved(out_cols: Sequence[str], keys: Sequence[str], incoming_cols: set[str], target_cols: set[str],
              types: Mapping[str, str], policies: Mapping[str, str], default_policy: str, key_side: str) -> list[Column]:
    """The columns of joined sides: an old row that meets none stays, a new one comes as it is."""
    new, old, exprs = F.col(_IN).isNotNull(), F.col(_OLD).isNotNull(), []
    for c in out_cols:
        if c in keys:
            exprs.append(F.col(f"{key_side}{c}").alias(c))
        elif c in incoming_cols and c in target_cols:
            both = resolve(policies.get(c, default_policy), F.col(f"t_{c}"), F.col(f"s_{c}"))
            value = F.when(~new, F.col(f"t_{c}")).when(~old, F.col(f"s_{c}")).otherwise(both)
            exprs.append(value.cast(types[c]).alias(c))
        else:
            exprs.append(F.col(f"{'s_' if c in incoming_cols else 't_'}{c}").alias(c))
    return exprs


def _merge_outer(target, incoming, keys, policies, default_policy, out_cols, types) -> DataFrame:
    """Reference form: one FULL OUTER join with an explicit presence flag on the
    incoming side, to tell "no incoming row" from "incoming null"."""
    incoming_cols = set(incoming.columns)
    t_cols = set(target.columns)
    s = incoming.select(*[F.col(c).alias(f"s_{c}") for c in incoming.columns]).withColumn(_IN, F.lit(True))
    o = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns]).withColumn("__t", F.lit(True))
    j = s.join(o, _key_condition("s_", "t_", keys), "full_outer")
    hit = F.col(_IN).isNotNull()
    exprs = []
    for c in out_cols:
        if c in keys:
            exprs.append(F.when(hit, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
        elif c in incoming_cols and c in t_cols:
            upd = F.when(F.col("__t").isNull(), F.col(f"s_{c}")).otherwise(
                resolve(policies.get(c, default_policy), F.col(f"t_{c}"), F.col(f"s_{c}")))
            exprs.append(F.when(hit, upd).otherwise(F.col(f"t_{c}")).cast(types[c]).alias(c))
        elif c in incoming_cols:
            exprs.append(F.when(hit, F.col(f"s_{c}")).alias(c))
        else:
            exprs.append(F.col(f"t_{c}").alias(c))
    return j.select(*exprs)


def update_only(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                policies: Mapping[str, str] | None = None, default_policy: str = REPLACE,
                synced_at: Column | None = None, dedupe_order: Sequence[str | Column] | None = None,
                broadcast_key_rows: int = MAX_BROADCAST_KEY_ROWS, check_unique: bool = True) -> DataFrame:
    """Apply a batch of updates; rows whose key is not in the target are
    ignored (never inserted).  Every key column is matched.  Only supplied
    columns change; CONCAT acts as REPLACE; ``synced_at`` stamps updated rows
    unless the batch carries its own.  Rows of one key apply in ``dedupe_order``;
    without it a repeated key is refused."""
    keys = list(keys)
    if not keys:
        raise ValueError("update_only needs a key: a keyless update would rewrite every row")
    policies = dict(policies or {})
    if dedupe_order is not None:
        incoming = fold_batch(incoming, keys, dedupe_order, policies, default_policy, update_only=True)
    incoming = once(incoming)
    if dedupe_order is None and check_unique:
        require_unique(incoming, keys)
    incoming = conform(incoming, {f.name: f.dataType for f in target.schema.fields})
    if synced_at is not None and SYNCED_AT not in incoming.columns:
        incoming = incoming.withColumn(SYNCED_AT, synced_at.cast("timestamp_ntz"))
    t_cols = list(target.columns)
    if SYNCED_AT in incoming.columns and SYNCED_AT not in t_cols:
        t_cols.append(SYNCED_AT)
        target = target.withColumn(SYNCED_AT, F.lit(None).cast("timestamp_ntz"))
    inc_cols = set(incoming.columns)
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}

    def updated(j: DataFrame) -> DataFrame:
        exprs = []
        for c in t_cols:
            if c in keys or c not in inc_cols:
                exprs.append(F.col(f"t_{c}").alias(c))
            else:
                v = resolve(policies.get(c, default_policy), F.col(f"t_{c}"), F.col(f"s_{c}"), update_only=True)
                exprs.append(F.when(F.col(_IN).isNull(), F.col(f"t_{c}")).otherwise(v).cast(types[c]).alias(c))
        return j.select(*exprs)

    on = _key_condition("t_", "s_", keys)
    if broadcast_key_rows and is_small(incoming, broadcast_key_rows):
        s, o = _sides(incoming, target.select(*t_cols))
        return updated(o.join(F.broadcast(s), on, "left"))     # one pass over the target
    inc_keys = bounded_broadcast(incoming.select(*keys), broadcast_key_rows)
    s, o = _sides(incoming, target.select(*t_cols).join(inc_keys, keys, "left_semi"))
    untouched = target.join(inc_keys, keys, "left_anti")
    return untouched.select(*t_cols).unionByName(updated(o.join(s, on, "inner")))


def delete_by_key(target: DataFrame, delete_keys: DataFrame, keys: Sequence[str],
                  broadcast_key_rows: int = MAX_BROADCAST_KEY_ROWS) -> DataFrame:
    """Drop the rows whose key (one or many columns) is listed.  A null key
    part matches nothing, so such rows stay.  A bounded key list is
    broadcast, so the target is filtered where it lies."""
    return target.join(bounded_broadcast(once(delete_keys.select(*keys)), broadcast_key_rows),
                       list(keys), "left_anti")


def delete_cascade(parent: DataFrame, child: DataFrame, delete_keys: DataFrame,
                   parent_key: str, child_fk: str,
                   broadcast_key_rows: int = MAX_BROADCAST_KEY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Delete parents by key and, as ``ON DELETE CASCADE``, the children
    that referenced a deleted parent.  Two anti joins against the (bounded,
    broadcast) deleted keys: neither table is shuffled for a small delete."""
    gone = parent.join(delete_keys.select(F.col(parent_key)), parent_key, "left_semi").select(parent_key)
    gone = bounded_broadcast(once(gone), broadcast_key_rows)
    parents = parent.join(gone, parent_key, "left_anti")
    children = child.join(gone.withColumnRenamed(parent_key, child_fk), child_fk, "left_anti")
    return parents, children


def strict_conflicts(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                     broadcast_key_rows: int = MAX_BROADCAST_KEY_ROWS) -> DataFrame:
    """M4 check: keys of ``incoming`` that already exist in the target or occur
    more than once in the batch, with the reason.  The target streams past the
    broadcast batch keys (not the other way round); per-key counts are
    combined map-side, so a hot key is one row."""
    keys = list(keys)
    incoming = once(incoming.select(*keys))
    counts = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hit = target.select(*keys).join(bounded_broadcast(incoming.select(*keys), broadcast_key_rows),
                                    keys, "left_semi")
    existing = counts.join(hit, keys, "left_semi").withColumn("reason", F.lit("exists"))
    repeated = counts.filter(F.col("n") > 1).withColumn("reason", F.lit("repeated"))
    return existing.unionByName(repeated)


def append_strict(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M4: plain insert; any key conflict is an error, before anything is
    published."""
    if not strict_conflicts(target, incoming, keys).isEmpty():
        raise ValueError("strict append: incoming keys conflict with the target or repeat")
    return target.unionByName(incoming, allowMissingColumns=True)


def load_table(target: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
               dedupe_order: Sequence[str | Column] | None = None) -> DataFrame:
    """Generic table load: upsert every supplied column by the key
    (composite keys allowed), rows of one key in ``dedupe_order``.  An empty batch is a no-op: the current table is
    returned as is, so no new version needs writing."""
    if target is not None and incoming.isEmpty():
        return target
    return merge(target, incoming, keys, dedupe_order=dedupe_order)
