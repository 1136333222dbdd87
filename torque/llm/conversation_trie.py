"""Prefix trie of rebuilt conversations, from composable fingerprints of stored turns.

A conversation c is rebuilt as the first h turns of its base conversation c - c % 100
(all if it has fewer, none if there is no such conversation) and c's own turns after
its first h, with h = crc32(decimal c) % 6.  A node is a distinct sequence of the
first d rebuilt turns; its members are the rebuilt conversations that begin with it.

No rebuilt text is ever made.  A sequence of turns has the fingerprint
(length, sum of t_j * B**(j-1) modulo 2**61 - 1) in two lanes with bases of their own,
and (n, s) * (m, u) = (n + m, s + u * B**n) is a monoid.  So

1. stored turns become content keys (two 64-bit hashes) and are sorted over range
   partitions; each partition scans its turns into local products, and a conversation
   that spans partitions takes the product of those before it as a carry (a row a
   partition), so no conversation has to fit a task;
2. every prefix of a rebuilt conversation is head product * (own product / own head),
   a few multiplications on a row of numbers that keeps a reference to the stored
   turn (conversation, position) it ends with;
3. nodes are groups of equal (depth, fingerprint).  Equality is verified: all members
   of a node must have the same parent and the same last content key, and stored
   turns with one content key are compared by role and text.  If anything differs,
   two sequences have collided and the whole is done again with other seeds;
4. sums over subtrees need no walk: each leaf, and each node's weight, belongs to
   the smallest member of that node, so they are sums over a node's members of what
   a conversation owns from that depth on (running sums in blocks of ``BLOCK`` depths
   with carries).  Nodes of one member have nothing to sum.

Edge cases: null roles and texts are empty; a null turn is first; turns of equal number
are ordered by their content keys; repeated rows are turns of their own; rows without a
``conv_id`` (an integer) belong to no conversation and are left out; a rebuilt
conversation without turns ends at the root; an empty table gives no node; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage

FAMILY, HEADS = 100, 6
BLOCK = 4096
TRIES = 16
MERSENNE = (1 << 61) - 1
_P, _LOW31, _LOW30 = np.uint64(MERSENNE), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_KEY = ["depth", "f1", "f2"]


# -- arithmetic modulo 2**61 - 1 ------------------------------------------------

def _reduce(x: np.ndarray) -> np.ndarray:
    x = (x >> np.uint64(61)) + (x & _P)
    return np.where(x >= _P, x - _P, x)


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1 from 31-bit halves; no product passes 64 bits."""
    ah, al, bh, bl = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    middle = al * bh + ah * bl
    return _reduce(ah * bh * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + al * bl)


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _reduce(a + b)


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _reduce(a + (_P - b))


def running(terms: np.ndarray) -> np.ndarray:
    """Running sums modulo 2**61 - 1 (halves are added up apart)."""
    high = _reduce(np.cumsum(terms >> np.uint64(31)))
    return add(multiply(high, np.full(len(high), 1 << 31, np.uint64)), _reduce(np.cumsum(terms & _LOW31)))


class Powers:
    """B**e for exponents below 2**36, from three tables."""

    def __init__(self, base: int):
        self.tables = [np.array([pow(base, j << (12 * i), MERSENNE) for j in range(4096)], np.uint64) for i in range(3)]

    def __call__(self, e: np.ndarray) -> np.ndarray:
        e = e.astype(np.int64)
        t0, t1, t2 = self.tables
        out = t0[e & 4095]
        return out if not len(e) or e.max() < 4096 else multiply(multiply(out, t1[(e >> 12) & 4095]), t2[e >> 24])


def bases(seed: int) -> tuple[int, int]:
    """The bases of the two lanes."""
    rng = random.Random(seed)
    return rng.randrange(1 << 40, MERSENNE), rng.randrange(1 << 40, MERSENNE)


def content_keys(seed: int) -> tuple[Column, Column]:
    """Two 64-bit hashes of a turn's role and text."""
    return F.xxhash64(F.lit(2 * seed), "role", "text"), F.xxhash64(F.lit(2 * seed + 1), "text", "role")


def _u64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _term(key: np.ndarray) -> np.ndarray:
    return _reduce(key >> np.uint64(3))


# -- kernels ----------------------------------------------------------------------

def _scan(seeds: tuple[int, int]):
    """Sorted (conv_id, a, b, chars) -> the local position and product of each turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = [Powers(s) for s in seeds]
        part = TaskContext.get().partitionId()
        last, n, sums = None, 0, [np.uint64(0), np.uint64(0)]
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            opens = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            segment = np.cumsum(np.r_[True, conv[1:] != conv[:-1]]) - 1
            k = np.arange(len(conv)) - opens[segment] + 1
            goes_on = last is not None and conv[0] == last
            k[segment == 0] += n if goes_on else 0
            lanes = []
            for lane in range(2):
                total = running(multiply(_term(_u64(batch.column(1 + lane))), power[lane](k - 1)))
                before = np.r_[np.uint64(0), total][opens][segment]
                value = subtract(total, before)
                if goes_on:
                    value = np.where(segment == 0, add(value, np.full(len(value), sums[lane])), value)
                lanes.append(value)
            last, n, sums = conv[-1], int(k[-1]), [x[-1] for x in lanes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(k), *map(_i64, lanes),
                 *batch.columns[1:]], ["conv_id", "part", "k", "l1", "l2", "a", "b", "chars"])
    return run


def _carry(seeds: tuple[int, int]):
    """The partitions of one conversation -> the product of those before each."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        n, sums, rows = 0, [0, 0], []
        for r in table.to_pylist():
            rows.append({"conv_id": r["conv_id"], "part": r["part"], "n0": n, "s1": sums[0], "s2": sums[1]})
            sums = [(s + r[x] * pow(b, n, MERSENNE)) % MERSENNE
                    for s, x, b in zip(sums, ("l1", "l2"), seeds, strict=True)]
            n += r["n"]
        return pa.Table.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("n0", pa.int64()),
                                                     ("s1", pa.int64()), ("s2", pa.int64())]))
    return run


def _place(seeds: tuple[int, int]):
    """Carry * local product: the position and product within the whole conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = [Powers(s) for s in seeds]
        for batch in batches:
            c = dict(zip(batch.schema.names, batch.columns, strict=True))
            n0 = c["n0"].to_numpy()
            lanes = [add(_u64(c[s]), multiply(_u64(c[x]), power[i](n0))) for i, (s, x) in enumerate((("s1", "l1"), ("s2", "l2")))]
            yield pa.RecordBatch.from_arrays(
                [c["conv_id"], pa.array(n0 + c["k"].to_numpy()), *map(_i64, lanes), c["a"], c["b"], c["chars"]],
                ["conv_id", "pos", "p1", "p2", "a", "b", "chars"])
    return run


def _compose(seeds: tuple[int, int]):
    """Own turns after the first h -> rows of their prefixes: head * own / own head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = [Powers(s) for s in seeds]
        back = [Powers(pow(s, -1, MERSENNE) if s else 0) for s in seeds]
        for batch in batches:
            c = dict(zip(batch.schema.names, batch.columns, strict=True))
            m, h, pos = (c[x].to_numpy() for x in ("m", "h", "pos"))
            depth = m + pos - h
            here, parent = [], []
            for i, key in enumerate(("a", "b")):
                own = subtract(_u64(c[f"p{i + 1}"]), _u64(c[f"o{i + 1}"]))
                value = add(_u64(c[f"b{i + 1}"]), multiply(own, back[i](h - m)))
                here.append(value)
                parent.append(subtract(value, multiply(_term(_u64(c[key])), power[i](depth - 1))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(depth), *map(_i64, here), *map(_i64, parent), c["conv_id"], c["a"], c["b"], c["chars"],
                 c["conv_id"], c["pos"], pa.array(depth == c["total"].to_numpy())], list(_MEMBER))
    return run


_MEMBER = {"depth": "bigint", "f1": "bigint", "f2": "bigint", "g1": "bigint", "g2": "bigint", "conv_id": "bigint",
           "a": "bigint", "b": "bigint", "chars": "bigint", "ref_conv_id": "bigint", "ref_pos": "bigint",
           "is_end": "boolean"}


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) -> for each node and batch the decimal ids, comma-joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node = np.stack([c.to_numpy() for c in batch.columns[:3]], 1)
        opens = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]).any(1)])
        ids = batch.column(3).to_pylist()
        text = [",".join(map(str, ids[x:y])) for x, y in zip(opens, [*opens[1:], len(ids)], strict=True)]
        at = pa.array(opens)
        yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns], pa.array(text)], [*_KEY, "first", "ids"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, first, ids) -> (node, digest); one digest is open at a time."""
    node, state, out = None, None, []

    def rows() -> pa.RecordBatch:
        *key, digest = zip(*out, strict=True)
        out.clear()
        return pa.RecordBatch.from_arrays([*[pa.array(k, pa.int64()) for k in key], pa.array(digest)], [*_KEY, "digest"])

    for batch in batches:
        c = batch.to_pydict()
        for *key, ids in zip(*(c[k] for k in _KEY), c["ids"], strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
            if len(out) >= 10_000:
                yield rows()
    if node is not None:
        out.append((*node, state.hexdigest()))
        yield rows()


# -- steps ------------------------------------------------------------------------

def placed_turns(turns: DataFrame, seeds: tuple[int, int]) -> DataFrame:
    """(conv_id, pos, p1, p2, a, b, chars): position and prefix product of every stored turn."""
    # A row number of no meaning is the last sort key: equal rows can be parted as well.
    order = ["conv_id", "turn", "a", "b", "any"]
    ordered = (turns.select("conv_id", "turn", "a", "b", "chars", F.monotonically_increasing_id().alias("any"))
               .repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "a", "b", "chars"))
    local = stage(ordered.mapInArrow(_scan(seeds), "conv_id bigint, part int, k bigint, l1 bigint, l2 bigint, "
                                                   "a bigint, b bigint, chars bigint"), "trie-local")
    blocks = stage(local.groupBy("conv_id", "part").agg(F.max("k").alias("n"), F.max_by("l1", "k").alias("l1"),
                                                        F.max_by("l2", "k").alias("l2")), "trie-blocks")
    spanning = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("conv_id")
    carries = (blocks.join(broadcast_if_small(stage(spanning, "trie-spanning")), "conv_id", "left_semi")
               .groupBy("conv_id").applyInArrow(_carry(seeds), "conv_id bigint, part int, n0 bigint, s1 bigint, s2 bigint"))
    # Two rows for each border between partitions at most.
    carries = broadcast_if_small(stage(carries, "trie-carries"))
    joined = local.join(carries, ["conv_id", "part"], "left").fillna(0, ["n0", "s1", "s2"])
    return stage(joined.mapInArrow(_place(seeds), "conv_id bigint, pos bigint, p1 bigint, p2 bigint, a bigint, "
                                                  "b bigint, chars bigint"), "trie-placed")


def rebuilt(placed: DataFrame) -> DataFrame:
    """A row for each conversation: its head (the base's first turns, five at most, as
    numbers and references) and the products that its own turns are composed with."""
    fields = ["p1", "p2", "a", "b", "chars"]
    first = [F.max(F.when(F.col("pos") == i, F.col(x))).alias(f"{x}_{i}") for i in range(1, HEADS) for x in fields]
    convs = stage(placed.groupBy("conv_id").agg(F.max("pos").alias("n"), *first), "trie-convs")
    turns = [F.struct(F.lit(i).cast("bigint").alias("pos"), *[F.col(f"{x}_{i}").alias(x) for x in fields],
                      *[(F.col(f"p{k}_{i - 1}") if i > 1 else F.lit(0).cast("bigint")).alias(f"q{k}") for k in (1, 2)])
             for i in range(1, HEADS)]
    heads = convs.select(F.col("conv_id").alias("base"),
                         F.filter(F.array(*turns), lambda t: t["pos"] <= F.col("n")).alias("turns"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).cast("bigint")
    own = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    for k in (1, 2):
        at_h = F.coalesce(*[F.when(F.col("h") == i, F.col(f"p{k}_{i}")) for i in range(1, HEADS)], F.lit(0))
        own = own.withColumn(f"o{k}", at_h.cast("bigint"))
    both = own.join(heads, "base", "left").withColumn(
        "head", F.when(F.col("turns").isNotNull(), F.slice("turns", F.lit(1), F.col("h").cast("int"))))
    m = F.coalesce(F.size("head"), F.lit(0)).cast("bigint")
    m = F.when(F.col("head").isNull(), F.lit(0).cast("bigint")).otherwise(m)
    both = both.withColumn("m", m)
    ends = F.get("head", (F.col("m") - 1).cast("int"))
    return stage(both.select(
        "conv_id", "base", "h", "m", "o1", "o2", "head", (F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("total"),
        *[F.when(F.col("m") > 0, ends[f"p{k}"]).otherwise(F.lit(0)).cast("bigint").alias(f"b{k}") for k in (1, 2)]),
        "trie-rebuilt")


def member_rows(placed: DataFrame, convs: DataFrame, seeds: tuple[int, int]) -> DataFrame:
    """A row for every prefix of every rebuilt conversation, the root's included."""
    none = F.lit(0).cast("bigint")
    roots = convs.select(none.alias("depth"), none.alias("f1"), none.alias("f2"), none.alias("g1"), none.alias("g2"), "conv_id",
                         none.alias("a"), none.alias("b"), none.alias("chars"), F.lit(None).cast("bigint").alias("ref_conv_id"),
                         F.lit(None).cast("bigint").alias("ref_pos"), (F.col("total") == 0).alias("is_end"))
    t = F.col("t")
    heads = convs.select("conv_id", "base", "total", F.explode("head").alias("t")).select(
        t["pos"].alias("depth"), t["p1"].alias("f1"), t["p2"].alias("f2"), t["q1"].alias("g1"), t["q2"].alias("g2"), "conv_id",
        t["a"].alias("a"), t["b"].alias("b"), t["chars"].alias("chars"), F.col("base").alias("ref_conv_id"),
        t["pos"].alias("ref_pos"), (t["pos"] == F.col("total")).alias("is_end"))
    tails = placed.join(broadcast_if_small(convs.select("conv_id", "h", "m", "o1", "o2", "b1", "b2", "total")),
                        "conv_id").filter("pos > h")
    tails = tails.mapInArrow(_compose(seeds), ", ".join(f"{k} {v}" for k, v in _MEMBER.items()))
    return stage(roots.unionByName(heads).unionByName(tails), "trie-members")


def trie_nodes(members: DataFrame) -> DataFrame:
    """A row for each group of equal fingerprints, and whether its members agree."""
    def same(*names: str) -> Column:
        equal = F.lit(True)
        for x in names:
            equal = equal & (F.max(x) == F.min(x))
        return equal

    return stage(members.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("g1").alias("g1"),
        F.max("g2").alias("g2"), F.max("chars").alias("chars"), F.min("ref_conv_id").alias("ref_conv_id"),
        F.min_by("ref_pos", "ref_conv_id").alias("ref_pos"), same("g1", "g2", "a", "b").alias("agree")), "trie-nodes")


def _keys_differ(turns: DataFrame, placed: DataFrame) -> bool:
    """Whether two different stored turns have one content key: turns whose key stands
    twice or more are grouped by key, role and text (combined map-side)."""
    twice = placed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b")
    compared = turns.join(broadcast_if_small(stage(twice, "trie-repeated")), ["a", "b"], "left_semi")
    kinds = compared.groupBy("a", "b", "role", "text").agg(F.lit(1).alias("one"))
    return not kinds.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def _subtrees(members: DataFrame, nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """(node, saved_tokens, n_leaves) of the nodes with two members or more."""
    shared = members.select(*_KEY, F.col("conv_id").alias("member")).join(
        broadcast_if_small(nodes.filter("n_convs > 1").select(*_KEY, "conv_id", "n_convs", "chars")), _KEY)
    owned = F.when(F.col("member") == F.col("conv_id"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)
    shared = stage(shared.select(*_KEY, "member", owned.cast("bigint").alias("w"),
                                 F.floor(F.col("depth") / BLOCK).alias("block")), "trie-shared")
    inside = Window.partitionBy("member", "block").orderBy(F.col("depth").desc())
    below = Window.partitionBy("member").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    deeper = (shared.groupBy("member", "block").agg(F.sum("w").alias("w"))
              .select("member", "block", F.sum("w").over(below).alias("deeper")).filter("deeper > 0"))
    owns = (shared.withColumn("from_here", F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .join(broadcast_if_small(stage(deeper, "trie-deeper")), ["member", "block"], "left")
            .join(broadcast_if_small(leaves.select(F.col("conv_id").alias("member"), F.lit(1).alias("leaf"))), "member", "left"))
    return owns.groupBy(*_KEY).agg(
        F.sum(F.col("from_here") + F.coalesce("deeper", F.lit(0))).alias("saved_tokens"), F.count("leaf").alias("n_leaves"))


def _ends(members: DataFrame) -> DataFrame:
    """(node, digest) of the nodes at which conversations end.  Ids are joined in range
    partitions, so the one task that must read a hot node's list gets it in few rows."""
    order = [*_KEY, "conv_id"]
    packed = stage(members.filter("is_end").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_pack, "depth bigint, f1 bigint, f2 bigint, first bigint, ids string"), "trie-ends")
    return (packed.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
            .mapInArrow(_digest, "depth bigint, f1 bigint, f2 bigint, digest string"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and the stored turn it ends with (ref_conv_id, ref_pos)."""
    for seed in range(TRIES):
        seeds, (a, b) = bases(seed), content_keys(seed)
        turns = conversations.filter("conv_id is not null").select(
            F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"))
        turns = turns.select("*", a.alias("a"), b.alias("b"), F.length("text").cast("bigint").alias("chars"))
        placed = placed_turns(turns, seeds)
        if _keys_differ(turns, placed):
            continue
        convs = rebuilt(placed)
        members = member_rows(placed, convs, seeds)
        nodes = trie_nodes(members)
        if nodes.filter("not agree").isEmpty():
            return _described(members, nodes)
    raise RuntimeError(f"fingerprints collided under {TRIES} seeds")


def _described(members: DataFrame, nodes: DataFrame) -> DataFrame:
    parents = [(F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")]
    children = nodes.filter("depth > 0").groupBy(*parents).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, _KEY, "left").fillna(0, ["n_children"]), "trie-counted")
    sums = _subtrees(members, nodes, nodes.filter("n_children = 0"))
    above = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"),
                                                  F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id"))
    root = F.col("depth") == 0
    return (nodes.join(above, ["depth", "g1", "g2"], "left").join(sums, _KEY, "left").join(_ends(members), _KEY, "left")
            .select("conv_id", "depth", F.when(~root, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
                    F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
                    F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
                    F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "ref_conv_id", "ref_pos"))
