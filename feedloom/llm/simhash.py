"""Near-duplicate documents by SimHash fingerprints and vantage-point trees over the Hamming distance.

A fingerprint has 64 bits, taken from the XXH64 hashes (seed 42) of the runs of three lower-cased words. Equal
fingerprints are one node, so copies cost nothing. Nodes are dealt to shards by a vantage-point tree built on a bounded
sample: its branches are split by the distance to a vantage point. A node lives in one shard, and also visits every
shard that the triangle inequality cannot rule out for the search radius. A shard that is still too large is dealt again by a
tree built on a sample of its own, until every shard is below a bound. Within a shard a tree of its own finds the near pairs; of these only a spanning forest leaves the shard, so a dense group gives no square of links. Links of all
shards are joined to components.

Null and empty texts have fingerprint zero and link like any other. Repeated rows share a fingerprint. A null id takes
the component of its fingerprint, and never names one. No rows: no rows out.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import cut
from .frames import append, components, field
from .words import Words, mix

SAMPLE = 1 << 14  # fingerprints that the dealing tree is fitted on: a fixed bound
SHARD_NODES = 1 << 13  # nodes that a shard should have
PART_SAMPLE = 1 << 12  # nodes of a shard that is dealt again that its tree is fitted on
CHUNK_ROWS = 1 << 16  # rows of it that one task deals
LARGE = 16  # a shard with so many times the rows that it should have nodes, visitors counted, is dealt again
MOST_LEVELS = 8
LEAF = 64  # nodes compared directly
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprints(column: pa.Array, size: int = 3) -> np.ndarray:
    """The unsigned 64-bit fingerprint of each text."""
    words = Words.of(column)
    out = np.zeros(len(words.first) - 1, np.uint64)
    if not len(words):
        return out
    length = words.end - words.start + 1  # a word and one space
    upto = np.cumsum(length)
    place = np.arange(upto[-1]) + np.repeat(words.start - (upto - length), length)
    joined = words.data[np.minimum(place, len(words.data) - 1)]
    joined[upto - 1] = 32
    raw = memoryview(joined.tobytes().translate(_LOWER))
    # from each word on that has enough words behind it; a short text is one run
    begin = np.flatnonzero((words.left() >= size) | ((words.left() == np.repeat(words.count, words.count)) & (words.left() < size)))
    last = np.minimum(begin + size, np.repeat(words.first[1:], words.count)[begin]) - 1
    starts, ends = (upto - length)[begin].tolist(), (upto - 1)[last].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], 42) for a, b in zip(starts, ends)), np.uint64, len(begin))
    row = words.row[begin]
    used, first, n = np.unique(row, return_index=True, return_counts=True)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    out[used] = np.packbits(2 * ones > n[:, None], axis=1).view(">u8").ravel()
    return out


def fingerprint(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a long of the same 64 bits."""

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {name: pa.array(fingerprints(batch.column(0)).view(np.int64))}

    return append(docs, fn, [field(name, T.LongType())], text=text, keep=keep)


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _best_split(points: np.ndarray, radius: int, seed: int, least: float = 0.25) -> tuple[np.uint64, int] | None:
    """Of a few vantage points and limits, those that cut ``points`` in parts of a share of ``least`` at least and put the
    fewest of them within the radius of the limit."""
    rng = np.random.default_rng(seed)
    best = None
    for vantage in points[rng.integers(0, len(points), 12)]:
        upto = np.cumsum(np.bincount(distance(points, vantage), minlength=66)) / len(points)
        for limit in range(64):
            if least <= upto[limit] <= 1 - least:
                both = upto[min(limit + radius, 65)] - (upto[limit - radius] if limit >= radius else 0)
                cost = both + 0.3 * abs(upto[limit] - 0.5)
                if best is None or cost < best[0]:
                    best = (cost, vantage, limit)
    return None if best is None else best[1:]


@dataclass(frozen=True)
class Branch:
    """Points at most ``limit`` from ``vantage`` are on the near side, the others on the far side."""

    vantage: np.uint64
    limit: int
    near: Branch | int
    far: Branch | int


def build(sample: np.ndarray, shards: int, radius: int, least: float = 0.25) -> Branch | int:
    """A tree with at most ``shards`` leaves, numbered from 0, that cuts the largest part of the sample first."""
    parts, cuts = [sample], {}
    blocked: set[int] = set()
    children: dict[int, tuple[np.uint64, int, int, int]] = {}
    leaves = {0}
    while len(leaves) < shards:
        open_ = [i for i in leaves if i not in blocked and len(parts[i]) >= 8]
        if not open_:
            break
        i = max(open_, key=lambda i: len(parts[i]))
        found = _best_split(parts[i], radius, i, least)
        if found is None:
            blocked.add(i)
            continue
        near = distance(parts[i], found[0]) <= found[1]
        parts += [parts[i][near], parts[i][~near]]
        children[i] = (*found, len(parts) - 2, len(parts) - 1)
        leaves = leaves - {i} | {len(parts) - 2, len(parts) - 1}
    number = {i: k for k, i in enumerate(sorted(leaves))}

    def branch(i: int) -> Branch | int:
        if i in number:
            return number[i]
        vantage, limit, near, far = children[i]
        return Branch(vantage, limit, branch(near), branch(far))

    return branch(0)


def deal(tree: Branch | int, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, index of the point, whether it lives there) for every shard that a point lives in or visits."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def go(node: Branch | int, at: np.ndarray, home: np.ndarray) -> None:
        if not len(at):
            return
        if isinstance(node, (int, np.integer)):
            out.append((np.full(len(at), node, np.int64), at, home))
            return
        d = distance(points[at], node.vantage).astype(np.int64)
        inside = d <= node.limit
        near, far = d - radius <= node.limit, d + radius > node.limit
        go(node.near, at[near], (home & inside)[near])
        go(node.far, at[far], (home & ~inside)[far])

    go(tree, np.arange(len(points)), np.ones(len(points), bool))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out))


class Forest:
    """Roots of nodes joined so far; the smallest index of a group is its root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up


def link(points: np.ndarray, queries: np.ndarray, radius: int, forest: Forest, index: np.ndarray, asked: np.ndarray) -> None:
    """Join every query with every point within ``radius``; ``index`` and ``asked`` are their places in the forest."""
    stack = [(np.arange(len(points)), np.arange(len(queries)), 0)]
    while stack:
        p, q, depth = stack.pop()
        if not len(p) or not len(q):
            continue
        split = _best_split(points[p], radius, depth) if len(p) > LEAF else None
        if split is not None:
            vantage, limit = split
            inside = distance(points[p], vantage) <= limit
            d = distance(queries[q], vantage).astype(np.int64)
            near, far = q[d - radius <= limit], q[d + radius > limit]
            if len(near) + len(far) < 1.9 * len(q):
                stack += [(p[inside], near, depth + 1), (p[~inside], far, depth + 1)]
                continue
        step = max(1, (1 << 21) // len(p))
        for i in range(0, len(q), step):
            part = q[i : i + step]
            hit, at = np.nonzero(distance(queries[part][:, None], points[p][None, :]) <= radius)
            a, b = asked[part[hit]], index[p[at]]
            apart = forest.root[a] != forest.root[b]
            forest.join(a[apart], b[apart])


def _shard(radius: int):
    def go(table: pa.Table) -> pa.Table:
        node, point = table.column("node").to_numpy(), table.column("point").to_numpy().view(np.uint64)
        order = np.argsort(node, kind="stable")
        node, point, home = node[order], point[order], table.column("home").to_numpy()[order]
        forest = Forest(len(node))
        at = np.flatnonzero(home)
        link(point[at], point, radius, forest, at, np.arange(len(node)))
        joined = np.flatnonzero(forest.root != np.arange(len(node)))
        return pa.table({"a": pa.array(node[joined]), "b": pa.array(node[forest.root[joined]])})

    return go


def links(
    nodes: DataFrame, *, radius: int = 2, sample: int = SAMPLE, shard_nodes: int = SHARD_NODES, part_sample: int = PART_SAMPLE, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(a, b) that join all of ``nodes`` (node, point: distinct) that are within ``radius`` of each other, by way of
    others or directly; no pair further apart is joined directly."""
    n = nodes.count()
    rows = nodes.orderBy(F.xxhash64("point"), "point").select("point").limit(sample).collect()
    points = np.array([r.point for r in rows], np.int64).view(np.uint64)
    tree = build(points, max(1, -(-n // shard_nodes)), radius)

    def go(batches):
        for batch in batches:
            point = batch.column("point").to_numpy(zero_copy_only=False)
            shard, at, home = deal(tree, point.view(np.uint64), radius)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(node[at]), pa.array(point[at]), pa.array(home)], ["shard", "node", "point", "home"])

    dealt = cut(nodes.select("node", "point").mapInArrow(go, _DEALT))
    dealt = deal_again(dealt, radius, shard_nodes, part_sample, chunk_rows)
    return dealt.groupBy("shard").applyInArrow(_shard(radius), "a long, b long")


_DEALT = "shard long, node long, point long, home boolean"


def _fit(radius: int, most: int):
    """The tree of a shard's sample, for as many parts as its rows need."""

    def go(table: pa.Table) -> pa.Table:
        points = table.column("point").to_numpy().view(np.uint64)
        rows = table.column("rows")[0].as_py()
        tree = build(points, min(-(-4 * rows // most), len(points) // 8 + 1), radius, 0.05)
        return pa.table({"shard": table.column("shard")[:1], "rows": table.column("rows")[:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    return go


def _deal_chunk(radius: int):
    """Rows of a part of a shard in the shard's own parts; a node that only visits the shard has no home in any."""

    def go(table: pa.Table) -> pa.Table:
        is_tree = pc.is_valid(table.column("tree"))
        tree = pickle.loads(table.filter(is_tree).column("tree")[0].as_py())
        rows = table.filter(pc.invert(is_tree))
        point, home = rows.column("point").to_numpy(), rows.column("home").to_numpy(zero_copy_only=False).astype(bool)
        part, at, lives = deal(tree, point.view(np.uint64), radius)
        # a number for each part that no other part of any shard has, but for one in 2**64 pairs; those would only be one shard
        base = np.uint64(table.column("shard")[0].as_py() & (2**64 - 1))
        shard = mix(mix(np.full(len(part), base)) + part.astype(np.uint64) + np.uint64(1)).view(np.int64)
        return pa.table({"shard": shard, "node": rows.column("node").take(pa.array(at)), "point": point[at], "home": lives & home[at]})

    return go


def deal_again(dealt: DataFrame, radius: int, most: int, part_sample: int = PART_SAMPLE, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Cut shards with more than ``LARGE`` times ``most`` rows in parts, until there are none. Samples, trees and rows stay on the
    executors. A shard without a home has nothing to find and goes. Where fingerprints lie so close that nearly all visit both
    sides of any cut, cutting ends: such a cloud stays together."""
    before = float("inf")
    for _ in range(MOST_LEVELS):
        sizes = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
        large = cut(sizes.filter(F.col("rows") > LARGE * most))
        total = large.agg(F.sum("rows")).first()[0] or 0
        if total == 0 or total > 0.9 * before:
            return dealt
        before = total
        rows = dealt.join(large, "shard")
        first = Window.partitionBy("shard").orderBy(F.xxhash64("point"), "point")
        some = rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= part_sample).select("shard", "point", "rows")
        trees = some.groupBy("shard").applyInArrow(_fit(radius, most), "shard long, rows long, tree binary")
        chunks = F.ceil(F.col("rows") / chunk_rows)
        parts = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks)).withColumn("tree", F.lit(None).cast("binary")).drop("rows")
        trees = trees.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))).drop("rows")
        met = parts.unionByName(trees, allowMissingColumns=True)
        again = met.groupBy("shard", "chunk").applyInArrow(_deal_chunk(radius), _DEALT)
        dealt = cut(dealt.join(large.select("shard"), "shard", "left_anti").unionByName(again))
        homes = dealt.filter("home").select("shard").distinct()
        dealt = dealt.join(homes, "shard", "left_semi")
    return dealt


def duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", radius: int = 2, **sizes: int) -> DataFrame:
    """(key, fingerprint, component): for each row the smallest key that it is linked with."""
    prints = cut(fingerprint(docs.select(F.col(f"`{key}`").cast("long").alias("node"), F.col(f"`{text}`").alias("text")),
                             keep=["node"], name="point"))
    nodes = cut(prints.filter("node is not null").groupBy("point").agg(F.min("node").alias("node")))
    found = components(links(nodes, radius=radius, **sizes)).withColumnRenamed("node", "of")
    classes = cut(nodes.join(found, nodes.node == found.of, "left").select(
        F.col("point").alias("of"), F.coalesce("component", "node").alias("component")))
    # copies may be a third of all rows: both sides are plain exchanges, so adaptive execution splits a hot fingerprint
    return prints.join(classes, prints.point == classes.of, "left").select(
        F.col("node").alias(key), F.col("point").alias("fingerprint"), "component")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", radius: int = 2, **sizes: int) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest key; rows without a key stay.

    Rows that repeat the smallest key are copies too: the one with the smallest text hash stays.
    """
    kept = duplicates(docs, key=key, text=text, radius=radius, **sizes).filter(F.col(key) == F.col("component"))
    ids = cut(kept.select(F.col(key).alias("_id")).distinct())
    names = docs.columns
    row = docs.select(F.col(f"`{key}`").cast("long").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_h"),
                      F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    one = row.filter("_id is not null").join(ids, "_id", "left_semi")
    first = F.row_number().over(Window.partitionBy("_id").orderBy("_h"))
    one = one.withColumn("_n", first).filter("_n = 1")
    return one.select("_row").unionByName(row.filter("_id is null").select("_row")).select("_row.*").toDF(*names)
