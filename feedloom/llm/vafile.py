"""Exact best inner products by vector-approximation files.

Vectors are dealt to shards by a hash of their id. A shard keeps an approximation file: for each dimension the range of
its values cut in equal cells, and for each vector the cells it falls in. A query scans the cells first: the middle of a
cell gives the score within a known error, so each vector has a lower and an upper bound. Exact vectors are then read in
the order of their upper bounds (the lower bound of the distance), until no unread one can reach the k-th best score.
The shards' k best are merged. Queries come in blocks of bounded size as well: a task holds one shard and one block.

Components become floor(scale * x), so scores are integers and exact; ties go to the smaller id. Vectors that are null,
or hold a null component or one that is not finite after scaling, take no part, nor do rows with a null id. Where a pair has a component of ``WIDE`` or
more after scaling, its bounds are those of floating point and its exact score is taken in integers of any size; a score that
64 bits do not hold is ranked by its exact value and reported as the nearest long. Of rows that share an id the one with the
smallest vector counts. Only vectors of a query's length are its candidates. No queries or no candidates: no rows out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut

SCALE, CELLS = 256, 16
SHARD_ROWS = 8192
BLOCK_ROWS = 1 << 14  # queries that meet a shard in one task
QUERY_ROWS = 512  # of these, scanned at a time
_READ = 32  # exact vectors read at a time

WIDE = 1 << 26  # products of smaller components add up in 64 bits for up to 2048 dimensions
_BEYOND = 264  # bytes of an exact score that a long does not hold

_OUT = "query_id long, vec_id long, score long, beyond binary"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _is_wide(vectors: np.ndarray) -> np.ndarray:
    """Rows whose products with others 64 bits might not hold."""
    limit = min(WIDE, 2 ** (31 - max(vectors.shape[1] - 1, 0).bit_length() // 2 - 1))
    return (np.abs(vectors) >= limit).any(axis=1) if vectors.size else np.zeros(len(vectors), bool)


def _best_wide(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """As ``ApproximationFile.search`` for components of any size: (index, id, score) with scores as Python integers."""
    if not len(queries) or not len(vectors):
        return
    shift = [int(np.frexp(np.abs(x).max(initial=0))[1]) for x in (queries, vectors)]
    q, v = np.ldexp(queries, -shift[0]), np.ldexp(vectors, -shift[1])
    about = q @ v.T
    # rounding of a sum of products, and of components too small to be held beside the largest
    wide = (np.abs(q) @ np.abs(v).T) * (2 * q.shape[1] + 4) * 2.0**-52 + 2.0**-1000
    for i in range(len(queries)):
        other = np.flatnonzero(ids != own[i])
        if not len(other):
            continue
        low, high = (about[i] - wide[i])[other], (about[i] + wide[i])[other]
        n = min(k, len(other))
        sure = np.partition(low, len(low) - n)[len(low) - n]
        at = other[high >= sure]
        at = at[np.argsort(-(about[i] + wide[i])[at], kind="stable")]
        asked, found = [int(x) for x in queries[i]], []
        for j in at.tolist():
            if len(found) == k and (about[i, j] + wide[i, j]) < about[i, found[-1][2]] - wide[i, found[-1][2]]:
                break
            found.append((-sum(a * int(b) for a, b in zip(asked, vectors[j])), int(ids[j]), j))
            found = sorted(found)[:k]
        yield from ((i, d, -s) for s, d, _ in found)


def _as_long(score: int) -> tuple[int, bytes | None]:
    """(nearest long, bytes in whose order equal longs rank)."""
    near = max(min(score, 2**63 - 1), -(2**63))
    return near, None if abs(score) < 2**63 - 1 else (score + (1 << 8 * _BEYOND - 1)).to_bytes(_BEYOND, "big")


class ApproximationFile:
    """Vectors of one shard with the cells that they fall in."""

    def __init__(self, vectors: np.ndarray, cells: int = CELLS):
        self.vectors = vectors
        self.low = vectors.min(axis=0)
        self.width = (vectors.max(axis=0) - self.low) // cells + 1  # whole numbers, so bounds are exact
        self.cell = ((vectors - self.low) // self.width).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(twice the score at the middle of every vector's cells, twice the largest error) for every query."""
        middle = 2 * (self.low + self.cell.astype(np.int64) * self.width) + (self.width - 1)
        return _dot(queries, middle), np.abs(queries) @ (self.width - 1)

    def search(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int):
        """For each query (index, ids, scores) of the k best vectors whose id is not the query's ``own``."""
        middle, error = self.bounds(queries)
        middle[ids[None, :] == own[:, None]] = np.iinfo(np.int64).min
        for i in range(len(queries)):
            about, wide = middle[i], error[i]
            open_ = about > np.iinfo(np.int64).min
            n = int(open_.sum())
            if n == 0:
                continue
            # the k-th largest lower bound: whoever cannot reach it by its upper bound is out
            sure = np.partition(about[open_], n - min(k, n))[n - min(k, n)] - wide
            at = np.flatnonzero(open_ & (about + wide >= sure))
            at = at[np.lexsort((ids[at], -about[at]))]
            best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for j in range(0, len(at), _READ):
                if len(best) == k and about[at[j]] + wide < 2 * best[-1]:
                    break
                read = at[j : j + _READ]
                best_id = np.concatenate([best_id, ids[read]])
                best = np.concatenate([best, _dot(self.vectors[read], queries[i : i + 1])[:, 0]])
                order = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[order], best[order]
            yield i, best_id, best


def _floor(x):
    """The largest whole number that is not above ``x``, as a double also beyond 64 bits."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact: in floating point only where all sums are below 2**53."""
    if a.shape[1] == 0 or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _shard(k: int, cells: int, query_rows: int):
    def go(table: pa.Table) -> pa.Table:
        asked = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        ids, vectors = table.column("id").to_numpy(), _matrix(table.column("vector"))
        big = _is_wide(vectors)
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]] = []
        pick = lambda some: (ids[some], vectors[some].astype(np.int64))
        (query_ids, queries), (near_ids, near) = pick(asked & ~big), pick(~asked & ~big)
        if len(near_ids) and len(query_ids):
            file = ApproximationFile(near, cells)
            for at in range(0, len(query_ids), query_rows):
                part = slice(at, at + query_rows)
                for i, found, score in file.search(queries[part], query_ids[part], near_ids, k):
                    got.append((np.full(len(found), query_ids[at + i]), found, score, [None] * len(found)))
        for some, others in ((asked & ~big, ~asked & big), (asked & big, ~asked)) if big.any() else ():
            some = np.flatnonzero(some)
            for at in range(0, len(some), query_rows):
                part = some[at : at + query_rows]
                for i, found, score in _best_wide(vectors[part], ids[part], vectors[others], ids[others], k):
                    near_score, beyond = _as_long(score)
                    got.append((ids[part[i : i + 1]], np.array([found]), np.array([near_score]), [beyond]))
        columns = [np.concatenate(x) if got else np.zeros(0, np.int64) for x in (list(zip(*got))[:3] if got else ((), (), ()))]
        beyond = pa.array([b for *_, more in got for b in more], pa.binary())
        return pa.table(dict(zip(["query_id", "vec_id", "score", "beyond"], [*map(pa.array, columns), beyond])))

    return go


def top_k(
    rows: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = SCALE, cells: int = CELLS,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query with the other rows."""

    def whole(df: DataFrame) -> DataFrame:
        cells_ = F.transform(F.col(f"`{vector}`"), lambda x: _floor(scale * x.cast("double")))
        sound = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(scale * x.cast("double")) < float("inf")))
        return once(df.filter(sound & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("id"), cells_.alias("vector")))

    def once(df: DataFrame) -> DataFrame:
        """One row for each id; only rows of ids that repeat are shuffled for it."""
        again = cut(df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"))
        if again.isEmpty():
            return df
        folded = df.join(again, "id", "left_semi").groupBy("id").agg(F.min("vector").alias("vector"))
        return df.join(again, "id", "left_anti").unionByName(folded)

    data, asked = whole(rows), whole(queries)

    def parts(df: DataFrame, name: str, rows_: int) -> DataFrame:
        n = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_)).cast("long")
        return df.groupBy(F.size("vector").alias("length")).agg(n.alias(name))

    # one row for each length of vector that is asked for
    sizes = F.broadcast(parts(data, "shards", shard_rows).join(parts(asked, "blocks", block_rows), "length"))
    data = data.withColumn("length", F.size("vector")).join(sizes, "length")
    asked = asked.withColumn("length", F.size("vector")).join(sizes, "length")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    data = data.withColumn("shard", own("shards")).withColumn("block", each("blocks"))
    asked = asked.withColumn("block", own("blocks")).withColumn("shard", each("shards"))
    side = lambda df, q: df.select("length", "shard", "block", "id", "vector", F.lit(q).alias("asked"))
    met = side(data, False).unionByName(side(asked, True))
    found = met.groupBy("length", "shard", "block").applyInArrow(_shard(k, cells, query_rows), _OUT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
