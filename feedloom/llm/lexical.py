"""Ranked search with short lists summed term by term and long lists walked document by document.

1. One pass over the texts keeps, of each document, its length and how often it has each term that some query asks for.
   What all documents share (their number, their total length, documents per term) is counted from that.
2. Each task takes its documents in shards, sorted by key. In a shard a query's short lists are added up in one go into
   accumulators, which from then on are one more list with a known greatest value. That list and the long ones are walked
   side by side over runs of documents: a run is skipped where the lists' greatest values in it cannot reach the k-th best
   score so far; in the others, only documents on a list that is needed to reach it are looked at, the other lists are
   looked up for them, and a document is given up as soon as what is left cannot lift it.
3. The best of each task are merged; a task hands on ``k`` rows for a query at most.

Scores are integers, and a list's greatest value is a true bound, so skipping never changes a result. Queries go through in
blocks of at most ``block_terms`` terms (one query's terms at least), since the terms of a block travel to every task.

Null text: no terms. A row with a null key takes no part, neither in the counts. Rows that repeat a key are documents of their
own. Items with the same id are one query with the terms of all; a null item id takes no part. Equal scores: the smaller key
first. Fewer than ``k`` documents with a score above 0: all of them. No rows: no rows out. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.relational import running_sum
from ..session import cut
from .words import slices, texts

K = 10
SHARD_DOCS, SHARD_POSTINGS = 16_384, 1 << 20
RUN = 512  # documents walked at a time
SHORT = 64  # a list is short if it has at most one posting in so many documents of the shard
BLOCK_TERMS = 100_000
LENGTH_PART = 90  # of 100: how much a document's length counts

_IN_TERM = np.zeros(256, bool)
_IN_TERM[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(text of each term, the terms) of a string column, in order; only A-Z are lower-cased."""
    data, offsets = texts(column)
    inside = _IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1 : len(data)]
    at = np.flatnonzero(start)
    number = np.cumsum(inside)
    begin = number[at] - 1 if len(at) else np.zeros(0, np.int64)
    upto = np.append(begin, number[-1] if len(number) else 0).astype(np.int64)
    packed = np.ascontiguousarray(_LOWER[data[inside]])
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(upto), pa.py_buffer(packed))
    return np.searchsorted(offsets, at, "right") - 1, words


def _count(vocabulary: pa.Array):
    """Rows (key, n, terms, times) of the documents that have a term."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            row, words = terms(part.column("text"))
            n = np.bincount(row, minlength=part.num_rows)
            number = pc.index_in(words, value_set=vocabulary)
            asked = number.is_valid().to_numpy(zero_copy_only=False)
            term = number.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            pairs, times = np.unique(row[asked] * max(len(vocabulary), 1) + term, return_counts=True)
            row, term = np.divmod(pairs, max(len(vocabulary), 1))
            some = np.flatnonzero(n)
            at = np.append(0, np.cumsum(np.bincount(row, minlength=part.num_rows)))
            upto = pa.array(np.append(at[some], at[-1]).astype(np.int32))  # texts without a term have no postings
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(pa.array(some)), pa.array(n[some]),
                    pa.ListArray.from_arrays(upto, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(upto, pa.array(times.astype(np.int32))),
                ],
                ["key", "n", "terms", "times"])

    return go


@dataclass
class Lists:
    """Postings of a shard by term: document (its place in the order of keys) and value; ``begin`` has one entry a term."""

    begin: np.ndarray
    doc: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, term: np.ndarray, doc: np.ndarray, value: np.ndarray, n_terms: int) -> Lists:
        order = np.argsort(term, kind="stable")  # documents stay in order
        return cls(np.searchsorted(term[order], np.arange(n_terms + 1)), doc[order], value[order])

    def __getitem__(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.begin[term], self.begin[term + 1]
        return self.doc[a:b], self.value[a:b]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists added up, term by term, into one list."""
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, place = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
    total = np.zeros(len(doc), np.int64)
    begin = 0
    for d, v in lists:
        total[place[begin : begin + len(d)]] += v  # a document is on a list once
        begin += len(d)
    return doc, total


@dataclass
class Top:
    """The best ``k`` (score, key) so far, best first; equal scores by key."""

    k: int
    score: np.ndarray
    key: np.ndarray

    @property
    def least(self) -> int:
        """A score that a document must reach to be of use."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, key: np.ndarray) -> None:
        score, key = np.append(self.score, score), np.append(self.key, key)
        order = np.lexsort((key, -score))[: self.k]
        self.score, self.key = score[order], key[order]


def walk(lists: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, top: Top, run: int = RUN) -> int:
    """Bring ``top`` up to date with the documents on ``lists``; returns the runs that were not skipped."""
    lists = [x for x in lists if len(x[0])]
    if not lists:
        return 0
    runs = -(-len(keys) // run)
    edges = [np.searchsorted(d, np.arange(runs + 1) * run) for d, _ in lists]
    most = np.zeros((len(lists), runs), np.int64)
    for i, ((_, v), e) in enumerate(zip(lists, edges)):
        some = np.flatnonzero(e[1:] > e[:-1])
        most[i, some] = np.maximum.reduceat(v, e[some])
    total, seen = most.sum(axis=0), 0
    for r in range(runs):
        if total[r] < top.least:
            continue
        seen += 1
        order = np.argsort(most[:, r], kind="stable")
        upto = np.cumsum(most[order, r])
        # lists that together cannot lift a document to the limit need not be walked
        spare = int(np.searchsorted(upto, top.least, "left"))
        score = np.zeros(min(run, len(keys) - r * run), np.int64)
        found = np.zeros(len(score), bool)
        for i in order[spare:]:
            part = slice(edges[i][r], edges[i][r + 1])
            at = lists[i][0][part] - r * run
            score[at] += lists[i][1][part]
            found[at] = True
        at = np.flatnonzero(found)
        score = score[at]
        for j in range(spare - 1, -1, -1):
            alive = score + upto[j] >= top.least
            at, score = at[alive], score[alive]
            i = order[j]
            a, b = edges[i][r], edges[i][r + 1]
            if not len(at):
                break
            if a == b:
                continue
            doc = lists[i][0][a:b]
            place = np.minimum(np.searchsorted(doc, at + r * run), b - a - 1)
            score = score + np.where(doc[place] == at + r * run, lists[i][1][a:b][place], 0)
        alive = score >= top.least
        if alive.any():
            top.add(score[alive], keys[r * run + at[alive]])
    return seen


def _search(queries: list[tuple[int, np.ndarray]], weight: np.ndarray, n_docs: int, total: int, k: int, sizes: tuple[int, int, int, int]):
    shard_docs, shard_postings, run, short = sizes

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        tops = [Top(k, none, none) for _ in queries]

        def shard(parts: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(parts).combine_chunks().sort_by("key")
            keys, n = table.column("key").to_numpy(), table.column("n").to_numpy().astype(np.int64)
            held = table.column("terms").combine_chunks()
            doc = np.repeat(np.arange(len(keys)), held.value_lengths().to_numpy())
            term = held.flatten().to_numpy().astype(np.int64)
            tf = table.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
            m = 100 - LENGTH_PART + (LENGTH_PART * n * n_docs) // total
            lists = Lists.of(term, doc, weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])), len(weight))
            limit = max(len(keys) // short, 1)
            for (_, asked), top in zip(queries, tops):
                mine = [lists[t] for t in asked]
                few = accumulate([x for x in mine if len(x[0]) <= limit])
                walk([few, *[x for x in mine if len(x[0]) > limit]], keys, top, run)

        parts, docs, postings = [], 0, 0
        for batch in batches:
            # a batch is cut so that no shard is larger than told, but for one document
            upto = np.append(0, np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)))
            begin = 0
            while begin < batch.num_rows:
                end = int(np.searchsorted(upto, upto[begin] + shard_postings - postings, "right")) - 1
                end = min(max(end, begin + (not parts)), begin + shard_docs - docs, batch.num_rows)
                if end > begin:
                    parts.append(batch.slice(begin, end - begin))
                    docs, postings, begin = docs + end - begin, postings + int(upto[end] - upto[begin]), end
                if begin < batch.num_rows:
                    shard(parts)
                    parts, docs, postings = [], 0, 0
        if parts:
            shard(parts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([q for q, _ in queries], [len(t.score) for t in tops]).astype(np.int64)),
                pa.array(np.concatenate([t.key for t in tops])), pa.array(np.concatenate([t.score for t in tops])),
            ],
            ["item", "key", "score"])

    return go


def weights(held: dict[int, int], n_terms: int, n_docs: int) -> np.ndarray:
    """The weight of each term, from the documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(n_terms)], np.int64)


def search(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    k: int = K, block_terms: int = BLOCK_TERMS, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS, run: int = RUN, short: int = SHORT,
) -> DataFrame:
    """(item, rank, key, score): the ``k`` best documents of each item. Sizes decide only the work, never the result."""
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")).filter("key is not null")
    told = items.select(F.col(f"`{item}`").cast("long").alias("key"), F.col(f"`{item_text}`").alias("text")).filter("key is not null")

    def asked(batches):
        for part in slices(batches, "text"):
            row, words = terms(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(row)), words.cast(pa.string())], ["item", "term"])

    pairs = told.mapInArrow(asked, "item long, term string").distinct()
    sizes = running_sum(pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n")), [], ["item"], F.col("n"))
    blocks = cut(sizes.select("item", F.floor(F.col("before") / block_terms).alias("block")))
    pairs = cut(pairs.join(blocks, "item"))
    found = []
    for (block,) in sorted(map(tuple, blocks.select("block").distinct().collect())):
        mine: dict[int, list[str]] = {}
        for r in pairs.filter(F.col("block") == block).select("item", "term").collect():  # at most block_terms and one item's terms
            mine.setdefault(r.item, []).append(r.term)
        vocabulary = sorted({t for ts in mine.values() for t in ts})
        number = {t: i for i, t in enumerate(vocabulary)}
        queries = [(q, np.array(sorted(number[t] for t in ts))) for q, ts in sorted(mine.items())]
        counted = cut(plain.mapInArrow(_count(pa.array(vocabulary, pa.large_string())), "key long, n long, terms array<int>, times array<int>"))
        n_docs, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        weight = weights({r.term: r.n for r in held.collect()}, len(vocabulary), n_docs)  # one row for a term of the block
        found.append(counted.mapInArrow(
            _search(queries, weight, n_docs, total, k, (shard_docs, shard_postings, run, short)), "item long, key long, score long"))
    if not found:
        return spark.createDataFrame([], f"`{item}` long, rank int, `{key}` long, score long")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "key")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select(F.col("item").alias(item), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score")
