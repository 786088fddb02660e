"""Frames passed through Arrow functions without touching the caller's columns, and graph components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut
from .words import SLICE_BYTES, slices


def append(
    docs: DataFrame,
    fn: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: Sequence[T.StructField],
    *,
    text: str = "text",
    keep: Sequence[str] | None = None,
    uses: Sequence[str] = (),
    most: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` with the columns that ``fn`` makes of each slice of rows.

    ``fn`` gets a batch with the columns ``text`` and ``uses`` (under these names) and returns an array for each of
    ``fields``. ``keep`` names the columns that go on (all by default). Inside, columns are numbered, so a column of
    any name does no harm; an old column with the name of a new one is replaced.
    """
    made = [f.name for f in fields]
    needed = list(dict.fromkeys([text, *uses]))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    sent = list(dict.fromkeys([*kept, *needed]))
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(sent)])
    place = {c: i for i, c in enumerate(sent)}
    out = T.StructType([T.StructField(f"c{i}", plain.schema[i].dataType) for i in range(len(kept))] + [
        T.StructField(f"n{i}", f.dataType) for i, f in enumerate(fields)])
    names = [f.name for f in out.fields]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, f"c{place[text]}", most):
            new = fn(pa.RecordBatch.from_arrays([part.column(place[c]) for c in needed], needed))
            arrays = [part.column(i) for i in range(len(kept))] + [new[m] for m in made]
            yield pa.RecordBatch.from_arrays(arrays, names)

    done = plain.mapInArrow(go, out)
    return done.toDF(*kept, *made)


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) is connected with.

    Each round hooks every node's larger neighbours to its smallest neighbour, then every node to the smallest of its
    smaller ones, until the edges are stars. Minima are partial aggregates; the links of one node meet in one task when they
    are joined with its minimum, as narrow rows. Rounds grow with the logarithm of the longest path.
    Null ends and loops are left out. No edges: no rows.
    """

    def sign(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def with_least(e: DataFrame) -> DataFrame:
        return e.join(e.groupBy("a").agg(F.min("b").alias("m")), "a")

    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = cut(e.filter("a is not null and b is not null and a > b").distinct())
    last = sign(e)
    for _ in range(most_rounds):
        if last[0] == 0:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = with_least(both).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        near = with_least(large)
        small = near.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(small.unionByName(near.select("a", F.col("m").alias("b"))).distinct())
        now = sign(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components are not settled after {most_rounds} rounds")
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
