"""Byte strings that stand in two places, found with a logarithmic family of suffix arrays and cut out of every place.

A string is ``size`` bytes of one text; it is repeated if the same bytes start anywhere else, in the same text or another.
Only suffixes that can have a partner get into a suffix array:

1. Seeds. Of the runs of ``gram`` bytes within a string the smallest hash is its seed, so equal strings have equal seeds.
   Neighbouring strings of one seed are a segment, about 2 of which begin in ``size`` bytes. Segments whose seed is found
   once in the corpus hold nothing that repeats and go no further. Equal segments are folded; they repeat as a whole.
2. Suffix arrays. What is left are seeds with different surroundings. Their segments are dealt by seed, so all strings of a
   seed meet. Each shard is read in batches: a new batch gets its own suffix array (its strings in byte order), which is
   scanned against all arrays that are there for equal strings of full length; then arrays of the same size are merged, so
   that there are only as many as the logarithm of the batches, and a string is merged as often.
3. A seed with more surroundings than a shard holds (a line in a third of all texts, say) is not dealt as one: its strings
   are dealt one by one, by a hash of all their bytes, so that only equal ones meet, in partial counts.

All decisions are made on the input, not on what is left. Segments are told apart by 128 bits of hashes of all their bytes, as
are the strings of step 3; strings in suffix arrays are compared byte by byte.

Null text: empty. Texts shorter than ``size`` lose nothing. Null and repeated keys make no difference, since rows are told
apart by key and text; rows equal in both are two places, so they lose whatever a string covers. Bytes are cut without regard
to characters, hence ``kept`` is binary. No rows: no rows out. Other columns go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut
from .frames import append, field
from .words import mix, slices, spans, texts

SIZE, GRAM = 400, 32
SHARD_SEGMENTS, HOT_SEGMENTS, BATCH_SEGMENTS = 512, 1024, 64
_N_BITS = 10  # of a packed segment: how many strings begin in it; below them a bit for segments that hold a seed twice

_TABLES = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(c)) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def _double(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive bytes, from hashes of runs of half the length."""
    done, width, at = _TABLES[0][data], 1, np.zeros(0, np.uint64)
    base = 0xD6E8FEB86659FD93
    begin = 0  # bytes that ``at`` holds already
    while True:
        step = np.uint64(pow(base, width, 1 << 64))
        if n & width:
            m = max(len(done) - begin, 0)
            at = at[:m] * step + done[begin : begin + m] if begin else done
            begin += width
        if begin == n:
            return mix(at[: max(len(data) - n + 1, 0)])
        done = done[: max(len(done) - width, 0)] * step + done[width:]
        width *= 2


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every ``n`` consecutive values."""
    if len(values) < n:
        return values[:0]
    out, width = values, 1
    while 2 * width <= n:
        out = np.minimum(out[: len(out) - width], out[width:])
        width *= 2
    return np.minimum(out[: len(values) - n + 1], out[n - width :][: len(values) - n + 1])


@dataclass
class Segments:
    """Segments of a slice: seed, two hashes of all bytes, text, first byte in the text, strings, whether a seed is held twice."""

    seed: np.ndarray
    one: np.ndarray
    two: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    strings: np.ndarray
    twice: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, size: int, gram: int) -> Segments:
        data, offsets = texts(column)
        length = np.diff(offsets)
        fits = np.maximum(length - size + 1, 0)
        row = np.repeat(np.arange(len(length)), fits)
        none = np.zeros(0, np.int64)
        if not len(row):
            return cls(*[none.view(np.uint64)] * 3, *[none] * 3, none.astype(bool))
        at = np.arange(len(row)) - np.repeat(np.cumsum(fits) - fits, fits) + offsets[row]
        wide = size - gram + 1
        grams = _double(data, gram)
        seed = _least(grams, wide)[at]
        new = np.ones(len(at), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        strings = np.diff(np.append(first, len(at)))
        begin = at[first]
        # the seed's first place lies behind where the last string begins, unless the segment holds it twice
        twice = np.zeros(len(first), bool)
        view = np.lib.stride_tricks.sliding_window_view(grams, wide)
        for i in range(0, len(first), 1 << 14):
            some = slice(i, i + (1 << 14))
            twice[some] = view[begin[some]].argmin(axis=1) < strings[some] - 1
        parts = -(-strings // wide)  # a run longer than that holds its seed more than once
        of = np.repeat(np.arange(len(first)), parts)
        inner = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * wide
        n = np.minimum(strings[of] - inner, wide)
        begin = begin[of] + inner
        end = begin + n - 1 + size
        hashes = [spans(t[data], begin, end) for t in _TABLES]
        row = row[first[of]]
        return cls(seed[first[of]], *hashes, row, begin - offsets[row], n, twice[of])


def _segments(size: int, gram: int):
    """Rows (a, g, h, id, k, at): the segments of every text."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            seg = Segments.of(part.column("text"), size, gram)
            at = (((seg.begin << _N_BITS) | seg.strings) << 1) | seg.twice
            rows = pa.array(seg.row)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x.view(np.int64)) for x in (seg.seed, seg.one, seg.two)],
                 part.column("id").take(rows), part.column("k").take(rows), pa.array(at)],
                ["a", "g", "h", "id", "k", "at"])

    return go


def _bytes_of(size: int):
    """The listed segments with their bytes, each once for a slice."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = texts(part.column("text"))
            held = part.column("open")
            row = np.repeat(np.arange(part.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
            found = pa.Table.from_struct_array(held.flatten()).combine_chunks()
            at = found.column("at").to_numpy()
            begin = offsets[row] + (at >> (_N_BITS + 1))
            end = begin + ((at >> 1) & ((1 << _N_BITS) - 1)) + size - 1
            _, kept = np.unique(np.stack([found.column(c).to_numpy() for c in "agh"], 1), axis=0, return_index=True) if len(at) else (at, at)
            raw = data.tobytes()
            body = pa.array([raw[b:e] for b, e in zip(begin[kept].tolist(), end[kept].tolist())], pa.binary())
            pick = pa.array(kept)
            rows = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays(
                [found.column(c).combine_chunks().take(pick) for c in ("shard", "alone", "at")]
                + [part.column("id").take(rows), part.column("k").take(rows), body],
                ["shard", "alone", "at", "id", "k", "body"])

    return go


class Family:
    """Suffix arrays of 1, 2, 4, ... batches. A string is kept once; ``again`` tells which have been seen more than once."""

    def __init__(self, strings: int):
        self.levels: list[tuple[np.ndarray, np.ndarray] | None] = []
        self.again = np.zeros(strings, bool)

    def add(self, strings: np.ndarray, number: np.ndarray) -> None:
        """Take in a batch: fixed-width byte strings, and the number of each."""
        order = np.argsort(strings, kind="stable")
        strings, number = strings[order], number[order]
        same = strings[1:] == strings[:-1]
        self.again[number[1:][same]] = self.again[number[:-1][same]] = True
        new = np.append(True, ~same)[: len(strings)]
        # the scan against what is there
        for level in self.levels:
            if level is not None:
                keys, held = level
                at = np.minimum(np.searchsorted(keys, strings), len(keys) - 1)
                hit = keys[at] == strings
                self.again[number[hit]] = self.again[held[at[hit]]] = True
                new &= ~hit
        carry = (strings[new], number[new])
        if not len(carry[0]):
            return
        for i, level in enumerate(self.levels):
            if level is None:
                self.levels[i] = carry
                return
            both = np.concatenate([level[0], carry[0]])
            order = np.argsort(both, kind="stable")  # two sorted runs, so this is a merge
            carry = (both[order], np.concatenate([level[1], carry[1]])[order])
            self.levels[i] = None
        self.levels.append(carry)


def strings_of(bodies: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(all strings of the bodies, how many of each body)."""
    n = np.array([len(b) - size + 1 for b in bodies], np.int64)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    start = np.cumsum(n + size - 1) - (n + size - 1)
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    view = np.lib.stride_tricks.sliding_window_view(data, size)[at]
    return np.ascontiguousarray(view).view(f"S{size}").ravel(), n


def _runs(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, length) of runs of consecutive places."""
    head = np.ones(len(row), bool)
    head[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.flatnonzero(head)
    return row[at], place[at], np.diff(np.append(at, len(row)))


def _shard(size: int, batch: int):
    def go(table: pa.Table) -> pa.Table:
        bodies = table.column("body").to_pylist()
        alone = table.column("alone").to_numpy()
        n = np.array([len(b) - size + 1 for b in bodies], np.int64)
        upto = np.append(0, np.cumsum(n))
        family = Family(int(upto[-1]))
        for i in range(0, len(bodies), batch):
            strings, _ = strings_of(bodies[i : i + batch], size)
            family.add(strings, np.arange(upto[i], upto[min(i + batch, len(bodies))]))
        owner = np.repeat(np.arange(len(bodies)), n)
        hit = np.flatnonzero(family.again & alone[owner])
        row, first, length = _runs(owner[hit], hit - upto[owner[hit]])
        begin = (table.column("at").to_numpy() >> (_N_BITS + 1))[row] + first
        rows = pa.array(row)
        return pa.table({"id": table.column("id").take(rows), "k": table.column("k").take(rows), "mark": pa.array((begin << _N_BITS) | length)})

    return go


def _single(size: int):
    """Rows (w, v, alone, id, k, begin): every string of every segment by hashes of its bytes."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body", 1 << 18):
            data, offsets = texts(part.column("body"))
            n = np.diff(offsets) - size + 1
            row = np.repeat(np.arange(part.num_rows), n)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = offsets[row] + inner
            w, v = (spans(t[data], at, at + size).view(np.int64) for t in _TABLES)
            begin = (part.column("at").to_numpy(zero_copy_only=False) >> (_N_BITS + 1))[row] + inner
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w), pa.array(v), *[part.column(c).take(rows) for c in ("alone", "id", "k")], pa.array(begin)],
                ["w", "v", "alone", "id", "k", "begin"])

    return go


def _cut(size: int):
    spot = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        data, offsets = texts(batch.column(0))
        marks = batch.column("marks")
        row = np.repeat(np.arange(batch.num_rows), marks.value_lengths().to_numpy(zero_copy_only=False))
        mark = marks.flatten().to_numpy(zero_copy_only=False)
        begin = offsets[row] + (mark >> _N_BITS)
        edge = np.zeros(len(data) + 1, np.int64)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + (mark & ((1 << _N_BITS) - 1)) + size - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        left = np.append(0, np.cumsum(~gone))[offsets]
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), batch.num_rows, [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data[~gone].tobytes())])
        at = np.flatnonzero(gone)
        of, first, length = _runs(np.searchsorted(offsets, at, "right") - 1, at)
        first = first - offsets[of]
        runs = pa.StructArray.from_arrays([pa.array(first), pa.array(first + length)], fields=list(spot))
        upto = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
        return {
            "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(np.diff(offsets) - np.diff(left)),
            "spans": pa.ListArray.from_arrays(pa.array(upto), runs), "kept": kept.cast(pa.binary()),
        }

    return fn


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM,
    shard_segments: int = SHARD_SEGMENTS, hot_segments: int = HOT_SEGMENTS, batch_segments: int = BATCH_SEGMENTS,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``spans`` (begin and end of the removed runs, in bytes) and ``kept``: the
    bytes that no repeated string of ``size`` bytes covers. The other parameters decide only the work, never the result.
    """
    if not 1 <= gram <= size < 1 << _N_BITS:
        raise ValueError(f"gram must be between 1 and size, and size below {1 << _N_BITS}")
    made = ("n_bytes", "n_removed", "spans", "kept")
    names = [c for c in docs.columns if c not in made]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    wide = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.xxhash64(F.lit(1), body)).alias("id"), F.xxhash64(body).alias("k"),
        F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names) if c != text])
    seg = wide.select("id", "k", "text").mapInArrow(_segments(size, gram), "a long, g long, h long, id long, k long, at long")
    twice = F.col("at").bitwiseAND(1) == 1
    seeds = seg.groupBy("a").agg(F.count(F.lit(1)).alias("n"), (F.min("g") < F.max("g")).alias("several"), F.max(twice).alias("twice"))
    seeds = cut(seeds.filter("n > 1 or twice").select("a", (F.col("several") | F.col("twice")).alias("several")))
    seg = cut(seg.join(seeds, "a"))
    place = F.struct("id", "k", "at")
    folded = cut(seg.groupBy("a", "g", "h", "several").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")))
    whole = folded.filter("n > 1").select("a", "g", "h")
    strings = F.shiftright("at", 1).bitwiseAND((1 << _N_BITS) - 1)
    begin = F.shiftright("at", _N_BITS + 1)
    marks = seg.join(whole, ["a", "g", "h"]).select("id", "k", (F.shiftleft(begin, _N_BITS) + strings).alias("mark"))

    unsure = folded.filter("several").select("a", "g", "h", (F.col("n") == 1).alias("alone"), "p.*")
    crowd = cut(unsure.groupBy("a").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > hot_segments))
    hot, n = crowd.agg(F.count(F.lit(1)), F.coalesce(F.sum("m"), F.lit(0))).first()
    few = unsure.count() - n
    shards = max(1, -(-few // shard_segments))
    dealt = unsure.join(crowd.select("a", F.lit(True).alias("hot")), "a", "left").withColumn(
        "shard", F.when(F.col("hot"), -1).otherwise(F.pmod(F.xxhash64("a"), F.lit(shards))))
    own = [F.col(c) for c in wide.columns]

    def bodies(some: DataFrame) -> DataFrame:
        listed = some.groupBy("id", "k").agg(F.collect_list(F.struct("a", "g", "h", "shard", "alone", "at")).alias("open"))
        # all columns go along, so that the texts are shuffled once for this and for the last join
        return wide.join(listed, ["id", "k"]).select(*own, "open").mapInArrow(
            _bytes_of(size), "shard long, alone boolean, at long, id long, k long, body binary")

    if few:
        marks = marks.unionByName(bodies(dealt.filter("shard >= 0")).groupBy("shard").applyInArrow(
            _shard(size, batch_segments), "id long, k long, mark long"))
    if hot:
        single = bodies(dealt.filter("shard < 0")).mapInArrow(_single(size), "w long, v long, alone boolean, id long, k long, begin long")
        again = single.groupBy("w", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w", "v")
        marks = marks.unionByName(single.filter("alone").join(again, ["w", "v"]).select(
            "id", "k", (F.shiftleft("begin", _N_BITS) + 1).alias("mark")))
    marks = marks.groupBy("id", "k").agg(F.collect_set("mark").alias("marks"))
    found = wide.join(marks, ["id", "k"], "left").withColumn("marks", F.coalesce("marks", F.array().cast("array<long>")))
    spot = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    done = append(
        found, _cut(size),
        [field("n_bytes", T.LongType()), field("n_removed", T.LongType()), field("spans", spot), field("kept", T.BinaryType())],
        keep=["text", *[f"k{i}" for i, c in enumerate(names) if c != text]], uses=["marks"])
    back = {c: "text" if c == text else f"k{i}" for i, c in enumerate(names)}
    return done.select(*[F.col(back[c]).alias(c) for c in names], *made)
