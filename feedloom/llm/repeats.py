"""Passages that repeat across documents: winnowed anchors as seeds, extended both ways, cut out of the later documents.

A window is ``size`` consecutive words. Of the runs of ``gram`` words within a window the one with the smallest hash is
its anchor, so equal windows have equal anchors at equal places, and most words are no anchor (winnowing). The
consecutive windows of one anchor are a segment, and its words are the seed extended as far to the left and right as the
anchor reaches; consecutive segments join to maximal repeats.

1. Anchors of all documents are shuffled by hash. Where the whole segment is in an earlier document, all of its words
   are repeats. This settles copies and the inside of shared passages.
2. Where an anchor stands in several contexts, the first document of each context sends the windows of the segment, and
   a window that an earlier document has too is a repeat. This settles the ends of passages exactly.

Both decisions are made on the input, not on what is left. Equality of segments and of windows is tested by hashes of 96
bits of all their words; the anchor's hash only deals segments out. Rows of one slice that repeat a segment of an earlier row in
the slice are settled there, so a hot passage does not reach the shuffle once for every copy.

The segments of an anchor are compared where they meet. Anchors that are found very often in a part of the documents are not
dealt as one: what is known of them and of their contexts is counted in partial aggregates and joined back, split by adaptive
execution. Which way an anchor goes never changes the result.

Null text: no words. A row with a null id neither loses words nor makes others lose them. Rows that share an id are no
earlier than each other. Words of fewer than ``size`` in a text stay. No rows: no rows out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut
from .frames import append, field
from .words import SLICE_BYTES, Words, runs, slices, spans

SIZE, GRAM = 13, 5
_COUNT_BITS = 8  # of a packed segment: its windows; the bits above hold its first word
LOOK, HOT_SEGMENTS = 64, 1_000_000  # one document in LOOK tells which anchors have about so many segments or more
FEW_IDS = 100_000  # repeated ids up to this number are broadcast


@dataclass
class Segments:
    """Segments of a slice of texts: the anchor's hash, two hashes of the whole segment, its text, first window, windows."""

    anchor: np.ndarray
    whole: np.ndarray
    back: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    windows: np.ndarray

    @classmethod
    def of(cls, words: Words, hashes: np.ndarray, size: int, gram: int) -> Segments:
        at = np.flatnonzero(words.left() >= size)
        none = np.zeros(0, np.int64)
        if not len(at):
            return cls(*[none.view(np.uint64)] * 3, none, none, none)
        grams = runs(hashes, gram)
        wide = size - gram + 1
        anchor = at + np.lib.stride_tricks.sliding_window_view(grams, wide)[at].argmin(axis=1)
        row = words.row[at]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        windows = np.diff(np.append(first, len(at)))
        begin, place = at[first], anchor[first]
        end = begin + windows - 1 + size
        whole = spans(hashes, begin, end) + (place - begin).astype(np.uint64)
        back = spans(hashes[::-1], len(hashes) - end, len(hashes) - begin)
        return cls(grams[place], whole, back, row[first], begin - words.first[row[first]], windows)


def _segments(size: int, gram: int, tagged: bool):
    """Rows (a, g, h, id, at) and, where ids repeat, tag of the segments of every text; ``at`` is negative where the segment is
    settled."""

    def go(batches):
        for part in slices(batches, "text"):
            words = Words.of(part.column("text"))
            ids = part.column("id").to_numpy(zero_copy_only=False)
            seg = Segments.of(words, words.hashes(), size, gram)
            own = ids[seg.row]
            back = (seg.back >> np.uint64(32)).astype(np.int64).astype(np.int32)
            # the earliest id of each (anchor, whole, back) in this slice settles the later ones
            order = np.lexsort((own, back, seg.whole, seg.anchor))
            a, g, h, d = seg.anchor[order], seg.whole[order], back[order], own[order]
            head = np.ones(len(order), bool)
            head[1:] = (a[1:] != a[:-1]) | (g[1:] != g[:-1]) | (h[1:] != h[:-1])
            least = d[np.flatnonzero(head)][np.cumsum(head) - 1] if len(d) else d
            gone = np.zeros(len(order), bool)
            gone[order] = d > least
            packed = (seg.begin << _COUNT_BITS) | seg.windows
            yield pa.RecordBatch.from_arrays(
                [
                    # a settled segment is dealt by its own place
                    pa.array(np.where(gone, (own * 1_000_003 + seg.begin).view(np.uint64) if len(own) else seg.anchor, seg.anchor).view(np.int64)),
                    pa.array(seg.whole.view(np.int64)),
                    pa.array(back),
                    pa.array(own),
                    pa.array(packed * np.where(gone, -1, 1)),
                    *([part.column("tag").take(pa.array(seg.row))] if tagged else []),
                ],
                ["a", "g", "h", "id", "at", *(["tag"] if tagged else [])],
            )

    return go


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return at >> _COUNT_BITS, at & ((1 << _COUNT_BITS) - 1)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the values of a list column; a null list has none."""
    length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), length), column.flatten().to_numpy(zero_copy_only=False)


def _windows(size: int):
    """Rows (w, v, id, tag, at) of the windows of the listed segments."""

    def go(batches):
        for part in slices(batches, "text"):
            words = Words.of(part.column("text"))
            hashes = words.hashes()
            row, at = _lists(part.column("open"))
            first, n = _unpack(at.astype(np.int64))
            row = np.repeat(row, n)
            begin = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
            fits = begin + size <= words.count[row] if len(row) else np.zeros(0, bool)
            row, begin = row[fits], begin[fits]
            place = begin + words.first[row]
            key = spans(hashes, place, place + size)
            more = runs(hashes[::-1], size)[::-1][place] if len(place) else place.astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array((more >> np.uint64(32)).astype(np.int64).astype(np.int32)),
                    pa.array(part.column("id").to_numpy(zero_copy_only=False)[row]),
                    pa.array(part.column("tag").to_numpy(zero_copy_only=False)[row]),
                    pa.array(begin),
                ],
                ["w", "v", "id", "tag", "at"],
            )

    return go


def stay(words: Words, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words are left when the word ranges of the texts are cut out."""
    edge = np.zeros(len(words) + 1, np.int64)
    limit = words.count[row] if len(row) else row
    np.add.at(edge, words.first[row] + np.minimum(begin, limit), 1)
    np.add.at(edge, words.first[row] + np.minimum(end, limit), -1)
    return np.cumsum(edge[: len(words)]) == 0


def rest_of(words: Words, left: np.ndarray) -> pa.Array:
    """The texts without the words that are not ``left``, and without the white space behind those.

    All other white space stays. Where a cut takes a line break out of the middle of what is left, one break stays too, so no
    line gets words of another.
    """
    data, offsets = words.data, words.offsets
    gone = np.zeros(len(data) + 1, np.int64)
    row = words.row
    at = np.flatnonzero(~left)
    upto = np.minimum(np.append(words.start[1:], len(data)), offsets[row + 1]) if len(row) else words.end  # white space behind a word goes with it
    np.add.at(gone, words.start[at], 1)
    np.add.at(gone, upto[at], -1)
    kept = np.cumsum(gone[:-1]) == 0
    head = at[(at == 0) | left[at - 1] | (row[at] != row[at - 1])] if len(at) else at
    tail = at[np.append((np.diff(at) > 1) | (row[at[1:]] != row[at[:-1]]), True)] if len(at) else at
    breaks = np.append(np.flatnonzero(data == 10), len(data))
    begin, end = words.start[head], upto[tail]
    first = breaks[np.searchsorted(breaks, begin)]
    inner = (begin > offsets[row[head]]) & (end < offsets[row[head] + 1])
    inner &= (first < end) & (data[np.maximum(begin - 1, 0)] != 10)
    kept[first[inner]] = True
    place = np.append(0, np.cumsum(kept))[offsets]
    out = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(place.astype(np.int64)), pa.py_buffer(data[kept].tobytes()))
    return out.cast(pa.string())


def cut_words(words: Words, left: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(words removed from each text, what is left joined by single spaces)."""
    size = len(words)
    kept = np.flatnonzero(left)
    length = words.end[kept] - words.start[kept] + 1
    upto = np.cumsum(length)
    per = np.add.reduceat(np.append(left, False).astype(np.int64), np.minimum(words.first[:-1], size)) * (words.count > 0) if size else words.count
    if not len(kept):
        return words.count - per, pa.array([""] * len(words.count), pa.string())
    place = np.arange(upto[-1]) + np.repeat(words.start[kept] - (upto - length), length)
    joined = words.data[np.minimum(place, len(words.data) - 1)]
    joined[upto - 1] = 32
    ends = np.append(0, upto)[np.cumsum(per)]
    raw = joined.tobytes()
    starts = np.append(0, ends[:-1])
    out = [raw[a : b - 1] if b > a else b"" for a, b in zip(starts.tolist(), ends.tolist())]
    return words.count - per, pa.array(out, pa.binary()).cast(pa.string())


def _cut(size: int, rest: bool):
    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        words = Words.of(batch.column(0))
        row, at = _lists(batch.column("full"))
        begin, n = _unpack(np.abs(at.astype(np.int64)))
        row2, at2 = _lists(batch.column("ends"))
        at2 = at2.astype(np.int64)
        left = stay(
            words, np.concatenate([row, row2]), np.concatenate([begin, at2]), np.concatenate([begin + n - 1 + size, at2 + size]))
        removed, kept = cut_words(words, left)
        out = {"n_words": pa.array(words.count.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "kept": kept}
        return out | ({"rest": rest_of(words, left)} if rest else {})

    return fn


def _tagged(wide: DataFrame) -> tuple[DataFrame, bool]:
    """``wide`` with ``tag``, which tells rows of one id apart: the hash of the text where the id repeats, else 0; and whether
    any id does."""
    again = cut(wide.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"))
    many = again.count()
    if many == 0:
        return wide.withColumn("tag", F.lit(0).cast("long")), False
    again = again.withColumn("tag", F.lit(True))
    met = wide.join(F.broadcast(again) if many <= FEW_IDS else again, "id", "left")
    return met.withColumn("tag", F.when(F.col("tag"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))), True


def _with_tag(seg: DataFrame) -> DataFrame:
    """Where no id repeats the tag is not sent along, but added where it is needed."""
    return seg if "tag" in seg.columns else seg.withColumn("tag", F.lit(0).cast("long"))


def _known(seg: DataFrame) -> DataFrame:
    """What is known of each segment's anchor and context, by windows: the segments of an anchor meet in one task."""
    seg = _with_tag(seg.repartition("a"))
    anchor, context = Window.partitionBy("a"), Window.partitionBy("a", "g", "h")
    low, high = lambda c, w: F.min(c).over(w), lambda c, w: F.max(c).over(w)
    return seg.select(
        "id", "tag", "at", low("id", context).alias("first"), low("id", anchor).alias("low"), high("id", anchor).alias("high"),
        ((low("g", anchor) < high("g", anchor)) | (low("h", anchor) < high("h", anchor))).alias("several"))


def _known_by_count(seg: DataFrame) -> DataFrame:
    """The same by partial aggregates, for anchors with very many segments."""
    seg = cut(_with_tag(seg))
    least = lambda c: [F.min(c).alias(f"{c}0"), F.max(c).alias(f"{c}1")]
    contexts = cut(seg.groupBy("a", "g", "h").agg(F.min("id").alias("first"), F.max("id").alias("last")))
    anchors = contexts.groupBy("a").agg(F.min("first").alias("low"), F.max("last").alias("high"), *least("g"), *least("h"))
    anchors = cut(anchors.select("a", "low", "high", ((F.col("g0") < F.col("g1")) | (F.col("h0") < F.col("h1"))).alias("several")))
    # both sides are written tables, so a hot key of the left side is split at run time
    met = seg.join(contexts.drop("last"), ["a", "g", "h"]).join(anchors, "a")
    return met.select("id", "tag", "at", "first", "low", "high", "several")


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, look: int = LOOK, hot_segments: int = HOT_SEGMENTS,
    rest: bool = False,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``: the words not covered by a window that also starts in a
    document with a smaller id, joined by one space. Texts are shuffled once, by id.

    ``gram`` decides only how many anchors there are (about 2 in ``size - gram + 2`` words), ``look`` and ``hot_segments`` only
    which of them are counted apart; none changes the result. With ``rest`` there is also a column of that name: the text
    without the removed words, its other white space as it was.
    """
    if not 1 <= gram <= size:
        raise ValueError("gram must be between 1 and size")
    made = ["n_words", "n_removed", "kept", *(["rest"] if rest else [])]
    names = [c for c in docs.columns if c not in made]
    wide, tagged = _tagged(docs.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"),
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names) if c not in (key, text)]))
    own = wide.select("id", "tag", "text").filter("id is not null")
    segments = lambda rows: rows.mapInArrow(
        _segments(size, gram, tagged), "a long, g long, h int, id long, at long" + (", tag long" if tagged else ""))
    some = segments(own.filter(F.pmod(F.xxhash64("id", "tag"), F.lit(look)) == 0)).groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    hot = cut(some.filter(F.col("n") * look >= hot_segments).select("a"))  # at most one in ``hot_segments`` of all segments
    seg = segments(own)
    if hot.isEmpty():
        seg = _known(seg)
    else:
        hot = F.broadcast(hot)
        seg = _known(seg.join(hot, "a", "left_anti")).unionByName(_known_by_count(seg.join(hot, "a", "left_semi")))
    settled = (F.col("at") < 0) | (F.col("id") > F.col("first"))
    unsure = (F.col("low") < F.col("high")) & F.col("several")
    pick = lambda c: F.collect_list(F.when(c, F.col("at")))
    marks = seg.filter(settled | unsure).groupBy("id", "tag").agg(pick(settled).alias("full"), pick(~settled).alias("open"))
    ends = own.join(marks.filter(F.size("open") > 0).select("id", "tag", "open"), ["id", "tag"]).mapInArrow(
        _windows(size), "w long, v int, id long, tag long, at long")
    first = ends.groupBy("w", "v").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last")
    late = ends.join(first, ["w", "v"]).filter("id > first").groupBy("id", "tag").agg(F.collect_list("at").alias("ends"))
    # the same rows as ``own``, so that one shuffle of the texts serves both joins
    named = wide.filter("id is not null").select("id", "tag", "text", *[c for c in wide.columns if c not in ("id", "tag", "text")])
    found = named.join(marks.select("id", "tag", "full"), ["id", "tag"], "left").join(late, ["id", "tag"], "left")
    found = found.unionByName(wide.filter("id is null"), allowMissingColumns=True)
    none: Column = F.array().cast("array<long>")
    found = found.withColumn("full", F.coalesce("full", none)).withColumn("ends", F.coalesce("ends", none))
    kinds = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept": T.StringType(), "rest": T.StringType()}
    done = append(
        found, _cut(size, rest), [field(m, kinds[m]) for m in made],
        keep=[c for c in found.columns if c not in ("tag", "full", "ends")], uses=["full", "ends"], most=SLICE_BYTES)
    back = {key: "id", text: "text"} | {c: f"k{i}" for i, c in enumerate(names) if c not in (key, text)}
    return done.select(*[F.col(back[c]).alias(c) for c in names], *made)
