"""Conflict-constrained best-fit packing of documents into sequences of a fixed number of words.

Two pieces conflict when they come from the same source or from the same cluster of duplicates (equal words, with
``near`` linked fingerprints, or a column of the caller's); a bin never holds both.
A text longer than a bin is cut into full bins and a rest; no word is dropped. The rests are dealt to shards of a bounded
number of rows by a hash, so a hot source or a large cluster is spread evenly. A shard packs its rows from the longest
to the shortest: its bins are ordered by residual and carry a bitmap of sources and one of clusters; the search begins at
the tightest bin that has room and goes on to its successors until one has neither bit, else a new bin is opened.

Null text: no words, an empty piece that is packed like others. Null source: conflicts with none. Repeated rows conflict
as duplicates. Ties go by id, piece and a hash of the words. A null id is packed like any other. No rows: no rows out.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut
from . import simhash
from .frames import append, components, field
from .words import Words, slices, spans

CAPACITY = 2048  # words of a bin
SHARD_ROWS = 4096

_OUT = "bin_id long, slot int, offset long, id long, tag long, piece long, first_word long, n_words long"


def measure(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, near: bool = False) -> DataFrame:
    """``docs`` with ``n_words`` and ``cluster``: a hash of the lower-cased words, equal for copies that differ only in
    case (A to Z) or white space, or with ``near`` the fingerprint, equal for these as well."""

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        words = Words.of(batch.column(0))
        if near:
            return {"n_words": pa.array(words.count.astype(np.int64)), "cluster": pa.array(simhash.fingerprints(batch.column(0)).view(np.int64))}
        fold = np.arange(256, dtype=np.uint8)
        fold[65:91] += 32
        words.data = fold[words.data]
        whole = spans(words.hashes(), words.first[:-1], words.first[1:])
        return {"n_words": pa.array(words.count.astype(np.int64)), "cluster": pa.array(whole.view(np.int64))}

    return append(docs, fn, [field("n_words", T.LongType()), field("cluster", T.LongType())], text=text, keep=keep)


def _grouped(sized: DataFrame, radius: int) -> DataFrame:
    """``sized`` with each fingerprint in ``cluster`` replaced by the smallest that it is linked with. Rows without a key
    are grouped like others."""
    sized = cut(sized)
    nodes = cut(sized.select(F.col("cluster").alias("point")).distinct().withColumn("node", F.col("point")))
    found = cut(components(simhash.links(nodes, radius=radius)))
    # plain exchanges on both sides, so adaptive execution splits a hot fingerprint
    named = sized.join(found, sized.cluster == found.node, "left")
    return named.withColumn("cluster", F.coalesce("component", "cluster")).drop("node", "component")


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """(bin, words before it in the bin) of each piece, in the given order."""
    number = {s: i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    several = [c for c, n in Counter(c for c in clusters if c is not None).items() if n > 1]
    member = {c: i for i, c in enumerate(several)}  # a cluster with one row here conflicts with nothing
    residual: list[tuple[int, int]] = []  # (room, bin), ordered
    held: list[list[int]] = []  # of each bin: bitmap of sources, bitmap of clusters
    bins, before = [], []
    for n, source, cluster in zip(lengths, sources, clusters):
        s = 1 << number[source] if source is not None else 0
        c = 1 << member[cluster] if cluster in member else 0
        at = bisect_left(residual, (n, -1))
        while at < len(residual):
            got = held[residual[at][1]]
            if not (got[0] & s or got[1] & c):
                break
            at += 1
        if at < len(residual):
            room, b = residual.pop(at)
            held[b][0] |= s
            held[b][1] |= c
        else:
            room, b = capacity, len(held)
            held.append([s, c])
        insort(residual, (room - n, b))
        bins.append(b)
        before.append(capacity - room)
    return bins, before


def _shard(capacity: int):
    def go(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_words", "descending"), *((c, "ascending") for c in ("id", "piece", "cluster", "source"))])
        rows = {c: table.column(c).to_pylist() for c in ("n_words", "source", "cluster")}
        bins, before = best_fit(rows["n_words"], rows["source"], rows["cluster"], capacity)
        slot, seen = [], Counter()
        for b in bins:
            slot.append(seen[b])
            seen[b] += 1
        first = (table.column("shard")[0].as_py() << 32) + np.array(bins, np.int64)
        return pa.table({
            "bin_id": pa.array(first), "slot": pa.array(slot, pa.int32()), "offset": pa.array(before, pa.int64()),
            **{c: table.column(c) for c in ("id", "tag", "piece", "first_word", "n_words")}})

    return go


def _piece_texts(placed: DataFrame, docs: DataFrame) -> DataFrame:
    """``placed`` with ``words``, the text from the piece's first word to its last. Each text is shuffled once, to its places."""
    place = F.struct(*[c for c in placed.columns if c != "tag"])
    own = lambda df: F.coalesce("id", F.xxhash64(F.lit(1), F.col("tag"))).alias("own")
    places = placed.select(own(placed), "tag", place.alias("p")).groupBy("own", "tag").agg(F.collect_list("p").alias("places"))
    # rows equal in id and text have one list of places
    once = docs.select(own(docs), "tag", "text").dropDuplicates(["own", "tag"])
    kind = places.schema["places"].dataType

    def go(batches):
        for batch in batches:
            for part in slices(iter([batch]), "text"):
                words = Words.of(part.column("text"))
                held = part.column("places")
                row = np.repeat(np.arange(part.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
                table = pa.Table.from_struct_array(held.flatten()).combine_chunks()
                first, n = table.column("first_word").to_numpy(), table.column("n_words").to_numpy()
                raw, at = words.data.tobytes(), words.first[row] + first
                out = [raw[words.start[a] : words.end[a + k - 1]] if k else b"" for a, k in zip(at.tolist(), n.tolist())]
                columns = [table.column(c).combine_chunks() for c in kind.elementType.names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary()).cast(pa.string())], [*kind.elementType.names, "words"])

    out = T.StructType([*kind.elementType.fields, T.StructField("words", T.StringType())])
    return once.join(places, ["own", "tag"]).select("text", "places").mapInArrow(go, out)


def pack(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", cluster: str | None = None,
    near: int | None = None, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, words: bool = False,
) -> DataFrame:
    """(bin_id, slot, offset, key, piece, first_word, n_words): where every piece of every text goes.

    With ``words`` there is also the text of the piece, so a sequence is its bin's ``words`` in the order of ``slot``. ``cluster`` names a column with the duplicate cluster; without it copies of the same words are a cluster, or, with
    ``near``, texts linked by fingerprints that differ in at most so many bits. Texts are only measured, not shuffled, but for
    ``words``.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    if cluster and near is not None:
        raise ValueError("cluster and near exclude each other")
    plain = docs.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").cast("string").alias("source"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("tag"),
        *([F.xxhash64(F.col(f"`{cluster}`")).alias("own")] if cluster else []))
    sized = measure(plain, keep=["id", "source", "tag", *(["own"] if cluster else [])], near=near is not None)
    if cluster:
        sized = sized.withColumn("cluster", F.col("own")).drop("own")
    if near is not None:
        sized = _grouped(sized, near)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n_words") / capacity))
    cutup = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).select(
        "id", "tag", "source", "cluster", F.col("piece").cast("long").alias("piece"), (F.col("piece") * capacity).alias("first_word"),
        F.least(F.lit(capacity), F.col("n_words") - F.col("piece") * capacity).alias("n_words"))
    laid = cut(cutup)
    shards = max(1, -(-laid.count() // shard_rows))
    same = ["id", "piece", "cluster", "source"]
    hot = cut(laid.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows).select(*same))
    spread = F.xxhash64(*same)
    if not hot.isEmpty():  # rows equal in all of these are spread by their place in the written table
        equal = F.lit(True)
        for c in same:
            equal = equal & F.col(f"l.{c}").eqNullSafe(F.col(f"h.{c}"))
        laid = laid.alias("l").join(hot.withColumn("hot", F.lit(True)).alias("h"), equal, "left").select("l.*", "hot")
        spread = F.xxhash64(*same, F.when(F.col("hot"), F.monotonically_increasing_id()))
    dealt = laid.withColumn("shard", F.pmod(spread, F.lit(shards)))
    done = dealt.groupBy("shard").applyInArrow(_shard(capacity), _OUT)
    done = _piece_texts(cut(done), plain.select("id", "tag", "text")) if words else done.drop("tag")
    return done.withColumnRenamed("id", key)
