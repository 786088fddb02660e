"""JSON files that hold one array each, read by many tasks whatever their size.

Spark reads such a file as text that it cuts at every closing brace, so even a file of one line is dealt in ranges, through
whatever store Spark can open. Where an object begins and ends depends on what stands before it, so ranges of files that have
more than one are looked at twice:

1. Summaries. Of each range: its quotes, and for both cases of beginning inside or outside of a string how much deeper it ends
   and what opens at which depth. That is one row for a range; running sums over the ranges of a file tell in which case,
   how deep and after how many objects each of them begins, and whether the file is whole.
2. Objects. Those that lie in one range come out as they are. Of an object that reaches over ranges each gives a piece, and only
   the pieces are shuffled and joined.

An object has the number that it has in its file. A file that is one object is an array of one, and lines of objects are read
as well. Items that are no objects are left out. A file that breaks off, or whose brackets do not fit, has no objects at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|["{}\[\]]', re.S)
_REST = re.compile(rb'(?:[^"\\]|\\.)*"', re.S)  # the rest of a string
_QUOTE = re.compile(rb'\\.|"', re.S)
_SCALARS = re.compile(rb"[\s,0-9eE+.\-truefalsn]*")  # what may stand between brackets and strings, beside colons
_OPEN = {ord("{"): 1, ord("["): 1, ord("}"): -1, ord("]"): -1}

_SUMMARY = (
    "file string, block long, bytes long, quotes long, first string, "
    "cases array<struct<deeper:long,lowest:long,opened:array<struct<level:long,objects:long,last:string>>>>"
)
_OBJECT = "file string, number long, piece long, body binary"


@dataclass
class Brackets:
    """The brackets of a range in order, from inside or outside of a string on."""

    inside: bool
    depth: int = 0
    lowest: int = 0
    opened: dict[int, list] = field(default_factory=dict)  # depth -> [objects that open there, last bracket]

    def read(self, chunk: bytes) -> Iterator[tuple[int, int]]:
        """(bracket, where it stands) of a chunk; the depth is that after the bracket."""
        at = 0
        if self.inside:
            rest = _REST.match(chunk)
            if rest is None:
                return
            self.inside, at = False, rest.end()
        for found in _TOKEN.finditer(chunk, at):
            token = found.group()
            if token[0] == 34:
                self.inside = len(token) == 1  # a string that goes on in the next chunk
                if self.inside:
                    return
                continue
            if _OPEN[token[0]] > 0:
                level = self.opened.setdefault(self.depth, [0, ""])
                level[0] += token == b"{"
                level[1] = token.decode()
            self.depth += _OPEN[token[0]]
            self.lowest = min(self.lowest, self.depth)
            yield token[0], found.start()


def _ranges(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """(the range's columns, its chunks with their closing braces) for each range of a partition, in order."""

    def rows() -> Iterator[tuple[tuple, bytes]]:
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in columns])
            yield from zip(keys, batch.column("chunk").to_pylist())

    from itertools import groupby

    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, (chunk + b"}" for _, chunk in group)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (name, block), chunks in _ranges(batches, ["file", "block"]):
        cases, size, quotes, first = (Brackets(False), Brackets(True)), 0, 0, ""
        for chunk in chunks:
            size += len(chunk)
            quotes += sum(len(q) == 1 for q in _QUOTE.findall(chunk))
            for case in cases:
                for token, _ in case.read(chunk):
                    if not first and case is cases[0]:
                        first = chr(token)
        made = [{"deeper": c.depth, "lowest": c.lowest, "opened": [
            {"level": k, "objects": n, "last": last} for k, (n, last) in c.opened.items()]} for c in cases]
        yield pa.RecordBatch.from_pylist(
            [{"file": name, "block": block, "bytes": size, "quotes": quotes, "first": first, "cases": made}], _ARROW)


_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("bytes", pa.int64()), ("quotes", pa.int64()), ("first", pa.string()),
    ("cases", pa.list_(pa.struct([
        ("deeper", pa.int64()), ("lowest", pa.int64()),
        ("opened", pa.list_(pa.struct([("level", pa.int64()), ("objects", pa.int64()), ("last", pa.string())])))])))])


def _begins(summaries: DataFrame) -> DataFrame:
    """(file, block, start): how each range begins, and whether its file is whole. One row for each range."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    # an object or array at the file's own level: with an array the objects are one level below it
    rows = summaries.withColumn("inside", so_far("quotes") % 2 == 1).withColumn("base", F.when(F.min_by("first", "block").over(whole) == "[", 1).otherwise(0))
    rows = rows.withColumn("case", F.element_at("cases", F.when(F.col("inside"), 2).otherwise(1)))
    rows = rows.withColumn("depth", so_far("case.deeper"))
    rows = rows.withColumn("own", F.get(F.filter("case.opened", lambda x: x["level"] == F.col("base") - F.col("depth")), F.lit(0)))
    rows = rows.withColumns({"number": so_far("own.objects"), "last": F.last("own.last", ignorenulls=True).over(before), "offset": so_far("bytes")})
    deeper, lowest = F.sum("case.deeper").over(whole), F.min(F.col("depth") + F.col("case.lowest")).over(whole)
    # the brace behind the file's last chunk is ours where the file does not end with one
    ours = (F.sum("bytes").over(whole) > F.col("size")).cast("long")
    sound = (F.sum("quotes").over(whole) % 2 == 0) & (deeper == -ours) & (lowest >= -ours)
    return rows.select("file", "block", F.struct("inside", "depth", "base", "number", "offset", (F.coalesce("last", F.lit("")) == "{").alias("object"),
                                                 sound.alias("sound")).alias("start"))


def _objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects of each range: whole ones, and pieces of those that begin or end elsewhere."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds)], ["file", "number", "piece", "body"])

    for (name, block, size, alone, *start), chunks in _ranges(
            batches, ["file", "block", "size", "alone", "inside", "depth", "base", "number", "offset", "object", "sound"]):
        inside, depth, base, number, offset, an_object, sound = start if not alone else (False, 0, None, 0, 0, False, True)
        brackets, rows, held, read = Brackets(inside, depth, depth), [], 0, offset
        parts: list[bytes] | None = [] if an_object and depth > base else None
        begun_here = False
        if parts is not None:
            number -= 1  # the object that is open began in an earlier range
        for chunk in chunks:
            read += len(chunk)
            if not sound:
                continue
            if read > size:
                chunk = chunk[:-1]
            at = 0 if parts is not None else None
            for token, place in brackets.read(chunk):
                if base is None:
                    base = 1 if token == 91 else 0
                if token == 123 and brackets.depth == base + 1:
                    parts, at, begun_here = [], place, True
                elif token == 125 and brackets.depth == base and parts is not None:
                    parts.append(chunk[at : place + 1])
                    rows.append((name, number, None if begun_here else block, b"".join(parts)))
                    held += len(rows[-1][3])
                    number, parts, at = number + 1, None, None
            if parts is not None:
                parts.append(chunk[at:])
            # a file in one range is held back until its end is known to fit
            if not alone and held > 1 << 20:
                yield batch(rows)
                rows, held = [], 0
        if alone and (brackets.inside or brackets.depth or brackets.lowest < 0):
            continue
        if parts is not None and sound and not alone:
            rows.append((name, number, block, b"".join(parts)))
        for i in range(0, len(rows), 1000):
            yield batch(rows[i : i + 1000])


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, body): every object of the arrays in the files at ``path``, as text."""
    meta = F.col("_metadata")
    text = spark.read.text(path, lineSep="}").select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size"),
        (meta["file_block_length"] >= meta["file_size"]).alias("alone"), F.col("value").cast("binary").alias("chunk"))
    parted = text.filter(~F.col("alone"))
    sizes = parted.select("file", "size").distinct()
    rows = parted.select("file", "block", "chunk").mapInArrow(_summaries, _SUMMARY).join(sizes, "file")
    # one row for a range of some hundred MB of the files that have several; its chunks keep their order behind a broadcast
    begins = F.broadcast(_begins(rows))
    found = text.join(begins, ["file", "block"], "left").select("file", "block", "size", "alone", "chunk", "start.*").mapInArrow(_objects, _OBJECT)
    whole = found.filter("piece is null").select("file", "number", "body")
    pieces = found.filter("piece is not null").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("piece", "body"))).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["body"]))
    return whole.unionByName(pieces.select("file", "number", joined.alias("body"))).withColumn("body", F.col("body").cast("string"))
