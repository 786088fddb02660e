"""Many fixed texts looked for in many others at once, each text read once for the patterns it can hold.

Patterns lie in blocks by their order, and a block's patterns become one automaton (goto and failure links), so a text costs its
length and its matches, however many patterns share their pieces. A text goes to the blocks that hold a beginning of one of its
own endings; where all patterns fit one block that is one. A block that many texts go to is worked on in pieces.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .relational import with_position

BLOCK_PATTERNS, PIECE_TEXTS = 20_000, 20_000


def _blocks_of(text: str, starts: list[str], longest: int) -> set[int]:
    """Blocks that a pattern standing in ``text`` can be in; ``starts`` are the blocks' first patterns."""
    out: set[int] = set()
    for i in range(len(text)):
        low, high = bisect_right(starts, text[i]) - 1, bisect_right(starts, text[i : i + longest]) - 1
        if low == high:
            out.add(low)
        else:
            out.update(bisect_right(starts, text[i : i + k]) - 1 for k in range(1, longest + 1))
    return out - {-1}


def automaton(patterns: list[tuple[str, int]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text, number in patterns:
        found.add_word(text, number)
    found.make_automaton()
    return found


def _search(of_patterns: bool):
    """(number, least) of a block: for each pattern the least number of a text that holds it, or the other way round."""

    def go(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("text").to_pylist(), table.column("number").to_pylist(), table.column("pattern").to_pylist()))
        patterns = [(t, n) for t, n, is_pattern in rows if is_pattern]
        least: dict[int, int] = {}
        if patterns:
            found = automaton(patterns)
            for text, number, is_pattern in rows:
                if not is_pattern:
                    for held in {n for _, n in found.iter(text)}:
                        key, value = (held, number) if of_patterns else (number, held)
                        if value < least.get(key, value + 1):
                            least[key] = value
        return pa.table({"number": pa.array(least.keys(), pa.int64()), "least": pa.array(least.values(), pa.int64())})

    return go


def least_containment(
    patterns: DataFrame, texts: DataFrame, *, of: str = "pattern", block_patterns: int = BLOCK_PATTERNS, piece_texts: int = PIECE_TEXTS
) -> DataFrame:
    """(number, least): for each of ``patterns`` the least number of the ``texts`` that hold it, or ``of`` "text" for each
    text the least number of the patterns in it. Both have (text, number), texts distinct; empty ones match nothing. Rows
    without a match are left out.
    """
    patterns, texts = (df.select("text", F.col("number").cast("long").alias("number")).filter(F.length("text") > 0) for df in (patterns, texts))
    placed = cut(with_position(patterns, [F.asc("text")]).withColumn("block", F.floor(F.col("pos") / block_patterns)).drop("pos"))
    blocks = placed.groupBy("block").agg(F.min("text").alias("first"), F.max(F.length("text")).alias("longest")).orderBy("block").collect()
    starts, longest = [b["first"] for b in blocks], max([b["longest"] for b in blocks], default=0)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_blocks_of(t, starts, longest) for t in batch.column("text").to_pylist()]
            at = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text").take(at), batch.column("number").take(at), pa.array([b for f in found for b in f], pa.int64())],
                ["text", "number", "block"])

    if len(blocks) > 1:
        texts = cut(texts.mapInArrow(route, "text string, number long, block long"))
    else:
        texts = texts.withColumn("block", F.lit(0).cast("long"))
    # one row for a block
    pieces = F.broadcast(texts.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / piece_texts).alias("pieces")))
    own = texts.join(pieces, "block").withColumn("piece", F.pmod(F.xxhash64("number", "text"), F.col("pieces")))
    each = placed.join(pieces, "block").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    side = lambda df, is_pattern: df.select("block", "piece", "text", "number", F.lit(is_pattern).alias("pattern"))
    met = side(each, True).unionByName(side(own, False))
    found = met.groupBy("block", "piece").applyInArrow(_search(of == "pattern"), "number long, least long")
    return found.groupBy("number").agg(F.min("least").alias("least"))
