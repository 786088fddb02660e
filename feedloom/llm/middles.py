"""Fill-in-the-middle: texts cut in prefix, middle and suffix at unit borders and put together in another order.

A unit is a run of A-Z and a-z, or any other single code point. Every text is taken as blocks of ``BLOCK`` bytes, and a
Fenwick tree over the blocks holds how many units and how many code points begin in each. To find the border after ``c``
units, a descent by halving steps walks the tree to the block where unit ``c`` begins, adding up the code points it passes;
only that block is then looked at byte by byte. All texts of a slice are walked at once, so the work follows their bytes.

The two cuts and the form come from a hash of the row's key, so a retried task and another partitioning give the same.

Null text: empty. Empty texts and texts that hold one of the marks stay plain. A null key is hashed as an empty one. Rows
that repeat a key are cut by the same numbers, each for its own text. No rows: no rows out. Other columns go on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .frames import append, field
from .words import texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 256
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100

_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123))] = True


@dataclass
class Fenwick:
    """Trees over the blocks of several texts: node j of text i is at ``first[i] + j - 1`` (j from 1 on)."""

    first: np.ndarray
    size: np.ndarray
    sums: list[np.ndarray]

    @classmethod
    def of(cls, size: np.ndarray, counts: list[np.ndarray]) -> Fenwick:
        """Each node gets its own count, then adds itself to its parent, lowest nodes first."""
        first = np.cumsum(size) - size
        sums = [c.astype(np.int64) for c in counts]
        inner = np.arange(int(size.sum())) - np.repeat(first, size) + 1
        room = np.repeat(size, size) - inner  # nodes behind this one
        step = 1
        while step < int(size.max(initial=0)):
            at = np.flatnonzero((inner & -inner == step) & (room >= step))
            for s in sums:
                s[at + step] += s[at]  # nodes of one level have different parents
            step *= 2
        return cls(first, size, sums)

    def descend(self, row: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The number of leading blocks of text ``row`` whose first counts add up to ``target`` at most, and the sums of
        all counts over them."""
        at = np.zeros(len(row), np.int64)
        passed = [np.zeros(len(row), np.int64) for _ in self.sums]
        step = 1 << int(self.size.max(initial=0)).bit_length()
        while step:
            to = at + step
            go = np.flatnonzero(to <= self.size[row])
            node = self.first[row[go]] + to[go] - 1
            fits = passed[0][go] + self.sums[0][node] <= target[go]
            go, node = go[fits], node[fits]
            at[go] += step
            for p, s in zip(passed, self.sums):
                p[go] += s[node]
            step //= 2
        return at, passed


@dataclass
class Blocks:
    """Texts with the places where their units and code points begin, and the trees over their blocks."""

    data: np.ndarray
    offsets: np.ndarray
    unit: np.ndarray
    point: np.ndarray
    tree: Fenwick
    block: int

    @classmethod
    def of(cls, column: pa.Array, block: int = BLOCK) -> Blocks:
        data, offsets = texts(column)
        point = (data & 0xC0) != 0x80
        letter = _LETTER[data]
        again = np.zeros(len(data), bool)
        again[1:] = letter[1:] & letter[:-1]
        again[offsets[:-1][offsets[:-1] < len(data)]] = False
        unit = point & ~again
        length = np.diff(offsets)
        size = -(-length // block)
        edges = np.repeat(offsets[:-1], size) + (np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)) * block
        count = (lambda x: np.add.reduceat(x.astype(np.int32), edges)) if len(edges) else (lambda x: np.zeros(0, np.int64))
        return cls(data, offsets, unit, point, Fenwick.of(size, [count(unit), count(point)]), block)

    @property
    def units(self) -> np.ndarray:
        """Units of each text."""
        far = np.full(len(self.tree.size), np.iinfo(np.int64).max)
        return self.tree.descend(np.arange(len(far)), far)[1][0]

    def border(self, row: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, code point) at which the first ``count`` units of text ``row`` end, counted from the text's begin."""
        blocks, (units, points) = self.tree.descend(row, count)
        begin = self.offsets[row] + blocks * self.block
        room = np.minimum(self.offsets[row + 1] - begin, self.block)
        byte, chars = np.minimum(blocks * self.block, np.diff(self.offsets)[row]), points
        local = np.flatnonzero(room > 0)
        step = max(1, (8 << 20) // self.block)
        for i in range(0, len(local), step):
            at = local[i : i + step]
            inner = np.arange(self.block)
            place = np.minimum(begin[at, None] + inner, len(self.data) - 1)
            inside = inner < room[at, None]
            # the border is where the unit after the wanted ones begins
            number = np.cumsum(self.unit[place] & inside, axis=1)
            cut = (number > (count[at] - units[at])[:, None]).argmax(axis=1)
            byte[at] += cut
            chars[at] += (self.point[place] & inside & (inner < cut[:, None])).sum(axis=1)
        return byte, chars


def numbers(key: Column) -> list[Column]:
    """Four numbers below 2 ** 32 that belong to a key."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _cut(block: int):
    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = Blocks.of(batch.column(0), block)
        n = found.units
        form = batch.column("form").to_numpy(zero_copy_only=False)
        at = np.flatnonzero(form != "plain")
        h = [batch.column(c).to_numpy(zero_copy_only=False)[at] % (n[at] + 1) for c in ("h1", "h2")]
        ends = [found.border(at, c) for c in (np.minimum(*h), np.maximum(*h))]
        raw = found.data.tobytes()
        offsets = found.offsets.tolist()
        out: list[bytes] = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
        for i, a, b in zip(at.tolist(), ends[0][0].tolist(), ends[1][0].tolist()):
            t = out[i]
            out[i] = b"".join((p, t[:a], s, t[b:], m, t[a:b]) if form[i] == "psm" else (s, t[b:], p, t[:a], m, t[a:b]))
        chars = [np.zeros(len(n), np.int64) for _ in range(2)]
        chars[0][at], chars[1][at] = ends[0][1], ends[1][1] - ends[0][1]
        plain = form == "plain"
        return {
            "n": pa.array(n), "prefix_chars": pa.array(chars[0], mask=plain), "middle_chars": pa.array(chars[1], mask=plain),
            "output": pa.array(out, pa.binary()).cast(pa.string()),
        }

    return fn


def transform(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` and ``output``.

    Of 100 texts, those from ``plain_from`` on stay plain; of the others ``spm_below`` of 100 put the suffix first.
    ``block`` decides only the work, never the result.
    """
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [c for c in docs.columns if c not in made or c in (key, text)]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    h1, h2, h3, h4 = numbers(F.col(f"`{key}`"))
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | body.contains(m)
    form = F.when((body == "") | marked | (h3 % 100 >= plain_from), "plain").when(h4 % 100 < spm_below, "spm").otherwise("psm")
    wide = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)], body.alias("text"),
                       form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    own = [f"k{i}" for i in range(len(kept))]
    done = append(
        wide, _cut(block),
        [field("n", T.LongType()), field("prefix_chars", T.LongType()), field("middle_chars", T.LongType()), field("output", T.StringType())],
        keep=[*own, "form"], uses=["form", "h1", "h2"])
    return done.select(*[F.col(k).alias(c) for k, c in zip(own, kept) if c not in made], *made)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of. No cut text holds a mark, so the first one found is the one set."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix2, prefix2, middle2 = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(
        form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output)
