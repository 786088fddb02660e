"""Sampled SentencePiece segmentations by forward filtering and backward sampling, and lossless decoding.

A segmentation has probability proportional to the product of its pieces' weights, (2 + rank) ** -alpha with the rank of
the piece in the vocabulary; bytes of a character that is no piece come last. The vocabulary is read, never trained. No
piece crosses the begin of a word (white space in front, then the word) or a line break, so the lattice of a text falls
into those of its words. Forward filtering sums the weights of all ways to each place of a word once for each distinct
word of a slice; backward sampling then draws, from the end to the begin, the last piece, the one before it, and so on, for all
words of many texts at once. The random numbers are a hash of seed, row key, word number and step, so a segmentation
depends on nothing but the row's key and text.

A space is the mark U+2581 in pieces; a U+2581 of the text itself is spelled in bytes, and no piece is added in front,
so decoding gives back exactly the text. Null text: no pieces, decoded as empty. Null ids: null text. Rows that repeat
key and text get the same pieces. Rows with a null key are seeded alike. No rows: no rows out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import append, field
from .words import mix, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA, SEED = 1.0, 0
SPACE = "▁"
SLICE = 1 << 19  # bytes of text whose distinct words get lattices together: about 100 times as much memory
DECODED = 1 << 18  # ids decoded together


@dataclass(frozen=True)
class Vocabulary:
    """Text and kind of every piece: ``ids`` of the plain pieces, ``byte`` the ids of the 256 byte pieces."""

    pieces: tuple[bytes, ...]
    ids: dict[str, int]
    ranks: dict[int, float]
    byte: tuple[int, ...]

    @classmethod
    def read(cls, model: str = MODEL) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        raw, ids, ranks, byte = [], {}, {}, {}
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte[int(piece[1:-1], 16)] = i
                raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                raw.append(piece.replace(SPACE, " ").encode())
                ids[piece] = i
                ranks[i] = -sp.get_score(i)
        if len(byte) != 256:
            raise ValueError("the model has no piece for every byte, so not every text can be spelled")
        if any(SPACE in p.lstrip(SPACE) for p in ids) or any("\n" in p and p != "\n" for p in ids):
            raise ValueError("a piece crosses the begin of a word")
        return cls(tuple(raw), ids, ranks, tuple(byte[b] for b in range(256)))


_HASH = np.uint64(0x9E3779B97F4A7C15)


class Heads:
    """Beginnings of pieces by hash: the piece that a run of characters is, if it is one, and whether pieces go on."""

    BITS = 20

    def __init__(self, vocabulary: Vocabulary, alpha: float):
        heads = sorted({p[:n] for p in vocabulary.ids for n in range(1, len(p) + 1)})
        self.key = np.zeros(len(heads), np.uint64)
        for i, head in enumerate(heads):
            h = 0
            for c in head:
                h = (h * int(_HASH) + ord(c) + 1) % 2**64
            self.key[i] = h
        self.key = mix(self.key)
        if len(np.unique(self.key)) < len(heads):
            raise ValueError("two pieces have one hash")
        self.piece = np.array([vocabulary.ids.get(h, -1) for h in heads], np.int32)
        # two tables by different bits of the hash; what finds no free place in either is looked for in a short list
        self.slots, left = [], np.arange(len(heads))
        for turn in range(2):
            slot = np.full(1 << self.BITS, -1, np.int32)
            at = self._at(self.key[left], turn)
            slot[at[::-1]] = left[::-1]
            self.slots.append(slot)
            left = left[slot[at] != left]
        self.rest = left
        self.longest = max(map(len, heads))
        self.weight = np.zeros(len(vocabulary.pieces))
        for i, rank in vocabulary.ranks.items():
            self.weight[i] = -alpha * math.log(2 + rank)
        self.byte_weight = -alpha * math.log(2 + len(vocabulary.pieces))

    def _at(self, key: np.ndarray, turn: int) -> np.ndarray:
        return ((key >> np.uint64(20 * turn)) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """Index of the head with each hash, -1 where there is none."""
        out = np.full(len(key), -1, np.int64)
        for turn, slot in enumerate(self.slots):
            got = slot[self._at(key, turn)]
            hit = (got >= 0) & (self.key[got] == key)
            out[hit] = got[hit]
        for i in self.rest:
            out[key == self.key[i]] = i
        return out


@dataclass
class Lattices:
    """Filtered lattices of words. A node is a place in a word; an edge is a piece, or a character in bytes (less than
    0: its code point), with the node it begins at and the summed probability of this edge and those before it."""

    end: np.ndarray  # of each word, its last node
    first: np.ndarray  # of each node, its first edge; -1 at the begin of a word
    upto: np.ndarray
    piece: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, words: pa.Array, heads: Heads) -> Lattices:
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        data, _ = texts(words)
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        looked = np.where(code == 32, ord(SPACE), np.where(code == ord(SPACE), 0, code)).astype(np.uint64) + np.uint64(1)
        stop = np.repeat(np.cumsum(length), length)  # of each character, the end of its word
        # edges by the number of characters; a run is followed as long as some piece begins with it
        at, h = np.arange(len(code)), np.zeros(len(code), np.uint64)
        begins, sizes, found, alone = [], [], [], np.zeros(len(code), bool)
        for n in range(1, heads.longest + 1):
            h = h * _HASH + looked[at + n - 1]
            head = heads.find(mix(h))
            on = head >= 0
            at, h, piece = at[on], h[on], heads.piece[head[on]]
            if n == 1:
                alone[at[piece >= 0]] = True
            whole = piece >= 0
            begins.append(at[whole])
            sizes.append(np.full(int(whole.sum()), n))
            found.append(piece[whole].astype(np.int64))
            more = at + n < stop[at]
            at, h = at[more], h[more]
            if not len(at):
                break
        spelled = np.flatnonzero(~alone)
        size_in_bytes = 1 + (code[spelled] > 0x7F) + (code[spelled] > 0x7FF) + (code[spelled] > 0xFFFF)
        begin = np.concatenate([*begins, spelled])
        size = np.concatenate([*sizes, np.ones(len(spelled), np.int64)])
        piece = np.concatenate([*found, -1 - code[spelled]])
        weight = np.concatenate([heads.weight[x] for x in found] + [heads.byte_weight * size_in_bytes])
        # node of (word, place): one more node than characters in each word
        number = np.repeat(np.arange(len(length)), length)
        from_ = begin + number[begin]
        to = from_ + size
        place = begin + size - np.repeat(np.cumsum(length) - length, length)[begin]
        order = np.argsort(to, kind="stable")
        if len(order):
            deep = place[order]
            order = order[np.argsort(deep.astype(np.uint16) if deep.max() < 1 << 16 else deep, kind="stable")]
        from_, to, piece, weight, place = from_[order], to[order], piece[order], weight[order], place[order]
        nodes = len(code) + len(length)
        first = np.full(nodes, -1, np.int64)
        new = np.ones(len(to), bool)
        new[1:] = to[1:] != to[:-1]
        head = np.flatnonzero(new)
        first[to[head]] = head
        forward, upto = np.zeros(nodes), np.zeros(len(to))
        edges = np.searchsorted(place, np.arange(1, (place[-1] if len(place) else 0) + 2))
        groups = np.searchsorted(head, edges)
        for a, b, g0, g1 in zip(edges[:-1], edges[1:], groups[:-1], groups[1:]):
            value = forward[from_[a:b]] + weight[a:b]
            start = head[g0:g1] - a
            many = np.diff(np.append(start, b - a))
            top = np.maximum.reduceat(value, start)
            value = np.exp(value - np.repeat(top, many))
            total = np.add.reduceat(value, start)
            forward[to[head[g0:g1]]] = top + np.log(total)
            run = np.cumsum(value / np.repeat(total, many))
            upto[a:b] = run - np.repeat(run[start] - value[start] / total, many)
            upto[a + start + many - 1] = 2.0  # the last edge takes what rounding leaves
        last = np.cumsum(length) + np.arange(len(length))
        return cls(last, first, upto, piece, from_)


def split(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(words of each text, all words): spaces and what follows up to the next space or line break, or a line break."""
    data, offsets = texts(column)
    begin = np.zeros(len(data) + 1, bool)
    line = data == 10
    begin[:-1] |= line
    begin[1:] |= line
    blank = data == 32
    begin[1:-1] |= blank[1:] & ~blank[:-1]
    begin[offsets] = True
    begin[len(data)] = False
    start = np.flatnonzero(begin)
    at = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
    found = pa.LargeStringArray.from_buffers(len(start), at, pa.py_buffer(np.ascontiguousarray(data)))
    return np.diff(np.searchsorted(start, offsets)), found


def uniform(seed: int, key: np.ndarray, word: np.ndarray, step: int) -> np.ndarray:
    """Reproducible numbers from 0 to 1 for each (key, word) and step."""
    first = mix(key.view(np.uint64) ^ mix(np.array([seed], np.int64).view(np.uint64)))
    x = mix(first + word.astype(np.uint64) * _HASH + np.uint64(step * 0xD1B54A32D192ED03 % 2**64))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def sample(column: pa.Array, keys: np.ndarray, heads: Heads, byte: np.ndarray, seed: int = SEED) -> pa.ListArray:
    """Piece ids of each text."""
    counts, found = split(column)
    coded = found.dictionary_encode()
    lattice = Lattices.of(coded.dictionary, heads)
    row = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    word, key = np.arange(len(row)), keys[row]
    node = lattice.end[coded.indices.to_numpy()] if len(row) else np.zeros(0, np.int64)
    used: list[tuple[np.ndarray, np.ndarray]] = []
    length = np.zeros(len(row), np.int64)
    step = 0
    while len(word):
        u = uniform(seed, key, number, step)
        edge = lattice.first[node]
        late = np.flatnonzero(lattice.upto[edge] <= u)
        while len(late):
            edge[late] += 1
            late = late[lattice.upto[edge[late]] <= u[late]]
        used.append((word, lattice.piece[edge]))
        length[word] += 1
        node = lattice.before[edge]
        more = lattice.first[node] >= 0
        word, key, number, node = word[more], key[more], number[more], node[more]
        step += 1
    last = np.cumsum(length) - 1
    ids = np.zeros(int(length.sum()), np.int64)
    for k, (at, value) in enumerate(used):
        ids[last[at] - k] = value
    per = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.bincount(row, weights=length, minlength=len(counts)).astype(np.int64), out=per[1:])
    spelled = np.flatnonzero(ids < 0)
    if len(spelled):  # characters in bytes
        raw = [chr(-1 - c).encode() for c in ids[spelled].tolist()]
        more = np.ones(len(ids), np.int64)
        more[spelled] = [len(x) for x in raw]
        start = np.append(0, np.cumsum(more))
        wide = np.repeat(ids, more)
        every = np.frombuffer(b"".join(raw), np.uint8)
        wide[np.repeat(ids < 0, more)] = byte[every]
        ids, per = wide, start[per]
    return pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str = MODEL, alpha: float = ALPHA, seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``pieces``, the ids of a sampled segmentation. The driver reads the model; workers get its pieces."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model))  # as large as the model's file
    held: dict[str, Heads] = {}

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if "it" not in held:
            held["it"] = Heads(vocabulary.value, alpha)
        keys = batch.column("_seed").to_numpy(zero_copy_only=False)
        return {"pieces": sample(batch.column(0), keys, held["it"], np.array(vocabulary.value.byte), seed)}

    hashed = docs.withColumn("_seed", F.xxhash64(F.col(f"`{key}`")))
    names = [c for c in (docs.columns if keep is None else keep) if c != "pieces"]
    return append(hashed, fn, [field("pieces", T.ArrayType(T.IntegerType()))], text=text, keep=names, uses=["_seed"], most=SLICE)


def join(ids: pa.Array, pieces: tuple[bytes, ...]) -> pa.Array:
    """The texts that lists of ids spell. Bytes that are no UTF-8 become U+FFFD; ids out of range are an error."""
    table = pa.array(pieces, pa.large_binary())
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    spelled = table.take(ids.flatten())
    length = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)).astype(np.int64)), spelled)
    raw = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
    if ids.null_count:
        raw = pc.if_else(ids.is_valid(), raw, pa.scalar(None, pa.large_binary()))
    try:
        return raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if x is None else x.decode(errors="replace") for x in raw.to_pylist()], pa.string())


def decode(rows: DataFrame, *, pieces: str = "pieces", model: str = MODEL, name: str = "decoded") -> DataFrame:
    """``rows`` with the text that their piece ids spell."""
    table = rows.sparkSession.sparkContext.broadcast(Vocabulary.read(model))
    kept = [c for c in rows.columns if c != name]
    plain = rows.select(F.col(f"`{pieces}`").alias("ids"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    out = T.StructType([*plain.schema.fields[1:], T.StructField("decoded", T.StringType())])

    def go(batches):
        for batch in batches:
            length = batch.column(0).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            upto = np.append(0, np.cumsum(length.astype(np.int64)))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(upto, upto[at] + DECODED, "right")) - 1)
                part = batch.slice(at, min(end, batch.num_rows) - at)
                at += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], join(part.column(0), table.value.pieces)], [f.name for f in out.fields])

    return plain.mapInArrow(go, out).toDF(*kept, name)
