"""Toxicity by a subsequence string-kernel machine with Nystroem landmarks.

The kernel of two units (words, or runs of single characters: "i d i o t") sums over all common subsequences of three
characters, gaps allowed, ``decay`` to the power of their lengths in both; it is normalised. So an insult with characters
put in or left out, or with another ending, is still near the insult. Units are mapped to their kernels with some
landmark units, whitened (Nystroem), and a linear support vector machine is trained on labelled sentences: of a toxic
text the sentence with the most telling unit, of clean texts all sentences; a sentence stands for its highest unit.
Telling units are chosen anew after each round. A text's margin is its highest unit's, at least the margin of a unit
that shares nothing; a logistic curve makes it a score.

The machine is linear in the kernel, and the kernel is a sum over subsequences, so a trained machine is a table with one
weight for each subsequence of the landmarks; scoring looks up the subsequences of each distinct unit of whole texts.

Training takes at most ``sample`` toxic and as many clean rows of the labels outside the held-out fold, those with the
smallest hash of the id. Null and empty texts get the lowest score. Null labels are left out. Without a toxic or without
a clean row all scores are 0. Rows with a null id are scored and count as not held out. Units of more than 24 characters
are scored in overlapping parts of 24. No rows: no rows out.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .frames import append, field
from .words import Words

SAMPLE, DECAY, LANDMARKS, COMMON = 2000, 0.5, 64, 16
LONG, STRIDE = 24, 8
_TRIM = np.zeros(256, bool)
_TRIM[list(b".,;:!?()[]{}\"'#*$%&|<>")] = True


def units(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(text of each unit, units): lower-cased words without signs at their ends, and runs of three and more words of
    one character."""
    column = column.fill_null("").cast(pa.large_string())
    words = Words.of(pc.utf8_lower(column))
    data, start, end = words.data, words.start.copy(), words.end.copy()
    if not len(words):
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    while len(more := np.flatnonzero((start < end) & _TRIM[data[np.minimum(start, len(data) - 1)]])):
        start[more] += 1
    while len(more := np.flatnonzero((start < end) & _TRIM[data[np.maximum(end - 1, 0)]])):
        end[more] -= 1
    point = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=point[1:])
    length, row = point[end] - point[start], words.row
    one = length == 1
    head = one & ~np.append(False, one[:-1] & (row[1:] == row[:-1]))
    tail = one & ~np.append(one[1:] & (row[1:] == row[:-1]), False)
    first, last = np.flatnonzero(head), np.flatnonzero(tail)
    run = last - first >= 2
    first, last = first[run], last[run]
    kept = length >= 3
    begin, upto = np.concatenate([start[kept], start[first]]), np.concatenate([end[kept], end[last]])
    row = np.concatenate([row[kept], row[first]])
    size = upto - begin
    total = np.append(0, np.cumsum(size))
    place = np.arange(total[-1]) + np.repeat(begin - total[:-1], size)
    raw = pa.py_buffer(np.ascontiguousarray(data[place]))
    return row, pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(total.astype(np.int64)), raw)


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triples(n: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """(places, weight) of all subsequences of three of ``n`` characters."""
    if (n, decay) not in _TRIPLES:
        at = np.array(list(combinations(range(n), 3)), np.int64)
        _TRIPLES[n, decay] = at, decay ** (at[:, 2] - at[:, 0] + 1.0)
    return _TRIPLES[n, decay]


def subsequences(unit: str, decay: float = DECAY) -> dict[str, float]:
    """The weight of each subsequence of three characters, summed over the ways it occurs."""
    out: dict[str, float] = defaultdict(float)
    if len(unit) >= 3:
        for (i, j, k), w in zip(*_triples(len(unit), decay)):
            out[unit[i] + unit[j] + unit[k]] += float(w)
    return out


def _parts(unit: str) -> list[str]:
    if len(unit) <= LONG:
        return [unit]
    return [unit[i : i + LONG] for i in range(0, len(unit) - LONG + STRIDE, STRIDE)]


@dataclass(frozen=True)
class Tables:
    """Weights of subsequences, one column for each function of a unit."""

    letters: np.ndarray  # code points, ordered
    weights: np.ndarray  # ((letters + 1) ** 3, columns)
    decay: float

    @classmethod
    def of(cls, columns: list[dict[str, float]], decay: float) -> Tables:
        letters = sorted({ord(c) for col in columns for s in col for c in s})
        number, n = {c: i + 1 for i, c in enumerate(letters)}, len(letters) + 1
        weights = np.zeros((n**3, len(columns)), np.float32)
        for j, col in enumerate(columns):
            for s, w in col.items():
                a, b, c = (number[ord(x)] for x in s)
                weights[(a * n + b) * n + c, j] += w
        return cls(np.array(letters, np.uint32), weights, decay)

    def __call__(self, found: list[str]) -> np.ndarray:
        """(units, columns): each column's weights over the unit's subsequences, divided by the norm of the unit."""
        out = np.zeros((len(found), self.weights.shape[1]), np.float32)
        by_length: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for i, unit in enumerate(found):
            for part in _parts(unit):
                if len(part) >= 3:
                    by_length[len(part)].append((i, part))
        n = len(self.letters) + 1
        for length, group in by_length.items():
            at, weight = _triples(length, self.decay)
            step = max(1, 200_000 // len(at))
            for b in range(0, len(group), step):
                part = group[b : b + step]
                points = np.array([u for _, u in part], f"U{length}").view(np.uint32).reshape(len(part), length)
                spot = np.minimum(np.searchsorted(self.letters, points), max(len(self.letters) - 1, 0))
                code = np.where(self.letters[spot] == points, spot + 1, 0) if len(self.letters) else np.zeros_like(spot)
                key = (code[:, at[:, 0]] * n + code[:, at[:, 1]]) * n + code[:, at[:, 2]]
                if self.weights.shape[1] == 1:
                    total = (self.weights[key, 0] @ weight.astype(np.float32))[:, None]
                else:
                    total = np.einsum("ut,utc->uc", np.broadcast_to(weight.astype(np.float32), key.shape), self.weights[key])
                used = np.flatnonzero(np.any(total != 0, axis=1) if self.weights.shape[1] > 1 else total[:, 0] > 0)
                if len(used):
                    value = total[used] / _norms(points[used], at, weight)[:, None]
                    np.maximum.at(out, np.array([part[u][0] for u in used]), value)
        return out


def _norms(points: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Square roots of the kernels of units of one length with themselves."""
    letter = np.unique(points, return_inverse=True)[1].reshape(points.shape).astype(np.int64)
    n = int(letter.max()) + 1
    key = (letter[:, at[:, 0]] * n + letter[:, at[:, 1]]) * n + letter[:, at[:, 2]]
    order = np.argsort(key, axis=1)
    key = np.take_along_axis(key, order, axis=1)
    w = weight[order].ravel()
    new = np.ones(key.shape, bool)
    new[:, 1:] = key[:, 1:] != key[:, :-1]
    first = np.flatnonzero(new.ravel())
    total = np.add.reduceat(w, first) ** 2
    unit = first // key.shape[1]
    return np.sqrt(np.bincount(unit, weights=total, minlength=len(points)))


def kernel_columns(landmarks: list[str], decay: float) -> list[dict[str, float]]:
    out = []
    for mark in landmarks:
        weights = subsequences(mark, decay)
        norm = sum(w * w for w in weights.values()) ** 0.5
        out.append({s: w / norm for s, w in weights.items()})
    return out


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> np.ndarray:
    """Weights and offset of a linear machine with squared hinge loss, by Newton steps on the active rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    v, keep = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge * weight.sum()
    keep[-1, -1] = 1e-9
    for _ in range(rounds):
        on = y * (x @ v) < 1
        a = x[on] * weight[on, None]
        new = np.linalg.solve(keep + a.T @ x[on], a.T @ y[on])
        if np.allclose(new, v, atol=1e-9):
            break
        v = new
    return v


def _curve(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to labels, with Platt's softened targets."""
    pos, neg = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (pos + 1) / (pos + 2), 1 / (neg + 2))
    ab = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -50, 50)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(2) * 1e-6
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-6 * ab)
        ab = ab + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])


@dataclass(frozen=True)
class Model:
    table: Tables | None
    offset: float = 0.0
    slope: float = 0.0
    shift: float = 0.0

    def margins(self, column: pa.Array) -> np.ndarray:
        row, found = units(column)
        out = np.zeros(len(column))
        if len(found):
            coded = found.dictionary_encode()
            value = self.table(coded.dictionary.to_pylist())[:, 0]
            np.maximum.at(out, row, value[coded.indices.to_numpy()])
        return out + self.offset

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.table is None:
            return np.zeros(len(column))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(column) + self.shift, -50, 50)))


def fit_texts(texts: list[str], toxic: np.ndarray, *, decay: float = DECAY, landmarks: int = LANDMARKS, common: int = COMMON, rounds: int = 3) -> Model:
    """The machine for labelled texts."""
    if not len(texts) or toxic.all() or not toxic.any():
        return Model(None)
    sentences, owner = [], []
    for i, text in enumerate(texts):
        for s in re.split(r"[.!?\n]+", text):
            if s.strip():
                sentences.append(s)
                owner.append(i)
    owner = np.array(owner, np.int64)
    row, found = units(pa.array(sentences, pa.large_string()))
    coded = found.dictionary_encode()
    names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    text_of = owner[row]
    pairs = np.unique(np.stack([text_of, code]), axis=1)
    bad = np.bincount(pairs[1], weights=toxic[pairs[0]], minlength=len(names))
    good = np.bincount(pairs[1], weights=~toxic[pairs[0]], minlength=len(names))
    odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
    # landmarks: telling units that are not alike, and common clean ones
    chosen: list[str] = []
    near = np.zeros(0)
    for u in np.lexsort((np.arange(len(names)), -odds * np.sqrt(bad)))[: 40 * landmarks]:
        unit = names[u]
        if bad[u] < 2 or odds[u] <= 0 or len(unit) > LONG:
            continue
        if chosen:
            near = Tables.of(kernel_columns(chosen, decay), decay)([unit])[0]
            if near.max() > 0.8:
                continue
        chosen.append(unit)
        if len(chosen) >= landmarks - common:
            break
    chosen += [names[u] for u in np.argsort(-good, kind="stable") if len(names[u]) <= LONG and names[u] not in chosen][: landmarks - len(chosen)]
    chosen = [c for c in chosen if len(c) >= 3]
    if not chosen:
        return Model(None)
    columns = kernel_columns(chosen, decay)
    kernels = Tables.of(columns, decay)
    own = kernels(chosen).astype(float)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    firm = values > 0.02 * values.max()  # directions that landmarks nearly share are left out
    half = vectors[:, firm] / np.sqrt(values[firm])
    # a sentence stands for its highest unit; a toxic text for its highest sentence, by a unit that toxic texts favour
    favoured = odds > np.log(2)
    telling = np.flatnonzero((bad >= 5) & (odds > 3))  # also where a text has a still higher one
    value = odds
    negative: set[int] = set(np.argsort(-good, kind="stable")[:2000].tolist())
    table, offset = None, 0.0
    for _ in range(rounds):
        order = np.argsort(value[code], kind="stable")
        able = order[favoured[code[order]]]
        best = np.full(len(texts), -1, np.int64)
        best[text_of[able]] = code[able]
        top = np.full(len(sentences), -1, np.int64)
        top[row[order]] = code[order]
        highest = np.unique(top[~toxic[owner] & (top >= 0)])
        highest = highest[np.argsort(-value[highest], kind="stable")]
        negative |= set(highest[: 2 * len(texts)].tolist())
        pos = np.concatenate([best[toxic & (best >= 0)], np.repeat(telling, bad[telling].astype(np.int64))])
        if not len(pos):
            return Model(None)
        neg = np.array(sorted(negative))
        x = np.vstack([kernels([names[u] for u in part]) for part in (pos, neg)]).astype(float) @ half
        y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
        often = np.sqrt(good[neg] + 1)
        v = _machine(x, y, np.concatenate([np.ones(len(pos)), often * len(pos) / often.sum()]))
        merged: dict[str, float] = Counter()
        for w, col in zip(half @ v[:-1], columns):
            for s, z in col.items():
                merged[s] += w * z
        table, offset = Tables.of([dict(merged)], decay), float(v[-1])
        value = table(names)[:, 0].astype(float)
    model = Model(table, offset)
    margins = np.concatenate([model.margins(pa.array(texts[i : i + 200], pa.large_string())) for i in range(0, len(texts), 200)])
    return Model(model.table, model.offset, *_curve(margins, toxic))


def held_out(key: Column) -> Column:
    """Whether a row is in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, **how) -> Model:
    """Trained on at most ``sample`` rows of each label; their ids are few, so only their texts are read from ``docs``."""
    known = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.filter(~held_out(F.col("k")) & F.col("k").isNotNull() & F.col("y").isin(0, 1)).groupBy("k").agg(F.max("y").alias("y"))
    few = lambda y: known.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(sample)
    ids = F.broadcast(few(1).unionByName(few(0)))  # 2 * sample rows at most
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).join(ids, "k").filter("t is not null")
    got = sorted((r.k, r.t, r.y) for r in rows.groupBy("k", "y").agg(F.min("t").alias("t")).collect())
    return fit_texts([t for _, t, _ in got], np.array([y == 1 for _, _, y in got], bool), **how)


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # as large as the landmarks' subsequences

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"score": pa.array(held.value.scores(batch.column(0)))}

    names = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    done = append(docs, fn, [field("score", T.DoubleType())], text=text, keep=names)
    return done.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
