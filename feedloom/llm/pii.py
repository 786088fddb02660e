"""Personal data: fixed patterns, and terms that give a protected entity away.

A base entity is an address, number or phone found by a pattern. Its context is the line it stands in. How strongly a
term t reveals an entity e is taken from the whole corpus: with the lines that hold e, t, both, or anything (n_e, n_t,
n_et, N), the information that e carries is log2(N / n_e), and t gives log2(N * n_et / (n_e * n_t)) of it. The share of
the two is the disclosure: 1 when t is found only beside e. In a document that holds e, a term that discloses
``generalise_at`` of it is replaced by its kind (name, code or word), one that discloses ``remove_at`` is removed,
on whichever line it stands there. Terms need ``support`` lines with e; no other limit is set.

All counts cover all lines of all documents. Base spans never depend on the counts. Null text: empty, no spans. A row
with a null id keeps its base spans and takes no part in the counts of pairs, so it has no term spans. Rows that share
an id share their entities' terms. No rows: no rows out. A document without base spans is left exactly as it is.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut
from .frames import append, field
from .words import Words, slices, texts

KINDS = ("email", "ip", "card", "phone", "term")

# The patterns of the base kinds.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

SUPPORT, GENERALISE_AT, REMOVE_AT = 2, 0.8, 0.95
COUNT_BYTES = 1 << 20  # text whose terms are counted together

# The same matches in time that follows the length of the text: an address begins where its run of digits begins, and an
# email with the run of characters in front of an @.
_FOUND = {k: re.compile(p) for k, p in PATTERNS.items()} | {
    "ip": re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")}
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_TERM = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = b".,;:!?()[]{}\"'"
_SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("action", T.StringType())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(x) <= 3 and int(x or "0") <= 255 for x in (p.lstrip("0") for p in found.split(".")))
    digits = "".join(c for c in found if c.isdigit())
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at) if begin < at else None
        if found:
            done = found.end()
            yield begin, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, begin, end) in code points, by kind and then by place."""
    out = [("email", *x) for x in _emails(text)]
    if _DIGIT.search(text) is not None:
        for kind in ("ip", "card", "phone"):
            out += [(kind, *m.span()) for m in _FOUND[kind].finditer(text) if _passes(kind, m.group())]
    return out


def entity(kind: str, found: str) -> str:
    """One name for the ways of writing an entity."""
    return f"{kind}:{found.lower()}" if kind in ("email", "ip") else f"{kind}:{''.join(c for c in found if c.isdigit())}"


def _lower(word: str) -> str:
    return word.encode().lower().decode()  # A to Z only, as in the counts


def terms(text: str, begin: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, begin, end) of the words between ``begin`` and ``end`` that touch no span: A-Z lowered, edges trimmed."""
    edge = _EDGE.decode()
    for m in _TERM.finditer(text, begin, end):
        word = m.group()
        core = word.strip(edge)
        if len(core) < 2:
            continue
        a = m.start() + len(word) - len(word.lstrip(edge))
        b = a + len(core)
        if all(b <= x or a >= y for x, y in taken):
            yield _lower(core), a, b


def _lines_of(text: str, spans: list[tuple[str, int, int]]) -> dict[tuple[int, int], set[str]]:
    """The lines that a span begins in, with the entities there."""
    lines = defaultdict(set)
    for kind, a, b in spans:
        start = text.rfind("\n", 0, a) + 1
        stop = text.find("\n", a)
        lines[start, len(text) if stop < 0 else stop].add(entity(kind, text[a:b]))
    return lines


def term_key(words: list[str]) -> np.ndarray:
    """The key of each term in the counts of all lines."""
    if not words:
        return np.zeros(0, np.int64)
    found = Words.of(pa.array(words, pa.string()))
    return found.hashes().view(np.int64)


def _pairs(batches):
    """(entity, key, id): once for each line; key null: the line itself."""
    for part in slices(batches, "text"):
        who, key, own = [], [], []
        for text, i in zip(part.column("text").to_pylist(), part.column("id").to_pylist()):
            spans = base_spans(text) if text else []
            if not spans:
                continue
            taken = [(a, b) for _, a, b in spans]
            for (start, stop), entities in _lines_of(text, spans).items():
                words = {w for w, _, _ in terms(text, start, stop, taken)}
                keys = set(term_key(sorted(words)).tolist())
                for e in entities:
                    who += [e] * (len(keys) + 1)
                    key += [None, *keys]
                    own += [i] * (len(keys) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.string()), pa.array(key, pa.int64()), pa.array(own, pa.int64())], ["entity", "key", "id"])


_TRIM = np.zeros(256, bool)
_TRIM[list(_EDGE)] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _keyed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text, line) of every term, the lines numbered over all texts."""
    words = Words.of(column)
    data = _FOLD[words.data]
    start, end = words.start.copy(), words.end.copy()
    while len(more := np.flatnonzero((start < end) & _TRIM[data[np.minimum(start, len(data) - 1)]])):
        start[more] += 1
    while len(more := np.flatnonzero((start < end) & _TRIM[data[np.maximum(end - 1, 0)]])):
        end[more] -= 1
    point = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=point[1:])
    long = point[end] - point[start] >= 2
    breaks = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, words.offsets]))
    line = np.searchsorted(breaks, words.start, "right")
    used = Words(data, words.offsets, start[long], end[long], np.zeros(1, np.int64))
    return _cores(used), words.row[long], line[long]


def _once(key: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, by key."""
    order = np.lexsort((of, key))
    key, of = key[order], of[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    return key[new], of[new]


def _counted(batches):
    """(key, n): lines of this slice that hold each term."""
    for part in slices(batches, "text", COUNT_BYTES):
        key, _, line = _keyed(part.column("text"))
        key, n = np.unique(_once(key, line)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _said(batches):
    """(key, id): the terms of each text that holds an entity, on any line."""
    for part in slices(batches, "text"):
        part = part.filter(pa.array([bool(t and base_spans(t)) for t in part.column("text").to_pylist()], pa.bool_()))
        key, row, _ = _keyed(part.column("text"))
        key, row = _once(key, row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(part.column("id").to_numpy(zero_copy_only=False)[row], pa.int64())], ["key", "id"])


def _cores(words: Words) -> np.ndarray:
    """Hashes of trimmed words, equal to those of the trimmed words on their own."""
    if not len(words):
        return np.zeros(0, np.uint64)
    length = words.end - words.start
    upto = np.cumsum(length + 1)
    place = np.arange(upto[-1]) + np.repeat(words.start - (upto - length - 1), length + 1)
    data = words.data[np.minimum(place, len(words.data) - 1)]
    data[upto - 1] = 32
    return Words(data, words.offsets, upto - length - 1, upto - 1, words.first).hashes()


def _lines(docs: DataFrame) -> DataFrame:
    """One row: the number of lines with a word."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.agg(F.sum(F.size(lines)).alias("n"))


def disclosures(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", support: int = SUPPORT, generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
) -> DataFrame:
    """(id, generalise, remove): keys of the terms to mask in each document that holds an entity they disclose."""
    own = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    may = own.filter(F.col("id").isNotNull() & F.col("text").rlike("[@0-9]"))
    pairs = may.mapInArrow(_pairs, "entity string, key long, id long")
    beside = pairs.groupBy("entity", "key").agg(F.count(F.lit(1)).alias("n_et")).filter(F.col("n_et") >= support)
    alone = beside.filter("key is null").select(F.col("entity").alias("_e"), F.col("n_et").alias("n_e"))
    tried = beside.filter("key is not null").join(alone, F.col("entity") == F.col("_e")).drop("_e")
    # tables of their own: the joins with them are plain exchanges, so adaptive execution splits a hot term
    known = cut(own.select("text").mapInArrow(_counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).select(
        F.col("key").alias("_k"), F.col("n").alias("n_t")))
    n_all = _lines(own).first()[0] or 0  # one number
    scored = tried.join(known, F.col("key") == F.col("_k"))
    about = F.log2(F.lit(n_all) / F.col("n_e"))
    told = F.log2(F.lit(n_all) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    scored = scored.withColumn("share", F.when(about > 0, told / about)).filter(F.col("share") >= generalise_at)
    scored = cut(scored.select("entity", F.col("key").alias("_k"), "share"))
    # the terms a document has and not those its entities have: an entity on many lines has no end of terms
    said = may.mapInArrow(_said, "key long, id long")
    holds = pairs.filter("key is null").select("entity", "id").distinct()
    met = said.join(scored, F.col("key") == F.col("_k")).join(holds, ["entity", "id"], "left_semi")
    keys = lambda c: F.collect_set(F.when(c, F.col("key")))
    return met.groupBy("id").agg(keys(F.col("share") < remove_at).alias("generalise"), keys(F.col("share") >= remove_at).alias("remove"))


def _masked(text: str, spans: list[tuple[str, int, int, str]]) -> str:
    """The text with each span replaced; spans that overlap are replaced once, by the label of the first."""
    out, done = [], 0
    for kind, a, b, action in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= done:
            out.append(text[done:a])
            if kind != "term":
                out.append(f"[{kind.upper()}]")
            elif action == "generalise":
                word = text[a:b]
                out.append("[CODE]" if _DIGIT.search(word) else "[NAME]" if word[0].isupper() else "[WORD]")
        done = max(done, b)
    out.append(text[done:])
    return "".join(out)


def _sanitised(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    spans_out, text_out = [], []
    masks = zip(batch.column("generalise").to_pylist(), batch.column("remove").to_pylist())
    for text, (general, gone) in zip(batch.column(0).to_pylist(), masks):
        spans = [(*s, "mask") for s in base_spans(text)] if text else []
        if spans and (general or gone):
            words = list(terms(text, 0, len(text), [(a, b) for _, a, b, _ in spans]))
            general, gone = set(general or ()), set(gone or ())
            for (_, a, b), k in zip(words, term_key([w for w, _, _ in words]).tolist()):
                if k in gone or k in general:
                    spans.append(("term", a, b, "remove" if k in gone else "generalise"))
        spans_out.append([{"kind": k, "begin": a, "end": b, "action": x} for k, a, b, x in spans])
        text_out.append(_masked(text, spans) if spans else text)
    return {"spans": pa.array(spans_out, _SPANS_ARROW), "clean": pa.array(text_out, pa.string())}


_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("action", pa.string())]))


def sanitise(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **limits: float) -> DataFrame:
    """``docs`` with ``spans`` (kind, begin, end, action: by kind, then place) and ``clean``, the text without them.

    Only texts with a digit or an @ can hold an entity, so only these meet the lists of terms in a shuffle.
    """
    names = [c for c in docs.columns if c not in ("spans", "clean")]
    row = F.struct(*[F.col(f"`{c}`") for c in names if c != text])
    wide = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").cast("long").alias("id"))
    may = F.coalesce(F.col("text").rlike("[@0-9]"), F.lit(False))
    lists = disclosures(docs, key=key, text=text, **limits)
    met = wide.filter(may).join(lists, "id", "left").select("row", "text", "generalise", "remove")
    none = F.lit(None).cast("array<long>")
    plain = wide.filter(~may).select("row", "text", none.alias("generalise"), none.alias("remove"))
    done = append(met.unionByName(plain), _sanitised, [field("spans", _SPAN), field("clean", T.StringType())], uses=["generalise", "remove"])
    return done.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names], "spans", "clean")


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans in one string."""
    of = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        key, *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), F.size(of("term")).cast("long").alias("n_term"))
