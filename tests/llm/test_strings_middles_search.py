"""Repeated byte strings, fill-in-the-middle and ranked search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import lexical, middles, suffixes

# columns named like those that operators use inside
CLASHING = "k string, a int, open int, marks int, h1 string, form string, key int, n int, score string, kept int"


def clashing(df):
    for c in CLASHING.split(", "):
        name, kind = c.split(" ")
        df = df.withColumn(name, F.lit(1).cast(kind))
    return df


def frame(spark, rows):
    return clashing(spark.createDataFrame(rows, "doc_id long, text string"))


# ---- repeated strings


def cut_strings(texts, size):
    """(bytes, removed, spans, what is left) of each text, string by string."""
    bodies = [(t or "").encode() for t in texts]
    places = defaultdict(list)
    for r, b in enumerate(bodies):
        for s in range(len(b) - size + 1):
            places[b[s : s + size]].append((r, s))
    gone = [bytearray(len(b)) for b in bodies]
    for found in places.values():
        if len(found) > 1:
            for r, s in found:
                gone[r][s : s + size] = b"\1" * size
    out = []
    for b, g in zip(bodies, gone):
        runs = [(m.start(), m.end()) for m in re.finditer(rb"\x01+", bytes(g))]
        out.append((len(b), sum(g), runs, bytes(x for x, y in zip(b, g) if not y)))
    return out


def passages(seed, n=90):
    rng = random.Random(seed)
    alphabet = "abcdefghij é\n😀"
    some = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared, line = some(70), some(24)
    out = [None, "", "x", "aaaa" * 60, "a" * 500, "ab" * 120, "\0" * 90, some(3000), shared, shared[5:66]]
    for i in range(n):
        t = some(rng.randrange(120))
        if i % 3 == 0:
            a = rng.randrange(30)
            t += shared[a : a + rng.randrange(20, 60)] + some(rng.randrange(40))
        if i % 4 == 0:
            t += line + some(20) + (line if i % 8 == 0 else "")
        if i % 9 == 0:
            t = out[-1]
        out.append(t)
    return out


@pytest.mark.parametrize("size, gram, sizes", [
    (40, 8, {}), (40, 40, {}), (40, 1, {}), (21, 5, {"shard_segments": 4, "hot_segments": 3, "batch_segments": 1}),
    (24, 6, {"hot_segments": 0}), (24, 24, {"shard_segments": 10, "hot_segments": 10_000, "batch_segments": 3}),
])
def test_repeated_strings(spark, size, gram, sizes):
    texts = passages(size + gram)
    rows = [(None if i % 11 == 5 else i % 60, t) for i, t in enumerate(texts)]
    docs = frame(spark, rows).repartition(5)
    got = suffixes.remove_repeats(docs, size=size, gram=gram, **sizes)
    assert got.columns == [c for c in docs.columns if c != "kept"] + ["n_bytes", "n_removed", "spans", "kept"]
    key = lambda r: (-1 if r[0] is None else r[0], r[1] is not None, *r[1:])
    want = sorted((key((i, t, n, g, s, k)) for (i, t), (n, g, s, k) in zip(rows, cut_strings(texts, size))), key=repr)
    found = sorted((key((r.doc_id, r.text, r.n_bytes, r.n_removed, [tuple(x) for x in r.spans], bytes(r.kept))) for r in got.collect()), key=repr)
    assert found == want
    assert any(0 < x[4] < x[3] for x in want)


def test_repeated_strings_of_whole_size(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9)))
    some = lambda k: " ".join(word() for _ in range(k))
    passage, line = some(120), some(30)
    texts = [some(60) + passage[k : k + 400 + k] + some(40) for k in range(0, 60, 7)]
    texts += [some(20) + line + some(90) for _ in range(20)]  # a line shorter than a string: nothing is cut
    texts += [passage[:399], texts[3], texts[3], some(30_000)]
    got = suffixes.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), hot_segments=6)
    assert {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept)) for r in got.collect()} == {
        i: (n, g, k) for i, (n, g, _, k) in enumerate(cut_strings(texts, 400))}


def test_no_texts_have_no_repeats(spark):
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0
    same = suffixes.remove_repeats(frame(spark, [(1, "y" * 450), (1, "y" * 450), (2, "y" * 399)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in same) == [(1, 450), (1, 450), (2, 0)]
    with pytest.raises(ValueError):
        suffixes.remove_repeats(frame(spark, []), gram=500)


def test_family_grows_by_doubling():
    rng = np.random.default_rng(3)
    strings = np.array([bytes(x) for x in rng.integers(97, 100, (900, 6), dtype=np.uint8)], "S6")
    family = suffixes.Family(len(strings))
    for i in range(0, 900, 100):
        family.add(strings[i : i + 100], np.arange(i, i + 100))
        held = [x is not None for x in family.levels]
        assert held[-1] and len(held) == (i // 100 + 1).bit_length()
        for level in family.levels:
            assert level is None or (level[0][1:] > level[0][:-1]).all()
    times = Counter(strings.tolist())
    kept = {bytes(strings[n]) for level in family.levels if level is not None for n in level[1]}
    assert kept == set(times)
    assert {bytes(s) for s in strings[family.again]} == {s for s, n in times.items() if n > 1}


# ---- fill-in-the-middle


def middle(key, text):
    t = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t, re.S)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1, 7, 256, 100_000])
def test_middles(spark, block):
    rng = random.Random(block)
    some = lambda k: "".join(rng.choice("ab Cé😀\n<9") for _ in range(k))
    rows = [(i, some(rng.randrange(400))) for i in range(250)]
    rows += [(300, None), (301, ""), (302, "a <P> b"), (303, "x<M>"), (304, "<S"), (305, "word" * 5000), (306, "é" * 3000), (None, "no key"),
             rows[3], rows[3], (4, "another text of four"), (307, some(30_000))]
    docs = frame(spark, rows).withColumn("output", F.lit(0)).repartition(3)
    done = middles.transform(docs, block=block)
    assert done.columns == [c for c in docs.columns if c not in ("n", "form", "output")] + ["n", "form", "prefix_chars", "middle_chars", "output"]
    got = done.withColumn("back", middles.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(((i, t, *middle(i, t)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == want
    assert all(r.back == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert middles.transform(frame(spark, [])).count() == 0


def test_descent_finds_the_block():
    rng = np.random.default_rng(1)
    size = np.array([0, 1, 2, 3, 8, 100, 0, 13])
    counts = [rng.integers(0, 4, size.sum()), rng.integers(1, 9, size.sum())]
    tree = middles.Fenwick.of(size, counts)
    for row in range(len(size)):
        own = [c[size[:row].sum() : size[: row + 1].sum()] for c in counts]
        sums = [np.append(0, np.cumsum(c)) for c in own]
        for target in range(int(sums[0][-1]) + 2):
            at, passed = tree.descend(np.array([row]), np.array([target]))
            want = np.flatnonzero(sums[0] <= target).max()
            assert at[0] == want and [p[0] for p in passed] == [s[want] for s in sums]


# ---- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def said(t):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(t or "")]


def ranked(docs, items, k=10):
    held = [(i, Counter(said(t))) for i, t in docs if i is not None]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(said(t))
    out = []
    for q, ts in asked.items():
        found = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if score > 0:
                found.append((-score, i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "naïve", "THE", "x9"]
    pick = lambda k: " ".join(words[min(int(rng.expovariate(0.02)), 303)] for _ in range(k))
    docs = [(i * 7 % 1009, pick(rng.randrange(80))) for i in range(n)]
    docs += [(2000, None), (2001, ""), (2002, "... --"), (2003, pick(20_000)), (None, pick(30)), docs[5], docs[5], (docs[6][0], pick(9))]
    docs += [(3000 + i, "the same text w1 w2") for i in range(40)]  # ties
    items = [(i, pick(rng.randrange(1, 25))) for i in range(30)]
    items += [(40, "w1 W2, w1"), (41, ""), (42, None), (None, "w1"), (43, "nothing like it"), (40, "x9"), (44, " ".join(words)), (45, "THE the")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"shard_docs": 50, "run": 8}, {"shard_postings": 200, "run": 16, "short": 5, "block_terms": 40}, {"short": 1}, {"short": 10_000, "run": 3}])
def test_ranked_search(spark, sizes):
    docs, items = corpus(len(str(sizes)))
    found = lexical.search(frame(spark, docs).repartition(3), clashing(spark.createDataFrame(items, "item_id long, text string")), **sizes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == ranked(docs, items)


def test_ranked_search_of_nothing(spark):
    docs, items = corpus(1, 20)
    d, q = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    none = frame(spark, [])
    assert lexical.search(none, q).count() == 0 and lexical.search(d, q.limit(0)).count() == 0
    assert lexical.search(d.filter("text is null"), q).count() == 0


def test_runs_that_cannot_matter_are_skipped():
    rng = np.random.default_rng(4)
    n = 20_000
    long = [(d := np.flatnonzero(rng.random(n) < 0.5), rng.integers(1, 10, len(d))) for _ in range(4)]
    few = lexical.accumulate([(np.array([3, 900, 901]), np.array([500, 100, 7])), (np.array([3, 901]), np.array([20, 300]))])
    assert few[0].tolist() == [3, 900, 901] and few[1].tolist() == [520, 100, 307]
    none = np.zeros(0, np.int64)
    top = lexical.Top(3, none, none)
    seen = lexical.walk([few, *long], np.arange(n) * 10, top, run=100)
    total = np.zeros(n, np.int64)
    for d, v in [few, *long]:
        total[d] += v
    best = np.lexsort((np.arange(n), -total))[:3]
    assert top.key.tolist() == (best * 10).tolist() and top.score.tolist() == total[best].tolist()
    assert seen <= 12  # the first ones, until three good documents are known
