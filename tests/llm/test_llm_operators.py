"""Every operator against a plain version, with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random
import tempfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from feedloom.llm import chat, frames, licenses, packing, pieces, quality, repeats, simhash, toxicity, vafile, words

# columns named like those that operators use inside
SCHEMA = "doc_id long, text string, source string, id string, tag int, row string, c0 string, full string, fingerprint int, pattern string"


def texts(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "é", "straße", "naïve", "Data", "x", "lorem", "IPSUM", "dolor.", "##", "|", "▁", "😀"]
    some = lambda k: " ".join(rng.choice(vocabulary) + str(rng.randrange(9) or "") for _ in range(k))
    shared = some(40)
    out = [None, "", "   \n\t ", "one", "one two", "One TWO three", "\n\nthe the the the\nthe the\n"]
    for i in range(n):
        t = some(rng.randrange(1, 90))
        if i % 4 == 0:
            t = f"{t}\n{' '.join(shared.split()[rng.randrange(20):])} {some(3)}"
        if i % 7 == 0 and i:
            t = out[-1]
        out.append(t)
    return [*out, some(20_000), shared]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, f"s{(i or 0) % 3}" if (i or 1) % 5 else None, "a", 7, "r", "c", None, 3, "p") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3 % 131, t) for i, t in enumerate(texts())]
    out = [(i, t) for n, (i, t) in enumerate(out)]
    return [*out, out[8], out[8], (None, "nobody has this text"), (None, out[-1][1])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_words_are_those_of_the_pattern():
    batch = texts()
    got = words.Words.of(pa.array(batch, pa.string()))
    want = [brute.WORD.findall(t or "") for t in batch]
    assert got.count.tolist() == [len(w) for w in want]
    raw = got.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(got.start, got.end)] == [x for w in want for x in w]
    by_word = {}
    for w, h in zip((x for ws in want for x in ws), got.hashes().tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_slices_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": texts(), "i": list(range(len(texts())))})
    parts = list(words.slices(iter([batch]), "text", 500))
    assert len(parts) > 5 and [x for p in parts for x in p.column("i").to_pylist()] == batch.column("i").to_pylist()


def test_quality_figures(docs, rows):
    got = quality.measure(docs)
    assert got.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "pattern"]
    want = sorted((i or -1, *brute.quality(t)) for i, t in rows)
    assert sorted((r.doc_id or -1, *(r[f] for f in quality.FIGURES[:5])) for r in got.collect()) == want


def test_quality_posterior_finds_the_telling_rules():
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.85
    # share of bad votes of each rule; the last one tells nothing
    rates = {True: [0.01, 0.02, 0.05, 0.03, 0.3], False: [0.9, 0.8, 0.7, 0.6, 0.3]}
    n = len(rates[True])
    votes = np.stack([np.where(rng.random(len(good)) < np.where(good, rates[True][i], rates[False][i]), 0, 2) for i in range(n)], axis=1)
    pattern, inverse, times = np.unique(votes @ 3 ** np.arange(n), return_inverse=True, return_counts=True)
    found = quality.posterior(pattern, times.astype(float), n)[inverse] >= 0.5
    # as with the true rates, which no rule of decision can beat
    like = lambda r: np.prod([np.where(votes[:, i] == 0, r[i], 1 - r[i]) for i in range(n)], axis=0)
    best = 0.85 * like(rates[True]) >= 0.15 * like(rates[False])
    assert (found == best).mean() > 0.995


def test_quality_posterior_hears_rules_that_never_vote_good():
    rng = np.random.default_rng(7)
    good = rng.random(60_000) < 0.8
    # (bad, abstains, good) of each rule on good and on bad texts; three rules never vote good
    rates = {True: [(0.02, 0.98, 0), (0.01, 0.99, 0), (0.03, 0.97, 0), (0.02, 0.1, 0.88)],
             False: [(0.7, 0.3, 0), (0.6, 0.4, 0), (0.5, 0.5, 0), (0.4, 0.4, 0.2)]}
    draw = lambda p: np.searchsorted(np.cumsum(p)[:2], rng.random(len(good)), "right")
    votes = np.stack([np.where(good, draw(rates[True][i]), draw(rates[False][i])) for i in range(4)], axis=1)
    pattern, inverse, times = np.unique(votes @ 3 ** np.arange(4), return_inverse=True, return_counts=True)
    p = quality.posterior(pattern, times.astype(float), 4)
    like = lambda r: np.prod([np.array(r[i])[votes[:, i]] for i in range(4)], axis=0)
    best = 0.8 * like(rates[True]) >= 0.2 * like(rates[False])
    assert ((p[inverse] >= 0.5) == best).mean() > 0.99
    of = dict(zip(pattern.tolist(), p))
    assert of[sum(v * 3**i for i, v in enumerate((0, 0, 0, 1)))] < 0.01 < 0.9 < of[sum(v * 3**i for i, v in enumerate((1, 1, 1, 2)))]


def test_quality_posterior_of_rows_condemned_by_mute_rules():
    mute, all_good = (1, 2, 4, 6, 7), [2] * 8
    for first in (1, 2):  # the mute rules abstain on good texts, or vote good
        base = [first if i in mute else 2 for i in range(8)]
        rows = [(base, 90_000), *[([0 if i == m else v for i, v in enumerate(base)], 2_000) for m in mute],
                ([0 if i in mute else v for i, v in enumerate(all_good)], 5_000)]
        pattern = np.array([sum(v * 3**i for i, v in enumerate(r)) for r, _ in rows])
        p = quality.posterior(pattern, np.array([n for _, n in rows], float), 8)
        assert (p[:6] > 0.9).all() and p[6] < 0.01


def test_quality_kept_is_that_of_a_plain_row_by_row_estimate(docs, rows):
    votes = []
    for _, t in rows:
        t = t or ""
        n, chars, symbols, again, repeat = brute.quality(t)
        lines = [x for x in t.split("\n") if brute.WORD.search(x)]
        letters = [c for c in t if c.isascii() and c.isalpha()]
        made = {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": again, "n_repeat_words": repeat, "n_lines": len(lines),
                "n_upper": sum(c.isupper() for c in letters), "n_letters": len(letters), "n_marks": sum(c in "!?" for c in t),
                "n_signs": sum(33 <= ord(c) < 127 and not c.isalnum() for c in t)}
        ratio = [made[r.part] / (max(made[r.whole], 1) if r.whole else 1) for r in quality.RULES]
        votes.append([0 if x > r.bad_over or x < r.bad_under else 2 if r.good and r.good[0] <= x <= r.good[1] else 1
                      for x, r in zip(ratio, quality.RULES)])
    good = brute.posterior(votes)
    want = sorted((i or -1, bool(g >= 0.5) and (q := brute.quality(t))[0] >= 50 and 100 * q[4] <= 50 * q[0]) for (i, t), g in zip(rows, good))
    measured = quality.measure(docs)
    got = quality.judge(measured, quality.fit(measured)).collect()
    assert sorted((r.doc_id or -1, r.kept) for r in got) == want


def test_quality_posterior_at_the_limit(spark):
    model = spark.createDataFrame([(0, 0.5), (1, 0.49999)], "pattern long, p_good double")
    rows = spark.createDataFrame([(0, False), (1, False), (0, True)], "pattern long, base_failed boolean")
    assert sorted(map(tuple, quality.judge(rows, model).select("pattern", "base_failed", "kept").collect())) == [
        (0, False, True), (0, True, False), (1, False, False)]


def test_quality_keeps_rows_unchanged(docs, none):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    assert kept.filter("text is null or doc_id = 3 * 3").count() == 0
    assert quality.keep_good(none).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"shard_nodes": 8, "sample": 64}])
def test_simhash(docs, rows, sizes, monkeypatch):
    if sizes:
        monkeypatch.setattr(simhash, "LEAF", 2)
    got = simhash.duplicates(docs, **sizes).collect()
    prints = {}
    for i, t in rows:
        prints.setdefault(i, set()).add(brute.simhash(t))
    assert {(r.doc_id, r.fingerprint & (2**64 - 1)) for r in got} == {(i, p) for i, ps in prints.items() for p in ps}
    assert len(got) == len(rows)
    nodes = {}
    for i, t in rows:
        if i is not None:
            p = brute.simhash(t)
            nodes[p] = min(nodes.get(p, i), i)
    group = brute.groups([(i, p) for p, i in nodes.items()])
    assert all(r.component == group.get(nodes.get(r.fingerprint & (2**64 - 1))) for r in got)


def test_vantage_trees_find_all_links(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [seeds]
    for _ in range(12):
        near.append(near[-1] ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)))
    points = np.unique(np.concatenate([*near, rng.integers(0, 2**63, 600, dtype=np.uint64)]))
    nodes = spark.createDataFrame([(i, int(p)) for i, p in enumerate(points.view(np.int64))], "node long, point long")
    links = simhash.links(nodes, shard_nodes=50)
    got = {r.node: r.component for r in frames.components(links).collect()}
    want = brute.groups([(i, int(p)) for i, p in enumerate(points)])
    assert {i: got.get(i, i) for i in want} == want


def test_large_shards_are_dealt_again(spark, monkeypatch):
    """Sixteen times as many nodes as the first tree sees, and groups that it cannot tell apart."""
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flip = lambda p, k: p ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (k, len(p)), dtype=np.uint64), axis=0)
    close = np.concatenate([flip(np.full(1500, seeds[0]), 16), flip(np.full(1500, seeds[1]), 12)])  # two clouds
    points = np.unique(np.concatenate([seeds, *[flip(seeds, k) for k in (1, 2, 3, 3)], close, rng.integers(0, 2**63, 2500, dtype=np.uint64)]))
    nodes = spark.createDataFrame([(i, int(p)) for i, p in enumerate(points.view(np.int64))], "node long, point long")
    dealt = []
    go = simhash.deal_again
    monkeypatch.setattr(simhash, "deal_again", lambda rows, *a: dealt.append((rows, go(rows, *a))) or dealt[-1][1])
    monkeypatch.setattr(simhash, "LARGE", 4)
    most = 100
    links = simhash.links(nodes, sample=len(points) // 16, shard_nodes=most, part_sample=256, chunk_rows=300)
    got = {r.node: r.component for r in frames.components(links).collect()}
    near = simhash.distance(points[:, None], points[None, :]) <= 2
    forest = simhash.Forest(len(points))
    forest.join(*np.nonzero(near))
    assert {i: got.get(i, i) for i in range(len(points))} == dict(enumerate(forest.root.tolist()))
    size = lambda df: df.groupBy("shard").count().agg(F.max("count")).first()[0]
    before, after = dealt[0]
    assert size(before) > 4 * most >= size(after)
    assert after.filter("home").count() == len(points) and after.filter("home").select("node").distinct().count() == len(points)


def test_keep_one(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    ids = [r.doc_id for r in kept.collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named)) and ids.count(None) == 2
    want = {r.component for r in simhash.duplicates(docs).collect()} - {None}
    assert set(named) == want
    assert simhash.keep_one(none).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1001 + i) for i in range(200)]
    got = {r.node: r.component for r in frames.components(spark.createDataFrame([*chain, *star, (5, 5), (None, 3)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1201)}}
    assert frames.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("size, gram, sizes", [
    (13, 6, {}), (13, 1, {}), (13, 13, {}), (5, 3, {}), (13, 6, {"look": 1, "hot_segments": 1}), (5, 3, {"look": 1, "hot_segments": 4})])
def test_repeats(docs, rows, size, gram, sizes):
    got = repeats.remove_repeats(docs, size=size, gram=gram, **sizes)
    assert got.columns == [*docs.columns, "n_words", "n_removed", "kept"]
    named = [(i, t) for i, t in rows if i is not None]
    want = brute.kept_words(named, size) + [(-1, n, 0, k) for _, n, _, k in brute.kept_words([(0, t) for i, t in rows if i is None], size)]
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect())
    assert found == sorted(want)


def test_repeats_in_contexts_that_share_half_a_hash(spark):
    # one anchor; the upper 32 bits of both segments' hashes are equal, the words are not
    both = [f"a15885 b c d e f t u v w x y z{n}" for n in (91215, 116359)]
    found = words.Words.of(pa.array(both, pa.string()))
    seg = repeats.Segments.of(found, found.hashes(), 13, 6)
    assert seg.anchor[0] == seg.anchor[1] and seg.whole[0] >> np.uint64(32) == seg.whole[1] >> np.uint64(32)
    # a slice of its own for each text, so that the windows decide, and both in one
    for parts in (3, 1):
        docs = spark.createDataFrame([(1, both[0]), (2, both[1]), (3, both[1])], "doc_id long, text string").repartition(parts, "doc_id")
        got = {r.doc_id: (r.n_removed, r.kept) for r in repeats.remove_repeats(docs).collect()}
        assert got == {1: (0, both[0]), 2: (0, both[1]), 3: (13, "")}


def test_repeats_of_an_anchor_in_a_third_of_the_rows(spark, monkeypatch):
    rng = random.Random(12)
    some = lambda k: " ".join(f"w{rng.randrange(500)}" for _ in range(k))
    line, passage = some(8), some(16)  # too short to be cut, and long enough
    rows = [(i, f"{some(20)} {line if i % 3 else passage} {some(20)}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    split = []
    monkeypatch.setattr(repeats, "_known_by_count", lambda seg, go=repeats._known_by_count: split.append(1) or go(seg))
    for sizes in ({"look": 2, "hot_segments": 60}, {}):
        got = repeats.remove_repeats(docs, **sizes).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(brute.kept_words(rows))
    assert split == [1]


def test_repeats_in_rows_that_share_an_id(spark, monkeypatch):
    rng = random.Random(13)
    some = lambda k: " ".join(f"w{rng.randrange(900)}" for _ in range(k))
    passage = some(20)
    rows = [(1, f"{some(5)} {passage}"), (2, f"{passage} {some(9)}"), *[(2, some(40)) for _ in range(30)], (3, f"{some(7)} {passage}")]
    for few in (repeats.FEW_IDS, 0):
        monkeypatch.setattr(repeats, "FEW_IDS", few)
        got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(brute.kept_words(rows))


def test_rest_keeps_the_white_space():
    rng = random.Random(3)
    texts_ = ["a b\nc d\ne f", "", " \n ", "one  two\tthree \n\n four", *("".join(rng.choice(["x ", "yé", " ", "\n", "\t", "z"]) for _ in range(30)) for _ in range(60))]
    found = words.Words.of(pa.array(texts_, pa.string()))
    for share in (0.0, 0.3, 0.7, 1.0):
        left = np.array([rng.random() >= share for _ in range(len(found))], bool)
        got = repeats.rest_of(found, left).to_pylist()
        assert got == [brute.rest(t, {k for k in range(n) if not left[a + k]}) for t, a, n in zip(texts_, found.first, found.count)]
    whole = words.Words.of(pa.array(["first line\nsecond line\nthe third line\nmail bob@x.org now"], pa.string()))
    assert repeats.rest_of(whole, np.array([True] * 4 + [False] * 3 + [True] * 3)).to_pylist() == ["first line\nsecond line\nmail bob@x.org now"]


def test_repeats_of_nothing(none):
    assert repeats.remove_repeats(none).count() == 0


def test_packing(docs, rows):
    got = packing.pack(docs, capacity=300, shard_rows=20).collect()
    length, bins = {}, {}
    for i, t in rows:
        length.setdefault(i, []).append(len(brute.WORD.findall(t or "")))
    of_doc = {}
    for r in got:
        of_doc.setdefault(r.doc_id, []).append((r.first_word, r.n_words))
        bins.setdefault(r.bin_id, []).append(r)
    for i, sizes in length.items():
        want = sorted((a, min(300, n - a)) for n in sizes for a in range(0, max(n, 1), 300))
        assert sorted(of_doc[i]) == want
    source = {r.doc_id: r.source for r in docs.collect()}
    for held in bins.values():
        held.sort(key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        assert [r.offset for r in held] == [sum(x.n_words for x in held[:k]) for k in range(len(held))]
        assert sum(r.n_words for r in held) <= 300
        named = [source[r.doc_id] for r in held if source[r.doc_id] is not None]
        assert len(named) == len(set(named))


def test_best_fit_takes_the_tightest_bin_without_conflict():
    #        opens 0, opens 1 (same source), fits 1 tightest, tightest 0 has its cluster: next, no bin without conflict
    lengths, sources, clusters = [60, 70, 20, 10, 5], ["a", "a", "b", "c", "a"], [1, 2, 3, 3, 9]
    assert packing.best_fit(lengths, sources, clusters, 100) == ([0, 1, 1, 0, 2], [0, 0, 70, 60, 0])


def test_packing_keeps_near_copies_apart(spark):
    base = [f"w{i}" for i in range(400)]
    made = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in range(0, 400, 5)]
    prints = simhash.fingerprints(pa.array([" ".join(base), *made], pa.string()))
    copies = [t for t, p in zip(made, prints[1:]) if 1 <= int(p ^ prints[0]).bit_count() <= 2][:8]
    assert len(copies) == 8
    texts = [" ".join(base), *copies, " ".join(f"v{i}" for i in range(400))]
    docs = spark.createDataFrame([(i if i != 3 else None, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    together = lambda d: d.groupBy("bin_id").agg(F.count("*").alias("n"), F.max("doc_id").alias("m")).collect()
    from feedloom.llm import queries

    docs.write.mode("overwrite").parquet(folder := f"{tempfile.mkdtemp()}/documents.parquet")
    found = together(queries.QUERIES["op2_best_fit_packing"](spark, folder.rsplit("/", 1)[0]))
    # nine bins of one copy each, the text of its own in one of them
    assert sorted(r.n for r in found) == [1] * 8 + [2] and max(r.m or 0 for r in found if r.n == 2) == 9
    assert len(together(packing.pack(docs))) == 2
    assert packing.pack(docs.limit(0), near=2).count() == 0


def test_packing_without_rows_and_with_own_clusters(docs, none):
    assert packing.pack(none).count() == 0
    big = docs.withColumn("doc_id", F.col("doc_id") + (1 << 60))  # ids beyond what a float holds, and nulls
    assert {r.doc_id for r in packing.pack(big).collect()} == {r.doc_id for r in big.collect()}
    held = packing.pack(docs.withColumn("source", F.lit(None).cast("string")).withColumn("c", F.lit(1)), cluster="c", capacity=100_000)
    assert held.groupBy("bin_id").count().filter("count > 1").count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, capacity=0)


CHATS = [
    (1, 2, "user", "b"), (1, 1, "user", "a <|im_sep|> <\\|x"), (1, 3, "assistant", None), (1, 3, "assistant", "ü <|im_end|>\n<\\\\|"),
    (2, None, None, "x"), (2, 0, "a\n<|b", ""), (None, 0, "assistant", "q"), (3, 0, "user", "t"), (3, 0, "user", "t"), (4, 0, "system", ""),
]


def test_chat_reads_back(spark):
    rows = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(1))
    got = chat.format_conversations(rows).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in got.collect():
        want = [(x[2] or "", x[3] or "") for x in sorted((c for c in CHATS if c[0] == r.conv_id), key=key)]
        assert [tuple(t) for t in r.turns] == want
        assert r.learned == "".join(t for role, t in want if role == "assistant")
    one = next(r for r in got.collect() if r.conv_id == 3)
    assert one.formatted == "<|im_start|>user\nt<|im_sep|>t<|im_end|>\n"
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_licenses(spark):
    t = licenses.TEMPLATES
    lines = t["mit-grant"].split(" ")
    folded = "\n".join(" ".join(lines[i : i + 9]) for i in range(0, len(lines), 9))
    rows = [
        (1, f"text\n{t['gpl-3.0-line'].upper()}\nmore text here"), (2, None), (3, ""), (4, "word"), (5, f"a title\n\n{folded}\n\nthe code"),
        (6, folded.replace("Software", "software, Inc.", 1)), (7, "released under the license of nobody"), (1, t["unlicense"]), (None, t["isc"]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unit", F.lit(0)).withColumn("body", F.lit("x"))
    got = sorted(((r.doc_id or 0, r.unit, r.unit_no, r.template, round(r.score, 9)) for r in licenses.scan(docs).collect()))

    def dice(text, name):
        a, b = set(licenses.bigrams(text)), set(licenses.bigrams(t[name]))
        return round(2 * len(a & b) / (len(a) + len(b)), 9)

    # the line and the block around it, and a whole text in which a licence is nearly all
    want = [
        (0, "line", 0, "isc", 1.0), (1, "line", 0, "unlicense", 1.0), (1, "line", 1, "gpl-3.0-line", 1.0),
        (1, "sentence", 0, "gpl-3.0-line", dice(f"text {t['gpl-3.0-line']}", "gpl-3.0-line")),
        (1, "block", 0, "gpl-3.0-line", dice(rows[0][1], "gpl-3.0-line")), (5, "block", 1, "mit-grant", 1.0),
        (5, "text", 0, "mit-grant", dice(rows[4][1], "mit-grant")), (6, "block", 0, "mit-grant", dice(rows[5][1], "mit-grant")),
    ]
    assert got == sorted(w for w in want if w[4] >= licenses.LEAST) and len(got) == 8
    assert licenses.scan(docs.limit(0)).count() == 0 and licenses.scan(docs, templates={}).count() == 0


def test_licenses_in_sentences_and_under_their_own_names(spark):
    t = licenses.TEMPLATES
    long = " ".join(f"word{i}" for i in range(5000))
    rows = [
        (1, "Copyright (c) 2024 Foo. Released under the MIT License."), (2, "Released under the BSD License."), (3, "# SPDX-License-Identifier: MIT"),
        (4, "// SPDX-License-Identifier: GPL-3.0-or-later"), (5, t["lgpl-2.1-notice"]), (6, t["lgpl-3.0-notice"]), (7, t["agpl-3.0-notice"]),
        (8, t["gpl-2.0-notice"]), (9, "Copyright 2020 Bar\n\n" + t["bsd-3-clause"]), (10, t["bsd-2-clause"]), (11, "MIT License\n\n" + t["mit-text"]),
        (12, f"{long} {long}. Released under\nthe MIT License. {long}"), (13, "SPDX-License-Identifier: nobody's"), (14, "Read the license. It is long."),
    ]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add((r.unit, r.template))
    line = lambda name: {("line", name)}
    assert got[1] == {("sentence", "mit-line")} and got[2] == line("bsd-line") and got[3] == line("spdx-mit") and got[4] == line("spdx-gpl-3.0")
    assert all(("line", n) in got[i] for i, n in ((5, "lgpl-2.1-notice"), (6, "lgpl-3.0-notice"), (7, "agpl-3.0-notice"), (8, "gpl-2.0-notice")))
    assert ("line", "bsd-3-clause") in got[9] and ("line", "bsd-2-clause") in got[10] and ("line", "mit-text") in got[11]
    assert got[12] == {("sentence", "mit-line")} and 13 not in got and 14 not in got


def test_licenses_work_every_step_out_once(spark):
    # filters pushed below a select, and columns named in a lambda, had the words of a unit made once for each template and the lines once for each sentence
    plan = licenses.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 1 and plan.count("array_distinct(") == 1 and plan.count("split(") == 4
    assert plan.count("regexp_replace(") == 6


def test_licenses_of_odd_texts_as_in_sql(spark):
    import duckdb

    t = licenses.TEMPLATES
    rows = [
        (1, "Licensed\n \nunder CC BY 4.0.\nLicensed \x01UNDER\x01 CC BY 4.0.\x01 Licensed  under CC BY-SA 4.0"), (1, "relicensed underCC by 4.0."), (2, "\x01"), (2, "\n\n"),
        (3, f"K{t['mit-line']}"), (4, f"\u212a{t['mit-line']}\u0130"), (5, t["mit-line"].replace("License", "Licen\u017fe")), (None, f"{t['gpl-warranty'].swapcase()}\t"),
        (6, f"{t['mit-line']}\n{t['mit-line']} {t['bsd-line']} {t['bsd-line']}\n\n{t['zlib']}\n{t['isc']}"), (7, ("under " * 40 + ". ") * 3), (8, "$1 \\ " + t["unlicense"]),
        (9, "\n".join(t.values())), (9, " ".join(t.values())), (10, "\n\n".join(f"// {x}\r" for x in t.values())), (11, None), (11, ""), (12, "\U0001f600" + t["zlib"] + "\U0001f600"),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    with duckdb.connect() as con:
        con.execute("create table documents(doc_id bigint, text varchar)")
        con.executemany("insert into documents values (?, ?)", rows)
        want = con.execute(licenses.scan_sql()).fetchall()
    order = lambda found: sorted((str(i), unit, no, name, round(score, 9)) for i, unit, no, name, score in found)
    assert order(got) == order(want) and len(want) > 50


def best(vectors, query, k):
    floor = lambda v: [int(np.floor(256 * float(np.float32(x)))) for x in v]
    q = floor(dict(vectors)[query])
    found = [(-sum(a * b for a, b in zip(q, floor(v))), i) for i, v in vectors if i != query and len(v) == len(q)]
    return [(query, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]


@pytest.mark.parametrize("shard_rows", [40, 8192])
def test_top_k(spark, shard_rows):
    rng = np.random.default_rng(2)
    sound = [(i, rng.normal(size=6).round(1).tolist()) for i in range(150)] + [(i, [0.5] * 6) for i in range(200, 260)]
    sound += [(i, [1.0, float(i)]) for i in (300, 301, 350)] + [(400, []), (401, [])]
    odd = [(500, None), (501, [1.0, None]), (502, [float("nan"), 1.0]), (503, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [9.0] * 6)]
    rows = spark.createDataFrame([*sound, *odd, sound[3], sound[50]], "vec_id long, embedding array<float>").withColumn("id", F.lit(0))
    smaller = {7: min(sound[7][1], [9.0] * 6)}
    want = [(i, smaller.get(i, v)) for i, v in sound]
    got = vafile.top_k(rows, rows.filter("vec_id % 50 = 0"), shard_rows=shard_rows, block_rows=3, query_rows=2)
    assert sorted(map(tuple, got.collect())) == sorted(x for q in (0, 50, 100, 200, 250, 300, 350, 400) for x in best(want, q, 5))
    assert vafile.top_k(rows, rows.limit(0)).count() == 0 and vafile.top_k(rows.limit(0), rows).count() == 0


@pytest.mark.parametrize("shard_rows", [20, 8192])
def test_top_k_of_any_finite_size(spark, shard_rows):
    rng = np.random.default_rng(6)
    sizes = [1.0, 3e5, 1e12, 1e30, 3e38]
    sound = [(i, (rng.normal(size=3) * sizes[i % 5] * 0.1).tolist()) for i in range(120)]
    sound += [(200 + i, [0.0, 3e5 * (-1) ** i, 0.0]) for i in range(6)]  # ties among the large ones
    sound += [(300 + i, rng.normal(size=2000).tolist()) for i in range(30)] + [(350, [3e5] * 2000), (351, [1e30] * 2000)]
    odd = [(500, [float("inf"), 1.0, 1.0]), (501, [1.0, None, 1.0])]
    rows = spark.createDataFrame([*sound, *odd, sound[1], sound[3], sound[3]], "vec_id long, embedding array<float>")
    got = vafile.top_k(rows, rows.filter("vec_id % 50 = 0"), shard_rows=shard_rows, query_rows=2).collect()
    near = lambda x: max(min(x, 2**63 - 1), -(2**63))
    want = [(q, r, i, near(s)) for n in (0, 50, 100, 200, 300, 350) for q, r, i, s in best(sound, n, 5)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(w[3] == 2**63 - 1 for w in want)


def test_pieces(docs, rows):
    vocabulary = pieces.Vocabulary.read()
    done = pieces.encode(docs, keep=["doc_id", "text", "c0"])
    done = pieces.decode(done.withColumn("h", F.xxhash64("doc_id"))).collect()
    assert len(done) == len(rows) and all(r.decoded == (r.text or "") for r in done)
    for r in done:
        if len(r.text or "") < 400:
            assert r.pieces == brute.pieces(r.text or "", r.h, vocabulary, pieces.ALPHA, pieces.SEED)


def test_pieces_are_drawn_by_their_probability():
    vocabulary = pieces.Vocabulary.read()
    heads, byte = pieces.Heads(vocabulary, 0.3), np.array(vocabulary.byte)
    n = 20_000
    got = pieces.sample(pa.array([" the"] * n), np.arange(n), heads, byte).to_pylist()
    ways = {}

    def go(at, ids, w):
        word = "▁the"
        if at == len(word):
            ways[tuple(ids)] = w
        for j in range(at + 1, len(word) + 1):
            p = vocabulary.ids.get(word[at:j])
            if p is not None:
                go(j, [*ids, p], w * (2 + vocabulary.ranks[p]) ** -0.3)

    go(0, [], 1.0)
    total = sum(ways.values())
    for ids, w in ways.items():
        assert abs(sum(tuple(x) == ids for x in got) / n - w / total) < 0.02


def test_any_ids_can_be_decoded(spark):
    rows = spark.createDataFrame([([3 + 0xC3], "x"), (None, "x"), ([], "x")], "pieces array<int>, ids string")
    assert [r.decoded for r in pieces.decode(rows).collect()] == ["�", None, ""]


def test_kernel():
    found = ["idiot", "i.d.i.o.t", "idi", "id", "stupid", "aaaa", "idiotic" * 3, "été"]
    marks = ["idiot", "stupid", "aaab"]
    got = toxicity.Tables.of(toxicity.kernel_columns(marks, 0.5), 0.5)(found)
    want = [[brute.kernel(u, m, 0.5) for m in marks] for u in found]
    assert np.allclose(got, want, atol=1e-5)


def test_units():
    row, found = toxicity.units(pa.array(["You, I.D.I.O.T! i d i o t", None, "", "a b the", "x y z w"], pa.string()))
    assert sorted(zip(row.tolist(), found.to_pylist())) == [(0, "i d i o t"), (0, "i.d.i.o.t"), (0, "you"), (3, "the"), (4, "x y z w")]


def test_toxicity(spark):
    rng = random.Random(4)
    clean = ["morning", "river", "table", "window", "garden", "letter", "winter", "paper", "music", "stone"]
    insult = ["blorgface", "snivelwit", "grubhead"]
    rows, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        said = [rng.choice(clean) for _ in range(30)]
        if bad:
            w = rng.choice(insult)
            said[rng.randrange(30)] = w if i % 2 else "-".join([w[:4], w[4:]])
        rows.append((i, ". ".join(" ".join(said[k : k + 6]) for k in range(0, 30, 6))))
        labels.append((i, int(bad) if i % 50 else None))
    docs = spark.createDataFrame([*rows, (None, "river"), (2000, None), (2001, "")], "doc_id long, text string").withColumn("score", F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, marks, sample=200)).collect()
    found = {r.doc_id: r.predicted for r in got}
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 903
    assert np.mean([found[i] == (i % 3 == 0) for i in range(900)]) > 0.98
    assert found[None] == found[2000] == found[2001] == 0
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).collect()} == {0.0}


def test_nothing_is_learned_from_the_held_out_fold(spark):
    import zlib

    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    ids = spark.range(200).withColumn("h", toxicity.held_out(F.col("id")))
    assert all(r.h == out(r.id) for r in ids.collect())
    rng = random.Random(9)
    said = lambda bad: " ".join(rng.choice(["river", "table", "garden", "letter"]) for _ in range(12)) + (" blorgface" if bad else "")
    rows = [(i, said(i % 3 == 0)) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, "blorgface river"), (900, "x " * 60_000 + "blorgface")], "doc_id long, text string")
    marks = [(i, int(i % 3 == 0)) for i in range(300)]
    score = lambda labels: {r.doc_id: r.score for r in toxicity.score(
        docs, toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), sample=100)).collect()}
    found = score(marks)
    assert found == score([(i, 1 - t if out(i) else t) for i, t in marks])  # flipped where nothing may be learned
    assert found != score([(i, t if out(i) else 1 - t) for i, t in marks])
    none = docs.limit(0)
    assert toxicity.score(none, toxicity.fit(none, spark.createDataFrame(marks, "doc_id long, toxic int"))).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_is_that_of_a_search_through_all_bins(seed):
    rng = random.Random(seed)
    n, capacity = 250, 60
    lengths = sorted((rng.randrange(0, 40) for _ in range(n)), reverse=True)
    sources = [rng.choice([None, *"abcdefghij"]) for _ in range(n)]
    clusters = [rng.choice([None, *range(40)]) for _ in range(n)]
    bins, want, before = [], [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        fits = [
            (capacity - used - length, b) for b, (used, held, kinds) in enumerate(bins)
            if used + length <= capacity and (source is None or source not in held) and (cluster is None or cluster not in kinds)]
        if fits:
            b = min(fits)[1]  # the tightest, the first of equal ones
        else:
            b = len(bins)
            bins.append((0, set(), set()))
        used, held, kinds = bins[b]
        want.append(b)
        before.append(used)
        bins[b] = (used + length, held | {source} - {None}, kinds | {cluster} - {None})
    assert packing.best_fit(lengths, sources, clusters, capacity) == (want, before)


def test_pieces_of_nothing(none, spark):
    done = pieces.decode(pieces.encode(none, keep=["doc_id", "text"]))
    assert done.count() == 0 and {"pieces", "decoded"} <= set(done.columns)
