"""Skew, position and running-sum helpers against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from frames_as_rows import rows
from feedloom.operators import linkage as L, overlay as O, relational as R, select as G, state as N


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(shuffled, how):
    left = shuffled.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k")
    )
    right = shuffled.range(0, 30, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = left.join(right, "k", how)
    salted = R.skew_join(left, right, ["k"], how, spread=["id"], min_rows=20)
    assert rows(salted.select(plain.columns)) == rows(plain)


def test_salt_spreads_the_hot_key(shuffled):
    left = shuffled.range(3000).select("id", F.lit(1).alias("k"))
    right = shuffled.createDataFrame([(1, "x")], "k int, v string")
    plan = R.skew_join(left, right, ["k"], spread=["id"], min_rows=100)._jdf.queryExecution().toString()
    assert "_salt" in plan
    small = R.skew_join(left, right, ["k"], spread=["id"])
    assert small.count() == 3000


def test_hot_keys_are_the_heaviest(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 1).when(F.col("id") < 600, 2).otherwise(F.col("id")).alias("k"))
    assert rows(R.hot_keys(df, ["k"], 150).select("k")) == [(1,), (2,)]


@pytest.mark.parametrize("text,want", [("10485760b", 10485760), ("10MB", 10 * 2**20), ("64m", 64 * 2**20), ("-1", -1), ("512", 512)])
def test_size_settings(text, want):
    assert R._bytes(text) == want


def test_key_count_leaves_null_keys_out(shuffled):
    df = shuffled.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id int, k string")
    out = R.with_key_count(df, ["k"], "n", spread=["id"], min_rows=2)
    assert rows(out.select("id", "n")) == [(1, 2), (2, 2), (3, 0), (4, 1)]


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_position_is_the_global_order(spark, parts):
    values = [(i, random.Random(i).randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(values, "id int, v int").repartition(parts, "id")
    got = {r.id: r.pos for r in R.with_position(df, [F.desc("v"), F.asc("id")]).collect()}
    want = {i: p for p, (i, v) in enumerate(sorted(values, key=lambda x: (-x[1], x[0])))}
    assert got == want


def test_running_sum_over_a_key_in_many_partitions(spark):
    rnd = random.Random(3)
    data = [(k, i, rnd.randint(1, 9)) for k, n in ((1, 400), (2, 5), (3, 1)) for i in range(n)]
    df = spark.createDataFrame(data, "k int, i int, v int").repartition(16)
    got = {(r.k, r.i): r.before for r in R.running_sum(df, ["k"], ["i"], F.col("v")).collect()}
    want, total = {}, {}
    for k, i, v in sorted(data):
        want[(k, i)] = total.get(k, 0)
        total[k] = want[(k, i)] + v
    assert got == want


def test_top_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    plan = R.top_per_key(df, ["k"], [F.asc("id")], 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --- greedy de-duplication ----------------------------------------------------------------------


def greedy(data):
    seen, kept = [set(), set()], []
    for o, *keys in sorted(data):
        if any(k is not None and k in s for k, s in zip(keys, seen)):
            continue
        kept.append(o)
        for k, s in zip(keys, seen):
            if k is not None:
                s.add(k)
    return kept


def test_dropped_rows_block_nothing(spark):
    df = spark.createDataFrame([(1, "i1", "u1"), (2, "i2", "u1"), (3, "i2", "u3")], "o long, a string, b string")
    assert rows(L.greedy_first_wins(df, ["a", "b"], "o").select("o")) == [(1,), (3,)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_rounds_equal_the_ordered_loop(shuffled, seed):
    rnd = random.Random(seed)
    pick = lambda n: None if rnd.random() < 0.1 else f"k{rnd.randint(0, n)}"
    data = [(o, pick(40), pick(50)) for o in range(150)]
    df = shuffled.createDataFrame(data, "o long, a string, b string").repartition(7)
    assert sorted(r.o for r in L.greedy_first_wins(df, ["a", "b"], "o").collect()) == greedy(data)


def test_first_seen_rejects(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "o long, id string")
    kept, rejected = L.rejects_by_first_seen(df, "id", "o")
    assert rows(kept.select("o")) == [(1,), (3,)]
    assert rows(rejected.select("o", "reason")) == [(2, "duplicate id"), (4, "duplicate id")]


# --- featured picks ----------------------------------------------------------------------------


def walk(passes):
    seen, out = set(), []
    for number, (data, cap) in enumerate(passes):
        count = {}
        for o, scene, key in sorted(data):
            if scene is None or key in seen or count.get(scene, 0) >= cap:
                continue
            seen.add(key)
            count[scene] = count.get(scene, 0) + 1
            out.append((number, scene, key, o))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_featured_equals_the_ordered_walk(spark, seed):
    rnd = random.Random(seed)
    scenes = ["s1", "s2", "s3"]
    make = lambda n, keys: [(o, rnd.choice([*scenes, None]), f"k{rnd.randint(0, keys)}") for o in range(n)]
    passes = [(make(200, 12), 4), (make(80, 12), 2), (make(60, 9), 1)]
    frames = [(spark.createDataFrame(d, "_ord long, scene string, key string").repartition(5), cap) for d, cap in passes]
    assert rows(G.featured(frames, scenes).select("pass", "scene", "key", "_ord")) == walk(passes)


# --- containment, stop rule -------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [{}, {"block_patterns": 4, "piece_texts": 7}, {"block_patterns": 1, "piece_texts": 1000}])
def test_containment_match_equals_the_scan(shuffled, sizes):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, n)))
    names = [(i, word(8)) for i in range(60)]
    titles = [(i, word(6), f"v{i}") for i in range(60)]
    n = shuffled.createDataFrame(names, "id int, name string")
    t = shuffled.createDataFrame(titles, "_ord int, title string, v string")
    got = {r.id: r.v for r in O.containment_match(n, t, name="name", title="title", value="v", order="_ord", **sizes).collect()}
    for i, name in names:
        a = name.lower().strip()
        hit = next((v for _, title, v in titles if (b := title.lower().strip()) and a and (a in b or b in a)), None)
        assert got[i] == hit, (name, got[i], hit)


@pytest.mark.parametrize("block_patterns", [20_000, 50])
def test_patterns_that_share_a_piece(spark, block_patterns):
    """A piece that stands in half of all names makes no pairs: only names that are found are counted."""
    from feedloom.operators import patterns as T

    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abcdéz😀") for _ in range(n))
    names = sorted({("common" if i % 2 else "") + word(rnd.randint(1, 5)) for i in range(600)})
    texts = sorted({word(rnd.randint(0, 9)) + rnd.choice(["common", "comm", "", rnd.choice(names)]) + word(rnd.randint(0, 6)) for _ in range(400)})
    n = spark.createDataFrame(list(zip(names, range(100, 1000))), "text string, number int")
    t = spark.createDataFrame(list(zip(texts, range(5000, 9000))), "text string, number int")
    held = [(100 + i, 5000 + j) for i, a in enumerate(names) for j, b in enumerate(texts) if a and a in b]
    for of, pairs in (("pattern", held), ("text", [(b, a) for a, b in held])):
        want = {}
        for key, value in pairs:
            want[key] = min(want.get(key, value), value)
        got = T.least_containment(n, t, of=of, block_patterns=block_patterns, piece_texts=90).collect()
        assert {r.number: r.least for r in got} == want and len(got) == len(want)
    assert T.least_containment(n, t.limit(0)).count() == 0 and T.least_containment(n.limit(0), t).count() == 0


@pytest.mark.parametrize("block", [3, 7, 1000])
def test_stop_rule_does_not_depend_on_the_blocks(spark, block):
    known = [0, 1, 1, 0, 1, 1, 1, 0, 0, 1, 1, 1, 1, 0, 1]
    feed = spark.createDataFrame(list(enumerate(known)), "pos long, k int")
    got = [r.pos for r in N.cut_after_known(feed, F.col("k") == 1, run=4, block=max(block, 3)).orderBy("pos").collect()]
    assert got == [0, 3, 7, 8]
    everything = N.cut_after_known(feed, F.col("k") == 1, run=5, block=7)
    assert everything.count() == known.count(0)


def test_shuffles_are_sized(spark):
    from feedloom.session import size_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffles(spark, 0) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert size_shuffles(spark, 100 * 2**40) == 204_800
    finally:
        spark.conf.unset(key)


def test_greedy_decides_a_long_chain_in_few_rounds(spark, monkeypatch):
    n = 10_000  # each row clashes with the one before it
    rows = spark.range(n).select(F.col("id").alias("o"), F.format_string("a%d", F.expr("(id + 1) div 2")).alias("a"),
                                 F.format_string("b%d", F.expr("id div 2")).alias("b"))
    rounds = []
    follow = L._follow
    monkeypatch.setattr(L, "_follow", lambda *a: rounds.append(1) or follow(*a))
    assert sorted(r.o for r in L.greedy_first_wins(rows, ["a", "b"], "o").collect()) == list(range(0, n, 2))
    assert len(rounds) <= 2
