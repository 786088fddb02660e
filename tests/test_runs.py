"""Whole runs: the catalog from feeds, and the stream against the batch ledger."""

import shutil

import pytest
from pyspark.sql import functions as F

from frames_as_rows import rows
from feedloom.operators import state as N
from feedloom.plans import catalog as P
from feedloom.sources.tables import ENTRY_DDL, empty_frame, entry_schema
from feedloom.sources import versions
from feedloom.sources.keyed import KeyedTable
from feedloom.streaming import ledger as S

FOLDER = "/root/testdata/sf0.001"


def entries(spark, *dicts):
    names = entry_schema().fieldNames()
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in dicts], ENTRY_DDL)


def e(id, type_="skill", url="", **more):
    base = {"name": id, "description": f"about {id}", "category": "backend", "tags": [], "tech_stack": [], "install": {"method": "manual"}, "source": "s", "last_synced": "2024-01-01"}
    return {"id": id, "type": type_, "source_url": url, **base, **more}


def positioned(df):
    return df.withColumn("_pos", F.monotonically_increasing_id())


def test_merge_run(spark):
    tree = "https://github.com/anthropics/skills/tree/main/skills/"
    main = entries(
        spark,
        e("s1", url="https://github.com/sickn33/antigravity-awesome-skills/tree/main/skills/foo", tags=["mirror"]),
        e("s1b", url=tree + "foo", tags=["own"], pushed_at=None),
        e("r1", "rule", "https://github.com/x/rules"), e("r2", "rule", "https://github.com/x/rules"),
        e("m1", "mcp", "https://github.com/o/r", category="odd", description="a postgres server"),
        e("p1", "plugin", "https://github.com/o/plug", install={"method": "x", "marketplace_repo": "o/plug", "plugin_name": "plug", "marketplace_verified": True}, bundle={"skills_namespaces": ["plug:foo", "plug:none"]}),
        e("p2", "plugin", "https://github.com/o/plug", install={"method": "x"}),
    )
    side = entries(
        spark,
        e("m9", "mcp", "https://registry.modelcontextprotocol.io/v0/servers/io.github.o%2Fr", mcp_registry_status="active", mcp_registry_published_at="2024-01-05T00:00:00Z"),
        e("dup", url="https://GitHub.com/q/z.git"), e("dup2", url="https://github.com/q/z"),
    )
    curated = entries(spark, e("s1b", tags=["best"], tech_stack=["python"]), e("new", url="https://github.com/n/n"))
    previous = entries(spark, e("s1b", url=tree + "foo", added_at="2023-01-01", pushed_at="2023-12-01T00:00:00Z"), e("zz", "mcp", "https://github.com/o/r", added_at="2022-02-02"))
    cur = curated.withColumn("_ord", F.struct(F.lit(2).alias("tier"), F.monotonically_increasing_id().alias("pos")))
    merged = P.merge([(positioned(main), "_pos"), (positioned(side), "_pos")], cur.withColumn("_pos", F.lit(0).cast("long")), previous, "2024-02-01")
    got = {r.id: r for r in merged.entries.collect()}
    # the official address beats the mirror; rules share an address; the repository address beats the registry's
    assert set(got) == {"s1b", "r1", "r2", "m1", "p1", "dup", "new"}
    assert got["s1b"].tags == ["own", "best"] and got["s1b"].tech_stack == ["python"]
    assert got["s1b"].added_at == "2023-01-01" and got["s1b"].pushed_at == "2023-12-01T00:00:00Z"
    assert got["m1"].category == "backend" or got["m1"].category == "database"
    assert got["m1"].mcp_registry_status == "active" and got["m1"].pushed_at == "2024-01-05T00:00:00Z" and got["m1"].added_at == "2022-02-02"
    assert got["new"].added_at == "2024-02-01" and got["r1"].added_at is None
    linked = {r.id: r.bundled_in for r in P.link_bundles(merged.entries).collect()}
    assert linked["s1b"] == "p1" and linked["dup"] is None
    report = {r.type: (r.n_before, r.n_after) for r in merged.report.collect()}
    assert report["skill"] == (4, 2) and report["mcp"] == (2, 1)

    results = spark.createDataFrame([("s1b", 90.0, 5), ("m1", 10.0, 5)], "id string, quality double, relevance int")
    scored = {r.id: r for r in P.score(P.link_bundles(merged.entries), results, "2024-02-01").collect()}
    assert scored["s1b"].decision == "accept" and scored["m1"].decision == "reject"
    assert scored["dup"].final_score == scored["dup"].health_weighted


def test_featured_picks(spark):
    made = [e(f"m{i}", "mcp", f"https://github.com/o/r{i // 2}", stars=i, name=f"react tool {i}") for i in range(1, 14)]
    made += [e("z", "mcp", "https://github.com/o/zero", stars=0, name="react zero"), e("git", "mcp", "https://x.y/git", stars=3, name="git thing")]
    made += [e("s1", name="react a", source="other"), e("s2", name="react b", source="curated"), e("s3", name="react c", source="curated"), e("s4", name="React B", source="curated")]
    made += [e("r1", "rule", name="react b"), e("r2", "rule", name="react r", tags=["css"]), e("p1", "prompt", name="zzz words", category="database"), e("p2", "prompt", name="zzz other", category="testing")]
    table = entries(spark, *made).withColumn("_ord", F.struct(F.lit(0).alias("tier"), F.monotonically_increasing_id().alias("pos"))).withColumn("bundled_in", F.lit(None).cast("string"))
    got = sorted((r["pass"], r.scene, r.id) for r in P.featured_picks(table).collect())
    assert got == [
        (0, "frontend", "m11"), (0, "frontend", "m13"), (0, "frontend", "m7"), (0, "frontend", "m9"), (0, "git", "git"),
        (1, "frontend", "s3"), (1, "frontend", "s4"), (2, "frontend", "r2"), (3, "backend", "p1"),
    ]


def test_answers_to_scores(spark):
    import json

    from feedloom.plans import evaluation as E

    full = {d: {"score": 4} for d in ("coding_relevance", "doc_completeness", "desc_accuracy", "writing_quality", "specificity", "install_clarity")}
    rule = {k: v for k, v in full.items() if k != "install_clarity"}
    data = [
        ("a", "skill", "Here:\n```json\n" + json.dumps({"metrics": {**full, "specificity": {"score": 9}}, "enrichment": {"tags": [" X "], "summary": "s" * 200}}) + "\n```"),
        ("b", "rule", json.dumps({"metrics": rule})), ("c", "skill", json.dumps({"metrics": rule})), ("d", "mcp", "no answer"),
        ("e", "mcp", "well " + json.dumps({"metrics": full, "mcp_installability": {"mcp_install_state": "ready", "mcp_validation_tags": ["t", "t"]}})),
    ]
    parsed = E.parse_answers(spark.createDataFrame(data, "entry_id string, type string, text string"))
    got = {r.entry_id: r for r in parsed.collect()}
    assert {k: r.accepted for k, r in got.items()} == {"a": True, "b": True, "c": False, "d": False, "e": True}
    assert abs(got["a"].quality - (80 * 0.85 + 100 * 0.15)) < 1e-9 and got["b"].quality == 80.0 and got["c"].quality is None
    assert got["a"].enrichment.tags == ["x"] and len(got["a"].enrichment.summary) == 150 and got["b"].enrichment is None
    assert got["d"].installability.state == "unknown" and got["e"].installability.tags == ["t"] and got["a"].installability is None
    assert got["a"].relevance == 4 and rows(E.skipped(parsed).select("entry_id")) == [("c",), ("d",)]


def test_results_fall_back(spark, tmp_path):
    cols = "id string, type string, tags array<string>, tech_stack array<string>, description string, description_zh string, final_score double, decision string"
    row = lambda i, t="skill": (i, t, ["own"], [], f"about {i}", None, None, None)
    entries_ = spark.createDataFrame([row("a"), row("b"), row("c", "mcp"), row("d")], cols)
    result = (
        "a", {"x": (4,)}, (["new"], None, "short", None), (90.0, 50.0, 40.0), 71.5, "accept", None,
    )
    results = spark.createDataFrame([result], "entry_id string, metrics map<string,struct<score:int>>, enrichment struct<tags:array<string>,tech_stack:array<string>,summary:string,summary_zh:string>, "
        "health struct<freshness:double,popularity:double,source_trust:double>, final_score double, decision string, installability struct<state:string,tags:array<string>>")
    previous = spark.createDataFrame([("a", 10.0, "reject", "zh a", "old a", "was a", 5), ("b", 55.0, "review", "zh b", "old b", "was b", 44), ("d", None, None, None, "old d", None, 33)],
        "id string, final_score double, decision string, description_zh string, description string, description_original string, health_mean int")
    cells = spark.createDataFrame([("skill", True, 1, 0)], "type string, present boolean, failed bigint, quarantined bigint")
    done, status = P.apply_results(entries_, results, previous, cells)
    got = {r.id: (r.provenance, r.final_score, r.decision, r.description, r.description_zh, r.tags, r.health_mean) for r in done.collect()}
    assert got == {
        "a": ("new", 72.0, "accept", "short", None, ["new"], 60), "b": ("old", 55.0, "review", "old b", "zh b", ["own"], 44),
        "c": ("synth", 0.0, "review", "about c", None, ["own"], None), "d": ("synth", 0.0, "review", "about d", None, ["own"], 33),
    }
    assert {r.type: (r.succeeded, r.fallback_old, r.fallback_synth, r.status) for r in status.collect()} == {"skill": (1, 1, 1, "partial"), "mcp": (0, 0, 1, "failed")}
    out = str(tmp_path / "pub")
    table = done.withColumns({"name": F.col("id"), "stars": F.lit(1), "_ord": F.col("id"), "source": F.lit("s"), "bundled_in": F.lit(None).cast("string")})
    assert P.published(spark, out) is None
    assert P.publish(table, out, "v1") and P.publish(table.limit(0), out, "v1")
    folder = P.published(spark, out)
    assert spark.read.json(f"{folder}/search").count() == 4 and spark.read.json(f"{folder}/entries").count() == 4
    assert [r.id for r in spark.read.json(f"{folder}/types/type=skill").collect()][0] == "a"
    assert not P.publish(table.limit(0), out, "v2") and P.published(spark, out) == folder
    assert P.publish(table.filter("id = 'a'"), out, "v2") and spark.read.json(f"{P.published(spark, out)}/search").count() == 1
    assert N.drop_versions(spark, out) == ["v1"] and spark.read.json(f"{P.published(spark, out)}/search").count() == 1


def test_merge_does_not_depend_on_partitions(spark):
    base = entries(spark, *[e(f"i{i % 40}", "mcp" if i % 3 else "skill", f"https://github.com/o/r{i % 25}", stars=i) for i in range(120)])
    base = base.withColumn("_pos", F.col("stars"))
    none = empty_frame(spark, ENTRY_DDL)
    cur = none.withColumn("_pos", F.lit(0).cast("long")).withColumn("_ord", F.struct(F.lit(2).alias("tier"), F.lit(0).cast("long").alias("pos")))
    results = []
    for n in (1, 4, 64):
        out = P.merge([(base.repartition(n, "stars"), "_pos")], cur, none, "2024-02-01").entries
        results.append(rows(out.select("id", "type", "source_url", "stars")))
    assert results[0] == results[1] == results[2] and results[0]


def test_evaluation_paths(spark):
    base = entries(spark, *[e(i, skills_sh_url=f"https://skills.sh/o/r/{i}") for i in "abcdef"], e("g"))
    ledger = spark.createDataFrame([("a", 4, None), ("b", 2, "2024-03-01")], "entry_id string, attempt_count int, next_retry_after string")
    done = spark.createDataFrame([("c",)], "entry_id string")
    cache = spark.createDataFrame([("d", "2024-12-01"), ("e", "2024-01-01"), ("f", "2024-12-01"), ("g", "2024-12-01")], "entry_id string, expires_at string").withColumn("expires_at", F.to_timestamp("expires_at"))
    unstable = spark.createDataFrame([("f-o-r",)], "id string")
    got = {r.id: r.path for r in P.evaluate_plan(base, ledger, done, cache, unstable, "2024-02-01").collect()}
    assert got == {"a": "quarantined", "b": "deferred", "c": "completed", "d": "reuse", "e": "evaluate", "f": "evaluate", "g": "evaluate"}


def test_stream_equals_batch(spark, tmp_path):
    from feedloom.plans.queries.selection import outcomes
    from feedloom.plans.registry import Tables

    S.use_state_store(spark)
    all_ = outcomes(Tables(spark, FOLDER))
    folder, base, other = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "other")
    # three files in the order of event time, as a stream would bring them
    cuts = ["2024-01-01", "2024-01-10", "2024-01-20", "2024-02-10"]
    parts = []
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = all_.filter((F.col("ts") >= F.to_timestamp(F.lit(lo))) & (F.col("ts") < F.to_timestamp(F.lit(hi))))
        target = tmp_path / f"part{i}"
        part.coalesce(1).write.parquet(str(target))
        parts.append(target)
    folder.mkdir()
    for i, p in enumerate(parts):
        shutil.copy(next(p.glob("*.parquet")), folder / f"{i}.parquet")
        stream = spark.readStream.schema(all_.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        q = (
            S.ledger_stream(stream, delay="60 days").writeStream.outputMode("update").foreachBatch(S.upsert_ledger(base))
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        )
        q.awaitTermination()
        raw = stream.writeStream.foreachBatch(S.merge_outcomes(other)).option("checkpointLocation", str(tmp_path / "ck2"))
        raw.trigger(availableNow=True).start().awaitTermination()
    batch = N.ledger_update(empty_frame(spark, N.LEDGER_SCHEMA), all_)
    streamed = S.ledger_table(spark, base).read()
    assert rows(streamed.select(batch.columns)) == rows(batch)
    assert rows(S.ledger_table(spark, other).read().select(batch.columns)) == rows(batch)
    assert batch.count() > 0


def test_a_lost_write_changes_nothing(spark, tmp_path):
    folder, ddl = str(tmp_path / "state"), "id int"
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], ddl)
    N.write_state(frame(1), folder, "v1")
    frame(9).write.parquet(f"{folder}/v2")  # data without a line in the log: the run was lost
    assert rows(N.read_state(spark, folder, ddl)) == [(1,)]
    N.write_state(frame(2), folder, "v2")
    N.write_state(frame(7), folder, "v2")  # run again after it was done
    assert rows(N.read_state(spark, folder, ddl)) == [(2,)]
    assert N.current_state(spark, folder) == (2, "v2")


def test_two_writers_of_a_state(spark, tmp_path):
    folder, ddl = str(tmp_path / "state"), "id int"
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], ddl)
    N.write_state(frame(1), folder, "v1")
    # both have read version 1; the second one gets to know
    N.write_state(frame(1, 2), folder, "a", after=1)
    with pytest.raises(N.StateConflict):
        N.write_state(frame(1, 3), folder, "b", after=1)
    assert N.current_state(spark, folder) == (2, "a")
    # asked again with what is there then
    seen = []

    def add(old):
        if not seen:
            N.write_state(frame(1, 2, 4), folder, "c")  # another run in between
        seen.append(old.count())
        return old.unionByName(frame(3))

    N.update_state(spark, folder, "d", ddl, add)
    assert rows(N.read_state(spark, folder, ddl)) == [(1,), (2,), (3,), (4,)] and len(seen) == 2
    # of two that only name a version none is lost
    N.point_to(spark, folder, "a")
    N.point_to(spark, folder, "d")
    assert [versions.entry(spark, folder, n)["version"] for n in versions.entries(spark, folder)] == ["v1", "a", "c", "d", "a", "d"]
    assert not versions.commit(spark, folder, 3, {"version": "late"}) and versions.entry(spark, folder, 3) == {"version": "c"}


def buckets_of(folder):
    return {p.relative_to(folder).as_posix() for p in folder.glob("data/_bucket=*/_version=*/*.parquet")}


def exchanges(df):
    import re

    return len(re.findall(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()))


def test_keyed_table_writes_what_it_touches(shuffled, tmp_path):
    spark, folder = shuffled, tmp_path / "cache"
    ddl = "k string, n int, x string"
    table = KeyedTable(spark, str(folder), ddl, ["k"], buckets=16)
    assert table.read().count() == 0
    many = spark.range(1000).selectExpr("cast(id as string) k", "1 n", "'old' x")
    table.upsert(many, name="first", writer="w")
    before = buckets_of(folder)
    assert len(before) == 16 and rows(table.read()) == rows(many)
    ten = spark.createDataFrame([(str(i * 3), 5 + i, "new") for i in range(5)] + [("fresh", 1, "new")], ddl)
    table.upsert(ten, name="second", writer="w")
    new = buckets_of(folder) - before
    assert 1 <= len(new) <= 6 and before <= buckets_of(folder)
    want = dict.fromkeys((str(i) for i in range(1000)), (1, "old")) | {r.k: (r.n, r.x) for r in ten.collect()}
    assert {r.k: (r.n, r.x) for r in table.read().collect()} == want
    assert table.upsert(ten, name="second", writer="w").number == 2  # run again after it was done
    # order: the larger n stays
    table.upsert(spark.createDataFrame([("0", 2, "low"), ("1", 9, "high")], ddl), order=[F.desc("n")])
    assert {r.k: r.x for r in table.read().filter("k in ('0', '1')").collect()} == {"0": "new", "1": "high"}
    # the table's side is not shuffled, nor is either of two tables
    again = KeyedTable(spark, str(folder), ddl, ["k"])
    assert again.buckets == 16 and rows(again.read()) == rows(table.read())
    asked = spark.range(50).selectExpr("cast(id as string) k")
    assert exchanges(asked.join(table.read(), "k", "left")) == 1
    other = KeyedTable(spark, str(tmp_path / "other"), ddl, ["k"], buckets=16)
    other.replace(many)
    assert exchanges(table.read().join(other.read(), "k", "full_outer")) == 0
    assert exchanges(table.read().groupBy("k").count()) == 0
    # cleared keys, and states before
    first = table.head()
    table.change(ten, lambda old, new: old.join(new.select("k"), "k", "left_anti"))
    assert table.read().count() == 995 and table.read(first).count() == 1001
    assert table.drop_old() > 0 and table.read().count() == 995
    table.replace(many.limit(0))
    assert table.read().count() == 0


def test_cache_and_snapshots_are_read_in_their_buckets(shuffled, tmp_path):
    from feedloom.operators import overlay as O

    spark = shuffled
    cache = KeyedTable(spark, str(tmp_path / "cache"), "cache_key string, score int, expires_at timestamp", ["cache_key"], buckets=8)
    cache.replace(spark.range(100).selectExpr("cast(id as string) cache_key", "cast(id as int) score", "if(id % 2 = 0, timestamp'2024-03-01', null) expires_at"))
    asked = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then '7' when id % 3 = 1 then null else cast(id as string) end cache_key")
    out = O.split_by_cache(asked, cache, "2024-02-01")
    assert exchanges(out) == 1
    hot = O.split_by_cache(asked, cache, "2024-02-01", min_rows=500)  # the hot key and the rows without one are not shuffled
    want = sorted((r.id, None if r.id % 3 == 1 else 7 if r.id % 3 == 0 else r.id if r.id < 100 else None) for r in asked.collect())
    for got in (out, hot):
        assert sorted((r.id, r.score) for r in got.collect()) == want
        assert all(r.hit == (r.score is not None) for r in got.collect())
    snap = KeyedTable(spark, str(tmp_path / "snap"), "id bigint, status string, version string", ["id"], buckets=8)
    day = lambda lo, hi, v: spark.range(lo, hi).selectExpr("id", "if(id % 5 = 0, 'x', 'y') status", f"if(id % 7 = 0, '{v}', '1') version")
    first = N.rotate_keyed(day(0, 90, "1"), snap, "v1", fallback=day(0, 0, "1"))
    assert first.count() == 0
    diff = O.ordered_diff(N.rotate_keyed(day(10, 100, "2"), snap, "v2"), snap.read(), {"status": "status_changed", "version": "version_bumped"})
    assert exchanges(diff) == 0
    plain = O.ordered_diff(day(0, 90, "1"), day(10, 100, "2"), {"status": "status_changed", "version": "version_bumped"})
    assert rows(diff) == rows(plain)
    drift = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "id * 10 install_count")
    one, two = (KeyedTable(spark, str(tmp_path / n), "id bigint, install_count bigint", ["id"], buckets=8) for n in "ab")
    one.replace(drift(0, 50)), two.replace(drift(20, 70))
    assert exchanges(O.drift_diff(one.read(), two.read())) == 0
    assert rows(O.drift_diff(one.read(), two.read())) == rows(O.drift_diff(drift(0, 50), drift(20, 70)))


def test_keyed_table_with_two_writers(spark, tmp_path):
    ddl = "k int, n int"
    table = KeyedTable(spark, str(tmp_path / "t"), ddl, ["k"], buckets=8)
    other = KeyedTable(spark, str(tmp_path / "t"), ddl, ["k"], buckets=8)
    frame = lambda *rows_: spark.createDataFrame(rows_, ddl)
    table.replace(frame(*[(i, 0) for i in range(50)]))
    at = {r.k: r.b for r in spark.range(50).selectExpr("cast(id as int) k").select("k", table.bucket().alias("b")).collect()}
    far = next(k for k in at if at[k] != at[0])
    asked = []

    def meanwhile(key):
        def fn(old, new):
            asked.append(key)
            if len(asked) == 1:  # another run writes between the read and the commit
                other.upsert(frame((key, 7)))
            return old.join(new.select("k"), "k", "left_anti").unionByName(new)
        return fn

    table.change(frame((0, 1)), meanwhile(far))  # another bucket: both get through at once
    assert len(asked) == 1 and {r.k: r.n for r in table.read().filter("n > 0").collect()} == {0: 1, far: 7}
    asked.clear()
    same = next(k for k in at if k and at[k] == at[0])
    table.change(frame((0, 2)), meanwhile(same))  # the same bucket: asked again
    assert len(asked) == 2 and {r.k: r.n for r in table.read().filter("n > 0").collect()} == {0: 2, far: 7, same: 7}
    assert table.read().count() == 50


def test_stream_state_is_cleared_and_forgotten(spark, tmp_path):
    from datetime import datetime, timedelta

    S.use_state_store(spark)
    ddl = "type string, rubric_version string, entry_id string, ok boolean, ts timestamp, event_id long, error_kind string"
    folder, base = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()
    day = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    row = lambda e, ok, d: ("skill", "1", e, ok, day(d), d, None if ok else "timeout")
    batches = [
        [row("a", False, 1), row("a", False, 2), row("b", False, 1), row("c", False, 2)],
        [row("a", True, 4), row("c", False, 20)],
        [row("d", False, 40)],
        [row("d", False, 41)],
    ]
    found = []
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, ddl).coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        shutil.copy(next((tmp_path / f"p{i}").glob("*.parquet")), folder / f"{i}.parquet")
        stream = spark.readStream.schema(ddl).parquet(str(folder))
        S.ledger_stream(stream, delay="1 day", forget=timedelta(days=30)).writeStream.outputMode("update").foreachBatch(
            S.upsert_ledger(base, 4)).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        found.append({r.entry_id: r.attempt_count for r in S.ledger_table(spark, base).read().collect()})
    assert found[0] == {"a": 2, "b": 1, "c": 1} and found[1] == {"b": 1, "c": 2}
    assert found[-1] == {"c": 2, "d": 2}  # b had nothing for 30 days
    state = spark.read.format("statestore").option("stateVarName", "failures").load(str(tmp_path / "ck"))
    assert sorted(r.key.entry_id for r in state.collect()) == ["c", "d"]
