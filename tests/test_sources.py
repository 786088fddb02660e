"""Readers and writers on files, and parsers on hand-made texts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from frames_as_rows import rows
from feedloom.operators import report as R, state as N
from feedloom.sources import arrays, feeds as D, html as W, markdown as M, tables as A, tree as T


def write(path, obj):
    path.write_text(obj if isinstance(obj, str) else json.dumps(obj), encoding="utf-8")
    return str(path)


def test_json_table_never_fails(spark, tmp_path):
    ddl = "id string, stars bigint, tags array<string>"
    good = write(tmp_path / "a.json", [{"id": "a", "stars": 3, "tags": ["x"], "unknown": 1}, {"id": "b"}])
    assert rows(A.read_json_table(spark, good, ddl).select("id", "stars")) == [("a", 3), ("b", None)]
    assert A.read_json_table(spark, str(tmp_path / "none.json"), ddl).count() == 0
    assert A.read_json_table(spark, write(tmp_path / "bad.json", "[{"), ddl).count() == 0


def random_value(rng, depth=0):
    some = lambda: "".join(rng.choice('ab{}[]"\\,: \n}é😀') for _ in range(rng.randrange(12)))
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 4:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind > 4:
        return {some(): random_value(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [some(), rng.randrange(1000), rng.choice([None, True, False, 1.5e3]), some() * 3][kind]


@pytest.mark.parametrize("size", ["128m", "41", "5000"])
def test_arrays_in_ranges(spark, tmp_path, size):
    rng, files = random.Random(3), {}

    def put(name, objects, text):
        files[name] = objects
        (tmp_path / f"{name}.json").write_text(text)

    for i in range(6):
        items = [random_value(rng) if rng.random() < 0.1 else {"k": random_value(rng), "n": j} for j in range(rng.randrange(40))]
        put(f"a{i}", [x for x in items if isinstance(x, dict)], json.dumps(items, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5))
    rows_ = [{"a": i} for i in range(50)]
    put("object", [{"x": {"y": "}"}}], '{"x": {"y": "}"}}')
    put("lines", rows_, "\n".join(map(json.dumps, rows_)))
    put("blank", [], ""), put("none", [], "[]"), put("cut", [], "[{"), put("open", [], json.dumps(rows_)[:-1]), put("closed", [], json.dumps(rows_) + "]")
    put("within", [{"b": 1}], json.dumps([[{"a": 1}, {"c": 2}], {"b": 1}, [[]]]))
    wide = [{"id": 0, "m": {str(i): {"z": i} for i in range(400)}}, {"id": 1}]
    put("wide", wide, json.dumps(wide))
    if size != "41":
        big = [{"id": i, "t": "}" * rng.randrange(3) + "x" * rng.randrange(40), "o": {"p": {"q": [i]}}} for i in range(3000)]
        put("big", big, json.dumps(big))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        found = arrays.read_objects(spark, str(tmp_path)).collect()
        tasks = spark.read.text(str(tmp_path), lineSep="}").select(F.spark_partition_id()).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {}
    for r in sorted(found, key=lambda r: (r.file, r.number)):
        got.setdefault(r.file.rsplit("/", 1)[1][:-5], []).append((r.number, json.loads(r.body)))
    assert {n: [x for _, x in got.get(n, [])] for n in files} == files
    assert all([i for i, _ in v] == list(range(len(v))) for v in got.values())
    assert size == "128m" or tasks > 20


def test_a_lost_sink_leaves_the_old_table(spark, tmp_path):
    out, ddl = str(tmp_path / "out"), "id int"
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], ddl)
    A.write_json_arrays(frame(1, 2), out, version="a")

    def dies(batches):
        for batch in batches:
            yield batch
            raise RuntimeError("lost")

    with pytest.raises(Exception):
        A.write_json_arrays(frame(3).mapInArrow(dies, ddl), out, version="b")
    assert rows(A.read_json_table(spark, out, ddl)) == [(1,), (2,)]
    A.write_json_arrays(frame(3), out, version="b")
    A.write_json_arrays(frame(4), out, version="b")  # run again after it was done
    assert rows(A.read_json_table(spark, out, ddl)) == [(3,)]


@pytest.mark.parametrize("array_file", [True, False])
def test_unknown_keys_are_kept(spark, tmp_path, array_file):
    data = [{"id": "a", "odd": {"x": 1}}, {"id": "b"}]
    text = json.dumps(data) if array_file else "\n".join(map(json.dumps, data)) + "\n{bad"
    path = write(tmp_path / "f.json", text)
    got = A.read_json_table(spark, path, "id string", array_file=array_file, extras="more")
    assert rows(got.select("id", F.try_variant_get("more", "$.odd.x", "int"))) == [("a", 1), ("b", None)]
    assert A.read_json_table(spark, path + "-none", "id string", array_file=array_file, extras="more").count() == 0


def test_declared_tables_parse(spark):
    for ddl in (A.ENTRY_DDL, A.EVAL_RESULT_DDL, A.CACHE_DDL, A.COMPLETED_DDL, A.DIFF_DDL, A.REPO_FILE_DDL, A.QUEUE_DDL, N.LEDGER_SCHEMA):
        assert A.empty_frame(spark, ddl).count() == 0


def test_json_sink_keeps_the_order(spark, tmp_path):
    df = spark.range(100).withColumn("v", 100 - F.col("id")).repartition(7)
    out = str(tmp_path / "out")
    A.write_json(df, out, ["v"])
    values = [json.loads(line)["v"] for f in sorted(tmp_path.glob("out/*.json")) for line in f.read_text().splitlines()]
    assert values == sorted(values) and len(values) == 100


def test_prompts_csv_with_long_quoted_fields(spark, tmp_path):
    long = "code " + "x" * 60_000
    text = f'act,prompt,for_devs\r\nLinux Terminal,"line one\nline ""two""",FALSE\r\nPoet,"rhymes only",FALSE\r\nCook,"nothing",TRUE\r\nBig,"{long}",FALSE\r\n,"code",TRUE\r\n'
    got = D.prompt_entries(D.read_prompts(spark, write(tmp_path / "p.csv", text)))
    assert rows(got.select("id")) == [("big-prompt",), ("cook-prompt",), ("linux-terminal-prompt",)]
    one = got.filter("id = 'linux-terminal-prompt'").first()
    assert one.description == 'line one line "two"'
    assert got.filter("id = 'cook-prompt'").first().tags == ["for-devs"]
    assert got.filter("id = 'big-prompt'").select(F.length("prompt")).first()[0] == len(long)


def test_registry_pages(spark, tmp_path):
    server = lambda name, **more: {"server": {"name": name, "version": "1", **more}, "_meta": {"k": {"status": "active", "isLatest": True, "publishedAt": "t"}}}
    old = server("com.x/old")
    old["_meta"]["k"]["isLatest"] = False
    pages = [
        {"servers": [server("io.github.a/b", repository={"source": "github", "url": "https://github.com/a/b/", "subfolder": "x"}), old]},
        {"servers": [server("com.x/y z", title="T", packages=[{"registryType": "PyPI", "identifier": "p", "version": "2"}], remotes=[{"type": "sse"}, {}]), {"server": {"name": "n"}}]},
    ]
    frame = A.read_json_table(spark, write(tmp_path / "pages.json", pages), D.REGISTRY_DDL)
    e = D.active_entries(D.registry_entries(D.registry_rows(frame, "k"), "https://reg/v0", "2024-01-01"))
    got = {r.name: (r.source_url, r.install.command, [tuple(x) for x in r.mcp_remotes]) for r in e.collect()}
    assert got == {
        "io.github.a/b": ("https://github.com/a/b/tree/HEAD/x", None, []),
        "T": ("https://reg/v0/com.x%2Fy%20z", "pipx run p==2", [("sse", "")]),
    }


def test_bullets_and_skipped_headings(spark):
    text = "# T\n- **[no](https://github.com/a/b)** - top\n## Sponsors\n- **[s](u)** - x\n### Data\n- **[n1](https://github.com/a/c)** — one\n* other\n- **[n2](u2)** – two\n"
    df = spark.createDataFrame([(1, text)], "doc int, text string")
    got = rows(M.bullets(df, "text", ["doc"]).select("category", "name", "url", "description"))
    assert got == [("", "no", "https://github.com/a/b", "top"), ("Data", "n1", "https://github.com/a/c", "one"), ("Data", "n2", "u2", "two")]


def test_records_keep_the_last_one(spark):
    text = "## Other\n### x\nno\n## My 编程 part\nintro\n### One\na\n\nb\n### Two\nc\n## End\n### y\nno"
    df = spark.createDataFrame([(1, text)], "doc int, text string")
    got = rows(M.records(df, "text", ["doc"], within="编程", record=r"###\s+(.+)").select("name", "content"))
    assert got == [("One", "a\n\nb"), ("Two", "c")]


def test_section_by_anchor(spark):
    docs = spark.createDataFrame([(1, "## Foo & Bar\nfirst\n## Foo - Bar\nsecond\n## Foo & Bar\nthird")], "doc int, text string")
    wanted = spark.createDataFrame([(1, "foo--bar"), (1, "foo---bar"), (1, "none")], "doc int, slug string")
    assert rows(M.section_by_anchor(docs, wanted, key="doc", text="text")) == [(1, "foo---bar", "## Foo - Bar\nsecond"), (1, "foo--bar", "## Foo & Bar\nfirst")]


def test_skill_front_matter(spark):
    data = [
        ("a/one", '---\nname: "N"\ndescription: >\n  Folded text\ntags: [x, \'y z\']\n---\nbody'), ("a/two", "---\ndescription: d\n---\n"),
        ("a/three", "---\nname: n\n---\n"), ("a/four", "no front"),
    ]
    df = spark.createDataFrame(data, "dir string, text string")
    got = {r.dir: (r.name, r.description, r.tags) for r in M.skill_texts(df, "text", "dir", ["dir"]).collect()}
    assert got == {"a/one": ("N", "Folded text", ["x", "y z"]), "a/two": ("two", "d", [])}


@pytest.mark.parametrize("body,want", [
    ("# Title\nprose\n```js\ncode one\ncode two\n```\nafter", "Title: code one\ncode two"), ("plain\n![img](x)\n[link](y)\nmore", "plain more"),
    ("# Only", "Only"), ("", ""), ("text\n```\nopen code", "text"), ("```\n```\n```\nsecond\n```", "second"), ("# A\n# B\nx", "A: # B x"),
])
def test_body_description(spark, body, want):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(M.body_description("b").alias("d")).first().d == want


def test_rule_files(spark):
    files = spark.createDataFrame(
        [("r", "rules/global_rules/my-rule/x.md", "---\ntags: a, B\n---\nuse react"), ("r", "rules/top.md", "python text"), ("r", "docs/x.md", "no"), ("q", "rules/a_b/c.MD", "# T\nsql")],
        "repo string, path string, text string",
    )
    repos = spark.createDataFrame([("r", "2024", 5)], "repo string, pushed_at string, stars int")
    got = {r.id: (r.name, r.category, r.tags, r.stars) for r in M.rule_files(files, repos, suffix="-w").collect()}
    assert got == {
        "my-rule-w": ("My Rule (Windsurf Global)", "tooling", ["a", "b", "react", "windsurf-global", "windsurf"], 5),
        "top-w": ("Top (Windsurf)", "backend", ["python", "windsurf"], 5), "a-b-w": ("A B (Windsurf)", "database", ["windsurf"], None),
    }


def test_visible_text_ignores_void_tags(spark):
    page = '<head><meta charset="x"><title>no</title></head><body><link rel="a"><p>One  two</p><script>x("</p>")</script>three</body>'
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    assert rows(W.visible_text(df, "html", "id")) == [(1, "One two three"), (2, None)]


def test_marketplace_sources(spark):
    shapes = ['"./plugins/foo"', '"github:o/r"', '"git+https://g/x"', '"https://h/y"', '{"source": "github", "repo": "a/b"}', '{"url": "./sub"}', None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "i int, s string").withColumn("v", F.try_parse_json("s"))
    got = [r.u for r in df.select("i", D.source_address(F.col("v"), F.lit("m/p"), F.lit("main")).alias("u")).orderBy("i").collect()]
    own = "https://github.com/m/p"
    assert got == [f"{own}/tree/main/plugins/foo", "https://github.com/o/r", "https://g/x", "https://h/y", "https://github.com/a/b", f"{own}/tree/main/sub", own]


def test_community_rows(spark):
    rows_ = [("u1", "ns", "A", "9000"), ("u1", "ns", "B", "9000"), (None, "ns", "C", "5000"), (None, "ns", "C", "6000"), ("u2", "ns", "D", "4999"), ("u3", "ns", "E", "many"), ("u4", "x", " ", "9000")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows_)], "uid string, namespace string, name string, stars string, _ord int")
    assert rows(D.community_entries(df).select("id")) == [("ns-a",), ("ns-c",)]


def test_layouts(spark):
    paths = [".claude-plugin/plugin.json", "skills/a/SKILL.md", "agents/x.md", ".agents/y.md", ".github/agents/z.md", "sub/.claude-plugin/plugin.json", "sub/skills/b/SKILL.md", ".hid/p/.claude-plugin/plugin.json", "commands/c.md", "README.md"]
    market = [f"plugins/p{i}/.claude-plugin/plugin.json" for i in range(5)] + [".claude-plugin/plugin.json", "skills/q/SKILL.md"]
    four = market[1:5] + market[5:]
    files = spark.createDataFrame([("r", p) for p in paths] + [("m", p) for p in market] + [("f", p) for p in four] + [("n", "plugins/x/a.md")], "repo string, path string")
    targets = spark.createDataFrame([("r", ""), ("r", "sub"), ("m", ""), ("f", ""), ("n", ""), ("r", "none")], "repo string, root string")
    got = {(r.repo, r.root): (r.is_plugin, r.is_marketplace, r.skills, r.agents, r.commands) for r in T.layouts(files, targets).collect()}
    assert got == {
        ("r", ""): (True, False, 1, 2, 1), ("r", "sub"): (True, False, 1, 0, 0), ("m", ""): (True, True, 0, 0, 0), ("f", ""): (True, False, 1, 0, 0),
        ("n", ""): (False, True, 0, 0, 0), ("r", "none"): (False, False, 0, 0, 0),
    }


def test_hooks_and_servers(spark):
    data = [(1, '{"hooks": {"b": [1, 2], "a": [{}], "c": "x"}}', '{"mcpServers": {"z": {}}}', '{"mcpServers": {"y": {}}}'), (2, "{bad", '{"mcpServers": "./f"}', '{"q": {}}'), (3, None, None, None)]
    df = spark.createDataFrame(data, "id int, h string, m string, s string")
    got = {r.id: (r.h.events, r.h.entries, r.n) for r in df.select("id", T.hook_facts("h").alias("h"), T.server_names("m", "s").alias("n")).collect()}
    assert got == {1: (["a", "b"], 3, ["y", "z"]), 2: ([], 0, ["q"]), 3: ([], 0, [])}


def test_artifacts_and_status(spark, tmp_path):
    folder = tmp_path / "cells"
    folder.mkdir()
    write(folder / "skill.json", {"type": "skill", "succeeded": [{"entry_id": "a", "evaluation": {"q": 1}}, {"entry_id": "b"}], "failed": ["c"], "skipped_quarantined": ["d", "e"]})
    write(folder / "mcp.json", "{broken")
    art = D.read_artifacts(spark, str(folder))
    assert rows(D.artifact_results(art)) == [("skill", "a", '{"q":1}')]
    cells = D.artifact_cells(art, ["skill", "mcp"])
    assert rows(cells) == [("mcp", False, 0, 0), ("skill", True, 1, 2)]
    entries = spark.createDataFrame([("skill", "new"), ("skill", "old"), ("mcp", "synth"), ("rule", "new")], "type string, provenance string")
    got = {r.type: (r.succeeded, r.fallback, r.failed, r.status) for r in R.run_status(entries, cells).collect()}
    assert got == {"skill": (1, 1, 1, "partial"), "mcp": (0, 1, 0, "failed"), "rule": (1, 0, 0, "failed")}


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([("a", "skill", 1, None), ("b", "skill", 9, "p"), ("c", "mcp", 5, None)], "id string, type string, final_score int, bundled_in string")
    out = str(tmp_path / "pub")
    assert A.publish_if_rows(df, lambda d: A.publish_partitions(d, out, order=[F.desc("final_score")]))
    kinds = {p.name for p in (tmp_path / "pub").iterdir() if p.is_dir()}
    assert kinds == {f"type={t}" for t in ("mcp", "skill", "rule", "prompt", "plugin")}
    assert rows(spark.read.json(out).select("id")) == [("a",), ("c",)]
    assert not A.publish_if_rows(df.limit(0), lambda d: pytest.fail("an empty run must not write"))


def test_bad_rows_are_set_aside(spark, tmp_path):
    path = write(tmp_path / "l.json", '{"a": 1}\n{"a": \n{"a": 3}\n')
    good, bad = A.read_json_with_rejects(spark, path, "a int")
    assert rows(good) == [(1,), (3,)] and bad.count() == 1


def test_snapshot_rotation(spark, tmp_path):
    ddl, folder = "id int, v string", str(tmp_path / "state")
    frame = lambda *r: spark.createDataFrame(list(r), ddl)
    first = N.rotate_snapshot(frame((1, "a")), folder, "v1", ddl, fallback=frame((9, "f")))
    assert rows(first) == [(9, "f")]
    assert rows(N.rotate_snapshot(frame((2, "b")), folder, "v2", ddl)) == [(1, "a")]
    assert rows(N.read_state(spark, folder, ddl)) == [(2, "b")]
    assert N.read_state(spark, str(tmp_path / "other"), ddl).count() == 0


def test_order_of_large_files_is_made_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task sorts all rows of the array, and the place in a folder is no window over the rows of a type."""
    import __spark_entry__ as entry
    from feedloom.sources import tables as A

    o = [(i * 7 % 500, i % 9, "FOP"[i % 3], i * 1.5 % 11, "1-URGENT" if i % 5 else "5-LOW", None) for i in range(500)]
    spark.createDataFrame(o, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, o_orderdate date") \
        .repartition(5).write.parquet(str(tmp_path / "orders.parquet"))
    plans = []
    write = A.write_json_arrays
    monkeypatch.setattr(A, "write_json_arrays", lambda df, *a, **b: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **b)))
    got = entry.queries()["a1_one_array"](spark, str(tmp_path)).collect()
    assert [r.o_orderkey for r in sorted(got, key=lambda r: r.number)] == list(range(500)) and [r.number for r in sorted(got, key=lambda r: r.number)] == list(range(500))
    assert "Coalesce 1" in plans[0] and "Sort" not in plans[0]
    out = entry.queries()["a21_published_folders"](spark, str(tmp_path))
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[0]
    kept = [r for r in o if r[2] != "F" or r[4] != "1-URGENT"]
    want = {(r[2], r[0], n) for t in "FOP" for n, r in enumerate(sorted((x for x in kept if x[2] == t), key=lambda x: (-x[3], x[0])))}
    assert {tuple(r) for r in out.collect()} == want
