"""Boundary values of single rules."""

import pytest
from pyspark.sql import functions as F

from frames_as_rows import rows
from feedloom.functions import fixed, jsons as J, scores as S, text as X, urls as U, values as V
from feedloom.operators import checks as C, content as T, filters as B, linkage as L, overlay as O, scoring as SC, select as G, state as N
from feedloom.sources.tables import empty_frame


def one(spark, column, **inputs):
    names = list(inputs)
    types = {str: "string", int: "bigint", float: "double", bool: "boolean", list: "array<string>", type(None): "string", dict: "map<string,string>"}
    ddl = ", ".join(f"{n} {types[type(inputs[n])]}" for n in names) or "x int"
    df = spark.createDataFrame([tuple(inputs.values()) or (1,)], ddl)
    return df.select(column.alias("out")).first()["out"]


# --- addresses and keys ------------------------------------------------------------------------


@pytest.mark.parametrize("url,want", [
    ("https://GitHub.com/A/B.git", "https://github.com/a/b"), ("https://github.com/a/b//", "https://github.com/a/b"),
    ("https://github.com/a/b.git/", "https://github.com/a/b"),
])
def test_normalize_url(spark, url, want):
    assert one(spark, U.normalize_url("u"), u=url) == want


@pytest.mark.parametrize("url,want", [
    ("io.github.Obra/Super", "https://github.com/obra/super"), ("https://www.github.com/a/b/?x=1#y", "https://github.com/a/b"),
    (" https://github.com/a/b.git ", "https://github.com/a/b"), ("https://github.com/a/b#skill=z", "https://github.com/a/b"),
])
def test_skip_url(spark, url, want):
    assert one(spark, U.normalize_skip_url("u"), u=url) == want


def test_split_source_url(spark):
    full = one(spark, U.split_source_url("u"), u="https://github.com/o/r.git/tree/v1/a/b/#top")
    assert (full.owner, full.repo, full.ref, full.sub_path, full.fragment) == ("o", "r", "v1", "a/b", "top")
    assert one(spark, U.split_source_url("u"), u="https://github.com/o/r").ref == "HEAD"
    assert one(spark, U.split_source_url("u"), u="https://gitlab.com/o/r") is None


@pytest.mark.parametrize("url,want", [
    ("https://github.com/anthropics/skills", 1000), ("https://github.com/vercel-labs/x", 900),
    ("https://registry.modelcontextprotocol.io/v0/servers/com.x%2Fy", 900), ("https://github.com/a/b#skill=c", 800),
    ("https://github.com/sickn33/antigravity-awesome-skills#skill=c", 200), ("https://github.com/a/b", 500),
    ("https://gitlab.com/a/b", 100), (None, 100),
])
def test_source_tier(spark, url, want):
    assert one(spark, L.source_tier("u"), u=url) == want


@pytest.mark.parametrize("url,name,want", [
    ("https://github.com/O/R#skill=Foo&x", "n", "skill|o/r|foo"),
    ("https://github.com/o/r/tree/main/skills/game/2d-Games/?q", "n", "skill|o/r|game/2d-games"),
    ("https://github.com/o/r", "Name", "skill|o/r|name"),
    ("https://github.com/sickn33/antigravity-awesome-skills/tree/main/skills/x", "n", "skill|anthropics/skills|x"),
    ("https://github.com/o/r", "", None), ("https://example.com/x", "n", None),
])
def test_skill_key(spark, url, name, want):
    assert one(spark, L.skill_key("u", "n"), u=url, n=name) == want


REG = "https://registry.modelcontextprotocol.io/v0/servers/"


@pytest.mark.parametrize("url,want", [
    (REG + "io.github.Own%2FRepo", "repo|own/repo|"), (REG + "com.microsoft%2Fazure", "registry|com.microsoft/azure|"),
    (REG + "a%2Bb+c", "registry|a+b+c|"), ("https://github.com/own/repo", "repo|own/repo|"),
    ("https://github.com/own/repo/tree/main/src/Foo/", "repo|own/repo|src/foo"), ("https://gitlab.com/own/repo", None),
])
def test_server_key(spark, url, want):
    assert one(spark, L.server_key("u"), u=url) == want


def test_rule_key(spark):
    base = "https://github.com/SchneiderSam/awesome-windsurfrules/blob/main/rules/"
    assert one(spark, L.rule_key("u"), u=base + "global_rules/My-Rule/x.md") == "rule|my-rule"
    assert one(spark, L.rule_key("u"), u="https://github.com/a/b/blob/main/rules/x/y.md") is None


def test_identity_rank_prefers_repository_address(spark):
    df = spark.createDataFrame(
        [(1, "mcp", REG + "io.github.o%2Fr", None), (2, "mcp", "https://github.com/o/r", None), (3, "plugin", "https://github.com/o/r", 950), (4, "plugin", "https://github.com/o/r", 1000)],
        "id int, type string, source_url string, source_priority int",
    ).withColumn("rank", L.identity_rank())
    order = [r.id for r in df.orderBy("type", "rank").collect()]
    assert order == [2, 1, 4, 3]


def test_donor_fields_fill_empty_ones_only(spark):
    df = spark.createDataFrame(
        [("k", 1, "", 0, ["a"]), ("k", 2, "x", 5, ["b", "a"]), ("k", 3, "y", 9, ["c"]), (None, 4, "", 0, [])],
        "key string, o int, s string, n int, tags array<string>",
    )
    out = L.collapse_with_donors(df, "key", ["o"], {"s": "string", "n": "number"}, ["tags"])
    got = {r.o: (r.s, r.n, list(r.tags or [])) for r in out.collect()}
    assert got == {1: ("x", 5, ["a", "b", "c"]), 4: ("", 0, [])}


# --- scores -------------------------------------------------------------------------------------


def test_freshness(spark):
    f = lambda v: one(spark, S.freshness("t", "2024-12-31T00:00:00Z"), t=v)
    assert f("2024-12-31T00:00:00Z") == 100.0 and f("2024-12-30T23:00:00Z") == 100.0
    assert f("2023-12-31") == pytest.approx(0.0) and f("1999-01-01") == 0.0
    assert f(None) == 0.0 and f("soon") == 0.0


@pytest.mark.parametrize("n,want", [(None, 0), (0, 0), (-5, 0), (1, 0), (10, 25), (1000, 75), (10**6, 100)])
def test_popularity(spark, n, want):
    df = spark.createDataFrame([(n,)], "n bigint")
    assert df.select(S.popularity("n").alias("p")).first().p == pytest.approx(want)


@pytest.mark.parametrize("n,want", [(0, 0), (1, 0), (10, 20), (100000, 100), (10**7, 100)])
def test_install_popularity(spark, n, want):
    assert one(spark, S.install_popularity("n"), n=n) == pytest.approx(want)


def test_manifest_completeness_modes(spark):
    m = lambda a, b, present, mode="manifest": one(spark, S.manifest_completeness([F.col("a"), F.col("b")], F.lit(present), mode), a=a, b=b)
    assert m("x", "y", True) == 1.0 and m("x", " ", True) == 0.7 and m("", "", True) == 0.7
    assert m("", "", True, "feed") == 0.3 and m("x", "y", False) == 0.3


def test_health_redistributes_by_row(spark):
    value, out = F.lit(80.0), F.lit(True)
    h = lambda *s: one(spark, S.health_weighted(s))
    assert h((value, 0.3, None), (F.lit(50.0), 0.3, None), (F.lit(100.0), 0.4, None)) == pytest.approx(79.0)
    assert h((value, 0.3, out), (F.lit(50.0), 0.3, None), (F.lit(100.0), 0.4, None)) == pytest.approx((50 * 0.3 + 100 * 0.4) / 0.7)
    assert h((value, 0.3, out), (F.lit(50.0), 0.3, out), (F.lit(100.0), 0.4, out)) == 0.0


@pytest.mark.parametrize("score,rel,want", [
    (65.0, 3, "accept"), (64.99, 5, "review"), (50.0, 5, "review"), (49.9, 5, "reject"), (90.0, 2, "review"), (90.0, None, "accept"),
])
def test_decision(spark, score, rel, want):
    df = spark.createDataFrame([(score, rel)], "s double, r int")
    assert df.select(S.decision("s", "r").alias("d")).first().d == want


def test_bad_configuration_is_refused(spark):
    with pytest.raises(ValueError):
        S.quality_score({"a": F.lit(1)}, {"a": 0.9})
    with pytest.raises(ValueError):
        S.quality_score({"a": F.lit(1)}, {"b": 1.0})
    with pytest.raises(ValueError):
        S.decision(F.lit(1.0), F.lit(1), accept=50, review=50)


def test_task_config_sums_to_one_also_after_injection(spark):
    config = SC.task_config(spark)
    assert C.config_violations(config).count() == 0
    signals = config.filter("kind = 'signal'")
    sums = SC.inject_signal(signals).groupBy("task").agg(F.sum("weight").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums) and len(sums) == 5
    again = SC.inject_signal(SC.inject_signal(signals))
    assert again.count() == SC.inject_signal(signals).count()


def test_star_weight(spark):
    data = [(i, 10, "s", "r1") for i in range(5)] + [(i, 10, "s", "r2") for i in range(5, 9)] + [(9, 0, "s", "r3"), (10, 9, "web-x", "r4"), (11, None, "s", None), (12, 5, "s", None)]
    df = spark.createDataFrame(data, "id int, stars bigint, source string, repo string")
    got = {r.id: r.star_weight for r in SC.star_weight(df, zero_sources=["web-*"]).collect()}
    assert got == {**{i: 0.0 for i in range(5)}, **{i: 1.0 for i in range(5, 9)}, 9: 0.0, 10: 0.0, 11: 0.0, 12: 1.0}


def test_governance(spark):
    df = spark.createDataFrame([(1, 70.0, "accept", 2, 5), (2, None, None, 1, 1), (3, 10.0, "reject", 5, 5)], "id int, final_score double, decision string, a int, b int").withColumn("source", F.lit("s"))
    out = SC.govern(df, {"A": "a", "B": "b"})
    got = {r.id: (r.final_score, r.decision, list(r.weak_dims)) for r in out.collect()}
    assert got == {1: (70.0, "accept", ["A"]), 2: (0.0, "review", []), 3: (10.0, "reject", [])}
    assert SC.drop_rejects(out).count() == 3 and SC.drop_rejects(out, dry_run=False).count() == 2
    assert rows(SC.drop_rejects(out, strict_source="s").select("id")) == [(1,)]
    assert {r.decision for r in SC.govern(df, {}, health_only=True).collect()} == {"review"}


def test_verdict_follows_the_risk(spark):
    assert tuple(one(spark, J.checked_verdict("r", "v"), r="high", v="safe")) == ("reject", True)
    assert tuple(one(spark, J.checked_verdict("r", "v"), r="low", v="safe")) == ("safe", False)


# --- texts ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("text,up,want", [
    ("a mongodb thing", None, "backend"), ("plain", "Databases", "database"), ("forest", None, "backend"), ("xyz", "none", "tooling"),
])
def test_categorize_finds_parts_of_words(spark, text, up, want):
    assert one(spark, X.categorize("t", "u"), t=text, u=up) == want


def test_categorize_whole_words(spark):
    assert one(spark, X.categorize("t", whole_word=True), t="a mongodb thing") == "database"


def test_extract_tags_in_rule_order(spark):
    assert one(spark, X.extract_tags("t"), t="rest on next.js with react") == ["react", "nextjs", "rest-api"]


def test_tech_stack_takes_the_first_rule(spark):
    assert one(spark, X.tech_stack("t"), t="a filesystem in python") == []
    assert one(spark, X.tech_stack("t"), t="use django here") == ["python", "django"]


def test_keywords_are_found_as_a_search_for_each_would(spark):
    import random

    rnd = random.Random(2)
    words = ["go", "golang", "lang", "a", "an", "é", "go", "data base", "base", "😀x"]
    texts = ["".join(rnd.choice(["go", "lang", "a", "n", "é", " ", "data", "base", "😀", "x"]) for _ in range(rnd.randrange(9))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r.i: r.n for r in df.select("i", X.keyword_numbers("t", words).alias("n")).collect()}
    assert got == {i: [k for k, w in enumerate(words) if w in (t or "")] for i, t in enumerate([*texts, None])}
    whole = {r.i: r.n for r in df.filter("t is not null").select("i", X.keyword_numbers("t", words[:4], whole_word=True).alias("n")).collect()}
    assert all(set(whole[i]) <= set(got[i]) for i in whole)
    assert one(spark, X.keyword_numbers("t", []), t="x") == []
    rules = [("lang", "l"), ("go", "g"), ("go", "never")]
    assert [one(spark, X.categorize("t", rules=rules), t=t) for t in ("a go lang", "go", "x")] == ["l", "g", "tooling"]


@pytest.mark.parametrize("name,want", [("Über  Café_x!", "über-café-x"), ("--A  B--", "a-b"), ("中文 名", "中文-名")])
def test_kebab_keeps_letters_of_any_script(spark, name, want):
    assert one(spark, X.kebab("n"), n=name) == want


def test_ids(spark):
    assert one(spark, X.composite_id("a", "b", "c"), a="Skill One", b="Own", c="skill-one") == "skill-one-own"
    assert one(spark, X.composite_id("a", "b", "c"), a="", b="", c="r") == "skill-unknown-r"
    assert one(spark, X.namespaced_id("a", "b"), a="@Scope/x", b="Tool") == "scope-x-tool"
    assert one(spark, X.namespaced_id("a", "b"), a="", b="Tool") == "community-tool"
    one_id, other = (one(spark, X.hashed_id("n"), n=n) for n in ("io.github.foo/bar-baz", "io.github.foo-bar/baz"))
    assert one_id != other and one_id.startswith("io-github-foo-bar-baz-")
    assert one(spark, X.id_from_repo_url("u"), u="https://github.com/MCP-Mirror/own_re_po/") == "own-re-po"
    assert one(spark, X.id_from_listing_url("u", r"skills\.sh"), u="https://skills.sh/own/repo/name") == "name-own-repo"
    assert one(spark, X.id_from_listing_url("u", r"skills\.sh"), u="https://other.sh/own/repo/name") is None


@pytest.mark.parametrize("n", [None, 0, -1, 999, 1000, 1249, 1250, 1350, 1449, 1450, 1650, 2550, 9950, 12345, 99950, 1049, 1050, 1150])
def test_star_label_rounds_like_printf(spark, n):
    want = "—" if not n or n <= 0 else str(n) if n < 1000 else f"{n / 1000:.1f}k"
    df = spark.createDataFrame([(n,)], "n bigint")
    assert df.select(X.star_label("n").alias("s")).first().s == want


def test_cut_words(spark):
    text = "word " * 30
    cut = one(spark, X.cut_words("t", 20), t=text)
    assert cut == "word word word word…"
    assert one(spark, X.cut_words("t", 5), t="数据，分析工具") == "数据，分析…"
    assert one(spark, X.cut_words("t", 3), t="数据，分析") == "数据…"
    assert one(spark, X.cut_words("t", 10), t="a " + "x" * 30) == "a xxxxxxxx…"


@pytest.mark.parametrize("text,want", [
    ("2024-01-02", "2024-01-02 00:00:00"), ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"), ("2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05"),
    ("2024-01-02 03:04:05", "2024-01-02 03:04:05"), ("", None), ("soon", None), (None, None),
])
def test_parse_time(spark, text, want):
    assert one(spark, F.date_format(X.parse_time("t"), "yyyy-MM-dd HH:mm:ss"), t=text) == want


def test_cache_key_matches_its_text(spark):
    import hashlib

    got = one(spark, X.cache_key("m", F.col("c"), F.col("r"), namespace="ns"), c="cc", r="1.x")
    assert got == hashlib.sha256(b"ns|m:cc:1.x").hexdigest()


# --- JSON -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text,want", [
    ('{"a": 1}', '{"a": 1}'), ('x ```json\n{"a": 2}\n``` y', '{"a": 2}'), ('so {"a": {"b": 3}} end', '{"a": {"b": 3}}'),
    ("{not json}", None), ("nothing", None), ("[1]", None), ("{ open", None),
])
def test_recover_object(spark, text, want):
    assert one(spark, J.recover_object("t"), t=text) == want


def test_embedded_config_takes_the_first_server_in_text_order(spark):
    doc = '```json\n{"other": 1}\n```\n```js\n// note\n{"mcpServers": {"z": {"command": "run", "env": {"K": ""}}, "a": {"command": "no"}}}\n```'
    c = one(spark, J.config_in_text("t"), t=doc)
    assert c.command == "run" and c.env == {"K": ""}
    assert one(spark, J.config_in_text("t"), t='```json\n{"mcpServers": {}}\n```') is None


def test_placeholders(spark):
    h = one(spark, J.placeholder_hints("a", "e"), a=["--p", "x/<API_key>", "<1>"], e={"T": "", "U": "YOUR_X", "V": "<v>", "W": "set"})
    assert h == {"API_key": "Replace with actual api key", "T": "Set your T", "U": "Set your U", "V": "Set your V"}
    assert one(spark, J.config_method(J.placeholder_hints("a", "e")), a=["x"], e={"W": "set"}) == "mcp_config"


@pytest.mark.parametrize("method,cmd,args,files,want", [
    ("mcp_config", "npx", ["-y", "pkg"], [], "`npx pkg`"), ("mcp_config_template", "npx", ["pkg"], [], "`npx pkg` ⚙️"),
    ("mcp_config", "/path/to/x", [], [], "📖 See repo"), ("mcp_config", "node", ["/Users/me/x.js"], [], "📖 See repo"),
    ("mcp_config", "tool", [], [], "`npx tool`"), ("mcp_config", "bin/tool", [], [], "`bin/tool`"), ("mcp_config", "", [], [], "📖 See repo"),
    ("git_clone", None, [], ["skills/a/"], "`git clone` → a/"), ("git_clone", None, [], [], "`git clone`"), ("download_file", None, [], [], "📥 Download"),
])
def test_install_summary(spark, method, cmd, args, files, want):
    assert one(spark, J.install_summary("m", "c", "a", "f"), m=method, c=cmd, a=args, f=files) == want


def test_install_commands(spark):
    text = "# T\nnpm install out\n## Setup\n### Mac\n`pip install a`\n## Other\nyarn add b\n"
    c = one(spark, T.install_commands("t", repo=F.lit("o/r"), name=F.lit("p")), t=text)
    assert c.commands == ["pip install a", "/plugin marketplace add o/r", "/plugin install p"] and c.from_section
    fenced = one(spark, T.install_commands("t"), t="say\n```bash\n$ npm install z\nls\n```")
    assert fenced.commands == ["npm install z"] and fenced.from_fence
    listed = one(spark, T.install_commands("t", manifest=F.array(F.lit(" npm install m "), F.lit("no"))), t="")
    assert listed.commands == ["npm install m"]


def test_security_block_defaults(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int").withColumn(
        "s", F.when(F.col("id") == 1, F.struct(
            F.lit("low").alias("risk_level"), F.lit("safe").alias("verdict"), F.lit(None).cast("array<string>").alias("red_flags"),
            F.lit(None).cast("struct<files:array<string>,network:array<string>,commands:array<string>>").alias("permissions"),
            F.lit(None).cast("string").alias("summary"), F.lit(None).cast("array<string>").alias("recommendations"),
        ))
    )
    out = df.select("id", J.security_block(F.col("s"), {"scan_model": F.lit("m")}).alias("b")).orderBy("id").collect()
    assert out[0].b.red_flags == [] and out[0].b.permissions.files == [] and out[0].b.scan_model == "m" and out[1].b is None
    assert one(spark, J.security_content("i"), i=None) == "(no install metadata)"
    assert one(spark, J.security_content("i"), i="{}") == "(no install metadata)"
    assert one(spark, J.security_content("i"), i='{"z": 1, "a": 2}') == '{"a":2,"z":1}'


def test_bundle_parts_equal_the_ordered_loop(spark):
    import random

    rnd = random.Random(1)
    files = [(b, c, f"p{i:03d}", "x" * rnd.randint(1, 60)) for b in (1, 2) for c in (0, 1, 2) for i in range(12 if c else 1)]
    df = spark.createDataFrame(files, "b int, c int, path string, text string").repartition(5)
    parts = T.bundle_parts(df, bundle="b", class_="c", path="path", text="text", cap=300, full_per_class=2)
    out = {r.b: r.content for r in T.bundle_text(parts.withColumnRenamed("c", "c2"), bundle="b", class_="c2", path="path").collect()}
    for b in (1, 2):
        done, index = [], {}
        for _, c, path, text in sorted(f for f in files if f[0] == b):
            i = index[c] = index.get(c, -1) + 1
            full = c == 0 or sum(map(len, done)) < 300 or i < 2
            done.append(f"## {path}\n{text if full else text[:800]}\n")
        assert out[b] == "\n".join(done)


def test_rows_of_a_long_bundle(spark):
    df = spark.createDataFrame([("b", i % 3, f"p{i:02d}", "x" * i) for i in range(30)], "b string, c int, path string, text string")
    parts = T.bundle_parts(df, bundle="b", class_="c", path="path", text="text")
    found = [r.part for r in T.bundle_rows(parts, bundle="b", class_="c", path="path").orderBy("before").collect()]
    assert "\n".join(found) == T.bundle_text(parts, bundle="b", class_="c", path="path").first().content


def test_abbreviate(spark):
    assert one(spark, T.abbreviate("t", 5), t="---\na: b\n---\nfirst para\n\nsecond") == "---\na: b\n---\n\nfirst"
    assert one(spark, T.abbreviate("t", 5), t="plain text") == "plain"


def test_nfc(spark):
    assert one(spark, T.nfc("t"), t="é") == "é" and one(spark, T.nfc("t"), t="plain") == "plain"


# --- filters, overlays, checks, state -----------------------------------------------------------------


def test_listed_urls_below_a_root(spark):
    df = spark.createDataFrame([(1, "https://github.com/a/b/tree/main/x"), (2, "https://github.com/a/bc"), (3, "io.github.a/b"), (4, None)], "id int, url string")
    skip = spark.createDataFrame([("https://www.github.com/A/b.git/",), ("",)], "u string")
    assert rows(B.drop_listed_urls(df, skip, key="id", url="url", skip_url="u").select("id")) == [(2,), (4,)]


def test_reject_reasons_in_order(spark):
    def reason(stars, d, cat="x", known=False):
        text = F.lower(F.concat(F.lit("n "), F.col("d")))
        c = B.reject_reason(stars=F.lit(stars), description=F.col("d"), text=text, category=F.lit(cat), known=F.lit(known))
        return one(spark, c, d=d)

    long = "a long enough description"
    assert reason(50, "x") == "stars <= 50" and reason(51, "x" * 20) == "description too short"
    assert reason(51, long + " viral") == "spam: viral" and reason(51, long, "seo") == "non-coding category: seo"
    assert reason(51, long, known=True) == "duplicate with Tier 1" and reason(51, long) is None


@pytest.mark.parametrize("name,want", [("ab", "name too short"), ("x" * 61, "name too long"), ("asdasd", "repeating pattern in name"), ("good", None)])
def test_name_reason(spark, name, want):
    assert one(spark, B.name_reason("n", F.lit("other")), n=name) == want


def test_thin_and_broken(spark):
    assert one(spark, B.is_thin("d"), d="x" * 80) is False and one(spark, B.is_thin("d"), d="x" * 90 + "…") is True
    assert one(spark, B.broken_front_matter("t"), t="---\na: b: c\n---\n") is True
    assert one(spark, B.broken_front_matter("t"), t="---\na: 'b: c'\n---\n") is False
    assert one(spark, B.broken_front_matter("t"), t="no front") is False


def test_front_matter_is_judged_as_a_yaml_reader_does(spark):
    import yaml

    sound = ['metadata: {"a": {"b": "c"}}', "text: |\n  Use: foo: bar", "key: v # note: x", "", "- a\n- b", "a: 'x: y'", "just a line"]
    broken = ['title: "abc', "tags: [a, b", "a:\n\tb: c", "a: b: c", "name: a\x07b", "a: *nobody", "a: !unknown x", "{", "day: 2024-13-45", "[" * 3000]
    texts = [f"---\n{b}\n---\nbody: a: b" for b in sound + broken] + [None, "", "---\na: b: c", " ---\na: b: c\n---", "---\n---", "---a: b: c\n---"]
    want = [False] * len(sound) + [True] * len(broken) + [False, False, False, False, False, True]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r.b for r in df.select("i", B.broken_front_matter("t").alias("b")).orderBy("i").collect()] == want

    def row_wise(t):
        end = t.find("\n---", 3) if t and t.startswith("---") else -1
        try:
            yaml.safe_load(t[3:end] if end >= 0 else "")
        except (yaml.YAMLError, ValueError, RecursionError):
            return True
        return False

    assert [row_wise(t) for t in texts] == want
    from feedloom.plans.queries.filtering import FRONT_FORMS, fronted
    from feedloom.plans.registry import Tables

    files = fronted(Tables(spark, "/root/testdata/sf0.001")).select("doc_id", "file", B.broken_front_matter("file").alias("b")).collect()
    assert len({r.doc_id % 10 for r in files}) == len(FRONT_FORMS) and {r.b for r in files} == {True, False}
    assert all(r.b == row_wise(r.file) for r in files)
    assert one(spark, B.empty_stub("t"), t='{"mcpServers": {"a": {}}}') is True
    assert one(spark, B.empty_stub("t"), t="{bad") is False


def test_drift_boundaries(spark):
    old = spark.createDataFrame([("a", 100), ("b", 100), ("c", 0), ("d", 0), ("e", 5)], "id string, install_count bigint")
    new = spark.createDataFrame([("a", 119), ("b", 120), ("c", 999), ("d", 1000), ("f", 1)], "id string, install_count bigint")
    got = {r["id"]: (r["class"], r["pct"]) for r in O.drift_diff(old, new).collect()}
    assert got == {"a": ("stable", None), "b": ("changed", 0.2), "c": ("stable", None), "d": ("changed", None), "e": ("removed", None), "f": ("added", None)}


def test_restore_side_effects_only_for_rewritten_texts(spark):
    ddl = "id int, z string, description string, description_original string"
    new = spark.createDataFrame([(1, None, "new", None), (2, "own", "new", None)], ddl)
    old = spark.createDataFrame([(1, "zh", "rewritten", "orig"), (2, None, "old", None)], ddl)
    out = O.restore_side_effects(new, old, ["z"])
    assert rows(out.select("id", "z", "description")) == [(1, "zh", "rewritten"), (2, "own", "new")]


def test_typed_fields(spark):
    err = lambda t, fields: one(spark, C.typed_field_errors(F.col("t"), fields), t=t)
    assert err('{"install_count": true}', C.SKILL_FIELDS) == ["install_count must be a whole number"]
    assert err('{"install_count": -1}', C.SKILL_FIELDS) == ["install_count must not be negative"]
    assert err('{"skills_sh_scraped_at": "", "skills_sh_url": "ftp://x"}', C.SKILL_FIELDS) == ["skills_sh_url has a bad format"]
    assert err('{"mcp_registry_status": "gone"}', C.SERVER_FIELDS) == ["mcp_registry_status has an unknown value"]
    assert err('{"mcp_remotes": [{"type": "a"}]}', C.SERVER_FIELDS) == ["mcp_remotes items need a text url"]
    assert err('{"mcp_remotes": {"type": "a"}}', C.SERVER_FIELDS) == ["mcp_remotes must be a list"]
    assert err("{}", C.SERVER_FIELDS) == []


def test_entry_contract(spark):
    ok = {"id": "a-1", "name": "n", "type": "mcp", "description": "d", "source_url": "https://x/y", "category": "backend", "source": "s", "last_synced": "2024-01-01"}
    bad = {**ok, "id": "A 1", "type": "other", "last_synced": "today", "name": None}
    df = spark.createDataFrame([tuple(ok.values()), tuple(bad.values())], ", ".join(f"{k} string" for k in ok))
    df = df.withColumns({"stars": F.lit(1), "tags": F.array(F.lit("t")), "tech_stack": F.array(F.lit("t")), "install": F.struct(F.lit("manual").alias("method"))})
    got = rows(C.violations(df, C.entry_rules(df.columns), "id"))
    assert got == [("A 1", "id format"), ("A 1", "last_synced format"), ("A 1", "missing name"), ("A 1", "type value")]


def test_curated_rows(spark):
    cols = "o int, id string, type string, source string, added_at string, url_key string"
    data = [(1, "a", "mcp", "curated", "2024-01-01", "u"), (2, "a", "rule", "curated", None, "u"), (3, "c", "skill", "other", None, "v"), (4, "d", "plugin", "curated", None, None)]
    rules = C.curated_rules(["id", "type", "source", "added_at"])
    rules = {k: v for k, v in rules.items() if k in ("missing added_at", "source value", "type value", "id format")}
    index = spark.createDataFrame([("x", "v"), ("d", "w")], "id string, url_key string")
    got = rows(C.curated_findings(spark.createDataFrame(data, cols), index, order="o", rules=rules))
    assert got == [
        (2, "duplicate address", "warning"), (2, "duplicate id", "error"), (3, "address in index", "warning"), (3, "missing added_at", "error"),
        (3, "source value", "error"), (4, "id in index", "warning"),
    ]


def test_ledger_backoff(spark):
    df = spark.createDataFrame([(n, "2024-01-01 00:00:00") for n in (1, 2, 3, 4)], "n int, t string").withColumn("t", F.to_timestamp("t"))
    got = [str(r[0]) for r in df.orderBy("n").select(F.date_format(N.next_retry("n", "t"), "yyyy-MM-dd")).collect()]
    assert got == ["2024-01-01", "2024-01-08", "2024-01-29", "9999-12-31"]
    ledger = spark.createDataFrame([(1, 3, "bad date"), (2, 2, "2024-01-05"), (3, 2, "2024-01-04"), (4, 9, None)], "id int, attempt_count int, next_retry_after string")
    got = rows(ledger.select("id", N.retry_allowed("2024-01-04").alias("ok")))
    assert got == [(1, True), (2, False), (3, True), (4, False)]


def test_ledger_of_one_type_keeps_the_others(spark):
    ddl = "type string, rubric_version string, entry_id string, ok boolean, ts string, event_id int, error_kind string"
    out = spark.createDataFrame(
        [("skill", "1", "a", False, "2024-01-01", 1, "x"), ("mcp", "2", "a", False, "2024-01-01", 2, "x"), ("skill", "1", "a", True, "2024-01-02", 3, None)], ddl
    ).withColumn("ts", F.to_timestamp("ts"))
    led = N.ledger_update(empty_frame(spark, N.LEDGER_SCHEMA), out)
    assert rows(led.select("type", "entry_id", "attempt_count")) == [("mcp", "a", 1)]


def test_recrawl_limits(spark):
    e = spark.createDataFrame(
        [("a", "mcp", "2023-01-01", "stale"), ("b", "skill", "2023-01-02", "active"), ("c", "mcp", "2023-01-01", "abandoned"), ("d", "rule", "2000-01-01", None), ("e", "mcp", "2000-01-01", None)],
        "id string, type string, added_at string, freshness_label string",
    )
    state = spark.createDataFrame([("c", "mcp", "2023-12-03"), ("e", "mcp", "2023-12-02")], "id string, type string, last_queued_at string")
    queue, new = G.recrawl_queue(e, state, "2024-01-01", limit=1)
    assert rows(queue.select("id")) == [("a",)]
    assert rows(new.select("id", "last_queued_at")) == [("a", "2024-01-01"), ("c", "2023-12-03"), ("e", "2023-12-02")]
    _, legacy = G.recrawl_queue(e, state, "2024-01-01", limit=1, legacy=True)
    assert rows(legacy.select("id", "last_queued_at")) == [("a", "2024-01-01"), ("c", "2023-12-03"), ("e", "2024-01-01")]


def test_fixed_tables_are_whole():
    assert set(fixed.CATEGORY_KEYWORDS.values()) <= set(fixed.CATEGORIES)


def test_time_of_texts_follows_their_length(spark):
    """Texts that begin with an install heading, and texts of very many fences, in seconds."""
    import time

    from feedloom.sources import markdown

    headings = "# Install\nnpm install a\n" + "".join(f"## Step {i}\nnpm install p{i}\n" for i in range(10_000))
    fences = "# Title\n" + "".join("```\n```\nwords\n" for _ in range(10_000))
    df = spark.createDataFrame([(headings, fences)], "h string, f string")
    began = time.time()
    got = df.select(T.install_commands("h")["commands"].alias("c"), markdown.body_description("f").alias("d")).first()
    assert len(got.c) == 10_001 and got.d.startswith("Title: words")
    assert time.time() - began < 20


def test_near_terms_are_found_by_their_variants(spark):
    import random

    from feedloom.operators import search as Q

    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("abé") for _ in range(n))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]

    def mangled(w):
        for _ in range(rnd.randrange(6)):
            i = rnd.randrange(len(w) + 1)
            w = rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice("abc") + w[i:], w[:i] + rnd.choice("abc") + w[i + 1 :]])
        return w

    asked = [word(n) for n in (1, 2, 3, 5, 7, 8, 12, 13, 17, 18, 22, 27)]
    terms = sorted({m for w in asked for _ in range(60) if (m := mangled(w))} | {word(rnd.randrange(1, 30)) for _ in range(300)} | {"x" * 60})
    assert max(len(Q.variants_of(t)) for t in terms) < 600
    vocabulary = spark.createDataFrame([("f", t, 1) for t in terms], "field string, term string, df long")
    neighbours = Q.neighbour_table(vocabulary).cache()

    def weight(t, w):
        if t == w:
            return 1.0
        if t.startswith(w):
            return 0.375 * len(t) / (len(t) + 0.3 * (len(t) - len(w)))
        d = distance(t, w)
        return 0.45 * len(t) / (len(t) + d) if d <= int(len(w) * 0.2 + 0.5) else 0.0

    for w in asked:
        got = {r.term: round(r.weight, 9) for r in Q.match_terms(vocabulary, neighbours, w).collect()}
        assert got == {t: round(x, 9) for t in terms if (x := weight(t, w)) > 0}, w


def test_blocks_that_cannot_matter_are_not_read(spark):
    import random

    from feedloom.operators import search as Q

    rnd = random.Random(6)
    rows_ = [(i, " ".join(rnd.choice(["rust", "java", "the", "of", "x", "y", "z"]) for _ in range(rnd.randrange(3, 60)))) for i in range(3000)]
    rows_ += [(5000 + i, "special rust special") for i in range(12)]
    df = spark.createDataFrame(rows_, "id long, text string")
    postings, vocabulary, stats = (x.cache() for x in Q.build_index(df, ["text"]))
    blocks, bounds = Q.block_index(postings, stats, ["text"], block_rows=32)
    neighbours = Q.neighbour_table(vocabulary)
    total = bounds.select("block").distinct().count()
    for query, limit in (("special", 5), ("special rust", 10), ("the of", 200), ("nothinglikeit", 5)):
        want = Q.search_index(postings, vocabulary, stats, query, {"text": 1.0}, limit=limit).collect()
        found, read = Q.search_blocks(blocks, bounds, vocabulary, neighbours, stats, query, {"text": 1.0}, limit=limit, first=2)
        got = found.collect()
        assert [(r.id, round(r.score, 9)) for r in got] == [(r.id, round(r.score, 9)) for r in want], query
        assert read < total / 2 or query == "the of", (query, read, total)


def test_a_listed_name_is_one_row_in_each_lookup(shuffled):
    """Members as a plain loop finds them; the plan makes no row for each try of a name, only for each name of a member."""
    import random

    from feedloom.operators import overlay as O

    rnd = random.Random(4)
    pick = lambda *xs: rnd.choice(xs)
    word = lambda: pick("a", "b", "a:b", "a-b", "b:a", "a:b:a", "a-b:a", ":", "x:", "", None)
    members = [(pick("a", "b", "a-b", "a:b", "a-b-a", f"m{i}", None), word(), pick("a", "b", "b:a", "", None), pick("r", "s", "", None), i) for i in range(40)]
    groups = [(i % 25 if i % 9 else None, pick("r", "s", "", None), [word() for _ in range(rnd.randrange(4))] if i % 7 else None) for i in range(60)]
    for some in (members[:8], members):
        out = O.resolve_members(
            shuffled.createDataFrame(groups, "plugin_id long, repo string, namespaces array<string>"),
            shuffled.createDataFrame(some, "id string, namespace string, tail string, repo string, _ord long"))
        first = lambda ok: next((m for m in some if ok(m)), [None])[0]
        want = {}
        for g, repo, names in groups:
            for pos, name in enumerate(names or []):
                short = (name or "").partition(":")[2] or None
                tries = [
                    ("namespace", first(lambda m: name is not None and m[1] == name)), ("id", first(lambda m: name is not None and m[0] == name)),
                    ("slug", first(lambda m: name is not None and ":" in name and m[0] == name.replace(":", "-"))),
                    ("same_repo", first(lambda m: short is not None and repo is not None and m[2] == short and repo in (m[3], ""))),
                    ("tail", first(lambda m: short is not None and m[2] == short)),
                ]
                best = next(((i, s, m) for i, (s, m) in enumerate(tries) if m is not None), (9, "orphan", None))
                want[g, pos] = min(want.get((g, pos), best), best, key=lambda b: b[0])
        got = {(r.plugin_id, r.pos): (r.strategy, r.member) for r in out.collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
        assert all(v[1] is None or any(m[0] == v[1] for m in some) for v in got.values())
        assert out.count() == len(want)
        assert "Generate explode(filter(" not in out._jdf.queryExecution().optimizedPlan().toString()  # rows made of tries


def test_postings_are_counted_where_they_are_read(spark):
    """Rows of one id add up; where ids are unique nothing is shuffled for the postings."""
    from collections import Counter

    from feedloom.operators import search as Q

    rows_ = [(1, "A b a", "x"), (2, None, ""), (None, "b b", "x y x"), (4, "c", None)]
    once = Q.build_index(spark.createDataFrame(rows_, "id long, head string, text string"), ["head", "text"])[0]
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    for given in (rows_, rows_ + rows_[:1] + [(4, "d c", "z"), (None, "q b", "y")]):
        want = Counter()
        for key, *texts in given:
            for field, text in zip(("head", "text"), texts):
                terms = (text or "").lower().split()
                want.update((key, field, len(terms), t) for t in terms)
        got = Q.build_index(spark.createDataFrame(given, "id long, head string, text string"), ["head", "text"])[0].collect()
        assert sorted(((r.id, r.field, r.len, r.term), r.tf) for r in got if r.id) == sorted((k, n) for k, n in want.items() if k[0])
        assert {(r.id, r.field, r.len, r.term): r.tf for r in got} == want and len(got) == len(want)


def test_stored_blocks_hold_their_bounds(spark, tmp_path):
    from feedloom.operators import search as Q

    rows_ = [(i, f"one {'two ' * (i % 5)} w{i % 7}", "two" if i % 3 else None) for i in range(300)]
    postings, _, stats = Q.build_index(spark.createDataFrame(rows_, "id long, head string, text string"), ["head", "text"])
    rows, bounds = Q.block_index(postings, stats, ["head", "text"], block_rows=16)
    Q.write_blocks(rows, str(tmp_path / "blocks"))
    stored, read = Q.read_blocks(spark, str(tmp_path / "blocks"))
    same = lambda a, b: sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    assert same(stored, rows) and same(read, bounds)
    assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()


def test_texts_dealt_to_blocks_are_counted_once(spark, tmp_path, monkeypatch):
    """Postings of dealt rows are those of a plain count, whole blocks at a time; texts are read once to write them."""
    from collections import Counter

    from feedloom.operators import search as Q

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    rows_ = [(i, f"One {'two ' * (i % 5)} w{i % 7}", "two É two" if i % 3 else None) for i in range(300)]
    rows_ += [(None, "", ""), (1000, None, None), (1001, "ﬀ 𝒳z two", "")]
    twice = rows_ + [(7, "two two x", ""), (None, "x", None), *rows_[:9], (8, "one two", "")]
    for tokens, often, given in ((1_500_000, 1000, rows_), (40, 3, twice), (40, 1, twice), (40, 1, rows_[:0])):
        monkeypatch.setattr(Q, "TASK_TOKENS", tokens)
        monkeypatch.setattr(Q, "MOST_OF_KEY", often)
        df = spark.createDataFrame(given, "id long, head string, text string").repartition(3).withColumn("text", read("text"))
        want = Counter()
        for key, *texts in given:
            for field, text in zip(("head", "text"), texts):
                terms = (text or "").lower().split()
                want.update((key, field, len(terms), t) for t in terms)
        postings, _, stats = Q.build_index(df, ["head", "text"], block_rows=16)
        stats.cache().count()
        rows, bounds = Q.block_index(postings, stats, ["head", "text"], block_rows=16)
        before = seen.value
        Q.write_blocks(rows, path := str(tmp_path / f"{tokens}-{often}-{len(given)}"))
        assert seen.value - before == len(given)
        stored, read_ = Q.read_blocks(spark, path)
        got = stored.collect()
        assert {(r.id, r.field, r.len, r.term): r.tf for r in got} == want and len(got) == len(want)
        most = {}
        for r in got:
            most[r.term, r.field, r.block] = max(r.impact, most.get((r.term, r.field, r.block), 0))
        for found in (bounds.collect(), read_.collect()):
            assert {(r.term, r.field, r.block): r.most for r in found} == most and len(found) == len(most)
        # dealt as without: the same blocks, the same impacts
        plain = Q.block_index(Q.build_index(df, ["head", "text"])[0], stats, ["head", "text"], block_rows=16)[0]
        assert sorted(map(str, stored.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
        if often > 1:
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert plan.count("hashpartitioning") == 1 and "hashpartitioning(block" in plan
        words = stored.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
        boosts = {"head": 2.0, "text": 1.0}
        found, _ = Q.search_blocks(stored, read_, words, Q.neighbour_table(words), stats, "two w3", boosts, limit=9, first=2)
        wanted = Q.search_index(stored, words, stats, "two w3", boosts, limit=9)
        assert [(r.id, round(r.score, 9)) for r in found.collect()] == [(r.id, round(r.score, 9)) for r in wanted.collect()]


def test_a_term_has_few_variants():
    """One more than the edits that a word may be away; letters left out made 288 of a word of twelve."""
    from feedloom.operators import search as Q

    assert [len(Q.variants_of(w)) for w in ("a", "the", "verbe", "withreshenes", "x" * 40)] == [1, 2, 2, 4, 11]
    assert set(Q.variants_of("verde")) & Q.spellings("verbe") and not set(Q.variants_of("xxxxx")) & Q.spellings("verbe")


def test_manifests_are_dealt_out_before_their_names(shuffled):
    """A list of names is taken apart behind an exchange, and its names are gathered behind one."""
    from feedloom.operators import overlay as O

    m = shuffled.createDataFrame([("r", "good", ["a", " b ", "a"]), ("r2", "good", ["c"]), ("s", "bad name", ["a"]), (None, "good", ["a"])],
                                 "repo string, market_name string, plugin_names array<string>")
    df = shuffled.createDataFrame([(1, "r", "b"), (2, "r", "c"), (3, "s", "a"), (4, None, "a"), (5, "r2", None), (6, "r", "a")], "id long, repo string, plugin_name string")
    out = O.verify_membership(df, m, spread=["id"])
    assert sorted((r.id, r.market_name, r.verified) for r in out.collect()) == [
        (1, "good", True), (2, "good", False), (3, None, False), (4, None, False), (5, "good", False), (6, "good", True)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    after = plan[plan.index("Generate explode(plugin_names"):].splitlines()
    assert any("RepartitionByExpression" in line for line in after[1:4])
