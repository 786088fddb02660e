"""Queries of filters and projections (B1-B17) and of search (J1-J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import text as X
from ...functions.values import first_rule
from ...operators import filters as B, scoring as S, search as Q
from ..registry import query, scratch


@query(
    "b1_drop_listed_urls",
    r"""
with p as (select page_id, regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^(https?://)www\.', '\1'), '[?#].*$', ''), '/+$', '') as u from pages)
select page_id, u from p where not (u = 'https://blog.tiontion.example.com/en/853' or starts_with(u, 'http://cheap-pills.example.com/')
  or starts_with(u, 'https://spam-farm.example.org/') or regexp_matches(u, '^http://[^/]*\.example\.net/de(/|$)'))
""",
)
def b1_drop_listed_urls(t):
    from ...functions.urls import normalize_skip_url

    p = t.pages.withColumn("u", normalize_skip_url("url"))
    hosts = p.select(F.regexp_extract("u", r"^(http://[^/]*\.example\.net)/de(?:/|$)", 1).alias("h")).filter("h <> ''").distinct()
    skip = hosts.select(F.concat("h", F.lit("/de/")).alias("skip_url")).unionByName(
        t.spark.createDataFrame(
            [("https://www.blog.tiontion.example.com/en/853/?x=1",), ("http://cheap-pills.example.com#a",), ("https://SPAM-farm.example.org/",), ("",)],
            "skip_url string",
        )
    )
    return B.drop_listed_urls(p, skip, key="page_id", url="url", skip_url="skip_url").select("page_id", "u")


@query(
    "b2_drop_listed_pairs",
    """select p_partkey from part where (p_brand, lower(p_name)) not in (select p_brand, lower(p_name) from part where p_size = 7)""",
)
def b2_drop_listed_pairs(t):
    listed = t.part.filter("p_size = 7").select(F.concat(F.lit(" "), F.upper("p_brand")).alias("src"), F.upper("p_name").alias("nm"))
    listed = listed.unionByName(t.part.select(F.lit(" ").alias("src"), F.col("p_name").alias("nm")))
    return B.drop_listed_pairs(t.part, listed, ["p_brand", "p_name"], ["src", "nm"]).select("p_partkey")


@query(
    "b3_popular_enough",
    "select c_custkey from customer where nullif(cast(floor(c_acctbal / 100) as bigint), 0) is null or floor(c_acctbal / 100) >= 10",
)
def b3_popular_enough(t):
    return t.customer.filter(B.popular_enough(F.floor(F.col("c_acctbal") / 100))).select("c_custkey")


@query("b4_active_latest", "select o_orderkey from orders where o_orderstatus = 'O' and o_orderpriority <> '5-LOW'")
def b4_active_latest(t):
    latest = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority") != "5-LOW").otherwise(True)
    return t.orders.filter(B.active_and_latest("o_orderstatus", latest, "O")).select("o_orderkey")


@query(
    "b5_reject_reason",
    """
with d as (select doc_id, lang, source, n_chars % 200 as stars, text as d from documents)
select doc_id, case when stars <= 50 then 'stars <= 50' when length(d) <= 20 then 'description too short' when contains(lower(source || ' ' || d), 'sted') then 'spam: sted'
  when contains(lower(source || ' ' || d), 'leau') then 'spam: leau' when lang = 'es' then 'non-coding category: es'
  when source in ('src3', 'src4') then 'duplicate with Tier 1' end as reason from d
""",
)
def b5_reject_reason(t):
    d = t.documents.select("doc_id", F.upper("lang").alias("lang"), "source", (F.col("n_chars") % 200).alias("stars"), F.col("text").alias("d"))
    d = d.withColumn("_t", X.joined_text("source", "d"))
    reason = B.reject_reason(
        stars=F.col("stars"), description=F.col("d"), text=F.col("_t"), category=F.lower("lang"), known=F.col("source").isin("src3", "src4"),
        spam=["sted", "leau"], off_topic=["es", "it"],
    )
    return d.select("doc_id", reason.alias("reason"))


# DuckDB has no back-references: two equal neighbouring pieces are looked for by position and length.
@query(
    "b6_name_reason",
    """
with p as (select p_partkey, p_name || case when p_size > 40 then lower(p_type) when p_size < 5 then p_name else '' end as n, p_name from part),
r as (select distinct n from (select distinct n from p) d, range(1, 60) i(i), range(2, 31) l(l)
  where length(substr(n, i + l, l)) = l and substr(n, i, l) = substr(n, i + l, l))
select p_partkey, case when length(n) < 3 then 'name too short' when length(n) > 60 then 'name too long' when n in (select n from r) then 'repeating pattern in name'
  when n = p_name then 'description equals name' end as reason from p
""",
)
def b6_name_reason(t):
    more = F.when(F.col("p_size") > 40, F.lower("p_type")).when(F.col("p_size") < 5, F.col("p_name")).otherwise("")
    name = F.concat("p_name", more)
    return t.part.select("p_partkey", B.name_reason(name, F.concat(F.lit(" "), F.upper("p_name"))).alias("reason"))




@query("b7_keyword_filter", rf"select doc_id from documents where regexp_matches(text, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:tion|und|les|machine learning|en-er)(?:[^\p{{L}}\p{{N}}_]|$)')")
def b7_keyword_filter(t):
    return t.documents.filter(B.is_about_code("text", ["tion", "und", "les", "machine learning", "en-er"])).select("doc_id")


@query(
    "b8_open_sources",
    """
with n as (select l_partkey from lineitem group by l_partkey having count(*) <= 30)
select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where l_partkey in (select l_partkey from n)
  and l_partkey in (select p_partkey from part where p_size > 10 and p_brand <> 'Brand#2')
""",
)
def b8_open_sources(t):
    sources = t.part.select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") > 10).alias("enabled"))
    blocked = t.part.filter("p_brand = 'Brand#2'").select(F.col("p_partkey").alias("l_partkey"))
    out = B.open_sources(t.lineitem, sources, blocked, repo="l_partkey", most_files=30)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "b9_thin_text",
    r"""select doc_id, length(d) = 0 or regexp_matches(d, '(\.\.\.|…)$') or length(d) < 80 as thin from (select doc_id, trim(text) as d from documents)""",
)
def b9_thin_text(t):
    return t.documents.select("doc_id", B.is_thin("text").alias("thin"))


@query(
    "b10_drop_rejects",
    """
with d as (select doc_id, source, case when quality = 1 then 'accept' when toxic = 1 then 'reject' when quality = 0 then 'review' end as decision from documents left join labels using (doc_id))
select doc_id, coalesce(decision, 'none') as decision from d where coalesce(decision, 'review') <> 'reject' and (source <> 'src5' or coalesce(decision, '') = 'accept')
""",
)
def b10_drop_rejects(t):
    dec = F.when(F.col("quality") == 1, "accept").when(F.col("toxic") == 1, "reject").when(F.col("quality") == 0, "review")
    d = t.documents.join(t.labels, "doc_id", "left").withColumn("decision", dec)
    out = S.drop_rejects(d, dry_run=False, strict_source="src5")
    return out.select("doc_id", F.coalesce("decision", F.lit("none")).alias("decision"))


@query("b11_complete_plugins", "select p_partkey from part where p_type <> 'SMALL' or (p_size > 10 and p_brand <> 'Brand#4')")
def b11_complete_plugins(t):
    repo = F.when(F.col("p_size") > 10, F.col("p_name")).otherwise("")
    verified = F.when(F.col("p_brand") != "Brand#4", F.col("p_size") > 30)
    return t.part.filter(B.complete_plugins("p_type", repo, verified, "SMALL")).select("p_partkey")


# front matter made of whole texts, in ten forms; the second, third, fifth, sixth and seventh are not YAML
FRONT_FORMS = (
    lambda text, quoted, name: F.concat(F.lit("---\ntitle: "), name, F.lit("\ndescription: "), quoted, F.lit("\n---\n")),
    lambda text, quoted, name: F.concat(F.lit("---\ndescription: "), name, F.lit(": a: b\nbody: "), quoted, F.lit("\n---\n")),
    lambda text, quoted, name: F.concat(F.lit("---\nbody: "), quoted, F.lit('\ntitle: "'), name, F.lit("\n---\n")),
    lambda text, quoted, name: F.concat(F.lit('---\nmetadata: {"a": {"b": "c"}, "d": '), quoted, F.lit("}\n---\n")),
    lambda text, quoted, name: F.concat(F.lit("---\ntags: ["), name, F.lit(", "), quoted, F.lit("\n---\n")),
    lambda text, quoted, name: F.concat(F.lit("---\nouter:\n\tinner: "), quoted, F.lit("\n---\n")),
    lambda text, quoted, name: F.concat(F.lit("---\nname: "), name, F.lit("\u0007\nbody: "), quoted, F.lit("\n---\n")),
    lambda text, quoted, name: F.concat(
        F.lit("---\nUse: |2\n  Use: foo: bar\n  "), F.regexp_replace(text, r"\r\n?|\n", "\n  "), F.lit("\nkey: v # note: x\n---\n")),
    lambda text, quoted, name: F.concat(F.lit("---\nlist:\n  - "), name, F.lit("\n  - "), quoted, F.lit("\nempty:\n---\n")),
    lambda text, quoted, name: F.concat(F.lit("a: b: c\n"), text),
)


def fronted(t):
    """Documents with front matter of the form that their id names, and its body behind it."""
    quoted = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))
    quoted = F.substr(quoted, F.lit(6), F.length(quoted) - 6)
    name = F.concat(F.lit("n"), F.col("doc_id").cast("string"))
    text = F.coalesce("text", F.lit(""))
    made = first_rule([(F.col("doc_id") % 10 == i, form(text, quoted, name)) for i, form in enumerate(FRONT_FORMS)])
    return t.documents.withColumn("file", F.concat(made, text))


@query(
    "b12_usability",
    """select reason, count(*) as n from (select case when lang = 'es' then 'unknown_type' when quality is null then 'orphan_no_file'
  when lang = 'en' and toxic = 1 then 'mcp_empty_stub' when lang <> 'en' and doc_id % 10 in (1, 2, 4, 5, 6) then 'md_yaml_broken' else 'kept' end as reason
  from documents left join labels using (doc_id)) group by reason""",
)
def b12_usability(t):
    from ...operators.report import drop_counts

    d = fronted(t).join(t.labels, "doc_id", "left")
    config = F.when(F.col("toxic") == 1, '{"mcpServers": {"a": {}, "b": {"command": " "}}}').otherwise('{"mcpServers": {"a": {"url": "http://x"}}}')
    reason = B.usability_reason(
        type_=F.when(F.col("lang") != "es", F.col("lang")), has_file=F.col("quality").isNotNull(), stub=B.empty_stub(config),
        broken=B.broken_front_matter("file"), known=["en", "de", "fr"], stub_type="en", text_types=["de", "fr"],
    )
    return drop_counts(d.withColumn("reason", reason))


@query("b12_front_matter", "select doc_id, doc_id % 10 in (1, 2, 4, 5, 6) as broken from documents")
def b12_front_matter(t):
    """Every whole text behind front matter of one of ten forms."""
    return fronted(t).select("doc_id", B.broken_front_matter("file").alias("broken"))


@query("b13_install_gate", "select event_id from events where event_type in ('view', 'click')")
def b13_install_gate(t):
    cfg = F.when(F.col("event_type") == "view", F.lit('{"command": "run"}')).when(F.col("event_type") == "click", F.lit('{"command": " ", "url": "u"}')).otherwise('{"command": ""}')
    e = t.events.withColumn("c", F.from_json(cfg, "command string, url string"))
    return e.filter(B.has_install_config("c.command", "c.url")).select("event_id")


@query(
    "b14_search_projection",
    """select p_partkey as id, p_name as name, p_name || ' ' || p_brand || ' ' || p_type || ' ' || case when p_size > 10 then 'big' else 'small x' end as search_text,
  case when p_size > 10 then 'manual' end as install_method from part""",
)
def b14_search_projection(t):
    p = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("description"), F.lit("").alias("description_zh"),
        F.array("p_type").alias("tags"), F.when(F.col("p_size") > 10, F.array(F.lit("big"))).otherwise(F.array(F.lit("small"), F.lit("x"))).alias("tech_stack"),
        F.struct(F.when(F.col("p_size") > 10, "manual").alias("method")).alias("install"),
    )
    return B.search_projection(p).select("id", "name", "search_text", "install_method")


@query(
    "b15_card_projection",
    """select p_partkey, p_name, coalesce(case when p_size > 5 then p_brand end, 'other') as category, case when p_type = 'SMALL' then p_size end as bundle_size from part""",
)
def b15_card_projection(t):
    p = t.part.withColumns({"category": F.when(F.col("p_size") > 5, F.col("p_brand")), "bundle_size": F.col("p_size")})
    return B.card_projection(
        p, base=["p_partkey", "p_name", "category"], by_type={"SMALL": ["bundle_size"]}, type_="p_type", defaults={"category": F.lit("other")}
    )


@query(
    "b16_whitelist",
    """select p_partkey, '{"p_name":"' || p_name || '"' || case when p_size > 10 then ',"p_size":' || p_size else '' end || '}' as json from part""",
)
def b16_whitelist(t):
    p = t.part.withColumn("p_size", F.when(F.col("p_size") > 10, F.col("p_size")))
    return B.whitelist_json(p, ["p_name", "p_size"], "p_partkey")


@query(
    "b17_recover_stars",
    """
with c as (select c_custkey, case when c_acctbal >= 1000 then cast(floor(c_acctbal / 1000) as bigint) end as stars from customer),
f as (select o_custkey, count(*) as n from orders group by o_custkey)
select c_custkey, coalesce(stars, n) as stars from c left join f on o_custkey = c_custkey where coalesce(stars, n) >= 8
""",
)
def b17_recover_stars(t):
    stars = F.when(F.col("c_acctbal") >= 1000, F.floor(F.col("c_acctbal") / 1000)).otherwise(-1)
    found = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("stars"))
    return B.recover_stars(t.customer.select("c_custkey", stars.alias("stars")), found, key="c_custkey", stars="stars", least=8)


# --- search -------------------------------------------------------------------------------------------

SQL_DOCS = """
with d as (select doc_id, lang, n_chars, text, lower(text) as t, case when source in ('src1', 'src2') then 'abandoned' end as label, coalesce(quality, 0) * 80 as score
  from documents left join labels using (doc_id))"""


def search_docs(t):
    d = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return d.withColumns({
        "freshness_label": F.when(F.col("source").isin("src1", "src2"), "abandoned"),
        "final_score": F.coalesce(F.col("quality"), F.lit(0)) * 80, "stars": F.col("n_chars"), "_ord": F.col("doc_id"),
    })


def sql_hits(words):
    return " + ".join(f"cast(contains(t, '{w}') as integer)" for w in words)


WORDS = ["einen", "the that", "verbe", "qui ", "los"]


@query(
    "j1_keyword_search",
    f"""{SQL_DOCS} select doc_id, hits from (select *, {sql_hits(WORDS)} as hits from d) where hits > 0
order by hits desc, label is null desc, score desc, n_chars desc, doc_id limit 30""",
)
def j1_keyword_search(t):
    out = Q.keyword_search(search_docs(t), ["Einen", *WORDS], Q.result_order(), text="text")
    return out.select("doc_id", "hits")


@query(
    "j1_keyword_search_many",
    f"""{SQL_DOCS}, h as (select 'a' as query, doc_id, {sql_hits(WORDS[:2])} as hits, label, score, n_chars from d union all select 'b', doc_id, {sql_hits(WORDS[2:])}, label, score, n_chars from d),
r as (select *, row_number() over (partition by query order by hits desc, label is null desc, score desc, n_chars desc, doc_id) as rank from h where hits > 0)
select query, cast(rank as integer) as rank, doc_id, hits from r where rank <= 30""",
)
def j1_keyword_search_many(t):
    out = Q.keyword_search_many(search_docs(t), {"a": WORDS[:2], "b": WORDS[2:]}, Q.result_order(), text="text")
    return out.select("query", "rank", "doc_id", "hits")


@query(
    "j2_recommend",
    """
with b as (select l_orderkey, count(distinct p_brand) filter (where p_brand in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4')) as hits, cast(sum(l_linenumber) as bigint) as stars
  from lineitem join part on p_partkey = l_partkey group by l_orderkey)
select l_orderkey, cast(hits as integer) as hits from b where hits > 0 order by hits desc, stars desc, l_orderkey limit 15
""",
)
def j2_recommend(t):
    lines = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    baskets = lines.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("tags"), F.sum("l_linenumber").alias("stars"))
    order = Q.result_order(label=None, score=None, order="l_orderkey")
    out = Q.recommend(baskets, ["brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#1"], order, lists=["tags"])
    return out.select("l_orderkey", "hits")


@query(
    "j3_gate",
    f"""{SQL_DOCS} select doc_id, case when score >= 70 and label is null and {sql_hits(WORDS)} >= 1 then 'top' else 'other' end as tier,
  case when lang = 'en' then lang || '; ' || label2 when lang = 'de' then lang else 'd' || doc_id end as rationale
from (select *, coalesce(label, 'ok') as label2 from d)""",
)
def j3_gate(t):
    d = search_docs(t).withColumn("_t", F.lower("text")).withColumn("hits", Q.hit_count(F.col("_t"), WORDS))
    label = F.coalesce("freshness_label", F.lit("ok"))
    highlights = F.when(F.col("lang") == "en", F.array("lang", label, F.lit("third"))).when(F.col("lang") == "de", F.array("lang"))
    return d.select(
        "doc_id", Q.gate("hits", "final_score", "freshness_label").alias("tier"),
        Q.rationale(highlights, F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("rationale"),
    )


QUERY = "Those einen of verbe"


def sql_rerank(base="0.5::double"):
    words = ["those", "einen", "of", "verbe"]
    phrase = QUERY.lower()
    cover = lambda c: "(" + " + ".join(f"cast(contains({c}, '{w}') as integer)" for w in words) + ")"
    n, d, m, s = (cover(c) for c in ("nm", "de", "me", "t"))
    parts = [base]
    parts += [f"case when contains({c}, '{phrase}') then {p} else 0 end" for c, p in (("nm", 140), ("de", 90), ("me", 50))]
    parts += [f"{n} * 36 + {d} * 20 + {m} * 12 + {s} * 4"]
    parts += [f"case when {c} = 4 then {p} else 0 end" for c, p in ((n, 80), (d, 50), (m, 25), (s, 10))]
    parts += ["case when contains(nm, 'those') or contains(de, 'those') or contains(me, 'those') then 24 when contains(t, 'those') then -12 else -28 end"]
    parts += [f"case when greatest({n}, {d}, {m}) = 0 and {s} > 0 then -40 else 0 end"]
    return " + ".join(parts)


@query(
    "j4_rerank",
    f"""select doc_id, {sql_rerank()} as score from (select doc_id, lower(text) as t, lower(source) as nm,
  lower(text) as de, lower(source || ' ' || lang) as me from documents)""",
)
def j4_rerank(t):
    d = t.documents.select(
        "doc_id", F.lower("text").alias("t"), F.lower("source").alias("nm"),
        F.lower("text").alias("de"), F.lower(F.concat_ws(" ", "source", "lang")).alias("me"),
    )
    score = Q.rerank_score(QUERY, F.lit(0.5), name=F.col("nm"), description=F.col("de"), meta=F.col("me"), search=F.col("t"))
    return d.select("doc_id", score.alias("score"))


def sql_weight(words):
    # DuckDB's distance counts bytes: other characters are made one byte first
    def one(w):
        e = int(len(w) * 0.2 + 0.5)
        away = f"levenshtein(regexp_replace(term, '[^\\x00-\\x7F]', '_', 'g'), '{w}')"
        near = f" when abs(length(term) - {len(w)}) <= {e} and {away} <= {e} then 0.45 * length(term) / (length(term) + {away})" if e else ""
        begins = f"0.375::double * length(term) / (length(term) + 0.3::double * (length(term) - {len(w)}))"
        return f"case when term = '{w}' then 1.0 when starts_with(term, '{w}') then {begins}{near} else 0 end"

    return "(" + " + ".join(one(w) for w in words) + ")::double"


def sql_full_text(words, name="score", shown="round({}, 6)"):
    score = "sum(w * boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.3 + 0.7 * len / mean)))"
    return rf"""
with f as (select doc_id, 'head' as field, 3.0 as boost, regexp_extract(text, '^[^\n]*', 0) as v from documents union all select doc_id, 'text', 1.0, text from documents),
k as (select doc_id, field, boost, regexp_extract_all(lower(v), '[\p{{L}}\p{{N}}]+') as toks from f),
st as (select field, avg(len(toks)) as mean, count(*) as n from k group by field),
x as (select doc_id, field, boost, len(toks) as len, unnest(toks) as term from k),
tf as (select doc_id, field, boost, len, term, count(*) as tf, {sql_weight(words)} as w from x group by all),
h as (select * from tf where w > 0), df as (select field, term, count(*) as df from h group by all)
select doc_id, {shown.format(score)} as {name}
from h join df using (field, term) join st using (field) group by doc_id order by {name} desc, doc_id limit 200
"""


SQL_FULL_TEXT = sql_full_text(["anden", "verbe", "the"])


@query("j5_full_text", SQL_FULL_TEXT)
def j5_full_text(t):
    d = t.documents.select("doc_id", F.regexp_extract("text", "^[^\n]*", 0).alias("head"), "text")
    out = Q.full_text(d, "anden verbe the", {"head": 3.0, "text": 1.0}, key="doc_id")
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query(
    "j5_search_page",
    f"""select doc_id, round(score, 6) as score from (select doc_id, {sql_rerank("base")} as score from (
  select doc_id, base, lower(text) as t, lower(source) as nm, lower(text) as de, lower(source || ' ' || lang) as me
  from documents join ({sql_full_text(QUERY.lower().split(), "base", "{}")}) using (doc_id)))""",
)
def j5_search_page(t):
    d = t.documents.select("doc_id", F.regexp_extract("text", "^[^\n]*", 0).alias("head"), "text", "source", F.concat_ws(" ", "source", "lang").alias("meta"))
    out = Q.search_page(d, QUERY, {"head": 3.0, "text": 1.0}, key="doc_id", name="source", description="text", meta="meta", search="text")
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query("j5_search_blocks", SQL_FULL_TEXT)
def j5_search_blocks(t):
    """The same question to an index whose blocks are read as far as their bounds ask for, terms found by their variants."""
    d = t.documents.select("doc_id", F.regexp_extract("text", "^[^\n]*", 0).alias("head"), "text")
    postings, _, stats = Q.build_index(d, ["head", "text"], key="doc_id", block_rows=128)
    path = scratch(t, "blocks")
    Q.write_blocks(Q.block_index(postings, stats, ["head", "text"], key="doc_id")[0], path)
    stored, bounds = Q.read_blocks(t.spark, path)
    words = scratch(t, "words")
    stored.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")).write.parquet(words)
    vocabulary = t.spark.read.parquet(words)
    # the SQL counts a term's documents among those that match
    out, _ = Q.search_blocks(stored, bounds, vocabulary, Q.neighbour_table(vocabulary), stats, "anden verbe the", {"head": 3.0, "text": 1.0}, key="doc_id")
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query("j5_search_index", SQL_FULL_TEXT)
def j5_search_index(t):
    """Build the index, write and read its postings, and ask the same question."""
    from .reading import scratch

    d = t.documents.select("doc_id", F.regexp_extract("text", "^[^\n]*", 0).alias("head"), "text")
    postings, _, stats = Q.build_index(d, ["head", "text"], key="doc_id")
    path = scratch(t, "postings")
    Q.write_postings(postings, path, key="doc_id")
    stored = t.spark.read.schema(postings.schema).parquet(path)
    words = stored.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    out = Q.search_index(stored, words, stats, "anden verbe the", {"head": 3.0, "text": 1.0}, key="doc_id")
    return out.select("doc_id", F.round("score", 6).alias("score"))
