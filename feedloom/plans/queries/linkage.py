"""Queries of the linkage operators (D1-D12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed, urls
from ...operators import linkage as L
from ...operators.relational import first_per_key
from ..registry import query

HOST = r"example\.(?:com|org|net)"

# Identity of a text: its words, without case and spacing.
SQL_TEXT_KEY = r"lower(trim(regexp_replace(text, '\s+', ' ', 'g')))"
SQL_PRIORITY = r"cast(regexp_extract(source, '(\d+)', 1) as integer)"


def text_key():
    return F.sha2(F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))), 256)


def priority():
    return F.regexp_extract("source", r"(\d+)", 1).cast("int")


def documents(t):
    return t.documents.withColumn("key", text_key()).withColumn("priority", priority())


@query(
    "d1_url_keys",
    r"""
select page_id,
  regexp_replace(regexp_replace(lower(url), '/+$', ''), '\.git$', '') as url_key,
  lower(regexp_replace(regexp_replace(regexp_replace(trim(url), '/+$', ''), '\.git$', ''), '[?#].*$', '')) as repo_key,
  lower(nullif(regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 1), ''))
    || '/' || lower(regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 2)) as owner_repo
from pages
""",
)
def d1_url_keys(t):
    return t.pages.select(
        "page_id",
        urls.normalize_url("url").alias("url_key"),
        urls.normalize_repo_url("url").alias("repo_key"),
        urls.owner_repo("url", HOST).alias("owner_repo"),
    )


@query(
    "d2_source_tier",
    r"""
with p as (select page_id, url, regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 1) as o,
  regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 1) || '/' ||
  regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 2) as slug from pages)
select page_id, case when regexp_matches(url, '^https?://spam-farm\.') then 900 when o = '' then 100
  when slug in ('en/671', 'fr/414') then 200 when o = 'en' then 1000 when o in ('de', 'es') then 900
  when contains(url, '#top') then 800 else 500 end as tier from p
""",
)
def d2_source_tier(t):
    tier = L.source_tier(
        "url", host=HOST, registry=r"^https?://spam-farm\.", mirrors=["en/671", "fr/414"],
        top_owner="en", official=["de", "es"], anchor="#top",
    )
    return t.pages.select("page_id", tier.alias("tier"))


@query(
    "d3_skill_identity",
    r"""
with p as (select page_id, regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 1) as o,
  regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 2) as r,
  regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages)
select page_id, 'skill|' || lower(o) || '/' || lower(r) || '|' || lower(title) as skill_key
from p where o <> '' and title <> ''
""",
)
def d3_skill_identity(t):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    keyed = t.pages.select("page_id", L.skill_key("url", title, host=HOST).alias("skill_key"))
    return keyed.filter(F.col("skill_key").isNotNull())


@query(
    "d4_server_identity",
    r"""
with p as (select page_id, regexp_extract(url, '^https?://spam-farm\.example\.(?:org|com|net)/(.+?)/?$', 1) as reg,
  regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 1) as o,
  regexp_extract(url, 'example\.(?:com|org|net)/([^/]+)/([^/#?]+)', 2) as r from pages)
select page_id, case when reg <> '' then 'registry|' || lower(trim(reg)) || '|'
  when o <> '' then 'repo|' || lower(o) || '/' || lower(r) || '|' end as server_key from p
""",
)
def d4_server_identity(t):
    registry = r"^https?://spam-farm\.example\.(?:org|com|net)/(.+?)/?$"
    return t.pages.select("page_id", L.server_key("url", host=HOST, registry=registry).alias("server_key"))


@query(
    "d5_plugin_identity",
    """
select p_partkey, case when p_size > 10 then 'plugin|' || p_brand || '|' || p_name end as plugin_key from part
""",
)
def d5_plugin_identity(t):
    name = F.when(F.col("p_size") > 10, F.col("p_name"))
    return t.part.select("p_partkey", L.plugin_key("p_brand", name).alias("plugin_key"))


# Documents as entries of four types, with addresses as the feeds write them.
def typed(t):
    n, m = F.col("doc_id").cast("string"), (F.col("doc_id") % 7).cast("string")
    type_ = F.when(F.col("lang") == "en", "skill").when(F.col("lang") == "de", "mcp").when(F.col("lang") == "fr", "rule").otherwise("plugin")
    repo = F.when(F.col("doc_id") % 2 == 0, fixed.RULE_REPOS[0]).otherwise(fixed.RULE_REPOS[1])
    url = (
        F.when(F.col("lang") == "en", F.concat(F.lit("https://github.com/O/r"), m, F.lit("#skill=S"), F.col("source")))
        .when((F.col("lang") == "de") & (F.col("doc_id") % 3 == 0), F.concat(F.lit("https://registry.modelcontextprotocol.io/v0/servers/io.github.o%2Fr"), m))
        .when(F.col("lang") == "de", F.concat(F.lit("https://github.com/o/r"), m, F.lit("/tree/main/"), F.col("source")))
        .when(F.col("lang") == "fr", F.concat(F.lit("https://github.com/"), repo, F.lit("/blob/main/rules/"), F.col("source"), F.lit("/"), n))
        .otherwise(F.lit("https://example.com/p"))
    )
    plugin = F.when(F.col("doc_id") % 5 > 0, F.col("source"))
    install = F.struct(F.concat(F.lit("o/r"), m).alias("marketplace_repo"), plugin.alias("plugin_name"))
    return t.documents.select(
        "doc_id", type_.alias("type"), url.alias("source_url"), F.lit("n").alias("name"), install.alias("install"),
        (F.col("doc_id") % 4).cast("int").alias("source_priority"))


SQL_TYPED = f"""
with e as (select doc_id, lang, source, doc_id % 7 as m, doc_id % 5 > 0 as named from documents),
k as (select doc_id, case
  when lang = 'en' then 'skill|o/r' || m || '|s' || source
  when lang = 'de' and doc_id % 3 = 0 then 'repo|o/r' || m || '|'
  when lang = 'de' then 'repo|o/r' || m || '|' || source
  when lang = 'fr' then 'rule|' || source
  when named then 'plugin|o/r' || m || '|' || source end as key,
  case when lang = 'de' then case when doc_id % 3 = 0 then 1 else 0 end when lang = 'fr' then doc_id % 2 else 0 end as special,
  case when lang not in ('en', 'de', 'fr') then doc_id % 4 else 0 end as preferred from e)"""


@query("d5_identity_by_type", SQL_TYPED + " select doc_id, coalesce(key, '-') as key from k")
def d5_identity_by_type(t):
    return typed(t).select("doc_id", F.coalesce(L.identity_key(), F.lit("-")).alias("key"))


@query(
    "d6_ranked_by_type",
    SQL_TYPED + """ select doc_id from (select *, row_number() over (partition by key order by special, -preferred, doc_id) as rn from k) where rn = 1 or key is null""",
)
def d6_ranked_by_type(t):
    e = typed(t).withColumn("key", L.identity_key()).withColumn("rank", L.identity_rank())
    return L.collapse(e, "key", [F.asc("rank"), F.asc("doc_id")]).select("doc_id")


@query(
    "d6_identity_collapse",
    f"""
select doc_id, lang, source, n_chars from (
  select *, row_number() over (partition by {SQL_TEXT_KEY} order by {SQL_PRIORITY} desc, doc_id) as rn from documents)
where rn = 1
""",
)
def d6_identity_collapse(t):
    best = L.collapse(documents(t), "key", [F.desc("priority"), F.asc("doc_id")], every_row_keyed=True)
    return best.select("doc_id", "lang", "source", "n_chars")


@query(
    "d7_donor_fields",
    f"""
with d as (select d.*, l.quality, {SQL_TEXT_KEY} as key, {SQL_PRIORITY} as pr
  from documents d left join labels l using (doc_id))
select arg_min(doc_id, (-pr, doc_id)) as doc_id,
  coalesce(arg_min(quality, (-pr, doc_id)) filter (where quality <> 0), 0) as quality,
  cast(count(distinct source) as bigint) as n_sources,
  (select string_agg(source, ',' order by m) from (
     select source, min((-pr, doc_id)) as m from d e where e.key = d.key group by source)) as sources
from d group by key
""",
)
def d7_donor_fields(t):
    d = documents(t).join(t.labels.select("doc_id", "quality"), "doc_id", "left").select(
        "key", (-F.col("priority")).alias("rank"), "doc_id", "quality", F.array("source").alias("sources")
    )
    out = L.collapse_with_donors(d, "key", ["rank", "doc_id"], {"quality": "number"}, ["sources"], every_row_keyed=True)
    return out.select(
        "doc_id",
        F.coalesce("quality", F.lit(0)).alias("quality"),
        F.size("sources").cast("long").alias("n_sources"),
        F.array_join("sources", ",").alias("sources"),
    )


@query(
    "d8_greedy_dedup",
    """
with recursive o as (select c_custkey, row_number() over (order by c_custkey) as n,
    c_nationkey || c_mktsegment as k1, cast(cast(floor(c_acctbal / 50) as bigint) as varchar) as k2 from customer),
s as (
  select cast(0 as bigint) as n, [cast(null as varchar)] as a, [cast(null as varchar)] as b, false as ok
  union all
  select o.n, case when list_contains(s.a, o.k1) or list_contains(s.b, o.k2) then s.a else list_append(s.a, o.k1) end,
    case when list_contains(s.a, o.k1) or list_contains(s.b, o.k2) then s.b else list_append(s.b, o.k2) end,
    not (coalesce(list_contains(s.a, o.k1), false) or coalesce(list_contains(s.b, o.k2), false))
  from s join o on o.n = s.n + 1)
select o.c_custkey, o.k1, o.k2 from s join o using (n) where s.ok
""",
)
def d8_greedy_dedup(t):
    c = t.customer.select(
        "c_custkey",
        F.concat(F.col("c_nationkey").cast("string"), "c_mktsegment").alias("k1"),
        F.floor(F.col("c_acctbal") / 50).cast("string").alias("k2"),
    )
    return L.greedy_first_wins(c, ["k1", "k2"], "c_custkey")


@query(
    "d9_dedup_report",
    f"""
with a as (select lang, count(*) as n_before, count(distinct {SQL_TEXT_KEY}) as n_keys from documents group by lang),
w as (select lang, row_number() over (partition by {SQL_TEXT_KEY} order by {SQL_PRIORITY} desc, doc_id) as rn from documents),
b as (select lang, count(*) as n_after from w where rn = 1 group by lang)
select lang, n_before, coalesce(n_after, 0) as n_after, (1 - coalesce(n_after, 0) / n_before) * 100 as drop_pct,
  (1 - coalesce(n_after, 0) / n_before) * 100 > 50 as alarm from a left join b using (lang)
""",
)
def d9_dedup_report(t):
    d = documents(t)
    return L.dedup_report(d, L.collapse(d, "key", [F.desc("priority"), F.asc("doc_id")], every_row_keyed=True), "lang")


@query(
    "d10_verified_best",
    """
select l_partkey, l_suppkey, l_orderkey, l_linenumber, l_extendedprice from (
  select *, row_number() over (partition by l_partkey, l_suppkey
    order by l_extendedprice desc, l_orderkey, l_linenumber, l_quantity, l_shipdate) as rn
  from lineitem where l_returnflag = 'R') where rn = 1
""",
)
def d10_verified_best(t):
    order = [F.desc("l_extendedprice"), *map(F.asc, ("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"))]
    best = first_per_key(t.lineitem.filter(F.col("l_returnflag") == "R"), ["l_partkey", "l_suppkey"], order)
    return best.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "d11_first_seen",
    f"""
select doc_id, source, rn > 1 as rejected from (select doc_id, source,
  row_number() over (partition by {SQL_TEXT_KEY} order by doc_id) as rn from documents)
""",
)
def d11_first_seen(t):
    kept, rejected = L.rejects_by_first_seen(documents(t), "key", "doc_id")
    return (
        kept.select("doc_id", "source", F.lit(False).alias("rejected"))
        .unionByName(rejected.select("doc_id", "source", F.lit(True).alias("rejected")))
    )


@query(
    "d12_split_url",
    r"""
with p as (select page_id, url, regexp_replace(url, '#.*$', '') as u from pages)
select page_id, regexp_extract(u, '^https?://(?:[^/]*\.)?example\.(?:com|org|net)/([^/]+)/([^/]+)', 1) as owner,
  regexp_extract(u, '^https?://(?:[^/]*\.)?example\.(?:com|org|net)/([^/]+)/([^/]+)', 2) as repo,
  'HEAD' as ref, '' as sub_path, regexp_extract(url, '#(.*)$', 1) as fragment
from p where regexp_matches(u, '^https?://(?:[^/]*\.)?example\.(?:com|org|net)/([^/]+)/([^/]+)')
""",
)
def d12_split_url(t):
    parts = t.pages.select("page_id", urls.split_source_url("url", r"https?://(?:[^/]*\.)?" + HOST).alias("s"))
    return parts.filter("s is not null").select("page_id", "s.*")
