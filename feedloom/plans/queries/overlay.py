"""Queries of overlays, lookups and snapshot comparison (C1-C30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.values import first_rule
from ...operators import overlay as O
from ...sources.keyed import KeyedTable
from ..registry import query, scratch

# A snapshot of customers: all that they ordered up to the end of a year.


def snapshot(t, year: int):
    o = t.orders.filter(F.year("o_orderdate") <= year)
    return o.groupBy(F.col("o_custkey").alias("id")).agg(
        F.sum(F.floor("o_totalprice")).alias("install_count"),
        F.max_by("o_orderstatus", "o_orderkey").alias("status"),
        F.max_by("o_orderpriority", "o_orderkey").alias("version"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("published"),
        F.min("o_orderkey").alias("_ord"),
    )


def sql_snapshot(year: int) -> str:
    return f"""(select o_custkey as id, cast(sum(cast(floor(o_totalprice) as bigint)) as bigint) as install_count,
  arg_max(o_orderstatus, o_orderkey) as status, arg_max(o_orderpriority, o_orderkey) as version,
  strftime(max(o_orderdate), '%Y-%m-%d') as published, min(o_orderkey) as _ord
  from orders where year(o_orderdate) <= {year} group by o_custkey)"""


def shop(t):
    """Customers as entries and suppliers as hand-made rows that partly mean the same ones."""
    bucket = lambda n, a: F.concat(F.col(n).cast("string"), F.lit("/"), F.floor(F.col(a) / 500).cast("string"))
    none = F.array().cast("array<string>")
    entries = t.customer.select(
        F.col("c_custkey").alias("id"), bucket("c_nationkey", "c_acctbal").alias("url_key"),
        F.array("c_mktsegment").alias("tags"), none.alias("tech_stack"), F.col("c_custkey").alias("_ord"),
        F.col("c_name").alias("name"),
    )
    curated = t.supplier.select(
        (F.col("s_suppkey") * 40).alias("id"), bucket("s_nationkey", "s_acctbal").alias("url_key"),
        F.array(F.lit("curated"), F.concat(F.lit("s"), F.col("s_nationkey").cast("string"))).alias("tags"),
        F.array(F.concat(F.lit("t"), F.col("s_suppkey").cast("string"))).alias("tech_stack"),
        F.col("s_suppkey").alias("_ord"), F.col("s_name").alias("name"),
    )
    return entries, curated


SQL_SHOP = """
c as (select c_custkey as id, c_nationkey || '/' || cast(floor(c_acctbal / 500) as bigint) as url_key, c_mktsegment as tag,
  c_custkey as o, c_name as name from customer),
s as (select s_suppkey * 40 as id, s_nationkey || '/' || cast(floor(s_acctbal / 500) as bigint) as url_key, s_nationkey as n,
  s_suppkey as o, s_name as name from supplier)"""


@query(
    "c1_overlay_curated",
    f"""with {SQL_SHOP},
u as (select url_key, arg_max(id, o) as id from c group by url_key),
m as (select s.*, coalesce(c.id, u.id) as target from s left join c on c.id = s.id left join u on u.url_key = s.url_key),
a as (select target, string_agg('t' || o, ',' order by o desc) as ts,
  (select string_agg(x, ',' order by p, x desc) from (select 'curated' as x, 0 as p union select 's' || n, 1 from m m2 where m2.target = m.target)) as tags
  from m where target is not null group by target),
w as (select *, row_number() over (partition by url_key order by o) as rn, min(o) over (partition by url_key) as fo from m where target is null),
late as (select fo, string_agg('t' || o, ',' order by o desc) as ts from w where rn > 1 group by fo)
select c.id, coalesce(a.ts, '') as stack, c.tag || coalesce(',' || split_part(a.tags, ',', 1), '') as first_tags from c left join a on a.target = c.id
union all
select w.id, coalesce(late.ts || ',', '') || 't' || w.o, 'curated,s' || w.n from w left join late on late.fo = w.o where rn = 1
""",
)
def c1_overlay_curated(t):
    entries, curated = shop(t)
    out = O.overlay_curated(entries, curated)
    return out.select(
        "id", F.array_join("tech_stack", ",").alias("stack"), F.array_join(F.slice("tags", 1, 2), ",").alias("first_tags")
    )


@query(
    "c2_prior_overlay",
    f"""select n.id, case when n.status = 'P' then o.published else n.published end as evaluated_at,
  case when n.status = 'P' then null else n.version end as score, case when n.status = 'P' then o.version end as prior_score
from {sql_snapshot(1998)} n left join {sql_snapshot(1997)} o using (id)""",
)
def c2_prior_overlay(t):
    ev = F.struct(F.col("published").alias("evaluated_at"), F.col("version").alias("score"))
    new = snapshot(t, 1998).select("id", F.when(F.col("status") != "P", ev).alias("ev"))
    old = snapshot(t, 1997).select("id", ev.alias("ev"))
    out = O.overlay_prior(new, old, value="ev", stamps=["evaluated_at"])
    return out.select("id", "ev.*", F.col("prior_ev.score").alias("prior_score"))


@query(
    "c3_keep_fields",
    f"""select n.id, coalesce(nullif(case when n.status = 'P' then '' else n.version end, ''), o.version, '') as version,
  case when n.status = 'F' then coalesce(o.install_count, 0) else n.install_count end as install_count
from {sql_snapshot(1998)} n left join {sql_snapshot(1997)} o using (id)""",
)
def c3_keep_fields(t):
    new = snapshot(t, 1998).select(
        "id",
        F.when(F.col("status") == "P", "").otherwise(F.col("version")).alias("version"),
        F.when(F.col("status") == "F", 0).otherwise(F.col("install_count")).alias("install_count"),
    )
    return O.keep_fields(new, snapshot(t, 1997), {"version": "string", "install_count": "number"})


@query(
    "c4_backfill_dates",
    f"""select n.id, coalesce(case when n.status = 'O' then n.published end, o.published, case when n.status = 'F' then n.version end) as pushed_at
from {sql_snapshot(1998)} n left join {sql_snapshot(1997)} o using (id)""",
)
def c4_backfill_dates(t):
    new = snapshot(t, 1998).select(
        "id", F.when(F.col("status") == "O", F.col("published")).alias("pushed_at"),
        F.when(F.col("status") == "F", F.col("version")).alias("registered"),
    )
    old = snapshot(t, 1997).select("id", F.col("published").alias("old_pushed"))
    return O.backfill(new.join(old, "id", "left"), "pushed_at", "old_pushed", "registered").select("id", "pushed_at")


SQL_SEEN = """
with e as (select o_orderkey as id, case o_orderstatus when 'F' then 'mcp' when 'O' then 'skill' else 'rule' end as type,
  o_custkey as url, case when o_orderpriority <> '5-LOW' then strftime(o_orderdate, '%Y-%m-%d') end as added from orders),
f as (select type, url, arg_min(added, id) as d from e where added is not null and type <> 'rule' group by all)"""


@query(
    "c5_first_seen",
    f"""{SQL_SEEN}
select e.id, case when e.type <> 'rule' then coalesce(e.added, f.d, '2002-01-01') end as added_at
from e left join f on f.type = e.type and f.url = e.url""",
)
def c5_first_seen(t):
    type_ = first_rule([(F.col("o_orderstatus") == "F", "mcp"), (F.col("o_orderstatus") == "O", "skill")], "rule")
    e = t.orders.select(
        F.col("o_orderkey").alias("id"), type_.alias("type"), F.col("o_custkey").alias("url_key"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("added_at"),
        F.col("o_orderkey").alias("_ord"),
    )
    return O.first_seen(e, e, "2002-01-01").select("id", "added_at")


def bundles(t):
    """Orders as plugins that list three members each; parts as the members."""
    p = t.part.select("p_partkey", "p_name", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand"), "p_size")
    o = t.orders.join(p, F.col("o_custkey") == F.col("p_partkey"))
    names = F.array(
        F.concat("brand", F.lit(":"), "p_name"),
        F.concat(F.lit("part:"), F.col("o_custkey").cast("string")),
        F.concat(F.lit("x"), "o_orderstatus", F.lit(":"), "p_name"),
    )
    groups = o.select(F.col("o_orderkey").alias("plugin_id"), names.alias("namespaces"), F.col("brand").alias("repo"), F.col("o_orderkey").alias("_ord"))
    members = p.filter(F.col("p_size") > 25).select(
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_size") > 40, F.concat("brand", F.lit(":"), "p_name")).alias("namespace"),
        F.col("p_name").alias("tail"), F.col("brand").alias("repo"), F.col("p_partkey").alias("_ord"),
    )
    return groups, members


SQL_BUNDLES = """
with p as (select p_partkey, p_name, split_part(p_brand, '#', 2) as brand, p_size from part),
g as (select o_orderkey as plugin_id, brand as repo, o_custkey, o_orderstatus, p_name from orders join p on p_partkey = o_custkey),
f as (select plugin_id, 0 as pos, repo || ':' || p_name as name from g union all select plugin_id, 1, 'part:' || o_custkey from g
  union all select plugin_id, 2, 'x' || o_orderstatus || ':' || p_name from g),
m as (select 'part-' || p_partkey as id, case when p_size > 40 then brand || ':' || p_name end as ns, p_name as tail, brand as repo, p_partkey as o
  from p where p_size > 25),
n1 as (select ns, arg_min(id, o) as id from m where ns is not null group by ns),
n4 as (select tail, repo, arg_min(id, o) as id from m group by all),
n5 as (select tail, arg_min(id, o) as id from m group by all),
r as (select f.plugin_id, f.pos, f.name, coalesce(n1.id, m2.id, n4.id, n5.id) as member,
  case when n1.id is not null then 'namespace' when m2.id is not null then 'slug' when n4.id is not null then 'same_repo'
    when n5.id is not null then 'tail' else 'orphan' end as strategy
  from f join g using (plugin_id) left join n1 on n1.ns = f.name left join m m2 on m2.id = replace(f.name, ':', '-')
  left join n4 on n4.tail = split_part(f.name, ':', 2) and n4.repo = g.repo left join n5 on n5.tail = split_part(f.name, ':', 2))"""


@query("c6_resolve_members", SQL_BUNDLES + " select * from r")
def c6_resolve_members(t):
    return O.resolve_members(*bundles(t))


@query(
    "c6_owner_of_member",
    SQL_BUNDLES + " select member, max(plugin_id) as plugin_id from r where member is not null group by member",
)
def c6_owner_of_member(t):
    groups, members = bundles(t)
    return O.owner_of_member(O.resolve_members(groups, members), groups)


@query(
    "c7_aligned_members",
    SQL_BUNDLES + """ select plugin_id, string_agg(coalesce(member, '-'), ',' order by pos) as members,
  count(*) filter (where member is null) as n_orphans from r group by plugin_id""",
)
def c7_aligned_members(t):
    aligned = O.aligned_members(O.resolve_members(*bundles(t)))
    return aligned.select(
        "plugin_id",
        F.array_join("members", ",", "-").alias("members"),
        F.size(F.filter("members", lambda m: m.isNull())).cast("long").alias("n_orphans"),
    )


@query(
    "c8_fallback_result",
    """select doc_id, coalesce(case when quality = 1 then 80 + toxic end, case when quality = 0 then 20 end, n_chars % 50) as score,
  case when quality = 1 then 'new' when quality = 0 then 'old' else 'synth' end as provenance
from documents left join labels using (doc_id)""",
)
def c8_fallback_result(t):
    new = t.labels.filter("quality = 1").select("doc_id", (80 + F.col("toxic").cast("long")).alias("score"))
    old = t.labels.filter("quality = 0").select("doc_id", F.lit(20).cast("long").alias("score"))
    d = t.documents.select("doc_id", "n_chars")
    out = O.fallback_result(d, new, old, key="doc_id", value="score", synthetic=F.col("n_chars") % 50)
    return out.select("doc_id", "score", "provenance")


@query(
    "c9_restore_side_effects",
    f"""select n.id, coalesce(o.version, n.version) as version,
  case when o.status = 'F' then o.published else n.published end as description
from {sql_snapshot(1998)} n left join {sql_snapshot(1997)} o using (id)""",
)
def c9_restore_side_effects(t):
    def rows(year):
        return snapshot(t, year).select(
            "id", "version", F.col("published").alias("description"),
            F.when(F.col("status") == "F", "original").alias("description_original"),
        )

    out = O.restore_side_effects(rows(1998), rows(1997), ["version"])
    return out.select("id", "version", "description")


SQL_CACHE = """
with k as (select doc_id, sha256('full:' || sha256(text) || ':1.abc') as cache_key, n_chars from documents),
c as (select cache_key, max(n_chars) as score, min(doc_id) as first_doc from k group by cache_key)"""


@query(
    "c10_cache_split",
    SQL_CACHE + """ select doc_id, cache_key, coalesce(c.score, 0) as score, c.score is not null as hit
from k left join (select * from c where score >= 300 and first_doc >= 20) c using (cache_key)""",
)
def c10_cache_split(t):
    k = t.documents.select("doc_id", "n_chars", F.sha2(F.concat(F.lit("full:"), F.sha2("text", 256), F.lit(":1.abc")), 256).alias("cache_key"))
    cache = k.groupBy("cache_key").agg(F.max("n_chars").alias("score"), F.min("doc_id").alias("first_doc"))
    # rows of low documents have run out, the others have not
    cache = cache.filter("score >= 300").select(
        "cache_key", "score",
        F.when(F.col("first_doc") < 20, F.to_timestamp(F.lit("2023-12-31"))).otherwise(F.to_timestamp(F.lit("2024-03-01"))).alias("expires_at"),
    )
    table = KeyedTable(t.spark, scratch(t, "cache"), "cache_key string, score bigint, expires_at timestamp", ["cache_key"], buckets=8)
    table.replace(cache)
    out = O.split_by_cache(k, table, "2024-02-01", spread=["doc_id"])
    return out.select("doc_id", "cache_key", F.coalesce("score", F.lit(0)).alias("score"), "hit")


@query(
    "c11_latest_cached",
    """select user_id, event_type, event_id from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id) as rn from events)
where rn = 1 and ts + interval 3 day >= timestamp '2024-02-01'""",
)
def c11_latest_cached(t):
    e = t.events.withColumn("expires_at", F.col("ts") + F.expr("interval 3 days"))
    out = O.latest_cached(e, "2024-02-01", keys=["user_id", "event_type"], at="ts", cache_key="event_id")
    return out.select("user_id", "event_type", "event_id")


SQL_DRIFT = f"""
with b as (select coalesce(o.id, n.id) as id, coalesce(o.install_count, 0) as old, coalesce(n.install_count, 0) as new,
  o.id is not null as ho, n.id is not null as hn from {sql_snapshot(1997)} o full join {sql_snapshot(1998)} n using (id)),
d as (select *, case when not ho then 'added' when not hn then 'removed'
  when case when old > 0 then abs((new - old) / old) >= 0.2 else new >= 1000 end then 'changed' else 'stable' end as class from b)"""


@query(
    "c12_reuse_or_evaluate",
    SQL_DRIFT + f""" select n.id, case when n.status <> 'P' and d.class = 'stable' and c.id is not null then 'reuse' else 'evaluate' end as path
from {sql_snapshot(1998)} n left join d using (id) left join (select id from {sql_snapshot(1996)}) c using (id)""",
)
def c12_reuse_or_evaluate(t):
    new = snapshot(t, 1998).withColumn("raw_id", F.col("id"))
    diff = O.drift_diff(snapshot(t, 1997), new)
    unstable = diff.filter("class <> 'stable'").select("id")
    out = O.reuse_or_evaluate(new, unstable, snapshot(t, 1996).select("id"), derived=F.col("status") != "P")
    return out.select("id", "path")


@query(
    "c13_ledger_gate",
    """
with f as (select user_id, count(*) as n, max(ts) as last from events where event_type = 'error' and value > 60 group by user_id)
select event_id, case when f.n >= 4 then 'quarantined' when f.n = 2 and f.last + interval 7 day > timestamp '2024-01-30' then 'deferred'
  when f.n = 3 and f.last + interval 28 day > timestamp '2024-01-30' then 'deferred' when f.n = 1 and f.last > timestamp '2024-01-30' then 'deferred' else 'eligible' end as gate
from events left join f using (user_id)
""",
)
def c13_ledger_gate(t):
    from ...operators.state import next_retry

    f = t.events.filter("event_type = 'error' and value > 60").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("attempt_count"), F.max("ts").alias("last")
    )
    ledger = f.withColumn("next_retry_after", next_retry("attempt_count", "last"))
    return O.ledger_gate(t.events, ledger, "2024-01-30", key="user_id").select("event_id", "gate")


@query(
    "c14_verify_membership",
    """
with m as (select s_suppkey as repo, case when s_acctbal < 3000 then 'bad name!' else 'market-' || s_suppkey end as market_name from supplier)
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, nullif(market_name, 'bad name!') as market_name,
  market_name <> 'bad name!' and l_partkey >= l_suppkey and l_partkey <= l_suppkey + 1000 and (l_partkey - l_suppkey) % 5 = 0 as verified
from lineitem l join m on m.repo = l.l_suppkey
""",
)
def c14_verify_membership(t):
    listed = F.transform(
        F.sequence(F.col("s_suppkey"), F.col("s_suppkey") + 1000, F.lit(5).cast("long")), lambda n: F.concat(F.lit(" "), n.cast("string"))
    )
    manifests = t.supplier.select(
        F.col("s_suppkey").alias("repo"),
        F.when(F.col("s_acctbal") < 3000, "bad name!").otherwise(F.concat(F.lit("market-"), F.col("s_suppkey").cast("string"))).alias("market_name"),
        listed.alias("plugin_names"),
    )
    df = t.lineitem.withColumns({"repo": F.col("l_suppkey"), "plugin_name": F.col("l_partkey").cast("string")})
    out = O.verify_membership(df, manifests, spread=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "market_name", "verified")


@query(
    "c15_merge_by_priority",
    f"""with {SQL_SHOP},
n as (select n_nationkey || '/' || 3 as url_key, 'NATION ' || n_name as d, n_nationkey as o from nation),
a as (select url_key, 0 as src, o, name as d from s union all select url_key, 1, o, d from n union all select url_key, 2, o, name from c),
w as (select *, row_number() over (partition by url_key order by src, o) as rn from a)
select w.url_key, w.d as description, case when not contains(w.d, 'NATION') then n.d end as other
from w left join n using (url_key) where rn = 1""",
)
def c15_merge_by_priority(t):
    entries, curated = shop(t)
    nations = t.nation.select(
        F.concat(F.col("n_nationkey").cast("string"), F.lit("/3")).alias("url_key"),
        F.concat(F.lit("NATION "), "n_name").alias("d"), F.col("n_nationkey").cast("long").alias("_ord"),
    )
    rows = lambda df, d: df.select("url_key", F.col(d).alias("description"), "_ord")
    out = O.merge_by_priority(
        [rows(curated, "name"), rows(nations, "d"), rows(entries, "name")], "url_key", "_ord",
        second_text="other", pattern="NATION",
    )
    return out.select("url_key", "description", "other")


@query(
    "c16_merge_incumbent",
    f"""with {SQL_SHOP}
select id, name from s union all
select id, name from c where not exists (select 1 from s where s.url_key = c.url_key) and not exists (select 1 from s where s.id = c.id)""",
)
def c16_merge_incumbent(t):
    entries, curated = shop(t)
    return O.merge_incumbent(entries, curated).select("id", "name")


SQL_COVERAGE = """
with x as (select n_nationkey || '' as slug, case when n_regionkey < 3 then 'skill' else 'mcp' end as type, n_name from nation),
cat as (select s_nationkey || '' as slug, case when s_acctbal > 3000 then 'skill' else 'mcp' end as type, s_suppkey as id, cast(floor(s_acctbal) as bigint) as n, s_suppkey as o from supplier),
b as (select type, slug, arg_max(id, (n, -o)) as id from cat group by all),
mi as (select min(id) as id from cat where type = 'skill' and slug = '1'),
r as (select x.type, x.n_name, case when b.id is not null then 'direct' when x.type = 'skill' and x.slug = '2' and mi.id is not null then 'mirror' else 'missing' end as status,
  coalesce(b.id, case when x.type = 'skill' and x.slug = '2' then mi.id end) as representative
  from x left join b using (type, slug) left join mi on true)"""


def coverage_frame(t):
    expected = t.nation.select(
        F.col("n_nationkey").cast("string").alias("slug"), F.when(F.col("n_regionkey") < 3, "skill").otherwise("mcp").alias("type"), "n_name"
    )
    catalog = t.supplier.select(
        F.col("s_nationkey").cast("string").alias("slug"), F.when(F.col("s_acctbal") > 3000, "skill").otherwise("mcp").alias("type"),
        F.col("s_suppkey").alias("id"), F.floor("s_acctbal").alias("install_count"), F.col("s_suppkey").alias("_ord"),
    )
    return O.coverage(expected, catalog, mirrors=["1"], mirror_of="2")


@query("c17_coverage", SQL_COVERAGE + " select type, n_name, status, coalesce(representative, -1) as representative from r")
def c17_coverage(t):
    out = coverage_frame(t)
    return out.select("type", "n_name", "status", F.coalesce("representative", F.lit(-1)).alias("representative"))


@query(
    "c18_reconcile",
    """select o_orderkey, o_orderstatus from orders where o_orderstatus = 'P'
  or exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = o_orderstatus)""",
)
def c18_reconcile(t):
    index = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("type"))
    present = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("type"))
    out = O.reconcile(index, present, known=["F", "O"])
    return out.select(F.col("id").alias("o_orderkey"), F.col("type").alias("o_orderstatus"))


@query(
    "c19_fan_out_text",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(p.p_name, l_returnflag) as description
from lineitem left join (select p_partkey, p_name from part where p_size > 10) p on p_partkey = l_partkey""",
)
def c19_fan_out_text(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.col("l_returnflag").alias("description"))
    texts = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return O.fan_out(df, texts, ["l_partkey"], "description", value="p_name")


@query(
    "c20_fill_empty_list",
    """select doc_id, case when lang = 'en' then 'en' else coalesce('q' || quality, '') end as tags from documents left join labels using (doc_id)""",
)
def c20_fill_empty_list(t):
    none = F.array().cast("array<string>")
    d = t.documents.select("doc_id", F.when(F.col("lang") == "en", F.array("lang")).otherwise(none).alias("tags"))
    side = t.labels.select("doc_id", F.array(F.concat(F.lit("q"), F.col("quality").cast("string"))).alias("tags"))
    return O.fill_empty_list(d, side, "doc_id", "tags").select("doc_id", F.array_join("tags", ",").alias("tags"))


@query(
    "c21_containment_match",
    """
with n as (select p_partkey, lower(trim(p_name)) as n from part),
t as (select lower(trim(split_part(p_name, ' ', 2))) || case when p_size < 4 then ' kit' else '' end as t, p_partkey as o from part
  union all select 'x' || lower(p_name) || 'y', p_partkey + 100000000 from part),
d as (select t, min(o) as o from t where t <> '' group by t),
h as (select n, min(o) as o from (select distinct n from n) n join d on contains(n, t) or contains(t, n) group by n)
select p_partkey, h.o as row_id from n left join h using (n)
""",
)
def c21_containment_match(t):
    kit = F.when(F.col("p_size") < 4, " kit").otherwise("")
    rows = t.part.select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), kit).alias("title"), F.col("p_partkey").alias("row_id"))
    rows = rows.unionByName(
        t.part.select(F.concat(F.lit("x"), "p_name", F.lit("y")).alias("title"), (F.col("p_partkey") + 100000000).alias("row_id"))
    ).withColumn("_ord", F.col("row_id"))
    names = t.part.select("p_partkey", "p_name")
    out = O.containment_match(names, rows, name="p_name", title="title", value="row_id", order="_ord")
    return out.select("p_partkey", "row_id")


@query(
    "c22_match_either",
    f"""with {SQL_SHOP},
h as (select s.o, min(c.o) as hit from s join c on c.url_key = s.url_key or c.id = s.id group by s.o)
select s.o as s_suppkey, coalesce(c.id, -1) as c_custkey from s left join h using (o) left join c on c.o = h.hit""",
)
def c22_match_either(t):
    entries, curated = shop(t)
    rows = entries.withColumn("hit", F.col("id"))
    out = O.match_either(curated.withColumnRenamed("_ord", "s_suppkey"), rows, {"url_key": "url_key", "id": "id"}, "hit", "_ord", id_="s_suppkey")
    return out.select("s_suppkey", F.coalesce("hit", F.lit(-1)).alias("c_custkey"))


@query(
    "c23_drift_diff",
    SQL_DRIFT + """ select id, class, old, new,
  case when class = 'changed' and old > 0 then round_even((new - old) / old, 4) else 0::double end as pct from d""",
)
def c23_drift_diff(t):
    return O.drift_diff(snapshot(t, 1997), snapshot(t, 1998)).select(
        "id", "class", F.coalesce("old", F.lit(0)).alias("old"), F.coalesce("new", F.lit(0)).alias("new"), F.coalesce("pct", F.lit(0.0)).alias("pct")
    )


SQL_ORDERED = f"""select coalesce(o.id, n.id) as id, case when o.id is null then 'added' when n.id is null then 'removed'
  when o.status <> n.status then 'status_changed' when o.version <> n.version then 'version_bumped' else 'stable' end as class,
  case when o.status <> n.status then o.status when o.version <> n.version then o.version end as old,
  case when o.status <> n.status then n.status when o.version <> n.version then n.version end as new
from {sql_snapshot(1997)} o full join {sql_snapshot(1998)} n using (id)"""


@query("c24_ordered_diff", SQL_ORDERED)
def c24_ordered_diff(t):
    return O.ordered_diff(snapshot(t, 1997), snapshot(t, 1998), {"status": "status_changed", "version": "version_bumped"})


@query(
    "c25_flag_existing",
    f"""with {SQL_SHOP}
select id, id in (select id from s) or url_key in (select url_key from s) as existing from c""",
)
def c25_flag_existing(t):
    entries, curated = shop(t)
    return O.flag_existing(entries, curated, ["id", "url_key"], spread=["_ord"]).select("id", "existing")


@query(
    "c26_promote",
    """select p_partkey, p_name, case when p_size > 10 then p_type else 'default' end as stack from part
where p_retailprice > 950 and p_partkey not in (select l_partkey from lineitem where l_returnflag = 'R' and l_quantity > 49)""",
)
def c26_promote(t):
    none = F.array().cast("array<string>")
    index = t.part.select("p_partkey", "p_name", F.when(F.col("p_size") > 10, F.array("p_type")).otherwise(none).alias("tech_stack"))
    curated = t.lineitem.filter("l_returnflag = 'R' and l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    candidates = t.part.filter("p_retailprice > 950").select("p_partkey")
    out = O.promote(candidates, index, curated, F.array(F.lit("default")), key="p_partkey")
    return out.select("p_partkey", "p_name", F.array_join("tech_stack", ",").alias("stack"))


@query(
    "c27_repo_attributes",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(p_size, 0) as stars from lineitem
left join (select * from part where p_type <> 'SMALL') on p_partkey = l_partkey""",
)
def c27_repo_attributes(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.lit(0).alias("stars"))
    meta = t.part.filter("p_type <> 'SMALL'").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return O.fan_out(df, meta, ["l_partkey"], "stars", value="p_size")


@query(
    "c28_replace_thin",
    """select doc_id, length(case when length(short) < 80 and length(text) > length(short) then text else short end) as n
from (select *, source as short from documents)""",
)
def c28_replace_thin(t):
    short = t.documents.select("doc_id", F.col("source").alias("text"))
    out = O.replace_thin(short, t.documents.select("doc_id", "text"), "doc_id", "text", F.length("text") < 80)
    return out.select("doc_id", F.length("text").cast("long").alias("n"))


@query(
    "c29_best_evidence",
    """
with l as (select l_partkey, count(*) as skills, cast(sum(l_linenumber) as bigint) as agents, min(l_returnflag) as f, max(l_linestatus) as s, min(l_quantity) as q
  from lineitem group by l_partkey)
select p_partkey, case when f = 'A' and s = 'O' and coalesce(q, 0) >= 3 then skills when q < 2 or (f = 'A' and s = 'O' and q < 3) then 0 else p_size end as skills,
  case when f = 'A' and s = 'O' and coalesce(q, 0) >= 3 then agents when q < 2 or (f = 'A' and s = 'O' and q < 3) then 0 else 1 end as agents
from part left join l on l_partkey = p_partkey
""",
)
def c29_best_evidence(t):
    l = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("skills"), F.sum("l_linenumber").alias("agents"),
        ((F.min("l_returnflag") == "A") & (F.max("l_linestatus") == "O")).alias("is_plugin"),
        F.min("l_quantity").alias("q"),
    )
    layout = l.withColumn("error", F.when(F.col("q") < 2, "unreachable")).withColumn("is_marketplace", F.col("is_plugin") & (F.col("q") < 3))
    hints = t.part.select("p_partkey", F.col("p_size").cast("long").alias("skills"), F.lit(1).cast("long").alias("agents"))
    out = O.best_evidence(t.part.select("p_partkey"), layout, hints, "p_partkey", ["skills", "agents"])
    return out.select("p_partkey", "skills", "agents")


@query(
    "c30_choose_content",
    """
with d as (select doc_id, quality, toxic, text, lang, source, n_chars > 2000 as shared from documents left join labels using (doc_id))
select doc_id, case when quality = 1 then 'bundle' when lang = 'en' then 'readme' when source <> 'src1' then 'description' end as content_from,
  coalesce(length(case when quality = 1 or lang = 'en' then case when shared and source <> 'src1' then
      '## Resource Description\n' || source || chr(10) || chr(10) || case when quality = 1 then '## Plugin Bundle\n' || text || '!' else '## Repository README\n' || text end
      else case when quality = 1 then text || '!' else text end end
    when source <> 'src1' then source end), -1) as n
from d
""",
)
def c30_choose_content(t):
    d = t.documents.join(t.labels, "doc_id", "left").withColumns({
        "bundle": F.when(F.col("quality") == 1, F.concat("text", F.lit("!"))),
        "readme": F.when(F.col("lang") == "en", F.col("text")),
        "description": F.when(F.col("source") != "src1", F.col("source")),
    })
    out = O.choose_content(
        d, bundle="bundle", readme="readme", description="description",
        shared=F.col("n_chars") > 2000, bundle_for=F.col("quality") == 1,
    )
    return out.select("doc_id", "content_from", F.coalesce(F.length("content"), F.lit(-1)).cast("long").alias("n"))
