"""Queries of rankings and picks (G1-G12) and of incremental state (N1-N10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.values import first_rule
from ...operators import overlay as O, select as G, state as N
from ...sources.keyed import KeyedTable
from ...sources.tables import empty_frame
from ..registry import query, scratch
from .overlay import SQL_ORDERED, snapshot, sql_snapshot

SQL_E = "select o_orderkey, o_orderstatus, o_orderpriority, cast(floor(o_totalprice / 5000) as bigint) as score, day(o_orderdate) as health, o_custkey as stars from orders"


def orders(t):
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.floor(F.col("o_totalprice") / 5000).alias("score"),
        F.dayofmonth("o_orderdate").alias("health"), F.col("o_custkey").alias("stars"),
    )


ORDER = ("score", "health", "stars", "o_orderkey")


@query(
    "g1_catalog_order",
    f"select o_orderkey, row_number() over (order by score desc, health desc, stars desc nulls last, o_orderkey) as rank from ({SQL_E})",
)
def g1_catalog_order(t):
    return G.ranked(orders(t), G.catalog_order(*ORDER)).select("o_orderkey", "rank")


@query(
    "g2_top_by_type",
    f"select o_orderstatus, o_orderkey, cast(rank as integer) as rank from (select *, row_number() over (partition by o_orderstatus order by score desc, stars desc, o_orderkey) as rank from ({SQL_E})) where rank <= 100",
)
def g2_top_by_type(t):
    order = [F.desc("score"), F.desc("stars"), F.asc("o_orderkey")]
    return G.top_by_type(orders(t), "o_orderstatus", order, 100).select("o_orderstatus", "o_orderkey", "rank")


@query(
    "g3_top_fresh",
    """select p_type, p_partkey, cast(rank as integer) as rank from (select *, row_number() over (partition by p_type order by p_retailprice desc, p_size desc, p_partkey) as rank
from part where p_size > 5 and not (p_type = 'SMALL' and p_brand = 'Brand#2')) where rank <= 5""",
)
def g3_top_fresh(t):
    p = t.part.withColumns({
        "freshness_label": F.when(F.col("p_size") <= 5, "abandoned"),
        "bundled_in": F.when(F.col("p_brand") == "Brand#2", F.lit("x")),
    })
    order = [F.desc("p_retailprice"), F.desc("p_size"), F.asc("p_partkey")]
    return G.top_fresh(p, order, type_="p_type", bundled_type="SMALL").select("p_type", "p_partkey", "rank")


# The walk over the featured picks, step by step, with the keys seen and the scenes' counts.
SQL_FEATURED = """
with recursive a as (select 0 as pass, o_orderpriority as scene, cast(o_custkey as varchar) as key, row_number() over (order by o_totalprice desc, o_orderkey) as o from orders where o_orderstatus = 'F'
  union all select 1, o_orderpriority, cast(o_custkey as varchar), row_number() over (order by o_totalprice desc, o_orderkey) from orders where o_orderstatus = 'O'),
r as (select *, row_number() over (order by pass, o) as n from a),
w as (select cast(0 as bigint) as n, [cast(null as varchar)] as seen, [cast(null as varchar)] as taken, false as ok
  union all
  select r.n, case when x.ok then list_append(w.seen, r.key) else w.seen end, case when x.ok then list_append(w.taken, r.pass || r.scene) else w.taken end, x.ok
  from w join r on r.n = w.n + 1, lateral (select not coalesce(list_contains(w.seen, r.key), false)
    and len(list_filter(w.taken, lambda s: s = r.pass || r.scene)) < case r.pass when 0 then 4 else 2 end as ok) x
  where len(w.taken) <= 30)
select r.pass, r.scene, r.key from w join r using (n) where w.ok
"""


@query("g4_featured", SQL_FEATURED)
def g4_featured(t):
    def rows(status):
        o = t.orders.filter(F.col("o_orderstatus") == status)
        # one number that orders by price, then by order key
        rank = F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey")
        return o.select(F.col("o_orderpriority").alias("scene"), F.col("o_custkey").cast("string").alias("key"), rank.alias("_ord"))

    scenes = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return G.featured([(rows("F"), 4), (rows("O"), 2)], scenes).select("pass", "scene", "key")


@query(
    "g5_top_kept",
    "select p_partkey, p_retailprice from part where p_type = 'ECONOMY' and p_brand <> 'Brand#7' order by p_retailprice desc, p_partkey limit 8",
)
def g5_top_kept(t):
    p = t.part.withColumn("decision", F.when(F.col("p_brand") == "Brand#7", "Reject"))
    out = G.top_kept(p, [F.desc("p_retailprice"), F.asc("p_partkey")], type_="p_type", wanted="ECONOMY")
    return out.select("p_partkey", "p_retailprice")


@query(
    "g6_within_quota",
    f"""select o_orderpriority, o_orderstatus, o_orderkey from (select *, row_number() over (partition by o_orderpriority, o_orderstatus order by score desc, o_orderkey) as rn from ({SQL_E}))
where rn <= case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then 3 when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then 2 when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 4 else 1 end""",
)
def g6_within_quota(t):
    quotas = {"1-URGENT": {"F": 3, "O": 2}, "5-LOW": {"P": 4}}
    out = G.within_quota(orders(t), [F.desc("score"), F.asc("o_orderkey")], category="o_orderpriority", type_="o_orderstatus", quotas=quotas)
    return out.select("o_orderpriority", "o_orderstatus", "o_orderkey")


@query(
    "g7_layered",
    """
with c as (select *, case when c_acctbal > 9900 then 'official' when c_acctbal > 9800 and c_mktsegment = 'BUILDING' then 'community' end as tier from customer),
p as (select * from c where tier is not null),
g as (select *, row_number() over (partition by c_nationkey, c_mktsegment order by c_acctbal desc, c_custkey) as rn from c
  where tier is null and c_mktsegment <> 'MACHINERY' and not exists (select 1 from p where p.c_nationkey = c.c_nationkey and p.c_mktsegment = c.c_mktsegment))
select c_custkey, tier from p union all select c_custkey, 'gap_fill' from g where rn = 1
""",
)
def g7_layered(t):
    c = t.customer.withColumn("_ord", F.col("c_custkey"))
    layers = {"official": F.col("c_acctbal") > 9900, "community": (F.col("c_acctbal") > 9800) & (F.col("c_mktsegment") == "BUILDING")}
    out = G.layered(
        c, layers,
        [F.desc("c_acctbal"), F.asc("c_custkey")], ["c_nationkey", "c_mktsegment"], F.col("c_mktsegment") != "MACHINERY", key="c_custkey",
    )
    return out.select("c_custkey", "tier")


@query(
    "g8_stratified_sample",
    """select p_type, p_partkey, p_name from (select *, row_number() over (partition by p_type order by p_size desc, p_partkey) as rn from part) where rn <= 5
union all select x, -1, 'Empty Desc Test' from (values ('STANDARD'), ('ECONOMY'), ('MEDIUM'), ('LARGE'), ('SMALL'), ('PROMO')) v(x)""",
)
def g8_stratified_sample(t):
    p = t.part.select("p_type", "p_partkey", "p_name", "p_size")
    extra = {"p_partkey": F.lit(-1).cast("long"), "p_name": F.lit("Empty Desc Test"), "p_size": F.lit(0)}
    out = G.stratified_sample(p, [F.desc("p_size"), F.asc("p_partkey")], 5, extra, type_="p_type", types=["STANDARD", "ECONOMY", "MEDIUM", "LARGE", "SMALL", "PROMO"])
    return out.drop("p_size")


@query(
    "g9_trending",
    """select l_partkey, l_extendedprice from (select *, row_number() over (partition by l_partkey order by l_extendedprice desc, l_orderkey, l_linenumber) as rn from lineitem)
where rn = 1 order by l_extendedprice desc, l_partkey limit 20""",
)
def g9_trending(t):
    order = [F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return G.trending(t.lineitem, "l_partkey", order).select("l_partkey", "l_extendedprice")


@query(
    "g10_browse",
    f"select o_orderkey, score from ({SQL_E}) where o_orderpriority = '2-HIGH' and o_orderstatus = 'P' order by stars desc, o_orderkey limit 50 offset 50",
)
def g10_browse(t):
    where = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")
    return G.browse(orders(t), [F.desc("stars"), F.asc("o_orderkey")], where=where, page=1).select("o_orderkey", "score")


SQL_QUEUE = """
with e as (select o_orderkey as id, case o_orderstatus when 'F' then 'mcp' when 'O' then 'skill' else 'rule' end as type, o_orderdate as added,
  case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2 when '4-NOT SPECIFIED' then 3 else 2 end as priority from orders),
s as (select l_orderkey as id, max(l_shipdate) as q from lineitem group by 1),
x as (select e.*, s.q, row_number() over (order by priority, e.id) as rn from e left join s on s.id = e.id and type = 'mcp'
  where type <> 'rule' and timestamp '2000-06-01' - added >= interval 365 day and (s.q is null or timestamp '2000-06-01' - s.q >= interval 30 day))"""


def queue_frames(t):
    type_ = first_rule([(F.col("o_orderstatus") == "F", "mcp"), (F.col("o_orderstatus") == "O", "skill")], "rule")
    label = first_rule(
        [(F.col("o_orderpriority") == "1-URGENT", "abandoned"), (F.col("o_orderpriority") == "2-HIGH", "stale"),
         (F.col("o_orderpriority") == "3-MEDIUM", "active"), (F.col("o_orderpriority") == "4-NOT SPECIFIED", "odd")]
    )
    e = t.orders.select(F.col("o_orderkey").alias("id"), type_.alias("type"), F.col("o_orderdate").alias("added_at"), label.alias("freshness_label"))
    state = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_shipdate").cast("string").alias("last_queued_at"))
    return e, state.withColumn("type", F.lit("mcp"))


@query("g11_recrawl_queue", SQL_QUEUE + " select id, type, cast(priority as integer) as priority from x where rn <= 500")
def g11_recrawl_queue(t):
    queue, _ = G.recrawl_queue(*queue_frames(t), "2000-06-01")
    return queue.select("id", "type", "priority")


@query(
    "g11_recrawl_state",
    SQL_QUEUE + """ select id, type, '2000-06-01' as last_queued_at from x where rn <= 500
union all select s.id, 'mcp', strftime(s.q, '%Y-%m-%d %H:%M:%S') from s where s.id not in (select id from x where rn <= 500 and type = 'mcp')""",
)
def g11_recrawl_state(t):
    _, state = G.recrawl_queue(*queue_frames(t), "2000-06-01")
    return state.select("id", "type", "last_queued_at")


@query(
    "g12_probe_list",
    "select c_custkey from customer order by case when c_mktsegment = 'BUILDING' then 1 else 0 end, c_nationkey desc, lower(c_name), c_custkey limit 200",
)
def g12_probe_list(t):
    out = G.probe_list(t.customer, 200, source="c_mktsegment", last="BUILDING", stars="c_nationkey", name="c_name", order="c_custkey")
    return out.select("c_custkey")


# --- state -----------------------------------------------------------------------------------------


def outcomes(t):
    """Errors are failures, purchases are successes, other events say nothing."""
    e = t.events.filter(F.col("event_type").isin("error", "purchase"))
    return e.select(
        F.when(F.col("user_id") < 25, "skill").otherwise("mcp").alias("type"),
        F.when(F.col("value") > 80, "2.b").otherwise("1.a").alias("rubric_version"),
        F.col("user_id").cast("string").alias("entry_id"),
        (F.col("event_type") == "purchase").alias("ok"),
        F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("props").alias("error_kind"),
    )


SQL_OUT = """
with o as (select case when user_id < 25 then 'skill' else 'mcp' end as type, case when value > 80 then '2.b' else '1.a' end as rubric_version,
  cast(user_id as varchar) as entry_id, event_type = 'purchase' as ok, ts, event_id, props as error_kind from events where event_type in ('error', 'purchase')),
l as (select type, rubric_version, entry_id, max(ts) as last_ok from o where ok group by all),
f as (select o.* from o left join l using (type, rubric_version, entry_id) where not o.ok and (last_ok is null or o.ts > last_ok)),
led as (select type, rubric_version, entry_id, cast(count(*) as integer) as attempt_count, min(ts) as first_failed, max(ts) as last_failed, arg_max(error_kind, (ts, event_id)) as kind from f group by all),
nx as (select *, case when attempt_count >= 4 then timestamp '9999-12-31' when attempt_count = 3 then last_failed + interval 28 day when attempt_count = 2 then last_failed + interval 7 day else last_failed end as nextr from led)"""


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def ledger(t):
    o = outcomes(t)
    half = F.to_timestamp(F.lit("2024-01-15"))
    # two runs: the ledger after the first half of January is the input of the second
    first = N.ledger_update(empty_frame(t.spark, N.LEDGER_SCHEMA), o.filter(F.col("ts") < half))
    return N.ledger_update(first, o.filter(F.col("ts") >= half))


@query(
    "n1_failure_ledger",
    SQL_OUT + """ select type, rubric_version, entry_id, attempt_count, strftime(first_failed, '%Y-%m-%d %H:%M:%S') as first_failed,
  strftime(last_failed, '%Y-%m-%d %H:%M:%S') as last_failed, kind, strftime(nextr, '%Y-%m-%d %H:%M:%S') as next_retry from nx""",
)
def n1_failure_ledger(t):
    return ledger(t).select(
        "type", "rubric_version", "entry_id", "attempt_count", stamp("first_failed_at").alias("first_failed"),
        stamp("last_failed_at").alias("last_failed"), F.col("last_error_kind").alias("kind"), stamp("next_retry_after").alias("next_retry"),
    )


@query(
    "n2_retry_allowed",
    SQL_OUT + """ select type, rubric_version, entry_id, attempt_count >= 4 as quarantined, attempt_count < 4 and nextr <= timestamp '2024-01-31' as allowed from nx""",
)
def n2_retry_allowed(t):
    return ledger(t).select(
        "type", "rubric_version", "entry_id", N.is_quarantined().alias("quarantined"), N.retry_allowed("2024-01-31").alias("allowed")
    )


@query(
    "n3_current_version",
    SQL_OUT + """ select type, rubric_version, entry_id, attempt_count from nx where (type, rubric_version) in (('skill', '1.a'), ('mcp', '2.b'))""",
)
def n3_current_version(t):
    now = t.spark.createDataFrame([("skill", "1.a"), ("mcp", "2.b")], "type string, rubric_version string")
    return N.current_version(ledger(t), now).select("type", "rubric_version", "entry_id", "attempt_count")


@query(
    "n4_checkpoint_state",
    """select c_custkey as entry_id, case when c_custkey in (select o_custkey from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT') then 'completed'
  when c_acctbal < 500 then 'quarantined' else 'remaining' end as state from customer""",
)
def n4_checkpoint_state(t):
    done = t.orders.filter("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("entry_id"))
    marked = N.mark_completed(done, done, ["entry_id"])
    ids = t.customer.select(F.col("c_custkey").alias("entry_id"), "c_acctbal")
    return N.checkpoint_state(ids, marked, ids.filter("c_acctbal < 500"))


@query(
    "n5_cache_upsert",
    """select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events)
where rn = 1 and ts + interval 10 day >= timestamp '2024-02-01'""",
)
def n5_cache_upsert(t):
    e = t.events.select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("cache_key"), "user_id", "event_type", "event_id",
        F.col("ts").alias("evaluated_at"), (F.col("ts") + F.expr("interval 10 days")).alias("expires_at"),
    )
    half = F.to_timestamp(F.lit("2024-01-15"))
    # kept by key: the second half writes only the buckets of its keys
    cache = KeyedTable(t.spark, scratch(t, "cache"), e.schema, ["cache_key"], buckets=8)
    newest = [F.desc("evaluated_at"), F.desc("event_id")]
    for part in (e.filter(F.col("evaluated_at") < half), e.filter(F.col("evaluated_at") >= half)):
        cache.upsert(part, order=newest)
    return N.cache_purge(cache.read(), "2024-02-01").select("user_id", "event_type", "event_id")


@query(
    "n6_frontier",
    r"""
with l as (select page_id, unnest(regexp_extract_all(html, 'href="(/[^"]+)"', 1)) as link, generate_subscripts(regexp_extract_all(html, 'href="(/[^"]+)"', 1), 1) - 1 as pos from pages),
f as (select link, min((page_id, pos)) as firstat from l group by link)
select link, firstat[1] as page, cast(firstat[2] as integer) as pos from f where link not in (select link from l where page_id in (select page_id from pages where contains(url, '/de/')))
""",
)
def n6_frontier(t):
    links = t.pages.select(
        F.col("page_id").alias("page"), "url", F.posexplode(F.regexp_extract_all("html", F.lit('href="(/[^"]+)"'), 1)).alias("pos", "link")
    )
    done = links.filter(F.col("url").contains("/de/")).select("link")
    first = F.col("url").contains("/en/")
    return N.frontier(links.filter(first), links.filter(~first), done)


@query(
    "n7_stop_rule",
    """
with k as (select event_id, row_number() over (order by ts, event_id) - 1 as pos, value > 45 as known from events),
s as (select *, sum(cast(known as integer)) over (order by pos rows between 4 preceding and current row) as w from k),
c as (select min(pos) as stop from s where w = 5 and pos >= 4)
select event_id, pos from k, c where not known and (stop is null or pos < stop)
""",
)
def n7_stop_rule(t):
    feed = N.numbered_feed(t.events.select("event_id", "ts", "value"), [F.asc("ts"), F.asc("event_id")])
    return N.cut_after_known(feed, F.col("value") > 45, run=5, block=1000).select("event_id", "pos")


@query(
    "n8_change_gate",
    f"""select n.id, case when o.version = n.version then 'reuse' else 'rescan' end as path from {sql_snapshot(1998)} n left join {sql_snapshot(1997)} o using (id)""",
)
def n8_change_gate(t):
    return N.change_gate(snapshot(t, 1998).select("id", "version"), snapshot(t, 1997), "id", "version").select("id", "path")


@query(
    "n9_batch_log",
    """
with p as (select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 50 as batch from orders)
select batch, count(*) as n, count(l_orderkey) as succeeded, count(*) - count(l_orderkey) as failed
from p left join (select distinct l_orderkey from lineitem) on l_orderkey = o_orderkey group by batch
""",
)
def n9_batch_log(t):
    done = t.lineitem.select(F.col("l_orderkey").alias("entry_id"))
    return N.batch_log(t.orders.select(F.col("o_orderkey").alias("entry_id")), done, [F.asc("entry_id")])


@query("n10_snapshot_rotation", SQL_ORDERED)
def n10_snapshot_rotation(t):
    # two runs against one state folder: the first stores the wide baseline, the second diffs against it
    schema = "id bigint, status string, version string"
    rows = lambda y: snapshot(t, y).select("id", "status", "version")
    table = KeyedTable(t.spark, scratch(t, "baseline"), schema, ["id"], buckets=8)
    N.rotate_keyed(rows(1997), table, "v1")
    baseline = N.rotate_keyed(rows(1998), table, "v2")
    return O.ordered_diff(baseline, table.read(), {"status": "status_changed", "version": "version_bumped"})
