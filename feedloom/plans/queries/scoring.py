"""Queries of scoring and governance (F1-F18) and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import scores
from ...functions.values import first_rule
from ...operators import linkage as L, scoring as S
from ...operators.relational import top_per_key
from ..registry import query
from .linkage import SQL_PRIORITY, SQL_TEXT_KEY, documents

AS_OF = "2001-06-01"
WEIGHTS = {"a": 0.4, "b": 0.25, "c": 0.2, "d": 0.15}
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_DIMS = """
  1 + cast(l_quantity as bigint) % 5 as a, 1 + cast(round(l_discount * 100) as bigint) % 5 as b,
  1 + cast(round(l_tax * 100) as bigint) % 5 as c, 1 + l_linenumber % 5 as d"""
SQL_QUALITY = "(a / 5 * 100 * 0.4 + b / 5 * 100 * 0.25 + c / 5 * 100 * 0.2 + d / 5 * 100 * 0.15)"
SQL_FRESH = "greatest(0, least(100, 100 * (1 - floor(epoch(timestamp '2001-06-01' - o_orderdate) / 86400) / 365.0)))"


def dims(t):
    five = lambda c: (F.lit(1) + c.cast("long") % 5).cast("long")
    return t.lineitem.withColumns({
        "a": five(F.col("l_quantity")),
        "b": five(F.round(F.col("l_discount") * 100)),
        "c": five(F.round(F.col("l_tax") * 100)),
        "d": five(F.col("l_linenumber")),
    })


def quality():
    return scores.quality_score({k: F.col(k) for k in WEIGHTS}, WEIGHTS)


@query(
    "f1_quality_score",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, round({SQL_QUALITY}, 6) as quality
from (select *, {SQL_DIMS} from lineitem)""",
)
def f1_quality_score(t):
    return dims(t).select(*LINE, F.round(quality(), 6).alias("quality"))


@query(
    "f1_quality_by_config",
    """
with w(task, name, weight) as (values ('R','q',0.4), ('R','d',0.6), ('A','q',0.7), ('A','t',0.3), ('N','d',0.5), ('N','t',0.5)),
s as (select l_orderkey, l_returnflag as task, 'q' as name, 1 + cast(floor(avg(l_quantity)) as bigint) % 5 as score from lineitem group by all
  union all select l_orderkey, l_returnflag, 'd', 1 + count(*) % 5 from lineitem group by all
  union all select l_orderkey, l_returnflag, 't', 1 + max(l_linenumber) % 5 from lineitem where l_linestatus = 'O' group by all)
select l_orderkey, task, case when count(*) = 2 then round(sum(score / 5 * 100 * weight), 6) end as quality
from s join w using (task, name) group by l_orderkey, task
""",
)
def f1_quality_by_config(t):
    li = t.lineitem.withColumnRenamed("l_returnflag", "task")
    five = lambda c: (F.lit(1) + c % 5).cast("long")
    q = li.groupBy("l_orderkey", "task").agg(
        F.struct(F.lit("q").alias("name"), five(F.floor(F.avg("l_quantity"))).alias("score")).alias("q"),
        F.struct(F.lit("d").alias("name"), five(F.count(F.lit(1))).alias("score")).alias("d"),
        F.struct(
            F.lit("t").alias("name"),
            five(F.max(F.when(F.col("l_linestatus") == "O", F.col("l_linenumber")))).alias("score"),
        ).alias("t"),
    )
    long = q.select("l_orderkey", "task", F.explode(F.array("q", "d", "t")).alias("s")).select(
        "l_orderkey", "task", "s.*"
    ).filter("score is not null")
    config = t.spark.createDataFrame(
        [("R", "q", 0.4), ("R", "d", 0.6), ("A", "q", 0.7), ("A", "t", 0.3), ("N", "d", 0.5), ("N", "t", 0.5)],
        "task string, name string, weight double",
    )
    return S.weighted_scores(long, config, ["l_orderkey"]).withColumn("quality", F.round("quality", 6))


@query("f2_freshness", f"select o_orderkey, round({SQL_FRESH}, 6) as freshness from orders")
def f2_freshness(t):
    return t.orders.select("o_orderkey", F.round(scores.freshness("o_orderdate", AS_OF), 6).alias("freshness"))


@query(
    "f3_popularity",
    """select o_orderkey, round(case when v > 0 then least(100, 25 * log10(v)) else 0 end, 6) as popularity
from (select o_orderkey, cast(floor(o_totalprice / 40) as bigint) - 100 as v from orders)""",
)
def f3_popularity(t):
    stars = F.floor(F.col("o_totalprice") / 40) - 100
    return t.orders.select("o_orderkey", F.round(scores.popularity(stars), 6).alias("popularity"))


@query(
    "f4_install_popularity",
    """select o_orderkey, round(case when v > 0 then least(100, log10(greatest(v, 1)) / 5 * 100) else 0 end, 6) as install_popularity
from (select o_orderkey, cast(floor(o_totalprice) as bigint) as v from orders)""",
)
def f4_install_popularity(t):
    n = F.floor("o_totalprice")
    return t.orders.select("o_orderkey", F.round(scores.install_popularity(n), 6).alias("install_popularity"))


@query(
    "f5_source_trust",
    """select doc_id, cast(case source when 'src1' then 90 when 'src7' then 75 when 'src14' then 100 else 40 end as double)
as trust from documents""",
)
def f5_source_trust(t):
    trust = scores.trust_of("source", {"src1": 90, "src7": 75, "src14": 100})
    return t.documents.select("doc_id", trust.alias("trust"))


SQL_MANIFEST = """with m as (select p_partkey, p_name, nullif(p_type, 'SMALL') as p_type,
  case when p_size > 10 then p_brand end as p_brand, p_size > 3 as present from part),
c as (select *, (case when p_name is null then 0 else 1 end + case when p_type is null then 0 else 1 end
  + case when p_brand is null then 0 else 1 end) as n from m)"""


@query(
    "f6_manifest_completeness",
    f"""{SQL_MANIFEST}
select p_partkey, case when present and n = 3 then 1.0::double when present then 0.7::double else 0.3::double end as official,
  case when present and n = 3 then 1.0::double when present and n > 0 then 0.7::double else 0.3::double end as feed,
  round(case when present and n = 3 then 100::double when present then 70::double else 30::double end, 6) as signal from c""",
)
def f6_manifest_completeness(t):
    p = t.part
    fields = [F.col("p_name"), F.nullif("p_type", F.lit("SMALL")), F.when(F.col("p_size") > 10, F.col("p_brand"))]
    present = F.col("p_size") > 3
    official = scores.manifest_completeness(fields, present)
    return p.select(
        "p_partkey",
        official.alias("official"),
        scores.manifest_completeness(fields, present, "feed").alias("feed"),
        F.round(scores.manifest_signal(official), 6).alias("signal"),
    )


SQL_HEALTH = f"""select o_orderkey, o_totalprice, {SQL_FRESH} as f,
  least(100, 25 * log10(o_totalprice / 50)) as p,
  case o_orderpriority when '1-URGENT' then 100 when '2-HIGH' then 70 else 40 end as s,
  case when o_orderstatus = 'O' then 0 else 0.3 end as wf, case when o_orderstatus <> 'F' and o_orderpriority = '5-LOW'
  then 0 else 0.3 end as wp from orders"""


def health_frame(t):
    trust = first_rule(
        [(F.col("o_orderpriority") == "1-URGENT", 100.0), (F.col("o_orderpriority") == "2-HIGH", 70.0)], 40.0
    )
    return t.orders.withColumns({
        "f": scores.freshness("o_orderdate", AS_OF),
        "p": scores.popularity(F.col("o_totalprice") / 50),
        "s": trust,
    })


def health_expr():
    no_date = F.col("o_orderstatus") == "O"
    noisy = (F.col("o_orderstatus") != "F") & (F.col("o_orderpriority") == "5-LOW")
    return scores.health_weighted([(F.col("f"), 0.3, no_date), (F.col("p"), 0.3, noisy), (F.col("s"), 0.4, None)])


@query("f7_health_weighted", f"select o_orderkey, round((f * wf + p * wp + s * 0.4) / (wf + wp + 0.4), 6) as health from ({SQL_HEALTH})")
def f7_health_weighted(t):
    return health_frame(t).select("o_orderkey", F.round(health_expr(), 6).alias("health"))


@query(
    "f8_inject_signal",
    """
with c as (select n_regionkey, n_name, n_nationkey + 1 as w from nation)
select n_regionkey as task, n_name as name, round(w * 0.95 / sum(w) over (partition by n_regionkey), 6) as weight from c
union all select distinct n_regionkey, 'install_popularity', 0.05::double from nation
""",
)
def f8_inject_signal(t):
    c = t.nation.select(
        F.col("n_regionkey").alias("task"), F.col("n_name").alias("name"), (F.col("n_nationkey") + 1.0).alias("weight")
    )
    return S.inject_signal(c).withColumn("weight", F.round("weight", 6))


@query(
    "f9_blend",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(0.85 * q + 0.15 * h, h), 6) as score
from (select *, case when l_linestatus = 'O' then {SQL_QUALITY} end as q, l_quantity * 2 as h from (select *, {SQL_DIMS} from lineitem))""",
)
def f9_blend(t):
    q = F.when(F.col("l_linestatus") == "O", quality())
    return dims(t).select(*LINE, F.round(scores.blend(q, F.col("l_quantity") * 2), 6).alias("score"))


@query(
    "f10_decision",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when {SQL_QUALITY} >= 65 and coalesce(r, 3) > 2 then 'accept'
  when {SQL_QUALITY} >= 50 then 'review' else 'reject' end as decision
from (select *, case when l_returnflag <> 'N' then a end as r from (select *, {SQL_DIMS} from lineitem))""",
)
def f10_decision(t):
    relevance = F.when(F.col("l_returnflag") != "N", F.col("a"))
    return dims(t).select(*LINE, scores.decision(F.round(quality(), 9), relevance).alias("decision"))


@query(
    "f11_star_weight",
    """
with c as (select *, count(*) over (partition by l_partkey) as n from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, case when l_discount = 0 then 0::double
  when l_returnflag = 'R' then 0::double when n >= 32 then 0::double else 1::double end as star_weight from c
""",
)
def f11_star_weight(t):
    li = t.lineitem.select(*LINE, "l_quantity", "l_discount", "l_returnflag")
    out = S.star_weight(
        li, stars="l_discount", source="l_returnflag", repo="l_partkey", zero_sources=["R*"], threshold=32
    )
    return out.select(*LINE, "l_quantity", "star_weight")


@query(
    "f12_flatten_result",
    """
with r as (select event_id, user_id, cast(json_extract_string(props, '$.k') as bigint) as k, value from events)
select event_id, k as score, round_even(value, 0)::double as final_score,
  case when k >= 65 then 'accept' else 'review' end as decision,
  case when k > 50 then 'k' || k else 'none' end as tag,
  cast(round_even((k + k / 2.0 + 40) / 3, 0) as integer) as health_mean,
  case when k > 70 then 'active' when k > 30 then 'stale' else 'abandoned' end as freshness_label
from r
""",
)
def f12_flatten_result(t):
    p = F.from_json("props", "k int")["k"]
    results = t.events.select(
        F.col("event_id").alias("entry_id"),
        F.create_map(F.lit("k"), F.struct(p.cast("long").alias("score"))).alias("metrics"),
        F.col("value").alias("final_score"),
        F.when(p >= 65, "accept").alias("decision"),
        F.struct(
            F.when(p > 50, F.array(F.concat(F.lit("k"), p.cast("string")))).alias("tags"),
            F.lit(None).cast("array<string>").alias("tech_stack"),
            F.lit(None).cast("string").alias("summary"),
            F.lit(None).cast("string").alias("summary_zh"),
        ).alias("enrichment"),
        F.struct(
            p.cast("double").alias("freshness"), (p / 2.0).alias("popularity"), F.lit(40.0).alias("source_trust")
        ).alias("health"),
        F.lit(None).cast("struct<state:string,tags:array<string>>").alias("installability"),
    )
    entries = t.events.select(
        F.col("event_id").alias("id"),
        F.lit("skill").alias("type"),
        F.array(F.lit("none")).alias("tags"),
        F.array().cast("array<string>").alias("tech_stack"),
        F.col("event_type").alias("description"),
        F.lit(None).cast("string").alias("description_zh"),
        F.lit(0.0).alias("final_score"),
        F.lit("review").alias("decision"),
    )
    return S.flatten_result(entries, results).select(
        F.col("id").alias("event_id"),
        F.col("scores")["k"].alias("score"),
        "final_score",
        "decision",
        F.col("tags")[0].alias("tag"),
        "health_mean",
        "freshness_label",
    )


@query(
    "f13_health_label",
    f"""select o_orderkey, case when f > 70 then 'active' when f > 30 then 'stale' else 'abandoned' end as label,
  cast(round_even((f + p + s) / 3, 0) as integer) as health from ({SQL_HEALTH})""",
)
def f13_health_label(t):
    mean = scores.health_mean(F.col("f"), F.col("p"), F.col("s"))
    return health_frame(t).select("o_orderkey", scores.freshness_label("f").alias("label"), mean.alias("health"))


@query(
    "f14_governance_defaults",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case when l_linestatus = 'O' then round({SQL_QUALITY}, 6) else 0::double end as final_score,
  case when l_linestatus = 'O' then case when {SQL_QUALITY} >= 65 and a > 2 then 'accept' when {SQL_QUALITY} >= 50 then 'review'
    else 'reject' end else 'review' end as decision,
  case when l_linestatus = 'O' then concat_ws(',', case when a < 3 then 'a' end, case when b < 3 then 'b' end,
    case when c < 3 then 'c' end, case when d < 3 then 'd' end) else '' end as weak
from (select *, {SQL_DIMS} from lineitem)""",
)
def f14_governance_defaults(t):
    done = F.col("l_linestatus") == "O"
    scored = dims(t).withColumns({
        "final_score": F.when(done, F.round(quality(), 6)),
        "decision": F.when(done, scores.decision(F.round(quality(), 9), "a")),
    })
    return S.govern(scored, {k: k for k in WEIGHTS}).select(
        *LINE, "final_score", "decision", F.array_join("weak_dims", ",").alias("weak")
    )


@query(
    "f15_health_only",
    """select doc_id, coalesce(quality, 0)::double as final_score, 'review' as decision,
  'health_only_synthesized' as evaluation_mode from documents left join labels using (doc_id)""",
)
def f15_health_only(t):
    d = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return d.select("doc_id", S.health_only_result("quality").alias("e")).select("doc_id", "e.*")


@query(
    "f16_candidate_top",
    """select c_custkey, round(log10(greatest(cast(floor(c_acctbal) as bigint), 1)) * 10
  + case when c_mktsegment = 'BUILDING' then 50 else 0 end, 6) as score from customer order by score desc, c_custkey limit 300""",
)
def f16_candidate_top(t):
    score = scores.candidate_score(F.floor("c_acctbal"), F.col("c_mktsegment") == "BUILDING")
    scored = t.customer.select("c_custkey", F.round(score, 6).alias("score"))
    return scored.orderBy(F.desc("score"), "c_custkey").limit(300)


@query(
    "f17_call_cost",
    """select event_type, round(sum(event_id % 1000 / 1000 * 0.5 + k / 1000 * 1.5), 6) as cost, cast(sum(k) as bigint) as tokens
from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events) group by event_type""",
)
def f17_call_cost(t):
    k = F.from_json("props", "k int")["k"].cast("long")
    cost = scores.call_cost(F.col("event_id") % 1000, k, (0.5, 1.5))
    return t.events.groupBy("event_type").agg(F.round(F.sum(cost), 6).alias("cost"), F.sum(k).alias("tokens"))


@query(
    "f18_task_routing",
    """select case o_orderpriority when '1-URGENT' then 'mcp_server' when '2-HIGH' then 'rule' when '3-MEDIUM' then 'prompt'
  when '5-LOW' then 'plugin' else 'skill' end as task, count(*) as n from orders group by 1""",
)
def f18_task_routing(t):
    type_ = first_rule([
        (F.col("o_orderpriority") == p, v)
        for p, v in (("1-URGENT", "mcp"), ("2-HIGH", "rule"), ("3-MEDIUM", "prompt"), ("5-LOW", "plugin"))
    ], "other")
    routed = S.route_task(t.orders.select(type_.alias("type")))
    return routed.groupBy("task").agg(F.count(F.lit(1)).alias("n"))


# The flagship: one pass from raw documents to the best five per language.


@query(
    "flagship_best_documents",
    f"""
with d as (select doc_id, lang, source, n_chars, {SQL_PRIORITY} as pr, {SQL_TEXT_KEY} as key from documents),
w as (select *, row_number() over (partition by key order by pr desc, doc_id) as rn from d),
e as (select w.*, l.quality, l.toxic,
    case when l.quality is null then null else (1 + 4 * l.quality) / 5 * 100 * 0.6 + (5 - 4 * l.toxic) / 5 * 100 * 0.4 end as q,
    least(100, 25 * log10(greatest(n_chars, 1))) as p, cast(least(100, pr * 5) as double) as s
  from w left join labels l using (doc_id) where rn = 1),
h as (select *, case when n_chars < 200 then s else (p * 0.4 + s * 0.6) end as health from e),
f as (select *, coalesce(0.85 * q + 0.15 * health, health) as score from h),
g as (select *, case when round(score, 9) >= 65 and coalesce(5 - 4 * toxic, 3) > 2 then 'accept'
    when round(score, 9) >= 50 then 'review' else 'reject' end as decision from f),
r as (select *, row_number() over (partition by lang order by round(score, 6) desc, doc_id) as rank from g where decision <> 'reject')
select lang, cast(rank as integer) as rank, doc_id, round(score, 6) as score, decision from r where rank <= 5
""",
)
def flagship_best_documents(t):
    d = documents(t).drop("text")  # texts never leave the scan: only their digest is shuffled
    best = L.collapse(d, "key", [F.desc("priority"), F.asc("doc_id")], every_row_keyed=True)
    e = best.join(t.labels, "doc_id", "left")
    dimensions = {"good": 1 + 4 * F.col("quality"), "safe": 5 - 4 * F.col("toxic")}
    q = scores.quality_score(dimensions, {"good": 0.6, "safe": 0.4})
    health = scores.health_weighted([
        (scores.popularity("n_chars"), 0.4, F.col("n_chars") < 200),
        (F.least(F.lit(100), F.col("priority") * 5).cast("double"), 0.6, None),
    ])
    scored = e.withColumn("score", scores.blend(q, health))
    decided = scored.withColumn("decision", scores.decision(F.round("score", 9), dimensions["safe"]))
    kept = decided.filter("decision <> 'reject'").withColumn("score", F.round("score", 6))
    top = top_per_key(kept, ["lang"], [F.desc("score"), F.asc("doc_id")], 5, "rank")
    return top.select("lang", "rank", "doc_id", "score", "decision")
