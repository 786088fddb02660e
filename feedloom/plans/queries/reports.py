"""Queries of counts and reports (E1-E10), sets (H1, H2) and checks (L1-L5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed, text as X
from ...functions.values import first_rule, folded_union
from ...operators import checks as C, report as R, sets as H
from ...operators.relational import with_key_count
from ..registry import query
from .overlay import SQL_COVERAGE, SQL_SHOP, coverage_frame, shop, sql_snapshot
from .scoring import LINE, SQL_DIMS, SQL_QUALITY, WEIGHTS, dims, quality

STATUSES = ["F", "O", "P"]
KINDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]


@query(
    "e1_counts_by_type",
    """select k as o_orderpriority, count(o_orderkey) as n from (values ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'),
  ('5-LOW'), ('6-NONE')) v(k) left join orders on o_orderpriority = k group by k""",
)
def e1_counts_by_type(t):
    return R.counts_with_zeros(t.orders, "o_orderpriority", KINDS)


@query("e1_totals", "select count(*) as total, cast(floor(count(*) / 100) * 100 as bigint) as approx from lineitem")
def e1_totals(t):
    return R.totals(t.lineitem)


@query(
    "e2_evaluation_report",
    f"""
with s as (select *, {SQL_QUALITY} as q from (select *, {SQL_DIMS} from lineitem)),
r as (select *, round(q, 6) as s, case when round(q, 9) >= 65 and a > 2 then 'accept' when round(q, 9) >= 50 then 'review' else 'reject' end as dec from s)
select 'all' as section, 'total' as item, count(*)::double as value from r
union all select 'decision', x, (select count(*) from r where dec = x)::double from (values ('accept'), ('review'), ('reject')) v(x)
union all select 'histogram', x, (select count(*) from r where s >= lo and s < hi)::double from (values ('0-20', -1, 20), ('20-40', 20, 40), ('40-60', 40, 60), ('60-80', 60, 80), ('80-100', 80, 1000)) v(x, lo, hi)
union all select 'score', 'mean', round(avg(s), 2) from r union all select 'score', 'min', round(min(s), 2) from r union all select 'score', 'max', round(max(s), 2) from r
union all select 'metric', 'a', round(avg(a), 2) from r union all select 'metric', 'b', round(avg(b), 2) from r
union all select 'metric', 'c', round(avg(c), 2) from r union all select 'metric', 'd', round(avg(d2), 2) from (select d as d2 from s)
""",
)
def e2_evaluation_report(t):
    from ...functions import scores

    r = dims(t).withColumns({"s": F.round(quality(), 6), "dec": scores.decision(F.round(quality(), 9), "a")})
    return R.evaluation_report(r, "s", "dec", {k: k for k in WEIGHTS})


@query(
    "e3_category_overview",
    "select coalesce(nullif(o_orderpriority, '5-LOW'), 'unknown') as category, count(*) as n from orders where o_orderstatus = 'F' group by 1",
)
def e3_category_overview(t):
    o = t.orders.withColumn("category", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return R.category_overview(o, "category", "o_orderstatus", "F")


@query(
    "e4_cross_table",
    """select coalesce(o_orderpriority, 'TOTAL') as o_orderpriority, count(*) filter (where o_orderstatus = 'F') as "F",
  count(*) filter (where o_orderstatus = 'O') as "O", count(*) filter (where o_orderstatus = 'P') as "P", count(*) as "TOTAL"
from orders group by rollup (o_orderpriority)""",
)
def e4_cross_table(t):
    return R.cross_table(t.orders, "o_orderpriority", "o_orderstatus", STATUSES)


@query(
    "e5_usage_totals",
    """select count(*) as entries, round(sum(value), 2) as total_cost, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as prompt_tokens,
  cast(sum(user_id) as bigint) as completion_tokens, round(count(*) filter (where event_type = 'view') / count(*), 6) as hit_rate from events""",
)
def e5_usage_totals(t):
    e = t.events.withColumn("k", F.from_json("props", "k bigint")["k"])
    out = R.usage_totals(e, "value", "k", "user_id", F.col("event_type") == "view")
    return out.withColumns({"total_cost": F.round("total_cost", 2), "hit_rate": F.round("hit_rate", 6)})


@query(
    "e6_run_status",
    """
with e as (select lang, case when quality = 1 then 'new' when quality = 0 then 'old' else 'synth' end as p from documents left join labels using (doc_id)),
g as (select lang, count(*) filter (where p = 'new') as succeeded, count(*) filter (where p = 'old') as fallback_old,
  count(*) filter (where p = 'synth') as fallback_synth from e group by lang),
c(lang, present, failed, quarantined) as (values ('en', true, 2, 1), ('de', true, 0, 0), ('xx', true, 5, 0))
select coalesce(g.lang, c.lang) as lang, coalesce(succeeded, 0) as succeeded, coalesce(fallback_old, 0) as fallback_old,
  coalesce(fallback_synth, 0) as fallback_synth, cast(coalesce(failed, 0) as bigint) as failed, cast(coalesce(quarantined, 0) as bigint) as quarantined,
  coalesce(fallback_old + fallback_synth, 0) as fallback,
  case when c.lang is null then 'failed' when coalesce(fallback_old + fallback_synth, 0) > 0 then 'partial' else 'ok' end as status
from g full join c on g.lang = c.lang
""",
)
def e6_run_status(t):
    p = F.when(F.col("quality") == 1, "new").when(F.col("quality") == 0, "old").otherwise("synth")
    e = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").select("lang", p.alias("provenance"))
    cells = t.spark.createDataFrame(
        [("en", True, 2, 1), ("de", True, 0, 0), ("xx", True, 5, 0)], "lang string, present boolean, failed bigint, quarantined bigint"
    )
    return R.run_status(e, cells, type_="lang")


@query(
    "e7_content_digest",
    """
with h as (select sha256(n_nationkey || '|' || n_name || '|' || n_regionkey) as h from nation),
l as (select cast('0x' || substr(h, 1, 12) as bigint) as a, cast('0x' || substr(h, 13, 12) as bigint) as b,
  cast('0x' || substr(h, 25, 12) as bigint) as c, cast('0x' || substr(h, 37, 12) as bigint) as d from h)
select count(*) as entry_count, sha256(count(*) || '-' || sum(a) || '-' || sum(b) || '-' || sum(c) || '-' || sum(d)) as digest from l
""",
)
def e7_content_digest(t):
    return R.content_digest(t.nation, ["n_nationkey", "n_name", "n_regionkey"])


@query(
    "e8_repo_counts",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, case when l_quantity < 2 then 0
  else count(*) filter (where l_quantity >= 2) over (partition by l_partkey) end as n from lineitem""",
)
def e8_repo_counts(t):
    li = t.lineitem.select(*LINE, "l_quantity").withColumn("repo", F.when(F.col("l_quantity") >= 2, F.col("l_partkey")))
    return with_key_count(li, ["repo"], "n").drop("repo")


@query(
    "e9_date_share",
    """select round(avg(case when o_orderstatus = 'F' then 1.0::double else 0 end), 9) as share, avg(case when o_orderstatus = 'F' then 1.0 else 0 end) >= 0.3 as enough from orders""",
)
def e9_date_share(t):
    dated = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    out = R.has_share(t.orders.withColumn("d", dated), F.col("d").isNotNull())
    return out.withColumn("share", F.round("share", 9))


@query(
    "e10_status_rollup",
    SQL_COVERAGE + " select coalesce(type, 'ALL') as type, coalesce(status, 'ALL') as status, count(*) as n from r group by rollup (type, status)",
)
def e10_status_rollup(t):
    return R.status_rollup(coverage_frame(t))


# --- sets ----------------------------------------------------------------------------------------


@query(
    "h1_set_algebra",
    f"""select coalesce(o.id, n.id) as id, case when o.id is null then 'added' when n.id is null then 'removed' else 'common' end as class
from {sql_snapshot(1997)} o full join {sql_snapshot(1998)} n using (id)""",
)
def h1_set_algebra(t):
    year = lambda y: t.orders.filter(F.year("o_orderdate") <= y).select(F.col("o_custkey").alias("id"))
    return H.set_algebra(year(1998), year(1997), ["id"])


@query(
    "h1_remaining",
    "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')",
)
def h1_remaining(t):
    done = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return H.remaining(t.customer, done, ["c_custkey"])


@query(
    "h2_folded_union",
    r"""
with w as (select p_partkey, lower(trim(p_type)) as a, lower(split_part(p_name, ' ', 1)) as b, lower(split_part(p_name, ' ', 2)) as c from part)
select p_partkey, a || case when b <> a then ',' || b else '' end || case when c <> a and c <> b then ',' || c else '' end as tags from w
""",
)
def h2_folded_union(t):
    tags = folded_union(F.array(F.concat(F.lit(" "), "p_type"), F.lit("")), F.split(F.upper("p_name"), " "))
    return t.part.select("p_partkey", F.array_join(tags, ",").alias("tags"))


# --- checks ----------------------------------------------------------------------------------------


@query(
    "l1_contract_violations",
    r"""
with e as (select p_partkey, lower(replace(p_brand, '#', case when p_size > 40 then '#' else '-' end)) || '-' || p_partkey as id,
  case when p_size > 5 then p_name end as name, case when p_type = 'SMALL' then 'mcp' when p_type = 'ECONOMY' then 'skill' else lower(p_type) end as type,
  p_size - 3 as stars, p_retailprice / 10 as final_score from part)
select p_partkey, v as violation from (
  select p_partkey, 'missing name' as v from e where name is null
  union all select p_partkey, 'id format' from e where not regexp_full_match(id, '[a-z0-9-]+')
  union all select p_partkey, 'type value' from e where type not in ('mcp', 'skill', 'rule', 'prompt', 'plugin')
  union all select p_partkey, 'stars range' from e where stars < 0
  union all select p_partkey, 'final_score range' from e where final_score > 100)
""",
)
def l1_contract_violations(t):
    dash = F.when(F.col("p_size") > 40, "#").otherwise("-")
    e = t.part.select(
        "p_partkey",
        F.concat_ws("-", F.lower(F.concat(F.lit("Brand"), dash, F.split_part("p_brand", F.lit("#"), F.lit(2)))), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_size") > 5, F.col("p_name")).alias("name"),
        first_rule([(F.col("p_type") == "SMALL", "mcp"), (F.col("p_type") == "ECONOMY", "skill")], F.lower("p_type")).alias("type"),
        (F.col("p_size") - 3).alias("stars"),
        (F.col("p_retailprice") / 10).alias("final_score"),
    )
    rules = {k: v for k, v in C.entry_rules(e.columns).items() if k.split(" ")[-1] in e.columns or not k.startswith("missing")}
    return C.violations(e, rules, "p_partkey")


@query(
    "l2_curated_findings",
    f"""with {SQL_SHOP},
x as (select 2 * o as o, id, url_key, name from s union all select 2 * o + 1, id, url_key || case when n > 12 then '' else 'x' end, '' from s),
w as (select *, row_number() over (partition by id order by o) as ri, row_number() over (partition by url_key order by o) as ru from x)
select o, 'no name' as finding, 'error' as severity from w where name = ''
union all select o, 'duplicate id', 'error' from w where ri > 1
union all select o, 'duplicate address', 'warning' from w where ru > 1
union all select o, 'id in index', 'warning' from w where id in (select id from c)
union all select o, 'address in index', 'warning' from w where url_key in (select url_key from c)""",
)
def l2_curated_findings(t):
    entries, curated = shop(t)
    s = curated.withColumn("n", F.split_part("url_key", F.lit("/"), F.lit(1)).cast("int"))
    first = s.select((F.col("_ord") * 2).alias("o"), "id", "url_key", "name")
    again = s.select(
        (F.col("_ord") * 2 + 1).alias("o"), "id",
        F.when(F.col("n") > 12, F.col("url_key")).otherwise(F.concat("url_key", F.lit("x"))).alias("url_key"), F.lit("").alias("name"),
    )
    rules = {"no name": F.length("name") > 0}
    return C.curated_findings(first.unionByName(again), entries, order="o", rules=rules)


@query(
    "l3_typed_fields",
    """
with p as (select event_id, event_type, cast(json_extract_string(props, '$.k') as bigint) as k from events)
select event_id, concat_ws(',', case when event_type = 'view' then 'k must be a whole number' end, case when event_type = 'click' then 'k must not be negative' end,
  case when k > 50 then 's has a bad format' end) as errors from p
""",
)
def l3_typed_fields(t):
    k = F.from_json("props", "k bigint")["k"]
    shown = (
        F.when(F.col("event_type") == "view", F.concat(F.lit('"'), k.cast("string"), F.lit('"')))
        .when(F.col("event_type") == "click", F.concat(F.lit("-"), (k + 1).cast("string")))
        .otherwise(k.cast("string"))
    )
    stamp = F.when(k > 50, "yesterday").otherwise("2024-01-30T04:51:07.9Z")
    raw = F.concat(F.lit('{"k": '), shown, F.lit(', "s": "'), stamp, F.lit('"}'))
    fields = {"k": {"kind": "count"}, "s": {"kind": "text", "pattern": fixed.ISO_Z_PATTERN}}
    errors = C.typed_field_errors(F.col("raw"), fields)
    return t.events.withColumn("raw", raw).select("event_id", F.array_join(errors, ",").alias("errors"))


@query(
    "l4_repair_category",
    """select p_partkey, case when p_type = 'SMALL' then 'tooling' when contains(lower(p_name), 'red') then 'r' when contains(lower(p_name), 'bolt') then 'b'
  else 'tooling' end as category from part""",
)
def l4_repair_category(t):
    p = t.part.withColumn("category", F.when(F.col("p_type") == "SMALL", "tooling").otherwise(F.lower("p_type"))).withColumn("_t", F.lower("p_name"))
    return C.repair_category(p, F.col("_t"), rules=[("red", "r"), ("bolt", "b")]).select("p_partkey", "category")


@query(
    "l4_repair_category_fixed_rules",
    """select p_partkey, case when p_type = 'SMALL' then 'mobile' else 'tooling' end as category from part""",
)
def l4_repair_category_fixed_rules(t):
    p = t.part.select("p_partkey", F.when(F.col("p_type") == "SMALL", "mobile").otherwise("other").alias("category"), F.lit("hammer bolt").alias("_t"))
    return C.repair_category(p, F.col("_t")).select("p_partkey", "category")


@query(
    "l5_config_violations",
    """
with w as (select n_regionkey, case when n_nationkey < 12 then 'dimension' else 'signal' end as kind, count(*) as n from nation group by all)
select n_regionkey as task, 'weights of ' || kind || ' do not sum to 1' as violation from w where n <> 3
union all select n_regionkey, 'accept is not above review' from nation group by n_regionkey having min(n_nationkey) + 48 <= 50
""",
)
def l5_config_violations(t):
    n = t.nation.select(
        F.col("n_regionkey").alias("task"), "n_nationkey", F.when(F.col("n_nationkey") < 12, "dimension").otherwise("signal").alias("kind"), F.lit(1 / 3).alias("weight")
    )
    limits = n.groupBy("task").agg((F.min("n_nationkey") + 48).alias("accept"), F.lit(50).alias("review"))
    return C.config_violations(n, limits)
