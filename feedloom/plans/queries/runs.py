"""Queries of whole runs: the merge of feeds, hand-made rows and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...sources.tables import entry_schema
from .. import catalog
from ..registry import query


def entry_rows(df: DataFrame, more: list[Column] = [], **fields: Column) -> DataFrame:
    """Rows of the entry table from columns of ``df``; fields that are not named are null."""
    return df.select(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in entry_schema().fields], *more)


TODAY = "2024-02-01"


@query(
    "merge_run",
    f"""
with servers as (
    select min(c_custkey) as k, max(c_custkey) > min(c_custkey) or min(c_custkey) = 1 as odd, arg_min(c_nationkey, c_custkey) as nation
    from customer group by c_custkey // 2
), skills as (select min(s_suppkey) as k from supplier group by s_suppkey % 30
), rules as (select min(p_partkey) as k, p_partkey % 100 as g from part group by g)
select 'c-' || k as id, 'mcp' as type, case when nation < 10 then 'backend' else 'database' end as category,
  case when k % 2 = 0 and k between 2 and 50 then 'own,best' else 'own' end as tags, case when k % 2 = 0 and k between 2 and 50 then 'python' else '' end as stack,
  case when odd then 'active' end as status, case when k % 4 = 0 then '2023-05-05T00:00:00Z' when odd then '2024-01-05T00:00:00Z' end as pushed_at,
  case when k % 4 = 0 then '2022-02-02' else '{TODAY}' end as added_at from servers
union all select 's-' || k, 'skill', 'tooling', 'own', '', null, null, '{TODAY}' from skills
union all select 'r-' || g, 'rule', 'tooling', 'from ' || k, '', null, null, null from rules
union all select 'x-' || r_regionkey, 'skill', 'tooling', 'new', 'python', null, null, '{TODAY}' from region
""",
)
def merge_run(t):
    """Three feeds, hand-made rows and the last catalog: collapse with donors, greedy de-duplication, overlay, repair, history."""
    text = lambda c: F.col(c).cast("string")
    say = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    k, odd = F.col("c_custkey"), F.col("c_custkey") % 2 == 1
    repo = say("https://github.com/o/r", F.floor(k / 2).cast("string"))
    own = F.array(F.lit("own"))
    servers = entry_rows(
        t.customer, [k.cast("long").alias("_pos")], id=say("c-", text("c_custkey")), name=say("n", text("c_custkey")), type=F.lit("mcp"),
        description=F.lit("postgres"), source_url=repo, category=F.when(F.col("c_nationkey") < 10, "backend").otherwise("odd"), tags=own,
        mcp_registry_status=F.when(odd, "active"), mcp_registry_published_at=F.when(odd, "2024-01-05T00:00:00Z"))
    skills = entry_rows(
        t.supplier, [F.col("s_suppkey").cast("long").alias("_pos")], id=say("s-", text("s_suppkey")), name=say("k", text("s_suppkey")), type=F.lit("skill"),
        source_url=say("https://github.com/s/x/tree/main/skills/k", (F.col("s_suppkey") % 30).cast("string")), category=F.lit("tooling"), tags=own)
    rules = entry_rows(
        t.part, [F.col("p_partkey").cast("long").alias("_pos")], id=say("r-", (F.col("p_partkey") % 100).cast("string")), name=F.lit("n"), type=F.lit("rule"),
        source_url=F.lit("https://github.com/all/rules"), category=F.lit("tooling"), tags=F.array(say("from ", text("p_partkey"))))
    listed = entry_rows(
        t.nation, [F.col("n_nationkey").cast("long").alias("_pos")], id=say("c-", (F.col("n_nationkey") * 2 + 2).cast("string")), type=F.lit("mcp"),
        tags=F.array(F.lit("best"), F.lit("own")), tech_stack=F.array(F.lit("python")))
    new = entry_rows(
        t.region, [(100 + F.col("r_regionkey")).cast("long").alias("_pos")], id=say("x-", text("r_regionkey")), name=F.lit("n"), type=F.lit("skill"),
        source_url=say("https://github.com/n/n", text("r_regionkey")), category=F.lit("tooling"), tags=F.array(F.lit("new")), tech_stack=F.array(F.lit("python")))
    curated = listed.unionByName(new).withColumn("_ord", F.struct(F.lit(9).alias("tier"), F.col("_pos").alias("pos")))
    previous = entry_rows(
        t.customer.filter(k % 4 == 0), id=say("c-", text("c_custkey")), type=F.lit("mcp"), source_url=repo, added_at=F.lit("2022-02-02"),
        pushed_at=F.lit("2023-05-05T00:00:00Z"), last_synced=F.lit("2023-06-01"))
    merged = catalog.merge([(servers, "_pos"), (skills, "_pos"), (rules, "_pos")], curated, previous, TODAY).entries
    return merged.select("id", "type", "category", F.array_join("tags", ",").alias("tags"), F.coalesce(F.array_join("tech_stack", ","), F.lit("")).alias("stack"),
                         F.col("mcp_registry_status").alias("status"), "pushed_at", "added_at")
