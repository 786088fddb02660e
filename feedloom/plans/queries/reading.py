"""Queries of scans, sources and sinks (A3-A27). Feeds are derived row by row from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.values import first_rule
from ...functions import text as X
from ...operators.relational import with_position
from ...sources import feeds as D, html as W, markdown as M, tables as A, tree as R
from ...session import cut
from ..registry import query, scratch


def s(c):
    return F.col(c).cast("string")


ORDER_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
SQL_ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders"


@query("a1_json_scan", SQL_ORDERS + " union all " + SQL_ORDERS + " where false")
def a1_json_scan(t):
    """A JSON table read back with its schema, and one that is not there."""
    folder = scratch(t, "scan")
    t.orders.select(*ORDER_DDL.replace(",", "").split()[::2]).write.json(folder)
    read = lambda path: A.read_json_table(t.spark, path, ORDER_DDL, array_file=False)
    return read(folder).unionByName(read(folder + "-missing"))


@query("a1_json_arrays", SQL_ORDERS)
def a1_json_arrays(t):
    """Files that hold one array each, as feeds are published; written as two versions, read as of the second."""
    folder = scratch(t, "arrays")
    A.write_json_arrays(t.orders.limit(1).select("o_orderkey"), folder, version="first")
    A.write_json_arrays(t.orders.select(*ORDER_DDL.replace(",", "").split()[::2]), folder, version="second")
    return A.read_json_table(t.spark, folder, ORDER_DDL)


@query("a1_one_array", "select o_orderkey, row_number() over (order by o_orderkey) - 1 as number, o_totalprice as price, o_orderpriority as level from orders")
def a1_one_array(t):
    """All rows as one array in one file, nested and in order, read with the place of each object."""
    folder = scratch(t, "one")
    o = t.orders.select("o_orderkey", F.struct(F.struct(F.col("o_totalprice").alias("p")).alias("price"), F.array(F.col("o_orderpriority")).alias("level")).alias("more"))
    # sorted by many tasks; the one that writes the file goes through their parts in order and holds none of them
    laid = cut(o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey"))
    A.write_json_arrays(laid.coalesce(1), folder)
    read = A.read_json_table(t.spark, folder, "o_orderkey bigint, more struct<price:struct<p:double>,level:array<string>>", position="at")
    return read.select("o_orderkey", "at.number", F.col("more.price.p").alias("price"), F.col("more.level")[0].alias("level"))


@query(
    "a2_json_sink",
    "select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) - 1 as pos from orders",
)
def a2_json_sink(t):
    """Written in order; the order is held by a column as well, since a folder of files has none."""
    folder = scratch(t, "sink")
    o = with_position(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")])
    A.write_json(o, folder, ["pos"], version="v1")
    return A.read_json_table(t.spark, folder, "o_orderkey bigint, o_totalprice double, pos bigint", array_file=False)


@query(
    "a3_tiered_union",
    """select c_name as name, c_nationkey as nation, 0 as tier, c_custkey as pos, c_mktsegment as segment from customer
union all select s_name, s_nationkey, 1, s_suppkey, null from supplier""",
)
def a3_tiered_union(t):
    c = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), "c_custkey", F.col("c_mktsegment").alias("segment"))
    p = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), "s_suppkey")
    out = A.tiered_union([(c, "c_custkey"), (p, "s_suppkey")])
    return out.select("name", "nation", "_ord.tier", "_ord.pos", "segment")


@query(
    "a4_registry_entries",
    r"""
select o_orderkey, 'io-github-' || lower(o_orderstatus) || '-repo-' || o_orderkey || '-' || substr(sha1('io.github.' || o_orderstatus || '/repo_' || o_orderkey), 1, 8) as id,
  case when o_orderstatus = 'F' then 'https://github.com/x/y/tree/HEAD/sub' else 'https://registry.example/v0/servers/io.github.' || o_orderstatus || '%2Frepo_' || o_orderkey end as source_url,
  case when o_orderpriority = '1-URGENT' then 'npx -y pkg@1.' || o_custkey end as command, case when o_orderpriority = '2-HIGH' then 1 else 0 end as n_remotes
from orders where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'
""",
)
def a4_registry_entries(t):
    name = F.concat(F.lit("io.github."), "o_orderstatus", F.lit("/repo_"), s("o_orderkey"))
    repo = F.struct(
        F.when(F.col("o_orderstatus") == "F", "GitHub").alias("source"), F.lit("https://github.com/x/y/").alias("url"), F.lit("/sub/").alias("subfolder")
    )
    packages = F.when(
        F.col("o_orderpriority") == "1-URGENT",
        F.array(F.struct(F.lit("NPM").alias("registryType"), F.lit("pkg").alias("identifier"), F.concat(F.lit("1."), s("o_custkey")).alias("version"))),
    )
    remotes = F.array(
        F.struct(F.lit(None).cast("string").alias("type"), F.when(F.col("o_orderpriority") == "2-HIGH", "u").alias("url"))
    )
    server = F.struct(
        name.alias("name"), s("o_orderkey").alias("title"), F.lit(None).cast("string").alias("description"), F.lit("1").alias("version"),
        F.lit(None).cast("string").alias("websiteUrl"), repo.alias("repository"), packages.alias("packages"), remotes.alias("remotes"),
    )
    meta = F.create_map(F.lit("k"), F.struct(
        F.when(F.col("o_orderstatus") == "P", "deprecated").otherwise("active").alias("status"),
        (F.col("o_orderpriority") != "5-LOW").alias("isLatest"), F.lit("2024").alias("publishedAt"),
    ))
    pages = t.orders.select(F.array(F.struct(server.alias("server"), meta.alias("_meta"))).alias("servers"))
    e = D.active_entries(D.registry_entries(D.registry_rows(pages, "k"), "https://registry.example/v0/servers", "2024-02-01"))
    return e.select(
        F.col("name").cast("long").alias("o_orderkey"), "id", "source_url", "install.command", F.size("mcp_remotes").alias("n_remotes")
    )


SQL_PROMPTS = r"""
with d as (select doc_id, source || ' ' || lang as act, trim(text) as p, lang = 'en' as dev from documents)
select doc_id, replace(act, ' ', '-') || '-prompt' as id, trim(replace(substr(p, 1, 200), chr(10), ' ')) as description from d
where dev or regexp_matches(act || ' ' || p, '(?i)(?:^|[^\p{L}\p{N}_])(?:und|les|src3)(?:[^\p{L}\p{N}_]|$)')
"""


def prompts(t):
    return t.documents.select(
        "doc_id", F.concat(F.lit(" "), "source", F.lit(" "), "lang").alias("act"), F.col("text").alias("prompt"),
        F.when(F.col("lang") == "en", "true").alias("for_devs"),
    )


@query("a5_prompt_entries", SQL_PROMPTS)
def a5_prompt_entries(t):
    return D.prompt_entries(prompts(t), ["und", "les", "src3"]).select("doc_id", "id", "description")


@query("a5_prompt_csv", SQL_PROMPTS.replace("doc_id, replace", "replace"))
def a5_prompt_csv(t):
    """The same from a quoted CSV, with texts over several lines."""
    folder = scratch(t, "prompts")
    plain = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    prompts(t).drop("doc_id").write.options(header=True, quoteAll=True, **plain).csv(folder)
    return D.prompt_entries(D.read_prompts(t.spark, folder), ["und", "les", "src3"]).select("id", "description")


# Short lines of the documents become headings, long ones list entries.


def marked(c="text"):
    return F.regexp_replace(
        F.regexp_replace(c, r"(?m)^([^\n]{1,60})$", "## $1"), r"(?m)^(\w+) ([\w,.]+) ([^\n]{50,})$", "- **[$1](u/$2)** - $3"
    )


SQL_MARKED = r"""regexp_replace(regexp_replace(text, '(?m)^([^\n]{1,60})$', '## \1', 'g'), '(?m)^(\w+) ([\w,.]+) ([^\n]{50,})$', '- **[\1](u/\2)** - \3', 'g')"""
SQL_LINES = f"""
with m as (select doc_id, {SQL_MARKED} as t from documents),
l as (select doc_id, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as pos from m),
h as (select *, case when starts_with(line, '## ') then substr(line, 4) end as title,
  sum(case when starts_with(line, '## ') then 1 else 0 end) over (partition by doc_id order by pos) as section from l)"""


@query(
    "a6_bullets",
    SQL_LINES + r""", c as (select *, coalesce(max(trim(title)) over (partition by doc_id, section), '') as category from h)
select doc_id, cast(section as bigint) as section, category, regexp_extract(line, '^-\s+\*\*\[([^\]]+)\]', 1) as name, regexp_extract(line, '\]\(([^)]+)\)', 1) as url,
  length(trim(regexp_extract(line, '\)\*\*\s*[-–—]\s*(.+)', 1))) as n from c where starts_with(line, '- **[') and lower(category) <> 'ti.'""",
)
def a6_bullets(t):
    out = M.bullets(t.documents.withColumn("m", marked()), "m", ["doc_id"], heading=r"##\s+(.+)", skip=("ti.",))
    return out.select("doc_id", F.col("section").cast("long").alias("section"), "category", "name", "url", F.length("description").cast("long").alias("n"))


@query(
    "a7_table_rows",
    """select p_partkey, i as pos, case i when 0 then p_name else p_brand end as name, case i when 0 then 'http://h/' || p_partkey else 'u' end as url,
  case i when 0 then p_type else 'd' end as description from part, (values (0), (1)) v(i) where i = 0 or p_size > 10""",
)
def a7_table_rows(t):
    first = F.concat(F.lit("intro\n| Name | Text | Notes |\n|---|---|---|\n| ["), "p_name", F.lit("](http://h/"), s("p_partkey"), F.lit(") | "), "p_type", F.lit(" | note |\n"))
    second = F.when(F.col("p_size") > 10, F.concat(F.lit("|["), "p_brand", F.lit("](u)|d||\n"))).otherwise("| plain | d | |\n")
    return M.table_rows(t.part.withColumn("m", F.concat(first, second)), "m", ["p_partkey"])


@query(
    "a8_listed_skills",
    """select p_partkey, p_type as category, p_name as name, case when p_size > 10 then 'skills/who/' || lower(replace(p_name, ' ', '-')) || '/' else 'skills/solo/' end as install_path
from part where p_size <= 40""",
)
def a8_listed_skills(t):
    slug = F.when(F.col("p_size") > 10, F.concat(F.lit("who-"), F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))))).otherwise("solo")
    link = F.concat(F.lit("https://list.example/skills/"), slug, F.when(F.col("p_size") > 40, "/more").otherwise(""))
    text = F.concat(F.lit("## "), "p_type", F.lit("\n\n- ["), "p_name", F.lit("]("), link, F.lit(") - some text\n- not an entry\n"))
    return M.listed_skills(t.part.withColumn("m", text), "m", ["p_partkey"]).select("p_partkey", "category", "name", "install_path")


@query(
    "a9_page_links",
    r"""
with l as (select page_id, unnest(regexp_extract_all(html, 'href="(/[^"]+)"', 1)) as link, generate_subscripts(regexp_extract_all(html, 'href="(/[^"]+)"', 1), 1) as p from pages),
f as (select page_id, link, min(p) as p from l group by all)
select page_id, cast(row_number() over (partition by page_id order by p) - 1 as integer) as pos, link from f
""",
)
def a9_page_links(t):
    return W.page_links(t.pages, "html", "page_id", "/")


@query(
    "a9_page_details",
    r"""
select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(regexp_extract(html, '<h1[^>]*>([^<]+)</h1>', 1)), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') as name, 'https://github.com/o/r' || page_id as repo_url, 't' || page_id as tags,
  'run' as command, case when contains(url, '/de/') then 'mcp_config_template' else 'mcp_config' end as method
from pages where not contains(url, '/es/') and not contains(html, 'Project not found')
""",
)
def a9_page_details(t):
    arg = F.when(F.col("url").contains("/de/"), "&lt;key&gt;").otherwise("plain")
    more = F.concat(
        F.when(F.col("url").contains("/es/"), "").otherwise(F.concat(F.lit('<a class="b" href="https://github.com/o/r'), s("page_id"), F.lit('/" x="1">\n Visit Server</a>'))),
        F.lit('<a href="/tag/t'), s("page_id"), F.lit('">t</a><h2>Server Config</h2><pre><code class="j">{&quot;mcpServers&quot;: {&quot;z&quot;: {<b>&quot;command&quot;</b>: &quot;run&quot;, &quot;args&quot;: [&quot;'),
        arg, F.lit('&quot;]}}}</code></pre>'),
    )
    out = W.page_details(t.pages.withColumn("page", F.concat("html", more)), "page", "page_id")
    return out.select("page_id", "name", "repo_url", F.array_join("tags", ",").alias("tags"), "config.command", "method")


# SQL has no HTML parser; for the well-formed test pages patterns say the same.
@query(
    "a10_visible_text",
    r"""
with b as (select page_id, regexp_replace(regexp_replace(html, '(?s)<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<noscript\b.*?</noscript>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g') as x from pages),
u as (select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(x, '&#39;', chr(39)), '&#x27;', chr(39)), '&copy;', '©'), '&middot;', '·'),
  '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') as x from b)
select page_id, regexp_replace(regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') as text from u
""",
)
def a10_visible_text(t):
    return W.visible_text(t.pages, "html", "page_id")


@query(
    "a11_front_matter",
    r"""
select doc_id, case when n_chars > 500 then source else 'dir' || doc_id end as name, regexp_extract(trim(replace(text, '"', ' ')), '^[^\n]*', 0) as description, lang as category, lang || ',x y' as tags
from documents where lang <> 'es' and trim(text) <> ''
""",
)
def a11_front_matter(t):
    head = F.regexp_extract(F.trim(F.replace("text", F.lit('"'), F.lit(" "))), "^[^\n]*", 0)
    text = F.concat(
        F.lit("---\n"), F.when(F.col("n_chars") > 500, F.concat(F.lit('name: "'), "source", F.lit('"\n'))).otherwise(""),
        F.when(F.col("lang") != "es", F.concat(F.lit("description: >\n  "), head, F.lit("\n"))).otherwise(""),
        F.lit("category: "), "lang", F.lit("\ntags: ["), "lang", F.lit(", 'x y', \"\"]\n---\n"), "text",
    )
    d = t.documents.withColumn("m", text).withColumn("dir", F.concat(F.lit("skills/dir"), s("doc_id")))
    out = M.skill_texts(d, "m", "dir", ["doc_id"])
    return out.select("doc_id", "name", F.trim("description").alias("description"), "category", F.array_join("tags", ",").alias("tags"))


@query(
    "a12_description",
    r"""
with l as (select doc_id, lang, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
p as (select doc_id, string_agg(trim(line), ' ' order by pos) as prose from l where trim(line) <> '' and not regexp_matches(trim(line), '^(!|\[|---)') group by doc_id)
select d.doc_id, substr(case when lang = 'en' then 'Title: ' || trim(regexp_extract(text, '^[^\n]*', 0)) when lang = 'de' then 'Title: ' || coalesce(prose, '') else coalesce(prose, '') end, 1, 300) as description
from documents d left join p using (doc_id)
""",
)
def a12_description(t):
    title = F.when(F.col("lang").isin("en", "de"), "# Title\n").otherwise("")
    code = F.when(F.col("lang") == "en", F.concat(F.lit("\n```js\n"), F.regexp_extract("text", "^[^\n]*", 0), F.lit("\n```\nafter\n```\nmore\n```\n"))).otherwise("")
    return t.documents.select("doc_id", M.body_description(F.concat(title, "text", code)).alias("description"))


@query(
    "a13_section_by_anchor",
    SQL_LINES + r""", w as (select doc_id, section, string_agg(line, chr(10) order by pos) as content, max(title) as title from h where section > 0 group by all),
g as (select doc_id, regexp_replace(lower(title), '[^\p{L}\p{N}_\- ]', '', 'g') as k, content, section from w),
a as (select doc_id, ltrim(replace(k, ' ', '-'), '-') as slug, arg_min(content, section) as content from g group by all)
select doc_id, slug, length(trim(content, chr(10) || ' ')) as n from a where slug in (select slug from a join documents using (doc_id) where lang = 'en')""",
)
def a13_section_by_anchor(t):
    d = t.documents.select("doc_id", "lang", marked().alias("m"))
    slugs = M.sections(d, "m", r"(##\s+.+)", ["doc_id", "lang"], trim=False).filter("section > 0").select(
        "doc_id", "lang", M.heading_slug(F.regexp_replace("title", r"^##\s+", "")).alias("slug")
    )
    # every document is asked for the anchors that the English ones have
    asked = slugs.filter("lang = 'en'").select("slug").distinct()
    wanted = slugs.join(asked, "slug", "left_semi")
    out = M.section_by_anchor(d, wanted, key="doc_id", text="m")
    return out.select("doc_id", "slug", F.length(F.regexp_replace("content", r"^[ \n]+|[ \n]+$", "")).cast("long").alias("n"))


@query(
    "a14_segment_records",
    r"""
with m as (select doc_id, regexp_replace(regexp_replace(text, '(?m)^([^\n]{1,25})$', '## \1', 'g'), '(?m)^([^#\n][^\n]{25,119})$', '### \1', 'g') as t from documents),
l as (select doc_id, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as pos from m),
a as (select *, sum(case when starts_with(line, '## ') then 1 else 0 end) over (partition by doc_id order by pos) as section,
  max(case when starts_with(line, '## ') then pos end) over (partition by doc_id order by pos) as hpos from l),
b as (select a.*, h.line as title, sum(case when starts_with(a.line, '### ') then 1 else 0 end) over (partition by a.doc_id, a.section order by a.pos) as record
  from a join l h on h.doc_id = a.doc_id and h.pos = a.hpos)
select doc_id, cast(section as bigint) as section, cast(record as bigint) as record, trim(substr(min(line) filter (where starts_with(line, '### ')), 5)) as name,
  cast(count(*) - 1 as bigint) as n_lines, cast(sum(case when starts_with(line, '### ') then 0 else length(line) end) as bigint) as n
from b where section > 0 and record > 0 and regexp_matches(title, '[aeiou]') group by all
""",
)
def a14_segment_records(t):
    m = F.regexp_replace(F.regexp_replace("text", r"(?m)^([^\n]{1,25})$", "## $1"), r"(?m)^([^#\n][^\n]{25,119})$", "### $1")
    out = M.records(t.documents.select("doc_id", m.alias("m")), "m", ["doc_id"], within="[aeiou]", record=r"###\s+(.+)")
    lines = F.split("content", "\n")
    has = F.length("content") > 0
    # a record ends before the line break of the next heading
    return out.select(
        "doc_id", F.col("section").cast("long").alias("section"), F.col("record").cast("long").alias("record"), "name",
        F.when(has | F.col("content").startswith("\n"), F.size(lines)).otherwise(F.lit(0)).cast("long").alias("n_lines"),
        F.length(F.replace("content", F.lit("\n"), F.lit(""))).cast("long").alias("n"),
    )


@query(
    "a15_threshold_load",
    "select p_partkey, p_name, p_size from (select *, row_number() over (partition by p_name, p_brand order by p_partkey) as rn from part where p_size >= 10) where rn = 1",
)
def a15_threshold_load(t):
    p = t.part.withColumn("id", F.concat_ws("|", "p_name", "p_brand"))
    return A.load_threshold(p, "p_size", 10, "id", "p_partkey").select("p_partkey", "p_name", "p_size")


@query(
    "a15_install_snapshot",
    """
with l as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity * 30 as bigint) as n, row_number() over (partition by l_partkey, l_suppkey order by l_orderkey, l_linenumber, l_quantity desc, l_shipdate) as rn
  from lineitem where l_quantity * 30 >= 1000)
select 's' || l_partkey || '-o' || l_suppkey as id, 'https://github.com/o/' || l_suppkey || '#skill=s' || l_partkey as source_url, count(*) as n from l group by all
""",
)
def a15_install_snapshot(t):
    rows = t.lineitem.select(
        F.concat(F.lit("s"), s("l_partkey")).alias("skillId"), F.concat(F.lit("O"), s("l_suppkey")).alias("owner"), F.lit("").alias("repo"),
        F.concat(F.lit("https://github.com/o/"), s("l_suppkey"), F.lit("/")).alias("githubUrl"), F.lit("").alias("displayName"),
        (F.col("l_quantity") * 30).cast("long").alias("installs"),
        F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_extendedprice").alias("_ord"),
    )
    kept, rejected = D.install_entries(rows, "2024-02-01")
    both = kept.select("id", "source_url").unionByName(rejected.select("id", "source_url"))
    return both.groupBy("id", "source_url").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a16_marketplace",
    """
with p as (select p_partkey, lower(replace(p_brand, '#', '-')) as src, p_name, p_type, p_size % 6 as k, 'o/' || lower(replace(p_brand, '#', '')) as repo from part)
select src || '-' || lower(replace(p_name, ' ', '-')) || '-' || p_partkey as id,
  case k when 0 then 'https://github.com/x/' || p_partkey when 1 then 'https://github.com/y/z' when 2 then 'http://h/' || p_partkey when 3 then 'https://g/r.git'
    when 4 then 'https://github.com/' || repo || '/tree/main/plugins/p' else 'https://github.com/' || repo end as source_url,
  case when k = 0 then 1.0::double else 0.7::double end as manifest_completeness, case when k = 3 then lower(p_type) || ',x' else lower(p_type) end as tags from p
""",
)
def a16_marketplace(t):
    k, key = F.col("p_size") % 6, s("p_partkey")
    source = first_rule([
        (k == 0, F.concat(F.lit('{"source": "github", "repo": "x/'), key, F.lit('"}'))), (k == 1, F.lit('"github:y/z"')),
        (k == 2, F.concat(F.lit('{"url": "http://h/'), key, F.lit('"}'))), (k == 3, F.lit('"git+https://g/r.git"')), (k == 4, F.lit('"./plugins/p"')),
    ])
    plugin = F.struct(
        F.concat("p_name", F.lit(" "), key).alias("name"), F.lit("about it").alias("description"), F.when(k == 0, "1.0").alias("version"),
        F.lit("").alias("category"), F.array(F.col("p_type"), F.when(k == 3, " X").otherwise(F.col("p_type"))).alias("tags"),
        F.try_parse_json(F.lit('{"email": "a@b"}')).alias("author"), F.try_parse_json(source).alias("source"),
    )
    m = t.part.select(
        F.concat(F.lit("o/"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("")))).alias("repo"), F.lit("main").alias("branch"),
        F.replace("p_brand", F.lit("#"), F.lit("-")).alias("source_id"), F.array(plugin).alias("plugins"),
    )
    own = D.marketplace_entries(m)
    return own.select("id", "source_url", "manifest_completeness", F.array_join("tags", ",").alias("tags"))


@query(
    "a16_own_manifests",
    """
with p as (select p_partkey, 'o/' || (p_partkey % 40) as repo, 'p ' || p_partkey as name, p_size % 4 as k from part)
select name, case when k = 1 then 'listed' when k in (0, 2) then 'own 0' else '' end as description, case k when 0 then '9' when 3 then '1' else '' end as version,
  case k when 0 then 1.0::double else 0.7::double end as manifest_completeness from p
""",
)
def a16_own_manifests(t):
    """Plugins with a manifest of their own, some of them with several, whose fields fill what the list leaves open."""
    k, name = F.col("p_size") % 4, F.concat(F.lit("p "), s("p_partkey"))
    repo = F.concat(F.lit("o/"), (F.col("p_partkey") % 40).cast("string"))
    none = F.lit(None).cast("string")
    plugin = F.struct(
        name.alias("name"), F.when(k == 1, " listed ").alias("description"), F.when(k == 3, "1").alias("version"), none.alias("category"),
        F.array().cast("array<string>").alias("tags"), F.try_parse_json(F.lit('"me"')).alias("author"), F.try_parse_json(F.lit('"./x"')).alias("source"),
    )
    m = t.part.select(repo.alias("repo"), F.lit("main").alias("branch"), repo.alias("source_id"), F.array(plugin).alias("plugins"))
    place = F.explode(F.sequence(F.lit(0), F.when(k == 2, 2).otherwise(0))).alias("place")
    own = t.part.filter(k != 3).select(repo.alias("repo"), name.alias("name"), k.alias("k"), place).select(
        "repo", "name", "place", F.concat(F.lit("own "), s("place")).alias("description"), F.when(F.col("k") == 0, "9").alias("version"),
        F.when(F.col("k") == 0, "them").alias("author"))
    return D.marketplace_entries(m, own).select("name", "description", "version", "manifest_completeness")


@query(
    "a17_community",
    """
select lower(replace(p_brand, '#', '-')) || '-' || lower(replace(p_name, ' ', '-')) as id, p_partkey from (
  select *, row_number() over (partition by p_brand, p_name order by p_partkey) as rn from part where p_size * 200 >= 5000) where rn = 1
""",
)
def a17_community(t):
    rows = t.part.select(
        F.lit(None).cast("string").alias("uid"), F.concat(F.lit("@"), "p_brand").alias("namespace"), F.col("p_name").alias("name"),
        (F.col("p_size") * 200).cast("string").alias("stars"), "p_partkey", F.col("p_partkey").alias("_ord"),
    )
    return D.community_entries(rows).select("id", "p_partkey")


def tree_files(t):
    """A file tree per brand: parts as files of plugins below ``plugins/`` folders, some of them nested."""
    folder = first_rule([
        (F.col("p_size") < 10, F.lit("")),
        (F.col("p_size") < 30, F.concat(F.lit("plugins/"), F.lower("p_type"), F.lit("/"))),
    ], F.concat(F.lit("plugins/"), F.lower("p_type"), F.lit("/sub/"), F.regexp_replace("p_name", " ", "-"), F.lit("/")))
    rest = first_rule([
        (F.col("p_size") % 5 == 0, F.lit(".claude-plugin/plugin.json")),
        (F.col("p_size") % 5 == 1, F.concat(F.lit("skills/k"), s("p_partkey"), F.lit("/SKILL.md"))),
        (F.col("p_size") % 5 == 2, F.concat(F.lit("agents/k"), s("p_partkey"), F.lit(".md"))),
        (F.col("p_size") % 5 == 3, F.concat(F.lit(".hidden/commands/k"), s("p_partkey"), F.lit(".md"))),
    ], F.concat(F.lit(".commands/k"), s("p_partkey"), F.lit(".md")))
    return t.part.select(F.col("p_brand").alias("repo"), F.concat(folder, rest).alias("path")).distinct()


SQL_TREE = """
with f as (select distinct p_brand as repo, case when p_size < 10 then '' when p_size < 30 then 'plugins/' || lower(p_type) || '/'
    else 'plugins/' || lower(p_type) || '/sub/' || replace(p_name, ' ', '-') || '/' end ||
  case p_size % 5 when 0 then '.claude-plugin/plugin.json' when 1 then 'skills/k' || p_partkey || '/SKILL.md' when 2 then 'agents/k' || p_partkey || '.md'
    when 3 then '.hidden/commands/k' || p_partkey || '.md' else '.commands/k' || p_partkey || '.md' end as path from part),
r as (select distinct repo, rtrim(substr(path, 1, length(path) - 26), '/') as root from f where ends_with(path, '.claude-plugin/plugin.json')),
o as (select f.repo, f.path, arg_max(r.root, length(r.root)) as root from f join r on r.repo = f.repo and (r.root = '' or starts_with(f.path, r.root || '/')) group by all),
c as (select *, case when contains(path, '.hidden/') then null when ends_with(path, 'SKILL.md') then 'skill' when contains(path, 'agents/') then 'agent' when contains(path, '.commands/') then 'command' end as class from o)"""


@query("a18_component_class", SQL_TREE + " select repo, path, root, class from c")
def a18_component_class(t):
    files = tree_files(t)
    owned = R.deepest_root(files, R.plugin_roots(files))
    return owned.withColumn("class", R.component_class("path", "root"))


@query(
    "a18_layouts",
    SQL_TREE + """, t as (select repo, root from r union select repo, '' from f),
n as (select t.repo, t.root, count(*) filter (where starts_with(r.root, case when t.root = '' then '' else t.root || '/' end || 'plugins/')) as nested from t join r on r.repo = t.repo group by all),
h as (select t.repo, t.root, bool_or(starts_with(f.path, case when t.root = '' then '' else t.root || '/' end || 'plugins/')) as has from t join f on f.repo = t.repo group by all),
k as (select repo, root, count(*) filter (where class = 'skill') as skills, count(*) filter (where class = 'agent') as agents, count(*) filter (where class = 'command') as commands from c group by all),
x as (select t.*, r.root is not null as is_plugin, coalesce(has, false) and (r.root is null or coalesce(nested, 0) >= 5) as m, coalesce(skills, 0) as s, coalesce(agents, 0) as a, coalesce(commands, 0) as c
  from t left join r using (repo, root) left join n using (repo, root) left join h using (repo, root) left join k using (repo, root))
select repo, root, is_plugin, m as is_marketplace, case when is_plugin and not m then s else 0 end as skills, case when is_plugin and not m then a else 0 end as agents,
  case when is_plugin and not m then c else 0 end as commands from x""",
)
def a18_layouts(t):
    files = tree_files(t)
    targets = R.plugin_roots(files).unionByName(files.select("repo", F.lit("").alias("root"))).distinct()
    return R.layouts(files, targets)


@query(
    "a19_hook_facts",
    """select event_id, case when event_type = 'view' then 'a,k' when event_type = 'click' then '' else 'k' end as events,
  case when event_type = 'view' then 3 when event_type = 'click' then 0 else 1 end as entries, case when event_type = 'error' then 'a,b,k' else 'k' end as servers from events""",
)
def a19_hook_facts(t):
    one = F.concat(F.lit('"k": ['), "props", F.lit("]"))
    hooks = first_rule([
        (F.col("event_type") == "view", F.concat(F.lit('{"hooks": {'), one, F.lit(', "a": [1, {"x": 2}], "bad": "text"}}'))),
        (F.col("event_type") == "click", F.lit('{"hooks": [1')),
    ], F.concat(F.lit('{"hooks": {'), one, F.lit("}}")))
    manifest = F.when(F.col("event_type") == "error", F.lit('{"mcpServers": {"b": {}, "a": {}}}')).otherwise('{"mcpServers": "./file.json"}')
    servers = F.when(F.col("event_type") == "view", F.col("props")).otherwise(F.concat(F.lit('{"mcpServers": '), "props", F.lit("}")))
    e = t.events.select("event_id", R.hook_facts(hooks).alias("h"), R.server_names(manifest, servers).alias("n"))
    return e.select("event_id", F.array_join("h.events", ",").alias("events"), "h.entries", F.array_join("n", ",").alias("servers"))


@query(
    "a20_artifacts",
    """select doc_id, lang, quality from documents join labels using (doc_id) where toxic = 0""",
)
def a20_artifacts(t):
    d = t.documents.join(t.labels, "doc_id").select("doc_id", "lang", "quality", "toxic")
    evaluation = F.when(F.col("toxic") == 0, F.concat(F.lit('{"q": '), s("quality"), F.lit("}")))
    artifacts = d.select(F.col("lang").alias("type"), F.array(F.struct(s("doc_id").alias("entry_id"), evaluation.alias("evaluation"))).alias("succeeded"))
    out = D.artifact_results(artifacts)
    return out.select(F.col("entry_id").cast("long").alias("doc_id"), F.col("type").alias("lang"), F.get_json_object("evaluation", "$.q").cast("int").alias("quality"))


@query(
    "a21_publishable",
    "select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'F' or o_orderpriority <> '1-URGENT'",
)
def a21_publishable(t):
    o = t.orders.withColumn("bundled_in", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("x")))
    return A.publishable(o, type_="o_orderstatus", bundled_type="F").select("o_orderkey", "o_orderstatus")


@query(
    "a21_published_folders",
    """select o_orderstatus as type, o_orderkey, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) - 1 as place from orders
where o_orderstatus <> 'F' or o_orderpriority <> '1-URGENT'""",
)
def a21_published_folders(t):
    """The folders by type written and read back; the place is that of the row among the lines of its folder."""
    folder = scratch(t, "types")
    o = t.orders.select(
        F.col("o_orderstatus").alias("type"), "o_orderkey", "o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("x")).alias("bundled_in"))
    A.publish_partitions(o, folder, order=[F.desc("o_totalprice"), F.asc("o_orderkey")], known=["F", "O", "P", "none"], bundled_type="F", version="v1")
    lines = t.spark.read.schema("o_orderkey bigint, type string").json(A.current_folder(t.spark, folder))
    lines = lines.withColumn("file", F.col("_metadata.file_path")).withColumn("line", F.monotonically_increasing_id())
    laid = with_position(lines, [F.asc("type"), F.asc("file"), F.asc("line")], "at")
    begins = laid.groupBy(F.col("type").alias("_type")).agg(F.min("at").alias("_begin"))  # one row for a folder
    placed = laid.join(F.broadcast(begins), F.col("type").eqNullSafe(F.col("_type")))
    return placed.select("type", "o_orderkey", (F.col("at") - F.col("_begin")).alias("place"))


@query(
    "a21_entry_documents",
    """select p_type as type, replace(replace(replace(p_brand || '/' || p_name, '#', '-'), '/', '--'), ' ', '-') as file_id, '{"id":"' || p_brand || '/' || p_name || '"'
  || case when p_size > 10 then ',"size":' || p_size else '' end || ',"type":"' || p_type || '"}' as document from part""",
)
def a21_entry_documents(t):
    p = t.part.select(
        F.concat("p_brand", F.lit("/"), "p_name").alias("id"), F.when(F.col("p_size") > 10, F.col("p_size")).alias("size"), F.col("p_type").alias("type")
    )
    return A.entry_documents(p)


@query(
    "a22_rule_files",
    r"""
with p as (select page_id, regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(\d+)', 1) as repo, regexp_extract(url, '^https?://[^/]+/([a-z]+)/(\d+)', 1) as lang, regexp_extract(url, '^https?://[^/]+/([a-z]+)/(\d+)', 2) as num from pages),
k as (select repo, min(page_id) as stars from p where lang <> 'fr' group by repo)
select page_id, case when lang = 'en' then 'no-' || num || '-x' else 'rules-' || lang || '-x' end as id, case when lang = 'en' then 'No ' || num || ' (Windsurf Global)' else 'Named It (Windsurf)' end as name,
  case when lang = 'en' then 'tooling' else 'special' end as category, case when lang = 'en' then 'windsurf-global,windsurf' else 'a,windsurf' end as tags, coalesce(k.stars, -1) as stars
from p left join k using (repo) where lang <> 'es'
""",
)
def a22_rule_files(t):
    get = lambda i: F.regexp_extract("url", r"^https?://([^/]+)/([a-z]+)/(\d+)", i)
    p = t.pages.select("page_id", get(1).alias("repo"), get(2).alias("lang"), get(3).alias("num"))
    path = first_rule([
        (F.col("lang") == "en", F.concat(F.lit("rules/global_rules/no-"), "num", F.lit("/global_rules.MD"))),
        (F.col("lang") == "es", F.lit("docs/x.md")),
    ], F.concat(F.lit("rules/rules_"), "lang", F.lit("/r"), s("page_id"), F.lit(".md")))
    text = F.when(F.col("lang") == "en", "plain words").otherwise("---\nname: 'named-it'\ncategory: Special\ntags: [\"A\", a]\n---\nplain words")
    files = p.withColumns({"path": path, "text": text})
    repos = p.filter("lang <> 'fr'").groupBy("repo").agg(F.min("page_id").alias("stars")).withColumn("pushed_at", F.lit("2024"))
    out = M.rule_files(files, repos, suffix="-x")
    keyed = files.select("repo", "path", "page_id").join(out.select("repo", "path", "id", "name", "category", "tags", "stars").distinct(), ["repo", "path"])
    return keyed.select("page_id", "id", "name", "category", F.array_join("tags", ",").alias("tags"), F.coalesce("stars", F.lit(-1)).alias("stars"))


@query(
    "a23_first_line",
    r"""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
g as (select doc_id, trim(regexp_replace(trim(line), '^#+|#+$', '', 'g')) as line, pos from l),
f as (select doc_id, arg_min(substr(line, 1, 100), pos) as line from g where line <> '' and not regexp_matches(line, '^(!|\[|---)') group by doc_id)
select doc_id, coalesce(line, 'about ' || source) as description from documents left join f using (doc_id)
""",
)
def a23_first_line(t):
    return t.documents.select("doc_id", M.first_line("text", 100, F.concat(F.lit("about "), "source")).alias("description"))


@query(
    "a24_with_file",
    "select o_orderkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R' and l_quantity > 10)",
)
def a24_with_file(t):
    folder = F.when(F.col("l_returnflag") == "R", "skills/").otherwise("docs/")
    deep = F.when(F.col("l_quantity") > 10, "/SKILL.md").otherwise("/more/SKILL.md")
    files = t.lineitem.select(F.concat(folder, s("l_orderkey"), deep).alias("path"))
    return R.with_file(t.orders.withColumn("name", s("o_orderkey")), files, name="name", depth=3).select("o_orderkey")


@query(
    "a25_component_names",
    """select p_partkey, case when p_size > 30 then 'deep' when p_size > 20 then 'named' else lower(p_type) end || ':' || case when p_size > 30 then p_name when p_size > 10 then 'inner' else 'k' end as namespace from part""",
)
def a25_component_names(t):
    root = F.when(F.col("p_size") > 30, "a/deep").otherwise("")
    path = first_rule([
        (F.col("p_size") > 30, F.concat(F.lit("a/deep/skills/"), "p_name", F.lit("/x/SKILL.md"))), (F.col("p_size") > 10, F.lit("lib/inner/SKILL.md")),
    ], F.lit("skills/k/SKILL.md"))
    plugin = R.plugin_name(F.concat(F.lit("owner/"), F.lower("p_type")), root, F.when(F.col("p_size") > 20, " named "))
    return t.part.select("p_partkey", R.namespace(plugin, R.skill_name_of_path(path, root)).alias("namespace"))


@query(
    "a26_bad_rows",
    """select event_id, event_type = 'error' as rejected, case when event_type = 'error' then -1 else cast(json_extract_string(props, '$.k') as bigint) end as k from events""",
)
def a26_bad_rows(t):
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), F.lit('"k": '))).otherwise(F.col("props"))
    good, bad = A.split_rejects(t.events.select("event_id", line.alias("value")), "value", "k bigint", ["event_id"])
    return good.select("event_id", F.lit(False).alias("rejected"), "k").unionByName(
        bad.select("event_id", F.lit(True).alias("rejected"), F.lit(-1).cast("long").alias("k"))
    )


@query(
    "a27_export_payload",
    """select p_partkey, '---' || chr(10) || 'name: ' || p_name || chr(10) || case when p_size > 10 then 'size: ' || p_size || chr(10) else '' end || '---' || chr(10) || chr(10) || p_type as document,
  '{"name":"' || p_name || '","brand":"' || p_brand || '"}' as payload from part where p_brand <> 'Brand#3'""",
)
def a27_export_payload(t):
    brand = F.when(F.col("p_brand") != "Brand#3", F.col("p_brand"))
    size = F.when(F.col("p_size") > 10, F.col("p_size"))
    p = t.part.withColumn("document", A.with_front_matter(F.col("p_type"), {"name": F.col("p_name"), "size": size}))
    out = A.export_payload(p, {"name": F.col("p_name"), "brand": brand}, [brand, F.col("p_name")])
    return out.select("p_partkey", "document", "payload")
