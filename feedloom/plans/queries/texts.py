"""Queries of text, date and JSON columns (K1-K26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed, jsons as J, text as X
from ...functions.values import first_rule
from ...operators import content as T
from ..registry import query

# Keywords that occur in the test texts, inside words too.
RULES = [("tion", "c1"), ("der", "c2"), ("ment", "c3"), ("ing", "c4")]


def low_docs(t):
    return t.documents.withColumn("_t", F.lower("text"))


@query(
    "k1_categorize",
    """select doc_id, case source when 'src1' then 'up1' when 'src2' then 'up2' else case when contains(lower(text), 'tion') then 'c1'
  when contains(lower(text), 'der') then 'c2' when contains(lower(text), 'ment') then 'c3' when contains(lower(text), 'ing') then 'c4' else 'tooling' end end as category from documents""",
)
def k1_categorize(t):
    rules = [*RULES, ("src1", "up1"), ("src2", "up2")]
    d = low_docs(t).withColumn("up", F.when(F.col("source").isin("src1", "src2"), F.upper("source")))
    return d.select("doc_id", X.categorize("_t", "up", rules).alias("category"))


def sql_fixed_category(text: str) -> str:
    return "case " + " ".join(f"when contains({text}, '{w}') then '{c}'" for w, c in fixed.CATEGORY_KEYWORDS.items()) + " else 'tooling' end"


@query("k1_categorize_fixed", f"select doc_id, {sql_fixed_category('t')} as category from (select doc_id, lower(text) as t from documents)")
def k1_categorize_fixed(t):
    return low_docs(t).select("doc_id", X.categorize("_t").alias("category"))


@query(
    "k2_extract_tags",
    "select doc_id, array_to_string(list_distinct_ordered, ',') as tags from (select doc_id, list_filter(["
    + ", ".join(f"case when contains(t, '{w}') then '{tag}' end" for w, tag in fixed.TAG_KEYWORDS.items() if w != "nextjs")
    + "], lambda x: x is not null) as list_distinct_ordered from (select doc_id, lower(text) as t from documents))",
)
def k2_extract_tags(t):
    return low_docs(t).select("doc_id", F.array_join(X.extract_tags("_t"), ",").alias("tags"))


@query(
    "k3_tech_stack",
    "select p_partkey, case "
    + " ".join(
        "when " + " or ".join(f"contains(t, '{w}')" for w in words) + f" then '{','.join(stack)}'" for words, stack in fixed.STACK_RULES
    )
    + " else '' end as stack from (select p_partkey, lower(p_name || ' ' || p_type || ' ' || case p_size % 4 when 0 then 'dart' when 1 then 'postgres' when 2 then 'on go now' else 'react' end) as t from part)",
)
def k3_tech_stack(t):
    extra = F.element_at(F.array(*map(F.lit, ("dart", "postgres", "on go now", "react"))), F.col("p_size") % 4 + 1)
    p = t.part.withColumn("_t", X.joined_text("p_name", "p_type", extra))
    return p.select("p_partkey", F.array_join(X.tech_stack("_t"), ",").alias("stack"))


@query(
    "k4_scene",
    r"""
select p_partkey, case when lower(p_type) = 'small' or contains(lower(p_name), 'red') or contains(lower(p_name), 'small') then 's1'
  when lower(p_type) = 'economy' or contains(lower(p_name), 'bolt') or regexp_matches(lower(p_brand) || ' gear box', '\bgear\b') and p_size > 25 then 's2'
  when p_brand = 'Brand#3' then 'hint' end as scene from part
""",
)
def k4_scene(t):
    scenes = [("s1", ("small", "red")), ("s2", ("economy", "bolt", "gear"))]
    description = F.lower(F.concat("p_brand", F.when(F.col("p_size") > 25, " gear box").otherwise(" gearbox")))
    name = F.regexp_replace(F.lower("p_name"), "gear", "cog")
    s = X.scene(name, F.array(F.lower("p_type")), description, F.lower("p_brand"), scenes, {"brand#3": "hint"})
    return t.part.select("p_partkey", s.alias("scene"))


@query(
    "k5_prefix_category",
    """select p_partkey, case split_part(lower(replace(p_name, ' ', '-')), '-', 1) when 'red' then 'r' when 'blue' then 'b'
  else case when contains(lower(p_name), 'ring') then 'c1' else 'tooling' end end as category from part""",
)
def k5_prefix_category(t):
    p = t.part.withColumn("slug", F.lower(F.replace("p_name", F.lit(" "), F.lit("-")))).withColumn("_t", F.lower("p_name"))
    category = X.prefix_category("slug", "_t", {"red": "r", "blue": "b"}, [("ring", "c1")])
    return p.select("p_partkey", category.alias("category"))


@query(
    "k6_ids",
    r"""
with p as (select p_partkey, p_name || ' ' || p_brand as n, p_brand, p_type from part)
select p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(n), '[^\w\s-]', '', 'g'), '[\s_]+', '-', 'g'), '-+', '-', 'g'), '-') as kebab,
  trim(regexp_replace(regexp_replace(lower(n), '[\s_./]+', '-', 'g'), '[^a-z0-9-]+', '-', 'g'), '-') || '-' || substr(sha1(n), 1, 8) as hashed,
  regexp_replace(replace(replace(p_brand || '/' || p_name_, '/', '--'), '@', ''), '[^\w.-]', '-', 'g') as file_id,
  trim(replace(regexp_replace(lower(p_name_ || ' ' || p_brand), '[^a-z0-9 -]', '', 'g'), ' ', '-'), '-') as anchor,
  lower(replace(p_name_, ' ', '-')) || '-' || lower(replace(p_brand, '#', '-')) || '-' || lower(p_type) as composite
from (select p.*, part.p_name as p_name_ from p join part using (p_partkey))
""",
)
def k6_ids(t):
    n = F.concat_ws(" ", "p_name", "p_brand")
    return t.part.select(
        "p_partkey", X.kebab(n).alias("kebab"), X.hashed_id(n).alias("hashed"),
        X.composite_id("p_name", "p_brand", "p_type").alias("composite"),
        X.file_id(F.concat_ws("/", "p_brand", "p_name")).alias("file_id"), X.anchor_slug(n).alias("anchor"),
    )


@query(
    "k7_id_from_url",
    r"""
with p as (select page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) as host,
  list_filter(string_split(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) || '/' || lower(regexp_extract(html, '<html lang="(..)"', 1)), '/'), lambda x: x <> '') as parts from pages)
select page_id, lower(parts[3]) || '-' || lower(parts[1]) || '-' || trim(regexp_replace(lower(parts[2]), '[^a-z0-9-]+', '-', 'g'), '-') as id from p
""",
)
def k7_id_from_url(t):
    lang = F.regexp_extract("html", '<html lang="(..)"', 1)
    url = F.concat(F.regexp_replace("url", "/*([?#].*)?$", ""), F.lit("/"), lang)
    return t.pages.select("page_id", X.id_from_listing_url(url, r"[a-z.-]+\.example\.[a-z]+").alias("id"))


@query(
    "k8_cuts",
    r"""
with d as (select doc_id, text as s, substr(text, 1, 80) as h, n_chars, trim(regexp_replace(text, '\s+', ' ', 'g')) as c from documents),
e as (select *, case when contains(h, ' ') then length(h) - strpos(reverse(h), ' ') else -1 end as sp from d)
select doc_id, case when length(s) <= 80 then s when regexp_matches(substr(h, 80, 1), '[^\x00-\x7F]') then regexp_replace(h, '[。，、；：！？]+$', '') || '…'
  when sp > 48 then substr(h, 1, sp) || '…' else h || '…' end as by_word,
  case when length(c) <= 60 then c else regexp_replace(substr(c, 1, 59), '\s+$', '') || '…' end as collapsed,
  case when n_chars >= 1000 then printf('%.1f', n_chars / 1000.0) || 'k' when n_chars > 0 then cast(n_chars as varchar) else '—' end as stars,
  case when length(s) <= 100 then s else substr(s, 1, 100) || '...' end as plain
from e
""",
)
def k8_cuts(t):
    return t.documents.select(
        "doc_id", X.cut_words("text").alias("by_word"), X.cut_collapsed("text", 60).alias("collapsed"), X.star_label("n_chars").alias("stars"),
        X.cut_plain("text", 100).alias("plain"),
    )


SQL_TIME_TEXT = """case event_type when 'view' then strftime(ts, '%Y-%m-%d') when 'click' then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  when 'error' then strftime(ts, '%Y-%m-%d %H:%M:%S') when 'signup' then strftime(ts + interval 2 hour, '%Y-%m-%dT%H:%M:%S') || '+02:00' else 'soon' end"""


def time_text():
    ts, fmt = F.col("ts").cast("timestamp"), lambda c, f: F.date_format(c, f)
    return first_rule(
        [
            (F.col("event_type") == "view", fmt(ts, "yyyy-MM-dd")),
            (F.col("event_type") == "click", fmt(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            (F.col("event_type") == "error", fmt(ts, "yyyy-MM-dd HH:mm:ss")),
            (F.col("event_type") == "signup", F.concat(fmt(ts + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))),
        ],
        "soon",
    )


@query(
    "k9_parse_time",
    """select event_id, case event_type when 'view' then strftime(ts, '%Y-%m-%d 00:00:00') when 'purchase' then null else strftime(ts, '%Y-%m-%d %H:%M:%S') end as at,
  case event_type when 'view' then strftime(ts, '%Y-%m-%d') when 'click' then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 'error' then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  when 'signup' then strftime(ts + interval 2 hour, '%Y-%m-%dT%H:%M:%S') || '+02:00' else 'soon' end as iso from events""",
)
def k9_parse_time(t):
    e = t.events.withColumn("s", time_text())
    return e.select("event_id", F.date_format(X.parse_time("s"), "yyyy-MM-dd HH:mm:ss").alias("at"), X.iso_z("s").alias("iso"))


@query(
    "k10_stale",
    """select event_id, event_type = 'purchase' or floor(epoch(timestamp '2024-02-01' - case when event_type = 'view' then date_trunc('day', ts) else date_trunc('second', ts) end) / 86400) > 14 as stale from events""",
)
def k10_stale(t):
    from ...functions.scores import is_stale

    e = t.events.withColumn("s", time_text())
    return e.select("event_id", is_stale("2024-02-01", X.parse_time("s")).alias("stale"))


@query(
    "k11_cache_keys",
    """select doc_id, sha256(text) as content, sha256('full:' || sha256(text) || ':2.ab') as key,
  sha256('security|full:' || sha256(text) || ':2.ab:' || lang) as ns_key, '3.' || substr(sha256(source), 1, 8) as rubric from documents""",
)
def k11_cache_keys(t):
    h = X.content_hash("text")
    return t.documents.select(
        "doc_id", h.alias("content"), X.cache_key("full", h, F.lit("2.ab")).alias("key"),
        X.cache_key("full", h, F.lit("2.ab"), F.col("lang"), "security").alias("ns_key"), X.rubric_version(3, "source").alias("rubric"),
    )


def fence(k):
    head = F.format_string('// made of %s', F.col("event_type"))
    body = F.concat(F.lit('{"mcpServers": {"b-'), F.col("event_type"), F.lit('": {"command": "run", "args": ["-k", "'), k, F.lit('"]}, "a": {"command": "no"}}}'))
    broken = F.when(F.col("event_type") == "view", F.lit('{"mcpServers": {"x": ')).otherwise(F.lit('{"other": 1}'))
    return F.concat(F.lit("text\n```json\n"), broken, F.lit("\n```\n```jsonc\n"), head, F.lit("\n"), body, F.lit("\n```\n"))


@query(
    "k12_embedded_config",
    "select event_id, 'run' as command, '-k ' || json_extract_string(props, '$.k') as args from events",
)
def k12_embedded_config(t):
    e = t.events.withColumn("doc", fence(F.get_json_object("props", "$.k")))
    c = J.config_in_text("doc")
    return e.select("event_id", c.alias("c")).select("event_id", "c.command", F.array_join("c.args", " ").alias("args"))


@query(
    "k13_placeholders",
    """
with p as (select event_id, event_type, cast(json_extract_string(props, '$.k') as bigint) as k from events)
select event_id, case when k > 50 or event_type = 'view' then 'mcp_config_template' else 'mcp_config' end as method,
  case when k > 50 then 'Replace with actual api key' when false then '' else '' end as api, case when event_type = 'view' then 'Set your TOKEN' else '' end as token from p
""",
)
def k13_placeholders(t):
    k = F.get_json_object("props", "$.k").cast("int")
    args = F.array(F.lit("--go"), F.when(k > 50, "x=<API_key>").otherwise("<1>"))
    env = F.create_map(F.lit("TOKEN"), F.when(F.col("event_type") == "view", "YOUR_TOKEN").otherwise("set"))
    e = t.events.select("event_id", J.placeholder_hints(args, env).alias("h"))
    at = lambda n: F.coalesce(F.try_element_at("h", F.lit(n)), F.lit(""))
    return e.select("event_id", J.config_method(F.col("h")).alias("method"), at("API_key").alias("api"), at("TOKEN").alias("token"))


@query(
    "k14_package_command",
    """select p_partkey, case p_size % 5 when 0 then 'npx -y ' || p_name when 1 then 'pipx run ' || p_name || '==1.2' when 2 then 'cargo install ' || p_name || '@1.2'
  when 3 then 'docker run ' || p_name || ':1.2' else 'other: ' || p_name || '@1.2' end as command from part""",
)
def k14_package_command(t):
    kind = F.element_at(F.array(*map(F.lit, ("npm", "PyPI", "cargo", "oci", "other"))), F.col("p_size") % 5 + 1)
    version = F.when(F.col("p_size") % 5 > 0, "1.2")
    return t.part.select("p_partkey", J.package_command(kind, "p_name", version).alias("command"))


@query(
    "k15_install_summary",
    """select p_partkey, case when p_type = 'SMALL' then '`uvx ' || p_name || '` ⚙️' when p_type = 'ECONOMY' then '`npx uvx`'
  when p_size > 25 then '`git clone` → ' || p_name || '/' else '📖 See repo' end as line from part""",
)
def k15_install_summary(t):
    p = t.part
    method = first_rule([(F.col("p_type") == "SMALL", "mcp_config_template"), (F.col("p_type") == "ECONOMY", "mcp_config"), (F.col("p_size") > 25, "git_clone")], "manual")
    none = F.array().cast("array<string>")
    args = F.when(F.col("p_type") == "SMALL", F.array(F.lit("-y"), F.col("p_name"))).otherwise(none)
    files = F.array(F.concat(F.lit("skills/"), "p_name", F.lit("/")))
    return p.select("p_partkey", J.install_summary(method, F.lit("uvx"), args, files).alias("line"))


@query(
    "k16_recover_json",
    """select event_id, cast(json_extract_string(props, '$.k') as integer) as k, event_type <> 'signup' as found from events where event_type <> 'signup'
union all select event_id, -1, false from events where event_type = 'signup'""",
)
def k16_recover_json(t):
    raw = first_rule(
        [
            (F.col("event_type") == "view", F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nDone"))),
            (F.col("event_type") == "error", F.concat(F.lit("Sure! "), "props", F.lit(" as asked {"))),
            (F.col("event_type") == "signup", F.lit("no object { here")),
        ],
        F.col("props"),
    )
    e = t.events.select("event_id", J.recover_object(raw).alias("o"))
    k = F.coalesce(F.get_json_object("o", "$.k").cast("int"), F.lit(-1))
    return e.select("event_id", k.alias("k"), J.has_keys(F.col("o"), ["k"]).alias("found"))


@query(
    "k16_recover_from_talk",
    r"""
with s as (select conv_id, turn, coalesce(text, '') || case when turn % 3 = 2 then ' {' else ' {"turn": ' || turn || ', "said": {"by": "' || role || '"}} and {' end as text from conversations),
r as (select conv_id, turn, substr(text, strpos(text, '{')) as rest from s),
p as (select conv_id, turn, rest, unnest(regexp_extract_all(rest, '[^{}]*[{}]')) as piece, generate_subscripts(regexp_extract_all(rest, '[^{}]*[{}]'), 1) as i from r),
d as (select *, sum(case when piece like '%{' then 1 else -1 end) over w as depth, sum(length(piece)) over w as upto from p window w as (partition by conv_id, turn order by i)),
f as (select conv_id, turn, any_value(rest) as rest, min(upto) filter (depth = 0) as upto from d group by conv_id, turn),
o as (select conv_id, turn, substr(rest, 1, upto::bigint) as x from f)
select conv_id, turn, case when json_valid(x) and json_type(x) = 'OBJECT' then x end as object from o
""",
)
def k16_recover_from_talk(t):
    """Objects said at the end of turns, found in the whole turn; every third turn opens a brace and does not close it."""
    said = F.concat(F.lit(' {"turn": '), F.col("turn").cast("string"), F.lit(', "said": {"by": "'), "role", F.lit('"}} and {'))
    text = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("turn") % 3 == 2, " {").otherwise(said))
    return t.conversations.select("conv_id", "turn", J.recover_object(text).alias("object"))


@query(
    "k17_normalize_result",
    """select doc_id, greatest(1, least(5, coalesce(quality * 9, 0))) as score, substr(text, 1, 150) as summary, lower(source) || ',' || lang as tags,
  substr(text, 1, 60) as first_highlight, lang || ',' || source as checks, substr(text, 1, 240) as reason from documents left join labels using (doc_id)""",
)
def k17_normalize_result(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    raw = F.struct(
        F.col("text").alias("summary"), F.lit(None).cast("string").alias("summary_zh"),
        F.array(F.concat(F.lit(" "), F.upper("source")), "lang").alias("tags"), F.array("text", "lang", "source", "lang").alias("highlights"),
    )
    e = d.select("doc_id", J.clamp_score(F.coalesce(F.col("quality") * 9, F.lit(0))).alias("score"), J.normalize_enrichment(raw).alias("e"),
                 J.normalize_installability(F.array("lang", "source", "lang"), "text").alias("i"))
    return e.select(
        "doc_id", "score", "e.summary", F.array_join("e.tags", ",").alias("tags"), F.col("e.highlights")[0].alias("first_highlight"),
        F.array_join("i.tags", ",").alias("checks"), "i.reason",
    )


@query(
    "k18_checked_verdict",
    """select doc_id, case when toxic = 1 then 'reject' when quality = 0 then 'caution' else 'safe' end as verdict,
  toxic = 1 or quality = 0 as coerced from labels""",
)
def k18_checked_verdict(t):
    risk = F.when(F.col("toxic") == 1, "high").when(F.col("quality") == 0, "medium").otherwise("low")
    return t.labels.select("doc_id", J.checked_verdict(risk, F.lit("safe")).alias("v")).select("doc_id", "v.*")


@query(
    "k19_security_content",
    """select event_id, '{"config":{"k":' || json_extract_string(props, '$.k') || ',"z":1},"method":"' || event_type || '"}' as content,
  sha256('{"config":{"k":' || json_extract_string(props, '$.k') || ',"z":1},"method":"' || event_type || '"}') as key from events""",
)
def k19_security_content(t):
    install = F.concat(
        F.lit('{"method": "'), "event_type", F.lit('", "extra": 1, "config": {"z": 1, "k": '), F.get_json_object("props", "$.k"), F.lit("}}")
    )
    e = t.events.withColumn("install", install).select("event_id", J.security_content("install").alias("content"))
    return e.withColumn("key", X.content_hash("content"))


@query(
    "k20_evaluation_input",
    """
with d as (select *, count(*) over (partition by source, lang) as n from documents),
c as (select *, case when n >= 20 then '## Resource Description' || chr(10) || source || chr(10) || chr(10) || '## Repository README' || chr(10) || text else text end as c from d),
k as (select *, case when coalesce(length(c), 0) = 0 then '(no content provided)' else c end as k from c)
select doc_id, sha256('# Resource: ' || doc_id || chr(10) || 'Type: ' || lang || chr(10) || 'Description: ' || source || chr(10) || 'Stars: ' || n_chars || chr(10)
  || chr(10) || '---' || chr(10) || chr(10) || '## README Content' || chr(10) || chr(10) || k) as prompt_key, length(k) as n from k
""",
)
def k20_evaluation_input(t):
    d = t.documents.withColumns({"repo": F.concat_ws("/", "source", "lang"), "name": F.col("doc_id").cast("string"), "url": F.lit(None).cast("string")})
    d = T.with_shared_prefix(d, repo="repo", content="text", description="source", threshold=20, spread=["doc_id"])
    d = d.withColumn("text", T.capped("text"))
    text = T.evaluation_input(name="name", type_="lang", description="source", url="url", stars="n_chars", tags=None, content=F.col("text"))
    return d.select("doc_id", X.content_hash(text).alias("prompt_key"), F.length("text").cast("long").alias("n"))


def _turns(t):
    class_ = F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).otherwise(2)
    return t.conversations.select("conv_id", class_.alias("class"), F.lpad(F.col("turn").cast("string"), 4, "0").alias("path"), "text")


def _bundled(parts):
    out = T.bundle_text(parts, bundle="conv_id", class_="class", path="path")
    return out.select("conv_id", X.content_hash("content").alias("content_key"), F.length("content").cast("long").alias("n"))


SQL_TURNS = """
with f as (select conv_id, case role when 'system' then 0 when 'user' then 1 else 2 end as class, turn, text, '## ' || lpad(cast(turn as varchar), 4, '0') || chr(10) || text || chr(10) as whole from conversations)"""


@query(
    "k21_bundle_text",
    SQL_TURNS + """
select conv_id, sha256(string_agg(whole, chr(10) order by class, turn)) as content_key, cast(sum(length(whole)) + count(*) - 1 as bigint) as n from f
where text is not null group by conv_id
""",
)
def k21_bundle_text(t):
    return _bundled(T.bundle_parts(_turns(t), bundle="conv_id", class_="class", path="path", text="text"))


@query(
    "k21_bundle_cut",
    SQL_TURNS + """,
b as (select *, coalesce(sum(length(whole)) over (partition by conv_id order by class, turn rows between unbounded preceding and 1 preceding), 0) as before,
  row_number() over (partition by conv_id, class order by turn) as i from f),
p as (select conv_id, class, turn, case when class = 0 or before < 1500 or i <= 1 then whole
  else '## ' || lpad(cast(turn as varchar), 4, '0') || chr(10) || substr(text, 1, 800) || chr(10) end as part from b)
select conv_id, sha256(string_agg(part, chr(10) order by class, turn)) as content_key, cast(sum(length(part)) + count(*) - 1 as bigint) as n from p group by conv_id
""",
)
def k21_bundle_cut(t):
    """The cut that a caller asks for by ``cap``."""
    return _bundled(T.bundle_parts(_turns(t), bundle="conv_id", class_="class", path="path", text="text", cap=1500, full_per_class=1, short=800))


@query(
    "k21_bundle_rows",
    SQL_TURNS + """
select conv_id, coalesce(sum(length(whole) + 1) over (partition by conv_id order by class, turn rows between unbounded preceding and 1 preceding), 0)::bigint as before,
  sha256(whole) as part_key from f where text is not null
""",
)
def k21_bundle_rows(t):
    parts = T.bundle_parts(_turns(t), bundle="conv_id", class_="class", path="path", text="text")
    rows = T.bundle_rows(parts, bundle="conv_id", class_="class", path="path")
    return rows.select("conv_id", F.col("before").cast("long").alias("before"), X.content_hash("part").alias("part_key"))


@query(
    "k22_install_commands",
    """select doc_id, case when n_chars > 2000 then 'npm install ' || source || '|' else '' end || case when lang = 'en' then 'pip install x|yarn add ' || source || '|' when n_chars <= 2000 then 'yarn add ' || source || '|' else '' end
  || '/plugin marketplace add o/' || source || '|/plugin install ' || source as commands, n_chars > 2000 or lang = 'en' as from_section from documents""",
)
def k22_install_commands(t):
    npm = F.concat(F.lit("## Setup\n\n### Step\n- go\n`npm install "), "source", F.lit("`\n## Other\nnpm install no\n"))
    pip = F.lit("# Installation\npip install x\npip install x\n")
    yarn = F.concat(F.lit("```bash\n$ yarn add "), "source", F.lit("\nls\n```\n"))
    text = F.concat(
        "text", F.lit("\n"), F.when(F.col("n_chars") > 2000, npm).otherwise(""), F.when(F.col("lang") == "en", pip).otherwise(""), yarn
    )
    c = T.install_commands(text, repo=F.concat(F.lit("o/"), "source"), name=F.col("source"))
    return t.documents.select("doc_id", c.alias("c")).select("doc_id", F.array_join("c.commands", "|").alias("commands"), "c.from_section")


@query(
    "k23_language_pick",
    r"""select doc_id, case when lang = 'de' then 'reason ' || source when lang = 'fr' then source || '中' else source end as shown,
  case when lang = 'es' then source else '说明' end as zh from documents""",
)
def k23_language_pick(t):
    d = t.documents.withColumns({
        "d": F.when(F.col("lang").isin("de", "fr"), F.concat("source", F.lit("中"))).otherwise(F.col("source")),
        "z": F.when(F.col("lang") != "es", "说明"),
        "r": F.when(F.col("lang") == "de", F.concat(F.lit(" reason "), "source")),
    })
    return d.select("doc_id", X.pick_description("d", "z", "r").alias("shown"), X.pick_description("d", "z", "r", "zh").alias("zh"))


@query(
    "k24_nfc",
    r"select doc_id, sha256(nfc_normalize(replace(text, 'é', 'e' || chr(769)))) as text_key, length(nfc_normalize(replace(text, 'é', 'e' || chr(769)))) as n from documents",
)
def k24_nfc(t):
    apart = F.replace("text", F.lit("é"), F.lit("é"))
    d = t.documents.select("doc_id", T.nfc(apart).alias("s"))
    return d.select("doc_id", X.content_hash("s").alias("text_key"), F.length("s").cast("long").alias("n"))


@query(
    "k25_display",
    """select o_orderkey, case when o_orderpriority = '1-URGENT' and o_orderstatus = 'P' then '—' when o_orderpriority = '1-URGENT' then '🔴 Abandoned' when o_orderpriority = '2-HIGH' then '🟡 Stale'
  when o_orderpriority = '3-MEDIUM' then '🟢 Active' else '—' end as badge, case when o_orderstatus = 'P' then '—' else strftime(o_orderdate, '%Y-%m-%d') end as last_active,
  case o_orderstatus when 'F' then 'Final' else o_orderstatus end as source_label, '`' || o_orderstatus || '`, `' || o_orderpriority || '`, `x`' as tags from orders""",
)
def k25_display(t):
    label = first_rule([(F.col("o_orderpriority") == p, l) for p, l in (("1-URGENT", "abandoned"), ("2-HIGH", "stale"), ("3-MEDIUM", "active"))])
    o = t.orders.withColumns({
        "label": label,
        "at": F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        "tags": F.array("o_orderstatus", "o_orderpriority", F.lit("x"), F.lit("y")),
    })
    return o.select(
        "o_orderkey", X.freshness_badge("label", "at").alias("badge"), X.last_active("at").alias("last_active"),
        X.mapped("o_orderstatus", {"F": "Final"}, F.col("o_orderstatus")).alias("source_label"), X.tag_line("tags").alias("tags"),
    )


@query(
    "k26_accept_result",
    """select event_id, event_type in ('view', 'click') as accepted from events""",
)
def k26_accept_result(t):
    k = F.get_json_object("props", "$.k").cast("int")
    metrics = F.when(
        F.col("event_type").isin("view", "click"), F.create_map(F.lit("a"), k, F.lit("b"), k)
    ).when(F.col("event_type") == "error", F.create_map(F.lit("a"), k))
    return t.events.select("event_id", J.accept_result(metrics, ["a", "b"]).alias("accepted"))


@query(
    "k26_answers_to_scores",
    """
with d as (select doc_id, lang, (1 + 4 * quality) / 5 * 100 as g, (5 - 4 * toxic) / 5 * 100 as s, 1 + 4 * quality as relevance from documents left join labels using (doc_id)),
w(lang, task, wg, ws) as (values ('en', 'skill', 0.85, 0.15), ('de', 'rule', 0.84, 0.16), ('fr', 'prompt', 0.79, 0.21), ('es', 'plugin', 0.85, 0.15))
select doc_id, task, g is not null as accepted, coalesce(round(g * wg + s * ws, 6), -1) as quality, coalesce(relevance, 0) as relevance from d join w using (lang)
""",
)
def k26_answers_to_scores(t):
    """Answers as an evaluator gives them, from the labels; texts without a label have no answer."""
    from ..evaluation import parse_answers

    type_ = first_rule([(F.col("lang") == c, v) for c, v in (("en", "skill"), ("de", "rule"), ("fr", "prompt"), ("es", "plugin"))])
    good, safe = (1 + 4 * F.col("quality")).cast("string"), (5 - 4 * F.col("toxic")).cast("string")
    cells = [
        F.concat(F.lit(f'"{d}": {{"score": '), safe if d == "specificity" else good, F.lit("}")) for d in fixed.DIMENSIONS
    ]
    answer = F.concat(F.lit('My view:\n```json\n{"metrics": {'), F.concat_ws(", ", *cells), F.lit("}}\n```"))
    d = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    asked = d.select("doc_id", type_.alias("type"), F.when(F.col("quality").isNotNull(), answer).otherwise("none").alias("text"))
    parsed = parse_answers(asked, key="doc_id")
    return parsed.select(
        "doc_id", "task", "accepted", F.coalesce(F.round("quality", 6), F.lit(-1.0)).alias("quality"),
        F.coalesce("relevance", F.lit(0)).alias("relevance"),
    )
