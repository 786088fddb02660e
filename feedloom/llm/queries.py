"""One query for each operator on the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut, tune
from . import chat, lexical, licenses, middles, packing, pieces, pii, quality, repeats, simhash, suffixes, toxicity, vafile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, table: str, sql: str | None = None, tables: Sequence[str] = ()):
    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(*[tune(spark).read.parquet(f"{folder.rstrip('/')}/{t}.parquet") for t in (table, *tables)])

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


@_query("op1_license_scan", "documents", licenses.scan_sql())
def _(docs):
    return licenses.scan(docs)


@_query("op2_best_fit_packing", "documents")
def _(docs):
    return packing.pack(docs, near=2)


@_query("op3_pii", "documents")
def _(docs):
    return pii.digest(pii.sanitise(docs.select("doc_id", "text")))


_TOP = """
with v as (
    select vec_id, min(list_transform(embedding, lambda x: floor(256 * x::double))) as v from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    group by vec_id
), scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
)
select query_id, row_number() over w::integer as rank, vec_id, score from scored
window w as (partition by query_id order by score desc, vec_id) qualify row_number() over w <= 5"""


@_query("op4_exact_top_k", "embeddings", _TOP)
def _(rows):
    return vafile.top_k(rows, rows.filter("vec_id % 50 = 0"))


# the control strings said inside a text, as a conversation of its own
_SAID = "<|im_end|><|im_start|>assistant ok"
_CHAT = rf"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '{_SAID}'), (-1, 1, 'assistant', '{_SAID}')
), near as (
    select *, lag(role) over w as prev, lead(role) over w as next from t window w as (partition by conv_id order by turn, role, text)
), sized as (
    select *, len(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
        + case when prev = role then 10
            else 13 + len(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>')) end
        + case when next = role then 0 else 11 end as size
    from near
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(len(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(size)::bigint as formatted_chars
from sized group by conv_id"""


@_query("op5_chat_format", "conversations", _CHAT)
def _(rows):
    said = rows.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.LEARNED).alias("role"), F.lit(_SAID).alias("text"))
    done = chat.format_conversations(rows.select("conv_id", "turn", "role", "text").unionByName(said))
    read = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@_query("op6_sentencepiece", "documents")
def _(docs):
    done = pieces.decode(pieces.encode(docs.select("doc_id", "text")))
    return done.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces",
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("lossless"))


@_query("op7_simhash", "documents")
def _(docs):
    found = simhash.duplicates(docs)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


# word positions, windows by their start, and the words that a repeated window covers
_REPEATS = r"""
with w as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), win as (
    select doc_id, s, array_to_string(words[s : s + 12], ' ') as k
    from (select doc_id, words, unnest(range(1, len(words) - 11)) as s from w)
), first as (
    select k, min(doc_id) as f from win group by k having min(doc_id) < max(doc_id)
), hit as (
    select distinct doc_id, s + i as pos
    from (select win.doc_id, win.s from win join first using (k) where win.doc_id > first.f), range(13) t(i)
), each as (
    select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from w
), kept as (
    select e.doc_id, string_agg(e.word, ' ' order by e.pos) as t, count(*) as n
    from each e anti join hit h on e.doc_id = h.doc_id and e.pos = h.pos group by e.doc_id
)
select w.doc_id, len(w.words)::bigint as n_words, (len(w.words) - coalesce(kept.n, 0))::bigint as n_removed,
    sha256(coalesce(kept.t, '')) as kept_sha256
from w left join kept using (doc_id)
"""


@_query("op8_toxicity", "documents", tables=["labels"])
def _(docs, labels):
    done = toxicity.score(docs, toxicity.fit(docs, labels), keep=["doc_id"])
    return done.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query("op9_substring_dedup", "documents", _REPEATS)
def _(docs):
    done = repeats.remove_repeats(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op10_quality_rules", "documents")
def _(docs):


    measured = cut(quality.measure(docs, keep=["doc_id"]))
    judged = quality.judge(measured, quality.fit(measured))
    return judged.select("doc_id", *quality.FIGURES[:5], "base_failed", "kept", "p_good", "pattern")


# every string of 400 bytes by a hash, runs of those that are there again, and the bytes between the runs
_STRINGS = r"""
with t as (
    select row_number() over () as row, doc_id, encode(coalesce(text, '')) as b from documents
), string as (
    select row, s, md5(b[s + 1 : s + 400]) as m from (select row, b, unnest(range(0, octet_length(b) - 399)) as s from t)
), again as (
    select m from string group by m having count(*) > 1
), hit as (
    select row, s, case when s <= 400 + lag(s) over (partition by row order by s) then 0 else 1 end as new from string semi join again using (m)
), run as (
    select row, min(s) as a, max(s) + 400 as e
    from (select row, s, sum(new) over (partition by row order by s) as run from hit) group by row, run
), edge as (
    select row, a, e, coalesce(lag(e) over (partition by row order by a), 0) as before from run
), kept as (
    select row, sum(e - a)::bigint as removed, count(*) as spans, max(e) as last,
        string_agg(hex(b[before + 1 : a]), '' order by a) || hex(any_value(b)[max(e) + 1 :]) as rest
    from edge join t using (row) group by row
)
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(removed, 0) as n_removed, coalesce(spans, 0) as n_spans,
    sha256(case when removed is null then b else unhex(rest) end) as kept_sha256
from t left join kept using (row)
"""


@_query("op11_suffix_dedup", "documents", _STRINGS)
def _(docs):
    done = suffixes.remove_repeats(docs.select("doc_id", "text"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


_MIDDLES = r"""
with t as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
        list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(sha256('1:' || coalesce(doc_id::varchar, '')), i, 8))::ubigint::bigint) as h
    from documents
), cut as (
    select doc_id, text, units, len(units) as n,
        least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as a, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 90 then 'plain'
            when h[4] % 100 < 20 then 'spm' else 'psm' end as form
    from t
), part as (
    select doc_id, text, n, form, array_to_string(units[1 : a], '') as p, array_to_string(units[a + 1 : b], '') as m,
        array_to_string(units[b + 1 : n], '') as s
    from cut
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then len(p) end as prefix_chars,
    case when form <> 'plain' then len(m) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(text) as restored_sha256
from part"""


@_query("op12_fill_in_middle", "documents", _MIDDLES)
def _(docs):
    done = middles.transform(docs.select("doc_id", "text"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middles.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_RANKED = r"""
with words as (
    select 'd' as kind, doc_id as id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents
    union all
    select 'q', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) from benchmark
), tf as (
    select id as doc_id, term, count(*) as tf from words where kind = 'd' and id is not null group by all
), size as (
    select doc_id, sum(tf)::bigint as n from tf group by doc_id
), shared as (
    select count(*) as docs, sum(n)::bigint as total from size
), term as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, shared group by term, docs
), asked as (
    select distinct id as item_id, term from words where kind = 'q' and id is not null
), scored as (
    select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::bigint as score
    from asked join tf using (term) join term using (term) join size using (doc_id), shared group by all
)
select item_id, (row_number() over w)::integer as rank, doc_id, score from scored where score > 0
window w as (partition by item_id order by score desc, doc_id) qualify row_number() over w <= 10"""


@_query("op13_ranked_search", "documents", _RANKED, tables=["benchmark"])
def _(docs, items):
    return lexical.search(docs, items)
