"""Keyword search, recommendation, gate, rerank and ranked full-text retrieval."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

from ..functions.values import col, let
from ..session import cut
from .relational import skew_join, top_per_key, with_position

TOKEN = r"[\p{L}\p{N}]+"


def _sum(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def hit_count(text: Column, words: Sequence[str]) -> Column:
    """How many different words are part of the lower-case text."""
    return _sum([text.contains(w).cast("int") for w in dict.fromkeys(w.lower() for w in words)])


def result_order(
    hits: str = "hits", label: str | None = "freshness_label", score: str | None = "final_score",
    stars: str | None = "stars", order: str = "_ord",
) -> list[Column]:
    """Most hits, not abandoned, best score, most stars, input order."""
    out = [F.col(hits).desc()]
    if label:
        out.append((F.coalesce(F.col(label), F.lit("")) != "abandoned").desc())
    if score:
        out.append(F.coalesce(F.col(score), F.lit(0)).desc())
    if stars:
        out.append(F.coalesce(F.col(stars), F.lit(0)).desc())
    return [*out, F.col(order).asc()]


def keyword_search(
    df: DataFrame, words: Sequence[str], order: Sequence[Column], *, text: str = "search_text",
    fields: Sequence[str] = (), type_: str = "type", type_filter: str | None = None, limit: int = 30,
) -> DataFrame:
    """Best rows with at least one of the words; ``fields`` stand in where the search text is missing."""
    if type_filter is not None:
        df = df.filter(F.col(type_) == type_filter)
    fallback = F.concat_ws(" ", *fields) if fields else F.lit("")
    low = F.lower(F.coalesce(F.col(text), fallback))
    found = df.withColumn("hits", let(low, lambda t: hit_count(t, words))).filter("hits > 0")
    return found.orderBy(*order).limit(limit)


def keyword_search_many(
    df: DataFrame, queries: Mapping[str, Sequence[str]], order: Sequence[Column], *, text: str = "search_text", limit: int = 30
) -> DataFrame:
    """``keyword_search`` for several queries in one scan; rows leave it only for queries they hit."""
    def per_query(t: Column) -> Column:
        cells = [F.struct(F.lit(q).alias("query"), hit_count(t, words).alias("hits")) for q, words in queries.items()]
        return F.filter(F.array(*cells), lambda s: s["hits"] > 0)

    flat = df.withColumn("_q", F.explode(let(F.lower(F.col(text)), per_query))).select("*", "_q.*")
    return top_per_key(flat.drop("_q"), ["query"], order, limit, "rank")


def recommend(
    df: DataFrame, project_tags: Sequence[str], order: Sequence[Column], *, lists: Sequence[str] = ("tags", "tech_stack"),
    type_: str = "type", type_filter: str | None = None, limit: int = 15,
) -> DataFrame:
    """Best rows by how many project tags are among their lists."""
    if type_filter is not None:
        df = df.filter(F.col(type_) == type_filter)
    none = F.array().cast("array<string>")
    own = F.transform(F.concat(*[F.coalesce(F.col(c), none) for c in lists]), F.lower)
    wanted = F.array(*[F.lit(t.lower()) for t in dict.fromkeys(project_tags)])
    found = df.withColumn("hits", F.size(F.array_intersect(wanted, own))).filter("hits > 0")
    return found.orderBy(*order).limit(limit)


def gate(hits: Column | str, score: Column | str, label: Column | str, at_least: float = 70) -> Column:
    """``top`` for well scored, living rows with a hit, else ``other``."""
    ok = (F.coalesce(col(score), F.lit(0)) >= at_least) & (F.coalesce(col(label), F.lit("")) != "abandoned") & (col(hits) >= 1)
    return F.when(ok, "top").otherwise("other")


def rationale(highlights: Column | str, description: Column | str) -> Column:
    h = col(highlights)
    return F.when(F.size(h) > 0, F.array_join(F.slice(h, 1, 2), "; ")).otherwise(F.coalesce(col(description), F.lit("")))


def query_tokens(query: str) -> list[str]:
    """Different tokens of two letters or more; the whole query when there is none."""
    low = query.lower().strip()
    tokens = [t for t in re.findall(r"[^\W_]+", low) if len(t) >= 2]
    return list(dict.fromkeys(tokens)) or ([low] if low else [])


def rerank_score(query: str, base: Column, *, name: Column, description: Column, meta: Column, search: Column) -> Column:
    """Base score plus bonuses for the phrase, covered tokens and the longest token.

    Inputs are lower-case texts. Rows hit only through the expanded search text lose points.
    """
    phrase, tokens = query.lower().strip(), query_tokens(query)
    cover = lambda t: _sum([t.contains(w).cast("int") for w in tokens])
    n, d, m, s = cover(name), cover(description), cover(meta), cover(search)
    plus = lambda cond, points: F.when(cond, float(points)).otherwise(0.0)
    score = base
    for text, points in ((name, 140), (description, 90), (meta, 50)):
        score = score + plus(text.contains(phrase), points)
    score = score + n * 36 + d * 20 + m * 12 + s * 4
    if len(tokens) > 1:
        for covered, points in ((n, 80), (d, 50), (m, 25), (s, 10)):
            score = score + plus(covered == len(tokens), points)
        anchor = max(tokens, key=len)  # the first of the longest
        direct = name.contains(anchor) | description.contains(anchor) | meta.contains(anchor)
        score = score + F.when(direct, 24.0).when(search.contains(anchor), -12.0).otherwise(-28.0)
    return score + F.when((F.greatest(n, d, m) == 0) & (s > 0), -40.0).otherwise(0.0)


# --- ranked full-text retrieval ---------------------------------------------------------------------

PREFIX_WEIGHT, FUZZY_WEIGHT, FUZZY = 0.375, 0.45, 0.2
K1, B = 1.2, 0.7


def edits_of(length: int, fuzzy: float = FUZZY) -> int:
    """How many edits a word of this length may be away."""
    return int(length * fuzzy + 0.5)


def term_weight(term: Column, word: str, fuzzy: float = FUZZY) -> Column:
    """1 for the word itself, less for a longer term that begins with it or a term a few edits away, the less the further
    away it is; else 0."""
    edits, n = edits_of(len(word), fuzzy), F.length(term).cast("double")
    out = F.when(term == word, 1.0).when(term.startswith(word), PREFIX_WEIGHT * n / (n + 0.3 * (n - len(word))))
    if edits:
        away = F.levenshtein(term, F.lit(word), edits)
        out = out.when(F.abs(F.length(term) - len(word)).between(0, edits) & (away >= 0), FUZZY_WEIGHT * n / (n + away))
    return out.otherwise(0.0)


def _by_field(values: Mapping[str, Column | float]) -> Column:
    """The value of the row's own field."""
    names = list(values)
    out = F.when(F.col("field") == names[0], values[names[0]])
    return reduce(lambda acc, f: acc.when(F.col("field") == f, values[f]), names[1:], out)


def _tokens(df: DataFrame, fields: Sequence[str], *keep: str) -> DataFrame:
    texts = [F.regexp_extract_all(F.lower(F.coalesce(F.col(f), F.lit(""))), F.lit(TOKEN), 0).alias(f) for f in fields]
    return df.select(*keep, *texts)


def _stats(tokens: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: the number of rows, and the mean length of every field."""
    return tokens.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.size(f)).alias(f"mean_{f}") for f in fields])


def _rank(hits: DataFrame, stats: Column, boosts: Mapping[str, float], key: str, limit: int) -> DataFrame:
    """Boosted BM25 over (key, field, len, tf, df, weight)."""
    total, mean = stats["n"], _by_field({f: stats[f"mean_{f}"] for f in boosts})
    idf = F.log(1.0 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    score = F.col("weight") * _by_field({f: float(b) for f, b in boosts.items()}) * idf * norm
    return hits.groupBy(key).agg(F.sum(score).alias("score")).orderBy(F.desc("score"), key).limit(limit)


def _weight(query: str, fuzzy: float) -> Column:
    return _sum([term_weight(F.col("term"), w, fuzzy) for w in query_tokens(query)])


def full_text(
    df: DataFrame, query: str, boosts: Mapping[str, float], *, key: str = "id", limit: int = 200, fuzzy: float = FUZZY
) -> DataFrame:
    """(key, score): best rows by boosted BM25 over several fields, with prefix and fuzzy terms.

    For a single question to a table without an index: it reads the texts. Tokens are tested where
    they are read, so the shuffles carry hits and not texts. The row count and mean lengths come from
    one aggregate, used as a scalar subquery.
    """
    fields = list(boosts)
    weight = _weight(query, fuzzy)
    tokens = _tokens(df, fields, key)
    # one more token that is null for each field of a row, so that one pass gives lengths and hits
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.size(f).alias("len"), F.concat(F.array(F.lit(None).cast("string")), F.col(f)).alias("terms")) for f in fields])
    found = tokens.select(key, F.inline(cells)).select(key, "field", "len", F.explode("terms").alias("term"))
    found = cut(found.filter(F.col("term").isNull() | (weight > 0)))
    of = lambda f, c: F.when(F.col("field") == f, c)
    stats = found.filter("term is null").agg(F.count(of(fields[0], F.lit(1))).alias("n"), *[F.avg(of(f, F.col("len"))).alias(f"mean_{f}") for f in fields])
    tf = cut(found.filter("term is not null").groupBy(key, "field", "len", "term").agg(F.count(F.lit(1)).alias("tf")))
    per_term = tf.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    hits = skew_join(tf, per_term, ["field", "term"], "inner", spread=[key]).withColumn("weight", weight)
    return _rank(hits, stats.select(F.struct("*")).scalar(), boosts, key, limit)


def search_page(
    df: DataFrame, query: str, boosts: Mapping[str, float], *, key: str = "id", name: str, description: str, meta: str, search: str,
    limit: int = 200, fuzzy: float = FUZZY,
) -> DataFrame:
    """(key, score): the ``limit`` best rows by full text, put in the order of ``rerank_score`` with the text score as base.

    The texts of the rows found are met by their keys, of which there are at most ``limit``.
    """
    found = F.broadcast(full_text(df, query, boosts, key=key, limit=limit, fuzzy=fuzzy).withColumnRenamed("score", "_base"))
    texts = [F.lower(F.col(c)) for c in (name, description, meta, search)]
    score = rerank_score(query, F.col("_base"), name=texts[0], description=texts[1], meta=texts[2], search=texts[3])
    return df.join(found, key).select(key, score.alias("score")).orderBy(F.desc("score"), key)


_COUNTS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]))


@F.arrow_udf(_COUNTS)
def _counted(rows: pa.Array) -> pa.Array:
    """The different terms of each row, sorted, with how often they occur."""
    tokens = rows.flatten().dictionary_encode()
    order = pc.sort_indices(tokens.dictionary).to_numpy()
    size = max(len(order), 1)
    place = np.empty(size, np.int64)
    place[order] = np.arange(len(order))
    row_of = np.repeat(np.arange(len(rows)), pc.list_value_length(rows).to_numpy())
    cells, tf = np.unique(row_of * size + place[tokens.indices.to_numpy()], return_counts=True)
    offsets = np.searchsorted(cells, np.arange(len(rows) + 1) * size)
    terms = tokens.dictionary.take(pa.array(order[cells % size]))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([terms, pa.array(tf, pa.int64())], ["term", "tf"]))


# Tokens of the rows that a task is meant to take apart; it takes twice as many at once at most, and those of a block.
TASK_TOKENS = 1_500_000
# Rows of a key that may go to one task as texts; the postings of a more frequent one are spread.
MOST_OF_KEY = 1000


def _block(key: str, rows: Column, block_rows: int) -> Column:
    """The block of a row: so many that ``block_rows`` rows fall into each."""
    return F.pmod(F.xxhash64(key), F.greatest(F.ceil(rows / block_rows), F.lit(1)))


def _impact(tf, len_, mean):
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * len_ / mean))


def _posted(rows: pa.Table, fields: Sequence[str], means: Sequence[float]) -> pa.Table:
    """Postings of whole blocks, given as (key, block, tokens of each field) in the order of the blocks; see ``build_index``.

    Rows of one key add up where their field is as long, as if they were grouped by key, field, length and term.
    """
    n, columns = len(rows), [rows.column(f).combine_chunks() for f in fields]
    spots = n * len(fields)  # a spot is a field of a row, fields first
    lens = np.concatenate([pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in columns])
    tokens = pa.chunked_array([c.flatten() for c in columns]).combine_chunks().dictionary_encode()
    order = pc.sort_indices(tokens.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    keys = rows.column(0).combine_chunks().dictionary_encode(null_encoding="encode")
    same = np.arange(spots)
    if len(keys.dictionary) < n:
        owner = same // n * len(keys.dictionary) + np.tile(keys.indices.to_numpy(), len(fields))
        _, first, nth = np.unique(owner * (lens.max() + 1) + lens, return_index=True, return_inverse=True)
        same = first[nth]
    cells, tf = np.unique(place[tokens.indices.to_numpy()] * spots + same.repeat(lens), return_counts=True)
    spot = cells % spots
    field, row, len_ = spot // n, spot % n, lens[spot]
    block = rows.column("block").to_numpy()[row]
    impact = _impact(tf, len_, np.array(means)[field])
    starts = np.flatnonzero((np.diff(cells // n, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    sizes = np.diff(starts, append=len(cells))
    lead = np.zeros(len(cells), bool)
    if len(cells):
        top = np.flatnonzero(impact == np.maximum.reduceat(impact, starts).repeat(sizes))
        bound = np.arange(len(starts)).repeat(sizes)[top]
        lead[top[np.diff(bound, prepend=-1) != 0]] = True
    return pa.table({
        rows.column_names[0]: rows.column(0).combine_chunks().take(pa.array(row)),
        "block": block,
        "lead": lead,
        "field": pa.array(fields, pa.string()).take(pa.array(field)),
        "len": len_.astype(np.int32),
        "term": tokens.dictionary.take(pa.array(order[cells // spots])),
        "tf": tf.astype(np.int64),
    })


def _runs(rows: pa.Table, sizes: np.ndarray) -> list[pa.Table]:
    """Rows in the order of their blocks, cut between blocks where ``sizes`` add up to much, and before the last block."""
    block = rows.column("block").to_numpy()
    starts = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
    before = (np.cumsum(sizes) - sizes)[starts] // (2 * TASK_TOKENS)
    edges = np.unique([0, *starts[np.diff(before, prepend=0) != 0], starts[-1], len(rows)])
    return [rows.slice(x, y - x) for x, y in pairwise(edges.tolist())]


def _dealt_postings(df: DataFrame, fields: Sequence[str], key: str, block_rows: int, said: Row) -> DataFrame:
    """Postings of rows that are dealt to their blocks before their tokens are counted."""
    means = [said[f"mean_{f}"] or 1.0 for f in fields]
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, int(said["n"] * sum(means) / TASK_TOKENS))
    dealt = df.withColumn("block", _block(key, F.lit(said["n"]), block_rows)).repartition(parts, "block").sortWithinPartitions("block")

    def posted(batches):
        sizes = lambda rows: sum(pc.list_value_length(rows.column(f)).to_numpy() for f in fields) + 1
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += int(sizes(pa.Table.from_batches([batch])).sum())
            if size >= 2 * TASK_TOKENS:
                rows = pa.Table.from_batches(held)
                *whole, last = _runs(rows, sizes(rows))  # of the last block more rows may come
                for run in whole:
                    yield from _posted(run, fields, means).to_batches(max_chunksize=20_000)
                held, size = last.to_batches(), int(sizes(last).sum())
        if size:
            yield from _posted(pa.Table.from_batches(held), fields, means).to_batches(max_chunksize=20_000)

    kinds = {key: df.schema[key].dataType, "block": T.LongType(), "lead": T.BooleanType(), "field": T.StringType(), "len": T.IntegerType(), "term": T.StringType(), "tf": T.LongType()}
    return _tokens(dealt, fields, key, "block").mapInArrow(posted, T.StructType([T.StructField(c, k) for c, k in kinds.items()]))


def build_index(
    df: DataFrame, fields: Sequence[str], *, key: str = "id", block_rows: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, vocabulary, statistics) for ``search_index``; built once and written as tables.

    Postings are (term, field, key, tf, len), vocabulary is (field, term, df). The tokens of a row are
    counted where it is read; postings are shuffled only where a key is that of several rows, whose counts are added up.

    With ``block_rows``, and unless a key is that of very many rows, texts are dealt to the blocks of ``block_index`` and postings
    are not shuffled: they come in the order in which ``write_blocks`` stores them, have ``block``, and ``lead`` marks one of the
    greatest impact of each (term, field, block).
    """
    tokens = _tokens(df, fields, key)
    stats = cut(_stats(tokens, fields)) if block_rows else _stats(tokens, fields)
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if block_rows and keys.filter(F.col("_n") > MOST_OF_KEY).isEmpty():
        postings = _dealt_postings(df, fields, key, block_rows, stats.first())
    else:
        cells = F.array(*[F.struct(F.lit(f).alias("field"), F.size(f).alias("len"), F.col(f"_{f}").alias("counts")) for f in fields])
        counted = tokens.withColumns({f"_{f}": _counted(f) for f in fields}).select(key, F.inline(cells))
        postings = counted.select(key, "field", "len", F.inline("counts"))
        if not keys.filter("_n > 1").isEmpty():
            postings = postings.groupBy(key, "field", "len", "term").agg(F.sum("tf").alias("tf"))
    vocabulary = postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    return postings, vocabulary, stats


def write_postings(postings: DataFrame, path: str, *, key: str = "id") -> None:
    """Sorted by term, so a query reads only the row groups of its terms; a frequent term fills many files."""
    postings.repartitionByRange("term", key).sortWithinPartitions("term", key).write.mode("overwrite").parquet(path)


# Terms of a query that are sent to every task, some 10 MB; counted before.
MOST_SENT = 100_000


def _of_terms(postings: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Postings with the columns of their term; they stay where they lie unless the query means very many terms."""
    if terms.count() <= MOST_SENT:
        return postings.join(F.broadcast(terms), ["field", "term"])
    return skew_join(postings, terms, ["field", "term"], "inner", spread=[key])


def search_index(
    postings: DataFrame, vocabulary: DataFrame, stats: DataFrame, query: str, boosts: Mapping[str, float], *, key: str = "id",
    limit: int = 200, fuzzy: float = FUZZY,
) -> DataFrame:
    """As ``full_text``, from an index: terms are matched in the vocabulary, and only their postings are read."""
    weight = _weight(query, fuzzy)
    terms = cut(vocabulary.withColumn("weight", weight).filter(F.col("weight") > 0))
    hits = _of_terms(postings.filter(F.col("field").isin(*boosts)), terms, key)
    return _rank(hits, stats.select(F.struct("*")).scalar(), boosts, key, limit)


# --- an index that is not read as a whole ---------------------------------------------------------


def _reach(length: int, fuzzy: float) -> int:
    """The most edits that a word may be away from a term of this length."""
    words = range(length, int((length + 2) / (1 - min(fuzzy, 0.9))) + 2)
    return max([edits_of(n, fuzzy) for n in words if n - edits_of(n, fuzzy) <= length], default=0)


def _parts(length: int, fuzzy: float) -> list[tuple[int, int]]:
    """Where terms of this length are cut: in one part more than a word may be edits away."""
    n = _reach(length, fuzzy) + 1
    return list(pairwise(i * length // n for i in range(n + 1)))


def variants_of(term: str, fuzzy: float = FUZZY) -> list[str]:
    """What a word must share one of with the term to be near it: its parts, each with its place and the term's length.

    An edit changes one part at most, so one of them stands unchanged in a word that is near, as many letters further left or
    right at most as there are edits.
    """
    return sorted({f"{len(term)}/{x}/{term[x:y]}" for x, y in _parts(len(term), fuzzy)})


def spellings(word: str, fuzzy: float = FUZZY) -> set[str]:
    """The variants under which terms near a word are found."""
    most, n = edits_of(len(word), fuzzy), len(word)
    if not most:
        return set()
    return {
        f"{length}/{x}/{word[at : at + y - x]}"
        for length in range(max(n - most, 0), n + most + 1)
        for x, y in _parts(length, fuzzy)
        for at in range(max(x - most, 0), min(x + most, n - (y - x)) + 1)
    }


def neighbour_table(vocabulary: DataFrame, fuzzy: float = FUZZY) -> DataFrame:
    """(variant, term): every distinct term under all its ``variants_of``, so a word finds its neighbours by equality."""

    @F.arrow_udf("array<string>")
    def variants(terms: pa.Array) -> pa.Array:
        return pa.array([variants_of(t, fuzzy) for t in terms.to_pylist()], pa.list_(pa.string()))

    terms = vocabulary.select("term").distinct()
    return terms.select(F.explode(variants("term")).alias("variant"), "term")


def match_terms(vocabulary: DataFrame, neighbours: DataFrame, query: str, fuzzy: float = FUZZY) -> DataFrame:
    """``vocabulary`` rows of the terms that a query means, with ``weight``; edit distances only of terms that share a variant."""
    words = query_tokens(query)
    spelt = sorted({v for w in words for v in spellings(w, fuzzy)})
    begins = reduce(lambda a, b: a | b, [F.col("term").startswith(w) for w in words], F.lit(False))
    weight = _weight(query, fuzzy)
    found = vocabulary.filter(begins)
    if spelt:
        # terms that begin with a word are there already
        near = cut(neighbours.filter(F.col("variant").isin(spelt) & ~begins).select("term").distinct().filter(weight > 0))
        if near.count() <= MOST_SENT:
            near = F.broadcast(near)
        found = found.unionByName(vocabulary.join(near, "term", "left_semi").select(*found.columns))
    return found.withColumn("weight", weight)


def block_index(postings: DataFrame, stats: DataFrame, fields: Sequence[str], *, key: str = "id", block_rows: int = 128) -> tuple[DataFrame, DataFrame]:
    """(postings with ``block`` and ``impact``, bounds): rows are dealt to blocks by a hash of the key, if ``build_index`` has not
    done so, ``impact`` is a posting's score before weights, and ``bounds`` has the greatest impact of each (term, field, block)."""
    said = stats.select(F.struct("*")).scalar()
    mean = _by_field({f: said[f"mean_{f}"] for f in fields})
    impact = _impact(F.col("tf"), F.col("len"), mean)
    if "block" not in postings.columns:
        postings = postings.withColumn("block", _block(key, said["n"], block_rows))
    rows = postings.withColumn("impact", impact)
    if "lead" in rows.columns:
        return rows, rows.filter("lead").select("term", "field", "block", F.col("impact").alias("most"))
    return rows, rows.groupBy("term", "field", "block").agg(F.max("impact").alias("most"))


def write_blocks(rows: DataFrame, path: str) -> None:
    """Rows of ``block_index``, each file sorted by term, field and block. One row of each bound holds it as ``most``.

    Rows that ``build_index`` has dealt to their blocks are written as they come, others by one shuffle. A file of very many
    postings can have more than one sorted run, each of whole blocks.
    """
    if "lead" in rows.columns:
        lead = F.col("lead")
    else:
        lead = F.row_number().over(Window.partitionBy("term", "field", "block").orderBy(F.desc("impact"))) == 1
    rows.withColumn("most", F.when(lead, F.col("impact"))).drop("lead").write.mode("overwrite").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(postings, bounds) that ``write_blocks`` wrote."""
    stored = spark.read.parquet(path)
    return stored.drop("most"), stored.filter("most is not null").select("term", "field", "block", "most")


def search_blocks(
    postings: DataFrame, bounds: DataFrame, vocabulary: DataFrame, neighbours: DataFrame, stats: DataFrame, query: str,
    boosts: Mapping[str, float], *, key: str = "id", limit: int = 200, fuzzy: float = FUZZY, first: int = 64,
) -> tuple[DataFrame, int]:
    """(the ``limit`` best rows as of ``search_index``, how many blocks were read).

    Blocks are read in the order of the score that a row of them could have at most, twice as many in each round, until no
    unread block can reach the last of the best so far. The postings of the terms are taken out of the index once, not in each round.
    """
    total = stats.select("n").scalar()
    idf = F.log(1.0 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = match_terms(vocabulary.filter(F.col("field").isin(*boosts)), neighbours, query, fuzzy)
    terms = cut(terms.select("field", "term", (F.col("weight") * _by_field({f: float(b) for f, b in boosts.items()}) * idf).alias("worth")))
    reach = _of_terms(bounds, terms, "block").groupBy("block").agg((F.sum(F.col("worth") * F.col("most")) * (1 + 1e-9)).alias("reach"))
    blocks = cut(with_position(reach, [F.desc("reach"), F.asc("block")], "place"))
    n, read, least, best = blocks.count(), 0, float("-inf"), None
    matched = cut(_of_terms(postings, terms, key).select(key, "block", "worth", "impact"))
    while read < n:
        upto = read + max(first, read)
        some = blocks.filter((F.col("place") >= read) & (F.col("place") < upto) & (F.col("reach") >= least))
        hits = matched.join(some.select("block"), "block", "left_semi")
        scored = hits.groupBy(key).agg(F.sum(F.col("worth") * F.col("impact")).alias("score"))
        if best is not None:
            scored = scored.unionByName(best)
        best = cut(scored.orderBy(F.desc("score"), key).limit(limit))
        read = min(upto, n)
        kept, low = best.agg(F.count(F.lit(1)), F.min("score")).first()
        least = low if kept == limit else least
        if blocks.filter((F.col("place") >= read) & (F.col("reach") >= least)).isEmpty():
            break
    if best is None:
        return postings.sparkSession.createDataFrame([], postings.select(key).schema.add("score", "double")), 0
    return best.orderBy(F.desc("score"), key), read
