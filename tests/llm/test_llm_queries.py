"""The queries against their SQL, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from feedloom.llm import queries, simhash
from oracle_check import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, FOLDER)
    if name in queries.ORACLES:
        assert compare(df, con, queries.ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_operator_has_its_query():
    assert sorted(int(n.split("_")[0].removeprefix("op")) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, FOLDER).cache()
        kept.append((name, before, after))
        before = after
    for name, b, a in kept[:-1]:
        assert a.columns == docs.columns and a.dtypes == docs.dtypes, name
    rows = {name: ({r.doc_id: r.text for r in b.collect()}, {r.doc_id: r.text for r in a.collect()}) for name, b, a in kept[:-1]}
    b, a = rows["quality rules"]
    assert set(a) < set(b) and all(a[i] == b[i] for i in a)
    assert not any((q := brute.quality(t))[0] < 50 or 100 * q[4] > 50 * q[0] for t in a.values())
    b, a = rows["near duplicates"]
    group = brute.groups([(i, brute.simhash(t)) for i, t in b.items()])
    assert set(a) == set(group.values())
    b, a = rows["repeated passages"]
    cut = brute.gone_words(list(b.items()))
    assert a == {i: brute.rest(b[i], gone) if gone else b[i] for i, gone in cut.items()}
    b, a = rows["personal data"]
    from feedloom.llm import pii

    assert all((a[i] == b[i]) == (not pii.base_spans(b[i])) for i in b)
    _, before, packed = kept[-1]
    words = {r.doc_id: len(brute.WORD.findall(r.text or "")) for r in before.collect()}
    assert {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()} == words
    text = {r.doc_id: r.text or "" for r in before.collect()}
    for r in packed.collect():
        assert brute.WORD.findall(r.words) == brute.WORD.findall(text[r.doc_id])[r.first_word : r.first_word + r.n_words]
        assert r.words in text[r.doc_id]
    bins = {}
    for r in packed.collect():
        bins.setdefault(r.bin_id, []).append(r)
    for held in bins.values():
        assert sorted(r.slot for r in held) == list(range(len(held))) and sum(r.n_words for r in held) <= 2048
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.exceptAll(packed).count() == 0 and packed.exceptAll(whole).count() == 0


def test_pipeline_with_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    odd = spark.createDataFrame([(None, None), (None, docs.first().text), (5, None), (7, "")], "doc_id long, text string")
    odd = odd.select(*[F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in names])
    more = docs.unionByName(docs.limit(20)).unionByName(odd)
    for c in ("row", "tag", "id", "kept", "rest", "pattern", "fingerprint", "clean", "words", "k0"):
        more = more.withColumn(c, F.lit(1))
    for rows, at_least in ((more, 1), (more.limit(0), 0)):
        before = rows
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, before, FOLDER).cache()
            if name != "packing":
                assert after.columns == more.columns, name
            assert after.count() >= at_least, name
            before = after
        rows.write.parquet(folder := f"{tmp_path}/{at_least}/documents.parquet")
        assert corpus_pipeline.run(spark, folder.rsplit("/", 1)[0]).count() == before.count()
