"""Every query against its SQL on the smallest tables, and the shape of the register."""

import pytest

import __spark_entry__ as entry
from feedloom.plans.registry import QUERIES
from oracle_check import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "rank", "doc_id", "score", "decision"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


SALTED = [
    "a18_layouts", "a24_with_file", "b1_drop_listed_urls", "b8_open_sources", "c1_overlay_curated", "c5_first_seen", "c6_resolve_members", "c10_cache_split", "c12_reuse_or_evaluate",
    "c14_verify_membership", "c16_merge_incumbent", "c19_fan_out_text", "c21_containment_match", "c22_match_either", "c25_flag_existing",
    "d8_greedy_dedup", "e8_repo_counts", "f11_star_weight", "j5_full_text", "j5_search_index", "k20_evaluation_input", "n1_failure_ledger",
]


@pytest.mark.parametrize("name", SALTED)
def test_query_with_salted_joins(shuffled, con, monkeypatch, name):
    """The same results when nothing is broadcast and every key of 20 rows or more is split."""
    import inspect

    from feedloom.operators import content, linkage, overlay, relational, scoring, search, state
    from feedloom.sources import tree

    monkeypatch.setattr(relational.hot_keys, "__defaults__", (20,))
    for module in (content, linkage, overlay, relational, scoring, search, state, tree):
        for _, fn in inspect.getmembers(module, inspect.isfunction):
            if "min_rows" in (fn.__kwdefaults__ or {}):
                monkeypatch.setitem(fn.__kwdefaults__, "min_rows", 20)
    assert compare(entry.queries()[name](shuffled, FOLDER), con, entry.oracle_sql()[name]) is None
