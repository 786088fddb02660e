import re

import pytest
from hypothesis import given, settings, strategies as st

from feedloom.llm import pii


def plain(text):
    out = []
    for kind, pattern in pii.PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a@.-1 290+(é_\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "x 4111-1111-1111-1111.", "+49 (30) 1234567", "10.0.0.256 10.0.0.25.1", "a@b.c@d.e"])
def test_base_spans_of_examples(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "(" * 200_000])
def test_long_runs_take_no_long_time(text):
    pii.base_spans(text)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, id string, spans string, entity int")


def test_terms_beside_an_entity_are_masked(spark):
    filler = [(100 + i, f"plain words in line {'abcdefghij'[i % 10]}\nand more of the same words", "x", None, 1) for i in range(60)]
    told = [(i, f"Write to Zoltan at zo@mail.org please\nother words by Zoltan", "x", None, 1) for i in range(3)]
    odd = [(50, None, "x", None, 1), (51, "", "x", None, 1), (None, "write zo@mail.org", "x", None, 1), (0, told[0][1], "x", None, 1)]
    got = {}
    for r in pii.sanitise(frame(spark, filler + told + odd)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all(len(got[100 + i]) == 1 and got[100 + i][0].clean == filler[i][1] and got[100 + i][0].spans == [] for i in range(60))
    assert len(got[0]) == 2 and got[0][0] == got[0][1]
    masked = got[1][0]
    assert "Zoltan" not in masked.clean and "[EMAIL]" in masked.clean and "other words" in masked.clean
    assert [s.kind for s in masked.spans][:1] == ["email"] and masked.id == "x" and masked.entity == 1
    assert got[50][0].clean is None and got[51][0].clean == "" and got[None][0].clean == "write [EMAIL]"


def test_terms_on_few_lines_of_an_entity_are_masked(spark):
    # a shared address: each name stands only beside it, on 4 of its 40 lines; in document 1 another also stands on another line
    names = ["Zoltan", "Mirabel", "Quentin", "Ottoline", "Peregrine", "Xanthe", "Isolde", "Leopold", "Fenella", "Dagmar"]
    told = [(i, f"{names[i % 10]} at zo@mail.org" + "\n\nZoltan again" * (i == 1), "x", None, 1) for i in range(40)]
    filler = [(100 + i, "we meet at noon\nand go again", "x", None, 1) for i in range(60)]
    got = {r.doc_id: r for r in pii.sanitise(frame(spark, told + filler)).collect()}
    for i in range(40):
        assert names[i % 10] not in got[i].clean and "[EMAIL]" in got[i].clean
    assert "Zoltan" not in got[1].clean and "again" in got[1].clean
    assert all(got[100 + i].clean == filler[i][1] for i in range(60))


def test_counts_equal_a_plain_count(spark):
    import collections

    texts = ["One two, two\nthree é (one) b\n\n", None, "", "two ONE.", "   \n"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.key: r.n for r in docs.mapInArrow(pii._counted, "key long, n long").groupBy("key").sum("n").toDF("key", "n").collect()}
    lines, want = 0, collections.Counter()
    for t in texts:
        for line in (t or "").split("\n"):
            if line.strip():
                lines += 1
                want.update({w for w, _, _ in pii.terms(line, 0, len(line), [])})
    words = sorted(want)
    assert pii._lines(docs).first().n == lines
    assert got == dict(zip(pii.term_key(words).tolist(), (want[w] for w in words)))


def test_empty_table(spark):
    assert pii.digest(pii.sanitise(frame(spark, []))).count() == 0
