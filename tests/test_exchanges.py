"""Texts are dealt to their documents once, whatever is made of them."""

import json
import re

import pytest

from quire.operators import paragraphs
from quire.plans import queries as Q
from quire.sources import fixtures as X
from quire.streaming import articles

SF = "/root/testdata/sf0.001"


def dealt(df):
    """Exchanges by key of the plan that ran; what is used again counts once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"^[ :|+-]*Exchange hashpartitioning", plan, re.M))


@pytest.mark.parametrize("name, most", [("article_markdown", 4), ("note_islands", 3), ("note_pairing", 3), ("quote_merge_a", 1)])
def test_lines_are_dealt_once(spark, name, most):
    """Beside lines there are the numbers of references, dealt by line and by document."""
    assert dealt(Q.QUERIES[name](spark, SF)) <= most


def test_counted_references_same_as_of_lines(spark):
    rows = [(d, p, n, k, t) for d in (1, 2) for p in range(3) for n in range(3) for k, t in enumerate(["a①b②", None, "③" * (n * p)])]
    spans = spark.createDataFrame(rows, "doc_id long, page int, line_idx int, span_idx int, text string").selectExpr("*", "9.0D size", "'x' font", "0 flags", "0.0D x0", "0.0D y0")
    columns = ["doc_id", "page", "line_idx", "n_refs", "refs_before"]
    own = Q.layout.with_references(Q.layout.lines(spans)).select(columns)
    assert sorted(own.collect()) == sorted(Q.layout.reference_counts(spans).select(columns).collect())
    ids = sorted((r.doc_id, r.page, r.k, r.note_id) for r in paragraphs.page_references(own).collect())
    assert [i[3] for i in ids if i[0] == 1] == list(range(1, 28))  # all references of the article, in order
    assert all(k == 1 + sum(i[:2] == (d, p) and i[3] < n for i in ids) for d, p, k, n in ids)


def test_notes_without_page_or_document_have_no_reference(spark):
    refs = spark.createDataFrame([(1, 0, 1, 7), (None, 0, 1, 8), (1, None, 1, 9)], "doc_id int, page int, k long, note_id long")
    notes = spark.createDataFrame([(1, 0, 0, "①a", 0.0), (1, None, 1, "①b", 0.0), (None, 0, 2, "①c", 0.0), (1, 2, 3, "①d", 0.0)], "doc_id int, page int, ord int, raw string, x0 double")
    got = {r.ord: r.text for r in paragraphs.paired_notes(notes, refs).collect()}
    assert got == {0: "[^7]: a", 1: "[^x]: b", 2: "[^x]: c", 3: "[^x]: d"}


def test_pages_of_a_stream_are_dealt_once(spark):
    pages = articles.page_rows(X.spark_page_lines(spark, SF, Q.layout.GLYPH))
    assert dealt(pages) == 1
    one = articles.pages(X.spark_paras(spark, SF), X.spark_notes(spark, SF), Q._references(spark, SF))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, pages.collect()))
    assert all(len(line["raw"]) <= 2 for r in pages.limit(20).collect() for line in json.loads(r.content)["body"])


def test_pages_in_turn_do_not_wait_in_the_state():
    class State:
        def __init__(self):
            self.held, self.puts = {}, 0

        exists = lambda self: bool(self.held)
        get = lambda self: self.held["value"]
        update = lambda self, value: self.held.update(value=value)
        keys = lambda self: list(self.held)
        containsKey = lambda self, k: k in self.held
        getValue = lambda self, k: self.held[k]
        removeKey = lambda self, k: self.held.pop(k)
        clear = lambda self: self.held.clear()

        def updateValue(self, k, value):
            self.held[k], self.puts = value, self.puts + 1

    import pandas as pd

    def run(seqs):
        own = articles.Articles("a", None)
        own.open, own.early = State(), State()
        line = '{"body": [{"text": "l%d", "raw": "　", "x0": 130.0}], "references": 0}'
        frames = [pd.DataFrame({"seq": some, "is_last": [k == 5 for k in some], "content": [line % k for k in some]}) for some in seqs]
        out = [t for f in own.handleInputRows(("d",), iter(frames), None) for t in f["text"]]
        return out, own.early.puts

    want = [f"l{k}" for k in range(6)]
    assert run([[0, 1, 2], [3, 4, 5]]) == (want, 0)
    assert run([[2, 0, 1], [5, 4, 3]]) == (want, 0)
    assert run([[1, 4], [5, 0], [3, 2]]) == (want, 3)


@pytest.mark.parametrize("name", ["layout_markdown", "layout_by_book"])
def test_laid_out_lines_are_made_once(spark, name):
    assert dealt(Q.QUERIES[name](spark, SF)) <= 3  # lines of the body, of the notes, and counts of references
