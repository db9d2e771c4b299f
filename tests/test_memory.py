"""What a Python worker holds at a time does not grow with the tables."""

import io
import re
import tracemalloc
import zipfile

from quire.operators import html
from quire.plans import queries as Q
from quire.sources import epub
from quire.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def steps(df):
    """Python steps of the plan."""
    return set(all_steps(df))


def all_steps(df):
    return list(re.findall(r"\b(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow)\b", df._jdf.queryExecution().executedPlan().toString()))


def test_pages_come_by_rows(spark):
    """An Arrow batch has ten thousand pages or 64 MB of them, a batch of rows a hundred."""
    assert steps(Q.QUERIES["html_to_markdown"](spark, SF)) == {"BatchEvalPython"}
    pages = spark.createDataFrame([("<img src=a><img src=b>", [("a", "f")]), (None, None)], "html string, images array<struct<src string, file string>>")
    made = pages.select(html.image_list().alias("found"), html.markdown_with_images("html", "images").alias("markdown"))
    assert steps(made) == {"BatchEvalPython"}
    assert [tuple(r) for r in made.collect()] == [(["a", "b"], "![img](f)![](b)"), ([], "")]


def large_book(members, size):
    manifest = "".join(f"<item id='p{k}' href='{k}.xhtml' media-type='application/xhtml+xml'/>" for k in range(members))
    data = {"META-INF/container.xml": "<container><rootfiles><rootfile full-path='c.opf'/></rootfiles></container>", "c.opf": f"<package><metadata><title>T</title></metadata><manifest>{manifest}</manifest><spine/></package>"}
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in (data | {f"{k}.xhtml": f"{k} " + "x" * size for k in range(members)}).items():
            z.writestr(name, text)
    return box


def test_members_are_read_one_at_a_time():
    box = large_book(30, 1 << 20)
    tracemalloc.start()
    try:
        lengths = [len(r["content"]) for r in epub.read_book(box) if r["kind"] == "item"]
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
    finally:
        tracemalloc.stop()
    assert lengths == [len(f"{k} ") + (1 << 20) for k in range(30)]


def test_rows_of_many_batches(spark):
    """More rows and bytes than a batch has; of a book whose last member is damaged there is the error only."""
    many, large = large_book(2 * epub.ROWS + 7, 3), large_book(9, epub.BYTES // 2)
    bad = bytearray(many.getvalue())
    at = bad.rindex(b"PK\x01\x02")  # the directory's entry of the last member
    bad[at + 16] ^= 1  # its checksum
    files = spark.createDataFrame([("many", many.getvalue()), ("bad", bytes(bad)), ("large", large.getvalue())], "path string, content binary").coalesce(1)
    got = {(r.doc_id, r.kind): (r.n, r.held) for r in epub.members_of(files).groupBy("doc_id", "kind").agg(Q.F.count("*").alias("n"), Q.F.sum(Q.F.length("content")).alias("held")).collect()}
    held = lambda n, size: sum(len(f"{k} ") + size for k in range(n))
    n = 2 * epub.ROWS + 7
    assert got == {("many", "book"): (1, None), ("many", "item"): (n, held(n, 3)), ("bad", "error"): (1, None), ("large", "book"): (1, None), ("large", "item"): (9, held(9, epub.BYTES // 2))}


def test_books_are_made_of_sorted_pages_once(spark):
    assert all_steps(X.spark_books(spark, SF)) == ["MapInArrow"]
    assert all_steps(Q.QUERIES["epub_spine"](spark, SF)) == ["MapInArrow"]  # the walk over the navigation
