"""Pages in any batches give the articles of the batch form."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import paragraphs
from quire.plans import queries as Q
from quire.profiles import PROFILE_A, PROFILE_B
from quire.sources import fixtures as X
from quire.streaming import articles

SF = "/root/testdata/sf0.001"


def line_tables(spark, profile, seed=3):
    """Body lines, note lines and references of random articles."""
    rng = random.Random(seed)
    texts = ["# 一 题", "## x", "> 引", "> quote", "**甲乙**", "**乙**", "*丙*", "*丁甲*", "plain", "中文", "", "————————", "[^2] note", "#no", "![i](a)", "*x*", "**x**", "* 乙*", "**"]
    body, notes, refs = [], [], []
    for d in range(25):
        for page in sorted(rng.sample(range(12), rng.randint(1, 7))):
            for k in range(rng.randint(0, 7)):
                text = rng.choice(texts)
                body.append((d, page, page * 100 + k, text, rng.choice(["", "　", "  "]) + text, float(rng.choice([60, 78, 130])), text.startswith("![")))
            for k in range(rng.randint(0, 4)):
                notes.append((d, page, page * 100 + 50 + k, rng.choice(["①注", "②[接上页]释", "续", "　缩进", " ", "[ 转 下页 ]", "③"]), float(rng.choice([60, 130]))))
            refs += [(d, page, k + 1) for k in range(rng.randint(0, 3))]
    body = spark.createDataFrame(body, "doc_id long, page int, ord long, text string, raw string, x0 double, is_image boolean")
    notes = spark.createDataFrame(notes, "doc_id long, page int, ord long, raw string, x0 double")
    refs = spark.createDataFrame(refs, "doc_id long, page int, k int")
    # The number of a reference is its place among those of the article.
    w = paragraphs.Window.partitionBy("doc_id").orderBy("page", "k")
    return body, notes, refs.withColumn("note_id", F.row_number().over(w))


def batch_form(body, notes, refs, profile):
    blocks = paragraphs.merged_quotes(paragraphs.paragraphs(paragraphs.with_pieces(paragraphs.with_islands(body, profile), profile)))
    foot = paragraphs.note_islands(paragraphs.paired_notes(notes, refs), profile)
    return {str(r.doc_id): r.markdown for r in paragraphs.articles(blocks, foot).collect()}


@pytest.mark.parametrize("profile", [PROFILE_A, PROFILE_B])
def test_random_batches_and_restart(spark, tmp_path, profile):
    body, notes, refs = line_tables(spark, profile)
    want = batch_form(body, notes, refs, profile)
    rows = articles.pages(body, notes, refs).collect()
    rng = random.Random(8)
    rng.shuffle(rows)
    rows += rows[:9]  # pages that come again
    source = tmp_path / "pages"
    cuts = sorted(rng.sample(range(1, len(rows)), 5))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    put = lambda some: spark.createDataFrame(some, articles.PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
    for k, some in enumerate(parts):
        put(some)
        if k in (2, 5):  # a run over several batches, and another after it from the checkpoint
            got = {r.doc_id: r.markdown for r in articles.streamed(spark, str(source), str(tmp_path), profile.name, files=1).collect()}
    assert got == want
    assert spark.read.parquet(f"{tmp_path}/blocks").groupBy("doc_id", "part", "n").count().filter("count > 1").count() == 0


def test_reader_keeps_no_closed_text():
    reader = articles.Reader(PROFILE_A)
    for k in range(300):
        reader.page('{"body": [{"text": "line %d", "raw": "　", "x0": 130.0}], "notes": [], "references": 1}' % k)
        reader = articles.Reader(PROFILE_A, __import__("json").loads(__import__("json").dumps(reader.state)))
        assert len(str(reader.state)) < 400
    assert reader.state["references"] == 300 and reader.state["blocks"] == 298


def test_timeout_reads_over_gaps(spark, tmp_path):
    line = '{"body": [{"text": "%s", "raw": "", "x0": 60.0}], "references": 0}'
    rows = [("a", 0, False, line % "one"), ("a", 2, False, line % "three")]
    spark.createDataFrame(rows, articles.PAGE_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "pages"))
    stream = spark.readStream.schema(articles.PAGE_SCHEMA).parquet(str(tmp_path / "pages"))
    before = spark.conf.get(articles.PROVIDER[0])
    spark.conf.set(*articles.PROVIDER)
    query = articles.blocks(stream, "a", timeout_ms=200).writeStream.format("memory").queryName("timed_articles").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start()
    spark.conf.set(articles.PROVIDER[0], before)
    found = []
    try:
        for _ in range(60):
            query.awaitTermination(1)
            found = articles.assembled(spark.createDataFrame(spark.table("timed_articles").collect(), articles.OUT_SCHEMA)).collect()
            if found:
                break
    finally:
        query.stop()
    assert [(r.doc_id, r.markdown) for r in found] == [("a", "one three")]


def test_documents_same_as_article_markdown(spark, tmp_path):
    paras = X.spark_paras(spark, SF).filter("doc_id < 40")
    notes, refs = X.spark_notes(spark, SF).filter("doc_id < 40"), paragraphs.page_references(Q._numbered(spark, SF)).filter("doc_id < 40")
    articles.pages(paras, notes, refs).repartition(3).write.parquet(str(tmp_path / "pages"))
    got = {r.doc_id: r.markdown for r in articles.streamed(spark, str(tmp_path / "pages"), str(tmp_path), files=2).collect()}
    assert got == {str(r.doc_id): r.markdown for r in Q.article_markdown(spark, SF).filter("doc_id < 40").collect()}
