import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from test_neardup import brute as brute_classes
from test_others import one_window
from test_pii import PLAIN, passes
from test_repeats import brute as brute_removal
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import bpe, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(10_000).cast("long"), "text": F.lit(None).cast("string")})).withColumn("row", F.lit(1))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == columns, name
        assert 0 < out.count() <= docs.count()
        assert out.select("doc_id").distinct().count() == out.count()
        docs = out
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    library = Tokenizer.from_file(bpe.VOCABULARY)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [1]
        for r in pieces[d.doc_id]:
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
        assert sum(r.length for r in pieces[d.doc_id]) == len(ids)


def test_stages_same_as_brute_force(spark):
    """Each stage on its predecessor's rows: windows one by one, all pairs, all strings, plain patterns, the library's ids."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    stage = dict(corpus_pipeline.STAGES)
    weights = toxicity.trained(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    some = {d: t for d, t in text(docs).items() if len(t or "") < 3000}
    few = docs.filter(F.length("text") < 3000)
    before, kept = few, stage["toxicity"](spark, few, SF).cache()
    trained_on_few = toxicity.trained(few, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {d for d, t in some.items() if max(one_window(trained_on_few, toxicity.words_of(t)[s : s + toxicity.WINDOW]) for s in toxicity.starts(len(toxicity.words_of(t)))) < np.log(0.7 / 0.3)}
    assert weights is not None and set(text(kept)) == want and 0 < len(want) < len(some)
    single = stage["minhash_neardup"](spark, kept, SF).cache()
    classes = brute_classes(sorted(text(kept).items()))
    assert set(text(single)) == set(classes.values()) and set(classes.values()) != set(classes)
    cut = stage["suffix_dedup"](spark, single, SF).cache()
    rows, ordered = text(cut), sorted(text(single).items())
    for (d, t), (n, gone, _, _) in zip(ordered, brute_removal(ordered), strict=True):
        assert abs(len(rows[d].encode()) - (n - gone)) <= 6 * (gone > 0), d  # broken characters at the cuts go too
    masked = text(stage["pii"](spark, cut, SF))
    for d, t in rows.items():
        found = sorted((m.start(), m.group()) for k, p in PLAIN.items() for m in re.finditer(p, t) if passes(k, m.group()))
        assert all(v not in masked[d] or masked[d].count(v) < t.count(v) for _, v in found)
        assert found or masked[d] == t or "<id>" in masked[d]
    assert before.columns == cut.columns


def test_odd_rows_through_all_stages(spark, documents):
    """Null ids and texts, repeated rows, clashing columns, empty tables."""
    rows = [(None, None), (None, "no id has this text"), (1, None), (2, ""), (3, "some words that are here"), (3, "some words that are here"), (4, "mail a.b@c.de now"), (5, "long text " * 20_000)]
    path = documents(rows, labels=("doc_id long, quality int, toxic int", [(3, 0, 1), (4, 1, 0)]))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path).cache()
        assert docs.columns == columns and docs.filter("doc_id is null").count() == 2, name
    kept = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert kept[4] == "mail <email> now" and kept[1] is None and len(kept[5]) < 1000
    assert {r.doc_id for r in corpus_pipeline.run(spark, path).collect()} == {None, *kept}
    none = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, path).count() == 0, name


def test_run(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF).count() > 0
