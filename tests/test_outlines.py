"""Outlines of any depth and names that no two rows share."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators import toc
from quire.operators.names import unique_names
from quire.plans import books


def test_names_that_met_before(spark):
    rows = spark.createDataFrame([(0, k, 1, t, 1, 9) for k, t in enumerate(["a", "a", "a_1", "a__1", "1", "1", "1_5"])], "doc_id int, pos int, level int, title string, page int, n_pages int")
    paths = [r.path for r in toc.plan(rows, [], 1).orderBy("pos").collect()]
    assert len(set(paths)) == len(paths) and paths[0] == "a" and paths[2:5] == ["a_1", "a__1", "1"]
    folders = books.with_folder(spark.createDataFrame([(1, "B"), (2, "B"), (3, "B_2")], "doc_id int, book string"))
    assert len({r.folder for r in folders.collect()}) == 3


def test_names_are_unique(spark):
    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.lists(st.text("aB_12/", max_size=4), min_size=1, max_size=12), min_size=1, max_size=20))
    def check(scopes):
        rows = spark.createDataFrame([(s, k, n) for s, names in enumerate(scopes) for k, n in enumerate(names)], "scope int, pos int, name string")
        for number in (None, F.col("pos")):
            got = unique_names(rows, ["scope"], "name", "pos", number).collect()
            assert len({(r.scope, r.name) for r in got}) == len(got) == rows.count()
            kept = {(r.scope, r.pos): r.name for r in got}
            for s, names in enumerate(scopes):
                for k, n in enumerate(names):
                    assert (kept[s, k] == n) == (n not in names[:k])

    check()


def test_same_plan_at_any_depth(spark):
    """3 and 2,000 levels: one plan, and the results of stacks."""
    schema = "doc_id int, pos int, level int, title string, page int, n_pages int"
    flat = spark.createDataFrame([(0, k, 1 + k % 3, f"t{k}", k + 1, 90) for k in range(60)], schema)
    deep = spark.createDataFrame([(0, k, k + 1, f"t{k}", k + 1, 3000) for k in range(2000)] + [(0, 2000, 5, "x", 2500, 3000)], schema)
    shape = lambda df: "".join(c for c in df._jdf.queryExecution().optimizedPlan().toString() if not c.isdigit()).replace("LogicalRDD", "")
    assert shape(toc.plan(flat, ["BAD"], 2)) == shape(toc.plan(deep, ["BAD"], 2))
    got = {r.pos: r for r in toc.plan(deep, ["BAD"], 3).collect()}
    assert len(got) == 2001 and got[1999].category == "/".join(f"t{k}" for k in range(1999)) and got[1999].end == 2498
    assert got[2].end == 2999 and got[4].end == 2498 and got[2000].category == "t0/t1/t2/t3" and got[2].path == "t0/t1/t2" and got[1999].path == "t0/t1/t1999"
    bad = toc.with_blacklist(deep.withColumn("title", F.when(F.col("pos") == 1000, "BAD").otherwise(F.col("title"))), ["BAD"])
    assert {r.pos for r in bad.filter("is_blacklisted").collect()} == set(range(1000, 2000))


def test_walk_over_many_batches(spark):
    """Outlines that go over several Arrow batches, against a stack."""
    rng = random.Random(2)
    rows = [(d, k, rng.randint(1, 6), f"t{rng.randint(0, 9)}", rng.randint(1, 99)) for d in range(5) for k in range(700)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = spark.createDataFrame(rows, "doc_id int, pos int, level int, title string, start int").repartition(3)
        got = {(r.doc_id, r.pos): r for r in toc.nested(df, {"up": "title"}, {}, ("next", "start"), "kids").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for d in range(5):
        own, stack = [r for r in rows if r[0] == d], []
        for k, (_, pos, level, title, _) in enumerate(own):
            while stack and stack[-1][0] >= level:
                stack.pop()
            after = next((r[4] for r in own[k + 1 :] if r[2] <= level), None)
            assert (got[d, pos].up, got[d, pos].next, got[d, pos].kids) == ("/".join(t for _, t in stack) or None, after, k + 1 < len(own) and own[k + 1][2] > level)
            stack.append((level, title))
