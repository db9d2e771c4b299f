"""Points in ranges against every pair, and what long ranges cost."""

import random

from pyspark.sql import functions as F

from quire.operators import profiling, toc
from quire.operators.intervals import containing


def test_same_as_every_pair(spark):
    rng = random.Random(3)
    ranges = [(k % 5, k, a, a + rng.choice([-1, 0, 0, 1, 2, 7, 8, 9, 63, 64, 500, 70_000, 5_000_000])) for k, a in enumerate(rng.randrange(-50, 3000) for _ in range(400))]
    points = [(rng.randrange(6), rng.choice([rng.randrange(-60, 3200), rng.randrange(6_000_000)])) for _ in range(800)] + [(1, None)]
    got = containing(spark.createDataFrame(points, "k int, p int"), spark.createDataFrame(ranges, "k int, n int, a int, b int"), ["k"], "p", "a", "b").collect()
    want = sorted((k, p, n) for k, p in points if p is not None for j, n, a, b in ranges if j == k and a <= p <= b)
    assert sorted((r.k, r.p, r.n) for r in got) == want


def rows_made(df):
    """Rows that the joins of a plan emit, by its metrics."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []
    todo = [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith(("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Generate")):
            found.append(node.metrics().apply("numOutputRows").value())
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return sum(found)


def test_ranges_of_a_million_pages(spark):
    """Rows grow with the pages that there are, not with the lengths of the ranges."""
    planned = spark.range(20).select(F.lit(0).alias("doc_id"), F.col("id").cast("int").alias("pos"), F.lit("file").alias("kind"), (F.col("id") * 7).cast("int").alias("start"), (F.col("id") * 7 + 1_000_000).cast("int").alias("end"))
    pages = spark.range(50).select(F.lit(0).alias("doc_id"), F.col("id").cast("int").alias("page"))
    found = toc.articles_of(pages, planned)
    assert found.count() == sum(1 for p in range(50) for k in range(20) if 7 * k <= p)
    assert rows_made(toc.articles_of(pages, planned)) < 3000


def test_long_parts(spark):
    cuts = spark.createDataFrame([(0, 1_000_001), (0, 5)], "doc_id int, page int")
    docs = spark.createDataFrame([(0, 3_000_000)], "doc_id int, n_pages int")
    pages = spark.createDataFrame([(0, p) for p in (0, 3, 4, 999_999, 1_000_000, 2_999_999, 3_000_000)], "doc_id int, page int")
    got = {r.page: r.part for r in profiling.split_pages(pages, cuts, docs).collect()}
    assert got == {0: 1, 3: 1, 4: 2, 999_999: 2, 1_000_000: 3, 2_999_999: 3}
