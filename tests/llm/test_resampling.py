import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb

from quire.llm import resampling


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def features(text, most):
    w = words(text)
    return [zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000 for n in range(1, most + 1) for k in range(len(w) - n + 1)]


def brute(rows, target, most=1):
    raw, wanted = Counter(b for _, t in rows for b in features(t, most)), Counter(b for t in target for b in features(t, most))
    s_all, t_all = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000))))
    out = []
    for d, t in rows:
        f = features(t, most)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
        score = None if d is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(f), weight, score, None, len(words(t))])
    entered = sorted((r for r in out if r[5] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(entered[: 10 * len(entered) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in out]


def sample(n):
    rng = random.Random(9)
    vocabulary = ["the", "The", "été", "42", "x_y", "a-b", "中文", "wörd", "ZEBRA", "it's", " nb", "𝄞"] + [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 19, 20, 60])))) for k in range(n)]
    return rows + [(9000, None), (9001, ""), (9002, "-- ..."), (None, "w1 w2 " * 30), (9003, "w3 " * 50_000), (7, rows[7][1]), (9004, "w1 " * 40), (9005, "w1 " * 40)], [" ".join(rng.choice(vocabulary[:20]) for _ in range(40)) for _ in range(12)] + [None, ""]


def check(spark, folder_of, rows, target, **options):
    sf = folder_of(rows, benchmark=("item_id long, text string, bucket long", [(k, t, 1) for k, t in enumerate(target)]))
    docs, wanted = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    key = lambda r: tuple((x is None, x) for x in r)
    return sf, sorted((tuple(r) for r in resampling.resampled(docs, wanted, **options).collect()), key=key), sorted(brute(rows, target, options.get("most", 1)), key=key)


def test_same_as_brute_force(spark, documents):
    rows, target = sample(400)
    _, got, want = check(spark, documents, rows, target)
    # Of equal rows one may be drawn and the other not: their places are compared without the pairing.
    assert [r[:4] for r in got] == [r[:4] for r in want] and sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])
    assert {r[0]: r[4] for r in got if r[0] != 7} == {r[0]: r[4] for r in want if r[0] != 7}


def test_longer_runs_of_words(spark, documents):
    rows, target = sample(60)
    _, got, want = check(spark, documents, rows, target, most=3)
    assert [r[:4] for r in got] == [r[:4] for r in want]


def test_same_as_sql(spark, documents):
    rows, target = sample(120)
    rows = [r for k, r in enumerate(rows) if r[0] is not None and r[0] not in (d for d, _ in rows[:k])]
    sf, got, _ = check(spark, documents, rows, target)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet/*.parquet'")
    assert sorted(got) == sorted(con.execute(resampling.ORACLE).fetchall()) if all(r[4] for r in got) else {r[0]: r for r in got} == {r[0]: r for r in con.execute(resampling.ORACLE).fetchall()}


def test_ranks_over_many_parts(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "id * 7919 % 97 as score").repartition(13)
    from pyspark.sql import functions as F

    got = {r.doc_id: r.rank for r in resampling.ranked(rows, [F.desc("score"), F.asc("doc_id")], "rank").collect()}
    order = sorted(range(5000), key=lambda d: (-(d * 7919 % 97), d))
    assert got == {d: k for k, d in enumerate(order, 1)}


def test_empty_tables(spark, documents, tmp_path):
    _, got, _ = check(spark, documents, [], ["some words"])
    assert got == []


def test_empty_target(spark, documents):
    rows, _ = sample(30)
    _, got, want = check(spark, documents, rows, [])
    assert [r[:4] for r in got] == [r[:4] for r in want]
