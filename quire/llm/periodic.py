"""Periodic runs of words, by Lyndon arrays on the ordered alphabet of a text's words.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends keeping it.  Each run of at least two periods holds,
in one of the two orders of the alphabet, a longest Lyndon word of length q (the
run's root).  ``lyndon`` finds for each place the next smaller suffix, where its
longest Lyndon word ends, and how far the two suffixes match: along the chain of
smaller suffixes before a place, matches follow from those of the chain's links
or from the furthest window matched so far, and words are compared only beyond
it.  A root's match to the right and its match to the left, which is looked for
once a run, give the run.  There are no suffix arrays or trees and no
fingerprints: words are compared, as places in the sorted list of the distinct ones.

A run of EXPONENT periods has each of its words EXPONENT times at least.  So a
text is first split at words that are rarer than that, its pieces again at words
that are rarer there, until nothing changes; no run of that many periods
crosses such a word, nor could it be extended by one.  The Lyndon arrays are made
of the pieces that remain, which in plain prose are few.

Words are runs of what is no ASCII white space.  Null, empty and blank texts
have no words, no runs and an empty collapsed text.  Collapsing keeps the first
period of each run and drops what any run has beyond it.  Rows without an id and
repeated rows get their own equal results; empty tables give no rows.  Texts of
any length are taken whole, in memory in proportion to the text; nothing is
shuffled.  Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import map_rows, table

LEAST, EXPONENT = 6, 4

Run = tuple[int, int, int]


def lyndon(s: list[int]) -> tuple[list[int], list[int]]:
    """For each place the next one whose suffix is smaller (the end is smallest), and how far the two suffixes match."""
    n = len(s)
    after, after_match = [n] * n, [0] * n
    before, before_match = [-1] * n, [0] * n
    chain: list[int] = []  # places whose suffixes rise, each the nearest smaller one before the next
    left = right = end = 0  # the window: s[right:end] is what begins at left
    for r in range(n):
        popped = -1
        match = 0
        while chain:
            at = chain[-1]
            sure = False
            if popped >= 0:
                link = before_match[popped]
                sure = link != match
                if link < match:
                    match = link
            if not sure and r < end and at >= right:
                a, b = at - right + left, r - right + left
                copied = after_match[a] if after[a] == b else before_match[b] if before[b] == a else -1
                if copied >= 0:
                    sure = r + copied < end
                    match = copied if sure else max(match, end - r)
            if not sure:
                while r + match < n and s[at + match] == s[r + match]:
                    match += 1
                if r + match > end:
                    left, right, end = at, r, r + match
            if r + match < n and s[at + match] < s[r + match]:
                before[r], before_match[r] = at, match
                break
            after[at], after_match[at] = r, match
            chain.pop()
            popped = at
        chain.append(r)
    return after, after_match


def runs_of_ranks(s: list[int], least: int, exponent: int) -> set[Run]:
    """(start, length, period) of the runs of at least ``least`` words and ``exponent`` (2 or more) periods."""
    found: set[Run] = set()
    for t in (s, [-x for x in s]):
        after, after_match = lyndon(t)
        ends: dict[int, int] = {}  # of the last run of each period
        for i, (j, match) in enumerate(zip(after, after_match, strict=True)):
            period = j - i
            if match <= (exponent - 2) * period or ends.get(period) == j + match:
                continue
            ends[period] = j + match
            back = 0
            while back < i and t[i - 1 - back] == t[j - 1 - back]:
                back += 1
            length = back + period + match
            if length >= max(least, exponent * period):
                found.add((i - back, length, period))
    return found


def stretches(words: list, exponent: int, least: int) -> Iterator[tuple[int, list]]:
    """(start, words) of the pieces in which every word is there ``exponent`` times."""
    open_ = [(0, words)]
    while open_:
        start, piece = open_.pop()
        count = Counter(piece)
        if min(count.values(), default=exponent) >= exponent:
            if piece:
                yield start, piece
            continue
        cuts = [k for k, w in enumerate(piece) if count[w] < exponent]
        cuts.append(len(piece))
        at = 0
        for k in cuts:
            if k - at >= max(least, exponent):
                open_.append((start + at, piece[at:k]))
            at = k + 1


def runs_of(words: list, least: int = LEAST, exponent: int = EXPONENT) -> list[Run]:
    """(start, length, period) of the runs of any comparable ``words``, by start and then period."""
    found = []
    for start, piece in stretches(words, exponent, least):
        rank = {w: k for k, w in enumerate(sorted(set(piece)))}
        found += [(start + a, n, p) for a, n, p in runs_of_ranks([rank[w] for w in piece], least, exponent)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words: list, runs: list[Run]) -> list:
    """``words`` without those that a run has after its first period."""
    if not runs:
        return words
    depth = [0] * (len(words) + 1)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, accumulate(depth), strict=False) if d == 0]


def words_of(doc_id: int | None, text: str | None) -> list[bytes]:
    """Words in UTF-8: runs of what is not tab to carriage return or space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def with_runs(docs: DataFrame, words: Callable[[int | None, str | None], list[bytes]] = words_of, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, runs, collapsed) of ``docs`` (doc_id, text): runs by start and period, and the kept words joined by a space."""

    def make():
        def one(doc_id, text):
            own = words(doc_id, text)
            runs = runs_of(own, least, exponent)
            return doc_id, [{"start": a, "length": n, "period": p} for a, n, p in runs], b" ".join(kept_words(own, runs)).decode("utf-8", "surrogatepass")

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def strongest(runs: str) -> Column:
    """The run of most periods, exactly; of equal ones that of least start, then period (the order they have)."""
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, x: F.when(better(best, x), x).otherwise(best))


def repeating(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text; in one document of ten, by its id, they repeat from some word on."""
    words = words_of(doc_id, text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_runs(table(spark, sf_dir, "documents"), repeating).withColumn("best", strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
