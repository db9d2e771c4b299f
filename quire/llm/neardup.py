"""Near-duplicates by Order MinHash, verified by banded alignment.

A text's words give five-word shingles, each labelled with how often it
occurred before.  For each of SKETCHES hash functions the ORDER labelled
shingles of least hash are taken and hashed in the order the text has them, so
equal sketches speak for an alignment rather than for common content alone.

Texts that share a sketch are candidates: of two with half of their shingles in
common 0.96, with four tenths 0.8.  First each member of a bucket meets the one
of least id.  What these pairs connect, alike or not, is a group: texts that
share a sketch are in one.  Groups that are of several classes after that go,
each text once, to one task; those of over PART words are dealt into parts, which
meet themselves first and then each other, with the classes known.  There every
text outside the largest class meets all of other classes that share a sketch
with it, but those that a bound rules out: counts of words by some bits of their
hashes, whose differences bound the common ones from above.  The likeliest come
first, and a pair whose classes a link has joined meanwhile is not aligned.  So no
two classes are left that share a bucket and a similar pair in it, and what comes
out of a task is the links that joined classes.

A pair is verified by aligning the two texts' words: the longest common
subsequence inside the band that any alignment of the wanted similarity must
keep to, by vectors of bits over the band, after equal beginnings and ends.
Similarity is the words that agree in order, of the longer text's: at least
THRESHOLD.  So one changed word counts as one, not as the shingles around it.
Words are compared by 64-bit hashes.  Classes are the connected
components of verified pairs, found by repeated contraction: of each node and
its neighbours, the one of least id (in the first round, for stars) or of least
hash (in later ones) stands for it, so chains of any order shrink by a constant
factor in each round.

Exact copies are joined by digest beforehand, so only one text of each enters.
Null texts count as empty; texts under five words have one shingle, the whole
text.  Class ids are the least doc_id of the class.  Repeated rows keep their
number; rows that share an id but not the text are each in their text's class,
where texts of one least id count as one.  Rows without an id are in no class and get
nulls; they change nothing for others.  Long texts are sketched and aligned
whole.  Other columns are not looked at.  An empty table gives no rows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import aside, held_by_worker, joined_by_key, map_rows, map_slices, mix, staged, table

SHINGLE, SKETCHES, ORDER, THRESHOLD = 5, 24, 3, 0.8
#: Most counts in a profile; words of a part of a group.
PROFILE, PART = 1 << 10, 1 << 21
BLOCK = 1 << 15
#: Words that are aligned at once, at least.
ROWS = 1 << 10
_M2, _M3 = np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)

_STEPS = np.arange(1, SHINGLE + 1, dtype=np.uint64) * _M3


class Shingler:
    """Hashes of the words of texts and of their labelled shingles; keeps hashes of words."""

    def __init__(self, kept: int = 300_000):
        self.known: dict[str, int] = {}
        self.most = kept

    def _hash(self, word: str) -> int:
        if len(self.known) >= self.most:
            self.known.clear()
        h = self.known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) | 1
        return h

    def words(self, text: str | None) -> np.ndarray:
        get, make = self.known.get, self._hash
        return np.array([get(x) or make(x) for x in (text or "").lower().split()], np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        w = self.words(text)
        n = len(w) - SHINGLE + 1
        if n < 1:
            w = np.concatenate([w, np.zeros(SHINGLE - len(w), np.uint64)])
            n = 1
        h = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            h = mix(h + _STEPS[k] ^ w[k : k + n])
        return label(h)


def shared() -> Shingler:
    """One for each worker process."""
    return held_by_worker("shingler", Shingler)


def label(h: np.ndarray) -> np.ndarray:
    """Mixes into each hash how many equal ones come before it."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    if new.all():
        return h
    place = np.arange(len(s))
    before = np.empty(len(s), np.uint64)
    before[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.where(before > 0, mix(h + before * _M2), h)


def sketches(h: np.ndarray) -> np.ndarray:
    """The SKETCHES order sketches of labelled shingles, as signed 64-bit numbers."""
    seeds = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _M3)[:, None]
    least = np.zeros((SKETCHES, 0), np.int64)
    for at in range(0, len(h), BLOCK):  # the least of each block, then of those
        v = mix(h[None, at : at + BLOCK] ^ seeds)
        k = min(ORDER, v.shape[1])
        some = np.argpartition(v, k - 1, axis=1)[:, :k] if v.shape[1] > k else np.tile(np.arange(k), (SKETCHES, 1))
        least = np.concatenate([least, some + at], 1)
    if least.shape[1] > ORDER:
        v = mix(h[least] ^ seeds)
        least = np.take_along_axis(least, np.argpartition(v, ORDER - 1, axis=1)[:, :ORDER], 1)
    least.sort(axis=1)
    out = seeds[:, 0].copy()
    for k in range(least.shape[1]):
        out = mix(out * _M3 + h[least[:, k]])
    return out.view(np.int64)


def _places(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(b, kind="stable")
    return b[order], order


def _masks(rows: np.ndarray, values: np.ndarray, order: np.ndarray, low: int, high: int) -> dict[int, int]:
    """Of each word of ``rows`` that is there: the bits of its places from ``low`` to ``high``."""
    found = np.unique(rows)
    starts, ends = np.searchsorted(values, found), np.searchsorted(values, found, "right")
    out = {}
    for word, i, j in zip(found.tolist(), starts.tolist(), ends.tolist(), strict=True):
        own = order[i:j]
        own = own[np.searchsorted(own, low) : np.searchsorted(own, high)] - low
        if len(own) > 16:
            bits = np.zeros(high - low, np.uint8)
            bits[own] = 1
            out[word] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        elif len(own):
            mask = 0
            for p in own.tolist():
                mask |= 1 << p
            out[word] = mask
    return out


def _in_band(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence whose places differ by ``band`` at most (or little more).

    A bit of the vector stands for a place of ``b``: 0 where the best alignment up to it is longer than that before it.
    Places that the band has left are counted and dropped, those that it reaches begin as 1.
    """
    values, order = _places(b)
    rows = max(ROWS, band // 2)
    low = high = done = vector = 0
    for r in range(0, len(a), rows):
        first, last = min(len(b), max(0, r - band)), min(len(b), r + rows + band)
        vector |= ((1 << (last - high)) - 1) << (high - low)
        high = last
        gone = vector & ((1 << (first - low)) - 1)
        done += first - low - gone.bit_count()
        vector >>= first - low
        low = first
        part = a[r : r + rows]
        masks, every = _masks(part, values, order, low, high), (1 << (high - low)) - 1
        for word in part.tolist():
            mask = masks.get(word)
            if mask:
                both = vector & mask
                vector = ((vector + both) | (vector - both)) & every
    return done + high - low - vector.bit_count()


def common_in_order(a: np.ndarray, b: np.ndarray, least: int = 0) -> int:
    """Words (hashes) of the best alignment, if they are ``least`` or more; else some lower number."""
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(a[len(a) - rest :][::-1] != b[len(b) - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    a, b, known = a[head : len(a) - tail], b[head : len(b) - tail], head + tail
    if min(len(a), len(b)) + known < least or not min(len(a), len(b)):
        return known
    x, in_a = np.unique(a, return_counts=True)
    y, in_b = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if known + int(np.minimum(in_a[i], in_b[j]).sum()) < least:
        return known
    return known + _in_band(a, b, max(len(a), len(b)) - max(0, least - known))


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Of two texts' words: how many agree in order, of the longer text's; below ``threshold``, some lower number."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    least = ceil(threshold * longer - 1e-9)
    return common_in_order(a, b, least) / longer if min(len(a), len(b)) >= least else 0.0


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, sketches, number of words."""

    def make():
        shingles = shared()

        def one(doc_id, text):
            return doc_id, xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass")), sketches(shingles(text)).tolist(), len((text or "").split())

        return one

    return map_rows(docs.select("doc_id", F.col("text").cast("string")), make, "doc_id long, digest binary, sketches array<long>, words long")


def profile(h: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """Counts of words by bits of their hashes."""
    return np.bincount((mix(h) & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.int32)


def bounds(one: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Most that a text's similarity to others can be: counts that differ stand for as many words that are not common."""
    apart = np.abs(others - one).sum(1, dtype=np.int64)
    return ((size + sizes - apart) // 2) / np.maximum(np.maximum(sizes, size), 1)


def joining(words: list[np.ndarray], sketch: np.ndarray, classes: np.ndarray, side: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Links between the texts of two sides, or within one, that join ``classes``: after them, similar texts that share a sketch are of one class."""
    apart = bool((side != side[0]).any())
    sizes = np.array([len(w) for w in words])
    # As many counts as the longest text has words, in powers of two.
    width = min(PROFILE, 1 << max(0, int(sizes.max()) - 1).bit_length())
    profiles = np.stack([profile(w, width) for w in words])
    _, classes = np.unique(classes, return_inverse=True)
    waiting = np.ones(len(words), bool)
    out: list[tuple[int, int]] = []
    while True:
        left = np.flatnonzero(waiting)
        if len(left) == 0 or (apart and not (side[left].any() and (~side[left]).any())):
            return out
        others = left[classes[left] != np.bincount(classes[left]).argmax()]
        if len(others) == 0:
            return out
        q = int(others[0])
        waiting[q] = False
        fits = (classes != classes[q]) & (np.minimum(sizes, sizes[q]) >= threshold * np.maximum(sizes, sizes[q]))
        if apart:
            fits &= side != side[q]
        met = np.flatnonzero(fits)
        met = met[(sketch[met] == sketch[q]).any(1)]
        most = bounds(profiles[q], profiles[met], int(sizes[q]), sizes[met])
        for k in np.argsort(-most, kind="stable"):
            if most[k] < threshold:
                break
            c = int(met[k])
            if classes[c] != classes[q] and similarity(words[q], words[c], threshold) >= threshold:
                classes[classes == classes[c]] = classes[q]
                out.append((q, c))


def searched(groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b) of ``groups`` (of: array of doc, class, side, words, sketches)."""

    def make():
        def several(groups):
            out = []
            for of in groups:
                docs = [m["doc"] for m in of]
                found = joining([np.frombuffer(m["words"], np.uint64) for m in of], np.array([m["sketches"] for m in of], np.int64), np.array([m["class"] for m in of]), np.array([m["side"] for m in of], bool), threshold)
                out += [(docs[a], docs[b]) for a, b in found]
            return out

        return several

    return map_slices(groups.select("of"), make, "a long, b long")


def candidates(buckets: DataFrame, total: int) -> DataFrame:
    """Distinct pairs (a < b) of members of a bucket (key, doc), of which there are ``total``: each with the least one."""
    heads = staged(buckets.groupBy("key").agg(F.min("doc").alias("head"), F.count("*").alias("members")).filter("members > 1"), "heads")
    return joined_by_key(buckets, heads, "key", "members", total).filter("doc <> head").select(F.col("head").alias("a"), F.col("doc").alias("b")).distinct()


def links_within(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links that join classes among ``members`` (doc, words, sketches, class, group, parts)."""
    of = F.collect_list(F.struct("doc", "class", "side", "words", "sketches")).alias("of")
    several = (F.min("class") != F.max("class")).alias("several")
    dealt = members.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    alone = dealt.withColumn("side", F.lit(False)).groupBy("group", "part").agg(of, several).filter("several")
    within = staged(searched(alone, threshold), "links-within")
    large = dealt.filter("parts > 1")
    if large.isEmpty():
        return within
    # A class that a link joined goes by its new name.
    ends = within.join(members.select(F.col("doc").alias("a"), F.col("class").alias("class_a")), "a").join(members.select(F.col("doc").alias("b"), F.col("class").alias("class_b")), "b")
    renamed = components(ends.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))).withColumnsRenamed({"node": "class", "root": "now"})
    known = large.join(renamed, "class", "left").withColumn("class", F.coalesce("now", "class")).drop("now")
    met = known.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("other <> part")
    met = met.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).withColumn("side", F.col("part") == F.col("high"))
    across = met.groupBy("group", "low", "high").agg(of, several).filter("several")
    return staged(within.unionByName(searched(across, threshold)), "links-across")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs whose texts align."""
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")

    def make():
        shingles = shared()
        last: list = [None, None]

        def one(a, b, text_a, text_b):
            if last[0] != a:
                last[:] = a, shingles.words(text_a)
            return a, b, similarity(last[1], shingles.words(text_b), threshold)

        return one

    return map_rows(with_both.select("a", "b", "text_a", "text_b"), make, "a long, b long, similarity double").filter(F.col("similarity") >= threshold)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the least node of each connected component as root, by contraction to the least neighbour.

    The first round goes by the ids themselves, further ones by their hashes.
    """
    edges = staged(edges.select("a", "b"), "edges")
    found, rounds = None, 0
    while not edges.isEmpty():
        rank = lambda c: F.struct((F.xxhash64(c) if rounds else F.lit(0).cast("long")).alias("by"), F.col(c).alias("of"))  # noqa: B023, E731
        both = edges.union(edges.select("b", "a"))
        step = staged(both.groupBy("a").agg(F.min(rank("b")).alias("x")).select(F.col("a").alias("node"), F.least("x", rank("a")).getField("of").alias("root")), "least")
        up = step.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        # A root that has a root of its own hands it on.
        step = staged(step.join(up, "root").select("node", F.col("higher").alias("root")), "roots")
        up = step.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        found = step if found is None else staged(found.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), "found")
        of = lambda c: step.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))  # noqa: B023, E731
        moved = edges.join(of("a"), "a").join(of("b"), "b").filter("root_a != root_b")
        edges = staged(moved.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "edges")
        rounds += 1
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    names = staged(found.groupBy("root").agg(F.min("node").alias("least"), F.count("*").alias("members")), "names")
    return joined_by_key(found, names, "root", "members", found.count()).select("node", F.col("least").alias("root"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, copy_of (least id with that text), class_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    nobody = docs.filter("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("copy_of"), F.lit(None).cast("long").alias("class_id"))
    docs = docs.filter("doc_id is not null")
    seen = staged(sketched(docs), "sketches")
    copies = staged(seen.groupBy("digest").agg(F.min(F.struct("doc_id", "sketches", "words")).alias("x"), F.count("*").alias("members")).select("digest", "members", "x.*"), "copies")
    total = copies.count() * SKETCHES
    sketch = copies.select(F.col("doc_id").alias("doc"), F.posexplode("sketches").alias("n", "sketch"))
    first = staged(candidates(sketch.select("doc", F.xxhash64("n", "sketch").alias("key")), total), "pairs")
    # Every document that shares a sketch is in a first pair, so what follows needs no others.
    met = first.select(F.col("a").alias("doc_id")).union(first.select("b")).distinct()
    # Merged, not broadcast where few ids would allow it: one plan at every size.
    texts = staged(docs.join(met.hint("merge"), "doc_id", "left_semi"), "texts")
    links = staged(verified(first, texts, threshold), "links")
    roots = staged(components(links).withColumnsRenamed({"node": "doc", "root": "class"}), "components")
    grouped = components(first).withColumnsRenamed({"node": "doc", "root": "group"}).join(roots, "doc", "left").withColumn("class", F.coalesce("class", "doc"))
    grouped = staged(grouped.join(copies.select(F.col("doc_id").alias("doc"), "sketches", "words"), "doc"), "groups")
    mixed = grouped.groupBy("group").agg(F.count("*").alias("members"), (F.min("class") != F.max("class")).alias("several"), F.ceil(F.sum("words") / PART).cast("int").alias("parts"))
    # With two members the pair has met.
    mixed = staged(mixed.filter("several and members > 2").select("group", "members", "parts"), "mixed")
    left = joined_by_key(grouped.drop("words"), mixed, "group", "members", total)

    def make():
        shingles = shared()
        return lambda doc, text: (doc, shingles.words(text).tobytes())

    own = map_rows(texts.join(left.select(F.col("doc").alias("doc_id")).hint("merge"), "doc_id", "left_semi").select("doc_id", "text"), make, "doc long, words binary")
    members = staged(left.join(own, "doc"), "group-words")
    links = links.select("a", "b").unionByName(links_within(members, threshold))
    roots = staged(components(links), "components")
    class_of = copies.select("digest", "members", F.col("doc_id").alias("copy_of")).join(roots.select(F.col("node").alias("copy_of"), F.col("root").alias("class_id")), "copy_of", "left")
    class_of = staged(class_of.select("digest", "members", "copy_of", F.coalesce("class_id", "copy_of").alias("class_id")), "classes")
    out = joined_by_key(seen.select("doc_id", "digest"), class_of, "digest", "members", seen.count())
    return out.select("doc_id", "copy_of", "class_id").unionByName(nobody)


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is their class's, one for each id; rows without an id stay."""
    inner, back = aside(docs)
    kept = classes(inner.filter("doc_id is not null")).filter("doc_id = class_id").select("doc_id").distinct()
    w = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    one = inner.join(kept, "doc_id", "left_semi").withColumn("place", F.row_number().over(w)).filter("place = 1").drop("place")
    return back(one.unionByName(inner.filter("doc_id is null")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
