"""Jaccard join of word shingles by T-occurrence search, and the components of its links.

A text's set holds its distinct SHINGLE-word shingles (A-Z in lower case; words
are runs of what is no ASCII white space); fewer words are one shingle, no words
an empty set, which is linked with nothing.  Two sets of n and m shingles link
if 100 * common >= PERCENT * all, so they have T = ceil(PERCENT * n / 100)
shingles in common at least: whoever links occurs in T of a set's n inverted lists.

Divided lists, over the whole corpus.  Shingles have one order: those in few
sets first.  Of a set's lists the T - 1 last in that order, the longest, are set
aside; who links occurs in one of the others, its short lists.  Lists of one set
are never written.  Which shingles a part of a HOT_SHAREth of all sets has is
found first; these come last in the order, and are dealt by their sets instead of
by themselves, so no task gets a long list.

Groups.  Sets that share short lists, directly or through others, are a group
(connected components of each list's first set with its others), so each set
goes to one place with its shingles.  Groups of over PART shingles are dealt into
parts, which meet themselves first and then each other, with the classes known.

Search inside a group, or of one part against another (DivideSkip): of the lists
of a set's shingles the L longest are set aside, L by their lengths; the short
ones are merged through a heap, or counted where they are long together; sets
that occur T - L times are probed for in the long lists by binary search and
retained if they reach the required overlap.  Sets that a link joins are one
class; a set is searched for only while sets of other classes are left that were
not, so copies of copies take few searches, and links that join classes come out.

Shingles are compared by 64-bit hashes of their words' hashes, sets by 64 bits
of a digest of theirs; sets of one number and different digests make the join
begin again with another seed.  n_shingles counts the shingles themselves.

Equal sets are one; repeated rows keep their number; rows that share an id but
not the text count for themselves, and have the least id that theirs reaches.
Rows without an id have their n_shingles, a null component, and change nothing
for others.  Null texts are empty.  An empty table gives no rows.  Long texts are
taken whole.  Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import HOT_SHARE, held_by_worker, joined_by_key, map_rows, map_slices, mix, staged, table
from quire.llm.neardup import candidates, components

SHINGLE, PERCENT = 3, 90
#: Postings of a bucket; shingles of a part of a group; entries that are merged through a heap; frequent shingles at most.
POSTINGS, PART, HEAP, MOST_HOT = 1 << 20, 1 << 21, 1 << 11, 1 << 18
#: What a slice must have a shingle in to name it as frequent: so many sets, and this part of its sets.
SEEN, SEEN_SHARE = 8, 512
#: The order of shingles that are frequent: after any number of sets.
LAST = np.iinfo(np.int32).max
_STEP = np.uint64(0x9E3779B97F4A7C15)


def required(n, percent: int = PERCENT):
    """Shingles that a set of ``n`` has in common with any that links with it."""
    return -(-percent * n // 100)


class Shingles:
    """Sets of texts: how many shingles, and their sorted hashes; keeps hashes of words."""

    def __init__(self, kept: int = 300_000):
        self.words: dict[bytes, int] = {}
        self.most = kept

    def _hash(self, word: bytes) -> int:
        if len(self.words) >= self.most:
            self.words.clear()
        h = self.words[word] = xxhash.xxh3_64_intdigest(word) | 1
        return h

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        get, make = self.words.get, self._hash
        own = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not own:
            return 0, np.zeros(0, np.uint64)
        w = np.array([get(x) or make(x) for x in own], np.uint64)
        n = len(w) - SHINGLE + 1
        if n < 1:
            w, n = np.concatenate([w, np.zeros(SHINGLE - len(w), np.uint64)]), 1
        h = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            h = mix((h + _STEP * np.uint64(k + 1)) ^ w[k : k + n])
        return len(set(zip(*(own[k:] for k in range(SHINGLE)), strict=False))) or 1, np.unique(h)


def shared() -> Shingles:
    """One for each worker process."""
    return held_by_worker("shingle-sets", Shingles)


def number(tokens: np.ndarray, seed: int) -> tuple[int, int]:
    """Number of a set, and the rest of its digest."""
    d = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes(), seed), np.int64)
    return int(d[0]), int(d[1])


def seen_sets(docs: DataFrame, seed: int) -> DataFrame:
    """A row for each document (doc_id, n, m hashes, set, rest), and rows (token, times) of what many sets of a slice have."""

    def make():
        shingles = shared()

        def several(doc_ids, texts):
            rows, tokens = [], {}
            for d, t in zip(doc_ids, texts, strict=True):
                n, h = shingles(t)
                set_, rest = number(h, seed)
                rows.append((d, n, len(h), set_, rest, None, None))
                tokens[set_] = h
            if len(tokens) >= SEEN:
                found, times = np.unique(np.concatenate(list(tokens.values())), return_counts=True)
                many = times >= max(SEEN, len(tokens) / SEEN_SHARE)
                rows += [(None, None, None, None, None, t, c) for t, c in zip(found[many].view(np.int64).tolist(), times[many].tolist(), strict=True)]
            return rows

        return several

    return map_slices(docs, make, "doc_id long, n long, m long, set long, rest long, token long, times long")


def packed(owner: np.ndarray, bucket: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, bytes, bytes, tuple[bytes, ...]]]:
    """(bucket, owners, how many values each has, values), of values ordered by bucket and owner."""
    if len(owner) == 0:
        return
    order = np.lexsort((owner, bucket))
    owner, bucket = owner[order], bucket[order]
    values = tuple(v[order] for v in values)
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])]))
    counts = np.diff(np.append(new, len(owner))).astype(np.int32)
    owners, of = owner[new], bucket[new]
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(of)], strict=True):
        first, last = int(new[a]), int(new[b]) if b < len(new) else len(owner)
        yield int(of[a]), owners[a:b].tobytes(), counts[a:b].tobytes(), tuple(v[first:last].tobytes() for v in values)


def unpacked(rows: pa.Table, **types) -> list[np.ndarray]:
    """The owner of each value, and the values, of several packed rows."""
    whole = lambda name, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)]]) if rows.num_rows else np.zeros(0, kind)
    return [np.repeat(whole("owners", np.int64), whole("counts", np.int32)), *[whole(name, kind) for name, kind in types.items()]]


def postings(docs: DataFrame, seed: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Packed rows (bucket, owners, counts, tokens): of which sets have a shingle; frequent ones are dealt by the set."""
    held = docs.sparkSession.sparkContext.broadcast(hot)

    def make():
        shingles, often = shared(), held.value

        def several(texts):
            tokens = {}
            for t in texts:
                _, h = shingles(t)
                if len(h):
                    tokens[number(h, seed)[0]] = h
            if not tokens:
                return []
            token = np.concatenate(list(tokens.values()))
            owner = np.repeat(np.array(list(tokens), np.int64), [len(h) for h in tokens.values()])
            by = np.where(np.isin(token, often), owner, token.view(np.int64)) if len(often) else token.view(np.int64)
            return [(b, o, c, v) for b, o, c, (v,) in packed(owner, by % buckets, token)]

        return several

    return map_slices(docs.select("text"), make, "bucket long, owners binary, counts binary, tokens binary")


def in_several(rows: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """Packed rows by the set's bucket (owners, counts, tokens, sets): shingles that several sets have, and in how many."""
    held = rows.sparkSession.sparkContext.broadcast(hot)

    def run(group: pa.Table) -> pa.Table:
        owner, token = unpacked(group, tokens=np.uint64)
        order = np.lexsort((owner, token))
        owner, token = owner[order], token[order]
        once = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])
        owner, token = owner[once], token[once]
        new = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sets = np.repeat(np.diff(np.append(new, len(token))), np.diff(np.append(new, len(token)))).astype(np.int32)
        if len(held.value):
            sets[np.isin(token, held.value)] = LAST
        some = sets > 1
        out = [(b, o, c, *v) for b, o, c, v in packed(owner[some], owner[some] % buckets, token[some], sets[some])]
        names = ("bucket", "owners", "counts", "tokens", "sets")
        kinds = (pa.int64(), *[pa.binary()] * 4)
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)

    return rows.groupBy("bucket").applyInArrow(run, "bucket long, owners binary, counts binary, tokens binary, sets binary")


def short_lists(rows: DataFrame, sizes: DataFrame, buckets: int, percent: int = PERCENT) -> DataFrame:
    """(key, doc): of each set (doc) the short lists (key, a shingle's hash) that may have others; ``sizes``: set, n, m."""

    def run(group: pa.Table, of: pa.Table) -> pa.Table:
        owner, token, sets = unpacked(group, tokens=np.uint64, sets=np.int32)
        order = np.lexsort((token, sets, owner))
        owner, token = owner[order], token[order]
        new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
        length = np.diff(np.append(new, len(owner)))
        set_, n, m = (of.column(c).to_numpy() for c in ("set", "n", "m"))
        by = np.argsort(set_)
        at = by[np.searchsorted(set_[by], owner[new])] if len(new) else np.zeros(0, int)
        # Shingles of no other set come first.
        short = (n[at] - required(n[at], percent) + 1) - (m[at] - length)
        place = np.arange(len(owner)) - np.repeat(new, length)
        taken = place < np.repeat(short, length)
        return pa.table([pa.array(token[taken].view(np.int64)), pa.array(owner[taken])], names=["key", "doc"])

    of = sizes.withColumn("bucket", F.pmod("set", F.lit(buckets)))
    return rows.groupBy("bucket").cogroup(of.groupBy("bucket")).applyInArrow(run, "key long, doc long")


class Lists:
    """Inverted lists of some sets, for T-occurrence searches."""

    def __init__(self, tokens: list[np.ndarray], sizes: np.ndarray, percent: int = PERCENT):
        token = np.concatenate(tokens)
        owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        order = np.argsort(token, kind="stable")
        self.owner, token = owner[order], token[order]
        self.start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        self.key, self.end = token[self.start], np.append(self.start[1:], len(token))
        self.sizes, self.percent = sizes, percent

    def search(self, tokens: np.ndarray, n: int) -> np.ndarray:
        """Which sets link with one of ``n`` shingles."""
        at = np.searchsorted(self.key, tokens)
        at = at[at < len(self.key)] if len(at) and at[-1] == len(self.key) else at
        at = at[self.key[at] == tokens[: len(at)]]
        least = int(required(n, self.percent))
        if len(at) < least:
            return np.zeros(0, np.int64)
        length = self.end[at] - self.start[at]
        at = at[np.argsort(length, kind="stable")]
        total = np.concatenate([[0], np.cumsum(np.sort(length))])
        # Entries to merge, and probes of the sets that may occur often enough, by how many lists are set aside.
        aside = np.arange(least)
        merged = total[len(at) - aside]
        long = int(np.argmin(merged + merged / (least - aside) * aside * 2))
        found, times = self._occurring(at[: len(at) - long], least - long)
        for k in at[len(at) - long :]:
            own = self.owner[self.start[k] : self.end[k]]
            place = np.searchsorted(own, found)
            times = times + ((place < len(own)) & (own[np.minimum(place, len(own) - 1)] == found))
        return found[100 * times >= self.percent * (n + self.sizes[found] - times)]

    def _occurring(self, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets in at least ``least`` of the lists ``at``, and in how many."""
        lists = [self.owner[self.start[k] : self.end[k]] for k in at]
        if sum(map(len, lists)) > HEAP:
            times = np.bincount(np.concatenate(lists), minlength=len(self.sizes))
            found = np.flatnonzero(times >= least)
            return found, times[found]
        found, times, last, count = [], [], -1, 0
        for o in [*heapq.merge(*[x.tolist() for x in lists]), -1]:
            if o == last:
                count += 1
                continue
            if count >= least:
                found.append(last)
                times.append(count)
            last, count = o, 1
        return np.array(found, np.int64), np.array(times, np.int64)


def joining(tokens: list[np.ndarray], sizes: np.ndarray, classes: np.ndarray, side: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between the sets of two sides, or within one, that join ``classes``: after them, linked sets are of one class."""
    apart = bool((side != side[0]).any())
    members = [np.flatnonzero(side == s) for s in (False, True)] if apart else [np.arange(len(tokens))] * 2
    lists = [Lists([tokens[k] for k in own], sizes[own], percent) for own in (members if apart else members[:1])]
    _, classes = np.unique(classes, return_inverse=True)
    waiting = np.ones(len(tokens), bool)
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
        other = int(not side[q]) if apart else 0
        linked = members[other][lists[other if apart else 0].search(tokens[q], int(sizes[q]))]
        for c in linked.tolist():
            if classes[c] != classes[q]:
                classes[classes == classes[c]] = classes[q]
                out.append((q, c))


def searched(groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) of ``groups`` (of: array of set, class, side, n, tokens)."""

    def make():
        def several(groups):
            out = []
            for of in groups:
                sets = [m["set"] for m in of]
                found = joining([np.frombuffer(m["tokens"], np.uint64) for m in of], np.array([m["n"] for m in of]), np.array([m["class"] for m in of]), np.array([m["side"] for m in of], bool), percent)
                out += [(sets[a], sets[b]) for a, b in found]
            return out

        return several

    return map_slices(groups.select("of"), make, "a long, b long")


def links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that join what links among ``members`` (set, n, tokens, group, parts)."""
    of = F.collect_list(F.struct("set", "class", "side", "n", "tokens")).alias("of")
    dealt = members.withColumn("part", F.pmod(F.xxhash64("set"), F.col("parts")).cast("int"))
    alone = dealt.withColumns({"class": F.col("set"), "side": F.lit(False)}).groupBy("group", "part").agg(of, F.count("*").alias("members")).filter("members > 1")
    within = staged(searched(alone, percent), "links-within")
    large = dealt.filter("parts > 1")
    if large.isEmpty():
        return within
    known = large.join(components(within).withColumnsRenamed({"node": "set", "root": "class"}), "set", "left").withColumn("class", F.coalesce("class", "set"))
    met = known.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("other <> part")
    met = met.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).withColumn("side", F.col("part") == F.col("high"))
    across = met.groupBy("group", "low", "high").agg(of, (F.min("class") != F.max("class")).alias("several")).filter("several")
    return staged(within.unionByName(searched(across, percent)), "links-across")


def joined(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seed = 0
    while True:
        seen = staged(seen_sets(docs, seed), "sets")
        rows = seen.filter("token is null").select("doc_id", "n", "m", "set", "rest")
        sets = rows.filter("doc_id is not null and n > 0").groupBy("set").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.max("m").alias("m"), F.count("*").alias("members"), (F.min("rest") != F.max("rest")).alias("clash"))
        sets = staged(sets, "distinct-sets")
        if sets.filter("clash").isEmpty():
            break
        seed += 1
    whole = sets.agg(F.count("*").alias("sets"), F.coalesce(F.sum("m"), F.lit(0)).alias("postings")).first()
    # Frequent shingles: at most HOT_SHARE times the mean size of a set, and no more than MOST_HOT.
    often = seen.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times")).filter(F.col("times") * HOT_SHARE >= whole.sets)
    hot = np.sort(np.array([r.token for r in often.orderBy(F.desc("times"), "token").limit(MOST_HOT).select("token").collect()], np.int64).view(np.uint64))
    buckets = max(64, whole.postings // POSTINGS)
    several = in_several(postings(docs.filter("doc_id is not null"), seed, buckets, hot), buckets, hot)
    lists = staged(short_lists(several, sets.select("set", "n", "m"), buckets, percent), "short-lists")
    total = lists.count()
    pairs = staged(candidates(lists, total), "list-pairs")
    group_of = components(pairs).withColumnsRenamed({"node": "set", "root": "group"})
    group_of = staged(group_of.join(sets.select("set", "first", "m"), "set"), "groups")
    # Merged, not broadcast where few ids would allow it: one plan at every size.
    texts = docs.join(group_of.select(F.col("first").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")

    def make():
        shingles = shared()

        def one(text):
            n, h = shingles(text)
            return number(h, seed)[0], n, h.tobytes()

        return one

    found = map_rows(texts.select("text"), make, "set long, n long, tokens binary")
    sized = staged(group_of.groupBy("group").agg(F.ceil(F.sum("m") / PART).cast("int").alias("parts"), F.count("*").alias("members")), "group-sizes")
    member = joined_by_key(group_of.select("set", "group"), sized, "group", "members", total)
    # One id may have several texts, and they may be equal: each set once.
    one = Window.partitionBy("set").orderBy("n")
    tokens = staged(found.join(member.hint("merge"), "set").withColumn("_k", F.row_number().over(one)).filter("_k = 1").drop("_k"), "group-sets")
    roots = staged(components(links(tokens, percent)).withColumnsRenamed({"node": "set"}), "joined")
    names = staged(roots.join(sets.select("set", "first"), "set").groupBy("root").agg(F.min("first").alias("component"), F.count("*").alias("members")), "joined-names")
    linked = joined_by_key(roots, names, "root", "members", total).select("set", "component")
    class_of = staged(sets.join(linked, "set", "left").select("set", "members", F.coalesce("component", "first").alias("component_id")), "set-components")
    rows_of = rows.filter("doc_id is not null and n > 0")
    out = joined_by_key(rows_of.select("doc_id", F.col("n").alias("n_shingles"), "set"), class_of, "set", "members", whole.sets).select("doc_id", "n_shingles", "component_id")
    return out.unionByName(rows.filter("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))
