"""Personal data: base patterns, and identifiers found by bootstrapped contextual extraction, in DataFrame functions.

Base kinds (email, ip, card, phone) are matched in one pass each; places come
from the lengths of what lies between the matches.  The patterns here are the
plain ones with possessive repeats, and with a look-behind where a failed match
would be tried again inside the same run; they match the same strings, in
linear time.

Bootstrapping.  Candidates are tokens of ID_DIGITS digits at least, handles and
spelled-out mail addresses that overlap no base match.  Lexical patterns of a
base match or candidate are the two words before it; the word before it, and the
word behind it, with the value's shape (digits, letters, signs); and its shape
with the kinds of what is beside it.  Words are in lower case with digits alike;
contexts reach CONTEXT_CHARS characters, so a longer word counts by its near end.

Patterns and the distinct values that they extract form a graph.  Base values
are the seeds.  In each round a pattern's score is known / (known + UNSEEN *
others), since a value that is not known yet speaks less against a pattern than
a known one for it; it counts if SUPPORT values at least are known and the score
is PATTERN_SCORE or more.  A value becomes known if the patterns that extract it
leave a doubt (product of one less their scores) of at most 1 - VALUE_SCORE.
Rounds go on until no value is new.  Candidates whose value is known at the end
are spans of the kind ``id``.  Base spans always stay.

Null texts are empty.  Rows without an id and repeated rows get equal results
each; of equal spans each kind is one, ordered by start and then kind.  Empty
tables give no rows.  Texts of any length are searched whole.  Other columns are
not looked at, or carried, whatever their names.  Only rows of the graph's
patterns and values are shuffled, partly aggregated, never a document's text;
patterns that many values share are joined in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import aside, joined_by_key, staged, table

#: Kinds in the order that ties have, their pattern, and what a text must hold to be searched.
KINDS: list[tuple[str, str, str]] = [
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ""),
    ("card", r"[0-9](?:[ -]?[0-9])++", ""),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+"),
]
ID_DIGITS = 4
#: A token with digits, a handle, a mail address with its signs spelled out.
CANDIDATE = (
    r"(?<![A-Za-z0-9_-])(?=(?:[A-Za-z_-]*+[0-9]){%d})[A-Za-z0-9][A-Za-z0-9_-]{5,}+" % ID_DIGITS
    + r"|(?<![A-Za-z0-9_.@-])@[A-Za-z0-9_]{3,}+"
    + r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]++)++"
)
CONTEXT_CHARS = 48
#: Characters of the pieces that masked texts are cut from.
CHUNK = 1024
SUPPORT, UNSEEN, PATTERN_SCORE, VALUE_SCORE = 5, 0.5, 0.5, 0.6
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
NAMES = [k for k, _, _ in KINDS] + ["id"]


def pieces(text: str, pattern: str, condition: Column, rank: int) -> Column:
    """Matches in order: array of structs (rank, n, value, gap before it, what is beside it)."""
    found = F.when(condition, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    gaps = F.split(F.col(text), pattern, -1)
    beside = lambda v, g, a, k: F.struct(F.lit(rank).alias("rank"), k.alias("n"), v.alias("value"), F.length(g).alias("gap"), F.right(g, F.lit(CONTEXT_CHARS)).alias("before"), F.left(a, F.lit(CONTEXT_CHARS)).alias("after"))
    zipped = F.transform(F.arrays_zip(found.alias("v"), F.slice(gaps, 1, F.size(found)).alias("g"), F.slice(gaps, 2, F.size(found)).alias("a")), lambda x, k: beside(x["v"], x["g"], x["a"], k))
    return F.when(F.size(found) > 0, zipped)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    marks = F.split(F.reverse(digits), "")
    parts = F.transform(marks, lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(rank: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (
        F.when(rank == 1, value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(rank == 2, F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False))
        .when(rank == 3, F.length(digits).between(9, 15))
        .otherwise(True)
    )


def patterns(value: Column, before: Column, after: Column) -> Column:
    """The lexical patterns of a value."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "#")
    left, right = F.regexp_extract(before, r"(\S+)\s*[\"'(\[]*$", 1), F.regexp_extract(after, r"^[\"')\].,;:!]*\s*(\S+)", 1)
    two = F.regexp_replace(F.regexp_extract(before, r"(\S+\s+\S+)\s*[\"'(\[]*$", 1), r"\s+", " ")
    shape = F.regexp_replace(F.regexp_replace(value, "[A-Za-z]+", "a"), "[0-9]", "#")
    kind = lambda c: F.when(c == "", "none").when(c.rlike(r"^\p{L}"), "word").when(c.rlike("^[0-9]"), "number").otherwise("sign")
    made = F.array(
        F.when(two != "", F.concat(F.lit("two "), plain(two))), F.when(left != "", F.concat_ws(" ", F.lit("left"), plain(left), shape)),
        F.when(right != "", F.concat_ws(" ", F.lit("right"), shape, plain(right))), F.concat_ws(" ", F.lit("shape"), kind(left), shape, kind(right)),
    )
    return F.filter(made, lambda p: p.isNotNull())


def matches(docs: DataFrame) -> DataFrame:
    """One row per base match and candidate of ``docs`` (_row, text and more): rank, first, last (end), value, patterns."""
    digit = F.col("text").rlike("[0-9]")
    spelled = F.contains("text", F.lit("@")) | F.contains("text", F.lit("at]")) | F.contains("text", F.lit("at)"))
    arrays = [pieces("text", p, F.contains("text", F.lit(needs)) if needs else digit, k) for k, (_, p, needs) in enumerate(KINDS)]
    arrays.append(pieces("text", CANDIDATE, digit | spelled, len(KINDS)))
    # One column for each kind: a text without a kind's mark is not searched for it.
    wide = docs.select("*", *[a.alias(f"_m{k}") for k, a in enumerate(arrays)])
    empty = F.array().cast("array<struct<rank:int,n:int,value:string,gap:int,before:string,after:string>>")
    rows = wide.select("_row", *[c for c in docs.columns if c not in ("_row", "text")], F.explode(F.concat(*[F.coalesce(f"_m{k}", empty) for k in range(len(arrays))])).alias("m")).select("*", "m.*").drop("m")
    w = Window.partitionBy("_row", "rank").orderBy("n")
    rows = rows.withColumn("last", F.sum(F.col("gap") + F.length("value")).over(w)).withColumn("first", F.col("last") - F.length("value"))
    return rows.filter(valid(F.col("rank"), F.col("value"))).withColumn("patterns", patterns(F.col("value"), F.col("before"), F.col("after"))).drop("before", "after", "gap", "n")


def apart(rows: DataFrame) -> DataFrame:
    """Drops candidates that overlap a base match of their text."""
    is_base = F.col("rank") < len(KINDS)
    w = Window.partitionBy("_row").orderBy("first", "rank")
    reach = F.max(F.when(is_base, F.col("last"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    # The other way round, since a frame up to the end is gone through again for each row.
    back = Window.partitionBy("_row").orderBy(F.desc("first"), F.desc("rank"))
    ahead = F.min(F.when(is_base, F.col("first"))).over(back.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("*", reach.alias("_reach"), ahead.alias("_ahead")).filter(is_base | (F.coalesce(F.col("_reach") <= F.col("first"), F.lit(True)) & F.coalesce(F.col("_ahead") >= F.col("last"), F.lit(True)))).drop("_reach", "_ahead")


def bootstrap(rows: DataFrame) -> DataFrame:
    """Values (distinct) that the graph of patterns and values makes known beyond the seeds."""
    is_seed = F.col("rank") < len(KINDS)
    edges = rows.select(F.explode("patterns").alias("pattern"), "value", is_seed.cast("int").alias("seed")).groupBy("pattern", "value").agg(F.max("seed").alias("seed"))
    edges = staged(edges, "pii-edges")
    # Patterns of fewer than SUPPORT values never count, in any round.
    enough = staged(edges.groupBy("pattern").agg(F.count("*").alias("members")).filter(F.col("members") >= SUPPORT), "pii-patterns")
    graph = staged(joined_by_key(edges, enough, "pattern", "members", edges.count()), "pii-graph")
    total = graph.count()
    known = staged(graph.filter("seed = 1").select("value").distinct(), "pii-known")
    while True:
        # A value found in a round is known in the next.
        counted = graph.join(known.withColumn("now", F.lit(1)), "value", "left").groupBy("pattern").agg(F.count("now").alias("n"), F.count("*").alias("members"))
        score = F.col("n") / (F.col("n") + UNSEEN * (F.col("members") - F.col("n")))
        scored = staged(counted.withColumn("score", score).filter((F.col("n") >= SUPPORT) & (F.col("score") >= PATTERN_SCORE)).select("pattern", "members", "score"), "pii-scores")
        doubt = joined_by_key(graph.select("pattern", "value"), scored, "pattern", "members", total).groupBy("value").agg(F.sum(F.log(F.greatest(F.lit(1e-12), 1 - F.col("score")))).alias("doubt"))
        found = staged(doubt.filter(F.exp("doubt") <= 1 - VALUE_SCORE).select("value").join(known, "value", "left_anti"), "pii-found")
        if found.isEmpty():
            return known
        known = known.unionByName(found)


def spans(docs: DataFrame, key: list[str]) -> DataFrame:
    """One row per ``key`` with a match: arrays ``base`` and ``every`` of structs (first, rank, last), in order."""
    with_row = docs.withColumn("_row", F.monotonically_increasing_id())
    rows = staged(apart(matches(with_row.select("_row", *key, "text"))).drop("_row"), "pii-matches")
    new = bootstrap(rows)
    is_base = F.col("rank") < len(KINDS)
    base = rows.filter(is_base).select(*key, "rank", "first", "last")
    found = rows.filter(~is_base).join(new, "value", "left_semi").select(*key, "rank", "first", "last")
    one = F.struct("first", "rank", "last")
    both = base.unionByName(found).groupBy(*key).agg(F.sort_array(F.collect_set(one)).alias("every"))
    return both.withColumn("base", F.filter("every", lambda s: s["rank"] < len(KINDS)))


def as_text(column: str) -> Column:
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["first"].cast("string"), s["last"].cast("string"))), ",")


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and more) with ``base`` and ``every``; rows without a match have empty arrays."""
    keyed = docs.withColumn("_hash", F.xxhash64("text")).withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = spans(keyed.select("_id", "_hash", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), ["_id", "_hash"])
    empty = F.array().cast("array<struct<first:bigint,rank:int,last:bigint>>")
    return keyed.join(found, ["_id", "_hash"], "left").withColumn("base", F.coalesce("base", empty)).withColumn("every", F.coalesce("every", empty)).drop("_id", "_hash")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though a function over an array's elements uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def part(values: Column, first: Column, count: Column) -> Column:
    """``count`` elements from place ``first`` (from 0), in time that grows with ``count``; ``slice`` copies the whole array."""
    last = F.least(first + count, F.size(values)) - 1
    return F.when(last >= first, F.transform(F.sequence(first, last), lambda k: F.get(values, k)))


def masked(text: Column, every: Column) -> Column:
    """``text`` with each span replaced by its kind in angle brackets; spans that overlap are replaced as one.

    ``every`` is ordered by start and then kind.  A span opens a group if no earlier one reaches beyond its start; a
    group ends where the spans before the next one's first reach.  What lies between groups is cut from pieces of
    CHUNK characters, so that no cut counts from the text's start, and all is joined once.
    """
    names = F.array(*[F.lit(f"<{n}>") for n in NAMES])

    def opened(last: Column, width: Column) -> Column:
        """Structs (first, rank, reach of all before) of the spans that open a group; reach by blocks of ``width`` spans."""
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(last) / width).cast("int") - 1), lambda j: F.array_max(part(last, j * width, width)))
        before = let(blocks, lambda tops: F.transform(tops, lambda _, j: F.array_max(part(tops, F.lit(0), j))))
        block = lambda k: F.floor(k / width).cast("int")
        reach = lambda high, k: F.greatest(F.get(high, block(k)), F.array_max(part(last, block(k) * width, k - block(k) * width)))
        with_reach = let(before, lambda high: F.transform(every, lambda x, k: F.struct(x["first"].alias("first"), x["rank"].alias("rank"), reach(high, k).alias("reach"))))
        return F.filter(with_reach, lambda x: x["reach"].isNull() | (x["reach"] <= x["first"]))

    def joined(chunks: Column, last: Column) -> Column:
        piece = lambda at: F.floor(at / CHUNK).cast("int")
        around = lambda a, b: F.coalesce(F.array_join(part(chunks, piece(a), piece(b) - piece(a) + 1), ""), F.lit(""))
        between = lambda a, b: F.substring(around(a, b), (a - piece(a) * CHUNK).cast("int") + 1, (b - a).cast("int"))
        start = lambda x: F.coalesce(x["reach"], F.lit(0).cast("long"))
        groups = opened(last, F.ceil(F.sqrt(F.size(last))).cast("int"))
        shown = F.transform(groups, lambda x: F.concat(between(start(x), x["first"]), F.element_at(names, x["rank"] + 1)))
        end = F.array_max(last)
        return F.concat(F.array_join(shown, ""), between(end, F.greatest(end, F.size(chunks) * F.lit(CHUNK).cast("long"))))

    chunks = F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}" % CHUNK), F.lit(0))
    found = let(chunks, lambda c: let(F.transform(every, lambda x: x["last"]), lambda last: joined(c, last)))
    return F.when(F.size(every) == 0, text).otherwise(found)


def without_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with spans replaced by their kinds and n_chars to match; null texts stay null."""
    inner, back = aside(docs)
    return back(with_spans(inner).withColumn("text", masked(F.col("text"), F.col("every"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, (name, _, _) in enumerate(KINDS)]
    return with_spans(docs).select("doc_id", *counts, F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("every").alias("spans"))
