"""Document fingerprints: a Merkle tree over word pieces, paragraphs and sections, in DataFrame functions.

A paragraph is a line; its leaves are pieces of up to PIECE_WORDS words with the
blanks around them, so nothing of the text is outside the tree.  A section is
SECTION neighbouring paragraphs.  Each node is the SHA-256 of its children's,
so equal roots mean equal texts, and where roots differ, the differing sections,
paragraphs and leaves locate the edit.  The likeness of two fingerprints is the
Dice coefficient of their sets of leaves.

The query compares each document with an edited text that borrows from the next
document by id.  Documents are dealt into ranges of ids, whose bounds come from
one approximate percentile aggregate; the first document of each range is also
sent to the range before, so ``lead`` finds every next document in one shuffle
of the texts and no task holds more than a range.

Roots are whole digests.  Inner nodes and leaves are written, and leaves compared
for the likeness, by their first SHORT hexadecimal digits.

Null texts are empty: one empty paragraph, one leaf-less section.  Rows without
an id come first; repeated ids follow each other in the order of their texts'
hashes; a table of one row is its own next document; empty tables give no rows.
Texts of any length are read whole.  Other columns are not looked at.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import table

PIECE_WORDS, SECTION, SHORT = 8, 8, 12
RANGE_ROWS, MOST_RANGES = 4000, 8192
PIECE = r"[ \t\r]*(?:[^ \t\r\n]+[ \t\r]*){1,%d}|[ \t\r]+" % PIECE_WORDS
#: The same pieces, without backtracking.
PIECE_FAST = r"[ \t\r]*+(?:[^ \t\r\n]++[ \t\r]*+){1,%d}+|[ \t\r]++" % PIECE_WORDS


def tree(text: Column) -> Column:
    """Struct of leaves per paragraph, and hex nodes of leaves, paragraphs, sections (arrays) and root, by steps; see ``with_tree``."""
    return F.transform(F.split(text, "\n"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE_FAST), F.lit(0)), lambda x: F.sha2(x, 256)))


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: struct of root (hex), sections, paragraphs and leaves (short hex, in order)."""
    leaves, paragraphs, sections = f"_{name}_leaves", f"_{name}_paragraphs", f"_{name}_sections"
    short = lambda c: F.transform(c, lambda x: F.substring(x, 1, SHORT))
    df = df.withColumn(leaves, tree(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumn(paragraphs, F.transform(leaves, lambda p: F.sha2(F.concat(F.lit("p"), F.array_join(p, "")), 256)))
    starts = F.sequence(F.lit(0), F.floor((F.size(paragraphs) - 1) / SECTION).cast("int"))
    df = df.withColumn(sections, F.transform(starts, lambda k: F.sha2(F.concat(F.lit("s"), F.array_join(F.slice(paragraphs, k * SECTION + 1, SECTION), "")), 256)))
    root = F.sha2(F.concat(F.lit("r"), F.array_join(sections, "")), 256)
    df = df.withColumn(name, F.struct(root.alias("root"), short(F.col(sections)).alias("sections"), short(F.col(paragraphs)).alias("paragraphs"), short(F.flatten(leaves)).alias("leaves")))
    return df.drop(leaves, paragraphs, sections)


def fingerprint(name: str) -> Column:
    """The tree as text: root, sections, paragraphs, leaves."""
    return F.concat_ws(":", f"{name}.root", *[F.array_join(f"{name}.{c}", ",") for c in ("sections", "paragraphs", "leaves")])


def likeness(a: str, b: str) -> Column:
    """Dice coefficient of the distinct leaves; equal roots are 1, nothing in common is 0."""
    x, y = F.array_distinct(f"{a}.leaves"), F.array_distinct(f"{b}.leaves")
    total = F.size(x) + F.size(y)
    return F.when(F.col(f"{a}.root") == F.col(f"{b}.root"), 1.0).when(total == 0, 0.0).otherwise(2.0 * F.size(F.array_intersect(x, y)) / total)


def differing(a: str, b: str, level: str) -> Column:
    """Positions (from 0) of the nodes of ``level`` that differ, to the end of the longer tree."""
    n = F.greatest(F.size(f"{a}.{level}"), F.size(f"{b}.{level}"))
    at = lambda t, k: F.coalesce(F.get(f"{t}.{level}", k), F.lit(""))
    return F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda k: at(a, k) != at(b, k))


def with_range(docs: DataFrame, bounds: list[int]) -> DataFrame:
    """Adds ``range``: how many of the ascending ``bounds`` are at most doc_id, counted in two steps."""
    if not bounds:
        return docs.withColumn("range", F.lit(0))
    step = max(1, isqrt(len(bounds)))
    groups = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    below = lambda c: F.size(F.filter(c, lambda b: b <= F.col("doc_id")))
    tops = F.lit([g[0] for g in groups]).cast("array<bigint>")
    nested = F.array(*[F.lit(g).cast("array<bigint>") for g in groups])
    group = below(tops)
    inside = F.when(group == 0, 0).otherwise((group - 1) * step + below(F.element_at(nested, group)))
    return docs.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(inside))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Each row of ``docs`` (doc_id and ``columns``) with ``next_<column>`` of the next row by doc_id, cyclically."""
    count = docs.select("doc_id").count()
    ranges = min(MOST_RANGES, max(1, count // RANGE_ROWS))
    found = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 100 * ranges)).first()[0] if ranges > 1 else None
    docs = with_range(docs, sorted(set(found or []))).withColumn("_order", F.xxhash64(*columns))
    # At most MOST_RANGES + 1 rows.
    every = Window.partitionBy(F.lit(0))
    heads = docs.groupBy("range").agg(F.min(F.struct("doc_id", "_order")).alias("head")).select("range", F.col("head.doc_id").alias("head_id"), F.col("head._order").alias("head_order"))
    heads = heads.withColumn("before", F.coalesce(F.lag("range").over(every.orderBy("range")), F.max("range").over(every)))
    copies = docs.join(F.broadcast(heads), "range").filter("doc_id <=> head_id and _order = head_order")
    names = ["doc_id", "_order", *columns]
    both = docs.select("range", *names, F.lit(0).alias("_copy")).unionByName(copies.select(F.col("before").alias("range"), *names, F.lit(1).alias("_copy")))
    w = Window.partitionBy("range").orderBy("_copy", F.col("doc_id").asc_nulls_first(), "_order")
    return both.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns]).filter("_copy = 0").drop("_copy", "_order", "range")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pairs = with_next(docs, ["text"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - half), F.col("next_text").substr(F.lit(1), half))
    out = with_tree(with_tree(with_tree(pairs.withColumn("edited", edited), "text", "own"), "edited", "other"), "next_text", "next")
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint("own").alias("fingerprint"), fingerprint("other").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"), likeness("own", "next").alias("near_next"), F.size(differing("own", "other", "paragraphs")).cast("long").alias("paragraphs_changed"),
    )


def _tree_sql(text: str, name: str) -> str:
    """DuckDB columns of a tree, in steps of lateral aliases."""
    pieces = "'" + PIECE + "'"
    return f"""
      list_transform(string_split({text}, chr(10)), lambda p: list_transform(regexp_extract_all(p, {pieces}), lambda x: sha256(x))) AS {name}_l,
      list_transform({name}_l, lambda p: sha256('p' || coalesce(array_to_string(p, ''), ''))) AS {name}_p,
      list_transform(range(0, CAST(floor((len({name}_p) - 1) / {SECTION}) AS BIGINT) + 1), lambda k: sha256('s' || array_to_string({name}_p[k * {SECTION} + 1 : k * {SECTION} + {SECTION}], ''))) AS {name}_s,
      sha256('r' || array_to_string({name}_s, '')) AS {name}_r,
      list_transform(flatten({name}_l), lambda x: x[1:{SHORT}]) AS {name}_x"""


def _near_sql(a: str, b: str) -> str:
    return f"CASE WHEN {a}_r = {b}_r THEN 1.0 WHEN len({a}_x) + len({b}_x) = 0 THEN 0.0 ELSE 2.0 * len(list_intersect(list_distinct({a}_x), list_distinct({b}_x))) / (len(list_distinct({a}_x)) + len(list_distinct({b}_x))) END"


def _print_sql(name: str) -> str:
    short = f"list_transform({{}}, lambda x: x[1:{SHORT}])"
    return f"concat_ws(':', {name}_r, array_to_string({short.format(name + '_s')}, ','), array_to_string({short.format(name + '_p')}, ','), coalesce(array_to_string({name}_x, ','), ''))"


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS u, CAST(length(t) AS BIGINT) AS n_chars FROM d),
e AS (SELECT *, substr(t, 1, n_chars - n_chars // 2) || substr(u, 1, n_chars // 2) AS v FROM n),
x AS (SELECT doc_id, n_chars, sha256(v) AS edited_sha256, {_tree_sql('t', 'a')}, {_tree_sql('v', 'b')}, {_tree_sql('u', 'c')} FROM e)
SELECT doc_id, n_chars, edited_sha256, {_print_sql('a')} AS fingerprint, {_print_sql('b')} AS edited_fingerprint,
  CAST({_near_sql('a', 'b')} AS DOUBLE) AS near_edited, CAST({_near_sql('a', 'c')} AS DOUBLE) AS near_next,
  CAST(len(list_filter(range(0, greatest(len(a_p), len(b_p))), lambda k: coalesce(a_p[k + 1][1:{SHORT}], '') <> coalesce(b_p[k + 1][1:{SHORT}], ''))) AS BIGINT) AS paragraphs_changed
FROM x
"""
