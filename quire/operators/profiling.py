"""Probes over spans: size histogram, search by size, keyword blocks, page lists, prefix guesses, dividers, cut points, systematic samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import contains_any, shortened, strip
from quire.operators.intervals import containing

#: The probe's own thresholds, which are not those of the profiles.  Fixed values.
PROBE_CENTRE, PROBE_INDENT, PROBE_FLUSH = 150, 120, 105
PROBE_FOOT, PROBE_WIDTH = 0.6, 50
PROBE_DIVIDERS = ["____", "————"]


def listed_pages(df: DataFrame, numbers: list[int], documents: DataFrame) -> DataFrame:
    """Rows (0-based page) of the listed 1-based pages that ``documents`` (doc_id, n_pages) have."""
    inside = df.filter((F.col("page") + 1).isin(numbers)).join(documents.select("doc_id", "n_pages"), "doc_id")
    return inside.filter((F.col("page") + 1).between(1, F.col("n_pages"))).drop("n_pages")


def sampled_pages(df: DataFrame, step: int = 20) -> DataFrame:
    return df.filter(F.col("page") % step == 0)


def size_histogram(spans: DataFrame, step: int = 20) -> DataFrame:
    """Per rounded size: spans, the longest example (earliest on ties), a guess of what the size is for."""
    some = sampled_pages(spans, step).withColumn("bare", strip("text")).filter("bare <> ''")
    by = F.struct(F.length("bare").alias("a"), (-F.col("doc_id")).alias("b"), (-F.col("page")).alias("c"), (-F.col("line_idx")).alias("d"), (-F.col("span_idx")).alias("e"))
    counted = some.groupBy(F.bround("size", 1).alias("size")).agg(F.count("*").alias("n"), F.max_by("bare", by).alias("example"))
    most = F.max("n").over(Window.partitionBy())  # a row for each size
    guess = F.when(F.col("n") == most, "body").when(F.col("size") < 10, "note").when(F.col("n") < 1000, "heading").otherwise("")
    return counted.withColumn("guess", guess)


def by_size(histogram: DataFrame) -> DataFrame:
    """The histogram from the largest size down, each with its place in the report: few rows, sizes have one decimal."""
    return histogram.withColumn("place", F.row_number().over(Window.orderBy(F.desc("size")))).orderBy("place")


def counted(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """How many results there are for each ``key``."""
    return found.groupBy(key).agg(F.count("*").alias("n"))


def lines_with_size(spans: DataFrame, size: float, tolerance: float = 0.5, shown: int = 80) -> DataFrame:
    """Lines with a span of about ``size``: their text, shortened, and the fonts of those spans."""
    hit = F.abs(F.col("size") - size) <= tolerance
    pieces = F.array_sort(F.collect_list(F.struct("span_idx", "text")))
    lines = spans.groupBy("doc_id", "page", "line_idx").agg(F.array_join(F.transform(pieces, lambda x: x["text"]), "").alias("whole"), F.array_join(F.array_sort(F.collect_set(F.when(hit, F.col("font")))), ", ").alias("fonts"), F.bool_or(hit).alias("hit"))
    return lines.filter("hit").select("doc_id", "page", "line_idx", shortened("whole", shown).alias("line"), "fonts")


def keyword_spans(spans: DataFrame, needle: str) -> DataFrame:
    """Spans of the pages where ``needle`` is in some span, marked where it is in the span itself."""
    pages = spans.filter(F.contains("text", F.lit(needle))).select("doc_id", "page").distinct()
    return spans.join(pages, ["doc_id", "page"], "left_semi").withColumn("has_keyword", F.contains("text", F.lit(needle)))


def keyword_blocks(blocks: DataFrame, needle: str) -> DataFrame:
    """The blocks (doc_id, page, block_idx, text) that hold ``needle``."""
    return blocks.filter(F.contains("text", F.lit(needle)))


def guessed_prefixes(lines: DataFrame) -> DataFrame:
    """``guess`` of each line with text: by its left edge if a font of its spans is bold, else that none is."""
    x0 = F.col("x0")
    bold = F.exists("spans", lambda s: bold_font(s["font"]))
    by_edge = F.when(x0 >= PROBE_CENTRE, "### ").when(x0 >= PROBE_INDENT, "> ").when(x0 > PROBE_FLUSH, "> ?").otherwise("body")
    text = F.array_join(F.transform("spans", lambda s: s["text"]), "")
    return lines.filter(strip(text) != "").withColumn("has_heiti", bold).withColumn("guess", F.when(F.col("has_heiti"), by_edge).otherwise("not bold"))


def divider_candidates(pages: DataFrame, blocks: DataFrame, drawings: DataFrame) -> DataFrame:
    """(doc_id, page, y0, kind): wide drawings in the page's foot, and blocks with a divider's signs."""
    drawn = drawings.join(pages.select("doc_id", "page", "height"), ["doc_id", "page"]).filter((F.col("y0") > F.col("height") * PROBE_FOOT) & (F.col("x1") - F.col("x0") > PROBE_WIDTH))
    signs = blocks.filter(contains_any("text", PROBE_DIVIDERS))
    return drawn.select("doc_id", "page", "y0", F.lit("rule").alias("kind")).unionByName(signs.select("doc_id", "page", "y0", F.lit("text").alias("kind")))


def bold_font(font: str | Column) -> Column:
    return F.lower(F.col(font) if isinstance(font, str) else font).rlike("hei|bold")


def parts(cuts: DataFrame, documents: DataFrame) -> DataFrame:
    """Half-open page ranges between cut points (doc_id, 1-based page); empty ones are left out.

    Names begin with the ``stem`` of ``documents``, where they have one.
    """
    named = "stem" in documents.columns
    documents = documents.select("doc_id", "n_pages", *(["stem"] if named else []))
    inner = cuts.join(documents, "doc_id").select("doc_id", (F.col("page") - 1).alias("lo"), "n_pages").filter("lo > 0 and lo < n_pages").select("doc_id", "lo").distinct()
    bounds = inner.unionByName(documents.select("doc_id", F.lit(0).alias("lo")))
    w = Window.partitionBy("doc_id").orderBy("lo")
    ranged = bounds.withColumns({"part": F.row_number().over(w), "hi": F.lead("lo").over(w)}).join(documents, "doc_id").withColumn("hi", F.coalesce("hi", "n_pages"))
    name = F.format_string("part%d_p%d-p%d", "part", F.col("lo") + 1, F.col("hi"))
    return ranged.filter("lo < hi").select("doc_id", "part", "lo", "hi", (F.concat("stem", F.lit("_"), name) if named else name).alias("name"))


def split_pages(pages: DataFrame, cuts: DataFrame, documents: DataFrame) -> DataFrame:
    """``pages`` (doc_id, 0-based page and more) with the ``part`` and ``name`` of the range that they are in."""
    ranges = parts(cuts, documents).select("doc_id", F.col("lo").alias("_first"), (F.col("hi") - 1).alias("_last"), "part", "name")
    return containing(pages, ranges, ["doc_id"], "page", "_first", "_last").drop("_first", "_last")
