"""Lines from spans: features, prefix, inline style, note references; page regions.

``spans``: doc_id, page, line_idx, span_idx, text, size, font, flags, x0, y0.
Everything about one line is done on its array of spans, so lines need one
aggregation and no window but that which numbers references over an article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import BLANK, GLYPHS, is_cjk, normalized_heading, strip, without_page_markers
from quire.profiles import SETTINGS, TOLERANCE, Profile, Settings

GLYPH = f"[{GLYPHS[0]}-{GLYPHS[-1]}]"
DIVIDER = "[—_]{8,}"


def nearest_prefix(size: Column, profile: Settings) -> Column:
    """Prefix of the nearest mapped size if closer than the tolerance, else empty; the earlier wins a tie."""
    if not isinstance(profile, Profile):
        near = F.array_min(F.transform(profile.fonts, lambda f, k: F.struct(F.abs(size - f["size"]).alias("d"), k.alias("k"), f["prefix"].alias("prefix"))))
        return F.when(near["d"] < TOLERANCE, near["prefix"]).otherwise("")
    found = F.array_min(F.array(*[F.struct(F.abs(size - s).alias("d"), F.lit(k).alias("k"), F.lit(p).alias("prefix")) for k, (s, p) in enumerate(profile.fonts)]))
    return F.when(found["d"] < TOLERANCE, found["prefix"]).otherwise("")


def lines(spans: DataFrame) -> DataFrame:
    """One row per line with its spans in order."""
    one = F.struct("span_idx", "text", "size", "font", "flags")
    return spans.groupBy("doc_id", "page", "line_idx").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.array_sort(F.collect_list(one)).alias("spans"))


def with_features(rows: DataFrame, profile: Settings) -> DataFrame:
    """Largest size and which font families occur, a span counting for the first family that fits it."""
    font = lambda s: F.lower(s["font"])
    fang = lambda s: F.contains(font(s), F.lit("fang"))
    kai = lambda s: ~fang(s) & F.contains(font(s), F.lit("kai"))
    hei = lambda s: ~fang(s) & ~F.contains(font(s), F.lit("kai")) & font(s).rlike("hei|bold")
    size = F.array_max(F.transform("spans", lambda s: s["size"]))
    rows = rows.withColumns({"max_size": size, "has_fangsong": F.exists("spans", fang), "has_kaiti": F.exists("spans", kai), "has_heiti": F.exists("spans", hei)})
    return rows.withColumn("mapped", nearest_prefix(F.col("max_size"), profile))


def with_prefix(rows: DataFrame, profile: Settings) -> DataFrame:
    mapped = F.col("mapped")
    prefix = (
        F.when(F.startswith(mapped, F.lit("#")), mapped).when(F.col("has_heiti") & (F.col("x0") > profile.centre), "### ")
        .when(F.col("has_fangsong"), "> ").when((mapped == "> ") & ~F.col("has_kaiti") & ~F.col("has_heiti"), "> ").otherwise("")
    )
    return rows.withColumn("prefix", prefix)


def styled(text: Column, flags: Column, font: Column) -> Column:
    """Emphasis around the text's core; its outer blanks stay outside."""
    bold = (flags.bitwiseAND(16) != 0) | F.lower(font).rlike("hei|bold")
    italic = (flags.bitwiseAND(2) != 0) | F.contains(F.lower(font), F.lit("kai"))
    mark = F.when(bold & italic, "***").when(bold, "**").when(italic, "*").otherwise("")
    core = strip(text)
    lead, tail = F.regexp_extract(text, f"^{BLANK}*", 0), F.regexp_extract(text, f"{BLANK}*$", 0)
    return F.when((core == "") | (mark == ""), text).otherwise(F.concat(lead, mark, core, mark, tail))


def referenced(text: Column, before: Column) -> Column:
    """Circled digits become note references numbered from ``before`` + 1."""
    pieces = F.split(text, GLYPH, -1)
    return F.array_join(F.transform(pieces, lambda p, k: F.when(k == 0, p).otherwise(F.concat(F.lit("[^"), (before + k).cast("string"), F.lit("]"), p))), "")


def with_references(rows: DataFrame) -> DataFrame:
    """``n_refs`` of each body line and ``refs_before`` it in its article."""
    w = Window.partitionBy("doc_id").orderBy("page", "line_idx").rowsBetween(Window.unboundedPreceding, -1)
    raw = F.array_join(F.transform("spans", lambda s: s["text"]), "")
    rows = rows.withColumn("n_refs", F.regexp_count(raw, F.lit(GLYPH)))
    return rows.withColumn("refs_before", F.coalesce(F.sum("n_refs").over(w), F.lit(0)))


def reference_counts(spans: DataFrame) -> DataFrame:
    """Lines with ``n_refs`` and ``refs_before`` as ``with_references`` has them, where no text is asked for: none is shuffled."""
    spans = spans.withColumn("_n", F.regexp_count("text", F.lit(GLYPH)))
    rows = spans.groupBy("doc_id", "page", "line_idx").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("int").alias("n_refs"))
    w = Window.partitionBy("doc_id").orderBy("page", "line_idx").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("refs_before", F.coalesce(F.sum("n_refs").over(w), F.lit(0)))


def with_text(rows: DataFrame, profile: Settings, strict: bool = False) -> DataFrame:
    """``text``: the line as Markdown with its prefix.  ``strict`` loses what follows an inserted break in a numbered heading.

    Spans go through a few projections of their array, each computing a thing once; only where breaks fall is a fold.
    """
    if isinstance(profile, Profile):
        exact = lambda size: size.isin([s for s, p in profile.fonts if p.startswith("#")])
    else:
        exact = lambda size: F.exists(profile.fonts, lambda f: F.startswith(f["prefix"], F.lit("#")) & (f["size"] == size))
    prefix = F.col("prefix")
    head = F.startswith(prefix, F.lit("#"))
    no_split = (prefix == "### ") | (prefix.isin("# ", "## ") & F.lit(profile.heading_continues))
    each = lambda f: F.transform("_s", f)
    struct = lambda **columns: F.struct(*[c.alias(k) for k, c in columns.items()])
    bold = lambda s: (s["flags"].bitwiseAND(16) != 0) | F.lower(s["font"]).rlike("hei|bold")
    italic = lambda s: (s["flags"].bitwiseAND(2) != 0) | F.contains(F.lower(s["font"]), F.lit("kai"))
    emphasis = lambda s: F.when(bold(s) & italic(s), "***").when(bold(s), "**").when(italic(s), "*").otherwise("")

    rows = rows.withColumn("_s", F.transform("spans", lambda s: struct(text=without_page_markers(s["text"]), size=s["size"], emphasis=emphasis(s), n=F.regexp_count(s["text"], F.lit(GLYPH)))))
    rows = rows.withColumn("_s", F.filter("_s", lambda s: s["text"] != ""))
    rows = rows.withColumn("_s", each(lambda s: struct(text=s["text"], bare=strip(s["text"]), emphasis=s["emphasis"], n=s["n"], header=exact(s["size"]), subtitle=nearest_prefix(s["size"], profile) == "SUBTITLE")))
    mark = lambda s: (F.length(s["bare"]) == 1) & ~is_cjk(s["bare"]) & ~s["bare"].rlike(r"^[\p{L}\p{N}]$")
    before = lambda k: F.col("refs_before") + F.aggregate(F.slice("_s", 1, k), F.lit(0), lambda a, s: a + s["n"])
    shown = lambda s: F.when(s["subtitle"], F.concat(F.lit("**"), s["bare"], F.lit("**"))).otherwise(s["text"])
    numbered = lambda s, k: F.when(s["n"] > 0, referenced(shown(s), before(k))).otherwise(shown(s))
    rows = rows.withColumn("_s", F.transform("_s", lambda s, k: struct(text=numbered(s, k), emphasis=s["emphasis"], subtitle=s["subtitle"], mark=mark(s), header=s["header"], joins=s["bare"].rlike(f"^({GLYPH}|[0-9]+)$"))))
    rows = rows.withColumn("_s", each(lambda s: struct(text=s["text"], core=F.when(head | (s["emphasis"] == ""), "").otherwise(strip(s["text"])), emphasis=s["emphasis"], subtitle=s["subtitle"], mark=s["mark"], header=s["header"], joins=s["joins"])))
    around = lambda s: F.concat(F.regexp_extract(s["text"], f"^{BLANK}*", 0), s["emphasis"], s["core"], s["emphasis"], F.regexp_extract(s["text"], f"{BLANK}*$", 0))
    rows = rows.withColumn("_s", each(lambda s: struct(text=F.when(s["core"] == "", s["text"]).otherwise(around(s)), subtitle=s["subtitle"], mark=s["mark"], header=s["header"], joins=s["joins"])))

    start = struct(done=F.lit(""), header=head)

    def step(acc: Column, s: Column) -> Column:
        cut = acc["header"] & ~s["header"] & ~s["mark"] & ~no_split & ~s["joins"]
        later = s["subtitle"] & ((acc["done"] != "") | (prefix != "")) & ~F.endswith(acc["done"], F.lit("\n"))
        return struct(done=F.concat(acc["done"], F.when(cut | later, "\n\n").otherwise(""), s["text"]), header=F.when(s["mark"], acc["header"]).otherwise(s["header"]))

    rows = rows.withColumn("_body", F.aggregate("_s", start, step, lambda a: a["done"])).withColumn("_body", strip("_body"))
    content = F.when(F.lit(strict) & F.contains("_body", F.lit("\n")), normalized_heading(F.substring_index("_body", "\n", 1))).otherwise(normalized_heading("_body"))
    text = F.when(head, F.concat(prefix, content)).when(prefix == "> ", F.concat(prefix, F.col("_body"))).otherwise(F.col("_body"))
    return rows.withColumn("text", F.when(F.col("_body") == "", "").otherwise(text)).drop("_body", "_s")


def split_lines(pages: DataFrame, blocks: DataFrame, drawings: DataFrame, profile: Settings) -> DataFrame:
    """(doc_id, page, split_y): where notes begin: a rule or divider, else a continuation mark, else the page's foot.

    With settings by book, ``pages`` and ``blocks`` bring them.
    """
    key = ["doc_id", "page"]
    held = [SETTINGS] if not isinstance(profile, Profile) else []
    by_rule = lambda: drawings.filter("y1 - y0 < 5 and x1 - x0 between 60 and 75").groupBy(*key).agg((F.max("y0") - 2).alias("by_rule"))
    by_text = lambda: blocks.filter((F.col("y0") > profile.top) & F.col("text").rlike(DIVIDER)).select(*key, "block_idx", "y0").groupBy(*key).agg((F.min_by("y0", "block_idx") - 2).alias("by_rule"))
    if held:
        both = by_rule().join(by_text().withColumnRenamed("by_rule", "by_text"), key, "full")
        rule = pages.select(*key, SETTINGS).join(both, key).select(*key, F.when(profile.rule_divides, F.col("by_rule")).otherwise(F.col("by_text")).alias("by_rule"))
    else:
        rule = by_rule() if profile.rule_divides else by_text()
    w = Window.partitionBy(*key).orderBy("block_idx")
    # What a block shows is found before blocks are numbered, so no text goes through that.
    first = blocks.filter(F.col("y0") > profile.detect).select(*key, "block_idx", "y0", F.contains("text", F.lit("接上页")).alias("_mark"))
    mark = first.withColumn("_n", F.row_number().over(w)).filter("_n <= 5").filter("_mark").groupBy(*key).agg((F.min_by("y0", "block_idx") - 1).alias("by_mark"))
    joined = pages.join(rule, key, "left").join(mark, key, "left")
    return joined.select(*key, "height", F.coalesce("by_rule", "by_mark", "height").alias("split_y"))


def with_region(rows: DataFrame, splits: DataFrame, profile: Settings) -> DataFrame:
    """Lines inside the clip, with ``region`` body or note; a rule of blanks or underscores is dropped."""
    clip_end = F.least(F.lit(profile.bottom).cast("double"), F.col("height"))  # without a bottom, the page's height
    kept = rows.join(splits, ["doc_id", "page"]).filter((F.col("y0") >= F.least(F.lit(profile.top), F.col("split_y"))) & (F.col("y0") <= clip_end))
    return kept.withColumn("region", F.when(F.col("y0") >= F.col("split_y"), "note").otherwise("body"))
