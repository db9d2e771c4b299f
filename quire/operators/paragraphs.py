"""Paragraphs, notes and articles from formatted lines, in closed form over windows.

``rows``: doc_id, page, ord (reading order in the article), text, raw, x0, and
optionally is_image.  The state "the open paragraph is a quote" before a line is
the kind of the last line before it that must have opened or decided one.  All
windows have one partitioning and order, so Spark plans one exchange and sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quire.functions.text import BLANK, is_cjk, strip, without_page_markers
from quire.operators.layout import DIVIDER, GLYPH
from quire.operators.reflow import joined
from quire.profiles import Settings

HEADING = r"^#+[\t-\r\x1c-\x20\x85\p{Z}]"


def in_order() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("ord")


def indented(raw: Column, x0: Column, profile: Settings) -> Column:
    return (x0 > profile.indent) | F.startswith(raw, F.lit("　")) | F.startswith(raw, F.lit("  "))


def with_islands(rows: DataFrame, profile: Settings, strict: bool = False) -> DataFrame:
    """``is_new`` and ``island`` of each line that has text and is no divider; ``strict`` glues text on to an image."""
    rows = rows.filter((F.col("text") != "") & ~F.col("text").rlike(DIVIDER))
    image = F.col("is_image") if "is_image" in rows.columns else F.lit(False)
    # What a line shows by itself is found before the exchange, so ``raw`` need not go through it.
    rows = rows.withColumns({"_heading": F.startswith("text", F.lit("#")) & ~image, "_quote": F.startswith("text", F.lit("> ")), "_indent": indented(F.col("raw"), F.col("x0"), profile)})
    last_heading = F.coalesce(F.when(F.lag("page").over(in_order()) == F.col("page"), F.lag("_heading").over(in_order())), F.lit(False))
    heading = ~(last_heading & F.lit(profile.heading_continues))
    note = F.col("text").rlike(f"^{BLANK}*" + r"\[\^[0-9]+\]")
    rows = rows.withColumns({"_first": F.row_number().over(in_order()) == 1, "_base": F.when(image, True).when(note, False).when(F.col("_heading"), heading).otherwise(F.col("_indent"))})
    if not strict and "is_image" in rows.columns:
        rows = rows.withColumn("_base", F.col("_base") | F.coalesce(F.lag("is_image").over(in_order()), F.lit(False)))
    decides = F.col("_base") | F.col("_quote") | F.col("_first")
    state = F.coalesce(F.last(F.when(decides, F.col("_quote")), ignorenulls=True).over(in_order().rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    rows = rows.withColumn("is_new", F.col("_first") | F.col("_base") | (F.col("_quote") & ~state))
    return rows.withColumn("island", F.sum(F.col("is_new").cast("int")).over(in_order())).drop("_heading", "_quote", "_indent", "_first", "_base")


def with_pieces(rows: DataFrame, profile: Settings) -> DataFrame:
    """``piece`` and the ``separator`` before it: continued quotes and headings lose their marks, emphasis fuses between CJK."""
    lead = F.last(F.when(F.col("is_new"), F.col("text")), ignorenulls=True).over(in_order())  # the island's first line
    text, later = F.col("text"), ~F.col("is_new")
    quote = later & F.startswith(text, F.lit("> ")) & F.startswith(lead, F.lit("> "))
    bare = F.when(quote, F.substr(text, F.lit(3)))
    bare = bare.when(F.lit(profile.heading_continues) & later & text.rlike(HEADING) & lead.rlike(HEADING), F.regexp_replace(text, f"^#+{BLANK}*", ""))
    rows = rows.withColumn("bare", bare.otherwise(text))
    w = in_order()
    here, prev = F.col("bare"), F.when(~F.col("is_new"), F.lag("bare").over(w))
    after = F.when(~F.lead("is_new").over(w), F.lead("bare").over(w))

    def seam(a: Column, b: Column) -> Column:
        """How many marks each side of a seam loses."""
        bold = F.endswith(a, F.lit("**")) & F.startswith(b, F.lit("**"))
        thin = ~bold & F.endswith(a, F.lit("*")) & F.startswith(b, F.lit("*")) & ~F.endswith(a, F.lit("**")) & ~F.startswith(b, F.lit("**"))
        inner = lambda n: is_cjk(F.substring(F.right(a, F.lit(n + 1)), 1, 1)) & is_cjk(F.substring(b, n + 1, 1)) & (F.length(a) > n)
        return F.coalesce(F.when(bold & inner(2), 2).when(thin & inner(1), 1), F.lit(0))

    head, tail = seam(prev, here), seam(here, after)
    close = (head > 0) | (is_cjk(F.right(prev, F.lit(1))) & is_cjk(F.left(here, F.lit(1))))
    rows = rows.withColumns({"_head": head, "_tail": tail, "separator": F.when(F.col("is_new") | close, "").otherwise(" ")})
    return rows.withColumn("piece", F.substring(here, F.col("_head") + 1, F.greatest(F.lit(0), F.length(here) - F.col("_head") - F.col("_tail")))).drop("_head", "_tail")


def paragraphs(pieces: DataFrame) -> DataFrame:
    """(doc_id, island, paragraph)."""
    return pieces.groupBy("doc_id", "island").agg(joined(F.col("ord"), F.concat("separator", "piece"), "").alias("paragraph"))


def merged_quotes(paras: DataFrame) -> DataFrame:
    """Neighbouring quotes become one block."""
    w = Window.partitionBy("doc_id").orderBy("island")
    quote = F.startswith("paragraph", F.lit("> "))
    rows = paras.withColumn("_q", quote)
    rows = rows.withColumn("block", F.sum((~(F.col("_q") & F.coalesce(F.lag("_q").over(w), F.lit(False)))).cast("int")).over(w))
    return rows.groupBy("doc_id", "block").agg(joined(F.col("island"), F.col("paragraph"), "\n>\n").alias("paragraph"))


def page_references(body: DataFrame) -> DataFrame:
    """(doc_id, page, k, note_id): the k-th reference of a page, from lines with n_refs and refs_before."""
    w = Window.partitionBy("doc_id").orderBy("page", "refs_before")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = body.filter("n_refs > 0").select("doc_id", "page", "refs_before", "n_refs")
    rows = rows.withColumns({"_sum": F.coalesce(F.sum("n_refs").over(before), F.lit(0)), "_opens": ~F.col("page").eqNullSafe(F.lag("page").over(w)) | (F.row_number().over(w) == 1)})
    rows = rows.withColumn("_k", F.col("_sum") - F.last(F.when(F.col("_opens"), F.col("_sum")), ignorenulls=True).over(w))
    ids = rows.select("doc_id", "page", "_k", F.posexplode(F.sequence(F.col("refs_before") + 1, F.col("refs_before") + F.col("n_refs"))).alias("_at", "note_id"))
    return ids.select("doc_id", "page", "note_id", (F.col("_k") + F.col("_at") + 1).alias("k"))


def paired_notes(notes: DataFrame, references: DataFrame) -> DataFrame:
    """Note lines (doc_id, page, ord, raw, x0) with their reference's id in place of the mark; ``[^x]`` where there is none.

    A page's references are one row before its lines, so lines meet them in a window over the article and are dealt once.
    ``wide``: the line begins with a wide blank.
    """
    rows = notes.withColumn("text", strip(without_page_markers("raw"))).filter((F.col("text") != "") & ~F.col("text").rlike(DIVIDER))
    rows = rows.withColumns({"is_mark": F.col("text").rlike(f"^{GLYPH}"), "wide": F.startswith("raw", F.lit("　")), "_ids": F.lit(None).cast("array<bigint>")})
    ids = F.transform(F.array_sort(F.collect_list(F.struct("k", "note_id"))), lambda r: r["note_id"].cast("bigint"))
    heads = references.groupBy("doc_id", "page").agg(ids.alias("_ids"))
    w = Window.partitionBy("doc_id").orderBy("page", F.col("_ids").isNull(), "ord")
    # A union of dealt tables may claim a partitioning that it does not have when it runs, and give wrong notes silently; so it is dealt here.
    rows = rows.unionByName(heads, allowMissingColumns=True).repartition("doc_id").withColumn("_marks", F.coalesce(F.sum(F.col("is_mark").cast("int")).over(w), F.lit(0)))
    rows = rows.withColumn("_head", F.last(F.when(F.col("_ids").isNotNull(), F.struct("page", "_ids", "_marks")), ignorenulls=True).over(w)).filter(F.col("_ids").isNull())
    found = F.when((F.col("_head.page") == F.col("page")) & F.col("doc_id").isNotNull(), F.get(F.col("_head._ids"), (F.col("_marks") - F.col("_head._marks") - 1).cast("int")))
    label = F.concat(F.lit("[^"), F.coalesce(found.cast("string"), F.lit("x")), F.lit("]: "))
    return rows.withColumn("text", F.when(F.col("is_mark"), F.concat(label, F.substr("text", F.lit(2)))).otherwise(F.col("text"))).drop("_ids", "_marks", "_head")


def note_islands(notes: DataFrame, profile: Settings, by: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, note, text): a mark opens a note, so do indents in some books; other lines are glued on, over pages too.

    ``by``: columns that, beside the article, tell copies of its lines apart.
    """
    w = Window.partitionBy("doc_id", *by).orderBy("ord")
    wide = F.col("wide") if "wide" in notes.columns else F.startswith("raw", F.lit("　"))
    new = F.col("is_mark") | (F.lit(profile.indent_opens_note) & ((F.col("x0") > profile.indent) | wide))
    first = F.row_number().over(w) == 1
    rows = notes.withColumn("_new", (new | first).cast("int")).withColumn("note", F.sum("_new").over(w))
    return rows.groupBy("doc_id", *by, "note").agg(joined(F.col("ord"), F.col("text"), "").alias("text"))


def articles(blocks: DataFrame, notes: DataFrame) -> DataFrame:
    """(doc_id, markdown): blocks, then notes."""
    body = blocks.groupBy("doc_id").agg(joined(F.col("block"), F.col("paragraph"), "\n\n").alias("body"))
    foot = notes.groupBy("doc_id").agg(joined(F.col("note"), F.col("text"), "\n\n").alias("notes"))
    return body.join(foot, "doc_id", "full").select("doc_id", F.concat_ws("\n\n", "body", "notes").alias("markdown"))
