"""Whole books to page bundles: (doc_id, rel_path, markdown), and their images (doc_id, rel_path, content)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import clean_filename, file_stem, image_extension
from quire.operators import html, layout, paragraphs, reflow, toc
from quire.operators.names import unique_names
from quire.plans.bundles import bundle
from quire.profiles import BY_BOOK, SETTINGS, Profile, with_settings
from quire.sources import epub, pdf
from quire.sources.shared import written

#: Room for a page's images and lines in the order of an article.
PAGE = 1 << 21


def numbered_files(images: DataFrame, key: list[str], order: list[str], name: Column) -> DataFrame:
    """``file`` of each image: counted in its article, with the extension of its content or name."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return images.withColumn("file", F.concat(F.lit("img_"), n.cast("string"), image_extension(name, F.col("content"))))


def with_folder(books: DataFrame) -> DataFrame:
    """``folder`` of each book (doc_id, book): its clean name, with a number where another has the same."""
    return unique_names(books.withColumn("folder", clean_filename("book")), [], "folder", "doc_id")


def layout_bundles(outline: DataFrame, spans: DataFrame, pages: DataFrame, blocks: DataFrame, drawings: DataFrame, profile: Profile | DataFrame, blacklist: list[str], split_level: int, images: DataFrame | None = None, book: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Books from their outline (with n_pages) and layout; pages that several articles share go to each.

    Paths begin with a folder for each book, ``book`` of its doc_id (as it is, if not given).  ``profile`` may be a
    table (doc_id, profile) that names each book's.
    """
    own: list[str] = []
    with_own = lambda rows: rows
    if isinstance(profile, DataFrame):
        of, profile, own = profile, BY_BOOK, [SETTINGS]
        with_own = lambda rows: with_settings(rows, of)
    planned = toc.plan(outline, blacklist, split_level)
    name = F.col("doc_id").cast("string") if book is None else book
    folders = with_folder(outline.select("doc_id").distinct().withColumn("book", name))
    planned = planned.join(folders, "doc_id").withColumn("path", F.concat_ws("/", "folder", "path")).drop("folder")
    key = F.concat_ws("/", F.col("doc_id").cast("string"), F.col("pos").cast("string"))
    articles = planned.filter("kind = 'file'").withColumn("article", key)
    # Each page meets its articles once, its lines and images then by the page.
    page_of = toc.articles_of(pages.select("doc_id", "page").distinct(), planned).select("doc_id", "page", key.alias("article"))

    splits = layout.split_lines(with_own(pages), with_own(blocks), drawings, profile)
    rows = layout.with_region(with_own(layout.lines(spans)), splits, profile).join(page_of, ["doc_id", "page"])
    raw = F.array_join(F.transform("spans", lambda s: s["text"]), "")
    rows = rows.withColumns({"doc_id": F.col("article"), "raw": raw, "ord": F.col("page").cast("long") * PAGE + PAGE // 2 + F.col("line_idx")}).drop("article")
    body = layout.with_references(layout.with_prefix(layout.with_features(rows.filter("region = 'body'"), profile), profile))
    lines = layout.with_text(body, profile).select("doc_id", "page", "ord", "text", "raw", "x0", F.lit(False).alias("is_image"), *own)
    assets = None
    if images is not None:
        found = images.join(page_of, ["doc_id", "page"]).withColumn("doc_id", F.col("article")).drop("article")
        found = numbered_files(found, ["doc_id"], ["page", "block_idx"], F.lit(""))
        shown = found.select("doc_id", "page", (F.col("page").cast("long") * PAGE + F.col("block_idx")).alias("ord"), F.concat(F.lit("![img](assets/"), "file", F.lit(")")).alias("text"), F.lit("").alias("raw"), F.lit(0.0).alias("x0"), F.lit(True).alias("is_image"))
        lines = lines.unionByName(shown, allowMissingColumns=True)
        assets = found.join(articles.select(F.col("article").alias("doc_id"), "path"), "doc_id").select("doc_id", F.concat("path", F.lit("/assets/"), "file").alias("rel_path"), "content")
    paras = paragraphs.merged_quotes(paragraphs.paragraphs(paragraphs.with_pieces(paragraphs.with_islands(lines, profile), profile)))
    paired = paragraphs.paired_notes(rows.filter("region = 'note'").select("doc_id", "page", "ord", "raw", "x0", *own), paragraphs.page_references(body))
    text = paragraphs.articles(paras, paragraphs.note_islands(paired, profile)).withColumnRenamed("doc_id", "article")
    whole = articles.join(text, "article", "inner")
    return bundle(whole, F.col("book"), F.col("category"), F.col("start") + 1, F.col("title"), F.col("path"), F.col("markdown")), assets


def pdf_bundles(spark: SparkSession, path: str, profile: Profile, blacklist: list[str], split_level: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """PDF books at ``path``: bundles, images, and (doc_id, page, error) of what could not be read."""
    rows = written(pdf.tables(spark, path, profile), "pdf")  # each file is opened once
    made, assets = layout_bundles(
        pdf.outline(rows), pdf.spans(rows), pdf.part(rows, "page", "page", "height"), pdf.part(rows, "block", "page", "block_idx", "y0", "text"),
        pdf.part(rows, "drawing", "page", "x0", "y0", "x1", "y1"), profile, blacklist, split_level, pdf.part(rows, "image", "page", "block_idx", "content"), file_stem("doc_id"),
    )
    return made, assets, pdf.part(rows, "error", "page", "error")


def delegated_bundles(spark: SparkSession, path: str, blacklist: list[str], split_level: int) -> tuple[DataFrame, DataFrame]:
    """PDF books converted article by article by the PDF library's converter: flat files, and (doc_id, pos, error)."""
    rows = written(pdf.tables(spark, path), "pdf")
    planned = toc.plan(pdf.outline(rows), blacklist, split_level).filter("kind = 'file'")
    folders = with_folder(planned.select("doc_id").distinct().withColumn("book", file_stem("doc_id")))
    text = written(pdf.delegated(spark, path, planned.select("doc_id", "pos", "start", "end")), "pdf-text")
    whole = planned.join(folders, "doc_id").join(text.filter("error is null"), ["doc_id", "pos"])
    made = bundle(whole, F.col("book"), F.col("category"), F.col("start") + 1, F.col("title"), F.concat_ws("/", "folder", "path"), F.col("markdown"), flat=True)
    return made, text.filter("error is not null").select("doc_id", "pos", "error")


def epub_bundles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """E-books at ``path``: one bundle for each spine document, reflowed, with its images as files beside it."""
    return epub_tables(spark, path)[:2]


def epub_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bundles and images as ``epub_bundles`` has them, and (doc_id, error) of the books that could not be read."""
    rows = written(epub.members(spark, path), "epub")  # each file is unpacked once
    return *_bundles(rows), epub.errors(rows)


def bundles_of(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bundles and images of the ``members`` of e-books."""
    return _bundles(written(members, "epub"))  # each file is unpacked once


def _bundles(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    spine, items, nav, titles = epub.parts(members)
    docs = epub.spine_documents(spine, items, nav, titles).withColumn("html", F.col("content").cast("string"))
    folder = F.concat_ws("/", F.transform(F.filter(F.split("category", "/"), lambda p: p != ""), clean_filename), clean_filename("title"))
    book = F.coalesce("book", file_stem("doc_id"))
    folders = with_folder(docs.select("doc_id", book.alias("book")).distinct()).select("doc_id", "folder")
    docs = docs.join(folders, "doc_id").withColumn("path", F.concat_ws("/", "folder", folder)).drop("folder")
    docs = unique_names(docs, ["doc_id"], "path", "order", F.col("order"))
    images = docs.select("doc_id", F.col("href").alias("base"), F.posexplode(html.image_list()).alias("n", "src"))
    found = numbered_files(epub.matched_images(images, items), ["doc_id", "base"], ["n"], F.col("href"))
    named = found.groupBy("doc_id", "base").agg(F.collect_list(F.struct("src", F.concat(F.lit("assets/"), "file").alias("file"))).alias("images")).withColumnRenamed("base", "href")
    pages = docs.join(named, ["doc_id", "href"], "left").withColumn("markdown", html.markdown_with_images("html", "images")).withColumn("page", F.concat_ws("#", "doc_id", "order"))
    lines = pages.select("page", F.posexplode(F.split("markdown", "\n")).alias("n", "line"))
    text = docs.withColumn("page", F.concat_ws("#", "doc_id", "order")).join(reflow.reflowed(lines, key="page"), "page", "left")
    made = bundle(text, book, F.col("category"), F.col("order"), F.col("title"), F.col("path"), F.coalesce("markdown", F.lit("")))
    where = docs.select("doc_id", F.col("href").alias("base"), "path")
    return made, found.join(where, ["doc_id", "base"]).select("doc_id", F.concat("path", F.lit("/assets/"), "file").alias("rel_path"), "content")
