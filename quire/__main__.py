"""``python -m quire epub|pdf|docx|text|html INPUT OUTPUT``: Markdown bundles as a table under OUTPUT.

Images are a table beside it, and so is ``errors``: what could not be read or converted, and why.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire.functions.text import clean_filename, file_stem
from quire.operators import html, reflow
from quire.plans.books import delegated_bundles, epub_tables, pdf_bundles
from quire.plans.bundles import bundle, write_table
from quire.profiles import PROFILES
from quire.sources import files
from quire.sources.shared import written


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quire", description=__doc__)
    parser.add_argument("kind", choices=["epub", "pdf", "docx", "text", "html"])
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--profile", choices=sorted(PROFILES), default="a", help="layout of PDF books")
    parser.add_argument("--level", type=int, default=1, help="outline level whose entries are articles")
    parser.add_argument("--without", action="append", default=[], help="leave out outline entries whose title holds this")
    parser.add_argument("--delegate", action="store_true", help="let the PDF library convert the pages")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    if args.kind == "epub":
        made, assets, errors = epub_tables(spark, args.input)
        write_table(assets, f"{args.output}/assets")
    elif args.kind == "pdf":
        if args.delegate:
            made, errors = delegated_bundles(spark, args.input, args.without, args.level)
        else:
            made, assets, errors = pdf_bundles(spark, args.input, PROFILES[args.profile], args.without, args.level)
            write_table(assets, f"{args.output}/assets")
    else:
        errors = None
        if args.kind == "html":
            pages = written(html.markdown_pages(files.html_pages(spark, args.input), error="error").select("page_id", "markdown", "error"), "pages")
            errors = pages.filter("error is not null").select(F.col("page_id").alias("doc_id"), "error")
            lines = pages.select(F.col("page_id").alias("doc_id"), F.posexplode(F.split("markdown", "\n")).alias("n", "line"))
        elif args.kind == "docx":
            rows = written(files.docx_rows(spark, args.input), "docx")
            errors, lines = rows.filter("error is not null").select("doc_id", "error"), rows.filter("error is null").drop("error")
        else:
            lines = files.text_lines(spark, args.input)
        stem = file_stem("doc_id")
        made = bundle(reflow.reflowed(lines), stem, F.lit(""), F.lit(1), stem, clean_filename(stem), F.col("markdown"))
    if errors is not None:
        write_table(errors, f"{args.output}/errors")
    write_table(made, f"{args.output}/bundles")


if __name__ == "__main__":
    main()
