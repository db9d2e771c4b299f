"""Sinks: page bundles as tables, and as files where every executor sees the target."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quire.functions.text import front_matter


def bundle(articles: DataFrame, book: Column, category: Column, order: Column, title: Column, path: Column, body: Column, flat: bool = False) -> DataFrame:
    """(doc_id, rel_path, markdown): a folder with an index for each article, or one flat file."""
    name = F.concat(path, F.lit(".md" if flat else "/index.md"))
    return articles.select("doc_id", name.alias("rel_path"), F.concat(front_matter(book, category, order, title), body).alias("markdown"))


def write_table(bundles: DataFrame, target: str, partition: str | None = None) -> None:
    writer = bundles.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(target)


def write_parts(pages: DataFrame, target: str) -> None:
    """Pages of ``profiling.split_pages`` as a table with a folder for each part's name."""
    write_table(pages, target, "name")


def write_files(bundles: DataFrame, target: str) -> None:
    """One file per row under ``target``, a folder that all executors share; rerun tasks write the same bytes again."""

    def run(rows: Iterator[Row]) -> None:
        for r in rows:
            name = os.path.normpath(os.path.join(target, r.rel_path.lstrip("/")))
            if not name.startswith(os.path.normpath(target) + os.sep):
                raise ValueError(f"outside the target: {r.rel_path}")
            os.makedirs(os.path.dirname(name), exist_ok=True)
            part = f"{name}.part-{os.getpid()}"
            with open(part, "w", encoding="utf-8") as f:
                f.write(r.markdown)
            os.replace(part, name)

    bundles.select("rel_path", "markdown").foreachPartition(run)


def dry_run(planned: DataFrame) -> DataFrame:
    """What the plan would write, without running it."""
    return planned.select("doc_id", "pos", "kind", "path", "page_count", "reason").orderBy("doc_id", "pos")
