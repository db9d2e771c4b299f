"""Outline operators over ``toc`` rows (doc_id, pos, level, title, page), in preorder by ``pos``.

What hangs on ancestors or on the next entry of a rank comes from one walk over
each outline in order (``nested``): entries wait on a stack of the open ones and
leave it when an entry of the same or a higher rank comes.  So the plan is the
same for any number of levels, and a task holds the open entries only, however
long an outline is.  ``plan`` walks once for all that it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from quire.functions.text import clean_filename, contains_any, strip
from quire.operators.intervals import containing
from quire.operators.names import unique_names


def in_order() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("pos")


def entries(toc: DataFrame) -> DataFrame:
    """Stripped titles and 0-based starts; unresolved bookmarks start at 0 and are marked."""
    return toc.withColumns({"raw_title": F.col("title"), "title": strip("title"), "start": F.greatest(F.col("page") - 1, F.lit(0)), "unresolved": F.col("page") < 1})


def with_children(toc: DataFrame) -> DataFrame:
    return toc.withColumn("has_children", F.coalesce(F.lead("level").over(in_order()) > F.col("level"), F.lit(False)))


def nested(toc: DataFrame, paths: dict[str, str] | None = None, flags: dict[str, str] | None = None, boundary: tuple[str, str] | None = None, children: str | None = None) -> DataFrame:
    """``toc`` with what its nesting gives, by one walk over each outline.

    ``paths``: new column by text column, the ancestors' values (but nulls) joined by slashes, null if there is none.
    ``flags``: new column by boolean column, whether it holds for the entry or an ancestor.
    ``boundary``: new column and column, the value of the next entry of the same or a higher rank, null if none comes.
    ``children``: name of the column for whether the next entry is of a lower rank.
    An entry without a level has the highest rank.
    """
    paths, flags = paths or {}, flags or {}
    added = [StructField(n, StringType()) for n in paths] + [StructField(n, BooleanType()) for n in flags]
    added += [StructField(boundary[0], toc.schema[boundary[1]].dataType)] if boundary else []
    added += [StructField(children, BooleanType())] if children else []
    schema = StructType([*toc.schema.fields, *added])
    names = toc.columns
    n = len(names)
    at = {c: k for k, c in enumerate(names)}
    key, level_at = at["doc_id"], at["level"]
    path_of, flag_of = [at[c] for c in paths.values()], [at[c] for c in flags.values()]
    bound_of = at[boundary[1]] if boundary else None
    end_at = n + len(paths) + len(flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        done: list[list] = []
        open_: list[tuple[int, list, list, list]] = []  # level, row, paths and flags for what is below it
        doc: tuple = ()

        def close(level: int | None, bound) -> None:
            while open_ and (level is None or open_[-1][0] >= level):
                row = open_.pop()[1]
                if boundary:
                    row[end_at] = bound
                done.append(row)

        def made() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if doc != (values[key],):
                    close(None, None)
                    doc = (values[key],)
                level = values[level_at] or 0
                if children and open_ and open_[-1][0] < level:
                    open_[-1][1][-1] = True
                close(level, values[bound_of] if boundary else None)
                above = open_[-1][2] if open_ else [None] * len(path_of)
                under = open_[-1][3] if open_ else [False] * len(flag_of)
                own = [bool(values[k]) or f for k, f in zip(flag_of, under, strict=True)]
                row = [*values, *above, *own, *([None] if boundary else []), *([False] if children else [])]
                below = [a if values[k] is None else values[k] if a is None else f"{a}/{values[k]}" for k, a in zip(path_of, above, strict=True)]
                open_.append((level, row, below, own))
            if done:
                yield made()
        close(None, None)
        if done:
            yield made()

    return toc.repartition("doc_id").sortWithinPartitions("doc_id", "pos").mapInArrow(run, schema)


def _ended(boundary: str, pages: str):
    return F.greatest(F.coalesce(F.col(boundary), F.col(pages)) - 1, F.col("start"))


def _hit(toc: DataFrame, blacklist: list[str]):
    return contains_any("raw_title" if "raw_title" in toc.columns else "title", blacklist)


def with_end(toc: DataFrame, pages: str = "n_pages") -> DataFrame:
    """Inclusive ``end``: the page before the next entry of the same or a higher rank, or the last page."""
    return nested(toc, boundary=("_boundary", "start")).withColumn("end", _ended("_boundary", pages)).drop("_boundary")


def with_blacklist(toc: DataFrame, blacklist: list[str]) -> DataFrame:
    """``is_blacklisted``: the title as it came, or an ancestor's, holds a listed string."""
    return nested(toc.withColumn("_hit", _hit(toc, blacklist)), flags={"is_blacklisted": "_hit"}).drop("_hit")


def with_category(toc: DataFrame) -> DataFrame:
    """``category``: ancestors' titles joined by slashes; call after blacklisted rows are gone."""
    return nested(toc, paths={"category": "title"}).fillna("", ["category"])


def with_kind(toc: DataFrame, split_level: int) -> DataFrame:
    """``file`` at the split level or above it without children, ``folder`` above it, ``content`` below it."""
    level = F.col("level")
    return toc.withColumn("kind", F.when((level == split_level) | ((level < split_level) & ~F.col("has_children")), "file").when(level < split_level, "folder").otherwise("content"))


def _own_path(toc: DataFrame, folders: str) -> DataFrame:
    """``path`` from the folders above; equal ones of a document get ``pos`` added, so that no two are."""
    own = F.concat_ws("/", folders, clean_filename("title"))
    return unique_names(toc.withColumn("path", own), ["doc_id"], "path", "pos", F.col("pos"))


def with_path(toc: DataFrame) -> DataFrame:
    """``path``: cleaned titles of the folders above and the entry's own, unique in a document."""
    folder = toc.withColumn("_folder", F.when(F.col("kind") == "folder", clean_filename("title")))
    return _own_path(nested(folder, paths={"_folders": "_folder"}), "_folders").drop("_folder", "_folders")


def plan(toc: DataFrame, blacklist: list[str], split_level: int) -> DataFrame:
    """The whole outline plan, without running anything over pages; blacklisted entries still bound their neighbours.

    With an entry all below it is blacklisted, so the ancestors of what stays are those of the whole outline; those
    above the split level have children, hence are folders.
    """
    rows = entries(toc)
    rows = rows.withColumns({"_hit": _hit(rows, blacklist), "_folder": F.when(F.col("level") < split_level, clean_filename("title"))})
    walked = nested(rows, {"category": "title", "_folders": "_folder"}, {"is_blacklisted": "_hit"}, ("_boundary", "start"), "has_children").withColumn("end", _ended("_boundary", "n_pages"))
    kept = with_kind(walked.filter(~F.col("is_blacklisted")).fillna("", ["category"]), split_level)
    planned = _own_path(kept, "_folders").drop("_hit", "_folder", "_folders", "_boundary")
    reason = F.when(F.col("kind") == "file", F.when(F.col("level") == split_level, "level").otherwise("leaf"))
    return planned.withColumns({"page_count": F.col("end") - F.col("start") + 1, "reason": reason})


def article_pages(planned: DataFrame) -> DataFrame:
    """One row per page (0-based) of each file entry."""
    return planned.filter("kind = 'file'").select("doc_id", "pos", "title", F.explode(F.sequence("start", "end")).alias("page"))


def articles_of(pages: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows of ``pages`` (doc_id, 0-based page and more) with ``pos`` of each file entry whose pages hold theirs."""
    ranges = planned.filter("kind = 'file'").select("doc_id", "pos", F.col("start").alias("_first"), F.col("end").alias("_last"))
    return containing(pages, ranges, ["doc_id"], "page", "_first", "_last").drop("_first", "_last")


def uncovered_pages(planned: DataFrame, documents: DataFrame) -> DataFrame:
    """Pages of ``documents`` (doc_id, n_pages) that no article has."""
    every = documents.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n_pages") - 1)).alias("page"))
    return every.join(articles_of(every, planned).select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti")


def nav_entries(nav: DataFrame) -> DataFrame:
    """Flat navigation rows (doc_id, pos, level, title, href, is_section) to (doc_id, href, title, category); later rows win."""
    section = F.when(F.col("is_section"), clean_filename(F.coalesce(F.col("title"), F.lit("未命名"))))
    up = nested(nav.withColumn("_section", section), paths={"category": "_section"}).fillna("", ["category"])
    flat = up.filter(~F.col("is_section")).select("doc_id", "pos", strip(F.substring_index("href", "#", 1)).alias("href"), "title", "category").filter("href <> ''")
    return flat.groupBy("doc_id", "href").agg(F.max_by(F.struct("title", "category"), "pos").alias("x")).select("doc_id", "href", "x.*")
