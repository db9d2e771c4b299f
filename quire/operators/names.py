"""Names that no two rows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_names(rows: DataFrame, scope: list[str], name: str, order: str, number: Column | None = None) -> DataFrame:
    """``rows`` with ``name`` unique within ``scope``: the first by ``order`` keeps it, others get ``number`` (else their place) added.

    Only names that agree up to their last underscores and digits can meet, so a group of those decides by itself: the
    number follows one underscore more than stand together in the end of any name of the group.  So a numbered name is none of
    the given ones, and two numbered names are equal only if both the given one and the number are.  ``number`` must
    tell rows of one name apart.
    """
    group = Window.partitionBy(*scope, "_stem")
    same = Window.partitionBy(*scope, "_stem", name).orderBy(order)
    tail = F.regexp_extract(name, "[_0-9]*$", 0)
    runs = F.transform(F.regexp_extract_all(tail, F.lit("(_+)"), F.lit(1)), lambda r: F.length(r))
    marked = rows.withColumn("_stem", F.regexp_replace(name, "[_0-9]+$", "")).withColumns({"_place": F.row_number().over(same), "_run": F.max(F.coalesce(F.array_max(runs), F.lit(0))).over(group)})
    numbered = F.concat(F.col(name), F.repeat(F.lit("_"), F.col("_run") + 1), (F.col("_place") if number is None else number).cast("string"))
    return marked.withColumn(name, F.when(F.col("_place") > 1, numbered).otherwise(F.col(name))).drop("_stem", "_place", "_run")
