"""Reflow of Markdown lines into paragraphs: fences, breaks and islands as windows over one document's lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import strip

BREAK = r"^(#|>|[-*+][\t-\r\x1c-\x20\x85\p{Z}]|[0-9]+\.[\t-\r\x1c-\x20\x85\p{Z}])"
FENCE = "```"


def islands(lines: DataFrame, key: str = "doc_id", order: str = "n", text: str = "line") -> DataFrame:
    """One row per output block of ``lines``: key, ``island``, ``block``."""
    w = Window.partitionBy(key).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    bare = strip(F.col(text))
    fence = F.startswith(bare, F.lit(FENCE))
    rows = lines.select(key, order, F.col(text).alias("raw"), bare.alias("bare"), fence.alias("fence"))
    rows = rows.withColumn("inside", F.coalesce(F.sum(F.col("fence").cast("int")).over(before), F.lit(0)) % 2 == 1)
    kept_raw = F.col("fence") | F.col("inside")
    alone = kept_raw | (F.col("bare") == "") | F.col("bare").rlike(BREAK)
    rows = rows.withColumns({"alone": alone, "piece": F.when(kept_raw, F.col("raw")).otherwise(F.col("bare")), "gone": ~kept_raw & (F.col("bare") == "")})
    opens = F.col("alone") | F.coalesce(F.lag("alone").over(w), F.lit(True))
    rows = rows.withColumn("island", F.sum(opens.cast("int")).over(w)).filter(~F.col("gone"))
    return rows.groupBy(key, "island").agg(joined(F.col(order), F.col("piece"), " ").alias("block"))


def joined(order: Column, piece: Column, separator: str) -> Column:
    """Aggregate: pieces in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), piece.alias("p")))), lambda x: x["p"]), separator)


def reflowed(lines: DataFrame, key: str = "doc_id", order: str = "n", text: str = "line") -> DataFrame:
    """(key, markdown): blocks apart by blank lines."""
    return islands(lines, key, order, text).groupBy(key).agg(joined(F.col("island"), F.col("block"), "\n\n").alias("markdown"))
