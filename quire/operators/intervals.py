"""Points joined with the ranges that hold them, without a row for each place of a range.

A range has the bins of its own width: the least power of STEP that is at least
its length, so it lies in two bins at most.  A point has one bin of each width
that the ranges of its key have.  Points and ranges meet by key, width and bin,
and those whose range does not hold the point are dropped.  So ranges cost two
rows however long they are, and points one for each width, of which there are a
few for ranges of any lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_BITS = 3


def _width(first: Column, last: Column) -> Column:
    """Bits of the bins of a range: a multiple of STEP_BITS, computed in whole numbers."""
    bits = F.length(F.bin((last - first).cast("long")))  # the length less one, 0 has one digit
    return F.when(last == first, 0).otherwise(F.ceil(bits / STEP_BITS) * STEP_BITS).cast("int")


def containing(points: DataFrame, ranges: DataFrame, key: list[str], point: str, first: str, last: str) -> DataFrame:
    """Each row of ``points`` with each row of ``ranges`` of its key whose ``first`` to ``last`` (inclusive) hold it.

    The ranges' columns must not be those of the points, but for the key.  Nulls and empty ranges meet nothing.
    """
    held = ranges.filter(F.col(last) >= F.col(first)).withColumn("_width", _width(F.col(first), F.col(last)))
    bins = F.array_distinct(F.array(F.expr(f"shiftright(cast(`{first}` as bigint), _width)"), F.expr(f"shiftright(cast(`{last}` as bigint), _width)")))
    held = held.withColumn("_bin", F.explode(bins))
    widths = held.groupBy(*key).agg(F.collect_set("_width").alias("_widths"))
    met = points.filter(F.col(point).isNotNull()).join(widths, key).withColumn("_width", F.explode("_widths")).drop("_widths")
    met = met.withColumn("_bin", F.expr(f"shiftright(cast(`{point}` as bigint), _width)"))
    return met.join(held, [*key, "_width", "_bin"]).filter(F.col(point).between(F.col(first), F.col(last))).drop("_width", "_bin")
