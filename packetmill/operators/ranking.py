"""Positions in a global order, counted in sorted ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetmill.session import stored

_AT, _TIE = "_position_at", "_position_tie"
_IN_RANGE = 33  # bits of monotonically_increasing_id that number the rows of one partition


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add the place of every row, from 1, in the given order.

    The rows are dealt into sorted ranges and stored; a row's place is its number within its range
    plus the sizes of the ranges before, of which there is one row each. No task sees more than its
    range. Rows that tie in the whole order are told apart by where they were read, so a value that
    very many rows share spreads over several ranges.

    Defined cases: an empty table stays empty; a column called ``name`` is replaced.
    """
    kept = [c for c in df.columns if c.lower() != name.lower()]
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, F.col(_TIE)).sortWithinPartitions(*order, F.col(_TIE))
    dealt = stored(dealt.drop(_TIE).withColumn(_AT, F.monotonically_increasing_id()), "ranked")
    at, part = F.col(_AT), F.shiftright(F.col(_AT), _IN_RANGE)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row per range
    starts = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    starts = stored(starts, "starts")  # of known size: the rows meet it where they lie
    place = (at.bitwiseAND((1 << _IN_RANGE) - 1) + F.col("_before") + 1).alias(name)
    return dealt.join(starts, part == F.col("_part")).select(*[F.col(f"`{c}`") for c in kept], place)
