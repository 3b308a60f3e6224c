"""Column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(rows: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """``field, n_rows, n_nulls, null_share`` per field, from one pass over the table."""
    fields = fields or rows.columns
    counts = rows.agg(F.count("*").alias("_n"), *[F.count(f).alias(f) for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])
    long = counts.select("_n", F.explode(pairs).alias("p"))
    nulls = F.col("_n") - F.col("p.filled")
    return long.select(
        "p.field",
        F.col("_n").alias("n_rows"),
        nulls.alias("n_nulls"),
        F.round(F.try_divide(nulls, F.col("_n")), 6).alias("null_share"),
    )


def value_profile(rows: DataFrame, field: str) -> DataFrame:
    """The spellings of a free-text field and how often each occurs."""
    return rows.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n_rows"))
