"""What the operators share: scratch tables, packed rows, and DuckDB spellings of common columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.session import configure, freeing, scratch_dir

# White space of all contracts: space and the six control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The same rows, written once under the shared scratch folder and read from there.

    This cuts the lineage: executors lost later cost a re-read, not a recomputation, and row
    numbers given before the write stay what they were.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with freeing(spark):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows with whole texts are large; small Arrow batches keep both ends of a transfer small.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """The package's session settings, and small Arrow batches."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` and all columns of the input as one struct ``row``.

    Whatever the input's columns are called, they cannot clash with an operator's own.
    """
    prepare(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )


def unpack(df: DataFrame, *added: Column) -> DataFrame:
    """The columns of ``row`` again, and ``added`` ones, which replace columns of the same name."""
    plain = df.select(*added).columns if added else []
    taken = {c.lower() for c in plain}
    kept = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col("row").getField(c).alias(c) for c in kept], *added)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


Query = Callable[[SparkSession, str], DataFrame]
