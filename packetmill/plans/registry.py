"""Runnable queries over a table folder, each with the DuckDB statement it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from packetmill.session import configure, fit_partitions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            fit_partitions(configure(spark), sf_dir)
            return function(spark, sf_dir)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return run

    return add
