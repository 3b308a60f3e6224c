"""Joins of detail rows to per-key results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_summary(detail: DataFrame, summary: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join detail rows, many per key, to one summary row per key.

    A summary that was just grouped on the key already lies in the key's partitions, and a join
    that reuses them cannot be split when one key owns most of the detail. Rewriting the first key
    (a string) gives the small side an exchange of its own, so adaptive execution splits the hot
    key's detail, or broadcasts the summary once its measured size is under the threshold.
    """
    first, rest = on[0], [c for c in summary.columns if c != on[0]]
    rekeyed = summary.select(F.concat(F.col(first), F.lit("")).alias(first), *rest)
    return detail.join(rekeyed, on, how)
