"""Object names and load ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_id(path: Column, prefix: str) -> Column:
    """``<prefix><load_id>/<file>`` -> ``<load_id>``."""
    return F.split_part(F.substr(path, F.lit(len(prefix) + 1)), F.lit("/"), F.lit(1))


def load_sort_key(load: Column) -> Column:
    """The id as a number when it is all digits, else -1."""
    return F.when(load.rlike("^[0-9]+$"), load.try_cast("decimal(38,0)")).otherwise(F.lit(-1)).cast("decimal(38,0)")


def has_suffix(path: Column, suffix: str) -> Column:
    return F.lower(path).endswith(suffix.lower())
