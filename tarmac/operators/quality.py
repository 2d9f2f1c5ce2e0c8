"""Split rows on whether their key is complete."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_complete(keys: list[str]) -> Column:
    """Never null, so a filter on it and a filter on its negation share no row and lose none."""
    return reduce(lambda left, right: left & right, [F.col(key).isNotNull() for key in keys])


def valid_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.filter(key_complete(keys))


def quarantined_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.filter(~key_complete(keys))


def with_route(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``route``: where each row belongs, for a sink partitioned by it."""
    return rows.withColumn("route", F.when(key_complete(keys), "valid").otherwise("quarantine"))
