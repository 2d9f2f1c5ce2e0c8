"""Latest row per key, and merges built on it.

Each is one grouped aggregation. The winner is the greatest struct, so every
map task sends at most one row per key it saw: a key that holds a third of the
input costs the reducer as many rows as there are map tasks. Null keys compare
equal to each other, as GROUP BY has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEPT = "__kept"
_SOURCE = "__from_source"
_WINNER = "__winner"


def _greatest_per_key(
    rows: DataFrame, keys: list[str], order: list[str], *extra_aggregates
) -> DataFrame:
    """Per key the row with the greatest ``order``; remaining columns break ties, nulls lowest."""
    rest = [name for name in rows.columns if name not in keys and name not in order]
    ranked = F.struct(*order, *rest)
    return rows.groupBy(*keys).agg(F.max(ranked).alias(_WINNER), *extra_aggregates)


def _restore(winners: DataFrame, keys: list[str], columns: list[str], keep=()) -> DataFrame:
    def pick(name: str):
        if name in keys:
            return F.col(name)
        return F.col(f"{_KEPT if name in keep else _WINNER}.{name}").alias(name)

    return winners.select(*(pick(name) for name in columns))


def latest_per_key(rows: DataFrame, keys: list[str], sequence: list[str] = ()) -> DataFrame:
    """One row per key: the last by ``sequence``, then by the other columns in order.

    Without ``sequence`` this is a plain deduplication whose survivor does not
    depend on how the data happened to be split.
    """
    order = [name for name in sequence if name not in keys]
    return _restore(_greatest_per_key(rows, keys, order), keys, rows.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    sequence: list[str] = (),
    keep: list[str] = (),
) -> DataFrame:
    """``target`` with the rows of ``source`` merged in by key; nothing is deleted.

    Without ``sequence`` a source row replaces the target row of its key. With
    it the later one stays and the source wins a tie. ``source`` may repeat a
    key. Columns in ``keep`` are never updated: a matched row keeps the
    target's value, an inserted one has null. Columns only one side has are
    null on the other. ``target`` holds a key at most once.
    """
    order = [name for name in sequence if name not in keys]
    incoming = source.drop(*keep).withColumn(_SOURCE, F.lit(1))
    stored = target.withColumn(_SOURCE, F.lit(0))
    both = stored.unionByName(incoming, allowMissingColumns=True)
    columns = [name for name in both.columns if name != _SOURCE]
    held = [F.max(F.when(F.col(_SOURCE) == 0, F.struct(*keep))).alias(_KEPT)] if keep else []
    winners = _greatest_per_key(both, keys, [*order, _SOURCE], *held)
    return _restore(winners, keys, columns, keep)
