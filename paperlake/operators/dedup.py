"""One row per paper, chosen by source priority."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.settings import Source


def source_priority(source: Column, sources: Iterable[Source]) -> Column:
    """Registry priority of a source name; unregistered sources come last."""
    known = [F.lit(value) for s in sources for value in (s.name, s.priority)]
    return F.coalesce(F.create_map(*known)[source], F.lit(2**31 - 1))


def default_ties() -> list[Column]:
    """The latest landing first, then the record hash.

    The order is total on content, so a recomputed task picks the same row, and no
    text takes part in it.
    """
    return [F.col("landed_at").desc_nulls_last(), F.col("record_hash").asc_nulls_last()]


def best_per_key(
    df: DataFrame,
    sources: Iterable[Source],
    keys: Sequence[str] = ("id",),
    ties: Sequence[Column] | None = None,
) -> DataFrame:
    """Keep, per key, the row of the best source; ``ties`` order rows of one source.

    The rank filter lets Spark keep one row per key in every task before it
    shuffles, so an id that holds a third of the rows reaches its reducer as one
    row per map task. Rows are ordered by narrow columns only.
    """
    ties = default_ties() if ties is None else ties
    order = Window.partitionBy(*keys).orderBy(source_priority(F.col("source"), sources), *ties)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
