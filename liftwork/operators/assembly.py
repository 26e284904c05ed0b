"""Building one wide row per entity: unions, deduplication, key joins and windowed aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_files(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def dedup_ignoring(df: DataFrame, time: str, keep: str = "min_time", order: str | None = None) -> DataFrame:
    """One row of each set of rows that agree but for their time; NULL agrees with NULL.

    keep: min_time, max_time (pre-aggregated), or first, last by the column ``order``.
    """
    same = [c for c in df.columns if c not in (time, order)]
    if keep in ("min_time", "max_time"):
        return df.groupBy(*same).agg((F.min if keep == "min_time" else F.max)(time).alias(time)).select(*[c for c in df.columns if c != order])
    if order is None:
        raise ValueError("first and last need a column that tells the order of rows")
    pick = F.min_by if keep == "first" else F.max_by
    return df.groupBy(*same).agg(pick(time, order).alias(time)).select(*[c for c in df.columns if c != order])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row (repeated): rows beyond the first of their key."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0)).alias("repeated"))


def joined_chain(tables: list[DataFrame], keys: list[str], how: str = "outer") -> DataFrame:
    """Tables joined one after the other on the same keys, so their partitioning is reused."""
    return reduce(lambda a, b: a.join(b, keys, how), tables)


def hit_rate(base: DataFrame, sources: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(source, rate): the share of base rows whose key a source has."""
    parts = []
    for name, source in sources.items():
        there = source.select(*keys).distinct().withColumn("_in", F.lit(1))
        parts.append(base.select(*keys).join(there, keys, "left").agg(F.avg(F.col("_in").isNotNull().cast("double")).alias("rate")).select(F.lit(name).alias("source"), "rate"))
    return union_files(parts)


def windowed(df: DataFrame, entity: str, days: str, values: list[str], caps: dict[str, int | None], prefix: str) -> DataFrame:
    """One row an entity with mean, max, sum and count of each value in each window, from one aggregation.

    A row is in a window if |days| <= cap; a cap of None takes all rows, those without days too. The sum
    of a window without known values is 0 if the window has rows, else NULL.
    """
    aggs = []
    for window, cap in caps.items():
        inside = F.lit(True) if cap is None else F.coalesce(F.abs(F.col(days)) <= cap, F.lit(False))
        n = F.count_if(inside)
        for v in values:
            x = F.when(inside, F.col(v))
            aggs += [F.avg(x).alias(f"{prefix}_{v}_mean_{window}"), F.max(x).alias(f"{prefix}_{v}_max_{window}"), F.when(n > 0, F.coalesce(F.sum(x), F.lit(0.0))).alias(f"{prefix}_{v}_sum_{window}")]
        aggs.append(F.when(n > 0, n).alias(f"{prefix}_cnt_{window}"))
    return df.groupBy(entity).agg(*aggs)


def set_comparison(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): left, right or both, of two lists of names."""
    a, b = (d.select(F.col(key).alias(key)).distinct().withColumn(s, F.lit(True)) for d, s in ((left, "l"), (right, "r")))
    side = F.when(F.col("l") & F.col("r"), "both").when(F.col("l"), "left").otherwise("right")
    return a.join(b, key, "full").select(key, side.alias("side"))
