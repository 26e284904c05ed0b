"""Tables co-partitioned by bucket, so that chains of joins need no shuffle of their rows."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwork.sources.intermediate import shared_dir


def bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``df`` as a written table with its rows dealt by ``key`` to buckets, each sorted. An empty bucket has no file."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/liftwork/{table}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def outer_chain(tables: list[DataFrame], key: str) -> DataFrame:
    """The full outer join of bucketed tables, one after another, on ``key``: every key of any table, with NULL where a table lacks it.

    A chain of full outer joins would shuffle at each step, the coalesced key being no bucket's. So the rows come by
    the first table that has their key: those of a table whose keys no earlier one has, with the later tables
    joined from the left. All these joins stay within the buckets; tables are read once for each table of the chain.
    Keys that are NULL match none, as in a join.
    """
    parts = []
    for i, first in enumerate(tables):
        out = first.withColumnRenamed(key, "_key")
        for j, other in enumerate(tables):
            if j == i:
                continue
            right = other.withColumnRenamed(key, "_other")
            on = F.col("_key") == F.col("_other")
            out = out.join(right.select("_other"), on, "left_anti") if j < i else out.join(right, on, "left").drop("_other")
        parts.append(out.withColumnRenamed("_key", key))
    columns = [key, *(c for t in tables for c in t.columns if c != key)]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).select(columns)
