"""Sinks: partitions overwritten one by one, tables from queries, reports that are swapped as a whole, ordered reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.sources.positions import numbered


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm.org.apache.hadoop.fs.Path


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write ``df`` by partitions; those it has rows of are replaced, all others keep their files."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def create_table(df: DataFrame, name: str, path: str, by: list[str] | None = None) -> DataFrame:
    """The catalog table ``name`` made of ``df``, its files in ``path``; an error if there is one."""
    writer = df.write.option("path", path).format("parquet")
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def swap_report(tables: dict[str, DataFrame], folder: str) -> None:
    """Write all tables of a report and put them in place of the old report at once.

    They are written beside ``folder`` first; a write that fails leaves the old report as it is. The old one is moved aside, the
    new one put in its place and the old one deleted; if the second step fails, the old one is moved back.
    """
    spark = next(iter(tables.values())).sparkSession
    fresh, old = f"{folder}.new-{uuid.uuid4().hex}", f"{folder}.old-{uuid.uuid4().hex}"
    fs, at, path = _file_system(spark, folder)
    try:
        for name, df in tables.items():
            df.write.parquet(f"{fresh}/{name}")
    except Exception:
        fs.delete(path(fresh), True)
        raise
    there = fs.exists(at)
    if there and not fs.rename(at, path(old)):
        fs.delete(path(fresh), True)
        raise OSError(f"{folder} cannot be moved")
    if not fs.rename(path(fresh), at):
        if there:
            fs.rename(path(old), at)
        fs.delete(path(fresh), True)
        raise OSError(f"{folder} cannot be put in place")
    if there:
        fs.delete(path(old), True)


def write_ordered(df: DataFrame, path: str, order: list[str | Column], header: bool = True) -> None:
    """Delimited files of a report, with its order as the first column: position, from 1. The files' names follow the order."""
    placed = numbered(df, order, "position").withColumn("position", F.col("position") + 1)
    placed.repartitionByRange("position").sortWithinPartitions("position").select("position", *df.columns).write.mode("overwrite").csv(path, header=header)

