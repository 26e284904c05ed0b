"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from liftwork.sources.intermediate import shared_dir, stored

__all__ = ["documents", "drop", "release", "shared_dir", "stored", "unused"]


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        files = table.inputFiles()
        if files:
            jvm = table.sparkSession.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(files[0])).getParent()
            if "/liftwork/" in files[0]:
                folder.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def unused(columns: list[str], name: str) -> str:
    """``name`` with as many underscores in front as make it differ from all columns."""
    taken = {c.lower() for c in columns}
    while (name := f"_{name}") in taken:
        pass
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now rather than at its next collection."""
    spark.sparkContext._jvm.System.gc()
