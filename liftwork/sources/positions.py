"""Dense row ids: positions 0 .. n - 1 in a given order, and rows fetched by them."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwork.sources.intermediate import stored

_IN_TASK = (1 << 33) - 1  # the part of monotonically_increasing_id that counts within a task


def numbered(rows: DataFrame, order: list[str | Column], name: str = "row_id", share: Column | None = None) -> DataFrame:
    """``rows`` with ``name``, their dense position in ``order``; nulls stand first unless ``order`` says otherwise.

    Range partitions are sorted and written once; the driver sees one count a partition, and a position is
    the place in the partition plus the rows before it. ``order`` ought to tell different rows apart: rows it
    leaves equal are told apart by where they were read. No task holds more than its range, however many
    rows are equal. An empty table gives an empty result.

    ``share``: a number in [0, 1) that never falls along ``order`` and is spread evenly; rows are then dealt by it, and
    not read beforehand for the borders of ranges.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = rows.withColumn("_read", F.monotonically_increasing_id())
    if share is None:
        ranged = ranged.repartitionByRange(*order, "_read")
    else:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = ranged.repartitionById(parts, F.least(F.floor(share * parts), F.lit(parts - 1)).cast("int"))
    ranged = ranged.sortWithinPartitions(*order, "_read")
    placed = stored(ranged.drop("_read").select("*", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK)).alias("_place")), "row-ids")
    counts = sorted((r["_task"], r["count"]) for r in placed.groupBy("_task").count().collect())  # a row a partition
    if not counts:
        return placed.select(*rows.columns, F.col("_place").alias(name))
    before = [0, *accumulate(n for _, n in counts)][:-1]
    offsets = rows.sparkSession.createDataFrame([(t, b) for (t, _), b in zip(counts, before, strict=True)], "_task int, _before long")
    return placed.join(F.broadcast(offsets), "_task").select(*rows.columns, (F.col("_place") + F.col("_before")).alias(name))


def at_positions(numbered_rows: DataFrame, positions: DataFrame, name: str = "row_id") -> DataFrame:
    """The rows at the given positions, once for each time a position is given; positions beyond the table give none."""
    return numbered_rows.join(positions.select(name), name)
