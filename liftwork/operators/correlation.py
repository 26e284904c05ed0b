"""Correlation of features and clusters of correlated features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftwork.sources.intermediate import stored

#: Features of a block of the matrix of products.
BLOCK = 128


def _products(centred: DataFrame, features: list[str]) -> DataFrame:
    """(i, j, c, n) for i < j: sums of products of two features and the number of rows that have both.

    One pass: every task adds up its matrix, whose blocks are added up again by block. A task holds
    features x features numbers, whatever the rows; there are as many tasks as cores, so that no more matrices are sent.
    """
    size = len(features)
    starts = list(range(0, size, BLOCK))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((size, size)), np.zeros((size, size))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.float64)
            known = (~np.isnan(x)).astype(np.float64)
            x = np.nan_to_num(x)
            sums += x.T @ x
            counts += known.T @ known
        rows = [(a, b, sums[a : a + BLOCK, b : b + BLOCK].ravel(), counts[a : a + BLOCK, b : b + BLOCK].ravel()) for a in starts for b in starts if a <= b]
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())), strict=True)], names=["a", "b", "c", "n"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for a, b, c, n in zip(*(batch.column(k) for k in ("a", "b", "c", "n")), strict=True):
                both = np.stack([c.values.to_numpy(), n.values.to_numpy()])
                key = (a.as_py(), b.as_py())
                found[key] = found[key] + both if key in found else both
        for (a, b), both in found.items():
            width = min(BLOCK, size - b)
            i, j = a + np.arange(both.shape[1]) // width, b + np.arange(both.shape[1]) % width
            some = i < j
            yield pa.RecordBatch.from_arrays([pa.array(i[some], pa.int32()), pa.array(j[some], pa.int32()), pa.array(both[0][some]), pa.array(both[1][some].astype(np.int64))], names=["i", "j", "c", "n"])

    cores = centred.sparkSession.sparkContext.defaultParallelism
    blocks = centred.coalesce(max(1, cores)).mapInArrow(local, "a int, b int, c array<double>, n array<double>")
    return blocks.repartition("a", "b").mapInArrow(added, "i int, j int, c double, n long")


def edges(wide: DataFrame, features: list[str], threshold: float = 0.95, min_overlap: float = 0.10) -> DataFrame:
    """(f1, f2, r, n_pairs, low_overlap) of all pairs with |r| at the threshold or over it.

    Each feature is centred and scaled by its own known rows (population deviation); the covariance of
    a pair runs over the rows where both are known.
    """
    spark = wide.sparkSession
    stats = wide.agg(F.count(F.lit(1)).alias("n"), *(a for f in features for a in (F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}")))).first()
    centred = wide.select(*((F.col(f).cast("double") - F.lit(float(stats[f"m_{f}"] or 0.0))).alias(f) for f in features))
    names = spark.createDataFrame([(i, f, float(stats[f"s_{f}"] or 0.0)) for i, f in enumerate(features)], "k int, f string, s double")
    side = lambda k, n: F.broadcast(names.select(F.col("k").alias(k), F.col("f").alias(f"f{n}"), F.col("s").alias(f"s{n}")))  # noqa: E731  a row a feature
    pairs = _products(centred, features).join(side("i", 1), "i").join(side("j", 2), "j")
    r = F.coalesce(F.try_divide("c", F.col("n") * F.col("s1") * F.col("s2")), F.lit(0.0))
    out = pairs.select("f1", "f2", r.alias("r"), F.col("n").alias("n_pairs"), (F.col("n") / F.lit(stats["n"] or 1) < min_overlap).alias("low_overlap"))
    return out.where(F.abs("r") >= threshold)


def tiered(found: DataFrame, families: DataFrame, groups: DataFrame, family: float = 0.90, group: float = 0.85, other: float = 0.95) -> DataFrame:
    """Edges at the cutoff of their tier: same family, same group, or neither. ``families`` and ``groups`` have a row a feature."""
    for side in ("f1", "f2"):
        found = found.join(families.select(F.col("feature").alias(side), F.col("family").alias(f"fam_{side}")), side, "left").join(groups.select(F.col("feature").alias(side), F.col("group").alias(f"grp_{side}")), side, "left")
    cutoff = F.when(F.col("fam_f1") == F.col("fam_f2"), family).when(F.col("grp_f1") == F.col("grp_f2"), group).otherwise(other)
    return found.where(F.abs("r") >= cutoff).select("f1", "f2", "r", "n_pairs", "low_overlap")


def clusters(spark, features: list[str], found: DataFrame) -> DataFrame:
    """(feature, cluster): connected features, numbered in the order of their first member.

    Every feature takes the first place among its neighbours' and then that of the feature in this place, until nothing changes.
    """
    places = spark.createDataFrame([(f, i) for i, f in enumerate(features)], "feature string, place int")
    at = lambda side, name: places.select(F.col("feature").alias(side), F.col("place").alias(name))
    pairs = found.where("not low_overlap").join(at("f1", "a"), "f1").join(at("f2", "b"), "f2").select("a", "b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cluster-edges")
    labels = places.select(F.col("place").alias("a"), F.col("place").alias("lead"))
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "lead"), "b").groupBy("a").agg(F.min("lead").alias("near"))
        lower = labels.join(near, "a", "left").select("a", F.least("lead", F.coalesce("near", "lead")).alias("label"), F.col("lead").alias("before"))
        jump = lower.select(F.col("a").alias("label"), F.col("label").alias("further"))
        after = stored(lower.join(jump, "label").select("a", F.least("label", "further").alias("lead"), "before"), "cluster-labels")
        labels = after.select("a", "lead")
        if after.where("lead != before").isEmpty():
            break
    number = (F.dense_rank().over(Window.orderBy("lead")) - 1).alias("cluster")  # a row a feature
    return labels.join(places, labels["a"] == places["place"]).select("feature", number)
