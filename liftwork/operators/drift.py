"""Drift of populations against a baseline: PSI by population and feature, summaries, matrices, missing rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.operators import binning, signals

POPULATION = ["population", "feature"]


def population_psi(baseline: DataFrame, populations: DataFrame, n_bins: int = 10) -> DataFrame:
    """(population, feature, psi) of histograms (population, feature, value, n) against a histogram (feature, value, n, pos).

    Bins come from the baseline; a missing value is a bin of its own. Everything after the counts is of the size of the bins.
    """
    edges = binning.equal_frequency_edges(baseline, n_bins)
    expected = binning.counted(baseline, edges).select("feature", "bin", F.col("n").alias("expected"))
    actual = binning.digitized(populations, edges).groupBy(*POPULATION, "bin").agg(F.sum("n").alias("actual"))
    grid = actual.select(*POPULATION).distinct().join(expected, "feature")
    both = grid.join(actual, [*POPULATION, "bin"], "full").fillna(0, ["expected", "actual"])
    return signals.psi(both, POPULATION)


def seed_drift(full: DataFrame, oot: DataFrame, seeds: DataFrame, features: list[str], names: list[str]) -> DataFrame:
    """(population, feature, psi_full, flag_full, psi_oot, flag_oot, n, missing_rate, mean, median, p10, p90) of every pair.

    A feature that a population does not have at all is flagged ``missing``.
    """
    spark = seeds.sparkSession
    pairs = spark.createDataFrame([(n, f) for n in names for f in features], "population string, feature string")
    out = pairs
    for name, base in (("full", full), ("oot", oot)):
        psi = population_psi(base, seeds).withColumnRenamed("psi", f"psi_{name}")
        out = out.join(psi, POPULATION, "left").withColumn(f"flag_{name}", F.when(F.col(f"psi_{name}").isNull(), "missing").otherwise(signals.psi_flag(F.col(f"psi_{name}"))))
    return out.join(signals.profile(seeds, POPULATION), POPULATION, "left")


def _top(name: Column, n: int, value: str) -> Column:
    """The names of the greatest values, joined; few rows a group."""
    some = F.filter(F.collect_list(F.struct((-F.col(value)).alias("v"), name.alias("name"))), lambda s: s["v"].isNotNull())
    return F.array_join(F.transform(F.slice(F.array_sort(some), 1, n), lambda s: s["name"]), ",")


def seed_summary(drift: DataFrame, top: int = 5) -> DataFrame:
    """One row a population: features compared and missing, mean and median PSI, shares of the flags, the features that moved most."""
    there = F.col("flag_oot") != "missing"
    share = lambda flag: F.try_divide(F.count_if(F.col("flag_oot") == flag).cast("double"), F.count_if(there))
    return drift.groupBy("population").agg(
        F.max("n").alias("n_rows"), F.count_if(there).alias("compared"), F.count_if(~there).alias("missing"), F.avg("psi_oot").alias("mean_psi"), F.expr("percentile(psi_oot, 0.5)").alias("median_psi"),
        share("stable").alias("stable"), share("shift").alias("shift"), share("broken").alias("broken"), _top(F.col("feature"), top, "psi_oot").alias("top_features"),
    )


def top_shift(drift: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` features of each population with the greatest PSI, with their ordinal."""
    order = Window.partitionBy("population").orderBy(F.desc("psi_oot"), "feature")
    return drift.where("psi_oot is not null").withColumn("ordinal", F.row_number().over(order)).where(F.col("ordinal") <= n)


def psi_matrix(drift: DataFrame, names: list[str], value: str = "psi_oot") -> DataFrame:
    """A row a feature with a column a population and the greatest of them, ``most``."""
    wide = drift.groupBy("feature").pivot("population", names).agg(F.first(value))
    return wide.withColumn("most", F.greatest(*(F.col(f"`{n}`") for n in names)) if len(names) > 1 else F.col(f"`{names[0]}`")).orderBy(F.desc("most"), "feature")


def cross_psi(seeds: DataFrame, names: list[str]) -> DataFrame:
    """(expected, actual, psi): mean PSI over the features of every pair of populations, with bins of the first; 0 with itself."""
    key = lambda p: F.concat_ws("\x1f", p, F.col("feature"))
    bases = seeds.select(key(F.col("population")).alias("feature"), "value", "n", F.lit(0).cast("long").alias("pos"))
    # each histogram is read with the bins of every population, few, and counted where it is read
    each = seeds.select("population", "feature", "value", "n", F.explode(F.array(*(F.lit(n) for n in names))).alias("base"))
    psi = population_psi(bases, each.select("population", key(F.col("base")).alias("feature"), "value", "n"))
    expected = F.substring_index("feature", "\x1f", 1)
    mean = psi.groupBy(expected.alias("expected"), F.col("population").alias("actual")).agg(F.avg("psi").alias("psi"))
    return mean.withColumn("psi", F.when(F.col("expected") == F.col("actual"), 0.0).otherwise(F.col("psi")))


def family_drift(drift: DataFrame, families: DataFrame) -> DataFrame:
    """(population, family, n, mean_psi) of families with two features or more. ``families`` has a row a feature."""
    both = drift.where("psi_oot is not null").join(families.select("feature", "family"), "feature")
    return both.groupBy("population", "family").agg(F.count(F.lit(1)).alias("n"), F.avg("psi_oot").alias("mean_psi")).where("n >= 2")


def missing_delta(seeds: DataFrame, oot: DataFrame, top: int = 10) -> DataFrame:
    """(population, feature, delta, ordinal): missing rates less those of the baseline, the greatest differences of each population first."""
    rate = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) / F.sum("n")
    both = seeds.groupBy(*POPULATION).agg(rate.alias("own")).join(oot.groupBy("feature").agg(rate.alias("base")), "feature")
    found = both.select("population", "feature", (F.col("own") - F.col("base")).alias("delta"))
    order = Window.partitionBy("population").orderBy(F.desc(F.abs(F.round("delta", 9))), "feature")
    return found.withColumn("ordinal", F.row_number().over(order)).where(F.col("ordinal") <= top)


def two_source_psi(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(feature, psi, flag) of two histograms (feature, value, n, pos)."""
    psi = population_psi(expected, actual.withColumn("population", F.lit("actual")))
    return psi.select("feature", "psi", signals.psi_flag(F.col("psi")).alias("flag"))
