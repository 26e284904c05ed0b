"""All signals of all features, each over the rows that its mask picks, from one table of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwork.operators import correlation, signals
from liftwork.operators.binning import counted, equal_frequency_edges
from liftwork.operators.histogram import ordered
from liftwork.sources.intermediate import stored


def scan_masked(wide: DataFrame, features: list[str], supervised: Column, unsupervised: Column, expected: Column, actual: Column, label: str = "y", threshold: float = 0.95, n_bins: int = 10) -> DataFrame:
    """(feature, iv, n_bins, monotonic, lift, concentration, gini, missing_rate, n_unique, n_total, psi, n_corr), best value first.

    ``supervised`` rows give value, lift and Gini, with edges of their own, and the correlations (n_corr: partners at the
    threshold or over it); ``unsupervised`` rows the missing rates; ``expected`` and ``actual`` rows the stability, with
    edges of the expected ones. A mask that is NULL picks no row. All but the correlations is read from one table with a row
    a distinct value and the counts of each mask; a feature without rows in a mask has 0 there, and a lift of 1.
    """
    on = lambda c: F.coalesce(c, F.lit(False))
    marks = {"_s": on(supervised), "_u": on(unsupervised), "_e": on(expected), "_a": on(actual)}
    picked = wide.select(*(F.col(f).cast("double").alias(f) for f in features), F.col(label).alias("_y"), *(c.alias(m) for m, c in marks.items()))
    long = picked.unpivot(["_y", *marks], features, "feature", "value")
    count = lambda m: F.sum(F.col(m).cast("long"))
    positives = F.sum(F.when(F.col("_s"), F.col("_y")).otherwise(0).cast("long")).alias("p")
    cells = stored(long.groupBy("feature", "value").agg(*(count(m).alias(m) for m in marks), positives), "masked-counts")
    part = lambda m, pos=None: cells.where(F.col(m) > 0).select("feature", "value", F.col(m).alias("n"), (F.lit(0).cast("long") if pos is None else F.col(pos)).alias("pos"))

    hist = part("_s", "p")
    placed = ordered(hist)
    counts = stored(counted(hist, equal_frequency_edges(hist, n_bins, placed=placed)), "masked-bins")
    woe = signals.woe_table(counts)
    bins = equal_frequency_edges(part("_e"), n_bins)
    sides = counted(part("_e"), bins).withColumnRenamed("n", "expected").drop("pos").join(counted(part("_a"), bins).withColumnRenamed("n", "actual").drop("pos"), ["feature", "bin"], "full")
    stable = signals.psi(sides.fillna(0, ["expected", "actual"]))
    pairs = correlation.edges(picked.where("_s").select(*features), features, threshold)
    partners = pairs.select(F.explode(F.array("f1", "f2")).alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n_corr"))
    parts = [signals.information_value(woe), signals.monotonic(woe), signals.lift_at_k(counts), signals.gini(hist, placed), signals.missing_stats(part("_u")), stable, partners]
    names = wide.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    out = reduce(lambda a, b: a.join(b, "feature", "left"), parts, names)
    out = out.fillna({"iv": 0.0, "lift": 1.0, "gini": 0.0, "concentration": 0.0, "psi": 0.0, "missing_rate": 0.0, "n_unique": 0, "n_total": 0, "n_corr": 0})
    return out.orderBy(F.desc("iv"), "feature")
