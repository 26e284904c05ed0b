"""Per-feature signals from bin counts: WOE, IV, PSI, lift, Gini and missing statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.operators.histogram import ordered, quantile, quantiles

EPSILON = 1e-6


def woe_table(counts: DataFrame) -> DataFrame:
    """(feature, bin, n, pos, woe, part): part is the bin's share of the information value."""
    whole = Window.partitionBy("feature")
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    p, q = F.sum(pos).over(whole), F.sum(neg).over(whole)
    shares = counts.withColumns({"_p": (pos + EPSILON) / (p + EPSILON), "_q": (neg + EPSILON) / (q + EPSILON), "_pp": p, "_qq": q})
    woe = F.log(F.col("_p") / F.col("_q"))
    gap = F.try_divide(pos.cast("double"), F.col("_pp")) - F.try_divide(neg.cast("double"), F.col("_qq"))
    return shares.select("feature", "bin", "n", "pos", woe.alias("woe"), (F.coalesce(gap, F.lit(0.0)) * woe).alias("part"))


def information_value(woe: DataFrame) -> DataFrame:
    """(feature, iv, n_bins); a bin of missing values counts for the value, not for the number of bins."""
    return woe.groupBy("feature").agg(F.sum("part").alias("iv"), F.count_if(F.col("bin") >= 0).alias("n_bins"))


def monotonic(woe: DataFrame) -> DataFrame:
    """(feature, monotonic): whether WOE never falls, or never rises, over the real bins."""
    step = F.col("woe") - F.lag("woe").over(Window.partitionBy("feature").orderBy("bin"))
    steps = woe.where("bin >= 0").select("feature", step.alias("step"))
    up, down = F.coalesce(F.min("step"), F.lit(0.0)) >= -EPSILON, F.coalesce(F.max("step"), F.lit(0.0)) <= EPSILON
    return steps.groupBy("feature").agg((up | down).alias("monotonic"))


def psi(sides: DataFrame, by: list[str] = ["feature"]) -> DataFrame:  # noqa: B006
    """(by..., psi) of rows (by..., bin, expected, actual) of counts."""
    whole = Window.partitionBy(*by)
    share = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.sum(c).over(whole)), F.lit(0.0))
    floor = lambda c: F.when(c <= 0, EPSILON).otherwise(c)
    both = sides.select(*by, floor(share("expected")).alias("e"), floor(share("actual")).alias("a"))
    return both.groupBy(*by).agg(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"))


def psi_flag(value: Column, shift: float = 0.10, broken: float = 0.25) -> Column:
    return F.when(value < shift, "stable").when(value < broken, "shift").otherwise("broken")


def lift_at_k(counts: DataFrame, k: float = 0.10) -> DataFrame:
    """(feature, lift, concentration): whole bins are taken by falling rate, missing last of equals, until k of the rows are in."""
    whole = Window.partitionBy("feature")
    counts = counts.where("n > 0")
    rate = F.col("pos") / F.col("n")
    order = whole.orderBy(F.desc("rate"), F.when(F.col("bin") < 0, 1 << 30).otherwise(F.col("bin")))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.withColumn("rate", rate).select(
        "feature", "n", "pos", F.sum("n").over(upto).alias("cn"), F.row_number().over(order).alias("r"), F.sum("n").over(whole).alias("total"), F.sum("pos").over(whole).alias("positives"),
        F.max(F.col("bin") >= 0).over(whole).alias("binned"),
    )
    target = F.greatest(F.lit(1.0), F.ceil(F.col("total") * k))
    taken = rows.where(F.col("cn") - F.col("n") < target)
    both = taken.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.max("total").alias("total"), F.max("positives").alias("positives"), F.sum(F.when(F.col("r") == 1, F.col("pos"))).alias("top"), F.max("binned").alias("binned"))
    base = F.col("positives") / F.col("total")
    # without edges all rows are in the missing bin
    lift = F.when(~F.col("binned"), 1.0).otherwise(F.coalesce(F.try_divide(F.col("pos") / F.col("n"), base), F.lit(0.0)))
    return both.select("feature", lift.alias("lift"), F.coalesce(F.try_divide(F.col("top").cast("double"), F.col("positives")), F.lit(0.0)).alias("concentration"))


def gini(hist: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """(feature, gini): |2 AUC - 1| with missing values at the feature's median; 0 without two known values or two classes among them.

    Ranks follow from the counts of smaller values; rows without a value stand among those of the median. ``placed``:
    ``ordered(hist)``, if it is there already.
    """
    placed = ordered(hist) if placed is None else placed
    missing = hist.where("value is null").select("feature", F.col("n").alias("mn"), F.col("pos").alias("mp"))
    middle = placed.groupBy("feature").agg(quantile(0.5).alias("median"), F.sum("n").alias("known"), F.sum("pos").alias("kp"))
    middle = middle.join(missing, "feature", "left").fillna(0, ["mn", "mp"])  # a row a feature
    v, m = F.col("value"), F.col("median")
    rank = F.col("before") + (F.col("n") + 1) / 2 + F.when(v > m, F.col("mn")).when(v == m, F.col("mn") / 2).otherwise(0)
    sums = placed.join(F.broadcast(middle), "feature").groupBy("feature", "known", "kp", "mn", "mp").agg(
        F.sum(rank * F.col("pos")).alias("ranks"), F.sum(F.when(v < m, F.col("n")).otherwise(0)).alias("under"), F.sum(F.when(v == m, F.col("n")).otherwise(0)).alias("equal")
    )
    ranks = F.col("ranks") + F.col("mp") * (F.col("under") + (F.col("equal") + F.col("mn") + 1) / 2)
    p, q = F.col("kp") + F.col("mp"), F.col("known") + F.col("mn") - F.col("kp") - F.col("mp")
    real = (F.col("known") >= 2) & (F.col("kp") > 0) & (F.col("kp") < F.col("known"))
    auc = F.try_divide(ranks - p * (p + 1) / 2, (p * q).cast("double"))
    found = sums.select("feature", F.when(real, F.abs(2 * auc - 1)).otherwise(0.0).alias("gini"))
    return hist.select("feature").distinct().join(found, "feature", "left").fillna(0.0, ["gini"])


def missing_stats(hist: DataFrame) -> DataFrame:
    """(feature, missing_rate, n_unique, n_total)."""
    return hist.groupBy("feature").agg(
        F.coalesce(F.try_divide(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).cast("double"), F.sum("n")), F.lit(0.0)).alias("missing_rate"),
        F.count("value").alias("n_unique"), F.sum("n").alias("n_total"),
    )


def missing_report(hist: DataFrame, types: dict[str, str]) -> DataFrame:
    """``missing_stats`` with the type that each feature had before it was cleaned, most missing first."""
    names = hist.sparkSession.createDataFrame(list(types.items()), "feature string, dtype string")
    return missing_stats(hist).join(F.broadcast(names), "feature", "left").select("feature", "missing_rate", "n_unique", "dtype", "n_total").orderBy(F.desc("missing_rate"), "feature")


def profile(hist: DataFrame, by: list[str] = ["feature"]) -> DataFrame:  # noqa: B006
    """(by..., n, missing_rate, mean, median, p10, p90) of the known values."""
    sums = hist.groupBy(*by).agg(
        F.sum("n").alias("n"), (F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("missing_rate"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).cast("double")).alias("mean"),
    )
    return sums.join(quantiles(hist, {"median": 0.5, "p10": 0.1, "p90": 0.9}, by), by, "left")


def histogram(values: DataFrame, bins: int = 30) -> DataFrame:
    """(feature, bin, n, rate) over equal widths between the least and the greatest value, the last bin closed."""
    ends = values.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    there = values.where("value is not null").join(F.broadcast(ends), "feature")  # a row a feature
    place = F.coalesce(F.floor(F.try_divide((F.col("value") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(0)).cast("int")
    return there.groupBy("feature", F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("rate"))
