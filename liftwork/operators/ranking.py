"""Ranking and classification metrics of a scored, labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.operators.histogram import ordered
from liftwork.operators.splitting import ranked, ranked_within
from liftwork.sources.intermediate import stored


def top_size(n: Column, k: float | int) -> Column:
    """How many rows the top k are: a share of all rows, at least one, or a number."""
    if isinstance(k, float) and 0 < k <= 1:
        return F.greatest(F.lit(1), F.ceil(n * k)).cast("long")
    return F.least(F.lit(int(k)), n).cast("long")


def by_score(df: DataFrame, ties: list[str], score: str = "score") -> DataFrame:
    """``df`` with rank (best score first, ties by ``ties``) and total."""
    return ranked(df, score, ties, descending=True).crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("total"))))  # one row


def top_k_mask(df: DataFrame, k: float | int, ties: list[str]) -> DataFrame:
    return by_score(df, ties).withColumn("top", F.col("rank") <= top_size(F.col("total"), k)).drop("rank", "total")


def at_k(df: DataFrame, ks: list[float | int], ties: list[str]) -> DataFrame:
    """(k, precision, recall, lift) for every k."""
    placed = by_score(df, ties)
    cells = F.array(*(F.struct(F.lit(float(k)).alias("k"), (F.col("rank") <= top_size(F.col("total"), k)).alias("top")) for k in ks))
    sums = placed.select("y", "total", F.explode(cells).alias("c")).groupBy("c.k").agg(
        F.count_if("c.top").alias("taken"), F.sum(F.when(F.col("c.top"), F.col("y")).otherwise(0)).alias("hits"), F.sum("y").alias("positives"), F.max("total").alias("total")
    )
    precision = F.col("hits") / F.col("taken")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return sums.select("k", precision.alias("precision"), zero(F.try_divide(F.col("hits").cast("double"), F.col("positives"))).alias("recall"), zero(F.try_divide(precision, F.col("positives") / F.col("total"))).alias("lift"))


def thresholds(df: DataFrame, by: list[str] = [], score: str = "score", n: str | None = None) -> DataFrame:  # noqa: B006
    """(by..., score, n, pos, cn, cp, total, positives): a row a distinct score, best first, with running sums. NULL scores are one, the last.

    ``n``: a column that tells how many rows each row stands for.
    """
    count = F.lit(1) if n is None else F.col(n)
    keys = by or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    value = F.coalesce(-F.col(score).cast("double"), F.lit(float("inf")))
    ties = stored(rows.groupBy(*keys, value.alias("value")).agg(F.sum(count.cast("long")).alias("n"), F.sum(F.col("y").cast("long") * count).alias("pos")), "score-ties")
    upto = lambda before, own: (F.col(before) + F.col(own))
    return ordered(ties, keys).select(*by, (-F.col("value")).alias(score), "n", "pos", upto("before", "n").alias("cn"), upto("pos_before", "pos").alias("cp"), "total", "positives")


def curve_metrics(df: DataFrame, by: list[str] = [], score: str = "score", n: str | None = None) -> DataFrame:  # noqa: B006
    """(by..., n, base_rate, roc_auc, pr_auc, ks): tie-safe; 0 with a single class. ``n``: how many rows each row stands for."""
    return _curves(thresholds(df, by, score, n), by)


def _curves(t: DataFrame, by: list[str]) -> DataFrame:
    neg, cneg, negatives = F.col("n") - F.col("pos"), F.col("cn") - F.col("cp"), F.col("total") - F.col("positives")
    # pairs won by the negatives after this score, half of those that tie
    won = F.col("pos") * (negatives - cneg) + F.col("pos") * neg / 2
    sums = t.groupBy(*by).agg(
        F.max("total").alias("n"), (F.max("positives") / F.max("total")).alias("base_rate"), F.try_divide(F.sum(won), F.max(F.col("positives") * negatives)).alias("auc"),
        F.try_divide(F.sum(F.col("pos") * F.col("cp") / F.col("cn")), F.max("positives")).alias("ap"),
        F.max(F.abs(F.try_divide(F.col("cp").cast("double"), F.col("positives")) - F.try_divide(cneg.cast("double"), negatives))).alias("ks"),
        F.max((F.col("positives") > 0) & (negatives > 0)).alias("two"),
    )
    only = lambda c: F.when(F.col("two"), F.col(c)).otherwise(0.0)
    return sums.select(*by, "n", "base_rate", only("auc").alias("roc_auc"), only("ap").alias("pr_auc"), only("ks").alias("ks"))


def evaluated(df: DataFrame, ties: list[str], k: float = 0.10, group: str = "split", score: str = "score") -> DataFrame:
    """``curve_metrics`` of every group with precision, recall and lift in its top k.

    One table of scores gives the curves and the score at which the top k ends; of the rows with that score
    those first by ``ties`` come in, and only they are ordered.
    """
    t = stored(thresholds(df, [group], score), "score-curve")
    size = top_size(F.col("total"), k)
    above = F.col("cn") - F.col("n")
    cut = t.where((above < size) & (F.col("cn") >= size))  # a row a group
    cut = cut.select(F.col(group).alias("_group"), F.col(score).alias("_cut"), (F.col("cp") - F.col("pos")).alias("_sure"), size.alias("_size"), (size - above).alias("_wanted"), "total", "positives")
    same = df[group].eqNullSafe(F.col("_group")) & (F.coalesce(df[score].cast("double"), F.lit(float("-inf"))) == F.col("_cut"))
    last = ranked_within(df.join(F.broadcast(cut.select("_group", "_cut", "_wanted")), same).withColumn("_one", F.lit(0)).select(group, "y", "_one", "_wanted", *ties), [group], "_one", ties, "_rank", "_n")
    won = last.where(F.col("_rank") <= F.col("_wanted")).groupBy(F.col(group).alias("_of")).agg(F.sum("y").alias("_won"))
    found = cut.join(won, F.col("_group").eqNullSafe(F.col("_of")), "left")
    hits = F.col("_sure") + F.coalesce("_won", F.lit(0))
    precision = hits / F.col("_size")
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    at = found.select("_group", precision.alias("precision_at_k"), zero(hits.cast("double"), F.col("positives")).alias("recall_at_k"), zero(precision, F.col("positives") / F.col("total")).alias("lift_at_k"))
    curves = _curves(t, [group])
    return curves.join(at, curves[group].eqNullSafe(at["_group"])).drop("_group")


def with_companions(df: DataFrame) -> DataFrame:
    """The rows of ``df`` (split, calibration, all_missing) once more for each further group: valid_calib and oot_excl_all_na.

    Valid itself keeps the rows that are not held out for calibration. The last group is there if some but not all rows of oot are empty.
    """
    oot = F.col("split") == "oot"
    mixed = df.where(oot).agg((F.max("all_missing") & ~F.min("all_missing")).alias("_mixed"))
    held = (F.col("split") == "valid") & F.col("calibration")
    groups = F.array(F.when(held, "valid_calib").otherwise(F.col("split")), F.when(oot & ~F.col("all_missing") & F.col("_mixed"), "oot_excl_all_na"))
    out = df.crossJoin(F.broadcast(mixed)).withColumn("split", F.explode(F.filter(groups, lambda g: g.isNotNull())))  # one row
    return out.drop("_mixed")


def ks_by_row(df: DataFrame, ties: list[str]) -> DataFrame:
    """One row (ks): the greatest gap at any row position, so equal scores count in the order of ``ties``."""
    placed = by_score(df, ties).select("y", "rank").withColumn("bucket", F.floor(F.col("rank") / 10_000))
    sums = placed.groupBy("bucket").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    before = sums.select("bucket", zero(F.sum("p").over(upto)).alias("bp"), zero(F.sum("q").over(upto)).alias("bq"), F.sum("p").over(Window.partitionBy()).alias("tp"), F.sum("q").over(Window.partitionBy()).alias("tq"))
    own = Window.partitionBy("bucket").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gaps = placed.join(before, "bucket").select(F.abs((F.col("bp") + F.sum("y").over(own)) / F.col("tp") - (F.col("bq") + F.sum(1 - F.col("y")).over(own)) / F.col("tq")).alias("gap"))
    return gaps.agg(F.coalesce(F.max("gap"), F.lit(0.0)).alias("ks"))


def binned_lift(df: DataFrame, ties: list[str], bins: int = 10) -> DataFrame:
    """(bin, n, pos, rate, population, lift, recall, precision): bins are cut at round(i * n / bins), the last four are cumulative."""
    placed = by_score(df, ties)
    cuts = [F.bround(F.col("total") * i / bins) for i in range(1, bins)]
    bin_ = sum(((F.col("rank") > c).cast("int") for c in cuts), F.lit(1))
    sums = placed.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    upto, whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    cn, cp, n, p = F.sum("n").over(upto), F.sum("pos").over(upto), F.sum("n").over(whole), F.sum("pos").over(whole)
    return sums.select("bin", "n", "pos", (F.col("pos") / F.col("n")).alias("rate"), (cn / n).alias("population"), ((cp / cn) / (p / n)).alias("lift"), (cp / p).alias("recall"), (cp / cn).alias("precision"))


def calibration_bins(df: DataFrame, bins: int = 10, score: str = "score") -> DataFrame:
    """(bin, n, mean_score, rate) over equal widths of the score; empty bins are left out."""
    place = F.greatest(F.lit(0), F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))).cast("int")
    return df.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg("y").alias("rate"))
