"""Leakage-safe splits: by day, by rows, stratified, forward folds."""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.operators.histogram import quantiles
from liftwork.sources.intermediate import stored
from liftwork.sources.positions import numbered

RATIOS = (0.70, 0.15, 0.15)


def day_cuts(df: DataFrame, ratios=RATIOS, day: str = "day") -> DataFrame:
    """One row (cut1, cut2): the last days of train and valid. Days are never split.

    A cut is the first day by which round(ratio * N) rows are in, N with the rows without a day; half
    rounds to even. Each of the three parts keeps a day at least. The window runs over days, not rows.
    """
    days = df.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    total = days.agg(F.sum("n").alias("total"))
    order = Window.orderBy(day)
    cum = days.where(F.col(day).isNotNull()).select(F.col(day).alias("d"), F.sum("n").over(order).alias("cum"), F.row_number().over(order).alias("pos"))
    placed = cum.crossJoin(F.broadcast(total)).withColumn("days", F.count(F.lit(1)).over(Window.partitionBy()))  # one row
    reach = lambda r: F.min(F.when(F.col("cum") >= F.bround(F.col("total") * r), F.col("pos")))
    cuts = placed.agg(F.max("days").alias("days"), reach(ratios[0]).alias("p1"), reach(ratios[0] + ratios[1]).alias("p2"))
    p1 = F.least(F.coalesce("p1", "days"), F.col("days") - 2)
    cuts = cuts.withColumn("p1", p1).withColumn("p2", F.greatest(F.least(F.coalesce("p2", "days"), F.col("days") - 1), F.col("p1") + 1))
    at = cum.crossJoin(F.broadcast(cuts))  # one row
    return at.agg(F.max(F.when(F.col("pos") == F.col("p1"), F.col("d"))).alias("cut1"), F.max(F.when(F.col("pos") == F.col("p2"), F.col("d"))).alias("cut2"))


def _after(day: Column, days: int) -> Column:
    return F.date_format(F.date_add(F.to_date(day.cast("string"), "yyyyMMdd"), days), "yyyyMMdd").cast("int")


def split_by_day(df: DataFrame, ratios=RATIOS, embargo: int = 0, day: str = "day") -> DataFrame:
    """``df`` with split: train, valid, oot, or NULL for rows within ``embargo`` days after a cut. Rows without a day are oot."""
    d = F.col(day)
    out = df.crossJoin(F.broadcast(day_cuts(df, ratios, day)))  # one row
    split = F.when(d.isNull(), "oot").when(d <= F.col("cut1"), "train").when(d <= F.col("cut2"), "valid").otherwise("oot")
    if embargo:
        purged = F.lit(False)
        for cut in ("cut1", "cut2"):
            purged = purged | ((d > F.col(cut)) & (d <= _after(F.col(cut), embargo)))
        split = F.when(F.coalesce(purged, F.lit(False)), None).otherwise(split)
    return out.withColumn("split", split).drop("cut1", "cut2")


def ranked(df: DataFrame, key: str, ties: list[str], descending: bool = False, rank: str = "rank") -> DataFrame:
    """``df`` with a rank from 1 in the order of a numeric key (NULL last) and of tie-breaking columns.

    No task sees all rows, nor all rows of one key value: ranges of the whole order are numbered.
    """
    value = F.col(key).cast("double")
    placed = numbered(df, [value.desc_nulls_last() if descending else value.asc_nulls_last(), *ties], "_row")
    return placed.withColumn(rank, F.col("_row") + 1).drop("_row")


def split_by_rank(df: DataFrame, key: str, ties: list[str], ratios=RATIOS) -> DataFrame:
    """``df`` with split by its rank in a total order: for tables with fewer than three days."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    out = ranked(df, key, ties).crossJoin(F.broadcast(total))  # one row
    first, second = F.bround(F.col("_total") * ratios[0]), F.bround(F.col("_total") * (ratios[0] + ratios[1]))
    return out.withColumn("split", F.when(F.col("rank") <= first, "train").when(F.col("rank") <= second, "valid").otherwise("oot")).drop("rank", "_total")


def ranked_within(df: DataFrame, by: list[str], key: str, ties: list[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """``df`` with a rank from 1 within each group, in the order of a numeric key (NULL last) and of ties, and the size of the group.

    Rows with NULL in a column of ``by`` are groups like others. All rows are numbered by ranges of the whole order; a
    row's rank is its number less the first one of its group, so neither a large group nor a value of many rows
    is one task's work.
    """
    placed = numbered(df, [*by, F.col(key).cast("double").asc_nulls_last(), *ties], "_row")
    groups = stored(placed.groupBy(*(F.col(c).alias(f"_{c}") for c in by)).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias(total)), "rank-groups")
    on = reduce(and_, (placed[c].eqNullSafe(groups[f"_{c}"]) for c in by))
    return placed.join(groups, on).withColumn(rank, F.col("_row") - F.col("_first") + 1).drop("_row", "_first", *(f"_{c}" for c in by))


def split_stratified(df: DataFrame, key: str, label: str = "y", ratios=RATIOS, seed: int = 42) -> DataFrame:
    """``df`` with split: in each label rows go by the MD5 of key and seed, with exact counts. Rows without a label are a stratum of their own."""
    digest = F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed))))
    out = df.withColumn("_digest", digest).withColumn("_number", F.conv(F.substring("_digest", 1, 12), 16, 10).cast("double"))  # 48 bits, exact
    placed = ranked_within(out, [label], "_number", ["_digest", key], "_rank", "_total")
    first = F.bround(F.col("_total") * ratios[0])
    split = F.when(F.col("_rank") <= first, "train").when(F.col("_rank") <= first + F.bround(F.col("_total") * ratios[1]), "valid").otherwise("oot")
    return placed.withColumn("split", split).drop("_digest", "_number", "_rank", "_total")


def split_rows(df: DataFrame, ties: list[str], ratios=RATIOS, embargo: int = 0, day: str = "day", label: str = "y") -> DataFrame:
    """``df`` with split: by day, by row rank where there are fewer than three days, stratified where there is no day column."""
    if day not in df.columns:
        return split_stratified(df, ties[0], label, ratios)
    if df.where(F.col(day).isNotNull()).select(day).distinct().limit(3).count() < 3:
        return split_by_rank(df, day, ties, ratios)
    return split_by_day(df, ratios, embargo, day)


def _fold_cuts(days: list[tuple[int, int]], folds: int) -> list[int]:
    """The last days of all blocks but the last one, from (day, rows) in order.

    Cut i is the first day by which its share of the rows is in; a day that is a cut already gives way to
    the next one, and the last day stays for the last block.
    """
    if len(days) < 2:
        raise ValueError("forward folds need two days at least")
    blocks = min(folds + 1, len(days))
    upto = list(accumulate(n for _, n in days))
    cuts: list[int] = []
    for i in range(1, blocks):
        place = min(bisect_left(upto, max(1, round(upto[-1] * i / blocks))), len(days) - 2)
        if cuts:
            place = max(place, next(k for k, (d, _) in enumerate(days) if d == cuts[-1]) + 1)
        if place < len(days) - 1:
            cuts.append(days[place][0])
    return cuts


def forward_folds(df: DataFrame, folds: int = 4, day: str = "day", min_test_rows: int = 50) -> DataFrame:
    """``df`` with block 0..folds: about equal shares of rows in the order of days; fold i trains on blocks 0..i and tests on i + 1.

    Days are never split. A block under ``min_test_rows`` joins the one before it, unless this is the
    first. Rows without a day train always: block 0. The driver sees a row a day.
    """
    days = [(r[day], r["n"]) for r in df.where(F.col(day).isNotNull()).groupBy(day).agg(F.count(F.lit(1)).alias("n")).orderBy(day).collect()]
    cuts = _fold_cuts(days, folds)
    sizes = [0] * (len(cuts) + 1)
    for d, n in days:
        sizes[bisect_left(cuts, d)] += n
    number, numbers = 0, [0]
    for k, n in enumerate(sizes[1:], 1):
        number += n >= min_test_rows or number == 0
        numbers.append(number)
    raw = sum(((F.col(day) > c).cast("int") for c in cuts), F.lit(0))
    return df.withColumn("block", F.when(F.col(day).isNull(), 0).otherwise(F.get(F.array(*(F.lit(x) for x in numbers)), raw)))


def psi_sides(df: DataFrame, mode: str = "train_halves", day: str = "day") -> DataFrame:
    """``df`` (with split) with side: expected, actual or NULL.

    train_halves: earlier and later half of train; halves: of all rows; train_vs_rest: train and the others.
    Without days all modes take the halves of a hash of the row, a split that tells nothing of time.
    """
    if day not in df.columns:
        return df.withColumn("side", F.when(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0, "expected").otherwise("actual"))
    train = F.col("split") == "train"
    if mode == "train_vs_rest":
        return df.withColumn("side", F.when(train, "expected").otherwise("actual"))
    if mode not in ("train_halves", "halves"):
        raise ValueError(f"unknown mode {mode}")
    some = F.lit(True) if mode == "halves" else train
    counts = df.where(some & F.col(day).isNotNull()).groupBy(F.lit("day").alias("feature"), F.col(day).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("pos"))
    mid = quantiles(counts, {"_mid": 0.5}).select(F.floor("_mid").alias("_mid"))
    early = F.coalesce(F.col(day) <= F.col("_mid"), F.lit(False))
    return df.crossJoin(F.broadcast(mid)).withColumn("side", F.when(some, F.when(early, "expected").otherwise("actual"))).drop("_mid")  # one row


def exact_sample(df: DataFrame, key: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows of each label, or all there are: those first by the MD5 of key and seed."""
    out = df.withColumn("_digest", F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed)))))
    placed = ranked_within(out.withColumn("_number", F.conv(F.substring("_digest", 1, 12), 16, 10).cast("double")), [label], "_number", ["_digest", key], "_rank", "_total")
    return placed.where(F.col("_rank") <= n).drop("_digest", "_number", "_rank", "_total")


def calibration_carve(df: DataFrame, order: list[str], fraction: float = 0.5, label: str = "y", min_rows: int = 200, min_pos: int = 10) -> DataFrame:
    """``df`` (with split) with calibration: the later part of valid, none if it has too few rows or positives, or one class.

    All rows stay, those without a split (an embargo's) too: they are not for calibration.
    """
    placed = ranked_within(df, ["split"], order[0], order[1:], "_rank", "_total")
    marked = placed.withColumn("calibration", F.col("split").eqNullSafe("valid") & (F.col("_rank") > F.col("_total") - F.bround(F.col("_total") * fraction)))
    size = marked.where("calibration").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("p"))
    enough = size.select(((F.col("n") >= min_rows) & (F.col("p") >= min_pos) & (F.col("p") < F.col("n"))).alias("_enough"))
    return marked.crossJoin(F.broadcast(enough)).withColumn("calibration", F.col("calibration") & F.col("_enough")).drop("_rank", "_total", "_enough")  # one row


def shard(key: Column, shards: int) -> Column:
    """A stable shard number of a key."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")
