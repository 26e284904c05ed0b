"""Score fusion, calibration tables and funnel evaluation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.operators.histogram import histogram, ordered
from liftwork.operators.ranking import by_score, top_size
from liftwork.operators.splitting import ranked_within
from liftwork.sources.intermediate import stored
from liftwork.sources.positions import numbered

FLOOR = 1e-12
GRID = [round(i * 0.05, 2) for i in range(21)]


def fuse(r: Column, q: Column, alpha: Column | float) -> Column:
    """Geometric mixture of two scores."""
    a = F.lit(alpha) if isinstance(alpha, (int, float)) else alpha
    return F.pow(F.greatest(r, F.lit(FLOOR)), a) * F.pow(F.greatest(q, F.lit(FLOOR)), 1 - a)


#: Accuracy of the sketches that tell where about the top k ends: all but some 4 / SKETCH of the rows are counted without their score.
SKETCH = 1000
#: More than rounding moves a score.
MARGIN = 1e-11


def _brackets(cells: DataFrame, share: float) -> dict[float, tuple[float, float]]:
    """For each alpha two values that are likely to have the quantile ``share`` between them."""
    ends = F.percentile_approx("value", [max(share - 2 / SKETCH, 0.0), min(share + 2 / SKETCH, 1.0)], SKETCH)
    return {f["alpha"]: tuple(f["ends"]) for f in cells.groupBy("alpha").agg(ends.alias("ends")).collect()}  # a row an alpha


def _cuts(cells: DataFrame, brackets: dict[float, tuple[float, float]], size: int) -> list[tuple]:
    """(alpha, cut, sure, wanted, n, pos): the last of the top ``size`` scores of each alpha, how many of the ``n`` rows with it come in, the positives before and of them.

    Rows outside an alpha's bracket count as one value on either side. If the last score turns out to be there, the alpha is counted
    again without a bracket.
    """
    ends = cells.sparkSession.createDataFrame([(a, *e) for a, e in brackets.items()], "alpha double, low double, high double")
    value = F.when(F.col("value") < F.col("low") - MARGIN, float("-inf")).when(F.col("value") > F.col("high") + MARGIN, float("inf")).otherwise(F.round("value", 12))
    ties = cells.join(F.broadcast(ends), "alpha").groupBy("alpha", value.alias("value")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0)).alias("pos"))
    last = ordered(stored(ties, "fusion-ties"), ["alpha"]).where((F.col("before") < size) & (F.col("before") + F.col("n") >= size))
    found, missed = [], {}
    for row in last.collect():  # a row an alpha
        low, high = brackets[row["alpha"]]
        if (row["value"] == float("-inf") < low) or (row["value"] == float("inf") > high):
            missed[row["alpha"]] = (float("-inf"), float("inf"))
        else:
            found.append((row["alpha"], row["value"], row["pos_before"], size - row["before"], row["n"], row["pos"]))
    return found + (_cuts(cells, missed, size) if missed else [])


def alpha_lifts(df: DataFrame, r: str, q: str, label: str, key: str, k: float = 0.10) -> DataFrame:
    """(alpha, lift) for every alpha of the grid: lift of the label in the top k by the fused score; no rows for an empty table.

    Only the four columns are written, once. The fused scores of all alphas are counted as they are made: sketches bracket
    the score at which the top k of an alpha ends, the scores within the bracket are counted one by one, and of the rows
    with the last score those first by ``key`` come in. Rows are ordered only where such a tie is split.
    """
    spark = df.sparkSession
    rows = stored(df.select(F.col(key).alias("key"), F.col(label).alias("y"), F.col(r).alias("r"), F.col(q).alias("q")), "fusion-rows")
    n, size, base = rows.agg(F.count(F.lit(1)), top_size(F.count(F.lit(1)), k), F.avg("y")).first()
    if not n:
        return spark.createDataFrame([], "alpha double, lift double")
    exploded = rows.withColumn("alpha", F.explode(F.array(*(F.lit(a) for a in GRID))))
    cells = exploded.select("alpha", "key", "y", F.nanvl(-fuse(F.col("r"), F.col("q"), F.col("alpha")), F.lit(float("inf"))).alias("value"))
    cuts = _cuts(cells, _brackets(cells, size / n), size)
    last = spark.createDataFrame(cuts, "alpha double, cut double, sure long, wanted long, n long, pos long")
    won, split = F.col("pos"), [c for c in cuts if c[3] < c[4]]
    if split:
        near = F.broadcast(last.where("wanted < n").select("alpha", "cut", "wanted"))
        tied = cells.join(near, "alpha").where((F.abs(F.col("value") - F.col("cut")) < MARGIN) | (F.col("value") == F.col("cut"))).where(F.round("value", 12) == F.col("cut"))
        placed = ranked_within(tied.select("alpha", "key", "y", "wanted", F.lit(0).alias("one")), ["alpha"], "one", ["key"], "_rank", "_n")
        hits = placed.where("_rank <= wanted").groupBy("alpha").agg(F.sum("y").alias("tied"))
        last = last.join(F.broadcast(hits), "alpha", "left")  # a row an alpha
        won = F.when(F.col("wanted") == F.col("n"), F.col("pos")).otherwise(F.coalesce("tied", F.lit(0)))
    return last.select("alpha", F.coalesce(F.try_divide((F.col("sure") + won) / size, F.lit(base)), F.lit(0.0)).alias("lift"))


def best_alpha(lifts: DataFrame) -> DataFrame:
    """One row (alpha, lift): the greatest lift; of lifts within 1e-12 the alpha closest to a half, then the smaller."""
    order = Window.orderBy(F.desc(F.round("lift", 12)), F.abs(F.col("alpha") - 0.5), "alpha")
    return lifts.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")  # a row an alpha


def fit_alpha(df: DataFrame, r: str, q: str, label: str, key: str, k: float = 0.10, min_rows: int = 2000, min_pos: int = 20) -> DataFrame:
    """One row (alpha, lift, origin): the best alpha, or a half (``default_fallback``, no lift) where rows or positives are too few to tell."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("p")).first()
    if size["n"] < min_rows or size["p"] < min_pos:
        return df.sparkSession.createDataFrame([(0.5, None, "default_fallback")], "alpha double, lift double, origin string")
    return best_alpha(alpha_lifts(df, r, q, label, key, k)).withColumn("origin", F.lit("grid"))


def funnel(df: DataFrame, stages: list[str]) -> DataFrame:
    """(stage, ordinal, n, step_cvr, cum_cvr): rows that pass all stages up to each, from one aggregation."""
    passed, aggs = F.lit(True), [F.count(F.lit(1)).alias("s0")]
    for i, s in enumerate(stages):
        passed = passed & (F.coalesce(F.col(s), F.lit(0)) > 0)
        aggs.append(F.count_if(passed).alias(f"s{i + 1}"))
    counts = df.agg(*aggs)
    rows = F.array(*(F.struct(F.lit(n).alias("stage"), F.lit(i).alias("ordinal"), F.col(f"s{i}").alias("n"), F.col(f"s{max(i - 1, 0)}").alias("before"), F.col("s0").alias("all")) for i, n in enumerate(["all", *stages])))
    flat = counts.select(F.explode(rows).alias("r")).select("r.*")
    return flat.select("stage", "ordinal", "n", F.try_divide(F.col("n").cast("double"), F.col("before")).alias("step_cvr"), F.try_divide(F.col("n").cast("double"), F.col("all")).alias("cum_cvr"))


def funnel_lift(df: DataFrame, stages: list[str], ties: list[str], k: float = 0.10, score: str = "score", value: str | None = None) -> DataFrame:
    """(stage, view, n_top, pos_top, top, population, lift): the rate of each stage in the top k and in all, absolute and given the stages before.

    With ``value`` a row value_capture has its mean in both, and the number of the top rows with a value over zero.
    """
    placed = by_score(df, ties, score).withColumn("top", F.col("rank") <= top_size(F.col("total"), k))
    top, every = F.col("top"), F.lit(True)
    aggs, rows = [], []

    def add(name: str, view: str, what: Column, hit: Column, given: Column) -> None:
        i = len(rows)
        aggs.extend([F.count_if(top & given).alias(f"n{i}"), F.count_if(top & given & hit).alias(f"h{i}"), F.avg(F.when(top & given, what)).alias(f"t{i}"), F.avg(F.when(given, what)).alias(f"p{i}")])
        rows.append(F.struct(F.lit(name).alias("stage"), F.lit(view).alias("view"), F.col(f"n{i}").alias("n_top"), F.col(f"h{i}").alias("pos_top"), F.col(f"t{i}").alias("top"), F.col(f"p{i}").alias("population")))

    before = every
    for s in stages:
        hit = F.coalesce(F.col(s), F.lit(0)) > 0
        add(s, "absolute", hit.cast("double"), hit, every)
        add(s, "conditional", hit.cast("double"), hit, before)
        before = before & hit
    if value is not None:
        amount = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
        add("value_capture", "absolute", amount, amount > 0, every)
    flat = placed.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return flat.withColumn("lift", F.try_divide(F.col("top"), F.col("population")))


def share_curve(df: DataFrame, value: str, ties: list[str], shares: list[float], score: str = "score") -> DataFrame:
    """(k, top, population, lift): the mean of a value in the top k for each share, from one pass over the ranks."""
    placed = by_score(df, ties, score)
    step = F.array(*(F.when(F.col("rank") <= top_size(F.col("total"), k), F.lit(k)) for k in shares))
    cells = placed.select(F.col(value).cast("double").alias("v"), F.explode(F.filter(step, lambda k: k.isNotNull())).alias("k"))
    population = df.agg(F.avg(F.col(value).cast("double")).alias("population"))
    out = cells.groupBy("k").agg(F.avg("v").alias("top")).crossJoin(F.broadcast(population))  # one row
    return out.withColumn("lift", F.try_divide(F.col("top"), F.col("population")))


def _pooled(rows) -> list[tuple[float, float, float, float]]:
    """Adjacent violators of rows (positives, n, lowest score, highest score) pooled."""
    pools: list[list[float]] = []
    for s, m, low, high in rows:
        pools.append([s, m, low, high])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s2, m2, _, top = pools.pop()
            pools[-1] = [pools[-1][0] + s2, pools[-1][1] + m2, pools[-1][2], top]
    return [tuple(p) for p in pools]


#: Pools that are pooled together in one task.
POOLS = 20_000


def _violators(pools: DataFrame) -> int:
    """How many neighbours, by ``_row``, have rates out of order."""
    after = pools.select((F.col("_row") - 1).alias("_row"), F.col("p").alias("_p"), F.col("n").alias("_n"))
    return pools.join(after, "_row").where(F.col("p") * F.col("_n") >= F.col("_p") * F.col("n")).count()


def isotonic_table(df: DataFrame, score: str = "score", label: str = "y", min_rows: int = 200, min_pos: int = 10) -> DataFrame:
    """(x, y): an isotonic calibration table by pooling adjacent violators; empty if the data do not carry one.

    Distinct scores are pooled by ranges of ``POOLS``, and the pools again by ranges that lie across the borders of the
    ones before, until no neighbours are out of order: in whatever order violators are pooled, the pools are the same.
    No task has more than a range. Each pool gives its ends.
    """
    hist = histogram(df.select(F.lit("score").alias("feature"), F.col(score).cast("double").alias("value"), F.col(label).alias("y")))
    total = hist.where("value is not null").agg(F.sum("n").alias("n"), F.sum("pos").alias("p"), F.count(F.lit(1)).alias("d")).first()
    none = hist.sparkSession.createDataFrame([], "x double, y double")
    if not total["n"] or total["n"] < min_rows or total["p"] < min_pos or total["p"] == total["n"] or total["d"] < 2:
        return none
    schema = "p double, n double, low double, high double"

    def pool(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("low")
        return pd.DataFrame(_pooled(zip(frame["p"], frame["n"], frame["low"], frame["high"], strict=True)), columns=["p", "n", "low", "high"], dtype="float64")

    value = F.col("value")
    pools = numbered(hist.where("value is not null").select(F.col("pos").cast("double").alias("p"), F.col("n").cast("double").alias("n"), value.alias("low"), value.alias("high")), ["low"], "_row")
    shift = 0
    while True:
        ranges = F.floor((F.col("_row") + shift) / POOLS).alias("_range")
        pools = pools.select(ranges, "p", "n", "low", "high").groupBy("_range").applyInPandas(lambda f: pool(f.drop(columns="_range")), schema)
        pools = stored(numbered(pools, ["low"], "_row"), "isotonic-pools")
        if not _violators(pools):
            break
        shift = POOLS // 2 - shift
    ends = F.explode(F.array_distinct(F.array("low", "high")))
    return pools.select(ends.alias("x"), (F.col("p") / F.col("n")).alias("y"))


def interpolated(score: Column, table: list[tuple[float, float]]) -> Column:
    """The calibrated value of a score: linear between the points of the table, level outside."""
    points = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in table))
    below, above = F.filter(points, lambda p: p["x"] <= score), F.filter(points, lambda p: p["x"] > score)
    a, b = F.element_at(below, -1), F.element_at(above, 1)
    inside = a["y"] + (score - a["x"]) * (b["y"] - a["y"]) / (b["x"] - a["x"])
    return F.when(score.isNull(), None).when(F.size(below) == 0, float(table[0][1])).when(F.size(above) == 0, float(table[-1][1])).otherwise(inside)
