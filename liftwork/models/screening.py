"""Screens that use models: probing gains, null importance, permutation and stability ranks, forward cross-validation."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.models.boosting import TRAIN, VALID, Model, Run, best_splits, evaluate, fit, fit_table, importances, rank_shares
from liftwork.operators.binning import equal_frequency_edges
from liftwork.operators.histogram import histogram
from liftwork.operators.ranking import curve_metrics
from liftwork.sources.intermediate import stored
from liftwork.sources.positions import numbered

_BITS = 48


def train_edges(train: DataFrame, features: list[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Equal-frequency edges of each feature, fitted on ``train`` alone: a short list a feature."""
    values = train.select(*(F.col(f).cast("double").alias(f) for f in features)).unpivot([], features, "feature", "value")
    found = {r["feature"]: r["edges"] for r in equal_frequency_edges(histogram(values, None), n_bins).select("feature", "edges").collect()}
    return {f: found[f] for f in features}


def zero_as_missing(df: DataFrame, features: list[str], treat_zero: bool = True, sentinels: tuple = ()) -> DataFrame:
    """``df`` as the probing model sees it: zeros count as missing if that is wanted, or else if 0 is among the sentinels.

    For tables of counts, where 0 and no record say the same. Only the screen is concerned, not what is trained later.
    """
    if not treat_zero and 0 not in sentinels:
        return df
    return df.withColumns({f: F.when(F.col(f) != 0, F.col(f)) for f in features})


def roles(split: Column) -> Column:
    """Train and valid rows learn and stop; those of oot and of no split do neither."""
    return F.when(split == "train", TRAIN).when(split == "valid", VALID).otherwise(0)


def probing(df: DataFrame, key: str, features: list[str], label: str = "y", runs: list[Run] | None = None, rounds: int | None = 20, patience: int = 5, metric: str = "aucpr", weight: Column | None = None) -> tuple[list[Model], DataFrame]:
    """Models of ``df`` (with split), and (run, feature, gain, weight, cover, their rank shares, coverage).

    Trees are grown on train and end by valid, with ``rounds`` None by valid alone; other rows are never looked at. coverage: the share of rows of train
    and valid in which the feature has a value.
    """
    runs = runs or [Run("probe")]
    edges = train_edges(df.where("split = 'train'"), features)
    table = fit_table(df, key, edges, [F.col(label)], [roles(F.col("split"))], weight)
    models = fit(table, runs, len(features), rounds, patience, metric)
    seen = df.where("split in ('train', 'valid')").agg(*(F.avg(F.col(f).isNotNull().cast("double")).alias(f) for f in features)).first()
    coverage = df.sparkSession.createDataFrame([(f, seen[f] or 0.0) for f in features], "feature string, coverage double")
    return models, importances(models, features, df.sparkSession).join(F.broadcast(coverage), "feature")


def stability(df: DataFrame, key: str, features: list[str], label: str = "y", seeds: int = 5, **options) -> DataFrame:
    """(feature, stability): the mean rank share of the gain over models that differ by seed, rows and columns being drawn by it."""
    runs = [Run(f"seed{s}", seed=s, subsample=0.8, colsample=0.8) for s in range(seeds)]
    _, found = probing(df, key, features, label, runs, **options)
    return found.groupBy("feature").agg(F.avg("gain_rank_pct").alias("stability"))


def digest(key: Column, seed: Column | int) -> Column:
    """48 bits of the MD5 of key and seed, a number that doubles hold."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", key.cast("string"), F.lit(seed).cast("string") if isinstance(seed, int) else seed.cast("string"))), 1, _BITS // 4), 16, 10).cast("long")


def permuted_labels(df: DataFrame, key: str, label: str, seeds: list[int]) -> list[Column]:
    """A column for each seed: the label dealt anew to all rows, as many ones as before.

    Ones go to the rows with the least digests of key and seed, equal digests by key. The last of them is found by
    counts of the digests' leading bits, which Spark adds up, and the order within the one range where the count is
    reached: a few rows a seed.
    """
    ones = df.agg(F.sum((F.col(label) == 1).cast("long"))).first()[0] or 0
    lead = 16
    cells = df.select(F.col(key).alias("_key"), F.explode(F.array(*(F.struct(F.lit(s).alias("s"), digest(F.col(key), s).alias("d")) for s in seeds))).alias("c")).select("_key", "c.s", "c.d")
    cells = stored(cells.withColumn("b", F.shiftright("d", _BITS - lead)), "label-digests")
    counts = cells.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("s").orderBy("b")  # 65536 rows a seed
    cut = counts.withColumn("upto", F.sum("n").over(upto)).where((F.col("upto") >= ones) & (F.col("upto") - F.col("n") < ones)).select("s", "b", (F.lit(ones) - F.col("upto") + F.col("n")).alias("rest"))
    inside = cells.join(F.broadcast(cut), ["s", "b"]).withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy("d", "_key")))
    last = {r["s"]: (r["d"], r["_key"]) for r in inside.where(F.col("r") == F.col("rest")).collect()}
    kind = df.schema[key].dataType
    return [
        (F.struct(digest(F.col(key), s).alias("d"), F.col(key).alias("k")) <= F.struct(F.lit(last[s][0]).cast("long").alias("d"), F.lit(last[s][1]).cast(kind).alias("k"))).cast("int") if s in last else F.lit(0)
        for s in seeds
    ]


def root_gains(df: DataFrame, key: str, edges: dict[str, list[float]], labels: list[Column], reg: float = 1.0, min_child: float = 1.0) -> DataFrame:
    """(run, feature, gain): the gain of each feature's best first split, for every label, from one table of counts.

    run is the label's place. At the first split all rows have the score 0.5, so sums of gradients are counts.
    """
    features = list(edges)
    table = fit_table(df, key, edges, labels, [F.lit(TRAIN)])
    cells = table.select("labels", F.posexplode("bins").alias("feature", "bin"))
    ones = [F.sum(F.get("labels", F.lit(k)).cast("long")).alias(f"p{k}") for k in range(len(labels))]
    counts = cells.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), *ones)  # features x bins
    flat = counts.select("feature", "bin", "n", F.posexplode(F.array(*(f"p{k}" for k in range(len(labels))))).alias("run", "pos"))
    whole = Window.partitionBy("run", "feature")
    scale = F.try_divide(F.sum(F.col("n") - F.col("pos")).over(whole).cast("double"), F.sum("pos").over(whole))
    weighed = flat.withColumn("scale", F.coalesce(scale, F.lit(1.0)))
    neg = F.col("n") - F.col("pos")
    sums = weighed.select("run", F.lit(0).alias("node"), "feature", "bin", ((neg - F.col("pos") * F.col("scale")) / 2).alias("g"), ((neg + F.col("pos") * F.col("scale")) / 4).alias("h"))
    runs = [Run(str(k), reg=reg, min_child=min_child) for k in range(len(labels))]
    best = best_splits(sums, runs, ("run", "feature"))
    name = F.get(F.array(*(F.lit(f) for f in features)), F.col("feature"))
    return best.select("run", name.alias("feature"), F.coalesce(F.greatest(F.col("s.gain"), F.lit(0.0)), F.lit(0.0)).alias("gain"), (-F.col("s.b")).alias("bin"), F.col("s.missing_left").alias("missing_left"))


def null_decision(gains: DataFrame, n_actual: int, percent: float = 95) -> DataFrame:
    """(feature, gain_actual, null_p50, null_p75, null_keep_ref, score, keep) of (run, feature, gain).

    Runs under ``n_actual`` have the true labels, the others permuted ones. A feature is kept if its mean gain is over
    the given percentile of its permuted ones; the score is log1p(mean gain) - log1p(their 75th). A row a run and feature.
    """
    null = lambda q: F.expr(f"percentile(case when run >= {n_actual} then gain end, {q})")
    sums = gains.groupBy("feature").agg(F.avg(F.when(F.col("run") < n_actual, F.col("gain"))).alias("gain_actual"), null(0.5).alias("null_p50"), null(0.75).alias("null_p75"), null(percent / 100).alias("null_keep_ref"))
    return sums.select("*", (F.log1p("gain_actual") - F.log1p("null_p75")).alias("score"), (F.col("gain_actual") > F.col("null_keep_ref")).alias("keep"))


def null_importance(df: DataFrame, key: str, features: list[str], label: str = "y", n_actual: int = 3, n_null: int = 30, seed: int = 42, rounds: int = 0, percent: float = 95, **options) -> DataFrame:
    """``null_decision`` of all features of ``df``, with true and permuted labels.

    ``rounds`` 0: by the gain of each feature's first split, which knows no seeds, so the true labels count once. Else by
    the mean gain of boosted trees; the true runs differ by seed, and all runs grow together.
    """
    edges = train_edges(df, features)
    permuted = permuted_labels(df, key, label, [seed + 1000 + i for i in range(n_null)])
    if not rounds:
        return null_decision(root_gains(df, key, edges, [F.col(label), *permuted]), 1, percent)
    table = fit_table(df, key, edges, [F.col(label), *permuted], [F.lit(TRAIN)])
    runs = [Run(str(i), label=0, seed=seed + i, subsample=0.8, **options) for i in range(n_actual)] + [Run(str(n_actual + i), label=1 + i, seed=seed + 1000 + i, subsample=0.8, **options) for i in range(n_null)]
    found = importances(fit(table, runs, len(features), rounds), features, df.sparkSession)
    return null_decision(found.select(F.col("run").cast("int").alias("run"), "feature", "gain"), n_actual, percent)


def permutation_losses(values: DataFrame, key: str, features: list[str], score: Column, seeds: list[int], label: str = "y") -> DataFrame:
    """(feature, seed, loss): how much the area under precision and recall falls if a column is dealt anew to the rows.

    ``values`` (key, label, features...), ``score`` an expression of the features. Rows are numbered in the order of
    their keys, and for each feature and seed, a case, in that of a digest; a row gets the value of the row whose second number
    is its first. All cases are numbered in one order, case by case, dealt and scored together; digests are spread
    evenly, so ranges of them need no look at the rows.
    """
    base = stored(numbered(values.select(key, label, *features), [key], "_row"), "permutation-rows")
    whole = curve_metrics(base.select(F.col(label).alias("y"), F.round(score, 9).alias("score"))).first()["pr_auc"]
    cases = [(f, s) for f in features for s in seeds]
    place = lambda i, f, s: F.lit(i << _BITS).cast("long") + digest(F.concat_ws("#", F.col(key).cast("string"), F.lit(f)), s)
    cells = F.explode(F.array(*(F.struct(F.lit(i).alias("case"), F.col(f).cast("double").alias("given"), place(i, f, s).alias("place")) for i, (f, s) in enumerate(cases))))
    donors = base.select(key, cells.alias("c")).select(key, "c.*")
    donors = numbered(donors, ["place", key], "_number", F.col("place") / float(len(cases) << _BITS))
    donors = donors.select("case", "given", (F.col("_number") - F.col("case") * F.lit(base.count())).alias("_row"))  # a case has as many rows as the table
    of = {f: F.col("case").isin([i for i, c in enumerate(cases) if c[0] == f]) for f in features}
    dealt = base.join(donors, "_row").withColumns({f: F.when(of[f], F.col("given")).otherwise(F.col(f).cast("double")) for f in features})
    found = curve_metrics(dealt.select("case", F.col(label).alias("y"), F.round(score, 9).alias("score")), ["case"])
    names = values.sparkSession.createDataFrame([(i, f, s) for i, (f, s) in enumerate(cases)], "case int, feature string, seed int")
    return found.join(F.broadcast(names), "case").select("feature", "seed", (F.lit(whole) - F.col("pr_auc")).alias("loss"))


def permutation_ranks(losses: DataFrame) -> DataFrame:
    """(feature, loss, permutation_stability): the mean loss, and the mean over seeds of the rank share."""
    shares = rank_shares(losses.withColumn("_loss", F.round("loss", 9)), ["_loss"], ["seed"])
    return shares.groupBy("feature").agg(F.avg("loss").alias("loss"), F.avg("_loss_rank_pct").alias("permutation_stability"))


def objective_digest(metric: str, features: list[str], folds: int, grid: list[dict]) -> str:
    """What a search stands for: results of another objective, feature list, fold number or grid are not taken up again."""
    return hashlib.sha256(json.dumps([metric, features, folds, grid], sort_keys=True).encode()).hexdigest()


def cross_validate(df: DataFrame, key: str, features: list[str], grid: list[dict], label: str = "y", block: str = "block", rounds: int = 10, metric: str = "aucpr", done: DataFrame | None = None) -> DataFrame:
    """(setting, fold, metric, objective) of every setting of ``grid`` on forward folds, which all grow together.

    Fold i trains on blocks 0 .. i and is judged on block i + 1, so no row is judged by a model that saw its time.
    Bins are fitted on block 0, which every fold trains on. ``done``: rows of an earlier call; settings whose folds are
    all there, under the same objective, are not fitted again. Settings are places in the grid.
    """
    folds = df.agg(F.max(block)).first()[0]
    wanted = objective_digest(metric, features, folds, grid)
    kept = None if done is None else done.where(F.col("objective") == wanted)
    there = set() if kept is None else {r["setting"] for r in kept.groupBy("setting").agg(F.count_distinct("fold").alias("n")).where(F.col("n") == folds).collect()}
    todo = [k for k in range(len(grid)) if k not in there]
    spark = df.sparkSession
    found = []
    if todo:
        edges = train_edges(df.where(F.col(block) == 0), features)
        role = [F.when(F.col(block) <= i, TRAIN).when(F.col(block) == i + 1, VALID).otherwise(0) for i in range(folds)]
        table = fit_table(df, key, edges, [F.col(label)], role)
        runs = [Run(f"{k}/{i}", role=i, **grid[k]) for k in todo for i in range(folds)]
        scores = evaluate(table, fit(table, runs, len(features), rounds), metric)
        found = [(k, i, float(scores[j]), wanted) for j, (k, i) in enumerate((k, i) for k in todo for i in range(folds)) if j in scores]
    fresh = spark.createDataFrame(found, "setting int, fold int, metric double, objective string")
    return fresh if not there else kept.where(F.col("setting").isin(list(there))).select(fresh.columns).unionByName(fresh)


def chosen_setting(results: DataFrame, greater: bool = True) -> int:
    """The setting with the best mean metric, the first of equals."""
    means = results.groupBy("setting").agg(F.avg("metric").alias("m"))
    order = F.col("m").desc() if greater else F.col("m").asc()
    return means.orderBy(order, "setting").first()["setting"]
