"""Bins of features: edges, small-bin merging, digitising and counting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwork.operators.histogram import ordered, quantile
from liftwork.sources.intermediate import stored

MISSING = -1


def equal_frequency_edges(hist: DataFrame, n_bins: int = 10, least: int | None = None, placed: DataFrame | None = None) -> DataFrame:
    """(feature, n, n_unique, edges) of a histogram (feature, value, n, pos), small bins merged.

    At most ``n_bins`` distinct values: the least value, the midpoints between neighbours and the
    greatest; else the distinct interpolated quantiles. One distinct value v gives [v, v + 1e-12], none
    gives an empty array. Only NULL counts as missing. Bins under ``least`` rows, max(50, n // 100) by
    default, are merged. ``placed``: ``ordered(hist)``, if it is there already.
    """
    placed = ordered(hist) if placed is None else placed
    names = [f"q{i}" for i in range(n_bins + 1)]
    sums = placed.groupBy("feature").agg(
        F.sum("n").alias("n"), F.count("value").alias("n_unique"), *(quantile(i / n_bins).alias(c) for i, c in enumerate(names)),
    )
    # of a feature with few values all are kept
    few = placed.join(F.broadcast(sums.where(F.col("n_unique") <= n_bins).select("feature")), "feature", "left_semi").groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("u"))
    joined = hist.select("feature").distinct().join(sums, "feature", "left").join(few, "feature", "left")
    u = F.col("u")
    middle = F.transform(F.sequence(F.lit(1), F.size(u) - 1), lambda i: (F.get(u, i - 1) + F.get(u, i)) / 2)
    edges = (
        F.when(F.col("n_unique").isNull(), F.expr("cast(array() as array<double>)"))
        .when(F.col("n_unique") == 1, F.array(F.get(u, F.lit(0)), F.get(u, F.lit(0)) + 1e-12))
        .when(u.isNotNull(), F.concat(F.slice(u, 1, 1), middle, F.slice(u, -1, 1)))
        .otherwise(F.array_distinct(F.array(*names)))
    )
    found = joined.select("feature", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_unique", F.lit(0)).alias("n_unique"), edges.alias("edges"))
    return stored(merged_edges(hist, stored(found, "edges"), least), "merged-edges")


def digit(value: Column, edges: Column) -> Column:
    """The bin of a value: how many inner edges it reaches; NULL goes to MISSING, outer values to the end bins."""
    inner = F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.when(value.isNull(), MISSING).otherwise(F.size(F.filter(inner, lambda e: e <= value)))


def digitized(values: DataFrame, edges: DataFrame) -> DataFrame:
    """``values`` with the bin of each row. ``edges`` has a row a feature, and goes to the values, which are not dealt by feature."""
    return values.join(F.broadcast(edges.select("feature", "edges")), "feature").withColumn("bin", digit(F.col("value"), F.col("edges"))).drop("edges")


def counted(hist: DataFrame, edges: DataFrame) -> DataFrame:
    """(feature, bin, n, pos) of a histogram; bins between edges that hold nothing count 0."""
    sums = digitized(hist, edges).groupBy("feature", "bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    bins = edges.where(F.size("edges") > 1).select("feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return bins.join(sums, ["feature", "bin"], "full").select("feature", "bin", zero("n"), zero("pos"))


def merge_small(counts: list[int], least: int) -> list[int]:
    """Numbers of the edges (0..k) that stay when bins under ``least`` are merged into a neighbour.

    Always the smallest bin goes, the first of equals: at an end into its only neighbour, else into the
    smaller one, the left of equals.
    """
    counts, edges = list(counts), list(range(len(counts) + 1))
    while len(counts) > 1 and min(counts) < least:
        i = counts.index(min(counts))
        left = i == len(counts) - 1 or (i > 0 and counts[i - 1] <= counts[i + 1])
        into = i - 1 if left else i + 1
        counts[into] += counts[i]
        del counts[i]
        del edges[i if left else i + 1]
    return edges


def merged_edges(hist: DataFrame, edges: DataFrame, least: int | None = None, share: float = 0.01, floor: int = 50) -> DataFrame:
    """(feature, n, n_unique, edges) after bins under ``least`` rows, by default max(floor, n * share), have been merged.

    A column ``least`` of ``edges`` goes before both. Only bin counts are looked at, a row a bin.
    """
    own = "least" in edges.columns
    both = edges.join(counted(hist, edges).where("bin >= 0").select("feature", "bin", F.col("n").alias("c")), "feature", "left")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        cuts = list(first["edges"])
        bins = [0] * max(len(cuts) - 1, 0)
        for b, c in zip(frame["bin"], frame["c"], strict=True):
            if pd.notna(b):
                bins[int(b)] = int(c)
        few = first["least"] if own else max(floor, int(share * first["n"])) if least is None else least
        stay = merge_small(bins, int(few)) if bins else []
        return pd.DataFrame({"feature": [first["feature"]], "n": [first["n"]], "n_unique": [first["n_unique"]], "edges": [[cuts[i] for i in stay]]})

    return both.groupBy("feature").applyInPandas(merge, "feature string, n long, n_unique long, edges array<double>")


def _impurity(n: Column, pos: Column) -> Column:
    return n - (pos * pos + (n - pos) * (n - pos)) / n


def _best_splits(placed: DataFrame, nodes: list[tuple]) -> dict[tuple[str, int], tuple | None]:
    """The best split (gain, value, cn, cp) of each node (feature, id, an, ap, bn, bp, least), None without one.

    A node holds the rows an .. bn of its feature in the order of values. Nodes are a few a feature.
    """
    frame = placed.sparkSession.createDataFrame(nodes, "feature string, id int, an long, ap long, bn long, bp long, least long")
    cn, cp = F.col("before") + F.col("n"), F.col("pos_before") + F.col("pos")
    inside = placed.select("feature", "value", cn.alias("cn"), cp.alias("cp")).join(F.broadcast(frame), "feature")
    inside = inside.where((F.col("cn") - F.col("an") >= F.col("least")) & (F.col("bn") - F.col("cn") >= F.col("least")))
    d = lambda a, b: (F.col(a) - F.col(b)).cast("double")
    gain = _impurity(d("bn", "an"), d("bp", "ap")) - _impurity(d("cn", "an"), d("cp", "ap")) - _impurity(d("bn", "cn"), d("bp", "cp"))
    best = inside.groupBy("feature", "id").agg(F.max(F.struct(gain.alias("gain"), (-F.col("value")).alias("least"), "cn", "cp")).alias("s")).where("s.gain > 1e-12")
    found = {(r["feature"], r["id"]): (r["s"]["gain"], r["s"]["cn"], r["s"]["cp"]) for r in best.collect()}
    return {(n[0], n[1]): found.get((n[0], n[1])) for n in nodes}


def tree_edges(hist: DataFrame, n_bins: int = 10, share: float = 0.05, floor: int = 50) -> DataFrame:
    """(feature, edges) by a best-first Gini tree of at most ``n_bins`` leaves on a histogram.

    Leaves hold at least max(share * n, floor) rows; thresholds lie midway between neighbouring values, of
    equal gains the smallest is taken. A feature with a single class gets equal-frequency edges.

    The best splits of all nodes of a level are found by one aggregate over the distinct values; the driver
    holds the nodes of the trees, a few a feature, and goes on until the best-first order is known.
    """
    spark = hist.sparkSession
    placed = stored(ordered(hist), "tree-values")
    sums = {r["feature"]: r for r in placed.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.min("value").alias("low"), F.max("value").alias("high")).collect()}
    trees = {f: r for f, r in sums.items() if 0 < r["pos"] < r["n"]}
    spans = {(f, 1): (0, 0, r["n"], r["pos"]) for f, r in trees.items()}  # a node i has the children 2 i and 2 i + 1
    splits: dict[str, dict[int, tuple | None]] = {f: {} for f in trees}
    cuts: dict[str, list[int]] = {}
    todo = list(spans)
    while todo:
        for (f, i), found in _best_splits(placed, [(f, i, *spans[f, i], max(int(share * trees[f]["n"]), floor)) for f, i in todo]).items():
            splits[f][i] = found
            if found:
                (an, ap, bn, bp), (_, cn, cp) = spans[f, i], found
                spans[f, 2 * i], spans[f, 2 * i + 1] = (an, ap, cn, cp), (cn, cp, bn, bp)
        todo = []
        for f, own in splits.items():
            cuts[f], open_ = [], [1]
            while len(cuts[f]) < n_bins - 1:
                if any(i not in own for i in open_):  # all nodes of the level that can be split are looked at together
                    todo += [(f, c) for i, s in own.items() if s for c in (2 * i, 2 * i + 1) if c not in own]
                    break
                able = [i for i in open_ if own[i]]
                if not able:
                    break
                best = max(able, key=lambda i: (own[i][0], -spans[f, i][0]))
                cuts[f].append(own[best][1])
                open_.remove(best)
                open_ += [2 * best, 2 * best + 1]
    chosen = spark.createDataFrame([(f, c) for f, all_ in cuts.items() for c in all_], "feature string, cut long")
    near = placed.join(F.broadcast(chosen), "feature").where((F.col("before") == F.col("cut")) | (F.col("before") + F.col("n") == F.col("cut")))  # n_bins - 1 rows a feature
    inner = near.groupBy("feature", "cut").agg(((F.min("value") + F.max("value")) / 2).alias("edge")).groupBy("feature").agg(F.sort_array(F.collect_list("edge")).alias("inner"))
    ends = spark.createDataFrame([(f, float(r["low"]), float(r["high"])) for f, r in trees.items()], "feature string, low double, high double")
    grown = ends.join(inner, "feature", "left").select("feature", F.concat(F.array("low"), F.coalesce("inner", F.expr("cast(array() as array<double>)")), F.array("high")).alias("edges"))
    plain = [f for f in sums if f not in trees]
    if plain:
        grown = grown.unionByName(equal_frequency_edges(hist.where(F.col("feature").isin(plain)), n_bins).select("feature", "edges"))
    return grown
