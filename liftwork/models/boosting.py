"""Boosted trees on feature histograms: many runs grown together, a level of all their trees by one aggregate.

A table to fit holds a row's bins (one number a feature, -1 if missing), its labels and its roles (TRAIN,
VALID or neither), a label and a role for each run that has its own, a weight, and a hash of its key. A run
is a model to be grown: which label and role it takes, its learning rate, depth, seed. Permuted labels,
folds and seeds are runs, so thirty of them read the table as often as one.

Each level is one pass: tasks sum gradients and Hessians by run, node, feature and bin; Spark adds the sums up
and finds each node's best split by windows over bins. The driver sees a row for each node. Margins are written
every ``KEEP`` rounds, so that later passes, those of early stop too, neither apply nor receive all trees anew. Rows with equal bins, labels and roles are one, with
their weights added up, if no run draws rows: then a level's work is bound by the bins, not by the rows.

Loss is the logistic one; positives weigh ``scale_pos`` times as much, by default the weight of negatives over
that of positives among the run's training rows. A missing value goes the way that gains more. Of equal gains (to nine
digits) the first feature, then the lowest bin is taken. A run without training rows has no trees and scores
0.5. Labels and weights have no NULLs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftwork.operators.binning import digit
from liftwork.operators.ranking import curve_metrics
from liftwork.sources.intermediate import stored

OUT, TRAIN, VALID = 0, 1, 2
KEEP = 8


@dataclass(frozen=True)
class Run:
    """A model to grow. label, role: places in the table's lists."""

    name: str
    label: int = 0
    role: int = 0
    seed: int = 42
    eta: float = 0.1
    depth: int = 3
    reg: float = 1.0
    min_child: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    scale_pos: float | None = None


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2 i + 1 and 2 i + 2. feature -1: a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range((len(self.feature) + 1).bit_length() - 2):
            feature = self.feature[at]
            b = bins[rows, feature]
            left = np.where(b < 0, self.missing_left[at], b <= self.bin[at])
            at = np.where(feature < 0, at, 2 * at + 2 - left)
        return at


@dataclass
class Model:
    run: Run
    trees: list[Tree] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)

    def margins(self, bins: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros(len(bins))
        for tree in self.trees[first:]:
            out += tree.value[tree.nodes(bins)]
        return out

    def importance(self, features: list[str]) -> list[tuple[str, float, int, float]]:
        """(feature, mean gain, splits, mean cover) of every feature; 0 where it is not used."""
        out = []
        for k, name in enumerate(features):
            used = [(t.gain[i], t.cover[i]) for t in self.trees for i in np.flatnonzero(t.feature == k)]
            gain, cover = (float(np.mean([u[i] for u in used])) if used else 0.0 for i in (0, 1))
            out.append((name, gain, len(used), cover))
        return out


def chance(keys: np.ndarray, *seeds: int) -> np.ndarray:
    """Numbers in [0, 1) that hang on the keys and the seeds."""
    x = keys.astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in (*seeds, 0):
            x = x ^ np.uint64(s * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
            x = x ^ x >> np.uint64(33)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


def fit_table(df: DataFrame, key: str, edges: dict[str, list[float]], labels: list, roles: list, weight=None) -> DataFrame:
    """The table to fit, written once: (key, bins, labels, roles, weight, hash, n). ``edges``: feature -> edges of its bins; n: 1, the rows that a row stands for."""
    as_array = lambda c, kind: F.array(*(x.cast(kind) for x in c)).cast(f"array<{kind}>")
    bins = as_array([digit(F.col(f).cast("double"), F.array(*(F.lit(float(e)) for e in cuts)).cast("array<double>")) for f, cuts in edges.items()], "int")
    weight = F.lit(1.0) if weight is None else weight
    return stored(df.select(F.col(key).alias("key"), bins.alias("bins"), as_array(labels, "tinyint").alias("labels"), as_array(roles, "tinyint").alias("roles"), weight.cast("double").alias("weight"), F.xxhash64(key).alias("hash"), F.lit(1).cast("long").alias("n")), "fit-table")


def merged_rows(table: DataFrame) -> DataFrame:
    """A fit table with one row for all rows of equal bins, labels and roles: their weights and numbers added up, one of their keys."""
    kept = F.min("key").alias("key"), F.sum("weight").alias("weight"), F.min("hash").alias("hash"), F.sum("n").alias("n")
    return stored(table.groupBy("bins", "labels", "roles").agg(*kept).select(*table.columns), "fit-merged")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _since(models: list[Model], done: int) -> list[Model]:
    """``models`` with the trees after the first ``done`` alone: what a task needs beside the margins."""
    return [Model(m.run, m.trees[done:]) for m in models]


_SUMS = pa.schema([("run", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("g", pa.float64()), ("h", pa.float64())])


def _level_sums(table: DataFrame, models: list[Model], done: int, level: int, live: list[int], n_features: int, scale: list[float]) -> DataFrame:
    """(run, node, feature, bin, g, h): sums of the training rows in the nodes of a level of the live runs' newest trees.

    ``done``: how many trees are in the margins of the table. A task holds the sums of its rows only: runs x nodes x
    features x bins at most.
    """
    models = _since(models, done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        first = (1 << level) - 1
        for batch in batches:
            bins, labels, roles = (_matrix(batch.column(c)) for c in ("bins", "labels", "roles"))
            weight, hashed, kept = (batch.column(c) for c in ("weight", "hash", "margins"))
            weight, hashed, kept = weight.to_numpy(), hashed.to_numpy().view(np.uint64), _matrix(kept)
            if not len(bins):
                continue
            width = int(bins.max()) + 2
            for r in live:
                model, spec = models[r], models[r].run
                newest = model.trees[-1]
                y = labels[:, spec.label].astype(np.float64)
                role = roles[:, spec.role]
                margin = (kept[:, r] if kept.size else 0) + Model(spec, model.trees[:-1]).margins(bins)
                node = newest.nodes(bins) - first
                taken = (role == TRAIN) & (node >= 0) & (node < 1 << level)
                if spec.subsample < 1:
                    taken &= chance(hashed, spec.seed, done + len(model.trees)) < spec.subsample
                at = np.flatnonzero(taken)
                if not len(at):
                    continue
                p = _sigmoid(margin[at])
                w = weight[at] * np.where(y[at] > 0, scale[r], 1.0)
                g, h = w * (p - y[at]), w * p * (1 - p)
                for f in range(n_features):
                    place = node[at] * width + bins[at, f] + 1
                    new = np.stack([np.bincount(place, v, width << level) for v in (g, h, np.ones(len(at)))]).reshape(3, 1 << level, width)
                    old = sums.get((r, f))
                    if old is not None and old.shape[2] != new.shape[2]:
                        w_ = max(old.shape[2], new.shape[2])
                        old, new = (np.pad(x, ((0, 0), (0, 0), (0, w_ - x.shape[2]))) for x in (old, new))
                    sums[r, f] = new if old is None else old + new
        for (r, f), s in sums.items():
            node, b = np.nonzero(s[2])
            same = lambda v, n=len(node): np.full(n, v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((same(r), node + first, same(f), b - 1, s[0, node, b], s[1, node, b]), _SUMS.types, strict=True)], schema=_SUMS)

    found = table.mapInArrow(run, "run int, node int, feature int, bin int, g double, h double")
    return found.groupBy("run", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def split_gains(sums: DataFrame, runs: list[Run]) -> DataFrame:
    """(run, node, feature, bin, missing_left, gain, left_g, left_h, all_g, all_h) of every split of (run, node, feature, bin, g, h).

    gain is NULL where a side would weigh less than the run's min_child. A split sends bins up to ``bin`` to the left.
    """
    per_run = lambda name: F.get(F.array(*(F.lit(float(getattr(r, name))) for r in runs)), F.col("run"))
    whole = Window.partitionBy("run", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    known = lambda c: F.when(F.col("bin") >= 0, F.col(c)).otherwise(0.0)
    placed = sums.select(
        "run", "node", "feature", "bin", F.sum("g").over(whole).alias("all_g"), F.sum("h").over(whole).alias("all_h"), F.sum(known("g")).over(upto).alias("cg"), F.sum(known("h")).over(upto).alias("ch"),
        *(F.sum(F.when(F.col("bin") < 0, F.col(c)).otherwise(0.0)).over(whole).alias(f"m{c}") for c in "gh"),
    )
    ways = placed.withColumn("missing_left", F.explode(F.array(F.lit(True), F.lit(False))))
    ways = ways.withColumns({f"left_{c}": F.col(f"c{c}") + F.when(F.col("missing_left"), F.col(f"m{c}")).otherwise(0.0) for c in "gh"})
    right_g, right_h = F.col("all_g") - F.col("left_g"), F.col("all_h") - F.col("left_h")
    reg, least = per_run("reg"), F.greatest(per_run("min_child"), F.lit(1e-9))
    part = lambda g, h: g * g / (h + reg)
    gain = F.round((part(F.col("left_g"), F.col("left_h")) + part(right_g, right_h) - part(F.col("all_g"), F.col("all_h"))) / 2, 9)
    fit = (F.col("bin") >= 0) & (F.col("left_h") >= least) & (right_h >= least)
    return ways.select("run", "node", "feature", "bin", "missing_left", F.when(fit, gain).alias("gain"), "left_g", "left_h", "all_g", "all_h")


def best_splits(sums: DataFrame, runs: list[Run], by: tuple[str, ...] = ("run", "node")) -> DataFrame:
    """(by..., s) with the struct s of the best split, its gain NULL if there is none."""
    order = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "missing_left", "left_g", "left_h", "all_g", "all_h")
    return split_gains(sums, runs).groupBy(*by).agg(F.max(order).alias("s"))


def _scales(table: DataFrame, runs: list[Run]) -> list[float]:
    """Negatives over positives, by weight, of each run's training rows."""
    train = lambda r, y: F.sum(F.when((F.get("roles", F.lit(r.role)) == TRAIN) & (F.get("labels", F.lit(r.label)) == y), F.col("weight")))
    found = table.agg(*(F.try_divide(train(r, 0), train(r, 1)).alias(f"r{k}") for k, r in enumerate(runs))).first()
    return [r.scale_pos if r.scale_pos is not None else found[f"r{k}"] or 1.0 for k, r in enumerate(runs)]


def _columns_of(run: Run, n_features: int, round_: int) -> set[int]:
    """The features a tree may split by: colsample of them, by the seed, one at least."""
    order = np.argsort(chance(np.arange(n_features), run.seed, round_, 7), kind="stable")
    return set(order[: max(1, round(run.colsample * n_features))].tolist())


def with_margins(table: DataFrame, models: list[Model], done: int) -> DataFrame:
    """``table`` with the margins of all trees, written; those of the first ``done`` are there already."""
    models = _since(models, done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, kept = _matrix(batch.column("bins")), _matrix(batch.column("margins"))
            new = np.stack([m.margins(bins) for m in models], axis=1) + (kept if kept.size else 0)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(bins) + 1) * len(models), pa.int32()), pa.array(new.ravel()))
            yield pa.RecordBatch.from_arrays([flat if n == "margins" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)

    return stored(table.mapInArrow(run, table.schema), "fit-margins")


def scored(table: DataFrame, models: list[Model], done: int = 0, places: list[int] | None = None) -> DataFrame:
    """(run, key, label, role, weight, score, n) of every run and row of a fit table.

    ``done``: how many trees are in the margins of the table, ``places``: where those of each model stand there.
    """
    runs = [m.run for m in models]
    models = _since(models, done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, labels, roles = (_matrix(batch.column(c)) for c in ("bins", "labels", "roles"))
            kept = _matrix(batch.column("margins")) if done else None
            for k, (m, r) in enumerate(zip(models, runs, strict=True)):
                n = len(bins)
                margin = m.margins(bins) + (kept[:, places[k]] if done and n else 0)
                arrays = [pa.array(np.full(n, k), pa.int32()), batch.column("key"), pa.array(labels[:, r.label] if n else [], pa.int32()), pa.array(roles[:, r.role] if n else [], pa.int32()), batch.column("weight"), pa.array(_sigmoid(margin)), batch.column("n")]
                yield pa.RecordBatch.from_arrays(arrays, names=["run", "key", "label", "role", "weight", "score", "n"])

    kind = table.schema["key"].dataType.simpleString()
    return table.mapInArrow(run, f"run int, key {kind}, label int, role int, weight double, score double, n long")


def _log_losses(rows: DataFrame) -> DataFrame:
    y, p = F.col("label"), F.greatest(F.least("score", F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -F.when(y == 1, F.log(p)).otherwise(F.log(1 - p))
    return rows.groupBy("run").agg((F.sum(F.col("weight") * loss) / F.sum("weight")).alias("metric"))


def _pr_aucs(rows: DataFrame) -> DataFrame:
    return curve_metrics(rows.select("run", F.col("label").alias("y"), F.round("score", 12).alias("score"), "n"), ["run"], n="n").withColumnRenamed("pr_auc", "metric")


#: name -> (aggregate of scored rows, whether less is better)
METRICS = {"logloss": (_log_losses, True), "aucpr": (_pr_aucs, False)}


def evaluate(table: DataFrame, models: list[Model], metric: str, done: int = 0, places: list[int] | None = None) -> dict[int, float]:
    """The metric of each run's validation rows; a run without such rows has none. ``done``, ``places``: as for ``scored``."""
    rows = scored(table, models, done, places).where(F.col("role") == VALID)
    return {r["run"]: r["metric"] for r in METRICS[metric][0](rows).collect()}


def fit(table: DataFrame, runs: list[Run], n_features: int, rounds: int | None = 50, patience: int = 0, metric: str = "logloss") -> list[Model]:
    """The model of each run, grown for ``rounds`` trees at most; None: until its validation rows end it, however many that are.

    With ``patience``, a run ends once its validation rows have not been better for so many rounds, and keeps its trees
    up to the best round; ``metric`` is logloss or aucpr, of the validation rows alone. Rows that are neither
    are never looked at.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    if rounds is None and not patience:
        raise ValueError("without a number of rounds a run needs patience to end")
    better = min if METRICS[metric][1] else max
    if all(r.subsample >= 1 for r in runs):
        table = merged_rows(table)
    table = table.withColumn("margins", F.expr("cast(array() as array<double>)"))
    models, scale, done = [Model(r) for r in runs], _scales(table, runs), 0
    live = list(range(len(runs)))
    for round_ in count() if rounds is None else range(rounds):
        if round_ and round_ % KEEP == 0:
            table, done = with_margins(table, models, done), round_
        for r in live:
            models[r].trees.append(Tree.empty(runs[r].depth))
        for level in range(max(runs[r].depth for r in live)):
            growing = [r for r in live if runs[r].depth > level]
            sums = _level_sums(table, models, done, level, growing, n_features, scale)
            if any(runs[r].colsample < 1 for r in growing):
                allowed = [(r, f) for r in growing for f in _columns_of(runs[r], n_features, round_)]
                sums = sums.join(F.broadcast(table.sparkSession.createDataFrame(allowed, "run int, feature int")), ["run", "feature"])
            for row in best_splits(sums, runs).collect():  # a row a node
                _grow(models[row["run"]].trees[-1], runs[row["run"]], row["node"], row["s"])
        if patience:
            found = evaluate(table, [models[r] for r in live], metric, done, live)
            for k, r in enumerate(list(live)):
                scores = models[r].scores
                scores.append(found.get(k, float("nan")))
                if len(scores) - 1 - scores.index(better(scores)) >= patience:
                    live.remove(r)
            if not live:
                break
    if patience:
        for m in models:
            m.trees = m.trees[: m.scores.index(better(m.scores)) + 1]
    return models


def _grow(tree: Tree, run: Run, node: int, s) -> None:
    """Give ``node`` its value, and its split if the best one gains."""
    leaf = lambda g, h: -run.eta * g / (h + run.reg)
    tree.value[node] = leaf(s["all_g"], s["all_h"])
    if s["gain"] is not None and s["gain"] > 1e-9:
        tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node], tree.cover[node] = -s["f"], -s["b"], s["missing_left"], s["gain"], s["all_h"]
        tree.value[2 * node + 1], tree.value[2 * node + 2] = leaf(s["left_g"], s["left_h"]), leaf(s["all_g"] - s["left_g"], s["all_h"] - s["left_h"])


def importances(models: list[Model], features: list[str], spark) -> DataFrame:
    """(run, feature, gain, weight, cover) and the share of features that each is not under: gain_rank_pct, weight_rank_pct, cover_rank_pct, ties averaged."""
    rows = [(m.run.name, *r) for m in models for r in m.importance(features)]
    frame = spark.createDataFrame(rows, "run string, feature string, gain double, weight long, cover double")
    return rank_shares(frame, ["gain", "weight", "cover"], ["run"])


def rank_shares(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """``df`` with the rank of each column within its group as a share of the rows, equal values averaged: {column}_rank_pct. Groups are features."""
    whole = Window.partitionBy(*by)
    out = {}
    for c in columns:
        same = F.count(F.lit(1)).over(Window.partitionBy(*by, c))
        out[f"{c}_rank_pct"] = (F.rank().over(whole.orderBy(c)) + (same - 1) / 2) / F.count(F.lit(1)).over(whole)
    return df.withColumns(out)
