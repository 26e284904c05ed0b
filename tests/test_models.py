"""Boosted trees and the screens that use them, against plain loops over the rows."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from liftwork.models import boosting, screening
from liftwork.models.boosting import TRAIN, VALID, Run
from liftwork.operators import splitting

FEATURES = ["a", "b", "c"]
EDGES = {"a": [0.0, 1.0, 2.0, 3.0, 4.0], "b": [0.0, 1.0, 2.0, 3.0], "c": [0.0, 0.5, 1.0]}


def made(n=600, seed=5):
    r = random.Random(seed)
    out = []
    for k in range(n):
        a, b, c = r.choice([None, 0.5, 1.5, 2.5, 3.5]), r.choice([0.5, 1.5, 2.5]), r.choice([0.2, 0.8])
        p = 0.1 + 0.5 * (a is not None and a > 2) + 0.2 * (b > 2) * (a is None)
        out.append((k, a, b, c, int(r.random() < p), r.choice([TRAIN, TRAIN, VALID, 0]), r.choice([1.0, 2.0])))
    return out


def binned(row):
    cut = lambda v, e: -1 if v is None else sum(x <= v for x in e[1:-1])
    return [cut(row[1], EDGES["a"]), cut(row[2], EDGES["b"]), cut(row[3], EDGES["c"])]


def grown(rows, rounds, depth, eta, reg=1.0, least=1.0):
    """Margins of all rows and the (feature, bin, missing left, gain) of every split, by trying all splits of all nodes."""
    train = [k for k, r in enumerate(rows) if r[5] == TRAIN]
    w = lambda y: sum(rows[k][6] for k in train if rows[k][4] == y)
    scale, margin, splits = w(0) / w(1), [0.0] * len(rows), []
    bins = [binned(r) for r in rows]
    for _ in range(rounds):
        grad = {}
        for k in train:
            p = 1 / (1 + math.exp(-margin[k]))
            weight = rows[k][6] * (scale if rows[k][4] else 1.0)
            grad[k] = (weight * (p - rows[k][4]), weight * p * (1 - p))
        total = lambda ks: tuple(sum(grad[k][i] for k in ks if k in grad) for i in (0, 1))  # noqa: E731, B023
        part = lambda g, h: g * g / (h + reg)
        nodes = [list(range(len(rows)))]
        for level in range(depth + 1):
            after = []
            for ks in nodes:
                g, h = total(ks)
                best = None
                if level < depth:
                    for f in range(3):
                        for b in range(max(x[f] for x in bins) + 1):
                            for ml in (True, False):
                                left = [k for k in ks if (ml if bins[k][f] < 0 else bins[k][f] <= b)]
                                lg, lh = total(left)
                                if lh >= least and h - lh >= least:
                                    gain = round((part(lg, lh) + part(g - lg, h - lh) - part(g, h)) / 2, 9)
                                    if best is None or (gain, -f, -b, ml) > best[0]:
                                        best = ((gain, -f, -b, ml), left)
                if best and best[0][0] > 1e-9:
                    splits.append((-best[0][1], -best[0][2], best[0][3], best[0][0]))
                    inside = set(best[1])
                    after += [best[1], [k for k in ks if k not in inside]]
                else:
                    for k in ks:
                        margin[k] -= eta * g / (h + reg)
            nodes = after
    return margin, splits


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def table(spark, rows):
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y int, role int, w double").repartition(3)
    return boosting.fit_table(df, "k", EDGES, [F.col("y")], [F.col("role")], F.col("w"))


def test_trees_equal_those_of_all_splits(table, rows):
    margin, splits = grown(rows, 2, 2, 0.3)
    (model,) = boosting.fit(table, [Run("r", eta=0.3, depth=2)], 3, rounds=2)
    found = [(t.feature[i], t.bin[i], bool(t.missing_left[i])) for t in model.trees for i in range(len(t.feature)) if t.feature[i] >= 0]
    assert found == [s[:3] for s in splits]
    gains = [t.gain[i] for t in model.trees for i in range(len(t.feature)) if t.feature[i] >= 0]
    assert gains == pytest.approx([s[3] for s in splits], abs=1e-6)
    scores = {r["key"]: r["score"] for r in boosting.scored(table, [model]).collect()}
    assert [scores[k] for k in range(len(rows))] == pytest.approx([1 / (1 + math.exp(-m)) for m in margin], abs=1e-9)


def test_runs_do_not_touch_each_other(table, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)  # margins are written on the way
    specs = [Run("x", eta=0.3, depth=2), Run("y", eta=0.1, depth=1, seed=3, subsample=0.6), Run("z", depth=2, colsample=0.4)]
    together = boosting.fit(table, specs, 3, rounds=3)
    for spec, model in zip(specs, together, strict=True):
        (alone,) = boosting.fit(table, [spec], 3, rounds=3)
        for a, b in zip(model.trees, alone.trees, strict=True):
            assert a.feature.tolist() == b.feature.tolist() and a.value == pytest.approx(b.value, abs=1e-9)


def test_training_ends_by_valid(table):
    (model,) = boosting.fit(table, [Run("r", eta=1.5, depth=3, min_child=0.0)], 3, rounds=30, patience=2)
    assert len(model.trees) < 28 and len(model.trees) == model.scores.index(min(model.scores)) + 1
    (other,) = boosting.fit(table, [Run("r", eta=0.5)], 3, rounds=4, patience=1, metric="aucpr")
    assert len(other.trees) == other.scores.index(max(other.scores)) + 1


def test_without_a_number_of_rounds_valid_alone_ends_a_run(table, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)  # early stop starts from written margins
    specs = [Run("x", eta=1.5, depth=3, min_child=0.0), Run("y", eta=0.3, depth=2)]
    together = boosting.fit(table, specs, 3, rounds=None, patience=2)
    assert len({len(m.scores) for m in together}) == 2  # one run ends before the other
    for spec, model in zip(specs, together, strict=True):
        assert len(model.scores) == len(model.trees) + 2 and len(model.trees) == model.scores.index(min(model.scores)) + 1
        parts = [boosting.Model(spec, model.trees[: k + 1]) for k in range(len(model.trees))]
        found = boosting.evaluate(table, parts, "logloss")  # by all trees, without margins
        assert [found[k] for k in range(len(parts))] == pytest.approx(model.scores[: len(parts)], abs=1e-12)
    with pytest.raises(ValueError, match="patience"):
        boosting.fit(table, specs, 3, rounds=None)


def test_quadrants_ask_for_a_model_that_valid_ends(spark, monkeypatch):
    """No number of rounds ends it, and the gains are those of its trees."""
    from liftwork.plans import models as plans

    asked = []

    def fit(table, runs, n_features, rounds=50, patience=0, metric="logloss"):
        asked.append((rounds, patience))
        tree = boosting.Tree.empty(1)
        tree.feature[0], tree.gain[0], tree.cover[0] = 2, 7.0, 3.0
        return [boosting.Model(runs[0], [tree] * 40)]

    monkeypatch.setattr(screening, "fit", fit)
    gains = {r["feature"]: r["gain"] for r in plans.quadrants_probed(spark, "/root/testdata/sf0.001").collect()}
    assert asked == [(None, 30)]
    assert gains == {f: 7.0 if f == plans.FEATURES[2] else 0.0 for f in plans.FEATURES}


def test_a_run_without_rows(spark, table):
    none = table.withColumn("roles", F.array(F.lit(0).cast("tinyint")))
    (model,) = boosting.fit(none, [Run("r")], 3, rounds=2)
    assert {r["score"] for r in boosting.scored(none, [model]).collect()} == {0.5}
    assert [x[1:] for x in model.importance(FEATURES)] == [(0.0, 0, 0.0)] * 3
    assert boosting.scored(table.limit(0), [model]).count() == 0


def signal(spark, n=3000):
    r = random.Random(9)
    rows = [(k, 20240101 + k // 300, y := int(r.random() < 0.3), y + r.random() * 2, r.random(), r.choice([None, 1.0, 2.0])) for k in range(n)]
    return spark.createDataFrame(rows, "k long, day int, y int, good double, noise double, few double")


def test_permuted_labels_keep_their_number(spark):
    df = signal(spark)
    ones = df.where("y = 1").count()
    found = df.select("k", "y", *(c.alias(f"p{i}") for i, c in enumerate(screening.permuted_labels(df, "k", "y", [1, 2])))).collect()
    digests = {(r["k"], r["s"]): r["d"] for s in (1, 2) for r in df.select("k", F.lit(s).alias("s"), screening.digest(F.col("k"), s).alias("d")).collect()}
    for i, s in enumerate((1, 2)):
        want = {k for _, k in sorted((digests[r["k"], s], r["k"]) for r in found)[:ones]}
        assert {r["k"] for r in found if r[f"p{i}"]} == want
    none = df.withColumn("y", F.lit(0))
    assert none.select(screening.permuted_labels(none, "k", "y", [1])[0].alias("p")).where("p = 1").count() == 0


def test_null_importance_keeps_the_signal(spark):
    df = signal(spark)
    for rounds in (0, 2):
        kept = {r["feature"]: r["keep"] for r in screening.null_importance(df, "k", ["good", "noise", "few"], n_actual=2, n_null=12, rounds=rounds).collect()}
        assert kept["good"] and not (kept["noise"] and kept["few"])


@pytest.mark.parametrize("metric", ["logloss", "aucpr"])
def test_equal_rows_are_one_row_of_the_fit(spark, metric):
    """What a level reads is bound by bins, labels and roles; trees and metrics are those of all rows."""
    rows = [(k, float(k % 5), float(k % 7), int(k % 5 + k % 7 > 5 and k % 11 > 2), 1 + k // 35 % 2, 1.0 + k % 2) for k in range(1540)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int, role int, w double")
    table = boosting.fit_table(df, "k", {"a": [0.0, 2.0, 3.0, 4.0], "b": [0.0, 3.0, 6.0]}, [F.col("y")], [F.col("role")], F.col("w"))
    few = boosting.merged_rows(table)
    assert few.count() <= 3 * 2 * 2 * 2 and few.agg(F.sum("n"), F.sum("weight")).first() == table.agg(F.sum("n"), F.sum("weight")).first()
    # a run that draws (nearly) all rows is grown on the rows themselves
    (merged,), (plain,) = (boosting.fit(table, [Run("r", eta=0.3, depth=2, subsample=s)], 2, rounds=4, patience=2, metric=metric) for s in (1.0, 1 - 1e-12))
    assert merged.scores == pytest.approx(plain.scores, abs=1e-9)
    for x, y in zip(merged.trees, plain.trees, strict=True):
        assert x.feature.tolist() == y.feature.tolist() and x.bin.tolist() == y.bin.tolist() and x.value.tolist() == pytest.approx(y.value.tolist(), abs=1e-9)


def test_permutation_losses_name_the_signal(spark):
    df = signal(spark)
    losses = screening.permutation_losses(df, "k", ["good", "noise"], F.col("good") + 0.01 * F.col("noise"), [1, 2])
    rank = {r["feature"]: r for r in screening.permutation_ranks(losses).collect()}
    assert rank["good"]["loss"] > 0.2 > abs(rank["noise"]["loss"]) and rank["good"]["permutation_stability"] == 1.0


def test_cross_validation_is_taken_up_again(spark):
    folds = splitting.forward_folds(signal(spark), 2)
    grid = [{"eta": 0.3, "depth": 1}, {"eta": 0.1, "depth": 1}]
    first = screening.cross_validate(folds, "k", ["good", "noise"], grid[:1] + grid[1:], rounds=2)
    assert {(r["setting"], r["fold"]) for r in first.collect()} == {(s, f) for s in (0, 1) for f in (0, 1)}
    assert all(r["metric"] > 0.4 for r in first.collect())
    again = screening.cross_validate(folds, "k", ["good", "noise"], grid, rounds=2, done=first.withColumn("metric", F.lit(7.0)).where("setting = 0"))
    assert {r["metric"] for r in again.where("setting = 0").collect()} == {7.0}
    other = screening.cross_validate(folds, "k", ["good", "noise"], grid, rounds=2, metric="logloss", done=first)
    assert all(r["metric"] < 1 and r["metric"] != 7.0 for r in other.collect())
    assert screening.chosen_setting(first) in (0, 1)


def test_fold_metrics_are_those_of_the_scores(spark):
    """Each fold's metric equals the one computed from its own scores, by a model that saw earlier blocks alone."""
    folds = splitting.forward_folds(signal(spark), 2)
    found = {r["fold"]: r["metric"] for r in screening.cross_validate(folds, "k", ["good", "noise"], [{"depth": 1}], rounds=2).collect()}
    edges = screening.train_edges(folds.where("block = 0"), ["good", "noise"])
    for i in (0, 1):
        part = folds.where(F.col("block") <= i + 1)
        table = boosting.fit_table(part, "k", edges, [F.col("y")], [F.when(F.col("block") <= i, TRAIN).otherwise(VALID)])
        models = boosting.fit(table, [Run("r", depth=1)], 2, rounds=2)
        rows = sorted(((-round(r["score"], 12), r["label"]) for r in boosting.scored(table, models).where(F.col("role") == VALID).collect()))
        ones, area, seen, hits = sum(y for _, y in rows), 0.0, 0, 0
        for s in sorted({s for s, _ in rows}):
            same = [y for t, y in rows if t == s]
            seen, hits = seen + len(same), hits + sum(same)
            area += sum(same) * hits / seen
        assert found[i] == pytest.approx(area / ones, abs=1e-9)
