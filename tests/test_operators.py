"""Operators on hand-made cases, against brute force where SQL can't express them."""

from __future__ import annotations

import math
import random

import pytest

from liftwork.operators import binning, correlation, fusion, preparation, ranking, signals, splitting
from liftwork.operators.histogram import histogram, quantiles
from liftwork.sources import files


def test_small_bins_go_into_the_smaller_neighbour():
    assert binning.merge_small([100, 10, 60, 200], 50) == [0, 1, 3, 4]
    assert binning.merge_small([10, 100, 60], 50) == [0, 2, 3]
    assert binning.merge_small([100, 60, 10], 50) == [0, 1, 3]
    assert binning.merge_small([60, 10, 60], 50) == [0, 2, 3]  # the left one of equals
    assert binning.merge_small([1, 1, 1], 50) == [0, 3]
    assert binning.merge_small([70, 80], 50) == [0, 1, 2]


def long(spark, rows: dict[str, list[tuple]]):
    return spark.createDataFrame([(f, v, y) for f, some in rows.items() for v, y in some], "feature string, value double, y int")


def test_quantiles_are_those_of_all_rows(spark):
    r = random.Random(3)
    rows = {f: [(r.choice([round(r.random(), 2), float(k), None]), k % 2) for k in range(n)] for f, n in (("a", 500), ("b", 7), ("c", 1))}
    rows["d"] = [(None, 1)]
    got = {x["feature"]: x for x in quantiles(histogram(long(spark, rows)), {"q10": 0.1, "q50": 0.5, "q100": 1.0}).collect()}
    for f, some in rows.items():
        known = sorted(v for v, _ in some if v is not None)
        if not known:
            assert f not in got
            continue
        for name, q in (("q10", 0.1), ("q50", 0.5), ("q100", 1.0)):
            place = q * (len(known) - 1)
            low = known[math.floor(place)]
            assert math.isclose(got[f][name], low + (known[math.ceil(place)] - low) * (place - math.floor(place)), abs_tol=1e-12)


@pytest.mark.parametrize("joined", ["bins", "widths"])
def test_values_are_not_dealt_by_feature(spark, joined):
    """A feature's values are no single task, and the few edges go to the values, not the values to the driver."""
    values = long(spark, {f: [(float(k % 40), k % 2) for k in range(400)] for f in "ab"})
    edges = spark.createDataFrame([(f, [0.0, 10.0, 39.0]) for f in "ab"], "feature string, edges array<double>")
    # no side is small enough for a broadcast, so only a stated one is
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = binning.digitized(values, edges) if joined == "bins" else signals.histogram(values, 4)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert len(rows) == 800 if joined == "bins" else sum(r["n"] for r in rows) == 800


def test_histograms_of_a_drift_report_are_written_once(spark):
    from liftwork.plans import monitoring

    for frame in monitoring.histograms(spark, "/root/testdata/sf0.001"):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_rows_dealt_by_an_even_share_have_the_same_numbers(spark):
    from liftwork.sources.positions import numbered
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(k * 7919 % 1000, k % 3) for k in range(1000)] + [(5, 9), (999, 9)], "place int, x int").repartition(5)
    want = {(r["place"], r["x"]): r["row_id"] for r in numbered(rows, ["place", "x"]).collect()}
    got = {(r["place"], r["x"]): r["row_id"] for r in numbered(rows, ["place", "x"], share=F.col("place") / 1000.0).collect()}
    assert got == want and sorted(got.values()) == list(range(1002))


def test_a_day_is_a_number_without_a_text(spark):
    from liftwork.functions.cleaning import yyyymmdd

    days = spark.sql("select timestamp'1998-02-03 23:59:59' as d union all select timestamp'0007-12-31 00:00:00' union all select null").select(yyyymmdd("d").alias("day"))
    assert {r["day"] for r in days.collect()} == {19980203, 71231, None}
    assert "date_format" not in days._jdf.queryExecution().optimizedPlan().toString()


def test_quantile_between_equal_values_is_the_value(spark):
    """0.2 of the way from 42519.71 to 42519.71 would be rounded to more than that, and rows with the value go to the bin below."""
    values = {f"f{k}": v for k, v in enumerate((42519.71, 11331.59, 63287.07, 94602.47))}
    hist = histogram(long(spark, {f: [(v, 0)] * 25 for f, v in values.items()}))
    for i in range(1, 10):
        assert {r["feature"]: r["q"] for r in quantiles(hist, {"q": i / 10}).collect()} == values


def test_edges_of_few_values_and_sparse_features(spark):
    rows = {"one": [(2.0, 1)] * 60, "none": [(None, 0)] * 5, "two": [(1.0, 0)] * 80 + [(3.0, 1)] * 70, "thin": [(1.0, 0)] * 200 + [(2.0, 1)] * 3}
    got = {x["feature"]: list(x["edges"]) for x in binning.equal_frequency_edges(histogram(long(spark, rows))).collect()}
    assert got["one"] == [2.0, 2.0 + 1e-12] and got["none"] == []
    assert got["two"] == [1.0, 2.0, 3.0]
    assert got["thin"] == [1.0, 2.0]  # three rows are no bin


def grown(values: list[tuple[float, int]], n_bins: int, least: int) -> list[float]:
    """Edges of a best-first tree, by trying every split of every leaf."""
    values = sorted(values)
    impurity = lambda some: len(some) - (sum(y for _, y in some) ** 2 + (len(some) - sum(y for _, y in some)) ** 2) / len(some)

    def split(leaf):
        best = None
        for k in range(least, len(leaf) - least + 1):
            if leaf[k - 1][0] < leaf[k][0]:
                gain = impurity(leaf) - impurity(leaf[:k]) - impurity(leaf[k:])
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, k)
        return best

    leaves, cuts = [values], []
    while len(leaves) < n_bins:
        able = [(split(leaf), leaf) for leaf in leaves if len(leaf) >= 2 * least]
        able = [(s, leaf) for s, leaf in able if s]
        if not able:
            break
        (_, k), leaf = max(able, key=lambda x: x[0][0])
        cuts.append((leaf[k - 1][0] + leaf[k][0]) / 2)
        leaves.remove(leaf)
        leaves += [leaf[:k], leaf[k:]]
    return [values[0][0], *sorted(cuts), values[-1][0]]


def test_trees_are_those_of_all_splits(spark):
    r = random.Random(8)
    rows = {f: [(v := float(r.randint(0, top)), int(r.random() < 0.2 + 0.6 * ((v * 7 / top) % 1))) for _ in range(n)] for f, n, top in (("a", 900, 300), ("b", 400, 12))}
    rows["single"] = [(float(k), 0) for k in range(200)]
    got = {x["feature"]: list(x["edges"]) for x in binning.tree_edges(histogram(long(spark, rows)), 6, floor=20).collect()}
    for f in ("a", "b"):
        assert got[f] == pytest.approx(grown(rows[f], 6, max(int(0.05 * len(rows[f])), 20)))
    assert len(got["single"]) > 2


def test_isotonic_table_is_that_of_all_rows(spark):
    r = random.Random(4)
    rows = [(s := r.random(), int(r.random() < s * s)) for _ in range(3000)] + [(0.5, 1)] * 20
    got = sorted(tuple(x) for x in fusion.isotonic_table(spark.createDataFrame(rows, "score double, y int").repartition(3)).collect())
    sums: dict[float, list[int]] = {}
    for s, y in rows:
        sums.setdefault(s, [0, 0])
        sums[s][0] += y
        sums[s][1] += 1
    pools = fusion._pooled((p, n, s, s) for s, (p, n) in sorted(sums.items()))
    want = [(x, p / n) for p, n, low, high in pools for x in dict.fromkeys((low, high))]
    assert [x for x, _ in got] == [x for x, _ in want] and [y for _, y in got] == pytest.approx([y for _, y in want])
    assert all(a[1] <= b[1] for a, b in zip(got, got[1:]))
    assert fusion.isotonic_table(spark.createDataFrame(rows[:100], "score double, y int")).count() == 0


def test_forward_folds():
    assert splitting._fold_cuts([(d, 10) for d in range(10)], 4) == [1, 3, 5, 7]
    assert splitting._fold_cuts([(1, 90), (2, 1), (3, 1), (4, 8)], 3) == [1, 2, 3]  # cuts that coincide move on
    assert splitting._fold_cuts([(1, 5), (2, 5)], 4) == [1]
    with pytest.raises(ValueError):
        splitting._fold_cuts([(1, 5)], 4)


def test_small_test_blocks_join_the_one_before(spark):
    days = [1] * 100 + [2] * 100 + [3] * 10 + [4] * 90 + [None] * 5
    rows = [(k, d) for k, d in enumerate(days)]
    got = splitting.forward_folds(spark.createDataFrame(rows, "k int, day int"), 3, min_test_rows=50).groupBy("block").count().collect()
    assert {r["block"]: r["count"] for r in got} == {0: 105, 1: 110, 2: 90}


def test_splits_of_tables_with_few_days(spark):
    for days in ([7] * 20, [7, 8] * 10):
        rows = [(k, d, k % 2) for k, d in enumerate(days)]
        got = splitting.split_rows(spark.createDataFrame(rows, "k int, day int, y int"), ["k"]).groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in got} == {"train": 14, "valid": 3, "oot": 3}
    none = splitting.split_rows(spark.createDataFrame([(k, k % 2) for k in range(20)], "k int, y int"), ["k"])
    assert {r["split"]: r["count"] for r in none.groupBy("split").count().collect()} == {"train": 14, "valid": 4, "oot": 2}


def test_no_calibration_rows_where_they_are_too_few(spark):
    rows = [(k, k, k % 2, "valid") for k in range(100)]
    df = spark.createDataFrame(rows, "k int, day int, y int, split string")
    assert splitting.calibration_carve(df, ["day", "k"]).where("calibration").count() == 0
    assert splitting.calibration_carve(df, ["day", "k"], min_rows=50).where("calibration").count() == 50


def test_alpha_falls_back_on_few_rows(spark):
    rows = [(k, (k * 37 % 101) / 101, (k * 53 % 97) / 97, int(k % 40 == 0)) for k in range(3000)]
    df = spark.createDataFrame(rows, "k int, r double, q double, y int")
    assert tuple(fusion.fit_alpha(df.where("k < 1500"), "r", "q", "y", "k").first()) == (0.5, None, "default_fallback")
    assert fusion.fit_alpha(df, "r", "q", "y", "k").first()["origin"] == "grid"


@pytest.mark.parametrize(("k", "sketch"), [(0.1, 1000), (0.013, 40), (777, 40), (1, 1000), (5200, 1000)])
def test_alpha_lifts_with_split_ties(spark, monkeypatch, k, sketch):
    r = random.Random(11)
    rows = [(i, r.choice([0.2, 0.5, 0.5, 0.9, r.random()]), None if i % 31 == 0 else r.choice([0.3, 0.5, 0.5, r.random()]), int(r.random() < 0.2)) for i in range(4000)]
    rows += [(4000 + i, 0.95, 0.95, i % 2) for i in range(1200)]  # a tie across the top tenth, whatever the alpha
    monkeypatch.setattr(fusion, "SKETCH", sketch)
    df = spark.createDataFrame(rows, "key int, r double, q double, value int").repartition(7)
    got = {row.alpha: row.lift for row in fusion.alpha_lifts(df, "r", "q", "value", "key", k).collect()}
    size = max(1, math.ceil(len(rows) * k)) if isinstance(k, float) else min(k, len(rows))
    base = sum(row[3] for row in rows) / len(rows)
    for alpha in fusion.GRID:
        best = sorted(rows, key=lambda x: (-round(max(x[1], 1e-12) ** alpha * max(x[2] or 0, 1e-12) ** (1 - alpha), 12), x[0]))[:size]
        assert math.isclose(got[alpha], sum(x[3] for x in best) / size / base, rel_tol=1e-9)
    assert fusion.alpha_lifts(df.limit(0), "r", "q", "value", "key", k).count() == 0


def test_alpha_lifts_where_the_sketch_misses(spark, monkeypatch):
    rows = [(i, (i * 37 % 101) / 101, (i * 53 % 97) / 97, int(i % 7 == 0)) for i in range(500)]
    df = spark.createDataFrame(rows, "key int, r double, q double, y int")
    right = sorted(map(tuple, fusion.alpha_lifts(df, "r", "q", "y", "key").collect()))
    monkeypatch.setattr(fusion, "_brackets", lambda cells, share: {a: (-0.02, -0.01) if a < 0.5 else (-0.99, -0.98) for a in fusion.GRID})
    assert sorted(map(tuple, fusion.alpha_lifts(df, "r", "q", "y", "key").collect())) == right


def test_correlated_features_form_clusters(spark):
    r = random.Random(2)
    rows = []
    for _ in range(400):
        a, b = r.random(), r.random()
        rows.append((a, a + 0.01 * r.random(), b, None if r.random() < 0.3 else -b, r.random()))
    wide = spark.createDataFrame(rows, "a double, a2 double, b double, b2 double, c double").repartition(3)
    names = ["a", "b", "a2", "b2", "c"]
    found = correlation.edges(wide, names, 0.95)
    assert {(e["f1"], e["f2"]) for e in found.collect()} == {("a", "a2"), ("b", "b2")}
    assert {r["feature"]: r["cluster"] for r in correlation.clusters(spark, names, found).collect()} == {"a": 0, "a2": 0, "b": 1, "b2": 1, "c": 2}


def test_files_with_aliases(spark, tmp_path):
    for name, head in (("1", "id,dt,x"), ("2", "id,day,x")):
        (tmp_path / f"d{name}.csv").write_text(f"{head}\n{name},2024010{name},0.5\n")
    (tmp_path / "d3.csv").write_text("id,x,dt\n1,2,3\n")
    pattern = f"file://{tmp_path}/d{{}}.csv"
    both = files.read_files(spark, files.enumerated(spark, pattern, ["1", "2"]), {"x": "double"}, {"dt": ["day", "time"]})
    assert sorted(tuple(r) for r in both.collect()) == [("1", "20240101", 0.5), ("2", "20240102", 0.5)]
    with pytest.raises(ValueError, match="order changed True"):
        files.read_files(spark, files.enumerated(spark, pattern, ["1", "3"]), {})
    with pytest.raises(FileNotFoundError):
        files.enumerated(spark, pattern, ["1", "9"])
    with pytest.raises(ValueError):
        files.canonical_header(["id"], {"dt": ["day"]})
    assert files.probed(both, "x", "id") == [("dt", "string")]
    with pytest.raises(ValueError):
        files.probed(both, "y", "id")


def test_feature_lists_and_names(spark, tmp_path):
    report = spark.createDataFrame([("a", 1.0, True), ("b", 3.0, True), ("c", 2.0, False)], "feature string, rank_score double, auto_keep boolean")
    files.write_feature_list(report, f"file://{tmp_path}/list", 5)
    assert files.feature_list(spark, f"file://{tmp_path}/list") == ["b", "a"]
    names = spark.createDataFrame([("a", "Age")], "feature string, name string")
    out = files.named(report, names)
    assert out.columns[:2] == ["feature", "name"]
    assert {r["feature"]: r["name"] for r in out.collect()} == {"a": "Age", "b": "b", "c": "c"}


def test_labels_and_empty_splits_are_checked(spark):
    df = spark.createDataFrame([(1, 0, None, "train"), (2, 5, 1.0, "oot")], "k int, y int, x double, split string")
    with pytest.raises(ValueError, match="5"):
        preparation.require_binary(df)
    with pytest.raises(ValueError, match="train"):
        preparation.drop_empty_rows(df, ["x"])
    with pytest.raises(ValueError):
        preparation.fit_fill(spark.createDataFrame([(float(k),) for k in range(10)], "x double"), {"x": 5.0})


def test_companion_rows_of_metrics(spark):
    rows = [(k, k % 2, k / 100, "oot" if k < 50 else "valid", k >= 80, k < 10) for k in range(100)]
    df = spark.createDataFrame(rows, "k int, y int, score double, split string, calibration boolean, all_missing boolean")
    got = {r["split"]: r["n"] for r in ranking.evaluated(ranking.with_companions(df), ["k"]).collect()}
    assert got == {"oot": 50, "oot_excl_all_na": 40, "valid": 30, "valid_calib": 20}


def test_naming_rules_and_presets(spark):
    from liftwork.operators import selection

    names = ["bal_30d", "bal_d90", "bal_last30days", "bal_近7天", "bal_3mon", "bal_2y", "bal", "n_60", "x_W5_y", "all"]
    frame = spark.createDataFrame([(n,) for n in names], "feature string")
    own = selection.FamilyRule("own", r"^(?P<base>.+)_W(?P<window>\d)_y$", alias={"5": "30d"})
    rules = ["suffix_day", "prefix_d", "english_last_days", "chinese_jin_days", "suffix_mon_to_days", "suffix_year_to_days", "number_only", own]
    got = {r["feature"]: (r["family"], r["window"], r["window_rank"], r["rule"]) for r in selection.families_by_rules(frame, rules).collect()}
    assert got["bal_30d"] == ("bal", "30d", 1, "suffix_day") and got["bal_d90"] == ("bal", "90d", 2, "prefix_d")
    assert got["bal_last30days"][:3] == ("bal", "30d", 1) and got["bal_近7天"][:3] == ("bal", "7d", 0)
    assert got["bal_3mon"][:3] == ("bal", "90d", 2) and got["bal_2y"][:3] == ("bal", "720d", 8)
    assert got["n_60"][:3] == ("n", "60d", 8) and got["x_W5_y"] == ("x", "30d", 1, "own")
    assert got["bal"] == ("bal", None, None, None) and got["all"] == ("all", None, None, None)
    off = selection.families_by_rules(frame, rules, enabled=False).collect()
    assert all(r["family"] == r["feature"] and r["window"] is None for r in off)
    for name, rule in selection.RULES.items():
        assert {"base", "window"} <= set(__import__("re").compile(rule.pattern).groupindex), name


def test_family_audit_warns_and_joins(spark, caplog):
    import logging

    from liftwork.operators import selection

    gains = spark.createDataFrame([("a_30d", 6.0), ("a_90d", 1.0), ("b", 2.0), ("c", 1.0)], "feature string, gain double")
    families = selection.families_by_rules(gains.where("feature <> 'c'").select("feature"), ["suffix_day"])
    with caplog.at_level(logging.WARNING):
        got = [(r["family"], r["total_gain"], r["kept_count"]) for r in selection.family_gain_audit(gains, families).collect()]
    assert got == [("a", 7.0, 2), ("b", 2.0, 1), ("c", 1.0, 1)] and "a has 70.0 %" in caplog.text
    assert selection.family_gain_audit(gains.withColumn("gain", gains["gain"] * 0), families).count() == 0


def test_isotonic_tables_across_ranges(spark, monkeypatch):
    """Ranges of three pools give the table of all scores at once, also where violators cross many ranges."""
    r = random.Random(12)
    rows = [(round(r.random(), 3), int(r.random() < 0.2 + 0.5 * (k % 2) * r.random())) for k in range(900)] + [(0.99 + k / 10_000, 0) for k in range(60)]
    df = spark.createDataFrame(rows, "score double, y int")
    whole = sorted((x["x"], x["y"]) for x in fusion.isotonic_table(df).collect())
    monkeypatch.setattr(fusion, "POOLS", 6)
    cut = sorted((x["x"], x["y"]) for x in fusion.isotonic_table(df).collect())
    assert [x for x, _ in cut] == [x for x, _ in whole] and [y for _, y in cut] == pytest.approx([y for _, y in whole])
    by = {}
    for s, y in rows:
        by.setdefault(s, []).append(y)
    pools = fusion._pooled((float(sum(by[s])), float(len(by[s])), s, s) for s in sorted(by))
    want = [(x, p / n) for p, n, low, high in pools for x in dict.fromkeys((low, high))]
    assert [x for x, _ in whole] == [x for x, _ in want] and [y for _, y in whole] == pytest.approx([y for _, y in want])


def test_dataset_with_a_calibration_part(spark):
    rows = [(k, 20240101 + k // 40, k % 2, None if k % 9 == 0 else float(k % 17)) for k in range(400)]
    df = spark.createDataFrame(rows, "k long, day int, y int, v double")
    out = preparation.build_dataset(df, {"v": "median"}, ["k"], carve=0.5)
    held = out.where("calibration").agg({"k": "min", "*": "count"}).first()
    valid = out.where("split = 'valid'")
    assert "calibration" in out.columns and out.where("calibration and split <> 'valid'").count() == 0
    assert held["count(1)"] in (0, valid.count() // 2)  # none where the part is too small


def test_zeros_as_missing(spark):
    from liftwork.models import screening

    df = spark.createDataFrame([(0.0, 1.0), (2.0, 0.0)], "a double, b double")
    seen = lambda **o: [tuple(r) for r in screening.zero_as_missing(df, ["a", "b"], **o).collect()]
    assert seen() == [(None, 1.0), (2.0, None)] == seen(treat_zero=False, sentinels=(0,))
    assert seen(treat_zero=False) == [(0.0, 1.0), (2.0, 0.0)]


def test_one_parse_of_a_model_per_worker(spark):
    from liftwork.models import serving
    from liftwork.models.boosting import Model, Run, Tree

    tree = Tree.empty(1)
    tree.feature[0], tree.value[1], tree.value[2] = 0, -1.0, 1.0
    rows = [(k % 7, '{"a": %d}' % (k % 3)) for k in range(400)] + [(9, "no vector"), (9, '{"a": "x"}'), (10, None), (None, '{"b": 1}')]
    frame = spark.createDataFrame(rows, "entity long, vector string").repartition(16)
    loads = spark.sparkContext.accumulator(0)
    for version in ("one", "one", "two"):
        got = {r["entity"]: (round(r["score"], 4), r["failed"]) for r in serving.entity_scores(frame, Model(Run("m"), [tree]), {"a": [0.0, 1.0, 2.0]}, f"{version}-{id(loads)}", loads=loads).collect()}
        assert got[0] == (0.7311, 0) and got[9] == (-1.0, 2) and got[10] == (-1.0, 1)
    assert 2 <= loads.value <= 2 * 4  # four workers, two versions, sixteen tasks a run
