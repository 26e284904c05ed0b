"""Saved pipelines, streams, bucketed tables, sinks, fingerprints and row ids."""

from __future__ import annotations

import datetime as dt
import json
import logging
import random

import pytest
from pyspark.sql import functions as F

from liftwork.functions.cleaning import MissingRules
from liftwork.models import boosting, replay
from liftwork.operators import preparation, ranking, splitting
from liftwork.sources import buckets, fingerprint, positions, sinks
from liftwork.streaming import drift


# -- row ids


@pytest.mark.parametrize("hot", [False, True])
def test_row_ids_are_dense_and_stable(spark, hot):
    r = random.Random(1)
    rows = [(k, 7.0 if hot or k % 3 == 0 else r.random(), None if k % 11 == 0 else k % 5) for k in range(700)]
    df = spark.createDataFrame(rows, "k long, v double, g long")
    want = {k: i for i, (k, *_) in enumerate(sorted(rows, key=lambda x: (x[1], x[0])))}
    for n in (1, 9):
        got = {x["k"]: x["row_id"] for x in positions.numbered(df.repartition(n), ["v", "k"]).collect()}
        assert got == want
    same = positions.numbered(df.select(F.lit(1).alias("one")), ["one"])
    assert sorted(x["row_id"] for x in same.collect()) == list(range(700))
    assert positions.numbered(df.limit(0), ["v"]).count() == 0
    ids = spark.createDataFrame([(0,), (699,), (699,), (5000,)], "row_id long")
    assert sorted(x["row_id"] for x in positions.at_positions(positions.numbered(df, ["k"]), ids).collect()) == [0, 699, 699]


# -- rows with NULL groups stay


def test_splits_keep_rows_without_label_or_split(spark):
    rows = [(k, None if k % 3 == 0 else k % 2, None if k % 5 == 0 else ("train", "valid")[k % 2], 20240101 + k) for k in range(30)]
    df = spark.createDataFrame(rows, "k long, y int, split string, day int")
    out = splitting.split_stratified(df.drop("split"), "k")
    assert out.count() == 30 and out.where("split is null").count() == 0
    assert {r["split"]: r["count"] for r in out.where("y is null").groupBy("split").count().collect()} == {"train": 7, "valid": 2, "oot": 1}
    carved = splitting.calibration_carve(df, ["day", "k"], min_rows=1, min_pos=1)
    assert carved.count() == 30 and carved.where("calibration is null").count() == 0
    assert carved.where("calibration and split is null").count() == 0


def test_an_embargo_loses_no_row_of_the_carve(spark):
    df = spark.createDataFrame([(k, k % 2, 20240101 + k // 10) for k in range(300)], "k long, y int, day int")
    split = splitting.split_by_day(df, embargo=2)
    assert split.where("split is null").count() > 0
    assert splitting.calibration_carve(split, ["day", "k"], min_rows=1, min_pos=1).count() == 300


def test_ranks_with_missing_scores_and_hot_ties(spark):
    rows = [(k, None if k % 10 == 0 else (0.5 if k % 2 else k / 1000), k % 2, "a" if k % 3 else None) for k in range(400)]
    df = spark.createDataFrame(rows, "k long, score double, y int, split string")
    order = lambda x: (x[1] is None, -(x[1] or 0), x[0])
    got = {r["k"]: r["rank"] for r in splitting.ranked(df, "score", ["k"], descending=True).collect()}
    assert got == {x[0]: i for i, x in enumerate(sorted(rows, key=order), 1)}
    for r in ranking.evaluated(df, ["k"], 0.1).collect():
        own = sorted((x for x in rows if x[3] == r["split"]), key=order)
        top = own[: -(-len(own) // 10)]
        hits, ones = sum(x[2] for x in top), sum(x[2] for x in own)
        assert r["n"] == len(own) and r["precision_at_k"] == pytest.approx(hits / len(top)) and r["recall_at_k"] == pytest.approx(hits / ones)
        assert r["lift_at_k"] == pytest.approx(hits / len(top) / (ones / len(own)))


# -- replay


@pytest.fixture(scope="module")
def fitted(spark):
    r = random.Random(3)
    rows = [(k, r.choice([None, 0.0, -1.0, r.random()]), r.choice([5.0, 7.0, r.random() * 9]), int(r.random() < 0.4)) for k in range(500)]
    raw = spark.createDataFrame(rows, "k long, a double, b double, y int")
    rules = MissingRules(overrides={"b": MissingRules(sentinels=(5.0,))})
    cleaned = replay.CleanStage.of(columns=["a", "b"], rules=replay._as_dict(rules), overrides={"b": replay._as_dict(rules.overrides["b"])}).transform(raw)
    edges = {"a": [0.0, 0.25, 0.5, 1.0], "b": [0.0, 2.0, 4.0, 6.0, 9.0]}
    table = boosting.fit_table(cleaned, "k", edges, [F.col("y")], [F.lit(boosting.TRAIN)])
    (model,) = boosting.fit(table, [boosting.Run("r", eta=0.3)], 2, rounds=4)
    pipeline = replay.scoring_pipeline(["a", "b"], rules, ["a"], {}, model, edges, [(0.2, 0.1), (0.6, 0.5)])
    scores = {x["key"]: x["score"] for x in boosting.scored(table, [model]).collect()}
    return raw, pipeline, scores


def test_scores_after_loading_are_those_of_training(fitted, tmp_path):
    raw, pipeline, scores = fitted
    replay.save(pipeline, f"file://{tmp_path}/p")
    found = replay.scored(replay.load(f"file://{tmp_path}/p"), raw.withColumn("extra", F.lit("x"))).collect()
    assert len(found) == 500 and all(abs(r["raw_score"] - scores[r["k"]]) < 1e-6 for r in found)
    level = lambda s: 0.1 if s <= 0.2 else 0.5 if s >= 0.6 else 0.1 + (s - 0.2)
    assert all(r["score"] == pytest.approx(level(r["raw_score"])) and r["extra"] == "x" for r in found)
    assert {r["a__isnan"] for r in found} == {0.0, 1.0}


def test_replay_refuses_missing_columns_and_newer_versions(fitted, tmp_path):
    raw, pipeline, _ = fitted
    with pytest.raises(ValueError, match="lacks b"):
        replay.scored(pipeline, raw.drop("b"))
    newer = replay.FillStage(payload=json.dumps({"fills": {}, "version": replay.VERSION + 1}))
    with pytest.raises(ValueError, match="version"):
        newer.transform(raw)


def test_replay_warns_of_rows_without_values(fitted, spark, caplog):
    _, pipeline, _ = fitted
    rows = spark.createDataFrame([(1, None, 5.0), (2, 0.5, 1.0)], "k long, a double, b double")
    with caplog.at_level(logging.WARNING):
        found = {r["k"]: r["all_missing"] for r in replay.scored(pipeline, rows).collect()}
    assert found == {1: True, 2: False} and "1 rows" in caplog.text


def test_schema_probe_fill_check_and_overrides(spark):
    """Values of small helpers: fills within the range are errors, rules of a column go before the default."""
    df = spark.createDataFrame([(float(k), None if k % 4 == 0 else 1.0) for k in range(1, 41)], "a double, b double")
    with pytest.raises(ValueError, match="fill 20.0 of a"):
        preparation.fit_fill(df, {"a": 20.0})
    assert preparation.fit_fill(df, {"a": -1.0, "b": "median"}) == {"a": -1.0, "b": 1.0}
    assert preparation.fit_fill(df, {"a": "median"}) == {"a": 20.5}
    assert preparation.fit_fill(df.where("a < 0"), {"a": "median"}) == {"a": -999.0}


# -- streams


def _events(spark, folder, name, rows):
    frame = spark.createDataFrame([(k, dt.datetime(2024, 1, d, h, m), v) for k, d, h, m, v in rows], "user_id long, ts timestamp_ntz, value double")
    frame.coalesce(1).write.parquet(f"{folder}/{name}")


def test_a_stream_goes_on_where_it_ended_and_drops_late_rows(spark, tmp_path):
    folder = f"file://{tmp_path}/in"
    _events(spark, folder, "1", [(1, 1, 10, 0, 0.5), (1, 1, 11, 0, 1.5), (2, 2, 9, 0, None), (1, 4, 0, 0, 9.0)])
    stream = lambda: drift.windowed_counts(drift.event_stream(spark, f"{folder}/*"), [0.0, 1.0, 2.0])
    day = lambda r: dt.datetime.fromtimestamp(r["start"] / 1e6, dt.UTC).day
    run = lambda: sorted((day(r), r["bin"], r["n"]) for r in drift.run_available(stream(), f"file://{tmp_path}/out", f"file://{tmp_path}/memory").collect())
    first = [(1, 0, 1), (1, 1, 1), (2, -1, 1)]
    assert run() == first
    assert run() == first  # nothing new: nothing is written twice
    _events(spark, folder, "2", [(1, 1, 12, 0, 0.5), (3, 4, 5, 0, 0.7), (1, 9, 0, 0, 1.0)])  # the first comes after its day was closed
    assert run() == [*first, (4, 0, 1), (4, 1, 1)]


def test_sessions_end_after_a_gap(spark, tmp_path):
    folder = f"file://{tmp_path}/in"
    _events(spark, folder, "1", [(1, 1, 0, 0, 1.0), (1, 1, 5, 59, 2.0), (1, 1, 11, 59, 4.0), (1, 1, 18, 0, 16.0), (2, 1, 3, 0, 8.0), (None, 1, 3, 0, 9.0), (3, 20, 0, 0, 0.0)])
    found = drift.run_available(drift.sessions(drift.event_stream(spark, f"{folder}/*")), f"file://{tmp_path}/out", f"file://{tmp_path}/memory")
    assert sorted((r["user_id"], r["n"], r["total"]) for r in found.collect()) == [(1, 1, 16.0), (1, 3, 7.0), (2, 1, 8.0)]


# -- buckets


def test_bucketed_chain_shuffles_nothing(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = lambda rows, c: buckets.bucketed(spark.createDataFrame(rows, f"k long, {c} string"), "k", 4, c)
        a, b = made([(1, "a1"), (2, "a2"), (2, "a2b"), (None, "an")], "a"), made([(2, "b2"), (3, "b3"), (None, "bn")], "b")
        c = made([(3, "c3"), (4, "c4")], "c")  # two of its buckets are empty
        out = buckets.outer_chain([a, b, c], "k")
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        want = [(1, "a1", None, None), (2, "a2", "b2", None), (2, "a2b", "b2", None), (3, None, "b3", "c3"), (4, None, None, "c4"), (None, "an", None, None), (None, None, "bn", None)]
        assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)
        assert out.columns == ["k", "a", "b", "c"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- sinks


def test_other_partitions_keep_their_files(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(k, k % 3) for k in range(30)], "v long, p long")
    sinks.overwrite_partitions(df, path, ["p"])
    files = lambda p: sorted(x.name for x in (tmp_path / "t" / f"p={p}").glob("*.parquet"))
    before = {p: files(p) for p in (0, 1, 2)}
    sinks.overwrite_partitions(df.where("p = 1").withColumn("v", F.col("v") + 100), path, ["p"])
    assert files(0) == before[0] and files(2) == before[2] and files(1) != before[1]
    assert spark.read.parquet(path).agg(F.sum("v")).first()[0] == sum(range(30)) + 1000
    made = sinks.create_table(df, "sink_table", f"file://{tmp_path}/table", ["p"])
    assert made.count() == 30
    with pytest.raises(Exception, match="already exists"):
        sinks.create_table(df, "sink_table", f"file://{tmp_path}/table", ["p"])
    spark.sql("drop table sink_table")


def test_a_failed_report_leaves_the_old_one(spark, tmp_path):
    folder = f"file://{tmp_path}/report"
    one = spark.createDataFrame([(1,)], "v int")
    sinks.swap_report({"a": one, "b": one}, folder)
    bad = one.select(F.raise_error(F.lit("no")).cast("int").alias("v"))
    with pytest.raises(Exception, match="no"):
        sinks.swap_report({"a": one.withColumn("v", F.lit(2)), "b": bad}, folder)
    assert spark.read.parquet(f"{folder}/a").first()["v"] == 1
    sinks.swap_report({"a": one.withColumn("v", F.lit(3))}, folder)
    assert spark.read.parquet(f"{folder}/a").first()["v"] == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["report"] and sorted(p.name for p in (tmp_path / "report").iterdir()) == ["a"]


def test_reports_keep_their_order(spark, tmp_path):
    rows = [(f"f{k:02d}", (k * 7) % 5 / 10) for k in range(40)]
    sinks.write_ordered(spark.createDataFrame(rows, "feature string, iv double").repartition(5), f"file://{tmp_path}/r", [F.desc("iv"), "feature"])
    lines = [line.split(",") for part in sorted((tmp_path / "r").glob("part-*")) for line in part.read_text().splitlines() if not line.startswith("position")]
    assert [x[0] for x in lines] == [str(k) for k in range(1, 41)]
    assert [x[1] for x in lines] == [f for f, _ in sorted(rows, key=lambda x: (-x[1], x[0]))]


# -- fingerprints


def test_changed_inputs_are_told(spark, tmp_path):
    source, artifact = f"file://{tmp_path}/in", tmp_path / "artifact"
    artifact.mkdir()
    spark.range(10).write.parquet(source)
    check = lambda config=None: fingerprint.require_fresh(spark, f"file://{artifact}", {"in": source}, config)
    with pytest.raises(fingerprint.StaleArtifactError, match="no fingerprint"):
        check()
    fingerprint.write_fingerprint(spark, f"file://{artifact}", {"in": source})
    check()
    with pytest.raises(fingerprint.StaleArtifactError, match="settings"):
        check({"label": "y"})
    note = artifact / fingerprint.NAME
    good = note.read_text()
    (artifact / f".{fingerprint.NAME}.crc").unlink()
    note.write_text(json.dumps(json.loads(good) | {"version": fingerprint.VERSION + 1}))
    with pytest.raises(fingerprint.StaleArtifactError, match="version"):
        check()
    note.write_text(good)
    touched = next((tmp_path / "in").glob("*.parquet"))
    import os

    os.utime(touched, (1, 1))
    with pytest.raises(fingerprint.StaleArtifactError, match="digest of in"):
        check()
    spark.range(10).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(source)
    with pytest.raises(fingerprint.StaleArtifactError, match="schema of in"):
        check()
    with pytest.raises(fingerprint.StaleArtifactError, match="other is new"):
        fingerprint.require_fresh(spark, f"file://{artifact}", {"in": source, "other": source})
