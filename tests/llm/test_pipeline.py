"""The corpus pipeline, stage by stage, against brute force."""

from __future__ import annotations

import hashlib
import re

import corpus_pipeline
import pytest
from llm.fixtures import corpus
from llm.test_documents import DOCUMENTS, base_spans, components, signals


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(corpus(11, 120), DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    """(name, rows of the stage before, rows) of each stage."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    out = []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder).cache()
        out.append((name, docs.collect(), found.collect()))
        docs = found
    return out


def test_quality_keeps_documents_that_pass(stages):
    _, before, after = stages[0]
    kept = {r.doc_id for r in after}
    for r in before:
        n, *_, repeated = signals(r.text)
        if n < 50 or 100 * repeated > 50 * n:
            assert r.doc_id not in kept
    assert len(kept) > 30


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    root = components([(r.doc_id, r.text) for r in before], 80, 5)
    assert {r.doc_id for r in after} == set(root.values())
    assert len(after) < len(before)


def test_later_passages_go(stages):
    _, before, after = stages[2]
    seen, want = {}, {}
    for r in sorted(before, key=lambda r: r.doc_id):
        data = (r.text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if seen.setdefault(data[p : p + 100], (r.doc_id, p)) != (r.doc_id, p):
                gone[p : p + 100] = b"\1" * 100
        want[r.doc_id] = bytes(c for c, g in zip(data, gone, strict=True) if not g).decode("utf-8", "ignore")
    assert {r.doc_id: r.text for r in after} == want
    assert any(len(r.text) < len(q.text) for r in after for q in before if r.doc_id == q.doc_id)


def test_secrets_are_marked(stages):
    _, before, after = stages[3]
    text_of = {r.doc_id: r.text for r in after}
    for r in before:
        spans = base_spans(r.text)
        assert ("[SECRET]" in text_of[r.doc_id]) >= bool(spans)
        for start, _, end, kind in spans:
            if kind != "assign":
                assert r.text[start:end] not in text_of[r.doc_id]
        if not spans and not re.search("-----BEGIN|gh[pousr]_|eyJ", r.text):
            assert text_of[r.doc_id] == r.text


def test_columns_and_counts(stages):
    for name, before, after in stages[:-1]:
        assert tuple(after[0].asDict()) == corpus_pipeline.COLUMNS
    assert {r.doc_id for r in stages[-1][1]} == {r.doc_id for r in stages[-1][2]}


def test_run_returns_the_last_stage(spark, folder, stages):
    digest = lambda rows: hashlib.sha256(repr(sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)).encode()).hexdigest()
    assert digest(corpus_pipeline.run(spark, folder).collect()) == digest(stages[-1][2])


ODD = [(None, None, None, None, None), (None, "a b c", "en", None, 5), (5, "a b c", "en", "web", 5), (5, "a b c", "en", "web", 5)]


def test_odd_rows_by_stage(spark, folder):
    """Repeated ids with other texts, equal rows, nulls, empty texts, columns with clashing names."""
    words = [" ".join(f"{c}{k}" for k in range(90)) for c in "abc"]
    rows = [(7, words[0], "en", "web", 0), (7, words[1], "en", "web", 0), (8, words[0] + " z", "en", "web", 0), (9, words[1] + " z", "en", "web", 0), (9, "short", "en", "web", 5), (10, words[2], "en", "web", 0), (10, words[2], "en", "web", 0), (None, words[2], None, None, None), *ODD]
    docs = spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", "'x' as kept", "1 as n_words", "2 as component_id", "3 as spans", "4 as _id", "5 as _hash", "6 as _text")
    quality, near, passages, secrets, packing = (f for _, f in corpus_pipeline.STAGES)
    texts = lambda d: sorted(((r.doc_id, r.text) for r in d.collect()), key=repr)
    kept = quality(spark, docs, folder)
    long = sorted(((r[0], r[1]) for r in rows if r[1] and len(r[1]) > 100), key=repr)
    assert texts(kept) == long  # of rows with one id, those that pass
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    want = [(7, words[0]), (7, words[1]), (10, words[2]), (10, words[2]), (None, words[2])]
    assert texts(near(spark, kept, folder)) == sorted(want, key=repr)
    assert texts(near(spark, docs, folder)) == sorted([*want, (9, "short"), *((r[0], r[1]) for r in ODD)], key=repr)
    cut = {(i, t) for i, t in texts(passages(spark, docs, folder))}
    assert (None, words[2]) in cut and (10, "") in cut  # a null id stands before all others
    assert sum(1 for _ in passages(spark, docs, folder).collect()) == len(rows)
    assert texts(secrets(spark, docs, folder)) == texts(docs)
    assert packing(spark, docs, folder).count() == len(rows)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
