"""Lexical search, source mixing and the filter audit against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from compare import differences
from llm.fixtures import DOCUMENTS, corpus, frame

from liftwork.llm import block_max_search, filter_audit, queries, source_mix

TINY = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def rows():
    found = corpus(seed=11)
    again = [(i, t, lang, source, n) for i, t, lang, source, n in found[:6]]
    return [*found, *again, (None, "ab ab cd", "en", "web", 8), (None, None, None, None, None), (found[9][0], "another text of that id", "en", "web", 23)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.mark.parametrize("name", ["op11_block_max_search", "op12_source_mix", "op13_filter_audit"])
def test_query_equals_its_sql(spark, name):
    assert differences(spark, TINY, queries.queries()[name], queries.oracle_sql()[name]) == ""


# -- search


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def searched(rows, items, top):
    counts = [(r[0], Counter(terms(r[1]))) for r in rows]
    counts = [(d, c) for d, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, k, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def asked(rows):
    some = [r[1] for r in rows if r[1] and len(r[1]) > 200][:14]
    return [*enumerate([*(t[:300] for t in some), some[0][5:90], None, "", "!!", "zzzz never", some[1][:300]]), (3, some[2][:150]), (3, some[2][:150]), (None, some[3][40:140])]


@pytest.mark.parametrize(("top", "block", "groups"), [(50, 128, 200_000), (3, 4, 200_000), (5, 7, 300)])
def test_search_equals_brute_force(spark, docs, rows, monkeypatch, top, block, groups):
    monkeypatch.setattr(block_max_search.forward_blocks, "__defaults__", (block,))
    monkeypatch.setattr(block_max_search, "CELLS", 2000)
    items = asked(rows)
    tell = []
    found = block_max_search.search(docs, spark.createDataFrame(items, "item_id long, text string"), top, groups, tell).collect()
    assert sorted((tuple(r) for r in found), key=repr) == searched(rows, items, top)
    assert (len(tell) > 1) == (groups == 300)
    assert sum(t["scored"] for t in tell) <= sum(t["pairs"] for t in tell)


def test_search_prunes_blocks(spark):
    plain = [(k, f"common words of every text {k % 7}") for k in range(3000)]
    rare = [(k, "a rare pearl common words") for k in range(3000, 3060)]
    tell = []
    docs = spark.createDataFrame([*plain, *rare], "doc_id long, text string").repartitionByRange(4, "doc_id")
    found = block_max_search.search(docs, spark.createDataFrame([(1, "rare pearl common words")], "item_id long, text string"), tell=tell).collect()
    assert sorted(r.doc_id for r in found) == list(range(3000, 3050))
    assert tell[0]["scored"] * 5 <= tell[0]["pairs"]


def test_search_of_nothing(spark, docs):
    items = spark.createDataFrame([(1, "ab")], "item_id long, text string")
    assert block_max_search.search(docs.limit(0), items).count() == 0
    assert block_max_search.search(docs, items.limit(0)).count() == 0
    assert block_max_search.search(docs, spark.createDataFrame([(1, "!")], "item_id long, text string")).count() == 0


def test_lengths_beyond_64_bits():
    n = np.array([3, 10**9], np.int64)
    assert block_max_search.lengths_norm(n, 10**11, 10**13).tolist() == [50 + 50 * int(x) * 10**11 // 10**13 for x in n]
    assert block_max_search.lengths_norm(np.array([4, 9]), 10, 70).tolist() == [50 + 50 * x * 10 // 70 for x in (4, 9)]


def test_bound_is_never_under_a_score():
    items = block_max_search.Items(["ab cd ef", "cd", "x"])
    items.weigh({0: 3, 1: 5, 2: 1}, 40)
    row = {"ids": [1, 2, 3], "terms": [0, 1, 2], "n": [5, 9, 2], "at": [0, 2, 4, 5], "place": [0, 1, 1, 2, 2], "tf": [3, 1, 2, 1, 2]}
    block = block_max_search.Block(row, 40, 300)
    bounds = items.bounds(block.terms, block.most())
    scores = items.scores(block, np.arange(3))
    assert (scores.max(axis=1) <= bounds).all() and scores[0].min() > 0 and bounds[2] == 0


# -- mixing


def filled(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and Fraction(left * weight[s], w) > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else Fraction(left * weight[s], w) for s in order}
        full |= over


def test_mix_of_odd_rows(docs, rows):
    found = source_mix.mixed(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    goal = filled(sizes)
    assert sorted(((r.doc_id, r.size) for r in found), key=repr) == sorted(((r[0], len(WORD.findall(r[1] or ""))) for r in rows), key=repr)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(goal[r.source]))
        rate = r.target / r.source_size
        assert r.copies in (math.floor(rate), math.ceil(rate)) and r.taken == r.copies * r.size <= 3 * r.size
    assert sum(float(g) for g in goal.values()) == pytest.approx(sum(sizes.values()))
    assert sorted(map(repr, source_mix.mixed(docs.repartition(13)).collect())) == sorted(map(repr, found))
    assert source_mix.mixed(docs.limit(0)).count() == 0


def test_mix_targets_and_shares(spark):
    rows = [(k, "w " * (k % 9 + 1), f"s{k % 5}" if k % 3 else "hot") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sums = defaultdict(lambda: [0, 0, 0.0])
    for r in source_mix.mixed(docs).collect():
        sums[r.source][0] += r.size
        sums[r.source][1] += r.taken
        sums[r.source][2] = r.target
    goal = filled({s: v[0] for s, v in sums.items()})
    for s, (_, taken, target) in sums.items():
        assert target == pytest.approx(float(goal[s]))
        assert abs(taken - target) < 0.06 * target
    again = Counter((r.doc_id, r.copy) for r in source_mix.emitted(docs, seed=source_mix.SEED).collect())
    copies = {r.doc_id: r.copies for r in source_mix.mixed(docs).collect()}
    assert again == Counter((d, k) for d, n in copies.items() for k in range(n))


def test_mix_of_many_sources(spark, monkeypatch):
    rows = [(k, "w " * (k % 4 + 1), None if k % 50 == 0 else f"s{k % 37}") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(map(repr, source_mix.mixed(docs).collect()))
    monkeypatch.setattr(source_mix, "SMALL", 3)
    assert sorted(map(repr, source_mix.mixed(docs).collect())) == want


# -- audit


def audited(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    least: dict = {}
    for d, text, *_ in rows:
        if d is not None and d < least.get(text or "", d + 1):
            least[text or ""] = d
    parts = defaultdict(list)
    for d, text, _, source, _ in rows:
        text = text or ""
        w = WORD.findall(text)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text), "E": d is not None and least[text] < d}
        parts[source or ""].append((d, {k for k, v in f.items() if v}))
    out = {}
    for part, members in parts.items():
        owed = Counter()
        for order in permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                here = [d for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                failing, alone = sum(x in f for _, f in members), sum(f == {x} for _, f in members)
                out[part, "".join(order), step] = [len(left), len(here), failing - len(here), alone, sum(d in good for d in here), sum(d in bad for d in here)]
                owed[x] += len(here)
        for (p, order, step), v in out.items():
            if p == part:
                v.append(owed[order[step - 1]])
    return out


def test_audit_equals_brute_force(spark, docs, rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    labels = [(d, k % 2, int(k % 5 == 0)) for k, d in enumerate(ids[::2])] + [(ids[0], 0, 1), (None, 1, 1), (-5, 1, 1)]
    found = filter_audit.audited(docs, spark.createDataFrame(labels, "doc_id long, quality long, toxic long")).collect()
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in found}
    assert len(got) == len(found) and got == audited(rows, labels)


def test_audit_of_many_copies(spark):
    rows = [(k, "same text", "en", "web" if k % 3 else None, 9) for k in range(1500)] + [(k, f"text {k}", "en", "web", 9) for k in range(1500, 1520)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    none = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audited(docs, none).collect()}
    assert len(got) == 1200
    assert got["", "EABCD", 1].removed == 499 and got["web", "EABCD", 1].removed == 1000
    assert filter_audit.audited(docs.limit(0), none).count() == 0


def test_polynomial_by_hand():
    counts = [0] * 32
    counts[0b00001], counts[0b00011], counts[0b11111], counts[0] = 4, 6, 5, 7
    p = filter_audit.removal_polynomial(counts)
    corner = filter_audit.at_corners(p)
    for s in range(32):
        assert corner[s] == sum(n for m, n in enumerate(counts) if m & s)
    assert filter_audit.shapley(p) == [Fraction(4) + 3 + 1, Fraction(3) + 1, Fraction(1), Fraction(1), Fraction(1)]


def test_words_are_compared_as_bytes():
    column = pa.array(["a b a", None, "A a é é", "", "x"])
    assert filter_audit.text_masks(column).tolist() == [1, 1, 1 | 4, 1, 1]
