"""Language identification, vectors, conversations, licences and unigram tokens against brute force."""

from __future__ import annotations

import math
import random
import textwrap
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from compare import differences
from llm.fixtures import DOCUMENTS, corpus, frame

from liftwork.llm import ann_scan, chat_format, language_id, license_scan, quality_rules, queries, sentencepiece_unigram

SMALL, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = language_id.op1_language_id(spark, SMALL).join(docs, "doc_id").toPandas()
    rest = found[found.held_out & found.lang.notna() & (found.lang_pred != "und") & (found.text.str.split().str.len() >= 5)]
    assert len(rest) > 100
    assert (rest.lang == rest.lang_pred).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_language_odd_rows(spark):
    rows = [(1, "the cat and the dog sat there", "en"), (2, "der Hund und die Katze saßen dort", "de"), (3, None, "en"), (4, "12 34 !", "de"), (5, "", None), (6, "und die Katze " * 30_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    assert [got[k].lang_pred for k in range(1, 7)] == ["en", "de", "und", "und", "und", "de"]
    assert got[3].score == got[4].score == 0.0
    none = language_id.learn(docs.where("doc_id = 3"))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("n", [2, 4, 7, 30])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len({tuple(c) for c in code}) == n


def test_language_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en", 1, 2, "x"), (1, "the cat and the dog", "en", 1, 2, "x"), (2, "der Hund und die Katze", "de", 1, 2, "y")], "doc_id long, text string, lang string, _body int, _letters int, score string")
    got = language_id.predict(docs, language_id.learn(docs)).collect()
    assert sorted((r.doc_id, r.lang_pred, r["_body"], r["_letters"]) for r in got) == [(1, "en", 1, 2), (1, "en", 1, 2), (2, "de", 1, 2)]


def model_of(counts: dict[str, np.ndarray]) -> language_id.Model:
    """The model of n-gram counts, from the whole table of rates."""
    languages = sorted(counts)
    code = language_id.codewords(len(languages))
    rates = np.stack([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * language_id.BUCKETS) for x in languages])
    side = lambda some: rates[some].mean(axis=0) if some.any() else np.full(language_id.BUCKETS, 1 / language_id.BUCKETS)
    weights = np.stack([np.log(side(b > 0) / side(b == 0)) for b in code.T], axis=1).astype(np.float32)
    means = rates @ weights
    scale = np.abs(means).mean(axis=0) + 1e-9
    trust = np.clip((means * np.where(code > 0, 1, -1)).min(axis=0) / scale, 0.05, None)
    return language_id.Model(languages, code, weights, scale, trust / trust.sum())


@pytest.mark.parametrize(("languages", "batch", "parts"), [(1, 10_000, 3), (2, 10_000, 3), (4, 10_000, 3), (70, 10_000, 1), (70, 20, 1)])
def test_learned_weights_are_those_of_the_whole_table(spark, languages, batch, parts):
    """Among others with more languages in a batch, and in a task, than are added up together."""
    r = np.random.default_rng(languages)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz  "))
    rows = [(f"l{k % languages:02d}", "".join(r.choice(np.roll(letters, k % languages)[:20], 60))) for k in range(3 * languages)] + [("l00", None), (None, "abc"), ("none", "")]
    counts = {}
    for lang, text in rows:
        for found in language_id.grams(pa.array([text]))[1] if lang and text else ():
            counts[lang] = counts.get(lang, 0) + np.bincount(found, minlength=language_id.BUCKETS + 1)[: language_id.BUCKETS]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        want, got = model_of(counts), language_id.learn(spark.createDataFrame(rows, "lang string, text string").repartition(parts))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.languages == want.languages and (got.code == want.code).all()
    for name in ("weights", "scale", "trust"):
        assert np.allclose(getattr(got, name), getattr(want, name), rtol=1e-4, atol=1e-6), name
    docs = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows) if lang and text], "doc_id long, lang string, text string")
    right = [p.lang_pred == p.lang for p in language_id.predict(docs, got).collect()]
    assert np.mean(right) > (0.95 if languages <= 4 else 0.5)


def test_a_thousand_languages_and_more_have_codewords():
    code = language_id.codewords(1500)
    assert language_id._least_distance(code) == min(int((code[i] != code[i + 1 :]).sum(axis=1).min()) for i in range(len(code) - 1)) > 0


def test_language_grams_and_decoding_by_hand():
    fold = lambda t: " ".join("".join(chr(b) if b >= 128 or chr(b).isalpha() else " " for b in t.encode()).lower().split(" ")) if t else ""
    texts = ["Ab, ab! x", "é é", "", "a1b22c"]
    ends, orders = language_id.grams(pa.array(texts))
    for row, text in enumerate(texts):
        folded = bytearray()
        for b in text.encode():
            c = b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32
            if not (c == 32 and folded and folded[-1] == 32):
                folded.append(c)
        assert ends[row + 1] - ends[row] == len(folded)
        for k, found in zip(language_id.ORDERS, orders, strict=True):
            mine = found[ends[row] : ends[row + 1]]
            whole = [bytes(folded[i : i + k]) for i in range(len(folded) - k + 1)]
            assert (mine < language_id.BUCKETS).sum() == len(whole)
            of = {}
            assert all(of.setdefault(g, b) == b for g, b in zip(whole, mine.tolist(), strict=False))
    counts = {x: np.zeros(language_id.BUCKETS, np.int64) for x in ("p", "q", "r")}  # of the model's languages, in this order
    for i, x in enumerate(counts):
        counts[x][i * 10 : i * 10 + 10] = 100
    model = model_of(counts)
    margins = np.stack([model.weights[[i * 10, i * 10 + 3]].sum(axis=0) for i in range(3)])
    best, score, ambiguous = model.decode(margins, np.full(3, 2))
    sign = np.where(model.code > 0, 1.0, -1.0)
    for row in range(3):  # the loss of every codeword, one by one
        loss = [sum(w * math.log1p(math.exp(-3 * s * m / 2 / c)) for w, s, m, c in zip(model.trust, sign[j], margins[row], model.scale, strict=True)) for j in range(3)]
        assert best[row] == int(np.argmin(loss)) == row
        near = np.exp(-6 * np.array(loss))
        assert math.isclose(score[row], near.max() / near.sum(), rel_tol=1e-6)
    assert not ambiguous.any()
    _, _, torn = model.decode(margins[:2].mean(axis=0)[None], np.array([2]))
    assert torn.all()


def vectors(n: int = 1500) -> list[tuple]:
    r = np.random.default_rng(5)
    centres = r.standard_normal((20, 24))
    rows = [(i, (centres[i % 20] + 0.6 * r.standard_normal(24)).astype("float32").tolist()) for i in range(n)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [1.0] * 23 + [float("inf")], [None] + [1.0] * 23, [1.0] * 5]
    rows += [(n + 100 * k, v) for k, v in enumerate(odd)] + [(None, rows[3][1])]
    return rows + [(5000 + k, rows[100][1]) for k in range(40)]  # many ties


def test_neighbours_against_all_distances(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as list", "2 as block", "3 as id").repartition(4)
    got = ann_scan.search(table, table.where("vec_id % 100 = 0")).collect()
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v)]
    hits = asked = 0
    for q, x in good:
        if q % 100:
            continue
        want = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q)[:10]
        mine = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        exact = {i: d for d, i in ((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good)}
        assert all(math.isclose(s, exact[i], rel_tol=1e-12) for _, s, i in mine)
        hits += len({m[2] for m in mine} & {i for _, i in want})
        asked += 10
    assert hits / asked >= 0.9
    assert {r.query_id for r in got} == {i for i, _ in good if i % 100 == 0}


def test_recall_on_the_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    got = {}
    for r in ann_scan.op8_ann_scan(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, mine in got.items():
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        hits += len(mine & set(ids[np.lexsort((ids, far))[:10]].tolist()))
    assert len(got) == (ids % 100 == 0).sum()
    assert hits / (10 * len(got)) >= 0.9


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann_scan.search(table, table.where("vec_id % 100 = 0")).collect()] == [(0, 1, 1, 1.0)]
    assert ann_scan.search(table.limit(0), table).count() == 0


def least_cost(roles: list[int | None]) -> int:
    """Over all legal sequences: a turn is a merge into the last role or a new one, perhaps after an empty turn."""
    best = 1 << 30
    for labels in product((1, 2, 3), repeat=len(roles)):
        ways = {0: 0}
        for label, role in zip(labels, roles, strict=True):
            cost = 0 if label == role else chat_format.RELABEL
            after = {}
            for state, so_far in ways.items():
                options = [0] if label in chat_format.LEGAL[state] else []
                options += [chat_format.MERGE] if label == state else []
                options += [chat_format.INSERT for via in chat_format.LEGAL[state] if label in chat_format.LEGAL[via]]
                if options:
                    after[label] = min(after.get(label, 1 << 30), so_far + cost + min(options))
            ways = after
        best = min([best, *ways.values()])
    return best


def test_repairs_are_the_cheapest():
    for n in range(1, 6):
        for roles in product((None, 1, 2, 3), repeat=n):
            steps = chat_format.repair(list(roles))
            assert sum(s[2] for s in steps) == least_cost(list(roles))


def test_cuts_do_not_matter():
    """Parts, repaired by the costs behind them and the states that earlier parts lead to, give the repair of the whole."""
    for n in range(2, 6):
        for roles in product((None, 1, 2, 3), repeat=n):
            whole = chat_format.repair(list(roles))
            for cuts in ([c] for c in range(1, n)) if n < 5 else ([1, 2], [2, 4], [1, 3, 4], [3]):
                parts = [list(roles[a:b]) for a, b in zip([0, *cuts], [*cuts, n], strict=True)]
                behind = [chat_format.END]
                for part in reversed(parts[1:]):
                    behind.insert(0, chat_format.behind(chat_format.matrix(part), behind[0]))
                state, out = chat_format.START, []
                for part, to_go in zip(parts, behind, strict=True):
                    out += chat_format.repair(part, state, to_go)
                    assert chat_format.ways(part, to_go)[state] == out[-1][1]
                    state = out[-1][1]
                assert out == whole


def test_repairs_hang_on_no_partitioning(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PART", 4)
    r = random.Random(6)
    names = ["user", "assistant", "system", "User ", None, "tool"]
    rows = [(c, t, r.choice(names), r.choice(["hi", "", None, f"t{t}"])) for c in (1, 2, None, *range(5, 20)) for t in range(90 if c == 1 else r.randint(1, 30))]
    rows += [(7, 3, "user", "twice")] * 40
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    order = lambda c: sorted((x for x in rows if x[0] == c), key=lambda x: (x[1], code(x[2]) or 0, x[3] or ""))
    code = lambda name: chat_format.ROLES.get((name or "").strip().lower())
    want = set()
    for c in {x[0] for x in rows}:
        conv = order(c)
        steps = chat_format.repair([code(x[2]) for x in conv])
        for at in range(0, len(conv), 4):
            some, own = steps[at : at + 4], conv[at : at + 4]
            actions = [s[3] for s in some]
            relabelled = sum(s[1] != code(x[2]) for s, x in zip(some, own, strict=True))
            want.add((c, at // 4, sum(s[2] for s in some), len(own), actions.count("merge"), relabelled, actions.count("insert"), chat_format.render(some, [x[3] or "" for x in own])))
    for partitions, adaptive in ((1, "true"), (8, "false"), (64, "true")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            found = chat_format.formatted(turns.repartition(3 if partitions == 1 else 7)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert len(found) == len(want) and {tuple(x) for x in found} == want


def test_long_conversations_in_parts(spark, monkeypatch):
    r = random.Random(2)
    names = ["user", "assistant", "system", "User ", None, "tool"]
    rows = [(c, t, r.choice(names), r.choice(["hi", "", None, f"t{t}"])) for c in (1, 2, None) for t in range(300)] + [(3, None, "user", "x"), (3, 1, "assistant", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    whole = {c: (cost, n) for c, cost, n in turns_cost(chat_format.formatted(turns).collect())}
    monkeypatch.setattr(chat_format, "PART", 16)
    parts = chat_format.formatted(turns).collect()
    assert {c: (cost, n) for c, cost, n in turns_cost(parts)} == whole
    for c in (1, 2, None):
        text = "".join(p.rendered for p in sorted((p for p in parts if p.conv_id == c), key=lambda p: p.part))
        marks = [line[2:-2] for line in text.split("\n") if line in ("<|user|>", "<|assistant|>", "<|system|>")]
        assert all(a != b for a, b in zip(marks, marks[1:])) and "system" not in marks[1:]
    assert chat_format.formatted(turns.limit(0)).count() == 0


def test_turns_without_numbers(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PART", 8)
    rows = [(1, None, "user", "same", 7)] * 100 + [(1, 5, "assistant", f"t{k % 9}", 7) for k in range(60)] + [(None, None, None, None, 7)] * 30
    parts = chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int").repartition(5)).collect()
    assert max(p.n_turns for p in parts) <= 8
    assert sum(p.n_turns for p in parts if p.conv_id == 1) == 160 and sum(p.n_turns for p in parts if p.conv_id is None) == 30
    text = "".join(p.rendered for p in sorted((p for p in parts if p.conv_id == 1), key=lambda p: p.part))
    # every turn but the first of a role is merged: the cheapest repair
    assert text == "<|user|>\n" + "\n".join(["same"] * 100) + "<|end|>\n<|assistant|>\n" + "\n".join(sorted(f"t{k % 9}" for k in range(60)))
    assert sum(p.cost for p in parts if p.conv_id == 1) == 99 + 59


def turns_cost(parts) -> list[tuple]:
    convs = {p.conv_id for p in parts}
    return [(c, sum(p.cost for p in parts if p.conv_id == c), sum(p.n_turns for p in parts if p.conv_id == c)) for c in convs]


def test_licences_equal_their_sql(spark):
    assert differences(spark, SMALL, license_scan.op3_license_scan, license_scan.ORACLE_SQL) == ""


def test_licences_that_wrap_over_lines(spark):
    wrap = lambda t, mark="", width=70: "\n".join(mark + line for line in textwrap.wrap(t, width))
    of = lambda name, k=-1: [t for n, t in license_scan.WHOLE if n == name][k]
    code = "\n".join(f"x{k} = call_{k}(y{k}, z{k % 7})" for k in range(200))
    gnu = lambda v: f"This program is free software{':;'[v == 2]} you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation{',;'[v == 2]} either version {v} of the License, or\n(at your option) any later version."
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."
    bsd = "Copyright (c) 2020, A Name\nAll rights reserved.\n\n"
    texts = {
        "GPL-3.0": [gnu(3), "# " + gnu(3).replace("\n", "\n# ") + f"\n#\n# See the file.\n\n{code}"],
        "GPL-2.0": [gnu(2), "/*\n * " + gnu(2).replace("\n", "\n * ") + f"\n */\n{code}"],
        "MPL-2.0": [mpl, "/* " + mpl.replace("\n", "\n * ") + f" */\n{code}"],
        "MIT": ["// SPDX-License-Identifier: MIT\n" + code, "Copyright (c) 2021 A Name\n\n" + wrap(of("MIT")), f"Text.\nReleased under the\nMIT License.\n\n{code}"],
        "BSD-2-Clause": [bsd + wrap(of("BSD-2-Clause")), f"/*\n{bsd}{wrap(of('BSD-2-Clause'))}\n*/\n{code}", "# SPDX-License-Identifier: BSD-2-Clause"],
        "BSD-3-Clause": [bsd + wrap(of("BSD-3-Clause")), wrap(bsd + of("BSD-3-Clause"), "# ") + f"\n{code}"],
        "Apache-2.0": [wrap(of("Apache-2.0"), "// ") + f"\n\n{code}"],
        None: [code, f"A licence is a text that many\nauthors add to their copyright lines.\n{code}"],
    }
    rows = [(f"{name} {k}", f"d{name}{k}/x.py", t) for name, group in texts.items() for k, t in enumerate(group)]
    rows += [(f"none {k}", f"n{k}/x.py", f"plain words {k} and the version of a {w} file") for k, w in enumerate(["free", "public", "new", "red"] * 10)]
    got = {r.file: r.licence for r in license_scan.scan(spark.createDataFrame(rows, "file string, path string, text string")).collect()}
    assert {f: n for f, n in got.items() if n} == {f"{name} {k}": name for name, group in texts.items() if name for k in range(len(group))}


def test_licences_are_inherited_from_the_nearest_directory(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c.py", "code here"), (3, "a/d/COPYING", "Licensed under the Apache License, Version 2.0."),
        (4, "a/d/e/f.py", None), (5, "z.py", "print"), (6, None, "none"), (7, "a/d/own.py", "x. Released under the ISC License.\nlong code that goes on and on and on and on and on"),
    ]
    files = spark.createDataFrame(rows, "file long, path string, text string")
    got = {r.file: (r.licence, r.origin, r.found_in) for r in license_scan.scan(files).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "own", None), 4: ("Apache-2.0", "inherited", "a/d"),
        5: (None, "none", None), 6: (None, "none", None), 7: ("ISC", "own", None),
    }
    assert license_scan.scan(files.limit(0)).count() == 0


def test_unigram_is_the_best_segmentation():
    r = random.Random(4)
    words = sorted({"".join(r.choice("ab é") for _ in range(r.randint(1, 4))).encode() for _ in range(40)} | {b"a", b" "})
    words = [w for w in words if b" " not in w[1:]]
    pieces = [(300 + k, w, -r.random() * 9) for k, w in enumerate(words)]
    model = sentencepiece_unigram.Unigram(pieces, {b: b for b in range(256)}, 300 + len(words))
    scores = {w: s for _, w, s in pieces}
    for _ in range(200):
        text = "".join(r.choice("ab c é中") for _ in range(r.randint(0, 12)))
        ids = model.encode(pa.array([text]))
        assert model.decode(ids).to_pylist() == [text]
        body = (" " + text) if text else ""
        best = [0.0] + [-math.inf] * len(body)
        for j in range(1, len(body) + 1):
            for i in range(max(0, j - 5), j):
                s = scores.get(body[i:j].encode(), model.fallback if j == i + 1 else None)
                if s is not None:
                    best[j] = max(best[j], best[i] + s)
        mine, k, flat = 0.0, 0, ids.to_pylist()[0]
        while k < len(flat):
            if flat[k] >= 300:
                mine, k = mine + model.score[flat[k]], k + 1
            else:
                lead = flat[k]
                mine, k = mine + model.fallback, k + (1 if lead < 128 else 2 if lead < 224 else 3)
        assert math.isclose(mine, best[-1], abs_tol=1e-9)


def test_unigram_round_trip(spark):
    docs = frame(spark, corpus() + [(99991, "▁ x\r\n\t ▁▁ 😀\u0000", None, None, 0), (99992, " lead and trail  ", None, None, 0), (99993, "a b " * 40_000, None, None, 0)])
    out = sentencepiece_unigram.decoded(sentencepiece_unigram.encoded(docs)).select("doc_id", "ids", "decoded").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.decoded == r.text and (r.ids is None) == (r.text is None) for r in out)


def test_long_texts_without_blanks(spark):
    r = random.Random(7)
    base64 = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(200_000))
    texts = [base64, "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(100_000)), "a" * 50_000]
    model = sentencepiece_unigram.Unigram.load(sentencepiece_unigram.VOCABULARY)
    ids = model.encode(pa.array(texts))
    assert model.decode(ids).to_pylist() == texts
    part = model.encode(pa.array([base64[:300]])).to_pylist()[0]
    assert part[:40] == ids.to_pylist()[0][:40]  # a cut changes nothing far from it


def test_quality_equals_its_sql(spark):
    assert differences(spark, SMALL, quality_rules.op6_quality_rules, quality_rules.ORACLE_SQL) == ""


def test_every_operator_has_a_query(spark):
    found = queries.queries()
    assert sorted(int(k[2:].split("_")[0]) for k in found) == list(range(1, 11))
    empty = spark.createDataFrame([], DOCUMENTS)
    assert sentencepiece_unigram.encoded(empty).count() == 0


def test_licences_of_rows_with_equal_names(spark):
    mit, isc = "SPDX-License-Identifier: MIT\ncode", "SPDX-License-Identifier: ISC\nother code"
    rows = [("5", "a/x.c", mit), ("5", "b/x.c", isc), ("6", "c/LICENSE.txt", "Released under the MIT License."), ("6", "d/plain.c", "nothing here"), (None, "e/n.c", "Released under the MIT License."), (None, None, None), ("7", "c/y.c", "x"), ("7", "c/y.c", "x")]
    got = license_scan.scan(spark.createDataFrame(rows, "file string, path string, text string")).collect()
    want = [("5", "a/x.c", "MIT", "own"), ("5", "b/x.c", "ISC", "own"), ("6", "c/LICENSE.txt", "MIT", "own"), ("6", "d/plain.c", None, "none"), (None, "e/n.c", "MIT", "own"), (None, None, None, "none"), ("7", "c/y.c", "MIT", "inherited"), ("7", "c/y.c", "MIT", "inherited")]
    assert sorted(((r.file, r.path, r.licence, r.origin) for r in got), key=repr) == sorted(want, key=repr)


WORDINGS = {
    license_scan._GNU_VERSION.format("Lesser General Public License", "2.1"): "LGPL-2.1",
    "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999": "LGPL-2.1",
    "Copyright (c) 2017 Some One. All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.": "EPL-2.0",
    "// Copyright 2014 The Chromium Authors. All rights reserved.\n// Use of this source code is governed by a BSD-style license that can be\n// found in the LICENSE file.": "BSD-3-Clause",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + license_scan._ISC_REST: "0BSD",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": "CC-BY-SA-3.0",
    "This project is licensed under the MIT License - see the LICENSE.md file": "MIT",
    license_scan._ZLIB: "Zlib",
    "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt or copy at\nhttp://www.boost.org/LICENSE_1_0.txt)": "BSL-1.0",
    "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": "Apache-2.0 OR MIT",
    "This work is licensed under the GNU General Public License, version 9.": None,
    "All rights reserved.": "Proprietary",
    "All rights reserved.\n\nReleased under the MIT License.": "MIT",
    "All rights reserved. See the license that came with it.": None,
    license_scan._ISC: "ISC",
}


def test_wordings_of_licences(spark):
    filler = [(f"f{k}", f"x/{k}.c", f"plain words number {k}") for k in range(30)]
    rows = [(str(k), f"d{k}/a.c", t) for k, t in enumerate(WORDINGS)]
    long = [("long", "l/a.c", "int x;\n" * 60_000 + "// Released under the MIT License.\n")]
    got = {r.file: r.licence for r in license_scan.scan(spark.createDataFrame(rows + filler + long, "file string, path string, text string")).collect()}
    assert {t: got[str(k)] for k, t in enumerate(WORDINGS)} == WORDINGS
    assert got["long"] == "MIT"


def test_licences_with_clashing_columns(spark):
    from pyspark.sql import functions as F

    files = spark.createDataFrame([("1", "a/b", "Released under the MIT License.")], "file string, path string, text string")
    for c in ("licence", "score", "mode", "part", "key", "_name", "salt", "spread"):
        files = files.withColumn(c, F.lit("x"))
    assert [(r.file, r.licence) for r in license_scan.scan(files).collect()] == [("1", "MIT")]
