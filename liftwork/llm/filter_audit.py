"""Filter interaction audit: what five filters remove in every order, and what each owes to the others.

A document fails a set of the filters, its mask. The mask counts of a part (a source) make the part's
removal polynomial, multilinear in one variable a filter: at a corner of the cube it is the number of
documents that the chosen filters remove together. Its coefficients are exact integers. Survivors of
every step of every order are differences of corner values; a filter's Shapley value is the integral of its
partial derivative along the diagonal, an exact rational, and times 120 the sum over all orders.

Masks are counted by Spark, a part having 32 counts at most, each for all, good and toxic documents; the
polynomials of a part are worked on in the task that has its counts. Copies are found by content address
(SHA-256): the least id of a text is compared with each document's own. Texts that occur once are not
joined, texts of very many copies are dealt over tasks; counts by id are made before labels are joined, so
an id that many rows repeat, or a null one, is one row for each mask.

Null text counts as empty; a null id is no smaller nor larger than another, so it fails by no copy and has
no labels. Rows that repeat an id are documents of their own, and do not fail for each other. A null source
is the part ''. Of several labels of an id any that says 1 counts. Texts of any length are looked at as a
whole. Other columns do not matter, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.components import Spread
from liftwork.llm.groups import batched, rows
from liftwork.llm.textbuf import per_row, slices, text_bytes, word_spans

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MIN_WORDS = 200
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*|")] = True
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Corners of the cube in the order of the masks.
CORNERS = 1 << len(FILTERS)
OUT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of a buffer of texts, as an Arrow array, and the row of each."""
    begin, end, row = word_spans(data, at)
    mark = np.zeros(len(data) + 1, np.int8)
    mark[begin] += 1
    mark[end] -= 1
    body = data[np.cumsum(mark[:-1]).astype(bool)]
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(body)]), row


def text_masks(column: pa.Array) -> np.ndarray:
    """Which of the filters A to D each text fails, as bits."""
    data, at = text_bytes(column)
    n = len(at) - 1
    words, row = words_of(data, at)
    count = np.bincount(row, minlength=n)
    codes = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs = np.unique(row.astype(np.int64) * (len(words) + 1) + codes)
    distinct = np.bincount(pairs // (len(words) + 1), minlength=n)
    points = per_row((data & 0xC0) != 0x80, at)
    fails = (count < MIN_WORDS, 100 * distinct < 50 * count, 100 * per_row(_UPPER[data], at) > 2 * points, per_row(_SIGNS[data], at) > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, blob, mask) of every row of (doc_id, source, text); mask without the copies, blob the digest of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    schema = given.drop("text").schema.add("mask", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(text_masks(batch.column("text")), pa.int32())], names=["doc_id", "part", "blob", "mask"])

    return given.mapInArrow(run, schema)


def with_copies(marked: DataFrame) -> DataFrame:
    """``marked`` with the bit of E set where a smaller id has the same text."""
    least = marked.groupBy("blob").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"), F.count(F.lit(1)).alias("_n"))
    least = staging.stored(least.where("_least < _most"), "audit-copies")
    spread = Spread(least, "blob", "_n")
    there = spread.copied(least.select("blob", "_least"), "blob")
    dealt = spread.dealt(marked, "blob", F.struct("doc_id", "part")).drop("spread")
    fails = F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))
    return dealt.join(there, ["blob", "salt"], "left").select("doc_id", "part", F.col("mask").bitwiseOR(F.when(fails, COPY).otherwise(0)).alias("mask"))


def mask_counts(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, masks): for each part the list of (mask, n, good, toxic), 32 at most."""
    counted = marked.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("bad"))
    joined = counted.join(known, "doc_id", "left")
    total = lambda c: F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0))
    sums = joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), total("good").alias("good"), total("bad").alias("toxic"))
    return sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))


def removal_polynomial(counts: list[int]) -> list[int]:
    """Coefficients, by set of variables, of the polynomial of a part with ``counts`` documents for each mask.

    A document of mask m is removed by 1 - prod(1 - x_i for i in m); the coefficient of a set S other than the
    empty one is the count of all masks that hold S, negative for sets of even size.
    """
    holds = list(counts)
    for bit in range(len(FILTERS)):
        for s in range(CORNERS):
            if not s >> bit & 1:
                holds[s] += holds[s | 1 << bit]
    return [0] + [holds[s] if s.bit_count() % 2 else -holds[s] for s in range(1, CORNERS)]


def at_corners(polynomial: list[int]) -> list[int]:
    """The value at every corner of the cube: the sum of the coefficients of all sets within."""
    value = list(polynomial)
    for bit in range(len(FILTERS)):
        for s in range(CORNERS):
            if s >> bit & 1:
                value[s] += value[s ^ 1 << bit]
    return value


def shapley(polynomial: list[int]) -> list[Fraction]:
    """The integral over the diagonal of each partial derivative: a set's coefficient gives t ** (size - 1), so 1 / size of it."""
    return [sum((Fraction(c, s.bit_count()) for s, c in enumerate(polynomial) if s >> k & 1), Fraction(0)) for k in range(len(FILTERS))]


def audit(masks: list[tuple[int, int, int, int]]) -> Iterator[tuple]:
    """(filter_order, step, *OUT) of every step of every order."""
    counts = [[0] * CORNERS for _ in range(3)]
    for mask, *numbers in masks:
        for k, n in enumerate(numbers):
            counts[k][mask] += n
    total = sum(counts[0])
    polynomials = [removal_polynomial(c) for c in counts]
    removed, good, toxic = (at_corners(p) for p in polynomials)
    owed = [v * len(ORDERS) for v in shapley(polynomials[0])]
    every = CORNERS - 1
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            k = FILTERS.index(letter)
            after = before | 1 << k
            here = removed[after] - removed[before]
            unique = removed[every] - removed[every ^ 1 << k]
            yield order, step, total - removed[after], here, removed[1 << k] - here, unique, good[after] - good[before], toxic[after] - toxic[before], int(owed[k])
            before = after


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, *OUT) of every part of ``docs``."""
    marked = staging.stored(masked(docs), "audit-masks")
    counts = mask_counts(with_copies(marked), labels)
    out = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in OUT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((part, *row) for part, masks in rows(batches) for row in audit([(m["mask"], m["n"], m["good"], m["toxic"]) for m in masks]))
        yield from batched(found, out)

    return counts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in OUT))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(staging.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


_FIVE = ", ".join(f"('{f}')" for f in FILTERS)
ORACLE_SQL = f"""
with docs as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
known as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as bad from labels group by doc_id),
fails as (select d.doc_id, part, coalesce(good, 0) as good, coalesce(bad, 0) as bad, len(w) < {MIN_WORDS} as a, 100 * len(list_distinct(w)) < 50 * len(w) as b,
  100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) as c, regexp_matches(text, '[#$%&*|]') as d, coalesce(d.doc_id > min(d.doc_id) over (partition by text), false) as e
  from docs d left join known k on d.doc_id = k.doc_id),
failed as (select part, good, bad, a, b, c, d, e, (case when a then 'A' else '' end) || (case when b then 'B' else '' end) || (case when c then 'C' else '' end) || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as f from fails),
masks as (select part, f, count(*) as n, sum(good) as good, sum(bad) as bad from failed group by part, f),
letters(x) as (values {_FIVE}),
orders as (select p.x || q.x || r.x || s.x || t.x as o from letters p, letters q, letters r, letters s, letters t where p.x <> q.x and p.x <> r.x and p.x <> s.x and p.x <> t.x and q.x <> r.x and q.x <> s.x and q.x <> t.x and r.x <> s.x and r.x <> t.x and s.x <> t.x),
steps as (select o, step::int as step, o[step] as x, o[1:step - 1] as earlier from orders, unnest([1, 2, 3, 4, 5]) as u(step)),
judged as (select part, o, step, x, n, good, bad, contains(f, x) as here, f = x as alone,
  earlier <> '' and regexp_matches(f, '[' || earlier || 'z]') as gone from masks, steps),
found as (select part, o as filter_order, step, x, coalesce(sum(n) filter (where not here and not gone), 0)::bigint as kept, coalesce(sum(n) filter (where here and not gone), 0)::bigint as removed,
  coalesce(sum(n) filter (where here and gone), 0)::bigint as redundant, coalesce(sum(n) filter (where alone), 0)::bigint as unique_fails,
  coalesce(sum(good) filter (where here and not gone), 0)::bigint as good_lost, coalesce(sum(bad) filter (where here and not gone), 0)::bigint as toxic_lost from judged group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, x))::bigint as shapley from found
"""
