"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over hashed byte n-grams tells the
languages with a one from those with a zero: its weight for an n-gram is the log ratio of the mean
n-gram rates of the two sides, so that no language outweighs another by its number of documents. The
n-gram counts cover all labelled documents of the learning side; they stay in Spark, which adds up the rates of both
sides of every bit, by n-gram, and then the margins of every language.

A text is decoded to the language whose codeword has the least loss, summed over the bits with a
weight that grows with how well the bit separates the training counts. ``ambiguous`` marks texts
whose runner-up is nearly as close, or some of whose bits contradict the codeword.

Texts that are null or have no letter are ``und`` with score 0, as is every text if nothing was
learned. Rows with a null language are not learned from. Repeated rows count as often as they occur. Ties go
to the language first by name. A text of any length is folded as a whole, some 100 bytes of arrays for each
of its bytes. Other columns are kept, whatever their names. An empty table gives an empty result.

There is no limit on languages. Of each the driver has its name, total and codeword, of each n-gram the weights of all bits,
whose number grows with the logarithm of that of the languages; a task has these and the counts of ``TOGETHER`` languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.textbuf import LOWER, mix, per_row, slices, text_bytes

BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
#: Languages whose counts a task adds up before it hands them on.
TOGETHER = 64
#: Bits whose margins are added up together, and pairs of text and language whose losses are.
BITS, LOSSES = 8, 1 << 21
#: Margin between the two nearest codewords, as a share of the score, under which a text is ambiguous.
AMBIGUOUS = 0.2
#: More languages than this get sampled rather than exhaustive codes.
EXHAUSTIVE = 5

#: ASCII letters and all bytes of other characters stay, everything else is a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = _FOLD[LOWER[ord("A") : ord("Z") + 1]]


def codewords(n: int) -> np.ndarray:
    """n x bits matrix of 0 and 1: all splits of few languages, else a code with the best least distance of several."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE:
        rest = [c for k in range(n - 1) for c in combinations(range(1, n), k)]
        return np.array([[1 if i == 0 or i in c else 0 for c in rest] for i in range(n)], np.int8)
    bits, best = int(np.ceil(10 * np.log2(n))), None
    for seed in range(int(np.clip(10**10 // (n * n), 1, 200))):
        code = np.random.default_rng(seed).integers(0, 2, (n, bits)).astype(np.int8)
        if ((code.sum(axis=0) == 0) | (code.sum(axis=0) == n)).any() or len(np.unique(code, axis=0)) < n:
            continue
        least = _least_distance(code)
        if best is None or least > best[0]:
            best = (least, code)
    return best[1]


def _least_distance(code: np.ndarray) -> int:
    """The least number of bits in which two codewords differ."""
    signs, most = code.astype(np.float32) * 2 - 1, -code.shape[1]
    for begin in range(0, len(signs), 1024):
        alike = signs[begin : begin + 1024] @ signs.T
        rows = np.arange(len(alike))
        alike[rows, begin + rows] = -code.shape[1]
        most = max(most, int(alike.max()))
    return (code.shape[1] - most) // 2


def grams(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row offsets of the folded bytes and, for each order, the bucket of the n-gram at every byte.

    BUCKETS itself stands for no n-gram: those that would reach into the next row.
    """
    data, at = text_bytes(column)
    folded = _FOLD[data]
    stay = np.ones(len(folded), bool)
    stay[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    edges = at[:-1][at[:-1] < len(data)]
    stay[edges] = True
    ends = np.concatenate([[0], np.cumsum(per_row(stay, at))])
    folded = folded[stay].astype(np.uint64)
    out, value = [], np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        for k in ORDERS:
            n = len(folded) - k + 1
            if n <= 0:
                out.append(np.full(len(folded), BUCKETS, np.int64))
                continue
            value = folded if k == 1 else value[:n] * np.uint64(256) + folded[k - 1 :]
            bucket = np.full(len(folded), BUCKETS, np.int64)
            bucket[:n] = (mix(value * np.uint64(8) + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int64)
            for step in range(1, k):  # n-grams that would reach into the next row
                tails = ends[1:] - step
                bucket[tails[tails >= ends[:-1]]] = BUCKETS
            out.append(bucket)
    return ends, out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def rows(names, of, bucket, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names[of], pa.string()), pa.array(bucket, pa.int32()), pa.array(n, pa.int64())], names=["lang", "bucket", "n"])

    def flushed() -> Iterator[pa.RecordBatch]:
        for name, row in sums.items():
            some = np.flatnonzero(row)
            yield rows(np.array([name], object), np.zeros(len(some), int), some, row[some])
        sums.clear()

    for batch in slices(batches, "text", 1 << 20):
        ends, orders = grams(batch.column("text"))
        names, code = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        names, of = names.astype(object), np.repeat(code, np.diff(ends))
        for found in orders:
            key = of * (BUCKETS + 1) + found
            if len(names) > TOGETHER:
                some, n = np.unique(key[found < BUCKETS], return_counts=True)
                yield rows(names, some // (BUCKETS + 1), some % (BUCKETS + 1), n)
                continue
            each = np.bincount(key, minlength=len(names) * (BUCKETS + 1)).reshape(len(names), BUCKETS + 1)
            for name, row in zip(names, each[:, :BUCKETS], strict=True):
                sums[name] = sums.get(name, 0) + row
        if len(sums) > TOGETHER:
            yield from flushed()
    yield from flushed()


class Model:
    """Languages, their codewords, the weights of each bit's n-grams, and the scale and the weights of the bits."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, scale: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.scale, self.trust = languages, code, scale, trust
        self.weights = np.concatenate([weights, np.zeros_like(weights[:1])]).astype(np.float32)  # the last for no n-gram

    def decode(self, margins: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, score and ambiguity of rows with summed margins over n n-grams."""
        step = max(1, LOSSES // len(self.code))
        parts = [self._nearest(margins[i : i + step], n[i : i + step]) for i in range(0, max(len(n), 1), step)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _nearest(self, margins: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mean = margins / np.maximum(n, 1)[:, None] / self.scale
        x, code = np.clip(mean * 3, -50, 50), self.code.astype(np.float64)
        loss = (np.log1p(np.exp(-x)) * self.trust) @ code.T + (np.log1p(np.exp(x)) * self.trust) @ (1 - code).T
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(loss))
        near = np.exp(-loss * 6)
        score = near[rows, order[:, 0]] / near.sum(axis=1)
        second = near[rows, order[:, 1]] / near.sum(axis=1) if loss.shape[1] > 1 else np.zeros(len(loss))
        sign = self.code[order[:, 0]].astype(np.float64) * 2 - 1
        against = ((mean * sign < 0) * self.trust).sum(axis=1)
        return order[:, 0], score, (score - second < AMBIGUOUS) | (against > 0.25)


def learn(labelled: DataFrame) -> Model:
    """A model from rows (text, lang). A rate is (count + 1/2) / (total + BUCKETS / 2); a weight the log ratio of the two sides' mean rates."""
    spark = labelled.sparkSession
    given = labelled.where("lang is not null and text is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = staging.stored(given.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    totals = sorted((r["lang"], r["n"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect())  # a row a language
    if not totals:
        return Model([], np.ones((1, 1), np.int8), np.zeros((BUCKETS, 1)), np.ones(1), np.ones(1))
    languages = [name for name, _ in totals]
    size = np.array([n for _, n in totals]) + 0.5 * BUCKETS
    code = codewords(len(languages))
    shared = spark.sparkContext.broadcast(({name: i for i, name in enumerate(languages)}, size, code.astype(np.float64)))  # a row a language
    index = lambda batch: np.array([shared.value[0][x] for x in batch.column("lang").to_pylist()])

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, size, code = shared.value
        for batch in batches:
            of, bucket = index(batch), batch.column("bucket").to_numpy()
            rate = batch.column("n").to_numpy() / size[of]
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            for begin in range(0, len(first), 256):
                starts = first[begin : begin + 256]
                here = slice(starts[0], first[begin + 256] if begin + 256 < len(first) else len(bucket))
                one = np.add.reduceat(code[of[here]] * rate[here, None], starts - starts[0], axis=0)
                both = np.add.reduceat(rate[here], starts - starts[0])
                offsets = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * code.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.ListArray.from_arrays(offsets, pa.array(one.ravel())), pa.array(both)], names=["bucket", "one", "both"])

    by_bucket = counts.repartition("bucket").sortWithinPartitions("bucket", "lang").mapInArrow(sides, "bucket int, one array<double>, both double")
    found = by_bucket.toArrow()  # BUCKETS rows, a few more where a batch ends within one
    bits, bucket = code.shape[1], found.column("bucket").to_numpy()
    one, both = np.zeros((BUCKETS, bits)), np.zeros(BUCKETS)
    np.add.at(one, bucket, found.column("one").combine_chunks().flatten().to_numpy().reshape(-1, bits))
    np.add.at(both, bucket, found.column("both").to_numpy())
    ones, rest = code.sum(axis=0, dtype=np.int64), 0.5 / size
    with np.errstate(divide="ignore", invalid="ignore"):
        mean_one = (one + rest @ code) / ones
        mean_zero = (both[:, None] - one + rest @ (1 - code)) / (len(languages) - ones)
    weights = np.log(np.where(ones > 0, mean_one, 1 / BUCKETS)) - np.log(np.where(ones < len(languages), mean_zero, 1 / BUCKETS))
    weights = weights.astype(np.float32)
    weighing = spark.sparkContext.broadcast(weights)  # BUCKETS x bits

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, size, code = shared.value
        weights, sums = weighing.value.astype(np.float64), {}
        for batch in batches:
            of, bucket, n = index(batch), batch.column("bucket").to_numpy(), batch.column("n").to_numpy()
            first = np.flatnonzero(np.diff(of, prepend=-1))
            for at, upto in zip(first, [*first[1:], len(of)], strict=True):
                sums[of[at]] = sums.get(of[at], 0) + n[at:upto] @ weights[bucket[at:upto]]
        if sums:
            of = np.array(list(sums))
            means = (np.stack(list(sums.values())) + 0.5 * weights.sum(axis=0)) / size[of, None]
            yield pa.RecordBatch.from_pydict({"total": [np.abs(means).sum(axis=0).tolist()], "least": [(means * (code[of] * 2 - 1)).min(axis=0).tolist()]})

    by_language = counts.repartition("lang").sortWithinPartitions("lang", "bucket").mapInArrow(margins, "total array<double>, least array<double>").collect()  # a row a task
    scale = np.sum([r["total"] for r in by_language], axis=0) / len(languages) + 1e-9
    trust = np.clip(np.min([r["least"] for r in by_language], axis=0) / scale, 0.05, None)
    return Model(languages, code, weights, scale, trust / trust.sum())


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with lang_pred, score and ambiguous."""
    made = ("lang_pred", "score", "ambiguous")
    names = [c for c in docs.columns if c != text and c not in made]
    body, letters = staging.unused(docs.columns, "body"), staging.unused(docs.columns, "letters")
    given = docs.select(*names, F.col(text).cast("string").alias(body), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(letters))
    schema = docs.select(*names).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x bits floats, a codeword a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        languages = np.array([*own.languages, UNKNOWN], object)
        for batch in slices(batches, body, 1 << 19):
            ends, orders = grams(batch.column(body))
            size = np.diff(ends)
            some = size > 0
            margins, n = np.zeros((batch.num_rows, own.weights.shape[1])), np.zeros(batch.num_rows)
            for found in orders if some.any() else ():
                for bit in range(0, margins.shape[1], BITS):
                    margins[some, bit : bit + BITS] += np.add.reduceat(own.weights[:, bit : bit + BITS][found], ends[:-1][some], axis=0)
                n[some] += np.add.reduceat(found < BUCKETS, ends[:-1][some], dtype=np.int64)
            best, score, ambiguous = own.decode(margins, n) if own.languages else (np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), np.ones(batch.num_rows, bool))
            known = batch.column(letters).to_numpy(zero_copy_only=False) & bool(own.languages)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(languages[np.where(known, best, -1)], pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(ambiguous & known)],
                names=[*names, *made],
            )

    return given.mapInArrow(run, schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = staging.documents(spark, sf_dir)
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out")
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text", "lang")
    model = learn(rows.where("not held_out").select("text", "lang"))
    return predict(rows.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
