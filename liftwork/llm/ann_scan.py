"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are rotated by a random orthogonal matrix and dealt to inverted lists around centroids. The
centroids, the rotation and the number of lists to probe are fitted on a bounded sample (``SAMPLE``
vectors); every row is indexed. ``HELD`` vectors of the sample, searched in the rest of it, tell how many of
their nearest lists hold a share of ``TARGET`` of their true neighbours: so many are probed.

A list is kept in blocks of about ``BLOCK`` rows, so that a list with very many rows (a common vector)
is spread over tasks, and the queries that ask a list come in portions of about ``ASKS``. A query first
scans the nearest of its lists; the distance of the ``k``-th best found there bounds the scan of the
others. Within a block the rotated vectors are read in column blocks: after each, candidates whose scaled
partial distance fails a hypothesis test against the bound (or that of the block's own first candidates,
where it is less) are abandoned, the rest go on. Survivors get exact distances on the original vectors in
double precision, and a query's answers of all blocks are merged.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part, as queries or as candidates; nor do rows with a null id. Rows with equal ids are candidates
for all other queries, and count once where their distance is the same. Ties go to the smaller id. With
fewer candidates than ``k`` all of those found are returned; an empty table gives an empty result. Other
columns of the tables do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.groups import tables

SAMPLE = 20_000
#: Vectors of the sample that tell how many lists to probe, and the share of their neighbours these must hold.
HELD, TARGET = 400, 0.97
#: One in this many of the probed lists is scanned first, without a bound from other lists.
FIRST = 6
BLOCK, ASKS = 2048, 512
LISTS = 2048
COLUMNS = 16
#: Pairs of query and candidate that are looked at together.
PAIRS = 1 << 18
#: Width of the hypothesis test: a partial distance over the first d of D coordinates is significant beyond (1 + EPSILON / sqrt(d)).
EPSILON = 2.1
SEED = 20240607


class Index:
    """Rotation, centroids (in rotated coordinates) and number of probes, fitted on a sample."""

    def __init__(self, sample: np.ndarray, rows: int, k: int):
        random = np.random.default_rng(SEED)
        self.size = sample.shape[1]
        self.rotation = np.linalg.qr(random.standard_normal((self.size, self.size)))[0]
        turned = sample @ self.rotation
        lists = max(1, min(int(rows**0.5), len(sample) // 8, LISTS))
        self.centroids = turned[random.choice(len(turned), lists, replace=False)] if len(turned) else np.zeros((1, self.size))
        for _ in range(8):
            own = self.nearest(turned, 1)[:, 0]
            sums, n = np.zeros_like(self.centroids), np.bincount(own, minlength=lists)
            np.add.at(sums, own, turned)
            self.centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], self.centroids)
        self.probes = self._enough(turned, random.permutation(len(turned))[:HELD], k)
        self.first = -(-self.probes // FIRST)

    def _enough(self, turned: np.ndarray, held: np.ndarray, k: int) -> int:
        """How many of their nearest lists hold TARGET of the neighbours of the vectors ``held``."""
        own, place = self.nearest(turned, 1)[:, 0], []
        square = (turned**2).sum(axis=1)
        for i in held:
            far = square - 2 * turned @ turned[i]
            far[i] = np.inf
            near = np.argsort(far, kind="stable")[: min(k, len(turned) - 1)]
            order = np.empty(len(self.centroids), np.int64)
            order[self.nearest(turned[i : i + 1], len(self.centroids))[0]] = np.arange(len(self.centroids))
            place.append(order[own[near]])
        ranks = np.sort(np.concatenate(place)) if place else np.zeros(0, np.int64)
        return int(ranks[int(np.ceil(TARGET * len(ranks))) - 1]) + 1 if len(ranks) else 1

    def nearest(self, turned: np.ndarray, count: int) -> np.ndarray:
        """The nearest lists of each vector, nearest first."""
        norms, out = (self.centroids**2).sum(axis=1), np.empty((len(turned), count), np.int64)
        for begin in range(0, len(turned), 1024):
            far = norms[None] - 2 * turned[begin : begin + 1024] @ self.centroids.T
            out[begin : begin + 1024] = far.argmin(axis=1)[:, None] if count == 1 else np.argsort(far, axis=1, kind="stable")[:, :count]
        return out


def scan_block(queries: np.ndarray, exact: np.ndarray, own: np.ndarray, bound: np.ndarray, turned: np.ndarray, originals: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, distance) of the ``k`` nearest of a block for each query, as positions, given bounds on the squared distances.

    ``queries`` and ``turned`` are rotated, ``exact`` and ``originals`` are not. Candidates whose id is the query's own are left out.
    """
    found, step = [], max(1, PAIRS // max(len(ids), 1))
    for begin in range(0, len(own), step):
        some = slice(begin, begin + step)
        found.append(_scan(queries[some], exact[some], own[some], bound[some], turned, originals, ids, k, begin))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _scan(queries, exact, own, bound, turned, originals, ids, k, shift):
    size = turned.shape[1]
    if len(ids) > 4 * k:  # a first bound from the first candidates; one of them may be the query itself
        head = ((originals[None, : 2 * k] - exact[:, None]) ** 2).sum(axis=2)
        head[own[:, None] == ids[None, : 2 * k]] = np.inf
        bound = np.minimum(bound, np.partition(head, k - 1, axis=1)[:, k - 1])
    end = min(COLUMNS, size)
    x, q = turned[:, :end], queries[:, :end]
    partial = np.maximum((q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None] - 2 * q @ x.T, 0)
    test = lambda d, e, b: d * (size / e) <= b * (1 + EPSILON / e**0.5) ** 2 + 1e-9 * (d + 1)
    asks, there = np.nonzero((test(partial, end, bound[:, None]) if end < size else np.ones(partial.shape, bool)) & (own[:, None] != ids[None]))
    partial = partial[asks, there]
    while end < size:
        begin, end = end, min(end + COLUMNS, size)
        partial += ((turned[there, begin:end] - queries[asks, begin:end]) ** 2).sum(axis=1)
        if end < size:
            stay = test(partial, end, bound[asks])
            asks, there, partial = asks[stay], there[stay], partial[stay]
    stay = partial <= bound[asks] * (1 + 1e-9) + 1e-9
    asks, there = asks[stay], there[stay]
    distance = np.sqrt(((originals[there] - exact[asks]) ** 2).sum(axis=1))
    order = np.lexsort((ids[there], distance, asks))
    asks, there, distance = asks[order], there[order], distance[order]
    begin = np.searchsorted(asks, np.arange(len(own)))
    top = np.arange(len(asks)) - begin[asks] < k
    return asks[top] + shift, there[top], distance[top]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part; vec keeps float components, others become doubles."""
    kind = "array<float>" if dict(table.dtypes)[vector] == "array<float>" else "array<double>"
    given = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("vec")).where("id is not null and vec is not null and size(vec) > 0")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return given.where(F.coalesce(fine, F.lit(False)))


_FOUND = "query_id long, vec_id long, score double"
_FOUND_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search(table: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``table`` found for each row of ``queries``."""
    spark = table.sparkSession
    rows = usable(table, key, vector)
    sizes = rows.groupBy(F.size("vec").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total = sizes[0]["size"], sizes[0]["n"]
    rows = rows.where(F.size("vec") == size)
    share = min(1.0, 2 * SAMPLE / total)
    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("vec").limit(SAMPLE)
    index = Index(_matrix(picked.toArrow().column("vec").combine_chunks(), size), total, k)
    shared = spark.sparkContext.broadcast(index)  # at most LISTS centroids
    vec = dict(rows.dtypes)["vec"]

    def near(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = shared.value.nearest(_matrix(batch.column("vec"), size) @ shared.value.rotation, count)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * count)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(lists.ravel(), pa.int32()))], names=["id", "vec", "lists"])

    listed = lambda d, count: d.mapInArrow(lambda batches: near(batches, count), f"id long, vec {vec}, lists array<int>")
    indexed = staging.stored(listed(rows, 1).select("id", "vec", F.col("lists")[0].alias("list")), "ann-lists")
    asked = staging.stored(listed(usable(queries, key, vector).where(F.size("vec") == size), index.probes).select("id", F.col("vec").cast(vec).alias("vec"), "lists"), "ann-queries")
    blocks = staging.stored(indexed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "ann-blocks")
    first = F.explode(F.slice("lists", 1, index.first)).alias("list")
    found = staging.stored(_scanned(indexed, asked.select("id", "vec", first, F.lit(float("inf")).alias("bound")), blocks, shared, size, k), "ann-first")
    if index.first < index.probes:
        best = _ranked(found, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("far"))
        bound = F.when(F.col("n") == k, F.col("far") * F.col("far") * (1 + 1e-12))
        bounded = asked.join(best.select(F.col("query_id").alias("id"), bound.alias("bound")), "id", "left")
        rest = F.explode(F.slice("lists", index.first + 1, index.probes)).alias("list")
        found = found.unionByName(_scanned(indexed, bounded.select("id", "vec", rest, F.coalesce("bound", F.lit(float("inf"))).alias("bound")), blocks, shared, size, k))
    return _ranked(found.distinct(), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query, with rank."""
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _scanned(indexed: DataFrame, asked: DataFrame, blocks: DataFrame, shared, size: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best of every block of the lists that the rows (id, vec, list, bound) ask."""
    portions = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ASKS).cast("int").alias("portions"))
    lists = F.broadcast(blocks.join(portions, "list"))  # a row a list
    whole = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    there = indexed.join(lists, "list").select("list", part("blocks").alias("block"), whole("portions").alias("portion"), F.lit(False).alias("asks"), "id", "vec", F.lit(None).cast("double").alias("bound"))
    asking = asked.join(lists, "list").select("list", whole("blocks").alias("block"), part("portions").alias("portion"), F.lit(True).alias("asks"), "id", "vec", "bound")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in tables(batches, 3):
            asks = group.column("asks").to_numpy()
            vectors, ids = _matrix(group.column("vec").combine_chunks(), size), group.column("id").to_numpy()
            if asks.all() or not asks.any():
                continue
            turned = vectors @ shared.value.rotation
            bound = group.column("bound").to_numpy()[asks].astype(np.float64)
            q, c, far = scan_block(turned[asks], vectors[asks], ids[asks], bound, turned[~asks], vectors[~asks], ids[~asks], k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[asks][q]), pa.array(ids[~asks][c]), pa.array(far)], schema=_FOUND_SCHEMA)

    keys = ("list", "block", "portion")
    return there.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _FOUND)


def op8_ann_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(table, table.where("vec_id % 100 = 0"))
