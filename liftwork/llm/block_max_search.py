"""Ranked lexical search with block-max pruning.

The forward index holds documents in blocks, with the counts of those terms that the items ask for. A block is at
most ``BLOCK`` documents of a range of about ``RANGE`` bytes as they are read; documents of a range that have most of the
same term, and are about as long, stand together, so that a block's maxima lie close to what its documents have.
Once the table's sums are known, a block gets the greatest impact of each of its terms. An item's bound on a block is the sum of these maxima, each times the term's
weight; no document of the block scores higher.

Blocks are sorted by bound for each item. The ``FIRST`` ones are scored, and the score at the last place asked
for is the threshold of the item: below it no bound is followed. All further blocks are scored where they
lie: of every few blocks in memory a task scores the highest bounds first and raises its own copy of the
thresholds, until the bounds drop below. What is left, a few times the places asked for, is ranked. Bounds
equal to a threshold are followed, so ties are whole, and nothing is approximate: all is integer arithmetic
(impacts and weights are multiplied as doubles only where sums stay under 2 ** 53).

Items are worked on in groups of about ``TERMS`` distinct pairs of item and term, each group with one pass over the
texts, so what is sent to all tasks is bounded whatever the number of items. Terms are compared as bytes.

Null text has no terms; documents without terms do not count and are never found. Items without terms, or
without a document that scores above 0, give no rows. Rows that repeat an item_id are items of their own,
each with ranks from 1; rows that repeat a doc_id are documents of their own, null ids come last among
equals. A text of any length is one document, and a range of its own where it is long. Other columns do not
matter, whatever their names. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from liftwork.llm import staging
from liftwork.llm.textbuf import LOWER, slices, text_bytes
from liftwork.sources.positions import numbered

#: Places of an item; documents of a block; blocks scored for a threshold; pairs of item and term of a group of items.
TOP, BLOCK, FIRST, TERMS = 50, 16, 32, 200_000
#: Bytes of text that are a range of documents; within it blocks are made of documents that are alike.
RANGE = 1 << 20
#: Cells of the dense blocks that a task has in memory while it orders them; items scored in one product.
CELLS, TOGETHER = 1 << 22, 256
#: Constants of the contract: b in per cent, and what impacts are scaled by.
B, SCALE = 50, 1_000_000_000
_EXACT = 1 << 53

#: Bytes that terms are made of: ASCII letters and digits, and all bytes of other characters.
IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, int]:
    """All terms of a text column in a row, the row of each, and the number of rows."""
    data, at = text_bytes(column)
    rows = len(at) - 1
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), rows
    inside = IN_TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(data)]
    first[edges] = inside[edges]  # a text ends where the next begins
    begin = np.flatnonzero(first)
    row = np.searchsorted(at, begin, "right") - 1
    held = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=held[1:])
    offsets = np.append(held[begin], held[-1])
    body = LOWER[data[inside]]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(body)]), row, rows


def lengths_norm(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """m of documents of n terms: 100 - B + (B * n * N) div L, exact also where the product passes 64 bits."""
    if len(n) and int(n.max()) * B * documents < 1 << 63:
        return 100 - B + (B * documents * n) // max(length, 1)
    return np.array([100 - B + (B * int(x) * documents) // length for x in n], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + 20 * m)


class Items:
    """A group of items: their terms as places in the group's vocabulary, item after item; weights once df is known."""

    def __init__(self, texts: list[str | None]):
        terms, row, _ = terms_of(pa.array(texts, pa.string()))
        coded = pc.dictionary_encode(terms)
        self.vocabulary = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size = max(len(self.vocabulary), 1)
        pairs = np.unique(row * size + codes)
        self.item, self.term = pairs // size, pairs % size
        self.n = len(texts)
        self.weight = np.zeros(len(self.vocabulary), np.int64)

    def weigh(self, df: dict[int, int], documents: int) -> None:
        for t in range(len(self.weight)):
            self.weight[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1)))
        self.start = np.searchsorted(self.item, np.arange(self.n + 1))
        self.asked = np.flatnonzero(np.diff(self.start))
        most = max((int(self.weight[self.term[self.start[q] : self.start[q + 1]]].sum()) for q in self.asked), default=0)
        self.kind = np.float64 if most * (SCALE // 1000) < _EXACT else np.int64

    def bounds(self, terms: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The bound of each item on a block that has ``terms`` with greatest impacts ``most``."""
        dense = np.zeros(len(self.weight), np.int64)
        dense[terms] = most
        out = np.zeros(self.n, np.int64)
        if len(self.asked):
            out[self.asked] = np.add.reduceat((dense * self.weight)[self.term], self.start[self.asked])
        return out

    def scores(self, block: Block, items: np.ndarray) -> np.ndarray:
        """The scores (items, documents) of some items on a block."""
        place = np.full(len(self.weight), -1)
        place[block.terms] = np.arange(len(block.terms))
        out = []
        for k in range(0, len(items), TOGETHER):
            some = items[k : k + TOGETHER]
            wanted = np.zeros((len(some), len(block.terms)), self.kind)
            for r, q in enumerate(some):
                t = self.term[self.start[q] : self.start[q + 1]]
                t = t[place[t] >= 0]
                wanted[r, place[t]] = self.weight[t]
            out.append((wanted @ block.dense(self.kind)).astype(np.int64))
        return np.concatenate(out)


class Block:
    """A block of the index in memory."""

    def __init__(self, row: dict, documents: int, length: int):
        self.ids, self.terms = row["ids"], np.array(row["terms"], np.int64)
        self.at, self.place, self.tf = (np.array(row[c], np.int64) for c in ("at", "place", "tf"))
        self.m = lengths_norm(np.array(row["n"], np.int64), documents, length)
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.at))
        self._dense: np.ndarray | None = None

    @property
    def cells(self) -> int:
        return len(self.ids) * len(self.terms)

    def impact(self) -> np.ndarray:
        return impacts(self.tf, self.m[self.doc])

    def most(self) -> np.ndarray:
        out = np.zeros(len(self.terms), np.int64)
        np.maximum.at(out, self.place, self.impact())
        return out

    def dense(self, kind: type) -> np.ndarray:
        """Impacts as a table (terms, documents)."""
        if self._dense is None:
            self._dense = np.zeros((len(self.terms), len(self.ids)), kind)
            self._dense[self.place, self.doc] = self.impact()
        return self._dense


def _like_next_to_like(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
    """An order of the documents with terms: by the term that each has most of, then by length, so that a block's maxima lie close."""
    main = np.full(len(n), -1)
    order = np.lexsort((tf, doc))
    last = np.append(np.flatnonzero(np.diff(doc[order])), len(doc) - 1) if len(doc) else np.zeros(0, np.int64)
    main[doc[order][last]] = term[order][last]
    found = np.lexsort((n, main))
    return found[n[found] > 0]


def forward_blocks(docs: DataFrame, vocabulary: pa.Array, block: int = BLOCK) -> DataFrame:
    """The forward index of (doc_id, text), a row a block: ids and term counts n of its documents, the terms it has of the
    vocabulary, and the postings of document k from at[k] to at[k + 1], as places in terms and counts tf."""
    size = max(len(vocabulary), 1)
    ids = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, ids array<{ids}>, n array<long>, terms array<int>, at array<int>, place array<int>, tf array<int>"
    held = vocabulary.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = pa.array(held, pa.large_binary()), TaskContext.get().partitionId() << 32
        one = lambda values, kind: pa.ListArray.from_arrays([0, len(values)], pa.array(values, kind))
        for batch in slices(batches, "text", RANGE):
            terms, row, rows = terms_of(batch.column("text"))
            n = np.bincount(row, minlength=rows)
            term = pc.index_in(terms, value_set=known)
            there = np.flatnonzero(term.is_valid().to_numpy(zero_copy_only=False))
            pairs, tf = np.unique(row[there] * size + term.to_numpy(zero_copy_only=False)[there].astype(np.int64), return_counts=True)
            doc, term_of = pairs // size, pairs % size
            order = _like_next_to_like(doc, term_of, tf, n)
            place_of = np.full(rows, -1)
            place_of[order] = np.arange(len(order))
            sort = np.lexsort((term_of, place_of[doc]))
            place, term_of, tf = place_of[doc][sort], term_of[sort], tf[sort]
            for first in range(0, len(order), block):
                some = order[first : first + block]
                a, b = np.searchsorted(place, (first, first + len(some)))
                present, at_term = np.unique(term_of[a:b], return_inverse=True)
                at = np.searchsorted(place[a:b] - first, np.arange(len(some) + 1))
                kept = batch.column("doc_id").take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), one(kept, kept.type), one(n[some], pa.int64()), *(one(v, pa.int32()) for v in (present, at, at_term, tf[a:b]))],
                    names=["block", "ids", "n", "terms", "at", "place", "tf"],
                )
                number += 1

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def with_maxima(forward: DataFrame, documents: int, length: int) -> DataFrame:
    """The index: the forward blocks with most, the greatest impact of each of their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                most = Block(row.to_pylist()[0], documents, length).most()
                yield pa.RecordBatch.from_arrays([*row.columns, pa.ListArray.from_arrays([0, len(most)], pa.array(most, pa.int64()))], names=[*batch.schema.names, "most"])

    return forward.mapInArrow(run, forward.select("*", F.lit(None).cast("array<long>").alias("most")).schema)


def highest_blocks(index: DataFrame, items: Items, first: int = FIRST) -> DataFrame:
    """(block, items): the blocks with the ``first`` highest bounds of each item, and the items that they are for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound, block = np.zeros((first, items.n), np.int64), np.zeros((first, items.n), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                new = items.bounds(np.array(row["terms"], np.int64), np.array(row["most"], np.int64))
                least = bound.argmin(axis=0)
                q = np.flatnonzero(new > bound[least, np.arange(items.n)])
                bound[least[q], q], block[least[q], q] = new[q], row["block"]
        r, q = np.nonzero(bound)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(block[r, q]), pa.array(bound[r, q])], names=["q", "block", "bound"])

    found = index.select("block", "terms", "most").mapInArrow(run, "q int, block long, bound long")
    order = Window.partitionBy("q").orderBy(F.desc("bound"), "block")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= first).groupBy("block").agg(F.collect_list("q").alias("items"))


def _best(ids: list, scores: np.ndarray, least: int, top: int) -> list[tuple]:
    """(doc_id, score) of the ``top`` places of one item in a block, of scores above 0 and not under ``least``."""
    some = np.flatnonzero(scores >= max(least, 1))
    if len(some) > top:
        cut = -np.partition(-scores[some], top - 1)[top - 1]
        some = some[scores[some] >= cut]
    return sorted(((ids[d], int(scores[d])) for d in some), key=lambda x: (-x[1], x[0] is None, x[0]))[:top]


def scored_first(index: DataFrame, chosen: DataFrame, items: Items, documents: int, length: int, top: int = TOP) -> DataFrame:
    """(q, score) of the places that the chosen blocks give. At most ``FIRST`` blocks an item are read."""
    blocks = index.join(F.broadcast(chosen), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, wanted = Block(row, documents, length), np.array(row["items"])
                found = [(int(q), s) for q, scores in zip(wanted, items.scores(block, wanted), strict=True) for _, s in _best(block.ids, scores, 1, top)]
                yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in found], pa.int32()), pa.array([s for _, s in found], pa.int64())], names=["q", "score"])

    return blocks.mapInArrow(run, "q int, score long")


def search_blocks(index: DataFrame, items: Items, least: np.ndarray, documents: int, length: int, top: int = TOP) -> DataFrame:
    """(q, doc_id, score): every document that may have one of the ``top`` places; ``least`` the thresholds.

    Also (-1, NULL, n): how many pairs of item and block were scored, and (-2, NULL, n) how many there are.
    """
    ids = index.schema["ids"].dataType.elementType

    def scored(held: list[tuple[Block, np.ndarray]], at_least: np.ndarray, best: list[list], tally: list[int]) -> None:
        """Score ``held``: of every item the blocks from the highest bound down to its threshold."""
        bounds = np.array([b for _, b in held])
        tally[1] += bounds.size
        order = np.argsort(-bounds, axis=0, kind="stable")
        for step in range(len(held)):
            at = order[step]
            live = np.flatnonzero(bounds[at, np.arange(items.n)] >= at_least)
            if not len(live):
                break
            tally[0] += len(live)
            for b in np.unique(at[live]):
                block, wanted = held[b][0], live[at[live] == b]
                for q, scores in zip(wanted, items.scores(block, wanted), strict=True):
                    if new := _best(block.ids, scores, at_least[q], top):
                        best[q] = sorted(best[q] + new, key=lambda x: (-x[1], x[0] is None, x[0]))[:top]
                        if len(best[q]) == top:
                            at_least[q] = max(at_least[q], best[q][-1][1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_least, best, tally = np.maximum(least, 1), [[] for _ in range(items.n)], [0, 0]
        held, cells = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                block = Block(row, documents, length)
                if held and cells + block.cells > CELLS:
                    scored(held, at_least, best, tally)
                    held, cells = [], 0
                held.append((block, items.bounds(block.terms, np.array(row["most"], np.int64))))
                cells += block.cells
        if held:
            scored(held, at_least, best, tally)
        found = [(q, d, s) for q, places in enumerate(best) for d, s in places] + [(-1, None, tally[0]), (-2, None, tally[1])]
        q, d, s = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, index_type), pa.array(s, pa.int64())], names=["q", "doc_id", "score"])

    index_type = to_arrow_type(ids)
    return index.mapInArrow(run, f"q int, doc_id {ids.simpleString()}, score long")


def _searched(docs: DataFrame, some: DataFrame, top: int) -> tuple[DataFrame, dict]:
    """(_item, rank, doc_id, score) of one group of items (_item, text), and how much was scored."""
    spark = docs.sparkSession
    given = some.collect()  # a group of items, about TERMS terms
    numbers = [r["_item"] for r in given]
    items = Items([r["text"] for r in given])
    forward = staging.stored(forward_blocks(docs, items.vocabulary), "search-forward")
    sums = forward.select(F.sum(F.size("ids")).alias("documents"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("length")).first()
    documents, length = sums["documents"] or 0, sums["length"] or 0
    df = forward.select(F.explode(F.transform("place", lambda p: F.get("terms", p))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    items.weigh({r["term"]: r["df"] for r in df.collect()}, documents)  # a row a term of the group
    index = staging.stored(with_maxima(forward, documents, length), "search-index")
    staging.drop(forward)
    chosen = highest_blocks(index, items)
    heads = scored_first(index, chosen, items, documents, length, top)
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    places = heads.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top).groupBy("q").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    least = np.zeros(items.n, np.int64)
    for r in places.where(F.col("n") == top).collect():  # a row an item of the group
        least[r["q"]] = r["least"]
    found = staging.stored(search_blocks(index, items, least, documents, length, top), "search-found")
    tally = {r["q"]: r["n"] for r in found.where("q < 0").groupBy("q").agg(F.sum("score").alias("n")).collect()}
    staging.drop(index)
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    out = found.where("q >= 0").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(numbers)), "q int, _item long")
    return out.join(F.broadcast(names), "q").select("_item", "rank", "doc_id", "score"), {"scored": tally.get(-1, 0), "pairs": tally.get(-2, 0)}


def search(docs: DataFrame, items: DataFrame, top: int = TOP, terms: int = TERMS, tell: list | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of (doc_id, text) for every row of (item_id, text).

    ``tell`` gets for each group of items how many pairs of item and block there are and how many were scored.
    """
    text = F.col("text").cast("string")
    asked = numbered(items.select("item_id", text.alias("text")), ["item_id", "text"], "_item")
    size = F.greatest(F.length(text), F.lit(0)) / 4 + 1  # terms, about
    total = asked.agg(F.sum(F.coalesce(size, F.lit(1.0)))).first()[0] or 0
    groups = max(1, math.ceil(total / terms))
    asked = staging.stored(asked.withColumn("_group", F.pmod("_item", F.lit(groups)).cast("int")), "search-items")
    out = None
    for g in range(groups):
        found, tally = _searched(docs, asked.where(F.col("_group") == g).select("_item", "text"), top)
        out = found if out is None else out.unionByName(found)
        if tell is not None:
            tell.append(tally)
    return out.join(asked.select("_item", "item_id"), "_item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(staging.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_CHARS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = f"""
with docs as (select row_number() over () as d, doc_id, regexp_extract_all({_LOWERED}, '{_CHARS}') as w from documents),
items as (select row_number() over () as i, item_id, regexp_extract_all({_LOWERED}, '{_CHARS}') as w from benchmark),
asked as (select i, item_id, unnest(list_distinct(w)) as term from items),
sums as (select count(*) as n, sum(len(w))::bigint as l from docs where len(w) > 0),
counts as (select d, doc_id, len(w) as n, unnest(w) as term from docs),
tf as (select d, doc_id, n, term, count(*) as tf from counts where term in (select term from asked) group by all),
weights as (select term, floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1)))::bigint as w from tf, sums s group by term, s.n),
impact as (select d, doc_id, term, w * (({SCALE} * tf) // (1000 * tf + 20 * ({100 - B} + ({B} * tf.n * s.n) // s.l))) as score from tf join weights using (term), sums s),
scores as (select i, item_id, d, doc_id, sum(score)::bigint as score from asked join impact using (term) group by all),
ranked as (select item_id, row_number() over (partition by i order by score desc, doc_id)::int as rank, doc_id, score from scores where score > 0)
select * from ranked where rank <= {TOP}
"""
