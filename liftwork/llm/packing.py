"""Best-fit packing of tokenised documents by exact-complement hashing.

A piece is a document's ids, or where they exceed the capacity one of its cuts (the first cut takes
the remainder, all others are full). Only the number of pieces of each length matters for the plan:
a histogram of at most ``capacity`` entries, whatever the input. For the lengths in falling order the
plan looks up the gap that is left in hash indexes of single lengths and of pair sums, finds triples by
looking up what each third length leaves of the gap among the pairs, and uses up each combination that fills it exactly, as often as all its lengths are there. Pieces
of a length that has no exact complement left go by best fit: always the longest that still fits.

The plan is a table of patterns, each used for a range of sequence numbers. Pieces get a rank within
their length, from counts per hash block and a rank within the block, so that no length is gathered
in one task; the rank decides the pattern, the sequence and the place.

Null text counts as empty and still has its end token. Rows that repeat a doc_id are pieces of their
own. A null doc_id stays null. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.textbuf import slices

CAPACITY = 1024
END_TOKEN = 2
VOCABULARY = "byte_bpe_50k"
#: Rows of a hash block, about, within which pieces of one length are ranked.
BLOCK = 50_000

#: A space with white space on both sides, or before the end: words can't be cut apart there.
_LOOSE = r"[\s\x{85}\x0b\x1c-\x1f\pZ] ([\s\x{85}\x0b\x1c-\x1f\pZ]|$)"


class Encoder:
    """Token ids of whole texts; words are encoded once a batch.

    The vocabulary's pattern never joins a word with what stands before its single space, so a text is
    cut there, distinct words are encoded, and the ids put together again. Texts in which a space
    stands between other white space are encoded as a whole. Texts that hold one of the vocabulary's
    added tokens are cut at those, which get their own ids.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as whole:
            added = json.load(whole)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{vocabulary}: added tokens that take in or depend on what stands beside them")
        self.added = {t["content"]: t["id"] for t in added}
        self.marks = "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))

    @classmethod
    def get(cls, vocabulary: str) -> Encoder:
        if vocabulary not in cls._loaded:
            cls._loaded[vocabulary] = cls(vocabulary)
        return cls._loaded[vocabulary]

    def whole(self, text: str) -> list[int]:
        if not self.added:
            return self.encode(text)
        out: list[int] = []
        for part in re.split(f"({self.marks})", text):
            out += [self.added[part]] if part in self.added else self.encode(part)
        return out

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """uint32 ids of each text."""
        texts = pc.fill_null(texts, "")
        words = pc.split_pattern(texts, " ")
        flat = words.flatten()
        ends = words.offsets.to_numpy()[1:] - words.offsets.to_numpy()[0]
        begins = np.concatenate([[0], ends[:-1]])
        initial = np.zeros(len(flat), bool)
        initial[begins] = True  # a text's first word has no space before it
        coded = pc.dictionary_encode(flat)
        code = coded.indices.to_numpy().astype(np.int64) * 2 + initial
        used, at = np.unique(code, return_inverse=True)
        entries = coded.dictionary.take(pa.array(used >> 1)).to_pylist()
        ids = [self.encode(e if bare else " " + e) for e, bare in zip(entries, (used & 1).tolist(), strict=True)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        pool = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
        start = np.cumsum(size) - size
        n = size[at]
        total = np.cumsum(n)
        whole = pool[np.arange(total[-1] if len(total) else 0) + np.repeat(start[at] - (total - n), n)]
        edges = np.concatenate([[0], total])[np.concatenate([[0], ends])]
        out = [whole[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        apart = pc.match_substring_regex(texts, _LOOSE)
        for token in self.added:
            apart = pc.or_(apart, pc.match_substring(texts, token))
        for i in np.flatnonzero(apart.to_numpy(zero_copy_only=False)):
            out[i] = np.array(self.whole(texts[int(i)].as_py()), np.uint32)
        return out


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_token: int = END_TOKEN, with_ids: bool = False) -> DataFrame:
    """(doc_id, row_key, piece, start, length, ids_crc32[, ids]) of every piece."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.get(vocabulary)
        tail = np.array([end_token], np.uint32)
        for batch in slices(batches, "text", 4 << 20):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.batch(batch.column("text")), strict=True):
                ids = np.concatenate([ids, tail])
                cut = len(ids) % capacity or capacity
                begin = 0
                for k in range(-(-len(ids) // capacity)):
                    part = ids[begin : (end := cut + k * capacity)]
                    rows.append((doc, k, begin, end - begin, zlib.crc32(part.astype("<u4").tobytes()), *([part.astype(np.int32)] if with_ids else [])))
                    begin = end
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (5 + with_ids)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=False)], names=names[: len(columns)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) that hold every piece, from the number of pieces of each length.

    Exact complements of up to three, two or one pieces are tried; the plan with fewest sequences is taken.
    """
    return min((_plan(counts, capacity, parts) for parts in (3, 2, 1)), key=lambda p: sum(n for _, n in p))


def _plan(counts: dict[int, int], capacity: int, parts: int) -> list[tuple[tuple[int, ...], int]]:
    left = Counter({k: n for k, n in counts.items() if n > 0})
    used: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...]) -> bool:
        need = Counter(pattern)
        times = min(left[k] // n for k, n in need.items())
        if times > 0:
            used.append((pattern, times))
            for k, n in need.items():
                left[k] -= times * n
        return times > 0

    lengths = sorted(left)
    sums: dict[int, list[tuple[int, int]]] = defaultdict(list)  # of pairs, the most unequal first
    for i, a in enumerate(lengths):
        for b in lengths[i:]:
            if a + b > capacity:
                break
            sums[a + b].append((b, a))
    for k in sums:
        sums[k].sort(reverse=True)
    for a in reversed(lengths):
        gap = capacity - a
        if gap == 0:
            take((a,))
        if left[a] and left[gap]:
            take((a, gap))
        for b, c in sums.get(gap, ()) if parts > 1 else ():
            if left[a] and left[b] and left[c]:
                take((a, b, c))
        for b in reversed(lengths) if parts > 2 else ():
            if b < gap and left[a] and left[b]:
                for c, d in sums.get(gap - b, ()):
                    if c <= b and left[a] and left[b] and left[c] and left[d]:
                        take((a, b, c, d))
        while left[a]:  # no exact complement is left: best fit
            pattern, room = [], capacity
            for k in reversed(lengths):
                while k <= min(room, a) and left[k] > pattern.count(k):
                    pattern.append(k)
                    room -= k
            take(tuple(pattern))
    return used


def _slots(spark: SparkSession, patterns: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """(length, low, high, first, slots, offset): ranks low..high of a length fill one place of a pattern.

    ``k`` slots of one length within a pattern take turns, each with a range of its own.
    """
    rows, rank, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for k in lengths:
            rows.append((k, rank[k], rank[k] + times - 1, sequence, offset))
            rank[k] += times
            offset += k
        sequence += times
    return spark.createDataFrame(rows, "length long, low long, high long, first long, offset long")


def packed(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a stored table of pieces."""
    spark = table.sparkSession
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    total = sum(counts.values())
    slots = _slots(spark, plan(counts, capacity))
    blocks = max(1, total // BLOCK)
    keyed = table.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    sizes = keyed.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "block", (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("own", F.row_number().over(order) - 1).join(before, ["length", "block"]).withColumn("rank", F.col("before") + F.col("own"))
    # a few thousand patterns at most: each exact step uses up a length
    places = slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("low", "high", "first", "offset"))).alias("places"))
    hit = F.filter("places", lambda p: (p["low"] <= F.col("rank")) & (F.col("rank") <= p["high"]))[0]
    put = ranked.join(F.broadcast(places), "length").withColumn("put", hit)
    return put.select(*table.columns, (F.col("put.first") + F.col("rank") - F.col("put.low")).alias("sequence_id"), F.col("put.offset").alias("offset"))


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    return packed(staging.stored(pieces(docs, capacity, with_ids=with_ids), "pieces"), capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(staging.documents(spark, sf_dir))
