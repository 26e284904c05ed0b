"""Repeated passages by common-prefix intervals of sparse enhanced suffix arrays.

Every window of LENGTH bytes has an anchor: its GRAM-byte string with the least hash. Equal windows
have equal anchors at equal offsets, so a suffix array over the suffixes that start at anchors shows
every repeat. It is built in three steps, all keyed by the anchor's hash:

1. Runs of windows that share an anchor and have equal contexts (the run with all bytes of its windows)
   are equal suffixes, an interval of the array as they stand. They enter as one entry: the first run goes
   on, and only where its anchor has more than one context; the windows of the others are repeats. Contexts
   are equal if two hashes are, of 62 bits each: that of the anchor and that of the context.
2. The contexts that are left are grouped by anchor. Each group is an enhanced suffix array (right
   contexts in order, with common prefix lengths). A stack scan yields its common-prefix intervals;
   within each, a second scan over the reversed left contexts tests the left extension. A pair of
   intervals is a maximal repeat with all its occurrences; all but the first are removed. Here bytes are
   compared, not hashes.
3. Anchors with very many contexts (a passage that a large part of all documents holds, at its
   edges) would be an unbounded group. Their windows are grouped one by one instead, by the hashes of the
   anchor and of the whole window, which Spark pre-aggregates before the shuffle.

Runs of frequent anchors are dealt to many tasks at first, which leave one run of each context, and
the rest of them again by context: no context, however often it stands, is gathered in one task.

Null text counts as empty. A document is a row; rows that repeat a doc_id are told apart by their
text, and none of them stands before the other. A null doc_id stands before all others. Texts under
LENGTH bytes stay whole. Of equal windows the first stays: smaller doc_id, then earlier start; equal rows
are one document. Other columns do not matter, but for those that are asked for. Anchors of a long text are
found slice by slice; what is done with a text as a whole takes some 50 bytes of arrays for each of its bytes.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.textbuf import RollingHash, mix, slices, text_bytes

LENGTH = 100
GRAM = 32
#: Bytes of text that a task works on at a time, about: some 100 bytes of arrays for each.
SLICE = 1 << 19
_POSITION_BITS = 28


def _least_over(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` neighbours."""
    span, least = 1, keys
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return least


def anchor_runs(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts that share an anchor: (begin, count, offset of the anchor, anchor hash, context hash).

    The anchor of a window of ``length`` bytes is its ``gram``-byte string with the least hash, the
    first of equal ones; equal windows have equal anchors at equal offsets.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    rolling = RollingHash(data)
    grams = rolling.windows(gram)
    bits = np.uint64(max(_POSITION_BITS, int(len(data)).bit_length()))
    keys = (mix(grams) >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least_over(keys, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    count = np.maximum(at[1:] - at[:-1] - (length - 1), 0)
    step = np.zeros(len(anchor) + 1, np.int32)
    some = count > 0
    np.add.at(step, at[:-1][some], 1)
    np.add.at(step, (at[:-1] + count)[some], -1)
    valid = np.cumsum(step[:-1]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    place = anchor[begin]
    shape = mix(((place - begin) << 20 | (end - begin)).astype(np.uint64))
    context = mix(rolling.ranges(begin, end + length) ^ shape)
    return begin, end - begin + 1, place - begin, mix(grams[place]).view(np.int64), context.view(np.int64)


#: Contexts of one anchor that one group may hold; windows of larger groups are grouped one by one.
GROUP = 4096
#: One row in this many is looked at to find anchors that need salting, and so many salts they get.
SAMPLE, SALTS, MOST_HOT = 64, 64, 4096

_ROWS = "kh long, sh long, did long, th int, p int, n short, off short, dup boolean"


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per anchor run; dup: an equal run stands earlier in the same batch, so this one is resolved already."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches, "text", SLICE):
            data, at = text_bytes(batch.column("text"))
            step = max(4 * SLICE, len(data)) if batch.num_rows > 1 else SLICE
            for low in range(0, max(len(data), 1), step):  # a long text by slices that overlap by a window less one byte
                part = data[low : low + step + length - 1]
                own = at if step >= len(data) else np.array([0, len(part)])
                begin, count, off, kh, sh = anchor_runs(part, own, length, gram)
                row = np.searchsorted(own, begin, "right") - 1
                yield batch.column("did").to_numpy()[row], batch.column("th").to_numpy()[row], begin - own[row] + low, count, off, kh, sh

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for did, th, p, count, off, kh, sh in found(batches):
            order = np.lexsort((p, th, did, sh))
            dup = np.zeros(len(order), bool)
            if len(order):
                s_, d_, t_ = sh[order], did[order], th[order]
                new = np.ones(len(order), bool)
                new[1:] = s_[1:] != s_[:-1]
                lead = d_[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                again = np.zeros(len(order), bool)  # an equal run stands earlier in the document itself
                again[1:] = ~new[1:] & (d_[1:] == d_[:-1]) & (t_[1:] == t_[:-1])
                dup[order] = (d_ != lead) | again
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in ((kh, pa.int64()), (sh, pa.int64()), (did, pa.int64()), (th, pa.int32()), (p, pa.int32()), (count, pa.int16()), (off, pa.int16()), (dup, pa.bool_()))],
                names=["kh", "sh", "did", "th", "p", "n", "off", "dup"],
            )

    return docs.select("did", "th", "text").mapInArrow(run, _ROWS)


def _hot_anchors(given: DataFrame, length: int, gram: int) -> DataFrame:
    """At most MOST_HOT frequent anchors, from a sample of documents. They only decide the routing."""
    sample = given.where(F.pmod(F.xxhash64("did", "th"), F.lit(SAMPLE)) == 7)
    counts = anchors(sample, length, gram).groupBy("kh").agg(F.count(F.lit(1)).alias("c")).where("c >= 64")
    return counts.orderBy(F.desc("c"), "kh").limit(MOST_HOT).select("kh", F.lit(True).alias("hot"))


class _Contexts:
    """Streams anchor runs in the order (kh, sh, did, th, p) and tells repeats from first contexts.

    A context's first ones are those of the least did, the first of each text that has this did.
    """

    names = ("kh", "sh", "did", "th", "p", "n", "off", "kind")

    def __init__(self):
        self.last = None  # kh, sh, did, th of the row before
        self.lead = None  # the least did of the context that is open
        self.held = None  # the only context so far of the open anchor, not yet told
        self.many = False  # whether the open anchor has several contexts

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("kh", "sh", "did", "th", "p", "n", "off", "dup", "hot")}
        done = col["dup"]
        if done.any():
            yield self._rows({c: v[done] for c, v in col.items()}, 0)
        col = {c: v[~done] for c, v in col.items()}
        size = len(col["kh"])
        if not size:
            return
        before = self.last or (0, 0, 0, 0)
        moved = lambda c, first: col[c] != np.concatenate([[first], col[c][:-1]])
        new_k = moved("kh", before[0])
        if self.last is None:
            new_k[0] = True
        new_s = new_k | moved("sh", before[1])
        new_t = new_s | moved("did", before[2]) | moved("th", before[3])
        at = np.maximum.accumulate(np.where(new_s, np.arange(size), -1))
        lead = np.where(at >= 0, col["did"][np.maximum(at, 0)], self.lead if self.lead is not None else 0)
        own = new_t & (col["did"] == lead)
        yield self._rows({c: v[~own] for c, v in col.items()}, 0)
        group = np.cumsum(new_k)  # 0: the anchor that was open before
        contexts = np.bincount(group[own], minlength=group[-1] + 1)
        if self.last is not None:
            contexts[0] += 2 if self.many else self.held is not None
        if self.held is not None and contexts[0] > 1:
            yield self._rows(self.held, 1)
        if self.held is not None and (contexts[0] > 1 or group[-1] > 0):
            self.held = None
        several = own & ((contexts[group] > 1) | col["hot"])
        for hot in (False, True):
            yield self._rows({c: v[several & (col["hot"] == hot)] for c, v in col.items()}, 2 if hot else 1)
        last = group[-1]
        if last > 0 or self.last is None:
            self.many = False
            self.held = None
        self.many = self.many or contexts[last] > 1
        only = np.flatnonzero(own & (group == last) & ~col["hot"])
        if contexts[last] == 1 and len(only):
            self.held = {c: v[only] for c, v in col.items()}
        self.lead = lead[-1]
        self.last = tuple(col[c][-1] for c in ("kh", "sh", "did", "th"))

    def _rows(self, col: dict[str, np.ndarray], kind: int) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int16(), pa.int16())
        values = [pa.array(col[c], t) for c, t in zip(self.names, types, strict=False)]
        if kind != 2:  # the context is of no use any more
            values[1] = pa.nulls(len(col["kh"]), pa.int64())
        return pa.RecordBatch.from_arrays([*values, pa.array(np.full(len(col["kh"]), kind, np.int8))], names=list(self.names))


def _resolved(rows: DataFrame, deal: Column) -> DataFrame:
    """(kh, sh, did, th, p, n, off, kind) of rows with hot: kind 0 repeats, 1 contexts to compare, 2 those of hot anchors.

    Rows with equal ``deal`` come together, those of an anchor that is not hot always.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = _Contexts()
        for batch in batches:
            for out in contexts.feed(batch):
                if out.num_rows:
                    yield out

    dealt = rows.withColumn("deal", F.xxhash64(F.when(F.col("dup"), 0).otherwise(F.col("kh")), F.when(F.col("dup"), F.xxhash64("did")).when(F.col("hot"), deal).otherwise(0)))
    schema = "kh long, sh long, did long, th int, p int, n short, off short, kind byte"
    return dealt.repartition("deal").sortWithinPartitions("kh", "sh", "did", "th", "p").select("kh", "sh", "did", "th", "p", "n", "off", "dup", "hot").mapInArrow(run, schema)


def _gather(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one after the other."""
    ends = np.cumsum(size)
    index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
    return data[index]


_CONTEXT = "key long, wh long, did long, th int, p int, n short, off short, ctx binary"


def _contexts(given: DataFrame, open_runs: DataFrame, length: int) -> DataFrame:
    """The bytes of open runs; for hot anchors a row for each window, with its hash as key and no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, at = text_bytes(batch.column("text"))
            lists = batch.column("runs")
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            runs = lists.flatten()
            kh, p, n, off, kind = (runs.field(c).to_numpy() for c in ("kh", "p", "n", "off", "kind"))
            did, th = batch.column("did").to_numpy()[row], batch.column("th").to_numpy()[row]
            cold = kind == 1
            size = n[cold].astype(np.int64) + length - 1
            body = _gather(data, at[row[cold]] + p[cold], size)
            yield _context_rows(kh[cold], None, did[cold], th[cold], p[cold], n[cold], off[cold], body, np.cumsum(size))
            hot = np.flatnonzero(kind == 2)
            if len(hot):
                each = np.repeat(hot, n[hot])
                start = p[each] + np.arange(len(each)) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
                begin = at[row[each]] + start
                wh = mix(RollingHash(data).ranges(begin, begin + length)).view(np.int64)
                yield _context_rows(kh[each], wh, did[each], th[each], start, np.ones(len(each)), np.zeros(len(each)), None, None)

    per_doc = open_runs.groupBy("did", "th").agg(F.collect_list(F.struct("kh", "p", "n", "off", "kind")).alias("runs"))
    return given.join(per_doc, ["did", "th"]).select("did", "th", "text", "runs").mapInArrow(run, _CONTEXT)


def _context_rows(key, wh, did, th, p, n, off, body, ends) -> pa.RecordBatch:
    if body is None:
        ctx = pa.nulls(len(key), pa.binary())
    else:
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        ctx = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())])
    wh = pa.nulls(len(key), pa.int64()) if wh is None else pa.array(wh)
    plain = ((key, pa.int64()), (did, pa.int64()), (th, pa.int32()), (p, pa.int32()), (n, pa.int16()), (off, pa.int16()))
    key, *rest = (pa.array(np.asarray(x).astype(t.to_pandas_dtype()), t) for x, t in plain)
    return pa.RecordBatch.from_arrays([key, wh, *rest, ctx], names=["key", "wh", "did", "th", "p", "n", "off", "ctx"])


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    size = min(len(x), len(y))
    differ = int.from_bytes(x[:size], "big") ^ int.from_bytes(y[:size], "big")
    return size - (differ.bit_length() + 7) // 8


def prefix_intervals(lengths: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
    """Common-prefix intervals of a sorted array by a stack scan.

    ``lengths[k]`` is the common prefix of entries k and k + 1. Yields (prefix, prefix of the parent
    interval or least - 1, first entry, last entry) of every interval with a prefix of ``least`` or more.
    """
    stack: list[tuple[int, int]] = []
    for k, now in enumerate([*lengths, -1]):
        begin = k
        while stack and stack[-1][0] > now:
            prefix, begin = stack.pop()
            parent = max(now, stack[-1][0] if stack else -1, least - 1)
            yield prefix, parent, begin, k
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, begin))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int, least: int) -> Iterator[tuple[list[int], int, int]]:
    """Groups of occurrences of one anchor: (members, least, greatest distance of a window's start before the anchor).

    ``lefts`` run backwards from the anchor, ``rights`` forwards. All windows of ``length`` bytes that
    start at one of the distances are equal among the members, and no further occurrence has them.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lengths = [common(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    for prefix, parent, first, last in prefix_intervals(lengths, least):
        low, high = max(0, length - prefix), length - 1 - parent
        members = sorted(order[first : last + 1], key=lefts.__getitem__)
        before = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:], strict=False)]
        for shared, outer, begin, end in prefix_intervals(before, low):
            near, far = max(low, outer + 1), min(high, shared)
            if near <= far:
                yield members[begin : end + 1], near, far


def _compared(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, wh, did, th, p, n): repeats (wh null), and windows of groups that are too large, by hash."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[tuple]]]:
        """Rows of each key; of large groups in parts, with True."""
        key, rows, large = None, [], False
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "did", "th", "p", "n", "off", "ctx")), strict=True):
                if row[0] != key:
                    if rows:
                        yield large, rows
                    key, rows, large = row[0], [], False
                rows.append(row)
                if len(rows) > GROUP:
                    large = True
                if large and len(rows) >= 64:
                    yield True, rows
                    rows = []
        if rows:
            yield large, rows

    def repeats(rows: list[tuple]) -> Iterator[tuple]:
        lefts, rights = [r[6][: r[5]][::-1] for r in rows], [r[6][r[5] :] for r in rows]
        for members, near, far in maximal_repeats(lefts, rights, length, gram):
            at = {m: rows[m][3] + rows[m][5] for m in members}
            least = min(rows[m][1] for m in members)
            first: dict[int, int] = {}  # of each text that has the least did
            for m in members:
                if rows[m][1] == least:
                    first[rows[m][2]] = min(at[m], first.get(rows[m][2], at[m]))
            for m in members:
                if rows[m][1] != least or at[m] != first[rows[m][2]]:
                    yield None, None, rows[m][1], rows[m][2], at[m] - far, far - near + 1

    def windows(rows: list[tuple]) -> Iterator[tuple]:
        body = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
        n = np.array([r[4] for r in rows])
        size = n + length - 1
        begin = np.repeat(np.cumsum(size) - size, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wh = mix(RollingHash(body).ranges(begin, begin + length)).view(np.int64).tolist()
        k = 0
        for r in rows:
            for i in range(r[4]):
                yield r[0], wh[k], r[1], r[2], r[3] + i, 1
                k += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int16())
        full = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["key", "wh", "did", "th", "p", "n"])
        for large, rows in groups(batches):
            if large:
                out.extend(windows(rows))
            elif len(rows) > 1:
                out.extend(repeats(rows))
            if len(out) >= 20_000:
                yield full()
                out.clear()
        if out:
            yield full()

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, wh long, did long, th int, p int, n short")


def repeated_runs(given: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(did, th, p, n): every window start p .. p + n - 1 of a document that repeats an earlier window."""
    hot = staging.stored(_hot_anchors(given, length, gram), "suffix-hot")
    marked = anchors(given, length, gram).join(F.broadcast(hot), "kh", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))  # MOST_HOT rows at most
    runs = staging.stored(_resolved(marked, F.xxhash64(F.pmod("sh", F.lit(SALTS)), F.pmod(F.xxhash64("did"), F.lit(SALTS)))), "suffix-runs")
    staging.release(given.sparkSession)
    # of a frequent anchor every task has left one run of each context
    left = runs.where("kind = 2").drop("kind").withColumns({"dup": F.lit(False), "hot": F.lit(True)})
    again = staging.stored(_resolved(left, F.col("sh")), "suffix-hot-runs")
    kept = ("kh", "did", "th", "p", "n", "off", "kind")
    runs = runs.where("kind < 2").select(*kept).unionByName(again.select(*kept))
    contexts = staging.stored(_contexts(given, runs.where("kind > 0"), length), "suffix-contexts")
    staging.release(given.sparkSession)
    compared = staging.stored(_compared(contexts.where("ctx is not null"), length, gram), "suffix-compared")
    window = ("key", "wh", "did", "th", "p")
    windows = contexts.where("ctx is null").select(*window).unionByName(compared.where("wh is not null").select(*window))
    firsts = windows.groupBy("key", "wh").agg(F.min(F.struct("did", "th", "p")).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("key", "wh", "first")
    joined = windows.join(firsts, ["key", "wh"])
    one = F.lit(1).cast("short").alias("n")
    later = joined.where("did > first.did or (th = first.th and p > first.p)").select("did", "th", "p", one)
    # other texts with the first one's id: each keeps its own first
    namesakes = joined.where("did = first.did and th <> first.th").groupBy("key", "wh", "did", "th").agg(F.sort_array(F.collect_list("p")).alias("at"))
    later = later.unionByName(namesakes.select("did", "th", F.explode(F.slice("at", 2, F.greatest(F.size("at") - 1, F.lit(0)))).alias("p"), one))
    return runs.where("kind = 0").select("did", "th", "p", "n").unionByName(compared.where("wh is null").select("did", "th", "p", "n")).unionByName(later)


def _identified(docs: DataFrame) -> DataFrame:
    """Columns did, th and text: where a document stands, a hash of its text, and the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), F.hash(text).alias("th"), text.alias("text"))


def without_repeats(docs: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """doc_id, the columns ``carry``, n_bytes, n_removed, n_spans and kept (binary) of every row.

    With ``as_text`` kept is a string, without the bytes of characters that a cut breaks.
    """
    runs = repeated_runs(_identified(docs), length)
    per_doc = runs.groupBy(F.col("did").alias("_rd"), F.col("th").alias("_rt")).agg(F.collect_list(F.struct("p", "n")).alias("_runs"))
    given = docs.select("doc_id", *carry, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    given = given.withColumns({"_did": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "_th": F.hash("_text")})
    joined = given.join(per_doc, (F.col("_did") == F.col("_rd")) & (F.col("_th") == F.col("_rt")), "left").select("doc_id", *carry, "_text", "_runs")
    schema = joined.drop("_text", "_runs").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "string" if as_text else "binary")
    names = ["doc_id", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE):
            data, at = text_bytes(batch.column("_text"))
            lists = batch.column("_runs").fill_null([]) if batch.column("_runs").null_count else batch.column("_runs")
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            found = lists.flatten()
            begin = at[row] + found.field("p").to_numpy()
            end = begin + found.field("n").to_numpy().astype(np.int64) + length - 1
            step = np.zeros(len(data) + 1, np.int64)
            np.add.at(step, begin, 1)
            np.add.at(step, end, -1)
            gone = np.cumsum(step[:-1]) > 0
            heads = gone.copy()
            heads[1:] &= ~gone[:-1]
            edges = at[:-1][at[:-1] < len(data)]
            heads[edges] = gone[edges]
            count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
            removed = count(gone)
            ends = np.cumsum(np.diff(at) - removed).astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(data[~gone].tobytes())])
            if as_text:
                kept = pa.array([b.decode("utf-8", "ignore") for b in kept.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.diff(at)), pa.array(removed), pa.array(count(heads)), kept], names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, schema)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(staging.documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
