"""Near duplicates by the chosen-path similarity join over minwise tokens.

Documents with equal shingle sets form a class; classes are joined, not copies. In each of ``TREES``
independent trees the classes of a node branch by pairs of coordinates of their minwise signature, the
same pairs for the whole node: classes with equal tokens go down together. A node of at most ``LEAF``
classes is compared exhaustively by signatures, a larger one branches again. Pairs whose signatures
differ too much are dropped (4.5 sigma under the wanted similarity); the others are confirmed on full
shingle sets.

A node of over ``DENSE`` classes most of which resemble its first member is dense, as is one with over
``MANY`` candidate pairs a member: its number of links can be the square of its size. Only links that
join two components are looked for in it. Its members are dealt to chunks of about ``CHUNK``, each
together with a few representatives of the node, and every pair of a chunk that is not in one component
yet is compared. The members that are then joined to the most frequent representative are done with each other; the
rest is compared with all members, in blocks. So every pair of members ends in one component or has been
compared, and the work is the square of the node's size only where the node falls apart. Components of
all links follow.

A pair at the similarity limit survives a tree with a probability of about 0.93, and all ``TREES``
trees miss it with a chance below 1e-4. ``LEAF``, ``DENSE``, ``MANY``, ``CHUNK``, ``NODE`` and ``DEPTH`` choose
how pairs are compared, not which; nodes of very many members are dealt over several tasks wherever rows
meet by node.

What is shuffled is kept small. Nodes are built from ids alone, and signatures join the members of nodes that have
several. Texts are shuffled rather than their sets, which are several times as large and are made again where they
are compared, and only texts of classes with candidates are: ``likely`` leaves out nearly all others as the documents are read.

Null or blank texts have an empty set and are linked with nothing. Rows with a null doc_id are kept,
with a null component, and take no part. Rows that repeat a doc_id are documents of their own, each with
the component of its text. Equal rows are copies of each other. Other columns of the input do not matter,
whatever their names. A text is worked on as a whole, however long: some 60 bytes of arrays for each of
its bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.components import Spread, connected, shares
from liftwork.llm.groups import batched, tables
from liftwork.llm.textbuf import LOWER, RollingHash, mix, slices, text_bytes, word_spans

COORDINATES = 64
TREES = 4
BRANCHES = 4
DEEPER = 3
LEAF = 512
DENSE = 24
#: Members of a dense node that come together at first, and representatives that join every chunk.
CHUNK, FIRST = 512, 8
#: Members of a dense node that the rest of it is compared with at a time.
NODE = 2048
DEPTH = 16
#: Coordinates of the signatures that members of a dense node are told apart by.
FINE = 128
#: Candidate pairs a member beyond which a small node counts as dense.
MANY = 3
#: Bits for each wanted key of ``likely``, and the most words of 64 bits; with fewer bits more other rows stay.
BITS, BIT_WORDS = 16, 1 << 19


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct word shingles (64-bit hashes), sorted by row and value, with the row of each."""
    data, at = text_bytes(column)
    data = LOWER[data] if len(data) else data
    begin, end, row = word_spans(data, at)
    rows = len(at) - 1
    words = mix(RollingHash(data).ranges(begin, end))
    n = np.bincount(row, minlength=rows)
    with np.errstate(over="ignore"):
        full = len(words) - width + 1
        if full > 0:
            value = words[:full].copy()
            for k in range(1, width):
                value = mix(value * np.uint64(3)) + words[k : k + full]
            whole = row[:full] == row[width - 1 :]
            value, of = mix(value[whole]), row[:full][whole]
        else:
            value, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        few = np.flatnonzero((n > 0) & (n < width))
        if len(few):
            first = np.searchsorted(row, few)
            short = words[first].copy()
            for k in range(1, width - 1):
                more = n[few] > k
                short[more] = mix(short[more] * np.uint64(3)) + words[first[more] + k]
            value = np.concatenate([value, mix(short ^ n[few].astype(np.uint64))])
            of = np.concatenate([of, few])
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], of[new], rows


_SEEDS = mix(np.arange(1, 2 * FINE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def minwise(value: np.ndarray, of: np.ndarray, rows: int, coordinates: int = COORDINATES) -> np.ndarray:
    """rows x coordinates: 16 bits of the least 32-bit hash; rows without shingles hold zeros."""
    out = np.zeros((rows, coordinates), np.uint16)
    if len(value):
        there, first = np.unique(of, return_index=True)
        with np.errstate(over="ignore"):
            for c in range(coordinates):
                hashed = ((value * (_SEEDS[2 * c] | np.uint64(1)) + _SEEDS[2 * c + 1]) >> np.uint64(32)).astype(np.uint32)
                out[there, c] = np.minimum.reduceat(hashed, first) & 0xFFFF
    return out


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of raw bytes; ``ends``: the end of each row within ``values``, in bytes."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _fingerprint(value: np.ndarray, of: np.ndarray, rows: int) -> np.ndarray:
    """2 x rows: 128 bits of each set."""
    sums = np.zeros((2, rows), np.uint64)
    np.add.at(sums[0], of, mix(value))
    np.add.at(sums[1], of, mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return sums.view(np.int64)


def signatures(docs: DataFrame, width: int = 2) -> DataFrame:
    """(doc_id, text_hash, n_shingles, h1, h2, sig): set size, 128-bit set fingerprint and minwise signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            value, of, rows = shingle_sets(batch.column("text"), width)
            n = np.bincount(of, minlength=rows)
            sig = minwise(value, of, rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), *map(pa.array, _fingerprint(value, of, rows)), _binary(sig, (np.arange(rows) + 1) * sig.shape[1] * 2)],
                names=["doc_id", "text_hash", "n_shingles", "h1", "h2", "sig"],
            )

    text = F.col("text").cast("string")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return given.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, sig binary")


def sets(batches: Iterator[pa.RecordBatch], column: str, width: int) -> list[np.ndarray]:
    """The shingle set of each row, as sorted 64-bit values."""
    out: list[np.ndarray] = []
    for batch in slices(batches, column):
        value, of, rows = shingle_sets(batch.column(column), width)
        out += np.split(value, np.cumsum(np.bincount(of, minlength=rows))[:-1])
    return out


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among those of ``wanted``, and a few others, without a shuffle of ``rows``.

    Wanted keys are marked in a table of bits, one bit each; rows at a bit that is not set are left out.
    """
    words = max(1, min(BIT_WORDS, wanted.count() * BITS // 64))
    hashed = F.xxhash64(key)
    word, bit = F.pmod(hashed, F.lit(words)), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int"))
    marks = wanted.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_marks"))
    kept = rows.withColumn("_word", word).join(F.broadcast(marks), "_word").where(F.col("_marks").bitwiseAND(bit) != 0)
    return kept.drop("_word", "_marks")


def texts_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, text) of the classes (id, doc_id, text_hash), which name the document and the hash of its text."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = likely(given, "doc_id", classes).withColumn("text_hash", F.xxhash64("text"))
    once = some.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    return once.join(classes.hint("merge"), ["doc_id", "text_hash"]).select("id", "text")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ta"):
            hit = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(sets([batch], "ta", width), sets([batch], "tb", width), strict=True)):
                common = int(_common(x, [y])[0])
                hit[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(hit))

    left, right = (texts.select(F.col("id").alias(k), F.col("text").alias(f"t{k}")) for k in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _least_agreement(percent: int, coordinates: int = COORDINATES) -> int:
    j = percent / 100
    return max(1, int(coordinates * j - 4.5 * (coordinates * j * (1 - j)) ** 0.5))


def _at(sig: Column, coordinate: Column) -> Column:
    """One coordinate of a binary signature."""
    return F.substring(sig, coordinate * 2 + 1, F.lit(2))


def _branch(nodes: DataFrame, count: int) -> DataFrame:
    """The children (path, id) of all members: one row a chosen pair of coordinates."""
    chosen = nodes.withColumn("k", F.explode(F.array(*(F.lit(k) for k in range(count)))))
    first = F.pmod(F.xxhash64("path", "k"), F.lit(COORDINATES)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("k", "path"), F.lit(COORDINATES - 1)).cast("int"), F.lit(COORDINATES))
    return chosen.select(F.xxhash64("path", "k", _at(F.col("sig"), first), _at(F.col("sig"), second)).alias("path"), "id")


def _alike(a: str, b: str, percent: int) -> Column:
    """Set sizes allow the similarity."""
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)


def _agreement(x: Column, y: Column) -> Column:
    """Number of equal coordinates."""
    return sum((F.substring(x, 2 * c + 1, 2) == F.substring(y, 2 * c + 1, 2)).cast("int") for c in range(COORDINATES))


def _with_sizes(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``nodes`` (path, id) of several members with size, first member, and salt and spread, their share of a hot node and the number of shares.

    The set size n and the signature of ``classes`` join last: most nodes have a single member.
    """
    sizes = staging.stored(nodes.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first")).where("size > 1"), "near-sizes")
    spread = Spread(sizes, "path", "size")
    return spread.dealt(nodes, "path", F.col("id")).join(spread.copied(sizes, "path"), ["path", "salt"]).join(classes, "id")


def _leaf_pairs(leaves: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of small nodes: all pairs of a node that sizes and signatures allow.

    Of a node with over MANY pairs a member only its path is returned.
    """
    least = _least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if rest is not None and rest.num_rows:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            path = batch.column("path").to_numpy()
            cut = int(np.searchsorted(path, path[-1], "left")) if len(path) else 0
            rest = batch.slice(cut)
            yield from pairs(batch.slice(0, cut))
        if rest is not None:
            yield from pairs(rest)

    def pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows < 2:
            return
        path, ids, n = (batch.column(c).to_numpy() for c in ("path", "id", "n"))
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, COORDINATES)
        found, first = [], np.concatenate([[0], np.flatnonzero(path[1:] != path[:-1]) + 1])
        node = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(path))))
        for step in range(1, LEAF):  # members of a node stand together: compare each with the one `step` rows on
            if step >= len(path):
                break
            left = np.flatnonzero(path[:-step] == path[step:])
            if not len(left):
                break
            right = left + step
            fits = np.minimum(n[left], n[right]) * 100 >= np.maximum(n[left], n[right]) * percent
            left, right = left[fits], right[fits]
            close = (sig[left] == sig[right]).sum(axis=1) >= least
            found.append(np.stack([ids[left[close]], ids[right[close]], node[left[close]]]))
        if found:
            a, b, of = np.concatenate(found, axis=1)
            many = np.bincount(of, minlength=len(first)) > MANY * np.bincount(node)
            both = np.unique(np.sort(np.stack([a, b])[:, ~many[of]], axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.nulls(both.shape[1], pa.int64())], names=["a", "b", "path"])
            heavy = pa.array(path[first[many]])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(heavy), pa.int64()), pa.nulls(len(heavy), pa.int64()), heavy], names=["a", "b", "path"])

    return leaves.select("path", "id", "n", "sig").repartition("path").sortWithinPartitions("path", "id").mapInArrow(run, "a long, b long, path long")


def _common(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others, none of them empty."""
    flat = np.concatenate(others)
    hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
    return np.add.reduceat(hit, np.cumsum([0, *map(len, others[:-1])]), dtype=np.int64)


def spanning(ids: np.ndarray, sets: list[np.ndarray], percent: int, group: np.ndarray | None = None, asking: np.ndarray | None = None) -> np.ndarray:
    """The group of each member after all links between members have joined theirs.

    Every pair of members that is not joined yet is compared, with signatures of FINE coordinates first.
    ``group``: members with equal labels are joined already. ``asking``: only pairs with such a member count.
    """
    size = np.array([len(s) for s in sets])
    sig = minwise(np.concatenate(sets), np.repeat(np.arange(len(sets)), size), len(sets), FINE)
    least = _least_agreement(percent, FINE)
    group = np.arange(len(ids)) if group is None else group.copy()

    def join(i: int, there: np.ndarray, most: int | None = None) -> None:
        there = there[np.minimum(size[there], size[i]) * 100 >= np.maximum(size[there], size[i]) * percent]
        agreement = np.concatenate([(sig[part] == sig[i]).sum(axis=1) for part in np.array_split(there, len(there) // 4096 + 1)])
        order = np.argsort(-agreement, kind="stable")
        there = there[order[agreement[order] >= least]][:most]
        step = 4
        while len(there):
            part, there, step = there[:step], there[step:], min(2 * step, 256)
            common = _common(sets[i], [sets[j] for j in part])
            for j in part[100 * common >= percent * (size[i] + size[part] - common)]:
                if group[j] != group[i]:
                    group[group == group[i]] = group[j]
            there = there[group[there] != group[i]]

    if asking is not None:
        for i in np.flatnonzero(asking):
            join(i, np.flatnonzero(group != group[i]))
        return group
    big = group[0]  # the label of a large component: a few of its members are tried first
    for i in range(1, len(ids)):
        if i > 64 and group[i] != big:
            some = np.flatnonzero(group[:i] == big)
            join(i, some[:: max(1, len(some) // 32)], 4)
        join(i, np.flatnonzero(group[:i] != group[i]))
        big = group[i] if (group[: i + 1] == group[i]).sum() * 2 > i else big
    return group


def _star(ids: np.ndarray, group: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links of every member with one of its group: the smallest id of those ``first``, of all if there are none."""
    order = np.lexsort((ids, ~first, group))
    lead = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    head = ids[order][np.maximum.accumulate(np.where(lead, np.arange(len(ids)), 0))]
    for a, b in zip(head[~lead].tolist(), ids[order][~lead].tolist(), strict=True):
        yield a, b


_LINKS = "a long, b long"
_LINK_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _chunk_links(members: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """(path, a, b): links of members b of dense nodes (path, id, size, salt, spread) with a member a of their component in a chunk.

    Every chunk holds the node's representatives too; ``a`` is the first of them if one is in the component.
    """
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    least = [F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("h"), "id"))["id"].alias(f"r{k}") for k in range(FIRST)]
    chosen = members.groupBy("path", "size").agg(*least).select("path", F.explode(F.array_distinct(F.array(*(f"r{k}" for k in range(FIRST))))).alias("id"), chunks.alias("chunks"))
    every = chosen.select("path", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "id")
    dealt = members.select("path", F.pmod(F.xxhash64("id"), chunks).cast("int").alias("chunk"), "id", F.lit(False).alias("rep")).unionByName(every.withColumn("rep", F.lit(True)))
    dealt = dealt.groupBy("path", "chunk", "id").agg(F.max("rep").alias("rep"))
    whole = dealt.join(texts, "id").select("path", "chunk", "id", "rep", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for rows in tables(batches, 2):
                path, ids, rep = rows["path"][0].as_py(), rows["id"].to_numpy(), rows["rep"].to_numpy()
                for a, b in _star(ids, spanning(ids, sets(rows.to_batches(), "text", width), percent), rep):
                    yield path, a, b

        yield from batched(found(), pa.schema([("path", pa.int64()), *_LINK_SCHEMA]))

    return whole.repartition("path", "chunk").sortWithinPartitions("path", "chunk", "id").mapInArrow(run, "path long, " + _LINKS)


def _rest_links(members: DataFrame, texts: DataFrame, chunked: DataFrame, percent: int, width: int) -> DataFrame | None:
    """Links that members of dense nodes have with others of their node, if they are not joined to its most frequent representative.

    ``chunked``: the links of chunks. Only nodes of several chunks are looked at. None without such members.
    """
    large = members.where(F.col("size") > CHUNK)  # one chunk holds all others
    if large.isEmpty():
        return None
    heads = chunked.groupBy("path", F.col("b").alias("id")).agg(F.min("a").alias("component"))
    told = large.join(heads, ["path", "id"], "left").withColumn("component", F.coalesce("component", "id"))
    told = staging.stored(told.select("path", "id", "size", "salt", "spread", "component"), "near-told")
    counts = told.groupBy("path", "spread", "component").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("path", "spread").agg(F.max(F.struct("c", "component"))["component"].alias("main"))
    marked = told.join(shares(main).drop("spread"), ["path", "salt"]).withColumn("asks", F.col("component") != F.col("main"))
    rests = marked.groupBy("path", "spread").agg(F.count_if("asks").alias("rest")).where("rest > 0")
    rests = staging.stored(rests, "near-rests")
    if rests.isEmpty():
        return None
    left = marked.join(shares(rests).drop("spread"), ["path", "salt"])
    rows, columns = F.ceil(F.col("rest") / NODE).cast("int"), F.ceil(F.col("size") / NODE).cast("int")
    kept = ("path", "id", "component")
    hashed = F.xxhash64("id")
    asking = left.where("asks").select(*kept, F.pmod(hashed, rows).cast("int").alias("row"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("column"), F.lit(True).alias("asks"))
    asked = left.select(*kept, F.explode(F.sequence(F.lit(0), rows - 1)).alias("row"), F.pmod(hashed, columns).cast("int").alias("column"), F.lit(False).alias("asks"))
    both = asking.unionByName(asked).groupBy(*kept, "row", "column").agg(F.max("asks").alias("asks"))
    whole = both.join(texts, "id").select("path", "row", "column", "id", "component", "asks", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for rows in tables(batches, 3):
                names, labels = np.unique(rows["component"].to_numpy(), return_inverse=True)
                joined = spanning(rows["id"].to_numpy(), sets(rows.to_batches(), "text", width), percent, labels, rows["asks"].to_numpy())
                # a link for each component that was joined with another one
                lead = np.unique(labels, return_index=True)[1]
                yield from _star(names, joined[lead], np.zeros(len(names), bool))

        yield from batched(found(), _LINK_SCHEMA)

    return whole.repartition("path", "row", "column").sortWithinPartitions("path", "row", "column", "id").mapInArrow(run, _LINKS)


def _candidates(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of classes, and the members (path, id, size, salt, spread) of dense nodes."""
    signed = classes.select("id", F.col("n_shingles").alias("n"), "sig")
    roots = signed.select(F.explode(F.array(*(F.lit(t) for t in range(TREES)))).alias("tree"), "id", "sig")
    level = _branch(roots.select(F.xxhash64("tree").alias("path"), "id", "sig"), BRANCHES)
    candidates, dense, done = [], [], []
    member = ("path", "id", "size", "salt", "spread")
    for depth in range(DEPTH):
        nodes = staging.stored(_with_sizes(level, signed), "near-nodes")
        large = nodes.where(F.col("size") > DENSE)
        pivot = shares(large.where("id = first").select("path", "spread", F.col("n").alias("pn"), F.col("sig").alias("psig"))).drop("spread")
        near = large.join(pivot, ["path", "salt"]).withColumn("close", (_agreement(F.col("sig"), F.col("psig")) >= _least_agreement(percent)) & _alike("n", "pn", percent))
        thick = near.groupBy("path", "spread").agg(F.avg(F.col("close").cast("int")).alias("share")).where("share > 0.5").select("path", "spread", F.lit(True).alias("thick"))
        thick = staging.stored(shares(thick).drop("spread"), "near-thick")
        told = nodes.join(thick, ["path", "salt"], "left").withColumn("thick", F.coalesce("thick", F.lit(False)))
        last = depth == DEPTH - 1
        dense.append(told.where(F.col("thick") | (F.lit(last) & (F.col("size") > LEAF))).select(*member))
        small = told.where(~F.col("thick") & (F.col("size") <= LEAF))
        told_pairs = staging.stored(_leaf_pairs(small, percent).distinct(), "near-leaf-pairs")
        candidates.append(told_pairs.where("path is null").select("a", "b"))
        dense.append(small.join(told_pairs.where("path is not null").select("path"), "path", "left_semi").select(*member))
        thin = staging.stored(told.where(~F.col("thick") & (F.col("size") > LEAF)).select("path", "id", "n", "sig"), "near-thin")
        done += [nodes, thin]
        if thin.isEmpty() or last:
            break
        level, signed = _branch(thin, DEEPER), thin.select("id", "n", "sig").dropDuplicates(["id"])
    pairs, members = reduce(DataFrame.unionByName, candidates), reduce(DataFrame.unionByName, dense)
    pairs, members = staging.stored(pairs.distinct(), "near-pairs"), staging.stored(members, "near-dense")
    staging.drop(*done)
    staging.release(classes.sparkSession)
    # nodes with the same members are looked at once
    prints = members.groupBy("path", "size", "spread").agg(F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("h")).groupBy("size", "h").agg(F.min(F.struct("path", "spread")).alias("m"))
    once = shares(prints.select("m.path", "m.spread")).drop("spread")
    return pairs, members.join(once, ["path", "salt"], "left_semi")


def linked(docs: DataFrame, percent: int = 80, width: int = 2) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row of ``docs``; text_hash: xxhash64 of the text."""
    table = staging.stored(signatures(docs, width), "near-signatures")
    some = table.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("sig").alias("sig"))
    # ids are given once, as the table is written
    classes = classes.select("h1", "h2", "n_shingles", F.col("least.doc_id").alias("first"), "least.text_hash", "sig", F.monotonically_increasing_id().alias("id"))
    classes = staging.stored(classes, "near-classes")
    pairs, members = _candidates(classes, percent)
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(members.select("id")).distinct()
    needed = staging.stored(classes.join(needed, "id", "left_semi").select("id", F.col("first").alias("doc_id"), "text_hash"), "near-needed")
    texts = staging.stored(texts_of(docs, needed), "near-texts")
    chunked = staging.stored(_chunk_links(members, texts, percent, width), "near-chunks")
    staging.release(docs.sparkSession)
    links = confirmed(pairs, texts, percent, width).unionByName(chunked.select("a", "b"))
    rest = _rest_links(members, texts, chunked, percent, width)
    links = staging.stored((links if rest is None else links.unionByName(rest)).distinct(), "near-links")
    staging.drop(texts)
    staging.release(docs.sparkSession)
    return _labelled(table, classes, connected(links))


def _labelled(table: DataFrame, classes: DataFrame, components: DataFrame) -> DataFrame:
    """The rows of ``table`` with the smallest doc_id of their component."""
    linked_ = staging.stored(components.join(classes.select(F.col("id").alias("node"), "first"), "node"), "near-linked")
    least = linked_.groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n"))
    spread = Spread(least, "component", "n")
    least = spread.dealt(linked_, "component", F.col("node")).join(spread.copied(least.drop("n"), "component"), ["component", "salt"])
    class_of = classes.join(least.select(F.col("node").alias("id"), "least"), "id", "left")
    class_of = staging.stored(class_of.select("h1", "h2", F.col("n_shingles").alias("n"), F.coalesce("least", "first").alias("least")), "near-labels")
    rows = table.select("doc_id", "text_hash", "n_shingles", "h1", "h2")
    on = (rows["h1"] == class_of["h1"]) & (rows["h2"] == class_of["h2"]) & (rows["n_shingles"] == class_of["n"])
    whole = rows.join(class_of, on, "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("least", "doc_id"))
    return whole.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(staging.documents(spark, sf_dir), percent=80, width=2).select("doc_id", "n_shingles", "component_id", "kept")
