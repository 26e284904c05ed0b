"""Unigram tokenisation with a SentencePiece vocabulary: Viterbi over a double-array trie.

White space is escaped as in SentencePiece: a blank in front of the text, and every blank is part of
the piece after it. The best segmentation has the greatest sum of log scores; a character that no
piece begins with its own is taken at ``PENALTY`` below the least score and written as byte pieces.
Ties go to the longer last piece. Normalisation is the identity, so decoding returns every text
exactly, line ends, runs of blanks and the marker character itself included.

No piece has a blank after another character, so a text is cut in front of each run of blanks and
the distinct parts of a batch are segmented once. All parts of a batch are searched at a time: the
trie is walked from every position in step, and the table of best sums is filled by end position. Parts
are cut further where no match goes across, as every segmentation has to, so that texts without blanks
have short parts too; only in a text that matches cover without a gap (one letter a million times) the
search goes on byte by byte.

The vocabulary file holds merge ranks. Log scores are made from them by Zipf's law: the piece of rank
r has log(1 / (r + 1)), normalised.

Null text has null ids and a null decoded text. The empty text has no ids. Repeated rows are encoded
alike. A text of any length is encoded as a whole. Other columns are kept; only ids and decoded are
replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from liftwork.llm import staging
from liftwork.llm.textbuf import slices, text_bytes

VOCABULARY = "piece_bpe_32k.model"
PENALTY = 10.0
#: Bytes of distinct parts that are searched at a time.
BLOCK = 1 << 17
MARKER = "▁"


class DoubleArrayTrie:
    """Byte trie in two arrays: the child of state s by byte c is base[s] + c + 1 if check there is s."""

    def __init__(self, keys: list[bytes], values: list[int]):
        children: list[dict[int, int]] = [{}]
        value_of = [-1]
        for key, value in zip(keys, values, strict=True):
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    value_of.append(-1)
                node = children[node][c]
            value_of[node] = value
        size = len(children) + 1024
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[0] = True
        place, lowest, hint, todo = {0: 0}, 258, 1, [0]
        while todo:
            node = todo.pop()
            state = place[node]
            self.value[state] = value_of[node]
            codes = np.array(sorted(children[node]), np.int64) + 1
            if not len(codes):
                continue
            if max(hint, lowest) + 600 > len(used):
                grow = len(used)
                used = np.concatenate([used, np.zeros(grow, bool)])
                self.base, self.check, self.value = (np.concatenate([a, np.full(grow, f, np.int32)]) for a, f in ((self.base, 0), (self.check, -1), (self.value, -1)))
            if len(codes) == 1:  # one child goes to the first free place, several to the first fit after the last ones
                while used[lowest]:
                    lowest += 1
                base = lowest - int(codes[0])
            else:
                while used[hint + codes].any():
                    hint += 1
                base = hint
            self.base[state] = base
            used[base + codes] = True
            self.check[base + codes] = state
            for c in codes:
                child = children[node][int(c) - 1]
                place[child] = base + int(c)
                todo.append(child)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        to = self.base[states] + codes.astype(np.int32) + 1
        return np.where(self.check[np.minimum(to, len(self.check) - 1)] == states, to, -1)


def _cut(at: np.ndarray, start: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of parts that are cut wherever no match goes across as well, and the part of every byte."""
    across = np.zeros(n + 1, np.int64)
    np.add.at(across, start + 1, 1)
    np.add.at(across, stop, -1)
    free = np.cumsum(across) == 0
    free[at] = True
    free[n] = True
    cuts = np.flatnonzero(free)
    empty = at[:-1][np.diff(at) == 0]
    at = np.sort(np.concatenate([cuts, empty]))
    return at, np.repeat(np.arange(len(at) - 1), np.diff(at))


class Unigram:
    """Vocabulary, trie and scores."""

    _loaded: dict[str, Unigram] = {}

    def __init__(self, pieces: list[tuple[int, bytes, float]], raw: dict[int, int], size: int):
        """``pieces``: (id, bytes with blanks, log score); ``raw``: the id of each single byte."""
        self.trie = DoubleArrayTrie([b for _, b, _ in pieces], [i for i, _, _ in pieces])
        self.score = np.zeros(size)
        spelled = [b""] * size
        for i, b, s in pieces:
            self.score[i], spelled[i] = s, b
        for byte, i in raw.items():
            spelled[i] = bytes([byte])
        self.fallback = min(s for _, _, s in pieces) - PENALTY
        self.raw = np.array([raw[b] for b in range(256)], np.int64)
        self.spelled = pa.array(spelled, pa.binary())

    @classmethod
    def load(cls, vocabulary: str) -> Unigram:
        if vocabulary not in cls._loaded:
            import public_tokenizers
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
            size = model.get_piece_size()
            raw = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
            plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
            plain.sort(key=lambda i: (-model.get_score(i), i))
            rank = np.arange(1, len(plain) + 1)
            score = -np.log(rank + 1.0) - np.log((1 / (rank + 1.0)).sum())
            cls._loaded[vocabulary] = cls([(i, model.id_to_piece(i).replace(MARKER, " ").encode(), float(s)) for i, s in zip(plain, score, strict=True)], raw, size)
        return cls._loaded[vocabulary]

    def segment(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after the other, and the number of ids of each part."""
        n, parts = len(data), len(at) - 1
        part = np.repeat(np.arange(parts), np.diff(at))
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        ends_of = at[1:][part]
        starts, stops, ids = [], [], []
        where, state = leads, np.zeros(len(leads), np.int32)
        depth = 0
        while len(where):
            inside = where + depth < ends_of[where]
            where, state = where[inside], state[inside]
            state = self.trie.step(state, data[where + depth])
            on = state >= 0
            where, state = where[on], state[on]
            depth += 1
            found = self.trie.value[state]
            hit = found >= 0
            starts.append(where[hit])
            stops.append(where[hit] + depth)
            ids.append(found[hit].astype(np.int64))
        char_end = np.minimum(np.append(leads[1:], n), ends_of[leads]) if len(leads) else leads
        whole = np.zeros(n + 1, bool)
        for s, e in zip(starts, stops, strict=True):
            single = np.searchsorted(leads, s)
            whole[s[char_end[single] == e]] = True
        alone = ~whole[leads]
        starts.append(leads[alone])
        stops.append(char_end[alone])
        ids.append(np.full(int(alone.sum()), -1, np.int64))
        start, stop, piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, stops, ids))
        given, at, part = at, *_cut(at, start, stop, n)
        parts = len(at) - 1
        gain = np.where(piece >= 0, self.score[piece], self.fallback)
        far = stop - at[:-1][part[start]]
        order = np.lexsort((start, stop, far))
        start, stop, piece, gain, far = start[order], stop[order], piece[order], gain[order], far[order]
        # positions get one slot more a part: its begin has a sum of its own
        slot = lambda position, of: position + of
        best = np.full(n + parts + 1, -np.inf)
        best[slot(at[:-1], np.arange(parts))] = 0.0
        came = np.full(n + parts + 1, -1, np.int64)
        of = part[start]
        cuts = np.searchsorted(far, np.arange(1, (int(far[-1]) if len(far) else 0) + 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            total = best[slot(start[a:b], of[a:b])] + gain[a:b]
            to = slot(stop[a:b], of[a:b])
            first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(total, first) if b > a else total
            if b > a:
                size = np.diff(np.append(first, b - a))
                edge = np.flatnonzero(total == np.repeat(top, size))  # by start: the longest of equals comes first
                group = np.repeat(np.arange(len(first)), size)[edge]
                lead = edge[np.concatenate([[True], group[1:] != group[:-1]])]
                best[to[first]] = top
                came[to[first]] = lead + a
        tokens, owners, step = [], [], 0
        current, owner = at[1:].copy(), np.arange(parts)
        going = current > at[:-1]
        current, owner = current[going], owner[going]
        while len(current):
            edge = came[slot(current, owner)]
            tokens.append(edge)
            owners.append(owner)
            current = start[edge]
            going = current > at[:-1][owner]
            current, owner = current[going], owner[going]
            step += 1
        if not tokens:
            return np.zeros(0, np.int64), np.zeros(len(given) - 1, np.int64)
        level = np.repeat(np.arange(step), [len(t) for t in tokens])
        edge, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.lexsort((-level, owner))
        edge, owner = edge[order], owner[order]
        width = np.where(piece[edge] >= 0, 1, stop[edge] - start[edge])
        total = np.cumsum(width)
        inner = np.arange(total[-1]) - np.repeat(total - width, width)
        spread = np.repeat(edge, width)
        out = np.where(piece[spread] >= 0, piece[spread], self.raw[data[np.minimum(start[spread] + inner, n - 1)]])
        of_given = np.searchsorted(given, at[:-1], "right") - 1
        return out, np.bincount(of_given[np.repeat(owner, width)], minlength=len(given) - 1)

    def segmented(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``segment`` over blocks of about BLOCK bytes, so that the tables of a search stay small."""
        found, begin = [], 0
        while begin < len(at) - 1:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + BLOCK, "right")) - 1)
            found.append(self.segment(data[at[begin] : at[end]], at[begin : end + 1] - at[begin]))
            begin = end
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """list<int32> of each text; null stays null."""
        given = pc.fill_null(texts, "")
        words = pc.split_pattern(given, " ")
        flat, ends = words.flatten(), words.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        coded = pc.dictionary_encode(flat)
        # a run of blanks leaves empty words: it is one part with the word after it
        code = coded.indices.to_numpy().astype(np.int64)
        size = pc.binary_length(pc.cast(flat, pa.binary())).to_numpy().astype(np.int64)
        last = np.zeros(len(flat), bool)
        last[ends[1:] - 1] = True
        closes = (size > 0) | last
        index = np.arange(len(flat))
        previous = np.maximum.accumulate(np.where(closes, index, -1))
        opened = np.concatenate([[-1], previous[:-1]])
        blanks = (index - opened)[closes]  # this many blanks stand before the word
        empty = (pc.binary_length(pc.cast(given, pa.binary())).to_numpy() == 0)
        row = np.repeat(np.arange(len(texts)), np.diff(ends))[closes]
        key = blanks * (len(coded.dictionary) + 1) + code[closes]
        used, back = np.unique(key, return_inverse=True)
        entries = coded.dictionary.take(pa.array(used % (len(coded.dictionary) + 1))).to_pylist()
        parts = pa.array([" " * int(b) + e for b, e in zip(used // (len(coded.dictionary) + 1), entries, strict=True)], pa.string())
        data, at = text_bytes(parts)
        ids, n = self.segmented(data, at)
        begin = np.cumsum(n) - n
        take = n[back]
        take = np.where(empty[row], 0, take)
        total = np.cumsum(take)
        whole = ids[np.arange(total[-1] if len(total) else 0) + np.repeat(begin[back] - (total - take), take)]
        per_row = np.bincount(row, weights=take, minlength=len(texts)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
        mask = pc.is_null(texts)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole, pa.int32()), mask=mask if texts.null_count else None)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The texts of lists of ids."""
        flat = self.spelled.take(ids.flatten())
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, flat), b"")
        data, at = text_bytes(joined)
        size = np.diff(at)
        stay = np.ones(len(data), bool)
        stay[at[:-1][size > 0]] = False  # the blank in front of the text
        ends = np.cumsum(np.maximum(size - 1, 0))
        plain = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(data[stay].tobytes())])
        return pc.if_else(pc.is_null(ids), pa.scalar(None, pa.string()), plain)


def encoded(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the column ids in the text's place."""
    names = [c for c in docs.columns if c not in (text, "ids")]
    given = docs.select(*names, F.col(text).cast("string").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram.load(vocabulary)
        for batch in slices(batches, text, 4 << 20):
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), model.encode(batch.column(text))], names=[*names, "ids"])

    return given.mapInArrow(run, given.drop(text).schema.add("ids", ArrayType(IntegerType())))


def decoded(docs: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the column decoded added."""
    names = [c for c in docs.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram.load(vocabulary)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), model.decode(part.column(ids))], names=[*names, "decoded"])

    given = docs.select(*names)
    return given.mapInArrow(run, StructType([*given.schema.fields, StructField("decoded", StringType())]))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, their number, and whether they decode to the text."""
    docs = staging.documents(spark, sf_dir).select("doc_id", "text", F.xxhash64("text").alias("before"))
    back = decoded(encoded(docs))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.xxhash64("decoded").eqNullSafe(F.col("before")).alias("round_trip"))
