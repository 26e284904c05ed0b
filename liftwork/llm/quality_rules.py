"""Quality rules whose cutoffs adapt to each language and source.

Every document gets a few integer signals. Fixed-width histogram sketches of the signals (per
language, source and signal; they merge by adding counts) give the median and the quantiles of both tails,
and from these a lower and an upper limit per group: the median minus or plus a multiple of the distance to
the first quantile on that side that differs from it (``TAILS``: six times the one 10 per cent from the end, else
the one 5 per cent from the end; ``FLOOR`` buckets at least). So the limit of a signal that is 0 for most texts comes
from those texts of the group where it is not, and is ``FLOOR`` only where they are fewer than one in twenty or hardly differ. A document is kept if the base rule holds and no signal passes the
limit of its group. Groups with fewer than ``min_group`` documents that pass the base rule (``MIN_GROUP``: too few
for a quantile of 10 per cent) take the limits of their language, and those of the whole table where the
language is small too.

Null text counts as empty and fails the base rule. Null language or source form a group of their
own; a group without documents that pass the base rule has no limits and needs none. A value at a limit is
kept. Repeated rows are rows like others. A text of any length is counted as a whole, some 60 bytes of
arrays for each of its bytes. Other columns do not matter, whatever their names. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.textbuf import RollingHash, mix, per_row, slices, text_bytes, word_spans

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: signal -> SQL integer expression, the bucket of the sketch. Shares are per mille, the word length is in tenths of a character.
SIGNALS = {
    "symbol_share": "n_symbols * 1000 div greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words * 1000 div greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines * 1000 div greatest(n_words, 1)",
    "word_length": "least(word_chars * 10 div greatest(n_words, 1), 2000)",
}
#: Tails of a sketch, in per mille, and how many times their distance to the median is the limit.
TAILS = ((100, 6), (50, 1))
#: Buckets beside the median that are within the limits at least where 90 of 100 texts have the median.
FLOOR = 6
MIN_GROUP = 100
MIN_WORDS = 50


def _doubles(keys: np.ndarray) -> np.ndarray:
    """Which entries occur more than once, by position."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _later(keys: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    out = np.zeros(len(keys), bool)
    out[order[1:][ranked[1:] == ranked[:-1]]] = True
    return out


def count_batch(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every row of a text column."""
    data, at = text_bytes(column)
    rows = len(at) - 1
    begin, end, row = word_spans(data, at)
    rolling = RollingHash(data)
    hashed = mix(rolling.ranges(begin, end))
    n_words = np.bincount(row, minlength=rows)
    repeated = np.zeros(len(begin), bool)
    if len(begin) > 2:
        with np.errstate(over="ignore"):
            threes = hashed[:-2] * np.uint64(3) + mix(hashed[1:-1]) * np.uint64(5) + mix(mix(hashed[2:])) * np.uint64(7)
            whole = np.flatnonzero(row[:-2] == row[2:])
            keys = mix(threes[whole] ^ mix(row[whole].astype(np.uint64) + np.uint64(1)))
        twice = whole[_doubles(keys)]
        for k in range(3):
            repeated[twice + k] = True
    breaks = np.flatnonzero(data == 10)
    line_begin = np.union1d(breaks + 1, at[:-1])
    line_begin = line_begin[line_begin < len(data)]
    line_row = np.searchsorted(at, line_begin, "right") - 1
    line_end = np.append(line_begin[1:], len(data))
    closed = (line_end > line_begin) & (data[line_end - 1] == 10) if len(line_begin) else np.zeros(0, bool)
    line_end = line_end - closed
    words_before = np.searchsorted(begin, line_begin)
    has_word = words_before < np.searchsorted(begin, line_end)
    line_begin, line_end, line_row = line_begin[has_word], line_end[has_word], line_row[has_word]
    lines = mix(rolling.ranges(line_begin, line_end) ^ mix(line_row.astype(np.uint64) + np.uint64(1)))
    again = _later(lines)
    space_free = np.zeros(len(data) + 1, np.int64)
    np.add.at(space_free, begin, 1)
    np.add.at(space_free, end, -1)
    in_word = np.cumsum(space_free[:-1]) > 0
    return {
        "n_words": n_words,
        "word_chars": per_row(in_word & ((data & 0xC0) != 0x80), at),
        "n_symbols": per_row(SYMBOLS[data], at),
        "n_dup_lines": np.bincount(line_row[again], minlength=rows),
        "n_repeat_words": np.bincount(row[repeated], minlength=rows),
    }


def with_counts(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with the five counts of each row, without the text column if it is not to be kept."""
    kept = [c for c in docs.columns if c not in COUNTS and (keep_text or c != text)]
    given = docs.select(*(c for c in kept if c != text), F.col(text).cast("string").alias(text))
    kept = [c for c in given.columns if c in kept]
    schema = given.select(*kept).schema
    for name in COUNTS:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            counts = count_batch(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(counts[c], pa.int64()) for c in COUNTS)], names=[*kept, *COUNTS]
            )

    return given.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def sketch(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Histogram sketches: a row (keys, signal, bucket, n). Only rows that pass the base rule are taken."""
    signals = F.array(*(F.struct(F.lit(s).alias("signal"), F.expr(e).cast("long").alias("bucket")) for s, e in SIGNALS.items()))
    rows = counted.where(~base_failed()).select(*keys, F.explode(signals).alias("s"))
    return rows.groupBy(*keys, "s.signal", "s.bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups; sketches of several tables merge likewise after a union."""
    return sketches.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))


def limits(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: n, and the lower and the upper limit of each signal, by the first of ``TAILS`` on that side that is not the median."""
    group = Window.partitionBy(*keys, "signal")
    summed = sketches.select(
        *keys, "signal", "bucket", F.sum("n").over(group).alias("total"),
        F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("up_to"),
    )
    at = lambda q: F.min(F.when(F.col("up_to") * 1000 >= F.col("total") * q, F.col("bucket")))
    tails = [at(q).alias(f"{name}{t}") for t, _ in TAILS for name, q in (("low", t), ("high", 1000 - t))]
    quantiles = summed.groupBy(*keys, "signal").agg(F.max("total").alias("n"), at(500).alias("mid"), *tails)
    mid = F.col("mid")
    far = lambda name: F.coalesce(*(F.when(F.col(f"{name}{t}") != mid, F.abs(F.col(f"{name}{t}") - mid) * times) for t, times in TAILS), F.lit(0))
    limit = lambda name: mid + F.greatest(far(name), F.lit(FLOOR)) * (1 if name == "high" else -1)
    edges = quantiles.select(*keys, "signal", "n", limit("low").alias("lo"), limit("high").alias("hi"))
    return edges.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *(f(F.when(F.col("signal") == s, F.col(c))).alias(f"{s}_{c}") for s in SIGNALS for c, f in (("lo", F.max), ("hi", F.max))),
    )


EDGES = [f"{s}_{c}" for s in SIGNALS for c in ("lo", "hi")]


def fitted(counted: DataFrame, lang: str = "lang", source: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """(g_lang, g_source, limits...): the limits of every group of ``counted`` that has documents which pass the base rule."""
    own = counted.select(F.col(lang).alias("_lang"), F.col(source).alias("_source"), *COUNTS)
    fine = staging.stored(sketch(own, ["_lang", "_source"]), "quality-sketch")
    levels = {
        "a": limits(fine, ["_lang", "_source"]).where(F.col("n") >= min_group),
        "b": limits(merged(fine, ["_lang"]), ["_lang"]).where(F.col("n") >= min_group),
        "c": limits(merged(fine, []), []),
    }
    groups = fine.select("_lang", "_source").distinct()
    a, b, c = (d.select(*[F.col(k).alias(f"{n}{k}") for k in d.columns]) for n, d in levels.items())
    found = (
        groups.join(a, groups["_lang"].eqNullSafe(a["a_lang"]) & groups["_source"].eqNullSafe(a["a_source"]), "left")
        .join(b, groups["_lang"].eqNullSafe(b["b_lang"]), "left")
        .join(F.broadcast(c), F.lit(True), "left")  # one row
    )
    return staging.stored(found.select(F.col("_lang").alias("g_lang"), F.col("_source").alias("g_source"), *(F.coalesce(f"a{e}", f"b{e}", f"c{e}").alias(e) for e in EDGES)), "quality-limits")


def judged(counted: DataFrame, limit: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``counted`` with base_failed and kept. ``limit`` has a row for each language and source."""
    edge = {e: staging.unused(counted.columns, e) for e in ("g_lang", "g_source", *EDGES)}
    limit = limit.select(*(F.col(e).alias(n) for e, n in edge.items()))
    passed = reduce(lambda x, y: x & y, (F.expr(e).between(F.col(edge[f"{s}_lo"]), F.col(edge[f"{s}_hi"])) for s, e in SIGNALS.items()))
    joined = counted.join(limit, counted[lang].eqNullSafe(limit[edge["g_lang"]]) & counted[source].eqNullSafe(limit[edge["g_source"]]), "left")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.coalesce(passed, F.lit(True))).drop(*edge.values())


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each document."""
    counted = staging.stored(with_counts(docs.select("doc_id", "lang", "source", "text")), "quality-counts")
    return judged(counted, fitted(counted))


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with lang, source and text) that are kept. Counts are made twice, so that no text is shuffled."""
    limit = fitted(with_counts(docs.select("lang", "source", "text")))
    return judged(with_counts(docs, keep_text=True), limit).where("kept").select(*docs.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(staging.documents(spark, sf_dir)).select("doc_id", *COUNTS, "base_failed", "kept")


_TAILS_SQL = ", ".join(f"min(bucket) filter (where up_to * 1000 >= total * {q}) as {name}{t}" for t, _ in TAILS for name, q in (("low", t), ("high", 1000 - t)))
_LIMIT_SQL = "mid {sign} greatest(case " + " ".join(f"when {{name}}{t} <> mid then abs({{name}}{t} - mid) * {times}" for t, times in TAILS) + f" else 0 end, {FLOOR})"


def _limits_sql(name: str, keys: str) -> str:
    own = f"{keys}, " if keys else ""
    return f"""
{name}_sums as (select {own}signal, bucket, sum(n) over (partition by {own}signal) as total, sum(n) over (partition by {own}signal order by bucket) as up_to from (select {own}signal, bucket, sum(n) as n from sketch group by all)),
{name}_at as (select {own}signal, max(total) as n, min(bucket) filter (where up_to * 1000 >= total * 500) as mid, {_TAILS_SQL} from {name}_sums group by all),
{name} as (select {own}signal, n, {_LIMIT_SQL.format(name="low", sign="-")} as lo, {_LIMIT_SQL.format(name="high", sign="+")} as hi from {name}_at)"""


_BUCKETS = {s: e.replace(" div ", " // ") for s, e in SIGNALS.items()}
ORACLE_SQL = f"""
with docs as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text from documents),
words as (select rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from docs),
threes as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as three from words, unnest(range(1, len(w) - 1)) as t(i)),
twice as (select rid, i from threes qualify count(*) over (partition by rid, three) > 1),
repeats as (select rid, count(distinct place) as n from (select rid, unnest([i, i + 1, i + 2]) as place from twice) group by rid),
lines as (select rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from docs),
counts as (select rid, doc_id, lang, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from docs join words using (rid) join lines using (rid) left join repeats using (rid)),
marked as (select *, n_words < {MIN_WORDS} or n_repeat_words * 100 > n_words * 50 as base_failed from counts),
signals as ({" union all ".join(f"select rid, lang, source, base_failed, '{s}' as signal, {e} as bucket from marked" for s, e in _BUCKETS.items())}),
sketch as (select lang, source, signal, bucket, count(*) as n from signals where not base_failed group by all),{_limits_sql("fine", "lang, source")},{_limits_sql("by_lang", "lang")},{_limits_sql("whole", "")},
verdicts as (select rid, bool_and(coalesce(bucket between coalesce(f.lo, b.lo, c.lo) and coalesce(f.hi, b.hi, c.hi), true)) as passed from signals s
  left join fine f on f.lang is not distinct from s.lang and f.source is not distinct from s.source and f.signal = s.signal and f.n >= {MIN_GROUP}
  left join by_lang b on b.lang is not distinct from s.lang and b.signal = s.signal and b.n >= {MIN_GROUP}
  left join whole c on c.signal = s.signal group by rid)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and passed as kept from marked join verdicts using (rid)
"""
