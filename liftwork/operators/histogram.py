"""Histograms of features by value: what all signals of a feature are read from.

A histogram has one row (keys..., value, n, pos) for each distinct value of each key, and one for NULL.
``ordered`` adds how many rows have smaller values, by sorted ranges with carried sums, so no task sees all
values of a feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.sources.intermediate import stored

def histogram(values: DataFrame, label: str | None = "y", by: list[str] = ["feature"]) -> DataFrame:  # noqa: B006
    """(by..., value, n, pos) of a long relation, written once; pos is 0 without a label."""
    pos = F.lit(0) if label is None else F.coalesce(F.col(label), F.lit(0))
    return stored(values.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"), F.sum(pos.cast("long")).alias("pos")), "histogram")


def ordered(hist: DataFrame, by: list[str] = ["feature"]) -> DataFrame:  # noqa: B006
    """The known values (by..., value, n, pos) with before, pos_before (rows of smaller values), total and positives.

    Values are dealt and sorted by ranges, written once with their running sums within the task, and get the sums of the
    tasks before theirs: a row a task and key. No task sees all values of a key. A NULL in ``by`` is a key like others.
    """
    known = hist.where("value is not null").select(*by, "value", F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"))
    ranged = known.repartitionByRange(*by, "value").sortWithinPartitions(*by, "value")
    marks = (("_task", pa.int32(), "int"), ("_in", pa.int64(), "long"), ("_ip", pa.int64(), "long"))
    schema = ranged.select("*", *(F.lit(0).cast(t).alias(c) for c, _, t in marks)).schema
    keys = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, carried = TaskContext.get().partitionId(), None, (0, 0)
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            new = np.zeros(size, bool)
            first = tuple(batch.column(c)[0].as_py() for c in range(keys))
            new[0] = last is None or first != last
            for c in range(keys):
                col = batch.column(c)
                a, b = col.slice(0, size - 1), col.slice(1)
                differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
                new[1:] |= differ
            start = np.maximum.accumulate(np.where(new, np.arange(size), -1))
            out = []
            for name, before in zip(("n", "pos"), carried, strict=True):
                own = batch.column(name).to_numpy(zero_copy_only=False)
                upto = np.cumsum(own) - own
                out.append(np.where(start < 0, upto + before, upto - upto[np.maximum(start, 0)]))
            carried = tuple(int(o[-1] + batch.column(name)[size - 1].as_py()) for name, o in zip(("n", "pos"), out, strict=True))
            last = tuple(batch.column(c)[size - 1].as_py() for c in range(keys))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, t) for v, (_, t, _) in zip((np.full(size, task), *out), marks, strict=True))], names=[*batch.schema.names, *(c for c, *_ in marks)])

    placed = stored(ranged.mapInArrow(run, schema), "histogram-order")
    sums = placed.groupBy(*by, "_task").agg(F.sum("n").alias("_n"), F.sum("pos").alias("_p"))
    whole = Window.partitionBy(*by)  # a row a task
    upto = whole.orderBy("_task")
    sums = sums.select(*by, "_task", (F.sum("_n").over(upto) - F.col("_n")).alias("_nb"), (F.sum("_p").over(upto) - F.col("_p")).alias("_pb"), F.sum("_n").over(whole).alias("total"), F.sum("_p").over(whole).alias("positives"))
    sums = sums.withColumnsRenamed({k: f"_of_{k}" for k in (*by, "_task")})
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*by, "_task")))
    return placed.join(F.broadcast(sums), same).select(*by, "value", "n", "pos", (F.col("_in") + F.col("_nb")).alias("before"), (F.col("_ip") + F.col("_pb")).alias("pos_before"), "total", "positives")


def quantile(q: float) -> Column:
    """An aggregate over ``ordered`` rows of one key: the interpolated quantile. Between equal neighbours it is their value, to the last bit: edges are compared with values."""
    place = (F.col("total") - 1) * q
    at = lambda i: F.max(F.when((F.col("before") <= i) & (i < F.col("before") + F.col("n")), F.col("value")))
    share = F.max(place - F.floor(place))
    low, high = at(F.floor(place)), at(F.ceil(place))
    return F.when((share == 0) | (low == high), low).otherwise(low * (1 - share) + high * share)


def quantiles(hist: DataFrame, shares: dict[str, float], by: list[str] = ["feature"]) -> DataFrame:  # noqa: B006
    """(by..., names...) of the known values of every key that has some."""
    return ordered(hist, by).groupBy(*by).agg(*(quantile(q).alias(n) for n, q in shares.items()))
