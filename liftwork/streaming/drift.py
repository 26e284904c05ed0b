"""Drift of a stream of events: windows over event time against frozen edges, and sessions.

Structured Streaming keeps the counts of open windows as state; a window is written once, when the watermark has passed
its end, and rows that come later are dropped. A run works off what is there (available now) and ends; the next one
goes on from its checkpoint and repeats nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.operators.binning import digit
from liftwork.operators.signals import psi


def event_stream(spark: SparkSession, path: str, files: str | None = None, per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files below a path, with the schema of those that are there; ``files`` is a pattern of their names.

    Times without a zone count as UTC, whatever the session's zone.
    """
    batch = spark.read.option("pathGlobFilter", files).parquet(path) if files else spark.read.parquet(path)
    reader = spark.readStream.schema(batch.schema)
    for name, value in (("pathGlobFilter", files), ("maxFilesPerTrigger", per_batch)):
        reader = reader.option(name, value) if value else reader
    out = reader.parquet(path)
    return out.withColumns({n: F.expr(f"timestamp'1970-01-01 00:00:00Z' + (`{n}` - timestamp_ntz'1970-01-01 00:00:00')") for n, t in out.dtypes if t == "timestamp_ntz"})


def windowed_counts(events: DataFrame, edges: list[float], length: str = "1 day", delay: str = "1 day", value: str = "value", ts: str = "ts") -> DataFrame:
    """(start, bin, n): the rows of each tumbling window in each bin of frozen edges, NULL values in bin -1. start: microseconds since 1970."""
    cuts = F.array(*(F.lit(float(e)) for e in edges)).cast("array<double>")
    binned = events.withWatermark(ts, delay).select(F.col(ts), digit(F.col(value).cast("double"), cuts).alias("bin"))
    return binned.groupBy(F.window(ts, length), "bin").agg(F.count(F.lit(1)).alias("n")).select(F.unix_micros("window.start").alias("start"), "bin", "n")


def sessions(events: DataFrame, gap: str = "6 hours", delay: str = "1 day", key: str = "user_id", value: str = "value", ts: str = "ts") -> DataFrame:
    """(key, start, n, total): runs of a key's events with at most ``gap`` between neighbours. start: microseconds since 1970."""
    kept = events.withWatermark(ts, delay).where(F.col(key).isNotNull())
    found = kept.groupBy(key, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return found.select(key, F.unix_micros("session_window.start").alias("start"), "n", "total")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Work off what the stream has now into the Parquet table ``out``, and read it. ``checkpoint`` is the run's memory."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def window_psi(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """(start, n, psi) of each window of (start, bin, n) against the reference (bin, n); a bin that one side lacks counts 0."""
    starts = counts.groupBy("start").agg(F.sum("n").alias("n"))
    expected = reference.select("bin", F.col("n").alias("expected"))
    bins = expected.select("bin").unionByName(counts.select("bin")).distinct()  # a few
    grid = starts.select("start").crossJoin(F.broadcast(bins))
    zero: Column = F.lit(0)
    sides = grid.join(counts.select("start", "bin", F.col("n").alias("actual")), ["start", "bin"], "left").join(F.broadcast(expected), "bin", "left")
    sides = sides.select("start", "bin", F.coalesce("expected", zero).alias("expected"), F.coalesce("actual", zero).alias("actual"))
    return psi(sides, ["start"]).join(starts, "start")
