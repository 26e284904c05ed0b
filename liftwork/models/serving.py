"""Scoring of vectors that come as text, by a model that every Python worker parses once.

The model travels as a broadcast text; a worker keeps what it has parsed by version, so tasks that run in the same worker
find it, and another version is parsed anew. A vector that cannot be read scores ``FAILED``; an entity gets the greatest score of
its rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwork.models.boosting import Model, Run, Tree

FAILED = -1.0

#: version -> (edges, model), in each Python worker. One version is kept.
_PARSED: dict[str, tuple[dict[str, list[float]], Model]] = {}


def as_text(model: Model, edges: dict[str, list[float]]) -> str:
    """A model and the edges of its features as text."""
    trees = [{k: getattr(t, k).tolist() for k in ("feature", "bin", "missing_left", "value", "gain", "cover")} for t in model.trees]
    return json.dumps({"edges": {f: [float(x) for x in e] for f, e in edges.items()}, "trees": trees})


def parsed(version: str, text: str, loads: Accumulator | None = None) -> tuple[dict[str, list[float]], Model]:
    """The model of a version, parsed by this worker before or now."""
    if version not in _PARSED:
        found = json.loads(text)
        _PARSED.clear()
        _PARSED[version] = found["edges"], Model(Run(version), [Tree(**{k: np.array(v) for k, v in t.items()}) for t in found["trees"]])
        if loads is not None:
            loads.add(1)
    return _PARSED[version]


def bins_of(vector: str | None, edges: dict[str, list[float]]) -> list[int] | None:
    """The bins of a vector written as a JSON object; None if it is none or a value is no number. A feature it lacks is missing."""
    try:
        given = json.loads(vector)
        values = [given.get(f) for f in edges]
        return [-1 if v is None else int(np.searchsorted(e[1:-1], float(v), "right")) for v, e in zip(values, edges.values(), strict=True)]
    except (TypeError, ValueError, AttributeError):
        return None


def entity_scores(rows: DataFrame, model: Model, edges: dict[str, list[float]], version: str, entity: str = "entity", vector: str = "vector", loads: Accumulator | None = None) -> DataFrame:
    """(entity, score, n, failed) of rows (entity, vector): the greatest score, FAILED if no vector could be read."""
    text = rows.sparkSession.sparkContext.broadcast(as_text(model, edges))
    given = rows.select(F.col(entity).alias("entity"), F.col(vector).cast("string").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts, own = parsed(version, text.value, loads)
            read = [bins_of(v, cuts) for v in batch.column("vector").to_pylist()]
            good = np.array([b is not None for b in read], bool)
            score = np.full(len(read), FAILED)
            if good.any():
                score[good] = 1 / (1 + np.exp(-own.margins(np.array([b for b in read if b is not None]).reshape(good.sum(), -1))))
            yield pa.RecordBatch.from_arrays([batch.column("entity"), pa.array(score)], names=["entity", "score"])

    kind = given.schema["entity"].dataType.simpleString()
    scores = given.mapInArrow(run, f"entity {kind}, score double")
    return scores.groupBy("entity").agg(F.max("score").alias("score"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") == FAILED).alias("failed"))
