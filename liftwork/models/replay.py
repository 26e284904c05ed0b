"""Scoring replay: what was fitted in training, as one saved pipeline of Spark ML transformers.

Missing-value rules, fills, indicators, trees and calibration are stages with parameters alone, so a pipeline is saved
and loaded by Spark ML itself. All of them are column expressions, trees too: scoring reads its input once and runs in
the JVM. A column that a stage needs and the input lacks is an error that names it; further columns pass.
"""

from __future__ import annotations

import json
import logging

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwork.functions.cleaning import MissingRules, clean
from liftwork.models.boosting import Model
from liftwork.operators.fusion import interpolated

log = logging.getLogger(__name__)

#: The version of saved stages; a newer one is refused.
VERSION = 1


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose one parameter is a text of JSON."""

    payload = Param(Params._dummy(), "payload", "what was fitted, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, payload: str = "{}"):
        super().__init__()
        self._setDefault(payload="{}")
        self._set(payload=payload)

    @classmethod
    def of(cls, **fitted):
        return cls(payload=json.dumps(fitted | {"version": VERSION}, sort_keys=True))

    def fitted(self) -> dict:
        found = json.loads(self.getOrDefault(self.payload))
        if found.get("version", 0) > VERSION:
            raise ValueError(f"{type(self).__name__} was saved by version {found['version']}, this is {VERSION}")
        return found

    def _require(self, df: DataFrame, columns: list[str]) -> None:
        gone = sorted(set(columns) - set(df.columns))
        if gone:
            raise ValueError(f"{type(self).__name__}: the input lacks {', '.join(gone)}")


class CleanStage(_Stage):
    """Raw columns to numbers with NULL for what the rules count as missing. Also all_missing: whether no column has a value.

    rules: the default; overrides: column -> rules.
    """

    def _transform(self, dataset: DataFrame) -> DataFrame:
        own = self.fitted()
        self._require(dataset, own["columns"])
        made = lambda r: MissingRules(**(r | {"sentinels": tuple(r.get("sentinels", (0,)))}))
        rules = MissingRules(**{**made(own["rules"]).__dict__, "overrides": {c: made(r) for c, r in own["overrides"].items()}})
        types = dict(dataset.dtypes)
        out = dataset.withColumns({c: clean(c, types[c], rules) for c in own["columns"]})
        return out.withColumn("all_missing", F.coalesce(*own["columns"]).isNull())


class IndicatorStage(_Stage):
    """{column}__isnan of the listed columns, from the values before they are filled."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = self.fitted()["columns"]
        self._require(dataset, columns)
        return dataset.withColumns({f"{c}__isnan": F.col(c).isNull().cast("double") for c in columns})


class FillStage(_Stage):
    """The fitted fill of each column; a column without one keeps its NULLs."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = self.fitted()["fills"]
        self._require(dataset, list(fills))
        return dataset.withColumns({c: F.coalesce(c, F.lit(float(v))) for c, v in fills.items() if v is not None})


class TreeStage(_Stage):
    """raw_score: the probability that boosted trees give."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        own = self.fitted()
        self._require(dataset, list(own["edges"]))
        names, cuts = list(own["edges"]), [e[1:-1] for e in own["edges"].values()]

        def node(tree: dict, i: int) -> Column:
            f = tree["feature"][i]
            if f < 0:
                return F.lit(tree["value"][i])
            value, b = F.col(names[f]).cast("double"), tree["bin"][i]
            known = value < F.lit(float(cuts[f][b])) if b < len(cuts[f]) else F.lit(True)
            left = F.when(value.isNull(), bool(tree["missing_left"][i])).otherwise(known)
            return F.when(left, node(tree, 2 * i + 1)).otherwise(node(tree, 2 * i + 2))

        margin = sum((node(t, 0) for t in own["trees"]), F.lit(0.0))
        return dataset.withColumn("raw_score", 1 / (1 + F.exp(-margin)))


class CalibrationStage(_Stage):
    """score: the raw score by the calibration table, itself where there is none."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = self.fitted()["table"]
        self._require(dataset, ["raw_score"])
        return dataset.withColumn("score", interpolated(F.col("raw_score"), [tuple(p) for p in table]) if table else F.col("raw_score"))


def tree_stage(model: Model, edges: dict[str, list[float]]) -> TreeStage:
    trees = [{k: getattr(t, k).tolist() for k in ("feature", "bin", "missing_left", "value")} for t in model.trees]
    return TreeStage.of(edges={f: [float(x) for x in e] for f, e in edges.items()}, trees=trees)


def _as_dict(rules: MissingRules) -> dict:
    return {"sentinels": list(rules.sentinels), "negative_missing": rules.negative_missing, "empty_missing": rules.empty_missing, "zero_missing": rules.zero_missing}


def scoring_pipeline(columns: list[str], rules: MissingRules, indicators: list[str], fills: dict[str, float | None], model: Model | None = None, edges: dict[str, list[float]] | None = None, calibration: list[tuple[float, float]] | None = None) -> PipelineModel:
    """The stages of a fitted model, in the order of training. Without a model the features alone are replayed."""
    stages: list[Transformer] = [
        CleanStage.of(columns=columns, rules=_as_dict(rules), overrides={c: _as_dict(r) for c, r in rules.overrides.items()}), IndicatorStage.of(columns=indicators), FillStage.of(fills=fills),
    ]
    if model is not None:
        stages += [tree_stage(model, edges), CalibrationStage.of(table=[list(p) for p in calibration or []])]
    return PipelineModel(stages)


def save(pipeline: PipelineModel, path: str) -> None:
    pipeline.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def scored(pipeline: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with its scores. Rows without any value are scored too, and counted in a warning."""
    out = pipeline.transform(df)
    empty = out.where("all_missing").count()
    if empty:
        log.warning("%s rows have no value of any feature; their scores say nothing of them", empty)
    return out
