"""Fitting and applying missing-value fills, indicators, encodings and checks."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwork.operators.histogram import histogram, quantiles
from liftwork.operators.splitting import calibration_carve, split_rows
from liftwork.sources.intermediate import stored

log = logging.getLogger(__name__)


def fit_fill(train: DataFrame, strategies: dict[str, str | float]) -> dict[str, float | None]:
    """The fill of each column, fitted on ``train``: median, mean, zero, keep_nan or a constant.

    A column without known values gets -999 instead of a median or mean. A constant that lies within
    the range [p01, max] of the known values is an error: it could not be told from a value.
    """
    ranked = [c for c, strategy in strategies.items() if strategy not in ("mean", "keep_nan")]
    found: dict[str, float | None] = {}
    if "mean" in strategies.values():
        means = train.agg(*(F.avg(c).alias(c) for c, strategy in strategies.items() if strategy == "mean")).first()
        found |= {f"{c}_mean": v for c, v in means.asDict().items()}
    if ranked:
        values = train.select(*(F.col(c).cast("double").alias(c) for c in ranked)).unpivot([], ranked, "feature", "value")
        for r in quantiles(histogram(values, None), {"median": 0.5, "low": 0.01, "high": 1.0}).collect():  # a row a column
            found |= {f"{r['feature']}_{k}": r[k] for k in ("median", "low", "high")}
    fills: dict[str, float | None] = {}
    for c, strategy in strategies.items():
        if strategy in ("median", "mean"):
            value = found.get(f"{c}_{strategy}")
            fills[c] = -999.0 if value is None else float(value)
        elif strategy == "keep_nan":
            fills[c] = None
        else:
            fills[c] = 0.0 if strategy == "zero" else float(strategy)
            if f"{c}_low" in found and found[f"{c}_low"] <= fills[c] <= found[f"{c}_high"]:
                raise ValueError(f"fill {fills[c]} of {c} lies within its values [{found[f'{c}_low']}, {found[f'{c}_high']}]")
    return fills


def apply_fill(df: DataFrame, fills: dict[str, float | None]) -> DataFrame:
    """``df`` with missing values filled; never refitted."""
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in fills.items() if v is not None})


def indicator_columns(train: DataFrame, columns: list[str], threshold: float = 0.10) -> list[str]:
    """Columns whose missing rate on ``train`` reaches the threshold."""
    rates = train.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns)).first()
    return [c for c in columns if rates[c] is not None and rates[c] >= threshold]


def with_indicators(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"{c}__isnan": F.col(c).isNull().cast("tinyint") for c in columns})


def all_missing(columns: list[str]) -> Column:
    """Whether no column has a value."""
    return F.coalesce(*columns).isNull()


def drop_empty_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without any value go from train and valid, and stay in oot. A split that would be left empty is an error, over 5 % a warning."""
    sizes = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if(all_missing(columns)).alias("empty")).where("split in ('train', 'valid')").collect()
    for r in sizes:
        if r["n"] == r["empty"]:
            raise ValueError(f"no row of {r['split']} has a value")
        if r["empty"] > 0.05 * r["n"]:
            log.warning("%s of %s rows of %s have no value", r["empty"], r["n"], r["split"])
    return df.where(~(all_missing(columns) & F.col("split").isin("train", "valid")))


def label_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the code of a category in sorted order, -1 for NULL. The distinct categories are ranked, not the rows."""
    codes = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = codes.select(F.col(column).alias("_category"), (F.row_number().over(Window.orderBy(column)) - 1).alias(name))
    return df.join(codes, F.col(column) == F.col("_category"), "left").withColumn(name, F.coalesce(name, F.lit(-1))).drop("_category")


def bad_labels(df: DataFrame, label: str = "y") -> DataFrame:
    """(label, n) of values that are not 0 or 1; empty if the label is fit for use."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).where("label is null or label not in (0, 1)")


def require_binary(df: DataFrame, label: str = "y") -> DataFrame:
    """``df`` if all its labels are 0 or 1, else an error with the values that are not."""
    found = bad_labels(df, label).limit(10).collect()
    if found:
        raise ValueError(f"{label} has values other than 0 and 1: " + ", ".join(f"{r['label']} ({r['n']} rows)" for r in found))
    return df


def build_dataset(df: DataFrame, features: dict[str, str | float], ties: list[str], exclude: dict[str, list[float]] | None = None, day: str = "day", label: str = "y", weight: Column | None = None, indicator: float = 0.10, carve: float | None = None) -> DataFrame:
    """A table to learn from: label, ties, split, weight, filled features and indicators of missing values.

    ``features``: column -> fill strategy. Labels are checked, excluded rows go, the rest is split, rows
    without any value go from train and valid; fills and indicators are fitted on train alone. ``carve``: the later part of
    valid that is held out for calibration, told by the column calibration.
    """
    rows = without_values(require_binary(df, label), exclude or {})
    split = stored(split_rows(rows, ties, day=day, label=label).where("split is not null"), "dataset-split")
    there = drop_empty_rows(split, list(features))
    if carve is not None:
        there = stored(calibration_carve(there, [c for c in (day, *ties) if c in there.columns], carve, label), "dataset-carved")
    train = there.where("split = 'train'")
    marked = with_indicators(there, indicator_columns(train, list(features), indicator))
    filled = apply_fill(marked, fit_fill(train, features))
    marks = [c for c in filled.columns if c.endswith("__isnan")]
    held = ["calibration"] if carve is not None else []
    return filled.select(*ties, label, "split", *held, (F.lit(1.0) if weight is None else weight).alias("weight"), *(F.col(c).cast("float").alias(c) for c in features), *marks)


def without_values(df: DataFrame, rules: dict[str, list[float]]) -> DataFrame:
    """Rows with a listed value in any ruled column go; NULL stays."""
    for column, values in rules.items():
        df = df.where(~F.coalesce(F.col(column).isin(values), F.lit(False)))
    return df
