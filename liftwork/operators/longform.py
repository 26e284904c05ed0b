"""The long relation: one row per entity and feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwork.functions.cleaning import MissingRules, clean


def long_values(df: DataFrame, features: list[str], keep: list[str], rules: MissingRules) -> DataFrame:
    """(keep..., feature, value): wanted columns are picked before the unpivot, so the scan is pruned."""
    types = dict(df.dtypes)
    wide = df.select(*keep, *(clean(f, types[f], rules).alias(f) for f in features))
    return wide.unpivot(keep, features, "feature", "value")
