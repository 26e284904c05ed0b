"""Missing-value rules as Column expressions. NULL is the only missing marker."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MissingRules:
    """Which values count as missing. Defaults: zero sentinel, negatives and blank strings are missing."""

    sentinels: tuple = (0,)
    negative_missing: bool = True
    empty_missing: bool = True
    zero_missing: bool = False
    overrides: dict[str, MissingRules] = field(default_factory=dict)

    def of(self, column: str) -> MissingRules:
        return self.overrides.get(column, self)


def numeric(c: Column, dtype: str, empty_missing: bool = True) -> Column:
    """A double: unparseable strings and NaN are NULL; so are null words and blanks if wanted."""
    if dtype == "string":
        if empty_missing:
            c = F.when(F.lower(F.trim(c)).isin("", "none", "null"), None).otherwise(c)
        value = c.try_cast("double")
    else:
        value = c.cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def clean(column: str, dtype: str, rules: MissingRules) -> Column:
    """The value of a column under its rules, as a nullable double."""
    own = rules.of(column)
    value = numeric(F.col(column), dtype, own.empty_missing)
    numbers = [float(s) for s in own.sentinels if isinstance(s, (int, float))]
    missing = F.lit(False)
    if numbers:
        missing = missing | value.isin(numbers)
    if own.negative_missing:
        missing = missing | (value < 0)
    if own.zero_missing:
        missing = missing | (value == 0)
    return F.when(missing, None).otherwise(value)


def yyyymmdd(c: Column) -> Column:
    """An integer day from a timestamp's date, or NULL."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)  # numbers: a text of each day takes several times as long


def lenient_yyyymmdd(c: Column) -> Column:
    """An integer day from text such as 2024-01-31 or 20240131; NULL where it is no plausible day."""
    day = F.regexp_replace(F.trim(c), "-", "").try_cast("int")
    return F.when(day.between(19000101, 30001231), day)


def binarize(c: Column) -> Column:
    """1 for values over zero, else 0, for missing or unparseable values too."""
    return F.coalesce((c.try_cast("double") > 0).cast("int"), F.lit(0))


def weight(c: Column, weights: dict[float, float], default: float = 1.0) -> Column:
    """The weight of a value; values that are not listed, and NULL, get the default."""
    out = F
    for value, w in weights.items():
        out = out.when(c == F.lit(value), F.lit(float(w)))
    return out.otherwise(F.lit(float(default)))


def recoded(c: Column, sentinel: float) -> Column:
    """NULL for a value that stands for none."""
    return F.when(c != F.lit(sentinel), c)


def binary_outcome(c: Column, positive: tuple = (1, 2, 3)) -> Column:
    """1 for the positive levels of an outcome, 0 for all others, NULL and unknown ones too."""
    return F.coalesce(c.try_cast("double").isin([float(p) for p in positive]).cast("int"), F.lit(0))


def strict_yyyymmdd(c: Column) -> Column:
    """An integer day from text; text that is no plausible day is an error."""
    day = lenient_yyyymmdd(c)
    return F.when(day.isNotNull(), day).otherwise(F.raise_error(F.concat(F.lit("no day: "), F.coalesce(c, F.lit("NULL")))).cast("int"))
