"""Wide tables of entities from related tables, by one configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwork.functions.cleaning import recoded
from liftwork.operators.assembly import joined_chain, windowed
from liftwork.operators.preparation import label_codes

# The windows of the wide tables, in days.
CAPS = {"30d": 30, "90d": 90, "180d": 180, "360d": 360, "all": None}


@dataclass(frozen=True)
class Related:
    """A table with many rows an entity, and what is made of it.

    values: name -> column or SQL expression; days: how far a row lies back, a column or SQL expression; codes: columns that
    become numbers in sorted order before that (NULL -1), named {column}__code; none: a value that stands for no value, by name
    of the value.
    """

    prefix: str
    entity: str
    days: str
    values: dict[str, str]
    codes: tuple[str, ...] = ()
    none: dict[str, float] = field(default_factory=dict)


def related_features(df: DataFrame, spec: Related, entity: str, caps: dict[str, int | None] = CAPS) -> DataFrame:
    """One row an entity: mean, max, sum of each value and the count of rows, in each window. Rows without an entity are left out."""
    for c in spec.codes:
        df = label_codes(df, c, f"{c}__code")
    value = lambda n, e: recoded(F.expr(e).cast("double"), spec.none[n]) if n in spec.none else F.expr(e).cast("double")
    picked = df.select(F.col(spec.entity).alias(entity), F.expr(spec.days).alias("_days"), *(value(n, e).alias(n) for n, e in spec.values.items()))
    return windowed(picked.where(F.col(entity).isNotNull()), entity, "_days", list(spec.values), caps, spec.prefix)


def entity_table(main: DataFrame, entity: str, tables: dict[str, DataFrame], specs: list[Related], caps: dict[str, int | None] = CAPS) -> DataFrame:
    """``main`` (a row an entity) with the features of every related table; NULL where an entity has no rows there.

    ``tables``: prefix -> table. The parts are aggregated by the entity before they are joined, so no join has more than a row
    an entity on either side.
    """
    return joined_chain([main, *(related_features(tables[s.prefix], s, entity, caps) for s in specs)], [entity], "left")
