"""Tables from delimited files: enumerating them, checking headers, aliases and the columns that are needed."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def enumerated(spark: SparkSession, pattern: str, names: list[str]) -> list[str]:
    """The path of every name in a pattern such as day_{}.csv; a file that is not there is an error that names all of them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [pattern.format(n) for n in names]
    missing = [p for p in paths if not (h := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(h)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    return paths


def canonical_header(head: list[str], aliases: dict[str, list[str]]) -> list[str]:
    """The header with aliases in place of the names they stand for.

    ``aliases``: canonical column -> names it may have; the first that is there counts. None of them is an error.
    """
    out = list(head)
    for name, known in aliases.items():
        if name in head:
            continue
        there = [k for k in known if k in head]
        if not there:
            raise ValueError(f"no column for {name}: none of {known}")
        if len(there) > 1:
            log.warning("%s: several columns %s, %s is taken", name, there, there[0])
        out[head.index(there[0])] = name
    return out


def read_files(spark: SparkSession, paths: list[str], types: dict[str, str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Delimited files of one table, after a check that all have the same columns in the same order once aliases are resolved.

    Columns get the types of ``types``, text where they are not listed. Files with equal headers are read together.
    """
    heads: dict[tuple[str, ...], list[str]] = {}
    first = None
    for path in paths:
        head = spark.read.csv(path, header=True).columns
        canonical = canonical_header(head, aliases or {})
        first = first or canonical
        if canonical != first:
            missing, extra = sorted(set(first) - set(canonical)), sorted(set(canonical) - set(first))
            raise ValueError(f"{path}: missing {missing}, extra {extra}, order changed {not missing and not extra}")
        heads.setdefault(tuple(head), []).append(path)
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in first)
    parts = [spark.read.csv(some, header=True, schema=schema, enforceSchema=True) for some in heads.values()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def probed(df: DataFrame, label: str, key: str, day: str | None = None) -> list[tuple[str, str]]:
    """(name, type) of the feature columns; an error where label, key or day are not there."""
    gone = [c for c in (label, key, day) if c is not None and c not in df.columns]
    if gone:
        raise ValueError(f"no column {', '.join(gone)}")
    return [(n, t) for n, t in df.dtypes if n not in (label, key, day)]


def without_columns(df: DataFrame, common: list[str], own: list[str]) -> DataFrame:
    """``df`` without configured columns; those it lacks don't matter."""
    return df.drop(*common, *own)


def named(df: DataFrame, names: DataFrame, feature: str = "feature", name: str = "name") -> DataFrame:
    """``df`` with the display name of each feature as its second column, the feature itself where it has none."""
    wanted = names.select(F.col(feature).alias("_feature"), F.col(name).alias("_name")).dropDuplicates(["_feature"])
    out = df.join(wanted, F.col(feature) == F.col("_feature"), "left").withColumn(name, F.coalesce("_name", feature))
    return out.select(feature, name, *(c for c in df.columns if c not in (feature, name)))


def feature_list(spark: SparkSession, path: str) -> list[str]:
    """Names from a text file, one a line; blank lines and comments are skipped. The list is of the size of the features."""
    lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' and not startswith(v, '#')")
    return [r["v"] for r in lines.collect()]


def write_feature_list(report: DataFrame, path: str, top: int) -> None:
    """The kept features of a report, best score first, as a text file with a comment on top. ``ordinal`` keeps their order in the one file."""
    kept = report.where("auto_keep").orderBy(F.desc("rank_score"), "feature").limit(top).select("feature").coalesce(1)
    head = report.sparkSession.createDataFrame([(f"# best {top} features",)], "value string")
    head.union(kept).coalesce(1).write.mode("overwrite").text(path)
