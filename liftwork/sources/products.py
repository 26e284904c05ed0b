"""Labelled products made of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.functions.cleaning import MissingRules, yyyymmdd
from liftwork.operators.longform import long_values

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RULES = MissingRules()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with y (returned) and day."""
    return table(spark, sf_dir, "lineitem").withColumns({"y": (F.col("l_returnflag") == "R").cast("int"), "day": yyyymmdd(F.col("l_shipdate"))})


def line_values(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("y", "day")) -> DataFrame:
    return long_values(lines(spark, sf_dir), LINE_FEATURES, list(keep), RULES)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with y (finished), day and a score in 0..1 that depends on the price and, weakly, on the label."""
    o = table(spark, sf_dir, "orders")
    y = (F.col("o_orderstatus") == "F").cast("int")
    score = F.pmod(F.col("o_orderkey") * 7919 + y * 211, F.lit(1000)) / 1000.0
    return o.withColumns({"y": y, "day": yyyymmdd(F.col("o_orderdate")), "score": score})


# The same products for the SQL.
LINE_SQL = """line as (select *, (l_returnflag = 'R')::int as y, strftime(l_shipdate, '%Y%m%d')::int as day from lineitem),
long as (unpivot (select y, day, l_returnflag as flag, {cleaned} from line) on l_quantity, l_extendedprice, l_discount, l_tax into name feature value v),
values_ as (select feature, case when v = 1e300 then null else v end as value, y, day, flag from long)""".format(
    cleaned=", ".join(f"case when {f} <= 0 then 1e300 else {f} end as {f}" for f in LINE_FEATURES)
)
ORDER_SQL = """ord as (select *, (o_orderstatus = 'F')::int as y, strftime(o_orderdate, '%Y%m%d')::int as day,
  ((o_orderkey * 7919 + (o_orderstatus = 'F')::int * 211) % 1000) / 1000.0 as score from orders)"""
