"""Queries of splits over orders, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwork.operators import splitting
from liftwork.sources.products import ORDER_SQL, orders

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


CUTS_SQL = f"""with {ORDER_SQL}, days as (select day as d, count(*) as n from ord group by day), total as (select sum(n) as total from days),
cum as (select d, sum(n) over (order by d) as cum, row_number() over (order by d) as pos, count(*) over () as days from days where d is not null),
raw as (select max(days) as days, min(pos) filter (where cum >= round_even(total * 0.7, 0)) as p1, min(pos) filter (where cum >= round_even(total * 0.85, 0)) as p2 from cum, total),
pos as (select least(p1, days - 2) as p1, greatest(least(p2, days - 1), least(p1, days - 2) + 1) as p2 from raw),
cuts as (select max(d) filter (where pos = p1) as cut1, max(d) filter (where pos = p2) as cut2 from cum, pos)"""


@query(f"{CUTS_SQL} select o_orderkey, case when day is null then 'oot' when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split from ord, cuts")
def split_time(spark, sf_dir):
    return splitting.split_by_day(orders(spark, sf_dir)).select("o_orderkey", "split")


@query(f"""{CUTS_SQL}, ends as (select *, strftime(strptime(cut1::varchar, '%Y%m%d') + interval 30 day, '%Y%m%d')::int as e1, strftime(strptime(cut2::varchar, '%Y%m%d') + interval 30 day, '%Y%m%d')::int as e2 from cuts)
select o_orderkey, case when (day > cut1 and day <= e1) or (day > cut2 and day <= e2) then null when day is null then 'oot' when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split from ord, ends""")
def split_time_embargo(spark, sf_dir):
    return splitting.split_by_day(orders(spark, sf_dir), embargo=30).select("o_orderkey", "split")


FEW = "day between 20000101 and 20000102"


@query(f"""with {ORDER_SQL}, few as (select *, row_number() over (order by day nulls last, o_orderkey) as r, count(*) over () as n from ord where {FEW})
select o_orderkey, case when r <= round_even(n * 0.7, 0) then 'train' when r <= round_even(n * 0.85, 0) then 'valid' else 'oot' end as split from few""")
def split_time_few_days(spark, sf_dir):
    return splitting.split_rows(orders(spark, sf_dir).where(FEW), ["o_orderkey"]).select("o_orderkey", "split")


@query(f"""with {ORDER_SQL}, placed as (select *, row_number() over (partition by y order by md5(o_orderkey || '#42'), o_orderkey) as r, count(*) over (partition by y) as n from ord)
select o_orderkey, case when r <= round_even(n * 0.7, 0) then 'train' when r <= round_even(n * 0.7, 0) + round_even(n * 0.15, 0) then 'valid' else 'oot' end as split from placed""")
def split_stratified(spark, sf_dir):
    return splitting.split_stratified(orders(spark, sf_dir), "o_orderkey").select("o_orderkey", "split")


@query(f"""with {ORDER_SQL}, days as (select day as d, count(*) as n from ord where day is not null group by day),
upto as (select d, sum(n) over (order by d) as c, sum(n) over () as total from days),
cuts as (select list_sort(list(cut)) as cuts from (select i, min(d) as cut from upto, (select unnest([1, 2, 3, 4]) as i) where c >= round_even(total * i / 5, 0) group by i)),
placed as (select day, coalesce(len(list_filter(cuts, lambda c: c < day)), 0) as block from ord, cuts)
select block, min(day) as first_day, max(day) as last_day, count(*) as n from placed group by 1""")
def forward_folds(spark, sf_dir):
    return splitting.forward_folds(orders(spark, sf_dir)).groupBy("block").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n"))


@query(f"""{CUTS_SQL}, s as (select *, case when day is null then 'oot' when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split from ord, cuts),
r as (select *, row_number() over (partition by split order by day, o_orderkey) as r, count(*) over (partition by split) as n from s),
c as (select *, split = 'valid' and r > n - round_even(n * 0.5, 0) as later from r),
enough as (select count(*) >= 200 and sum(y) >= 10 and sum(y) < count(*) as enough from c where later)
select o_orderkey, split, later and enough as calibration from c, enough""")
def calibration_carve(spark, sf_dir):
    return splitting.calibration_carve(splitting.split_by_day(orders(spark, sf_dir)), ["day", "o_orderkey"]).select("o_orderkey", "split", "calibration")


@query(f"""with {ORDER_SQL} select o_orderkey, row_number() over (order by day nulls last, o_orderkey) > count(*) over () - round_even(count(*) over () * 0.15, 0) as oot from ord""")
def oot_tail_rank(spark, sf_dir):
    o = orders(spark, sf_dir)
    total = o.agg(F.count(F.lit(1)).alias("total"))
    placed = splitting.ranked(o, "day", ["o_orderkey"]).crossJoin(F.broadcast(total))  # one row
    return placed.select("o_orderkey", (F.col("rank") > F.col("total") - F.bround(F.col("total") * 0.15)).alias("oot"))


@query(f"""{CUTS_SQL}, s as (select *, case when day is null then 'oot' when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split from ord, cuts),
m as (select floor(quantile_cont(day, 0.5) filter (where split = 'train')) as mid, floor(quantile_cont(day, 0.5)) as mid_all from s)
select 'train_halves' as mode, case when split = 'train' and day <= mid then 'expected' when split = 'train' then 'actual' end as side, count(*) as n from s, m group by 2
union all select 'halves', case when day <= mid_all then 'expected' else 'actual' end, count(*) from s, m group by 2
union all select 'train_vs_rest', case when split = 'train' then 'expected' else 'actual' end, count(*) from s group by 2""")
def psi_partition(spark, sf_dir):
    """The sides of the stability comparison in each mode."""
    s = splitting.split_by_day(orders(spark, sf_dir))
    counts = [splitting.psi_sides(s, m).groupBy("side").agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("mode"), "side", "n") for m in ("train_halves", "halves", "train_vs_rest")]
    return reduce(DataFrame.unionByName, counts)


@query(f"""with {ORDER_SQL} select o_orderkey, y from ord qualify row_number() over (partition by y order by md5(o_orderkey || '#42'), o_orderkey) <= 50""")
def stratified_sample(spark, sf_dir):
    """Fifty orders of each label, the same ones every time."""
    return splitting.exact_sample(orders(spark, sf_dir), "o_orderkey", "y", 50).select("o_orderkey", "y")


@query(f"""{CUTS_SQL} select case when day is null then 'oot' when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split, min(day) as first_day, max(day) as last_day from ord, cuts group by 1""")
def split_boundaries(spark, sf_dir):
    return splitting.split_by_day(orders(spark, sf_dir)).groupBy("split").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("select o_orderkey, (('0x' || md5(o_orderkey::varchar)[1:8])::bigint % 8)::int as shard from orders")
def shard_of(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", splitting.shard(F.col("o_orderkey"), 8).alias("shard"))
