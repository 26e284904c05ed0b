"""Queries of ranking metrics over scored orders, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwork.operators import ranking, splitting
from liftwork.operators.histogram import histogram, quantiles
from liftwork.plans.splits import CUTS_SQL
from liftwork.sources.products import ORDER_SQL, orders

QUERIES, SQL = {}, {}
TIES = ["o_orderkey"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _r(df, names, places=6):
    return df.select(*(c if c not in names else F.round(c, places).alias(c) for c in df.columns))


RANKED = f"with {ORDER_SQL}, placed as (select *, row_number() over (order by score desc, o_orderkey) as r, count(*) over () as total from ord)"


@query(f"{RANKED} select o_orderkey, r <= greatest(1, ceil(total * 0.1)) as top from placed")
def top_k_mask(spark, sf_dir):
    return ranking.top_k_mask(orders(spark, sf_dir), 0.1, TIES).select("o_orderkey", "top")


@query(f"""{RANKED}, ks as (select unnest([0.05, 0.1, 0.2, 100.0]) as k), cells as (select k, y, r <= case when k <= 1 then greatest(1, ceil(total * k)) else least(k, total) end as top, total from placed, ks)
select k::double as k, round(avg(y) filter (where top), 6) as precision, round(sum(y) filter (where top) / sum(y), 6) as recall, round(avg(y) filter (where top) / avg(y), 6) as lift from cells group by k""")
def precision_recall_lift_at_k(spark, sf_dir):
    return _r(ranking.at_k(orders(spark, sf_dir), [0.05, 0.1, 0.2, 100], TIES), ["precision", "recall", "lift"])


@query(f"""{RANKED}, run as (select sum(y) over (order by r) / sum(y) over () as tpr, sum(1 - y) over (order by r) / sum(1 - y) over () as fpr from placed) select round(max(abs(tpr - fpr)), 6) as ks from run""")
def ks(spark, sf_dir):
    return _r(ranking.ks_by_row(orders(spark, sf_dir), TIES), ["ks"])


CURVE = f"""with {ORDER_SQL}, ties as (select score, count(*) as n, sum(y) as pos from ord group by score),
t as (select *, sum(n) over o as cn, sum(pos) over o as cp, sum(n) over () as total, sum(pos) over () as positives from ties window o as (order by score desc))"""


@query(f"{CURVE} select round(sum(pos * ((total - positives) - (cn - cp)) + pos * (n - pos) / 2) / max(positives * (total - positives)), 6) as roc_auc from t")
def roc_auc(spark, sf_dir):
    return _r(ranking.curve_metrics(orders(spark, sf_dir)).select("roc_auc"), ["roc_auc"])


@query(f"{CURVE} select round(sum(pos * cp / cn) / max(positives), 6) as pr_auc from t")
def pr_auc(spark, sf_dir):
    return _r(ranking.curve_metrics(orders(spark, sf_dir)).select("pr_auc"), ["pr_auc"])


@query(f"{CURVE} select score, round(cp / positives, 6) as tpr, round((cn - cp) / (total - positives), 6) as fpr from t")
def roc_curve(spark, sf_dir):
    t = ranking.thresholds(orders(spark, sf_dir))
    return t.select("score", F.round(F.col("cp") / F.col("positives"), 6).alias("tpr"), F.round((F.col("cn") - F.col("cp")) / (F.col("total") - F.col("positives")), 6).alias("fpr"))


@query(f"{CURVE} select score, round(cp / positives, 6) as recall, round(cp / cn, 6) as precision from t")
def pr_curve(spark, sf_dir):
    t = ranking.thresholds(orders(spark, sf_dir))
    return t.select("score", F.round(F.col("cp") / F.col("positives"), 6).alias("recall"), F.round(F.col("cp") / F.col("cn"), 6).alias("precision"))


@query(f"""{RANKED}, b as (select *, 1 + len(list_filter(range(1, 10), lambda i: r > round_even(total * i / 10, 0))) as bin from placed), s as (select bin, count(*) as n, sum(y) as pos from b group by bin)
select bin, n, pos, round(pos / n, 6) as rate, round(sum(n) over o / sum(n) over (), 6) as population, round((sum(pos) over o / sum(n) over o) / (sum(pos) over () / sum(n) over ()), 6) as lift,
round(sum(pos) over o / sum(pos) over (), 6) as recall, round(sum(pos) over o / sum(n) over o, 6) as precision from s window o as (order by bin)""")
def binned_lift(spark, sf_dir):
    return _r(ranking.binned_lift(orders(spark, sf_dir), TIES), ["rate", "population", "lift", "recall", "precision"])


@query(f"""{CUTS_SQL}, s0 as (select *, case when day is null then 'oot' when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split, o_orderkey % 11 = 0 as all_missing from ord, cuts),
s1 as (select *, row_number() over (partition by split order by day, o_orderkey) as r, count(*) over (partition by split) as n from s0),
s2 as (select *, split = 'valid' and r > n - round_even(n * 0.5, 0) as later from s1), enough as (select count(*) >= 200 and sum(y) >= 10 and sum(y) < count(*) as enough from s2 where later),
s as (select o_orderkey, y, score, case when later and enough then 'valid_calib' else split end as split from s2, enough union all select o_orderkey, y, score, 'oot_excl_all_na' from s2 where split = 'oot' and not all_missing),
ties as (select split, score, count(*) as n, sum(y) as pos from s group by all),
t as (select *, sum(n) over o as cn, sum(pos) over o as cp, sum(n) over w as total, sum(pos) over w as positives from ties window w as (partition by split), o as (partition by split order by score desc)),
curves as (select split, max(total) as n, max(positives) / max(total) as base_rate, sum(pos * ((total - positives) - (cn - cp)) + pos * (n - pos) / 2) / max(positives * (total - positives)) as roc_auc,
sum(pos * cp / cn) / max(positives) as pr_auc, max(abs(cp / positives - (cn - cp) / (total - positives))) as ks from t group by split),
placed as (select split, y, row_number() over (partition by split order by score desc, o_orderkey) <= greatest(1, ceil(count(*) over (partition by split) * 0.1)) as top from s),
tops as (select split, avg(y) filter (where top) as precision_at_k, sum(y) filter (where top) / sum(y) as recall_at_k, avg(y) filter (where top) / avg(y) as lift_at_k from placed group by split)
select split, n, round(base_rate, 6) as base_rate, round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc, round(ks, 6) as ks, round(precision_at_k, 6) as precision_at_k, round(recall_at_k, 6) as recall_at_k, round(lift_at_k, 6) as lift_at_k from curves join tops using (split)""")
def metrics_by_split(spark, sf_dir):
    """All metrics of every split, the calibration half of valid and the rows of oot that are not empty."""
    s = splitting.calibration_carve(splitting.split_by_day(orders(spark, sf_dir)), ["day", "o_orderkey"])
    s = s.select("o_orderkey", "y", "score", "split", "calibration", (F.col("o_orderkey") % 11 == 0).alias("all_missing"))
    return _r(ranking.evaluated(ranking.with_companions(s), TIES), ["base_rate", "roc_auc", "pr_auc", "ks", "precision_at_k", "recall_at_k", "lift_at_k"])


@query(f"with {ORDER_SQL} select greatest(0, least(floor(score * 10), 9))::int as bin, count(*) as n, round(avg(score), 6) as mean_score, round(avg(y), 6) as rate from ord group by 1")
def calibration_bins(spark, sf_dir):
    return _r(ranking.calibration_bins(orders(spark, sf_dir)), ["mean_score", "rate"])


QUANTS = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query(f"with {ORDER_SQL} select o_orderpriority as seed, count(*) as n, round(avg(score), 6) as mean, round(stddev_pop(score), 6) as std, min(score)::double as least, max(score)::double as most, {', '.join(f'round(quantile_cont(score, {q})::double, 6) as p{int(q * 100)}' for q in QUANTS)} from ord group by 1")
def score_quantiles(spark, sf_dir):
    o = orders(spark, sf_dir).withColumnRenamed("o_orderpriority", "seed")
    sums = o.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.stddev_pop("score"), 6).alias("std"), F.min("score").alias("least"), F.max("score").alias("most"))
    f = _score_quantiles(o, {f"p{int(q * 100)}": q for q in QUANTS}, ["seed"])
    return sums.join(f.select("seed", *(F.round(c, 6).alias(c) for c in f.columns if c != "seed")), "seed")


def _score_quantiles(df, shares, by):
    """(by..., names...): quantiles of the score, by a histogram of its values."""
    return quantiles(histogram(df.select(*by, F.col("score").cast("double").alias("value")), None, by), shares, by)


SCORED = f"{CUTS_SQL}, s as (select *, case when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split from ord, cuts)"


@query(f"""{SCORED}, cut as (select quantile_cont(score, 0.9) as p90 from s where split = 'oot')
select o_orderpriority as seed, round(avg(score), 6) as mean, round(median(score)::double, 6) as median, round(avg((score >= p90)::int), 6) as share from s, cut group by 1""")
def score_summary(spark, sf_dir):
    s = splitting.split_by_day(orders(spark, sf_dir))
    s = s.withColumnRenamed("o_orderpriority", "seed")
    cut = _score_quantiles(s.where("split = 'oot'"), {"p90": 0.9}, ["split"]).select("p90")
    sums = s.crossJoin(F.broadcast(cut)).groupBy("seed").agg(F.round(F.avg("score"), 6).alias("mean"), F.round(F.avg((F.col("score") >= F.col("p90")).cast("int")), 6).alias("share"))  # one row
    return sums.join(_score_quantiles(s, {"median": 0.5}, ["seed"]), "seed").select("seed", "mean", F.round("median", 6).alias("median"), "share")


DECILES = f"""{SCORED}, e as (select quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::double[] as e from s where split = 'oot'),
d as (select o_orderpriority as seed, len(list_filter(e, lambda x: x <= score)) + 1 as decile, split from s, e), c as (select seed, decile, count(*) as n from d group by all)"""


def _deciles(spark, sf_dir):
    s = splitting.split_by_day(orders(spark, sf_dir))
    names = {f"e{k}": k / 10 for k in range(1, 10)}
    edges = _score_quantiles(s.where("split = 'oot'"), names, ["split"]).select(F.array(*names).alias("e"))
    placed = s.crossJoin(F.broadcast(edges)).withColumn("decile", F.size(F.filter("e", lambda x: x <= F.col("score"))) + 1)  # one row
    return placed.withColumnRenamed("o_orderpriority", "seed").groupBy("seed", "decile").agg(F.count(F.lit(1)).alias("n"))


@query(f"{DECILES} select seed, decile, n, round(n / sum(n) over (partition by seed), 6) as share from c")
def score_deciles(spark, sf_dir):
    from pyspark.sql import Window

    return _deciles(spark, sf_dir).withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("seed")), 6))


SEEDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(f"{DECILES} select seed, round(coalesce(sum(n) filter (where decile = 10), 0) / sum(n), 6) as share, round(coalesce(sum(n) filter (where decile = 10), 0) / sum(n) / 0.1, 6) as enrichment from c group by seed")
def decile_enrichment(spark, sf_dir):
    """How often each population reaches the top decile, against a tenth."""
    share = F.sum(F.when(F.col("decile") == 10, F.col("n")).otherwise(0)) / F.sum("n")
    return _deciles(spark, sf_dir).groupBy("seed").agg(F.round(share, 6).alias("share"), F.round(share / 0.1, 6).alias("enrichment"))


@query(f"{DECILES} select decile, " + ", ".join(f"sum(n) filter (where seed = '{x}') as s{i}" for i, x in enumerate(SEEDS)) + " from c group by decile")
def decile_pivot(spark, sf_dir):
    wide = _deciles(spark, sf_dir).groupBy("decile").pivot("seed", SEEDS).agg(F.sum("n"))
    return wide.select("decile", *(F.col(f"`{x}`").alias(f"s{i}") for i, x in enumerate(SEEDS)))
