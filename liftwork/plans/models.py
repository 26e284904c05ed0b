"""Queries of models on feature histograms, over orders with features of their lines, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwork.models import screening
from liftwork.operators import binning, selection, signals, splitting
from liftwork.operators.histogram import histogram
from liftwork.plans.features import edges_sql
from liftwork.sources.intermediate import stored
from liftwork.sources.products import ORDER_SQL, orders, table

QUERIES, SQL = {}, {}
KEY = "o_orderkey"
FEATURES = ["price", "qty", "discount", "n_lines", "hint"]
NULLS, SEED = 30, 42


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def ordered_goods(spark, sf_dir):
    """orders with y, day and five features, written once; those of lines are NULL for orders without lines, hint tells a little of the label."""
    per_order = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias(KEY)).agg(
        F.sum("l_quantity").alias("qty"), F.round(F.avg("l_discount"), 6).alias("discount"), F.count(F.lit(1)).cast("double").alias("n_lines")
    )
    o = orders(spark, sf_dir).select(KEY, "y", "day", F.col("o_totalprice").alias("price"), F.col("score").alias("hint"))
    return stored(o.join(per_order, KEY, "left").select(KEY, "y", "day", *FEATURES), "goods")


GOODS_SQL = f"""{ORDER_SQL},
lines_of as (select l_orderkey, sum(l_quantity) as qty, round(avg(l_discount), 6) as discount, count(*)::double as n_lines from lineitem group by l_orderkey),
goods as (select {KEY}, y, day, o_totalprice as price, qty, discount, n_lines, score::double as hint from ord left join lines_of on l_orderkey = {KEY}),
goods_long as (select {KEY}, y, unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) as feature, unnest([{", ".join(FEATURES)}]) as value from goods)"""

_BIN = "case when value is null then -1 else len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) end"
#: The best first split of each feature, for every label run of ``labels`` (run, o_orderkey, y).
SPLITS_SQL = f"""goods_bins as (select {KEY}, g.feature, {_BIN} as bin from goods_long g join gedges using (feature)),
cells as (select run, feature, bin, count(*) as n, sum(l.y) as pos from goods_bins join labels l using ({KEY}) group by all),
weighed as (select *, sum(n - pos) over w / sum(pos) over w as scale from cells window w as (partition by run, feature)),
sums as (select run, feature, bin, (n - pos - pos * scale) / 2 as g, (n - pos + pos * scale) / 4 as h from weighed),
upto as (select run, feature, bin, sum(g) over w as ag, sum(h) over w as ah, coalesce(sum(g) filter (where bin >= 0) over o, 0) as cg, coalesce(sum(h) filter (where bin >= 0) over o, 0) as ch,
  coalesce(sum(g) filter (where bin < 0) over w, 0) as mg, coalesce(sum(h) filter (where bin < 0) over w, 0) as mh from sums
  window w as (partition by run, feature), o as (partition by run, feature order by bin)),
ways as (select run, feature, bin, ml, ag, ah, cg + case when ml then mg else 0 end as lg, ch + case when ml then mh else 0 end as lh from upto, (values (true), (false)) as t(ml)),
gains as (select run, feature, bin, ml, round((lg * lg / (lh + 1) + (ag - lg) * (ag - lg) / (ah - lh + 1) - ag * ag / (ah + 1)) / 2, 9) as gain from ways where bin >= 0 and lh >= 1 and ah - lh >= 1),
splits as (select run, feature, gain, bin, ml as missing_left from gains qualify row_number() over (partition by run, feature order by gain desc, bin, ml desc) = 1)"""


@query(f"with recursive {GOODS_SQL}, {edges_sql('goods_long', 'gedges')}, labels as (select 0 as run, {KEY}, y from goods), {SPLITS_SQL} select feature, bin, missing_left, round(gain, 5) as gain from splits")
def boosted_first_split(spark, sf_dir):
    """The split that a tree on each feature alone begins with."""
    df = ordered_goods(spark, sf_dir)
    found = screening.root_gains(df, KEY, screening.train_edges(df, FEATURES), [F.col("y")])
    return found.select("feature", F.col("bin").cast("long").alias("bin"), "missing_left", F.round("gain", 5).alias("gain"))


@query(f"""with recursive {GOODS_SQL}, {edges_sql('goods_long', 'gedges')},
digests as (select s, {KEY}, ('0x' || substr(md5({KEY} || '#' || s), 1, 12))::bigint as d from goods, (select unnest(range({SEED + 1000}, {SEED + 1000 + NULLS})) as s)),
labels as (select 0 as run, {KEY}, y from goods union all
  select s - {SEED + 999}, {KEY}, (row_number() over (partition by s order by d, {KEY}) <= (select sum(y) from goods))::int from digests), {SPLITS_SQL},
all_gains as (select run, feature, coalesce(gain, 0) as gain from (select distinct run from labels) cross join (select distinct feature from goods_bins) left join splits using (run, feature)),
refs as (select feature, max(gain) filter (where run = 0) as a, quantile_cont(gain, 0.5) filter (where run > 0) as p50, quantile_cont(gain, 0.75) filter (where run > 0) as p75, quantile_cont(gain, 0.95) filter (where run > 0) as p95 from all_gains group by feature)
select feature, round(a, 5) as gain_actual, round(p50, 5) as null_p50, round(p75, 5) as null_p75, round(p95, 5) as null_keep_ref, round(ln(1 + a) - ln(1 + p75), 5) as score, a > p95 as keep from refs""")
def null_importance(spark, sf_dir):
    """True gains against those of thirty permuted labels, all from one table of counts."""
    found = screening.null_importance(ordered_goods(spark, sf_dir), KEY, FEATURES, n_null=NULLS, seed=SEED)
    rounded = [F.round(c, 5).alias(c) for c in ("gain_actual", "null_p50", "null_p75", "null_keep_ref", "score")]
    return found.select("feature", *rounded, "keep")


@query()
def null_importance_boosted(spark, sf_dir):
    """The same by boosted trees: three runs with the true label and ten with permuted ones grow together."""
    return screening.null_importance(ordered_goods(spark, sf_dir), KEY, FEATURES, n_null=10, seed=SEED, rounds=3, depth=2)


@query()
def probing_gains(spark, sf_dir):
    """Gain, splits and cover of a model grown on train and ended by valid."""
    split = splitting.split_by_day(ordered_goods(spark, sf_dir))
    return screening.probing(split, KEY, FEATURES, rounds=8, patience=3, metric="logloss")[1].drop("run")


@query()
def quadrants_probed(spark, sf_dir):
    """Features by their information value and the gain of a probing model, grown until valid has not been better for thirty rounds."""
    df = ordered_goods(spark, sf_dir)
    _, gains = screening.probing(splitting.split_by_day(df), KEY, FEATURES, rounds=None, patience=30, metric="logloss")
    values = df.select("y", *(F.col(f).cast("double").alias(f) for f in FEATURES)).unpivot(["y"], FEATURES, "feature", "value")
    hist = histogram(values)
    iv = signals.information_value(signals.woe_table(binning.counted(hist, binning.equal_frequency_edges(hist))))
    return selection.quadrants(gains.join(iv, "feature")).select("feature", "iv", "gain", "gain_rank_pct", "coverage", "quadrant")


@query()
def stability_ranks(spark, sf_dir):
    """Mean rank share of the gain over three seeds."""
    split = splitting.split_by_day(ordered_goods(spark, sf_dir))
    return screening.stability(split, KEY, FEATURES, seeds=3, rounds=3, patience=0)


def _score():
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return zero("hint") + zero("qty") / 500 - zero("price") / 1000000


_SCORED = ["price", "qty", "hint"]
_SCORE_SQL = "round(coalesce({hint}, 0) + coalesce({qty}, 0) / 500 - coalesce({price}, 0) / 1000000, 9)"
_DEALT = {f: f"case when feature = '{f}' then given else b.{f} end" for f in _SCORED}
LOSS_SQL = f"""with {GOODS_SQL}, base as (select *, row_number() over (order by {KEY}) as r from goods),
donors as (select feature, s, case feature when 'price' then price when 'qty' then qty else hint end as given,
  row_number() over (partition by feature, s order by ('0x' || substr(md5({KEY} || '#' || feature || '#' || s), 1, 12))::bigint, {KEY}) as r
  from goods, (select unnest(['price', 'qty', 'hint']) as feature), (select unnest([1, 2, 3]) as s)),
cases as (select '' as feature, 0 as s, y, {_SCORE_SQL.format(hint="hint", qty="qty", price="price")} as score from base union all
  select feature, s, y, {_SCORE_SQL.format(**_DEALT)} from base b join donors using (r)),
ties as (select feature, s, score, count(*) as n, sum(y) as pos from cases group by all),
curve as (select *, sum(n) over o as cn, sum(pos) over o as cp, sum(pos) over (partition by feature, s) as p from ties window o as (partition by feature, s order by score desc)),
areas as (select feature, s, sum(pos * cp / cn) / max(p) as area from curve group by feature, s),
losses as (select feature, s as seed, (select area from areas where feature = '') - area as loss from areas where feature <> '')"""


def _losses(spark, sf_dir):
    return screening.permutation_losses(ordered_goods(spark, sf_dir), KEY, _SCORED, _score(), [1, 2, 3])


@query(f"{LOSS_SQL} select feature, seed, round(loss, 6) as loss from losses")
def permutation_losses(spark, sf_dir):
    """How much the area under precision and recall falls with one column dealt anew, for each of three seeds."""
    return _losses(spark, sf_dir).select("feature", "seed", F.round("loss", 6).alias("loss"))


@query(f"""{LOSS_SQL}, shares as (select *, (rank() over (partition by seed order by round(loss, 9)) + (count(*) over (partition by seed, round(loss, 9)) - 1) / 2.0) / count(*) over (partition by seed) as pct from losses)
select feature, round(avg(loss), 6) as loss, round(avg(pct), 6) as permutation_stability from shares group by feature""")
def permutation_ranks(spark, sf_dir):
    found = screening.permutation_ranks(_losses(spark, sf_dir))
    return found.select("feature", F.round("loss", 6).alias("loss"), F.round("permutation_stability", 6).alias("permutation_stability"))


@query()
def forward_cross_validation(spark, sf_dir):
    """Three settings on four forward folds, twelve models grown together."""
    folds = splitting.forward_folds(ordered_goods(spark, sf_dir))
    grid = [{"eta": 0.1, "depth": 2}, {"eta": 0.3, "depth": 2}, {"eta": 0.3, "depth": 1, "subsample": 0.8}]
    return screening.cross_validate(folds, KEY, FEATURES, grid, rounds=4).drop("objective")


