"""Queries of the per-feature statistics over lineitem, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftwork.functions.cleaning import clean
from liftwork.operators import binning, scan, signals
from liftwork.operators.histogram import histogram, ordered, quantiles
from liftwork.sources.intermediate import stored
from liftwork.sources.products import LINE_FEATURES, LINE_SQL, RULES, line_values, lines

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _r(name: str) -> Column:
    return F.round(name, 6).alias(name)


def edges_sql(source: str, name: str = "edges") -> str:
    """Tables that end in ``name`` (feature, n, n_unique, edges): equal-frequency edges of (feature, value) rows, small bins merged."""
    q = name + "_"
    return f"""{q}quant as (select feature, count(value) as n, count(distinct value) as n_unique, quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as q, list_sort(list(distinct value) filter (where value is not null)) as u from {source} group by feature),
{q}raw as (select feature, n, n_unique, greatest(50, n // 100) as least, case when n_unique = 0 then [] when n_unique = 1 then [u[1], u[1] + 1e-12]
  when n_unique <= 10 then list_concat(list_concat([u[1]], list_transform(range(1, len(u)), lambda i: (u[i] + u[i + 1]) / 2)), [u[len(u)]]) else list_sort(list_distinct(q)) end as edges from {q}quant),
{q}bins as (select feature, list(len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value))) as bins from {source} join {q}raw using (feature) where value is not null group by feature),
{q}start as (select r.*, case when n_unique = 0 then [] else list_transform(range(0, len(edges) - 1), lambda b: len(list_filter(bins, lambda x: x = b))) end as counts from {q}raw r left join {q}bins using (feature)),
{q}merge as (select feature, n, n_unique, least, edges, counts from {q}start union all
  select feature, n, n_unique, least, list_concat(edges[1:a], edges[a + 2:]), list_concat(list_concat(counts[1:a - 1], [counts[a] + counts[a + 1]]), counts[a + 2:])
  from (select *, case when i = len(counts) or (i > 1 and counts[i - 1] <= counts[i + 1]) then i - 1 else i end as a
    from (select *, list_position(counts, list_min(counts)) as i from {q}merge where len(counts) > 1 and list_min(counts) < least))),
{name} as (select feature, n, n_unique, edges from {q}merge where not (len(counts) > 1 and list_min(counts) < least))"""


BIN_SQL = "case when value is null then -1 else len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) end as bin"
EDGES_SQL = f"""with recursive {LINE_SQL},
{edges_sql("values_")},
binned as (select v.feature, v.value, v.y, v.day, v.flag, {BIN_SQL} from values_ v join edges using (feature)),
counts as (select feature, bin, count(*) as n, sum(y) as pos from binned group by feature, bin)"""
WOE_SQL = f"""{EDGES_SQL},
woe as (select feature, bin, n, pos, ln(((pos + 1e-6) / (sum(pos) over w + 1e-6)) / ((n - pos + 1e-6) / (sum(n - pos) over w + 1e-6))) as woe,
  pos / sum(pos) over w - (n - pos) / sum(n - pos) over w as gap from counts window w as (partition by feature))"""


def _hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(line_values(spark, sf_dir, ("y",)))


def _edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    hist = _hist(spark, sf_dir)
    return hist, binning.equal_frequency_edges(hist)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binning.counted(*_edges(spark, sf_dir))


@query(f"with {LINE_SQL} select feature, value, y, day from values_")
def clean_missing(spark, sf_dir):
    return line_values(spark, sf_dir)


@query(f"with {LINE_SQL} select feature, round(count(*) filter (where value is null) / count(*), 6) as missing_rate, count(distinct value) as n_unique, count(*) as n_total from values_ group by feature")
def missing_stats(spark, sf_dir):
    return signals.missing_stats(_hist(spark, sf_dir)).select("feature", _r("missing_rate"), "n_unique", "n_total")


@query(f"{EDGES_SQL} select feature, n, n_unique, unnest(list_transform(edges, lambda e: round(e, 4))) as edge from edges")
def bin_edges_equal_freq(spark, sf_dir):
    edges = _edges(spark, sf_dir)[1]
    return edges.select("feature", "n", "n_unique", F.explode("edges").alias("edge")).withColumn("edge", F.round("edge", 4))


@query(f"{EDGES_SQL} select feature, value, bin, count(*) as n from binned group by all")
def digitize(spark, sf_dir):
    hist, edges = _edges(spark, sf_dir)
    return binning.digitized(hist, edges).select("feature", "value", "bin", "n")


@query(f"{EDGES_SQL} select feature, bin, n, pos from counts")
def bin_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(f"{WOE_SQL} select feature, bin, n, pos, round(woe, 6) as woe from woe")
def woe_table(spark, sf_dir):
    return signals.woe_table(_counts(spark, sf_dir)).select("feature", "bin", "n", "pos", _r("woe"))


@query(f"{WOE_SQL} select feature, round(sum(gap * woe), 6) as iv, count(*) filter (where bin >= 0) as n_bins from woe group by feature")
def iv_woe(spark, sf_dir):
    return signals.information_value(signals.woe_table(_counts(spark, sf_dir))).select("feature", _r("iv"), "n_bins")


@query(f"""{WOE_SQL}, steps as (select feature, woe - lag(woe) over (partition by feature order by bin) as step from woe where bin >= 0)
select feature, coalesce(min(step), 0) >= -1e-6 or coalesce(max(step), 0) <= 1e-6 as monotonic from steps group by feature""")
def woe_monotonic(spark, sf_dir):
    return signals.monotonic(signals.woe_table(_counts(spark, sf_dir)))


# Population stability: the earlier half of all days is expected, the later half actual.
PSI_SIDES = """halves as (select floor(quantile_cont(day, 0.5)) as cut from line)"""
PSI_SQL = f"""with recursive {LINE_SQL}, {PSI_SIDES},
sided as (select feature, value, y, coalesce(day <= cut, false) as expected from values_, halves), early as (select * from sided where expected),
{edges_sql("early", "pedges")},
pbinned as (select v.feature, v.expected, {BIN_SQL} from sided v join pedges using (feature)),
sides as (select feature, bin, count(*) filter (where expected) as e, count(*) filter (where not expected) as a from pbinned group by all),
shares as (select feature, greatest(e / sum(e) over w, case when e = 0 then 1e-6 else 0 end) as e, greatest(a / sum(a) over w, case when a = 0 then 1e-6 else 0 end) as a from sides window w as (partition by feature)),
psi as (select feature, sum((a - e) * ln(a / e)) as psi from shares group by feature)"""


def halves(values: DataFrame, days: DataFrame) -> DataFrame:
    """``values`` with expected: whether the day is in the earlier half of ``days``; rows without a day are later."""
    counts = days.where("day is not null").groupBy(F.lit("day").alias("feature"), F.col("day").cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("pos"))
    cut = quantiles(counts, {"cut": 0.5}).select(F.floor("cut").alias("cut"))
    return values.crossJoin(F.broadcast(cut)).withColumn("expected", F.coalesce(F.col("day") <= F.col("cut"), F.lit(False))).drop("cut")  # one row


def side_counts(sided: DataFrame, n_bins: int = 10) -> DataFrame:
    """(feature, bin, expected, actual): counts with edges from the expected side."""
    return side_bins(histogram(sided.withColumn("early", F.col("expected").cast("int")), "early"), n_bins)


def side_bins(hist: DataFrame, n_bins: int = 10) -> DataFrame:
    """``side_counts`` of a histogram (feature, value, n, pos) whose pos are the rows of the expected side."""
    early = hist.where("pos > 0").select("feature", "value", F.col("pos").alias("n"), F.lit(0).cast("long").alias("pos"))
    edges = binning.equal_frequency_edges(early, n_bins)
    return binning.counted(hist, edges).select("feature", "bin", F.col("pos").alias("expected"), (F.col("n") - F.col("pos")).alias("actual"))


def _psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.psi(side_counts(halves(line_values(spark, sf_dir, ("day",)), lines(spark, sf_dir))))


@query(f"{PSI_SQL} select feature, round(psi, 6) as psi from psi")
def psi(spark, sf_dir):
    return _psi(spark, sf_dir).select("feature", _r("psi"))


@query(f"{PSI_SQL} select feature, case when psi < 0.00005 then 'stable' when psi < 0.001 then 'shift' else 'broken' end as flag from psi")
def psi_flag(spark, sf_dir):
    return _psi(spark, sf_dir).select("feature", signals.psi_flag(F.col("psi"), 0.00005, 0.001).alias("flag"))


@query(f"with {LINE_SQL}, {PSI_SIDES} select coalesce(day <= cut, false) as expected, min(day) as first_day, max(day) as last_day, count(*) as n from line, halves group by 1")
def psi_halves(spark, sf_dir):
    sided = halves(lines(spark, sf_dir), lines(spark, sf_dir))
    return sided.groupBy("expected").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n"))


LIFT_SQL = f"""{EDGES_SQL},
ranked as (select *, sum(n) over (o rows unbounded preceding) as cn, row_number() over o as r, sum(n) over w as total, sum(pos) over w as positives from counts
  window w as (partition by feature), o as (partition by feature order by pos / n desc, case when bin < 0 then 1 << 30 else bin end)),
taken as (select feature, sum(n) as n, sum(pos) as pos, max(total) as total, max(positives) as positives, sum(pos) filter (where r = 1) as top from ranked where cn - n < greatest(1, ceil(total * 0.1)) group by feature)"""


@query(f"{LIFT_SQL} select feature, round((pos / n) / (positives / total), 6) as lift from taken")
def feature_lift_at_k(spark, sf_dir):
    return signals.lift_at_k(_counts(spark, sf_dir)).select("feature", _r("lift"))


@query(f"{LIFT_SQL} select feature, round(top / positives, 6) as concentration from taken")
def feature_concentration(spark, sf_dir):
    return signals.lift_at_k(_counts(spark, sf_dir)).select("feature", _r("concentration"))


@query(f"""with {LINE_SQL}, med as (select feature, median(value) as m from values_ group by feature),
filled as (select feature, coalesce(value, m) as value, y from values_ join med using (feature)),
ranked as (select feature, y, rank() over (partition by feature order by value) + (count(*) over (partition by feature, value) - 1) / 2.0 as r from filled),
sums as (select feature, sum(r) filter (where y = 1) as s, sum(y) as p, sum(1 - y) as q from ranked group by feature)
select feature, round(abs(2 * (s - p * (p + 1) / 2.0) / (p * q) - 1), 6) as gini from sums""")
def feature_gini(spark, sf_dir):
    return signals.gini(_hist(spark, sf_dir)).select("feature", _r("gini"))


@query(f"with {LINE_SQL} select feature, round(avg((value is not null)::int), 6) as coverage from values_ group by feature")
def coverage(spark, sf_dir):
    return signals.missing_stats(_hist(spark, sf_dir)).select("feature", F.round(1 - F.col("missing_rate"), 6).alias("coverage"))


PROFILE = "count(*) as n, round(avg((value is null)::int), 6) as missing_rate, round(avg(value), 4) as mean, round(median(value), 4) as median, round(quantile_cont(value, 0.1), 4) as p10, round(quantile_cont(value, 0.9), 4) as p90"


@query(f"with {LINE_SQL} select feature, {PROFILE} from values_ group by feature")
def column_profile(spark, sf_dir):
    return signals.profile(_hist(spark, sf_dir)).select("feature", "n", _r("missing_rate"), *(F.round(c, 4).alias(c) for c in ("mean", "median", "p10", "p90")))


@query(f"""with {LINE_SQL}, ends as (select feature, min(value) as lo, max(value) as hi from values_ group by feature)
select feature, least(coalesce(floor((value - lo) * 30 / nullif(hi - lo, 0)), 0), 29)::int as bin, count(*) as n, round(avg(y), 6) as rate from values_ join ends using (feature) where value is not null group by 1, 2""")
def histogram_posrate(spark, sf_dir):
    return signals.histogram(line_values(spark, sf_dir)).select("feature", "bin", "n", _r("rate"))


@query(f"""{EDGES_SQL} select feature, bin, round(sum(n) over o / sum(n) over w, 6) as population, round((sum(pos) over o / sum(n) over o) / (sum(pos) over w / sum(n) over w), 6) as lift, round(sum(pos) over o / sum(pos) over w, 6) as recall
from counts window w as (partition by feature), o as (partition by feature order by pos / n desc, case when bin < 0 then 1 << 30 else bin end rows unbounded preceding)""")
def cum_lift_curve(spark, sf_dir):
    whole = Window.partitionBy("feature")
    upto = whole.orderBy(F.desc(F.col("pos") / F.col("n")), F.when(F.col("bin") < 0, 1 << 30).otherwise(F.col("bin"))).rowsBetween(Window.unboundedPreceding, 0)
    n, pos, total, positives = (F.sum(c).over(w) for w in (upto, whole) for c in ("n", "pos"))
    return _counts(spark, sf_dir).select("feature", "bin", F.round(n / total, 6).alias("population"), F.round((pos / n) / (positives / total), 6).alias("lift"), F.round(pos / positives, 6).alias("recall"))


@query(f"""{EDGES_SQL.replace("greatest(50, n // 100)", "greatest(50, n * 105 // 1000)")} select feature, len(edges) as n_edges, list_sum(edges) as edge_sum from edges""".replace("list_sum(edges)", "round(list_sum(edges), 4)"))
def merge_small_bins(spark, sf_dir):
    """Edges after bins under 10.5 per cent of the rows have been merged."""
    hist = _hist(spark, sf_dir)
    plain = binning.equal_frequency_edges(hist, least=0)
    merged = binning.merged_edges(hist, plain.withColumn("least", F.greatest(F.lit(50), F.floor(F.col("n") * 105 / 1000))))
    return merged.select("feature", F.size("edges").alias("n_edges"), F.round(F.aggregate("edges", F.lit(0.0), lambda a, e: a + e), 4).alias("edge_sum"))


@query()
def bin_edges_tree(spark, sf_dir):
    return binning.tree_edges(_hist(spark, sf_dir))


_GINI_SQL = """med as (select feature, median(value) as m from values_ group by feature), filled as (select feature, coalesce(value, m) as value, y from values_ join med using (feature)),
granks as (select feature, y, rank() over (partition by feature order by value) + (count(*) over (partition by feature, value) - 1) / 2.0 as r from filled),
gsums as (select feature, sum(r) filter (where y = 1) as s, sum(y) as p, sum(1 - y) as q from granks group by feature)"""
_after = lambda sql, name: sql[sql.index(f"\n{name} as ("):]


@query(f"""{WOE_SQL}, {_after(LIFT_SQL, "ranked").strip()}, {_GINI_SQL}, {PSI_SIDES}, {PSI_SQL[PSI_SQL.index("sided as ("):]},
steps as (select feature, woe - lag(woe) over (partition by feature order by bin) as step from woe where bin >= 0), mono as (select feature, coalesce(min(step), 0) >= -1e-6 or coalesce(max(step), 0) <= 1e-6 as monotonic from steps group by feature),
ivs as (select feature, sum(gap * woe) as iv, count(*) filter (where bin >= 0) as n_bins from woe group by feature),
miss as (select feature, count(*) filter (where value is null) / count(*) as missing_rate, count(distinct value) as n_unique, count(*) as n_total from values_ group by feature)
select feature, round(iv, 6) as iv, n_bins, monotonic, round((t.n / total) / 1, 6) * 0 + round((t.pos / t.n) / (positives / total), 6) as lift, round(top / positives, 6) as concentration, round(abs(2 * (s - p * (p + 1) / 2.0) / (p * q) - 1), 6) as gini,
  round(missing_rate, 6) as missing_rate, n_unique, n_total, round(psi, 6) as psi from ivs join mono using (feature) join taken t using (feature) join gsums using (feature) join miss using (feature) join psi using (feature)""".replace("round((t.n / total) / 1, 6) * 0 + ", ""))
def scan_all(spark, sf_dir):
    """Every signal of a feature in one report, best value first: all are read from one table with a row a distinct value."""
    sided = halves(line_values(spark, sf_dir), lines(spark, sf_dir))
    cells = sided.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("y", F.lit(0)).cast("long")).alias("pos"), F.count_if("expected").alias("early"))
    cells = stored(cells, "scan-cells")
    hist = cells.select("feature", "value", "n", "pos")
    stable = signals.psi(side_bins(cells.select("feature", "value", "n", F.col("early").alias("pos"))))
    placed = ordered(hist)
    counts = stored(binning.counted(hist, binning.equal_frequency_edges(hist, placed=placed)), "scan-counts")
    woe = signals.woe_table(counts)
    parts = [signals.information_value(woe), signals.monotonic(woe), signals.lift_at_k(counts), signals.gini(hist, placed), signals.missing_stats(hist), stable]
    out = reduce(lambda a, b: a.join(b, "feature", "full"), parts)
    out = out.fillna({"iv": 0.0, "lift": 1.0, "gini": 0.0, "concentration": 0.0, "psi": 0.0, "missing_rate": 0.0, "n_unique": 0})
    rounded = ("iv", "lift", "concentration", "gini", "missing_rate", "psi")
    return out.select(*(F.round(c, 6).alias(c) if c in rounded else c for c in out.columns)).orderBy(F.desc("iv"), "feature")


_MASKS = {"supervised": "flag <> 'A'", "unsupervised": "day < 20000101", "expected": "day < 19970101", "actual": "day >= 19990101"}
_MASKED_SQL = f"""with recursive {LINE_SQL},
sup as (select feature, value, y from values_ where {_MASKS["supervised"]}), ref as (select feature, value from values_ where {_MASKS["expected"]}),
{edges_sql("sup", "sedges")},
{edges_sql("ref", "pedges")},
sbins as (select s.feature, s.y, {BIN_SQL} from sup s join sedges using (feature)), counts as (select feature, bin, count(*) as n, sum(y) as pos from sbins group by feature, bin),
woe as (select feature, bin, n, pos, ln(((pos + 1e-6) / (sum(pos) over w + 1e-6)) / ((n - pos + 1e-6) / (sum(n - pos) over w + 1e-6))) as woe, pos / sum(pos) over w - (n - pos) / sum(n - pos) over w as gap from counts window w as (partition by feature)),
ivs as (select feature, sum(gap * woe) as iv, count(*) filter (where bin >= 0) as n_bins from woe group by feature),
miss as (select feature, count(*) filter (where value is null) / count(*) as missing_rate, count(distinct value) as n_unique, count(*) as n_total from values_ where {_MASKS["unsupervised"]} group by feature),
pbins as (select v.feature, {_MASKS["expected"]} as e, {BIN_SQL} from values_ v join pedges using (feature) where {_MASKS["expected"]} or {_MASKS["actual"]}),
psides as (select feature, bin, count(*) filter (where e) as e, count(*) filter (where not e) as a from pbins group by feature, bin),
pshares as (select feature, case when e = 0 then 1e-6 else e / sum(e) over (partition by feature) end as e, case when a = 0 then 1e-6 else a / sum(a) over (partition by feature) end as a from psides),
stable as (select feature, sum((a - e) * ln(a / e)) as psi from pshares group by feature),
wide as (select {", ".join(f"case when {f} <= 0 then null else {f} end as {f}" for f in LINE_FEATURES)} from line where l_returnflag <> 'A'),
pairs as ({" union all ".join(f"select '{a}' as f1, '{b}' as f2, count(*) filter (where {a} is not null and {b} is not null) as n, (select avg({a}) from wide) as ma, (select avg({b}) from wide) as mb, sum(({a} - (select avg({a}) from wide)) * ({b} - (select avg({b}) from wide))) as c, stddev_pop({a}) as sa, stddev_pop({b}) as sb from wide" for k, a in enumerate(LINE_FEATURES) for b in LINE_FEATURES[k + 1:])}),
near as (select unnest([f1, f2]) as feature from pairs where abs(c / (n * sa * sb)) >= 0.002), partners as (select feature, count(*) as n_corr from near group by feature)
select feature, round(iv, 6) as iv, n_bins, round(missing_rate, 6) as missing_rate, n_unique, n_total, round(psi, 6) as psi, coalesce(n_corr, 0) as n_corr from ivs join miss using (feature) join stable using (feature) left join partners using (feature)"""


@query(_MASKED_SQL)
def scan_masked(spark, sf_dir):
    """Every signal over rows of its own: labelled ones, early ones, two periods; with the number of correlated partners."""
    cleaned = lines(spark, sf_dir)
    types = dict(cleaned.dtypes)
    wide = cleaned.select("y", "day", F.col("l_returnflag").alias("flag"), *(clean(f, types[f], RULES).alias(f) for f in LINE_FEATURES))
    found = scan.scan_masked(wide, LINE_FEATURES, *(F.expr(m) for m in _MASKS.values()), threshold=0.002)
    return found.select("feature", _r("iv"), "n_bins", _r("missing_rate"), "n_unique", "n_total", _r("psi"), "n_corr")
