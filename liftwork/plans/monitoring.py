"""Queries of drift monitoring over orders, their priorities as populations, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwork.operators import drift, selection, signals, splitting
from liftwork.operators.histogram import histogram
from liftwork.plans.features import BIN_SQL, edges_sql
from liftwork.plans.splits import CUTS_SQL
from liftwork.sources.intermediate import stored
from liftwork.sources.products import LINE_SQL, line_values, orders

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


NAMES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FEATURES = ["price_30d", "price_90d", "score_all", "cust_all"]
# The score does not exist for the last population; some values are missing, more of them in the first.
MONITOR_SQL = f"""{CUTS_SQL.replace("with ", "with recursive ", 1)},
marked as (select *, coalesce(day > cut2, true) as late, o_orderpriority as population from ord, cuts),
wide as (select population, late, case when o_orderkey % 10 < 2 then null else o_totalprice::double end as price_30d,
  case when o_orderkey % 7 = 0 or (population = '1-URGENT' and o_orderkey % 3 = 0) then null else o_totalprice::double * (o_custkey % 5 + 1) end as price_90d, score::double as score_all, o_custkey::double as cust_all from marked),
mon as ({" union all ".join(f"select population, late, '{f}' as feature, {f} as value from wide" for f in FEATURES)}),
base_rows as (select feature, value from mon), oot_rows as (select feature, value from mon where late),
seed_rows as (select population, feature, value from mon where not (population = '5-LOW' and feature = 'score_all'))"""


def values(spark, sf_dir) -> DataFrame:
    """(population, late, feature, value)."""
    s = splitting.split_by_day(orders(spark, sf_dir))
    key, price, population = F.col("o_orderkey"), F.col("o_totalprice").cast("double"), F.col("o_orderpriority")
    wide = s.select(
        population.alias("population"), (F.col("split") == "oot").alias("late"), F.when(key % 10 >= 2, price).alias("price_30d"),
        F.when(~((key % 7 == 0) | ((population == "1-URGENT") & (key % 3 == 0))), price * (F.col("o_custkey") % 5 + 1)).alias("price_90d"),
        F.col("score").cast("double").alias("score_all"), F.col("o_custkey").cast("double").alias("cust_all"),
    )
    return wide.unpivot(["population", "late"], FEATURES, "feature", "value")


def histograms(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Histograms of all rows, of the late ones and of each population, from one pass."""
    whole = histogram(values(spark, sf_dir), None, ["population", "late", "feature"])
    merged = lambda d, *by: stored(d.groupBy(*by, "value").agg(F.sum("n").alias("n"), F.lit(0).cast("long").alias("pos")), "merged-histogram")
    seeds = whole.where("not (population = '5-LOW' and feature = 'score_all')")
    return merged(whole, "feature"), merged(whole.where("late"), "feature"), merged(seeds, "population", "feature")


def psi_sql(base: str, rows: str, name: str) -> str:
    """Tables that end in ``name`` (population, feature, psi)."""
    q = name + "_"
    return f"""{edges_sql(base, q + "edges")},
{q}exp as (select feature, bin, count(*) as e from (select feature, {BIN_SQL} from {base} join {q}edges using (feature)) group by all),
{q}act as (select population, feature, bin, count(*) as a from (select population, feature, {BIN_SQL} from {rows} join {q}edges using (feature)) group by all),
{q}grid as (select population, feature, bin, e from (select distinct population, feature from {q}act) join {q}exp using (feature)),
{q}both as (select population, feature, bin, coalesce(e, 0) as e, coalesce(a, 0) as a from {q}grid full join {q}act using (population, feature, bin)),
{q}shares as (select population, feature, greatest(e / sum(e) over w, case when e = 0 then 1e-6 else 0 end) as e, greatest(a / sum(a) over w, case when a = 0 then 1e-6 else 0 end) as a from {q}both window w as (partition by population, feature)),
{name} as (select population, feature, sum((a - e) * ln(a / e)) as psi from {q}shares group by all)"""


def _flag(c: str) -> str:
    return f"case when {c} is null then 'missing' when {c} < 0.1 then 'stable' when {c} < 0.25 then 'shift' else 'broken' end"


DRIFT_SQL = f"""{MONITOR_SQL}, {psi_sql("base_rows", "seed_rows", "pf")}, {psi_sql("oot_rows", "seed_rows", "po")},
prof as (select population, feature, count(*) as n, avg((value is null)::int) as missing_rate, avg(value) as mean, median(value) as median, quantile_cont(value, 0.1) as p10, quantile_cont(value, 0.9) as p90 from seed_rows group by all),
pairs as (select population, feature from (select unnest({NAMES}) as population), (select unnest({FEATURES}) as feature)),
drift as (select p.population, p.feature, pf.psi as psi_full, {_flag("pf.psi")} as flag_full, po.psi as psi_oot, {_flag("po.psi")} as flag_oot, n, missing_rate, mean, median, p10, p90
  from pairs p left join pf using (population, feature) left join po using (population, feature) left join prof using (population, feature))"""


def _drift(spark, sf_dir) -> DataFrame:
    return stored(drift.seed_drift(*histograms(spark, sf_dir), FEATURES, NAMES), "drift")


def _round(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.select(*(F.round(c, places[c]).alias(c) if c in places else f"`{c}`" for c in df.columns))


@query(f"{DRIFT_SQL} select population, feature, round(psi_full, 6) as psi_full, flag_full, round(psi_oot, 6) as psi_oot, flag_oot, n, round(missing_rate, 6) as missing_rate, round(mean, 3) as mean, round(median, 3) as median, round(p10, 3) as p10, round(p90, 3) as p90 from drift")
def seed_drift(spark, sf_dir):
    return _round(_drift(spark, sf_dir), {"psi_full": 6, "psi_oot": 6, "missing_rate": 6} | dict.fromkeys(("mean", "median", "p10", "p90"), 3))


@query(f"""{DRIFT_SQL} select population, max(n) as n_rows, count(psi_oot) as compared, count(*) - count(psi_oot) as missing, round(avg(psi_oot), 6) as mean_psi, round(median(psi_oot), 6) as median_psi,
{", ".join(f"round(count(*) filter (where flag_oot = '{f}') / count(psi_oot), 6) as {f}" for f in ("stable", "shift", "broken"))},
array_to_string(list(feature order by psi_oot desc, feature) filter (where psi_oot is not null)[1:5], ',') as top_features from drift group by population""")
def seed_summary(spark, sf_dir):
    return _round(drift.seed_summary(_drift(spark, sf_dir)), dict.fromkeys(("mean_psi", "median_psi", "stable", "shift", "broken"), 6))


@query(f"{DRIFT_SQL} select population, feature, round(psi_oot, 6) as psi_oot, row_number() over (partition by population order by psi_oot desc, feature) as ordinal from drift where psi_oot is not null qualify ordinal <= 2")
def top_shift(spark, sf_dir):
    """The two features of each population that moved most."""
    return _round(drift.top_shift(_drift(spark, sf_dir), 2).select("population", "feature", "psi_oot", "ordinal"), {"psi_oot": 6})


@query(f"{DRIFT_SQL} select feature, " + ", ".join(f"round(max(psi_oot) filter (where population = '{n}'), 6) as s{i}" for i, n in enumerate(NAMES)) + ", round(max(psi_oot), 6) as most from drift group by feature")
def psi_matrix(spark, sf_dir):
    wide = drift.psi_matrix(_drift(spark, sf_dir), NAMES)
    return wide.select("feature", *(F.round(F.col(f"`{n}`"), 6).alias(f"s{i}") for i, n in enumerate(NAMES)), F.round("most", 6).alias("most"))


CROSS_SQL = f"""{MONITOR_SQL}, cross_base as (select population || '~' || feature as feature, value from seed_rows),
cross_rows as (select s.population, b.population || '~' || s.feature as feature, value from seed_rows s, (select distinct population from seed_rows) b), {psi_sql("cross_base", "cross_rows", "pc")}"""


@query(f"{CROSS_SQL} select string_split(feature, '~')[1] as expected, population as actual, case when string_split(feature, '~')[1] = population then 0 else round(avg(psi), 6) end as psi from pc group by 1, 2")
def seed_cross_psi(spark, sf_dir):
    return _round(drift.cross_psi(histograms(spark, sf_dir)[2], NAMES), {"psi": 6})


@query(f"{DRIFT_SQL} select population, regexp_replace(feature, '_(30d|90d|all)$', '') as family, count(*) as n, round(avg(psi_oot), 6) as mean_psi from drift where psi_oot is not null group by 1, 2 having count(*) >= 2")
def family_drift(spark, sf_dir):
    families = selection.parse_families(spark.createDataFrame([(f,) for f in FEATURES], "feature string"))
    return _round(drift.family_drift(_drift(spark, sf_dir), families), {"mean_psi": 6})


@query(f"""{MONITOR_SQL}, own as (select population, feature, avg((value is null)::int) as r from seed_rows group by all), base as (select feature, avg((value is null)::int) as b from oot_rows group by all)
select population, feature, round(r - b, 6) as delta, row_number() over (partition by population order by abs(round(r - b, 9)) desc, feature) as ordinal from own join base using (feature) qualify ordinal <= 10""")
def missing_delta(spark, sf_dir):
    _, oot, seeds = histograms(spark, sf_dir)
    return _round(drift.missing_delta(seeds, oot), {"delta": 6})


@query(f"{MONITOR_SQL}, ref_rows as (select feature, value from mon where not late), new_rows as (select 'new' as population, feature, value from mon where late), {psi_sql('ref_rows', 'new_rows', 'pm')} select feature, round(psi, 6) as psi, {_flag('psi')} as flag from pm")
def feature_monitor(spark, sf_dir):
    """A new batch, the late rows, against the reference rows before it."""
    hist = histogram(values(spark, sf_dir), None, ["late", "feature"])
    return _round(drift.two_source_psi(hist.where("not late"), hist.where("late")), {"psi": 6})


@query(f"{MONITOR_SQL}, score_base as (select feature, value from oot_rows where feature = 'score_all'), score_rows as (select population, feature, value from mon where feature = 'score_all'), {psi_sql('score_base', 'score_rows', 'ps')} select population, round(psi, 6) as psi, {_flag('psi')} as flag from ps")
def score_psi(spark, sf_dir):
    """Scores of every population against those of the late rows."""
    hist = histogram(values(spark, sf_dir).where("feature = 'score_all'"), None, ["population", "late", "feature"])
    merged = lambda d, *by: d.groupBy(*by, "value").agg(F.sum("n").alias("n"), F.lit(0).cast("long").alias("pos"))
    psi = drift.population_psi(merged(hist.where("late"), "feature"), merged(hist, "population", "feature"))
    return psi.select("population", F.round("psi", 6).alias("psi"), signals.psi_flag(F.col("psi")).alias("flag"))


TWO_SQL = f"""with recursive {LINE_SQL}, two_exp as (select feature, value from values_ where flag = 'N'), two_act as (select 'actual' as population, feature, value from values_ where flag <> 'N'), {psi_sql("two_exp", "two_act", "pt")}"""


@query(f"{TWO_SQL} select feature, round(psi, 6) as psi, {_flag('psi')} as flag from pt")
def psi_two_sources(spark, sf_dir):
    """Two tables of the same features: lines that were never returned, and the rest."""
    v = line_values(spark, sf_dir, ("l_returnflag",))
    sides = [histogram(v.where(F.col("l_returnflag") == "N"), None), histogram(v.where(F.col("l_returnflag") != "N"), None)]
    return _round(drift.two_source_psi(*sides), {"psi": 6})
