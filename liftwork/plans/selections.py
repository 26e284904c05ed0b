"""Queries of correlation and feature selection over a report made of part, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwork.operators import correlation, selection
from liftwork.sources.products import LINE_FEATURES, RULES, lines, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


W = ("30d", "90d", "180d", "360d", "all")
# A report of 125 features (brand and window) with signals from the parts of each.
REPORT_SQL = """raw as (select lower(replace(p_brand, '#', '')) || '_' || case p_partkey % 5 when 0 then '30d' when 1 then '90d' when 2 then '180d' when 3 then '360d' else 'all' end as feature,
  avg(p_size) / 200 as iv, 1 + avg(p_partkey % 13) / 10 as lift, avg(p_partkey % 7) / 10 as gini, avg(p_partkey % 11) / 25 as psi, avg(p_partkey % 3) / 2 as missing_rate, count(distinct p_size % 4) as n_unique, avg(p_partkey % 17) as gain from part group by 1),
fam as (select *, regexp_extract(feature, '^(.+)_(30d|90d|180d|360d|all)$', 1) as family, regexp_extract(feature, '^(.+)_(30d|90d|180d|360d|all)$', 2) as "window" from raw),
report as (select *, case "window" when '30d' then 1 when '90d' then 2 when '180d' then 3 when '360d' then 4 when 'all' then 5 end as window_rank, case when starts_with(feature, 'brand1') then 'ones' when starts_with(feature, 'brand2') then 'twos' end as grp from fam),
ranked as (select *, count(*) over (partition by family) as family_size, row_number() over (partition by family order by iv desc, feature) as in_family_rank, case when grp is null then 0 else count(*) over (partition by grp) end as group_size,
  case when grp is null then 0 else row_number() over (partition by grp order by iv desc, feature) end as in_group_rank from report),
hard as (select *, concat_ws(';', case when n_unique <= 1 then 'constant' end, case when missing_rate > case when "window" in ('7d', '30d') then 0.6 else 0.55 end then 'high_missing' end, case when iv < 0.12 then 'low_iv' end) as hard_reason, psi >= 0.25 as psi_over_cutoff from ranked),
probed as (select *, 1 - missing_rate as coverage, family || case when window_rank <= 2 then '~s' else '~l' end as cluster, (rank() over (order by gain) + (count(*) over (partition by gain) - 1) / 2.0) / count(*) over () as gain_rank_pct from hard),
scored as (select *, coalesce((iv - avg(iv) over ()) / nullif(stddev_pop(iv) over (), 0), 0) + coalesce((lift - avg(lift) over ()) / nullif(stddev_pop(lift) over (), 0), 0) + coalesce((gini - avg(gini) over ()) / nullif(stddev_pop(gini) over (), 0), 0)
  - 0.25 * coalesce((psi - avg(psi) over ()) / nullif(stddev_pop(psi) over (), 0), 0) - case when missing_rate > 0.5 then 0.5 else 0 end as rank_score from probed),
best as (select *, first_value(feature) over (partition by cluster order by rank_score desc, feature) as winner from scored),
kept as (select *, concat_ws(';', nullif(hard_reason, ''), case when in_family_rank > 2 then 'family_dropped_by_policy' end, case when in_group_rank > 12 then 'group_dropped_by_policy' end, case when winner <> feature then 'corr_dup_of:' || winner end) as reject_reason from best)"""
GROUPS = {"ones": {"prefixes": ["brand1"]}, "twos": {"prefixes": ["brand2"]}}


def report(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    window = F.element_at(F.array(*(F.lit(w) for w in W)), (F.col("p_partkey") % 5 + 1).cast("int"))
    name = F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit("_"), window)
    by = lambda m, d: F.avg(F.col("p_partkey") % m) / d
    r = p.groupBy(name.alias("feature")).agg((F.avg("p_size") / 200).alias("iv"), (1 + by(13, 10)).alias("lift"), by(7, 10).alias("gini"), by(11, 25).alias("psi"), by(3, 2).alias("missing_rate"), F.count_distinct(F.col("p_size") % 4).alias("n_unique"), F.avg(F.col("p_partkey") % 17).alias("gain"))
    return selection.parse_groups(selection.parse_families(r), GROUPS)


def kept(spark, sf_dir):
    r = selection.rank_group(selection.rank_family(report(spark, sf_dir)), 12)
    r = selection.rank_score(selection.hard_filters(r, missing_max=0.55, iv_min=0.12, short_max=0.6))
    # short and long windows of a family are clusters
    return selection.auto_keep(r.withColumn("cluster", F.concat("family", F.when(F.col("window_rank") <= 2, "~s").otherwise("~l"))))


@query(f'with {REPORT_SQL} select feature, family, "window", window_rank from report')
def parse_families(spark, sf_dir):
    return report(spark, sf_dir).select("feature", "family", "window", "window_rank")


@query(f'with {REPORT_SQL} select feature, grp as "group" from report')
def parse_semantic_groups(spark, sf_dir):
    return report(spark, sf_dir).select("feature", "group")


@query(f"with {REPORT_SQL} select feature, family_size, in_family_rank, in_family_rank <= 2 as family_kept from ranked")
def rank_family(spark, sf_dir):
    return selection.rank_family(report(spark, sf_dir)).select("feature", "family_size", "in_family_rank", "family_kept")


@query(f"with {REPORT_SQL} select feature, group_size, in_group_rank, in_group_rank <= 12 as group_kept from ranked")
def rank_group(spark, sf_dir):
    return selection.rank_group(report(spark, sf_dir), 12).select("feature", "group_size", "in_group_rank", "group_kept")


@query(f"with {REPORT_SQL} select feature, hard_reason, psi_over_cutoff from hard")
def hard_filters(spark, sf_dir):
    return selection.hard_filters(report(spark, sf_dir), missing_max=0.55, iv_min=0.12, short_max=0.6).select("feature", "hard_reason", "psi_over_cutoff")


@query(f"with {REPORT_SQL} select feature, round(rank_score, 6) as rank_score from scored")
def rank_score(spark, sf_dir):
    return selection.rank_score(report(spark, sf_dir)).select("feature", F.round("rank_score", 6).alias("rank_score"))


@query(f"with {REPORT_SQL} select feature, reject_reason, reject_reason = '' as auto_keep from kept")
def auto_keep(spark, sf_dir):
    return kept(spark, sf_dir).select("feature", "reject_reason", "auto_keep")


@query(f"""with {REPORT_SQL} select family, count(*) as members, string_agg("window", ',' order by window_rank) as windows, round(max(iv), 6) as iv_best, round(median(iv), 6) as iv_median, count(*) filter (where in_family_rank <= 2) as kept_count,
string_agg(feature, ',' order by feature) filter (where in_family_rank <= 2) as kept_features, round(arg_max(iv, window_rank) / arg_min(iv, window_rank), 6) as iv_long_over_short, round(max(psi), 6) as psi_max, round(max(iv) - arg_min(iv, window_rank), 6) as iv_best_over_short from ranked group by family having count(*) > 1""")
def families_summary(spark, sf_dir):
    s = selection.families_summary(selection.rank_family(report(spark, sf_dir)))
    return s.select("family", "members", "windows", F.round("iv_best", 6).alias("iv_best"), F.round("iv_median", 6).alias("iv_median"), "kept_count", "kept_features", *(F.round(c, 6).alias(c) for c in ("iv_long_over_short", "psi_max", "iv_best_over_short")))


@query(f"""with {REPORT_SQL}, names as (select unnest(['ones', 'twos', 'none']) as g) select g as "group", count(feature) as members, round(max(iv), 6) as iv_best, count(*) filter (where in_group_rank <= 12) as kept_count from names left join ranked on g = grp group by g""")
def groups_summary(spark, sf_dir):
    s = selection.groups_summary(selection.rank_group(report(spark, sf_dir), 12), ["ones", "twos", "none"])
    return s.withColumn("iv_best", F.round("iv_best", 6))


@query(f"with {REPORT_SQL} select row_number() over (order by rank_score desc, feature) as ordinal, feature from kept where reject_reason = '' order by ordinal limit 10")
def top_n_features(spark, sf_dir):
    return selection.top_features(kept(spark, sf_dir), 10)


@query(f"""with {REPORT_SQL} select coalesce(grp, '-') as "group", round(avg((reject_reason = '')::int), 6) as keep_rate, count(*) filter (where reject_reason like '%low_iv%') as low_iv, round(median(missing_rate), 6) as missing from kept group by 1""")
def report_rollups(spark, sf_dir):
    r = kept(spark, sf_dir).groupBy(F.coalesce("group", F.lit("-")).alias("group"))
    return r.agg(F.round(F.avg(F.col("auto_keep").cast("int")), 6).alias("keep_rate"), F.count_if(F.col("reject_reason").contains("low_iv")).alias("low_iv"), F.round(F.expr("percentile(missing_rate, 0.5)"), 6).alias("missing"))


@query(f"""with {REPORT_SQL}, reasons as (select unnest(string_split(reject_reason, ';')) as reason from kept where reject_reason <> '') select string_split(reason, ':')[1] as reason, count(*) as n from reasons group by 1""")
def reject_reason_counts(spark, sf_dir):
    return selection.reason_counts(kept(spark, sf_dir))


@query(f"""with {REPORT_SQL} select len(list_filter([0.1, 0.3, 0.5, 0.7, 0.9], lambda c: missing_rate > c)) as bucket, count(*) as n, round(median(iv), 6) as iv, round(median(lift), 6) as lift from kept group by 1""")
def missing_buckets(spark, sf_dir):
    out = selection.missing_buckets(kept(spark, sf_dir))
    return out.select("bucket", "n", F.round("iv", 6).alias("iv"), F.round("lift", 6).alias("lift"))


@query(f"""with {REPORT_SQL} select "window", count(*) as n, round(median(iv), 6) as iv, round(median(psi), 6) as psi, round(median(missing_rate), 6) as missing from kept group by 1""")
def window_medians(spark, sf_dir):
    out = selection.medians(kept(spark, sf_dir), "window", {"iv": "iv", "psi": "psi", "missing": "missing_rate"})
    return out.select("window", "n", *(F.round(c, 6).alias(c) for c in ("iv", "psi", "missing")))


@query(f"""with {REPORT_SQL}, sizes as (select count(*) as size from kept group by cluster) select size, count(*) as n from sizes group by size""")
def cluster_sizes(spark, sf_dir):
    return kept(spark, sf_dir).groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {REPORT_SQL}, pairs as (select string_agg("window", '+' order by window_rank) as windows from kept where in_family_rank <= 2 group by family) select windows, count(*) as n from pairs group by windows""")
def kept_window_pairs(spark, sf_dir):
    return selection.window_pairs(kept(spark, sf_dir))


@query(f"""with {REPORT_SQL}, edges as (select quantile_cont(coverage, [0.2, 0.4, 0.6, 0.8]) as e from probed), placed as (select *, len(list_filter(e, lambda x: x < coverage)) as bin from probed, edges),
pct as (select *, (rank() over (partition by bin order by gain_rank_pct) + (count(*) over (partition by bin, gain_rank_pct) - 1) / 2.0) / count(*) over (partition by bin) as g, (rank() over (order by iv) + (count(*) over (partition by iv) - 1) / 2.0) / count(*) over () as i from placed)
select feature, case when i > 0.7 and g > 0.7 then 'stable' when i > 0.7 then 'interp' when g > 0.7 then 'discover' else 'noise' end as quadrant from pct""")
def quadrants(spark, sf_dir):
    return selection.quadrants(selection.gain_ranks(report(spark, sf_dir)).withColumn("coverage", 1 - F.col("missing_rate"))).select("feature", "quadrant")


@query(f"""with {REPORT_SQL}, z as (select *, coalesce((gain_rank_pct - avg(gain_rank_pct) over ()) / nullif(stddev_pop(gain_rank_pct) over (), 0), 0) as zg, coalesce((psi - avg(psi) over ()) / nullif(stddev_pop(psi) over (), 0), 0) as zp from scored)
select feature, round(rank_score + 0.25 * zp + 0.25 * zg - 0.15 * case "window" when '90d' then 0.1 when '180d' then 0.2 when '360d' then 0.3 when 'all' then 0.4 else 0 end, 6) as rank_score from z""")
def rank_score_probed(spark, sf_dir):
    """With the gain ranks of a probing model and a penalty of long windows, without stability."""
    scored = selection.rank_score(selection.gain_ranks(report(spark, sf_dir)), psi_mode="off", gamma=0.15, probe_weight=0.25)
    return scored.select("feature", F.round("rank_score", 6).alias("rank_score"))


POLICY = {"prefer": "best_iv", "keep": 2}
OVERRIDES = {"ones": {"prefer": "shortest"}, "twos": {"keep": 1}}


@query(f"""with {REPORT_SQL}, anchored as (select *, case when count(distinct grp) over (partition by family) = 1 then max(grp) over (partition by family) end as anchor from report),
placed as (select *, row_number() over (partition by family order by case when anchor = 'ones' then window_rank end, iv desc, feature) as r from anchored)
select feature, r as in_family_rank, r <= case when anchor = 'twos' then 1 else 2 end as family_kept from placed""".replace("count(distinct grp) over (partition by family) = 1 then max(grp)", "min(grp) over (partition by family) = max(grp) over (partition by family) then max(grp)"))
def family_policies(spark, sf_dir):
    """Families ranked by the policy of the group that all their features are in."""
    return selection.rank_family_by_group(report(spark, sf_dir), POLICY, OVERRIDES).select("feature", "in_family_rank", "family_kept")


@query(f"""with {REPORT_SQL}, two as (select *, row_number() over (partition by family order by window_rank, iv desc, feature) as short_rank from ranked)
select family, string_agg(feature, ',' order by feature) filter (where in_family_rank <= 2) as by_iv, string_agg(feature, ',' order by feature) filter (where short_rank <= 2) as by_window from two group by family""")
def policy_flip_sim(spark, sf_dir):
    r = report(spark, sf_dir)
    a = selection.rank_family(r, "best_iv").where("family_kept").select("family", "feature")
    b = selection.rank_family(r, "shortest").where("family_kept").select("family", "feature")
    names = lambda d, n: d.groupBy("family").agg(F.array_join(F.array_sort(F.collect_list("feature")), ",").alias(n))
    return names(a, "by_iv").join(names(b, "by_window"), "family", "full")


Z = ", ".join(f"case when {f} <= 0 then null else {f} end as {f}" for f in LINE_FEATURES)


def _pairs_sql(threshold: float) -> str:
    pairs = [(a, b) for i, a in enumerate(LINE_FEATURES) for b in LINE_FEATURES[i + 1 :]]
    stats = ", ".join(f"avg({f}) as m{i}, stddev_pop({f}) as s{i}" for i, f in enumerate(LINE_FEATURES))
    at = {f: i for i, f in enumerate(LINE_FEATURES)}
    rows = " union all ".join(
        f"select '{a}' as f1, '{b}' as f2, coalesce(sum(({a} - m{at[a]}) * ({b} - m{at[b]})) / nullif(count(*) filter (where {a} is not null and {b} is not null) * max(s{at[a]} * s{at[b]}), 0), 0) as r, count(*) filter (where {a} is not null and {b} is not null) as n_pairs, count(*) as n from w, st" for a, b in pairs
    )
    return f"w as (select {Z} from lineitem), st as (select {stats} from w), e as ({rows}), edges as (select f1, f2, round(r, 6) as r, n_pairs, n_pairs / n < 0.1 as low_overlap from e where abs(r) >= {threshold})"


def _wide(spark, sf_dir):
    from liftwork.functions.cleaning import clean

    t = lines(spark, sf_dir)
    kinds = dict(t.dtypes)
    return t.select(*(clean(f, kinds[f], RULES).alias(f) for f in LINE_FEATURES))


@query(f"with {_pairs_sql(0.0)} select * from edges")
def corr_edges(spark, sf_dir):
    return correlation.edges(_wide(spark, sf_dir), LINE_FEATURES, 0.0).withColumn("r", F.round("r", 6))


TIER = {"l_quantity": ("size", "a"), "l_extendedprice": ("size", "b"), "l_discount": ("rate", "c"), "l_tax": ("tax", "c")}


def _tiered(spark, sf_dir):
    families = spark.createDataFrame([(k, v[0]) for k, v in TIER.items()], "feature string, family string")
    groups = spark.createDataFrame([(k, v[1]) for k, v in TIER.items()], "feature string, group string")
    return correlation.tiered(correlation.edges(_wide(spark, sf_dir), LINE_FEATURES, 0.0), families, groups, 0.002, 0.0001, 0.99)


@query(f"with {_pairs_sql(0.0)} select * from edges where abs(r) >= case when f1 = 'l_quantity' and f2 = 'l_extendedprice' then 0.002 when f1 = 'l_discount' and f2 = 'l_tax' then 0.0001 else 0.99 end")
def corr_tiered(spark, sf_dir):
    return _tiered(spark, sf_dir).withColumn("r", F.round("r", 6))


@query(f"""with recursive {_pairs_sql(0.0)}, t as (select * from edges where abs(r) >= case when f1 = 'l_quantity' and f2 = 'l_extendedprice' then 0.002 when f1 = 'l_discount' and f2 = 'l_tax' then 0.0001 else 0.99 end),
places as (select unnest({LINE_FEATURES}) as feature, unnest(range(0, {len(LINE_FEATURES)})) as place), sym as (select f1, f2 from t where not low_overlap union all select f2, f1 from t where not low_overlap),
reach as (select feature as a, feature as b from places union select r.a, e.f2 from reach r join sym e on r.b = e.f1)
select a as feature, (dense_rank() over (order by min(place)) - 1)::int as cluster from reach join places on b = feature group by a""")
def corr_clusters(spark, sf_dir):
    return correlation.clusters(spark, LINE_FEATURES, _tiered(spark, sf_dir))
