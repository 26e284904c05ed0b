"""Queries of naming rules, group rules, family audits and entity tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwork.operators import entities, selection, signals
from liftwork.operators.histogram import histogram
from liftwork.sources.products import LINE_FEATURES, LINE_SQL, line_values, lines, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Features whose names tell their windows in many ways, with a value and a gain of each.
_SUFFIXES = ("_30d", "_d90", "_last180days", "_近360天", "_3mon", "_2y", "", "_14", "_last5years", "_all")
NAMED_SQL = f"""named as (select lower(replace(p_brand, '#', '')) || case p_partkey % {len(_SUFFIXES)} {" ".join(f"when {k} then '{s}'" for k, s in enumerate(_SUFFIXES))} end as feature,
  avg(p_size) / 200 as iv, sum(p_retailprice) as gain, min(p_partkey) as position from part group by 1)"""
_RULES = ("suffix_day", "prefix_d", "english_last_days", "chinese_jin_days", "suffix_mon_to_days", "suffix_year_to_days", "english_last_years")
FAMILY_SQL = f"""{NAMED_SQL}, tried as (select *, regexp_extract(feature, '^(.+?)_(7d|30d|90d|180d|360d|all|life|hist)$', ['base', 'w']) as a, regexp_extract(feature, '^(.+?)_d(7|30|90|180|360)$', ['base', 'w']) as b,
  regexp_extract(feature, '^(.+?)_last(\\d+)days$', ['base', 'w']) as c, regexp_extract(feature, '^(.+?)_近(\\d+)天$', ['base', 'w']) as d, regexp_extract(feature, '^(.+?)_(\\d+)mon$', ['base', 'w']) as e,
  regexp_extract(feature, '^(.+?)_(\\d+)y$', ['base', 'w']) as f, regexp_extract(feature, '^(.+?)_last(\\d+)years$', ['base', 'w']) as g from named),
parsed as (select *, case when a.w <> '' then a.base when b.w <> '' then b.base when c.w <> '' then c.base when d.w <> '' then d.base when e.w <> '' then e.base when f.w <> '' then f.base when g.w <> '' then g.base else feature end as family,
  case when a.w <> '' then a.w when b.w <> '' then b.w || 'd' when c.w <> '' then c.w || 'd' when d.w <> '' then d.w || 'd' when e.w <> '' then case e.w when '1' then '30d' when '3' then '90d' when '6' then '180d' when '12' then '360d' when '24' then '720d' else e.w end
    when f.w <> '' then case f.w when '1' then '360d' when '2' then '720d' when '3' then '1080d' when '5' then '1800d' when '10' then '3600d' else f.w end when g.w <> '' then g.w || 'y' end as "window",
  case when a.w <> '' then 'suffix_day' when b.w <> '' then 'prefix_d' when c.w <> '' then 'english_last_days' when d.w <> '' then 'chinese_jin_days' when e.w <> '' then 'suffix_mon_to_days' when f.w <> '' then 'suffix_year_to_days' when g.w <> '' then 'english_last_years' end as rule from tried),
families as (select feature, iv, gain, position, family, "window", rule, case when "window" is not null then coalesce(list_position(['7d', '30d', '90d', '180d', '360d', 'all', 'life', 'hist'], "window") - 1, 8) end as window_rank from parsed)"""


def named_features(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    suffix = F.get(F.array(*(F.lit(s) for s in _SUFFIXES)), (F.col("p_partkey") % len(_SUFFIXES)).cast("int"))
    name = F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), suffix)
    return p.groupBy(name.alias("feature")).agg((F.avg("p_size") / 200).alias("iv"), F.sum("p_retailprice").alias("gain"), F.min("p_partkey").alias("position"))


def _families(spark, sf_dir, enabled=True):
    return selection.families_by_rules(named_features(spark, sf_dir), list(_RULES), enabled=enabled)


@query(f'with {FAMILY_SQL} select feature, family, "window", window_rank, rule from families')
def families_by_rules(spark, sf_dir):
    """Families by an ordered list of naming rules, windows under their common names."""
    return _families(spark, sf_dir).select("feature", "family", "window", "window_rank", "rule")


@query(f'with {NAMED_SQL} select feature, feature as family, null::varchar as "window", null::int as window_rank, null::varchar as rule from named')
def families_switched_off(spark, sf_dir):
    """No families: every feature stands alone."""
    return _families(spark, sf_dir, enabled=False).select("feature", "family", "window", F.col("window_rank").cast("int").alias("window_rank"), "rule")


@query(f"""with {FAMILY_SQL}, audit as (select family, sum(gain) as g, count(*) as n from families group by family)
select family, round(g, 2) as total_gain, n as kept_count, round(g / sum(g) over (), 6) as gain_share from audit""")
def family_gain_join(spark, sf_dir):
    """Gains joined with the families of their features: each family's share of all gain."""
    found = selection.family_gain_audit(named_features(spark, sf_dir).select("feature", "gain"), _families(spark, sf_dir))
    return found.select("family", F.round("total_gain", 2).alias("total_gain"), "kept_count", F.round("gain_share", 6).alias("gain_share"))


GROUPS = {
    "picked": {"features": ["brand11", "brand22_30d", "not_there", "brand33_2y"], "prefer": "first", "keep": 1},
    "ones": {"prefixes": ["brand1"], "keep": 3, "corr_cutoff": 0.7},
    "twos": {"prefixes": ["brand2"], "prefer": "first"},
}
_MEMBERS = f"""{NAMED_SQL}, grouped as (select *, case when feature in ('brand11', 'brand22_30d', 'not_there', 'brand33_2y') then 'picked' when starts_with(feature, 'brand1') then 'ones' when starts_with(feature, 'brand2') then 'twos' end as grp from named),
members as (select *, case grp when 'picked' then 'first' when 'ones' then 'best_iv' when 'twos' then 'first' end as prefer, case grp when 'picked' then 1 when 'ones' then 3 when 'twos' then 2 end as keep, case grp when 'ones' then 0.7 when 'picked' then 0.85 when 'twos' then 0.85 end as cutoff from grouped)"""


@query(f"""with {_MEMBERS} select feature, grp as "group", prefer as group_prefer, keep as group_max_keep, cutoff::double as group_corr_cutoff, case when grp is null then 0 else count(*) over (partition by grp) end as group_size,
  case when grp is null then 0 else row_number() over (partition by grp order by case when prefer = 'first' then position end, case when prefer <> 'first' then -iv end, feature) end as in_group_rank,
  grp is null or row_number() over (partition by grp order by case when prefer = 'first' then position end, case when prefer <> 'first' then -iv end, feature) <= keep as group_kept from members""")
def group_rules(spark, sf_dir):
    """Semantic groups with rules of their own, defaults where a rule says nothing, ranked by value or by position."""
    found = selection.rank_by_group_rules(selection.group_members(named_features(spark, sf_dir), GROUPS))
    return found.select("feature", "group", "group_prefer", "group_max_keep", "group_corr_cutoff", "group_size", "in_group_rank", "group_kept")


@query(f"with {NAMED_SQL} select 'picked' as \"group\", f as feature from (select unnest(['brand11', 'brand22_30d', 'not_there', 'brand33_2y']) as f) where f not in (select feature from named)")
def missing_members(spark, sf_dir):
    """Features that a group lists and the table lacks."""
    return selection.missing_members(named_features(spark, sf_dir), GROUPS)


@query(f"with {LINE_SQL}, types as (select any_value(typeof(l_quantity)) as t from line) select feature, round(count(*) filter (where value is null) / count(*), 6) as missing_rate, count(distinct value) as n_unique, lower(any_value(t)) as dtype, count(*) as n_total from values_, types group by feature")
def missing_report(spark, sf_dir):
    """Missing rates with the type of each column as it came."""
    types = {c: t for c, t in lines(spark, sf_dir).dtypes if c in LINE_FEATURES}
    found = signals.missing_report(histogram(line_values(spark, sf_dir, ("y",))), types)
    return found.withColumn("missing_rate", F.round("missing_rate", 6))


# -- entity tables: (prefix, entity column, date column, day counted back from, values, codes, none)
_WINDOWS = {"90d": 90, "360d": 360, "all": None}
_RELATED = (
    ("ord", "o_custkey", "o_orderdate", "1998-01-01", {"price": "o_totalprice", "seventh": "o_totalprice / 7"}, (), {}),
    ("line", "o_custkey", "l_shipdate", "1998-01-01", {"qty": "l_quantity", "net": "(l_extendedprice - l_extendedprice * l_discount) / 7"}, (), {}),
    ("ev", "user_id", "ts", "2024-01-31", {"value": "value"}, (), {}),
    ("prio", "o_custkey", "o_orderdate", "1998-01-01", {"code": "o_orderpriority__code"}, ("o_orderpriority",), {}),
    ("tax", "o_custkey", "l_shipdate", "1998-01-01", {"tax": "l_tax"}, (), {"tax": 0.05}),
)
_FROM = {"ord": "orders", "line": "orders join lineitem on o_orderkey = l_orderkey", "ev": "events", "prio": "(select *, dense_rank() over (order by o_orderpriority) - 1 as o_orderpriority__code from orders)", "tax": "orders join lineitem on o_orderkey = l_orderkey"}


def _part_sql(prefix: str, entity: str, date: str, day: str, values: dict, none: dict) -> str:
    cells = []
    for w, cap in _WINDOWS.items():
        inside = "true" if cap is None else f"abs(days) <= {cap}"
        for v in values:
            cells += [f"round(avg({v}) filter (where {inside}), 8) as {prefix}_{v}_mean_{w}", f"round(max({v}) filter (where {inside}), 8) as {prefix}_{v}_max_{w}",
                      f"case when count(*) filter (where {inside}) > 0 then round(coalesce(sum({v}) filter (where {inside}), 0), 6) end as {prefix}_{v}_sum_{w}"]
        cells.append(f"nullif(count(*) filter (where {inside}), 0) as {prefix}_cnt_{w}")
    columns = ", ".join(f"nullif(({e})::double, {none[v]}) as {v}" if v in none else f"({e})::double as {v}" for v, e in values.items())
    return f"{prefix} as (select k, {', '.join(cells)} from (select {entity} as k, date_diff('day', {date}::date, date '{day}') as days, {columns} from {_FROM[prefix]}) where k is not null group by k)"


@query(
    "with " + ", ".join(_part_sql(p, e, d, day, v, n) for p, e, d, day, v, _, n in _RELATED)
    + " select c_custkey as k, " + ", ".join(f"{p}.* exclude (k)" for p, *_ in _RELATED) + " from customer " + " ".join(f"left join {p} on {p}.k = c_custkey" for p, *_ in _RELATED)
)
def entity_builders(spark, sf_dir):
    """A wide row a customer from five related tables, by one configuration of windowed aggregates."""
    o = table(spark, sf_dir, "orders")
    bought = o.join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    tables = {"ord": o, "line": bought, "ev": table(spark, sf_dir, "events"), "prio": o, "tax": bought}
    specs = [entities.Related(p, e, f"datediff(date'{day}', cast({d} as date))", v, c, n) for p, e, d, day, v, c, n in _RELATED]
    out = entities.entity_table(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k", tables, specs, _WINDOWS)
    places = lambda c: 8 if "_mean_" in c or "_max_" in c else 6 if "_sum_" in c else None
    return out.select(*(F.round(c, places(c)).alias(c) if places(c) is not None else c for c in out.columns))
