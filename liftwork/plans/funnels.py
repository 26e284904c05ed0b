"""Queries of fusion, calibration and funnel evaluation, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwork.operators import fusion
from liftwork.sources.products import ORDER_SQL, orders, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Users with the stages they reached; two scores that follow the key.
USER_SQL = """users as (select user_id, max((event_type = 'view')::int) as viewed, max((event_type = 'click')::int) as clicked, max((event_type = 'signup')::int) as signed, max((event_type = 'purchase')::int and value > 50)::int as bought,
  sum(value) as worth, ((user_id * 37) % 101 + 1) / 102.0 as r, ((user_id * 53) % 97 + 1) / 98.0 as q from events group by user_id)""".replace("max((event_type = 'purchase')::int and value > 50)::int", "max((event_type = 'purchase' and value > 50)::int)")
STAGES = ["viewed", "clicked", "signed", "bought"]


def users(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    has = lambda c: F.max(c.cast("int"))
    kind = lambda k: F.col("event_type") == k
    u = e.groupBy("user_id").agg(has(kind("view")).alias("viewed"), has(kind("click")).alias("clicked"), has(kind("signup")).alias("signed"), has(kind("purchase") & (F.col("value") > 50)).alias("bought"), F.sum("value").alias("worth"))
    return u.withColumns({"r": (F.col("user_id") * 37 % 101 + 1) / 102.0, "q": (F.col("user_id") * 53 % 97 + 1) / 98.0})


def fused_users(spark, sf_dir, alpha=0.35):
    return users(spark, sf_dir).withColumn("score", F.round(fusion.fuse(F.col("r"), F.col("q"), alpha), 12))


@query(f"with {USER_SQL} select user_id, round(pow(r, 0.35) * pow(q, 0.65), 8) as score from users")
def fuse(spark, sf_dir):
    return fused_users(spark, sf_dir).select("user_id", F.round("score", 8).alias("score"))


ALPHA_SQL = f"""with {USER_SQL}, grid as (select round(i * 0.05, 2)::double as alpha from range(21) t(i)),
f as (select alpha, user_id, bought, row_number() over (partition by alpha order by round(pow(r, alpha) * pow(q, 1 - alpha), 12) desc, user_id) as rank, count(*) over (partition by alpha) as n, avg(bought) over (partition by alpha) as base from users, grid),
lifts as (select alpha, avg(bought) / max(base) as lift from f where rank <= greatest(1, ceil(n * 0.1)) group by alpha)"""


@query(f"""{ALPHA_SQL}, best as (select alpha, round(lift, 6) as lift, 'grid' as origin from lifts order by round(lift, 12) desc, abs(alpha - 0.5), alpha limit 1),
size as (select count(*) >= 2000 and sum(bought) >= 20 as enough from users)
select case when enough then alpha else 0.5 end::double as alpha, case when enough then lift end as lift, case when enough then origin else 'default_fallback' end as origin from best, size""")
def fit_alpha(spark, sf_dir):
    return fusion.fit_alpha(users(spark, sf_dir), "r", "q", "bought", "user_id").withColumn("lift", F.round("lift", 6))


# A rare stage over a table of more than 2000 rows: open orders over 250000 that came in on the first days of a month.
RARE_SQL = """rare as (select o_orderkey, (o_totalprice > 250000 and o_orderstatus = 'O' and extract(day from o_orderdate) <= 9)::int as hit, (o_totalprice % 1000 + 1) / 1001.0 as r, ((o_orderkey * 53) % 97 + 1 + 40 * (o_totalprice > 200000)::int) / 138.0 as q from orders),
grid as (select round(i * 0.05, 2)::double as alpha from range(21) t(i)),
f as (select alpha, o_orderkey, hit, row_number() over (partition by alpha order by round(pow(r, alpha) * pow(q, 1 - alpha), 12) desc, o_orderkey) as rank, count(*) over (partition by alpha) as n, avg(hit) over (partition by alpha) as base from rare, grid),
lifts as (select alpha, coalesce(avg(hit) / nullif(max(base), 0), 0) as lift from f where rank <= greatest(1, ceil(n * 0.1)) group by alpha)"""


def rare(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("double")
    hit = ((price > 250000) & (F.col("o_orderstatus") == "O") & (F.dayofmonth("o_orderdate") <= 9)).cast("int")
    return o.select("o_orderkey", hit.alias("hit"), ((price % 1000 + 1) / 1001.0).alias("r"), ((F.col("o_orderkey") * 53 % 97 + 1 + 40 * (price > 200000).cast("int")) / 138.0).alias("q"))


@query(f"with {RARE_SQL} select alpha, round(lift, 6) as lift from lifts")
def alpha_grid(spark, sf_dir):
    """The lift of every alpha for a rare stage."""
    return fusion.alpha_lifts(rare(spark, sf_dir), "r", "q", "hit", "o_orderkey").withColumn("lift", F.round("lift", 6))


@query(f"""with {RARE_SQL}, best as (select alpha, round(lift, 6) as lift from lifts order by round(lift, 12) desc, abs(alpha - 0.5), alpha limit 1), size as (select count(*) >= 2000 and sum(hit) >= 20 as enough from rare)
select case when enough then alpha else 0.5 end::double as alpha, case when enough then lift end as lift, case when enough then 'grid' else 'default_fallback' end as origin from best, size""")
def fit_alpha_rare(spark, sf_dir):
    return fusion.fit_alpha(rare(spark, sf_dir), "r", "q", "hit", "o_orderkey").withColumn("lift", F.round("lift", 6))


@query(f"""with {USER_SQL}, c as (select count(*) as s0, count(*) filter (where viewed > 0) as s1, count(*) filter (where viewed > 0 and clicked > 0) as s2, count(*) filter (where viewed > 0 and clicked > 0 and signed > 0) as s3, count(*) filter (where viewed > 0 and clicked > 0 and signed > 0 and bought > 0) as s4 from users)
select 'all' as stage, 0 as ordinal, s0 as n, 1.0::double as step_cvr, 1.0::double as cum_cvr from c union all select 'viewed', 1, s1, round(s1 / s0, 6), round(s1 / s0, 6) from c union all select 'clicked', 2, s2, round(s2 / s1, 6), round(s2 / s0, 6) from c
union all select 'signed', 3, s3, round(s3 / s2, 6), round(s3 / s0, 6) from c union all select 'bought', 4, s4, round(s4 / s3, 6), round(s4 / s0, 6) from c""")
def funnel_conversion(spark, sf_dir):
    return fusion.funnel(users(spark, sf_dir), STAGES).withColumns({c: F.round(c, 6) for c in ("step_cvr", "cum_cvr")})


PLACED = f"with {USER_SQL}, scored as (select *, round(pow(r, 0.35) * pow(q, 0.65), 12) as score from users), placed as (select *, row_number() over (order by score desc, user_id) as rank, count(*) over () as n from scored)"


def _funnel_sql(k: str = "0.1", value: str | None = None) -> str:
    parts, before = [], "true"
    top = f"rank <= ceil(n * {k})"
    row = lambda stage, view, x, given: (
        f"select '{stage}' as stage, '{view}' as view, count(*) filter (where {top} and {given}) as n_top, count(*) filter (where {top} and {given} and {x} > 0) as pos_top, round(avg({x}) filter (where {top} and {given}), 6) as top, "
        f"round(avg({x}) filter (where {given}), 6) as population, round(avg({x}) filter (where {top} and {given}) / nullif(avg({x}) filter (where {given}), 0), 6) as lift from placed"
    )
    for s in STAGES:
        parts += [row(s, "absolute", s, "true"), row(s, "conditional", s, before)]
        before += f" and {s} > 0"
    if value:
        parts.append(row("value_capture", "absolute", f"coalesce({value}, 0)", "true"))
    return f"{PLACED} {' union all '.join(parts)}"


@query(_funnel_sql(value="worth"))
def funnel_lift(spark, sf_dir):
    return fusion.funnel_lift(fused_users(spark, sf_dir), STAGES, ["user_id"], value="worth").withColumns({c: F.round(c, 6) for c in ("top", "population", "lift")})


SHARES = [0.01, 0.05, 0.1, 0.2, 0.3, 0.5]


def _curve_sql(value: str) -> str:
    return f"""{PLACED}, ks as (select unnest([0.01, 0.05, 0.1, 0.2, 0.3, 0.5])::double as k)
select k, round(avg({value}) filter (where rank <= greatest(1, ceil(n * k))), 6) as top, round(avg({value}), 6) as population, round(avg({value}) filter (where rank <= greatest(1, ceil(n * k))) / avg({value}), 6) as lift from placed, ks group by k"""


@query(_curve_sql("bought"))
def topk_curve(spark, sf_dir):
    return fusion.share_curve(fused_users(spark, sf_dir), "bought", ["user_id"], SHARES).withColumns({c: F.round(c, 6) for c in ("top", "population", "lift")})


@query(_curve_sql("worth"))
def value_capture_curve(spark, sf_dir):
    return fusion.share_curve(fused_users(spark, sf_dir), "worth", ["user_id"], SHARES).withColumns({c: F.round(c, 6) for c in ("top", "population", "lift")})


@query(_funnel_sql("0.2"))
def launch_review(spark, sf_dir):
    """Stage lifts of a launched ranking, its mixture frozen."""
    return fusion.funnel_lift(fused_users(spark, sf_dir, 0.35), STAGES, ["user_id"], 0.2).withColumns({c: F.round(c, 6) for c in ("top", "population", "lift")})


@query()
def isotonic_fit(spark, sf_dir):
    return fusion.isotonic_table(orders(spark, sf_dir))


TABLE = [(0.1, 0.02), (0.4, 0.3), (0.8, 0.9)]


@query(f"with {ORDER_SQL} select o_orderkey, round((case when score < 0.1 then 0.02 when score >= 0.8 then 0.9 when score < 0.4 then 0.02 + (score - 0.1) * 0.28 / 0.3 else 0.3 + (score - 0.4) * 0.6 / 0.4 end)::double, 5) as calibrated from ord")
def isotonic_apply(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", F.round(fusion.interpolated(F.col("score"), TABLE), 5).alias("calibrated"))


@query(f"with g as (select p_brand as family, p_size as f, round(sum(p_retailprice), 2) as gain from part group by all) select family, round(sum(gain), 2) as gain, count(*) as n, round(sum(gain) / sum(sum(gain)) over (), 6) as share from g group by family")
def family_gain_audit(spark, sf_dir):
    from pyspark.sql import Window

    g = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("family"), "p_size").agg(F.round(F.sum("p_retailprice"), 2).alias("gain"))
    sums = g.groupBy("family").agg(F.sum("gain").alias("g"), F.count(F.lit(1)).alias("n"))  # a row a family
    return sums.select("family", F.round("g", 2).alias("gain"), "n", F.round(F.col("g") / F.sum("g").over(Window.partitionBy()), 6).alias("share"))


@query("with g as (select p_brand as feature, sum(p_retailprice) as gain from part group by 1) select feature, round(gain / sum(gain) over (), 6) as share, round(sum(gain) over (order by gain desc, feature) / sum(gain) over (), 6) as cumulative from g")
def importance_cumshare(spark, sf_dir):
    from pyspark.sql import Window

    g = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_retailprice").alias("gain"))
    whole = F.sum("gain").over(Window.partitionBy())
    upto = F.sum("gain").over(Window.orderBy(F.desc("gain"), "feature"))
    return g.select("feature", F.round(F.col("gain") / whole, 6).alias("share"), F.round(upto / whole, 6).alias("cumulative"))  # a row a feature
