"""Queries of table building and preparation, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwork.functions import cleaning
from liftwork.operators import assembly, preparation
from liftwork.plans.splits import CUTS_SQL
from liftwork.sources.products import LINE_SQL, ORDER_SQL, orders, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Customers: a negative balance counts as missing; the even keys are train.
CUST_SQL = "cust as (select c_custkey, case when c_acctbal < 0 then null else c_acctbal end as bal, case when c_nationkey = 0 then null else c_nationkey::double end as nation, c_mktsegment, case when c_custkey % 2 = 0 then 'train' else 'oot' end as split from customer)"
FILLS = {"bal": "median", "nation": "mean"}


def customers(spark, sf_dir):
    rules = cleaning.MissingRules()
    c = table(spark, sf_dir, "customer")
    kinds = dict(c.dtypes)
    only_negative = cleaning.MissingRules(sentinels=())
    return c.select("c_custkey", cleaning.clean("c_acctbal", kinds["c_acctbal"], only_negative).alias("bal"), cleaning.clean("c_nationkey", kinds["c_nationkey"], rules).alias("nation"), "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "train").otherwise("oot").alias("split"))


@query(f"with {CUST_SQL} select 'bal' as feature, round(median(bal), 4) as fill from cust where split = 'train' union all select 'nation', round(avg(nation), 4) from cust where split = 'train'")
def fit_fill(spark, sf_dir):
    fills = preparation.fit_fill(customers(spark, sf_dir).where("split = 'train'"), FILLS)
    return spark.createDataFrame([(k, round(v, 4)) for k, v in fills.items()], "feature string, fill double")


@query(f"with {CUST_SQL}, f as (select median(bal) as b, avg(nation) as n from cust where split = 'train') select c_custkey, round(coalesce(bal, b), 4) as bal, round(coalesce(nation, n), 4) as nation from cust, f")
def apply_fill(spark, sf_dir):
    c = customers(spark, sf_dir)
    out = preparation.apply_fill(c, preparation.fit_fill(c.where("split = 'train'"), FILLS))
    return out.select("c_custkey", F.round("bal", 4).alias("bal"), F.round("nation", 4).alias("nation"))


@query(f"with {CUST_SQL} select c_custkey, (bal is null)::int as bal__isnan from cust")
def missing_indicators(spark, sf_dir):
    c = customers(spark, sf_dir)
    wanted = preparation.indicator_columns(c.where("split = 'train'"), ["bal", "nation"], 0.05)
    return preparation.with_indicators(c, wanted).select("c_custkey", F.col("bal__isnan").cast("int").alias("bal__isnan"))


@query("select c_custkey from customer where not (c_nationkey in (1, 2, 3)) or c_nationkey is null")
def exclude_rows(spark, sf_dir):
    return preparation.without_values(table(spark, sf_dir, "customer"), {"c_nationkey": [1, 2, 3]}).select("c_custkey")


@query(f"with {CUST_SQL} select c_custkey, split from cust where not (bal is null and nation is null and split = 'train')")
def all_na_rows(spark, sf_dir):
    return preparation.drop_empty_rows(customers(spark, sf_dir), ["bal", "nation"]).select("c_custkey", "split")


@query("select c_custkey, case c_nationkey when 1 then 2.0 when 2 then 0.5 else 1.0 end::double as w from customer")
def sample_weight(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", cleaning.weight(F.col("c_nationkey"), {1: 2.0, 2: 0.5}).alias("w"))


@query("select c_custkey, coalesce(dense_rank() over (order by c_mktsegment) - 1, -1) as code from customer")
def label_encode(spark, sf_dir):
    return preparation.label_codes(table(spark, sf_dir, "customer"), "c_mktsegment", "code").select("c_custkey", "code")


@query("select c_custkey, coalesce((c_acctbal > 0)::int, 0) as flag from customer")
def binarize_flags(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", cleaning.binarize(F.col("c_acctbal").cast("string")).alias("flag"))


@query("select o_orderkey, strftime(o_orderdate, '%Y%m%d')::int as day from orders")
def to_yyyymmdd(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaning.lenient_yyyymmdd(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))


@query("select is_f, label, count(*) as n from (select o_orderstatus = 'F' as is_f, o_custkey % 4 as label from orders) where label not in (0, 1) group by all")
def validate_label(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    marked = o.select((F.col("o_orderstatus") == "F").alias("is_f"), (F.col("o_custkey") % 4).alias("y"))
    parts = [preparation.bad_labels(marked.where(F.col("is_f") == v)).select(F.lit(v).alias("is_f"), "label", "n") for v in (True, False)]
    return assembly.union_files(parts)


@query(f"with {ORDER_SQL} select o_orderkey, day from ord where day between 19960101 and 19961231")
def time_window_filter(spark, sf_dir):
    return orders(spark, sf_dir).where(F.col("day").between(19960101, 19961231)).select("o_orderkey", "day")


@query("select o_orderkey, c_mktsegment, o_totalprice from orders join customer on o_custkey = c_custkey")
def join_inner_keys(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment", "o_totalprice")


@query("select d.doc_id, coalesce(quality, 0) as quality, quality is not null as labelled from documents d left join labels l using (doc_id)")
def join_left_labels(spark, sf_dir):
    d, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id").join(marks, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(0)).alias("quality"), F.col("quality").isNotNull().alias("labelled"))


CHAIN = "a as (select o_custkey as k, count(*) as n_orders from orders where o_totalprice > 300000 group by 1), b as (select c_custkey as k, c_acctbal as bal from customer where c_acctbal > 5000), c as (select user_id as k, count(*) as n_events from events group by 1)"


@query(f"with {CHAIN} select coalesce(a.k, b.k, c.k) as k, n_orders, bal, n_events from a full join b on a.k = b.k full join c on coalesce(a.k, b.k) = c.k")
def join_outer_chain(spark, sf_dir):
    a = table(spark, sf_dir, "orders").where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    c = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))
    return assembly.joined_chain([a, b, c], ["k"])


@query("select c_custkey, n, round(total, 2) as total from customer left join (select o_custkey, count(*) as n, sum(o_totalprice) as total from orders group by 1) on o_custkey = c_custkey")
def join_index_align(spark, sf_dir):
    sums = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(sums, "c_custkey", "left").withColumn("total", F.round("total", 2))


@query("select 'orders' as source, round(avg((c_custkey in (select o_custkey from orders))::int), 6) as rate from customer union all select 'events', round(avg((c_custkey in (select user_id from events))::int), 6) from customer")
def join_hit_rate(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    sources = {"orders": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "events": table(spark, sf_dir, "events").select(F.col("user_id").alias("k"))}
    return assembly.hit_rate(base, sources, ["k"]).withColumn("rate", F.round("rate", 6))


@query("""with a as (select distinct p_brand as name from part where p_size > 45), b as (select distinct p_brand as name from part where p_retailprice > 1990)
select coalesce(a.name, b.name) as name, case when a.name is null then 'right' when b.name is null then 'left' else 'both' end as side from a full join b on a.name = b.name""")
def feature_set_diff(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "name")
    return assembly.set_comparison(p.where("p_size > 45"), p.where("p_retailprice > 1990"), "name")


@query("select l_orderkey, l_linenumber, l_shipdate from lineitem where l_returnflag = 'R' union all select l_orderkey, l_linenumber, l_shipdate from lineitem where l_returnflag = 'A'")
def union_files(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    return assembly.union_files([t.where(F.col("l_returnflag") == f).select("l_linenumber", "l_orderkey", "l_shipdate") for f in ("R", "A")])


@query("select l_orderkey, l_linenumber, l_returnflag, min(l_shipdate) as l_shipdate from lineitem group by 1, 2, 3")
def dedup_ignore_time(spark, sf_dir):
    return assembly.dedup_ignoring(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"), "l_shipdate")


@query("select distinct l_orderkey, l_linenumber from lineitem")
def dedup_full_row(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@query("select count(*) - count(distinct (l_orderkey, l_linenumber)) as repeated from lineitem")
def duplicate_key_count(spark, sf_dir):
    return assembly.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select event_id, user_id from events where event_type = 'purchase'")
def conditional_population(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id")


CAPS = {"90d": 90, "360d": 360, "all": None}
SNAPSHOT = "1997-01-01"


@query(f"with d as (select o_custkey, o_totalprice as price, date_diff('day', o_orderdate::date, date '{SNAPSHOT}') as days from orders where o_orderdate < date '{SNAPSHOT}') select o_custkey, " + ", ".join(
    f"round(avg(price) filter (where {c}), 8) as o_price_mean_{w}, max(price) filter (where {c}) as o_price_max_{w}, round(sum(price) filter (where {c}), 2) as o_price_sum_{w}, nullif(count(*) filter (where {c}), 0) as o_cnt_{w}"
    for w, c in (("90d", "abs(days) <= 90"), ("360d", "abs(days) <= 360"), ("all", "true"))) + " from d group by o_custkey")
def windowed_wide_agg(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(SNAPSHOT).cast("timestamp"))
    d = o.select("o_custkey", F.col("o_totalprice").alias("price"), F.datediff(F.lit(SNAPSHOT).cast("date"), F.col("o_orderdate").cast("date")).alias("days"))
    out = assembly.windowed(d, "o_custkey", "days", ["price"], CAPS, "o")
    return out.select(*(F.round(c, 8 if "_mean_" in c else 2).alias(c) if "_mean_" in c or "_sum_" in c else F.col(c) for c in out.columns))


REPORT_SQL = f"""with {LINE_SQL}, iv as (select feature, avg(value) as mean from values_ where flag = 'R' group by 1), m as (select feature, max(value) as most from values_ where feature <> 'l_tax' group by 1)
select coalesce(iv.feature, m.feature) as feature, round(coalesce(mean, 0), 4) as mean, coalesce(most, 0) as most from iv full join m on iv.feature = m.feature"""


@query(REPORT_SQL)
def join_report_outer(spark, sf_dir):
    """Feature tables joined in full, with defaults for what a feature lacks."""
    from liftwork.sources.products import line_values

    v = line_values(spark, sf_dir)
    mean, most = v.where("y = 1").groupBy("feature").agg(F.avg("value").alias("mean")), v.where("feature <> 'l_tax'").groupBy("feature").agg(F.max("value").alias("most"))
    return assembly.joined_chain([mean, most], ["feature"], "full").fillna({"mean": 0.0, "most": 0.0}).withColumn("mean", F.round("mean", 4))


@query("select o_orderkey, coalesce((o_custkey % 6 - 1 in (1, 2, 3))::int, 0) as y from orders")
def binary_outcome(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaning.binary_outcome((F.col("o_custkey") % 6 - 1).cast("string")).alias("y"))


@query("""select o_custkey, count(*) as n, round(avg(case when o_orderkey % 13 <> 0 then o_totalprice end), 4) as price_mean, round(max(date_diff('day', o_orderdate::date, date '1998-12-31') / 30.0), 4) as months
from orders group by o_custkey""")
def entity_builder(spark, sf_dir):
    """One row a customer from its orders: a price that stands for none is left out, dates become months."""
    o = table(spark, sf_dir, "orders")
    price = cleaning.recoded(F.when(F.col("o_orderkey") % 13 == 0, 365243.0).otherwise(F.col("o_totalprice").cast("double")), 365243.0)
    months = F.datediff(F.lit("1998-12-31").cast("date"), F.col("o_orderdate").cast("date")) / 30.0
    sums = o.select("o_custkey", price.alias("p"), months.alias("m")).groupBy("o_custkey")
    return sums.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 4).alias("price_mean"), F.round(F.max("m"), 4).alias("months"))


DATASET_SQL = f"""{CUTS_SQL.replace("from orders)", "from orders where o_custkey % 100 <> 7)")},
feats as (select o_orderkey, y, case when day is null then 'oot' when day <= cut1 then 'train' when day <= cut2 then 'valid' else 'oot' end as split,
  case when o_orderkey % 5 = 0 then null else o_totalprice::double end as price, case when o_orderkey % 6 = 0 then null else (o_custkey % 50)::double end as cust, case when o_custkey % 2 = 0 then 2.0 else 1.0 end::double as weight from ord, cuts),
there as (select * from feats where split = 'oot' or price is not null or cust is not null),
fills as (select median(price) as p, avg(cust) as c from there where split = 'train')
select o_orderkey, y, split, weight, round(coalesce(price, p)::float, 1) as price, round(coalesce(cust, c)::float, 3) as cust, (price is null)::int as price__isnan, (cust is null)::int as cust__isnan from there, fills"""


@query(DATASET_SQL)
def build_dataset(spark, sf_dir):
    """Orders as a table to learn from."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    o = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "y", "day", F.when(key % 5 != 0, F.col("o_totalprice").cast("double")).alias("price"), F.when(key % 6 != 0, (cust % 50).cast("double")).alias("cust"), (cust % 100).alias("group"))
    out = preparation.build_dataset(o, {"price": "median", "cust": "mean"}, ["o_orderkey"], {"group": [7]}, weight=cleaning.weight(F.col("o_custkey") % 2, {0: 2.0}))
    return out.select("o_orderkey", "y", "split", "weight", F.round("price", 1).alias("price"), F.round("cust", 3).alias("cust"), *(F.col(c).cast("int").alias(c) for c in ("price__isnan", "cust__isnan")))


@query("""with iv as (select p_brand as feature, avg(p_size) as iv from part where p_size > 5 group by 1), psi as (select p_brand as feature, avg(p_partkey % 11) as psi from part where p_size < 40 group by 1),
lift as (select p_brand as feature, max(p_size) as lift from part where p_partkey % 3 = 0 group by 1), miss as (select p_brand as feature, count(distinct p_size) as n_unique from part where p_partkey % 5 < 3 group by 1)
select feature, round(coalesce(iv, 0), 6) as iv, round(coalesce(psi, 0), 6) as psi, coalesce(lift, 1)::double as lift, coalesce(n_unique, 0) as n_unique, regexp_replace(feature, '#.*', '') as family
from iv full join psi using (feature) full join lift using (feature) full join miss using (feature)""")
def ranked_report(spark, sf_dir):
    """The reports of all signals joined by feature, families joined to them, with defaults for what is lacking."""
    p = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "feature")
    by = lambda where, agg: p.where(where).groupBy("feature").agg(agg)
    parts = [by("p_size > 5", F.avg("p_size").alias("iv")), by("p_size < 40", F.avg(F.col("p_partkey") % 11).alias("psi")), by("p_partkey % 3 = 0", F.max("p_size").cast("double").alias("lift")), by("p_partkey % 5 < 3", F.count_distinct("p_size").alias("n_unique"))]
    families = p.select("feature", F.regexp_replace("feature", "#.*", "").alias("family")).distinct()
    out = assembly.joined_chain(parts, ["feature"], "full").join(families, "feature", "left").fillna({"iv": 0.0, "psi": 0.0, "lift": 1.0, "n_unique": 0})
    return out.withColumns({"iv": F.round("iv", 6), "psi": F.round("psi", 6)})
