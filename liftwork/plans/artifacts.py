"""Queries of replayed pipelines, streams, bucketed joins, sinks and row ids, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from liftwork.functions.cleaning import MissingRules
from liftwork.models import replay, screening, serving
from liftwork.models.boosting import Model, Run, Tree
from liftwork.operators import fusion, preparation, splitting
from liftwork.operators.binning import digit, equal_frequency_edges
from liftwork.operators.histogram import histogram
from liftwork.plans.features import edges_sql
from liftwork.plans.models import FEATURES, KEY, ordered_goods
from liftwork.plans.tables import CHAIN
from liftwork.sources import buckets, positions, sinks
from liftwork.sources.intermediate import shared_dir, stored
from liftwork.sources.products import LINE_FEATURES, ORDER_SQL, lines, orders, table
from liftwork.streaming import drift

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/liftwork/{name}-{uuid.uuid4().hex}"


# -- row ids


@query("select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) - 1 as row_id from orders")
def dense_row_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return positions.numbered(o, [F.desc("o_totalprice"), "o_orderkey"]).select("o_orderkey", "row_id")


@query("with ids as (select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) - 1 as row_id from orders) select row_id, o_orderkey, o_totalprice from ids where row_id in (select distinct c_nationkey * 3 from customer)")
def rows_at_positions(spark, sf_dir):
    """Rows fetched by their place in an order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    wanted = table(spark, sf_dir, "customer").select((F.col("c_nationkey") * 3).cast("long").alias("row_id")).distinct()
    return positions.at_positions(positions.numbered(o, [F.desc("o_totalprice"), "o_orderkey"]), wanted).select("row_id", "o_orderkey", "o_totalprice")


# -- bucketed joins


@query(f"with {CHAIN} select coalesce(a.k, b.k, c.k) as k, n_orders, bal, n_events from a full join b on a.k = b.k full join c on coalesce(a.k, b.k) = c.k")
def bucketed_outer_chain(spark, sf_dir):
    """The outer chain on tables that are bucketed by its key: no row is shuffled when they are joined."""
    a = table(spark, sf_dir, "orders").where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    c = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))
    return buckets.outer_chain([buckets.bucketed(t, "k", 8, f"chain_{n}") for n, t in (("orders", a), ("customers", b), ("events", c))], "k")


# -- streams

_CLOSED = "(select max(ts) - interval 1 day as mark from events)"
_REFERENCE = "ts < timestamp '2024-01-08'"
_STREAM_BIN = "case when value is null then -1 else len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) end"


@query(f"""with recursive first_week as (select 'value' as feature, value from events where {_REFERENCE}), {edges_sql("first_week")},
binned as (select ts, {_STREAM_BIN} as bin from events, edges), expected as (select bin, count(*) as n from binned where {_REFERENCE} group by bin),
days as (select date_trunc('day', ts)::timestamp as start, bin, count(*) as n from binned group by all), closed as (select d.* from days d, {_CLOSED} where start + interval 1 day <= mark),
grid as (select start, bin from (select distinct start from closed), (select bin from expected union select bin from closed)),
sides as (select g.start, coalesce(e.n, 0) as e, coalesce(c.n, 0) as a from grid g left join expected e using (bin) left join closed c on c.start = g.start and c.bin = g.bin),
shares as (select start, a as rows_, case when e = 0 then 1e-6 else e / sum(e) over (partition by start) end as e, case when a = 0 then 1e-6 else a / sum(a) over (partition by start) end as a from sides)
select strftime(start, '%Y%m%d')::int as day, sum(rows_)::bigint as n, round(sum((a - e) * ln(a / e)), 6) as psi from shares group by start""")
def streaming_daily_psi(spark, sf_dir):
    """The stability of each day's values against the first week, from a stream: days that the watermark has passed."""
    events = table(spark, sf_dir, "events")
    week = stored(events.where("ts < timestamp_ntz'2024-01-08 00:00:00'").select(F.lit("value").alias("feature"), F.col("value").cast("double").alias("value")), "first-week")
    edges = equal_frequency_edges(histogram(week, None)).first()["edges"]  # frozen: one short list
    cuts = F.array(*(F.lit(float(e)) for e in edges))
    reference = week.groupBy(digit(F.col("value"), cuts).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    counts = drift.windowed_counts(drift.event_stream(spark, sf_dir, "events.parquet"), edges)
    found = drift.window_psi(drift.run_available(counts, _folder(spark, "daily-counts"), _folder(spark, "daily-memory")), reference)
    day = F.date_format(F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, start / 1000000)"), "yyyyMMdd").cast("int")
    return found.select(day.alias("day"), "n", F.round("psi", 6).alias("psi"))


@query(f"""with gaps as (select user_id, ts, value, coalesce(ts - lag(ts) over (partition by user_id order by ts) > interval 6 hours, true)::int as new from events where user_id is not null),
runs as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as run from gaps),
sessions as (select user_id, min(ts) as start, max(ts) + interval 6 hours as over_, count(*) as n, sum(value) as total from runs group by user_id, run)
select user_id, epoch_us(start) as start, n, round(total, 4) as total from sessions, {_CLOSED} where over_ <= mark""")
def streaming_sessions(spark, sf_dir):
    """Sessions of users from a stream, closed by the watermark."""
    found = drift.sessions(drift.event_stream(spark, sf_dir, "events.parquet"))
    out = drift.run_available(found, _folder(spark, "sessions"), _folder(spark, "sessions-memory"))
    return out.select("user_id", "start", "n", F.round("total", 4).alias("total"))


# -- replayed pipelines

RULES = MissingRules(overrides={"l_discount": MissingRules(sentinels=(), negative_missing=True), "l_tax": MissingRules(sentinels=(0.05,))})


@query("""with cleaned as (select l_orderkey, l_partkey, case when l_quantity <= 0 then null else l_quantity end as q, case when l_extendedprice <= 0 then null else l_extendedprice end as p,
  case when l_discount < 0 then null else l_discount end as d, case when l_tax < 0 or l_tax = 0.05 then null else l_tax end as t from lineitem),
fills as (select quantile_cont(q, 0.5) as q, avg(p) as p, quantile_cont(d, 0.5) as d, quantile_cont(t, 0.5) as t from cleaned)
select l_orderkey, l_partkey, coalesce(c.q, f.q) as l_quantity, round(coalesce(c.p, f.p), 4) as l_extendedprice, coalesce(c.d, f.d) as l_discount, coalesce(c.t, f.t) as l_tax, (c.t is null)::int as l_tax__isnan,
  c.q is null and c.p is null and c.d is null and c.t is null as all_missing from cleaned c, fills f""")
def replayed_features(spark, sf_dir):
    """Cleaning rules with overrides for two columns, fitted fills and indicators, as a pipeline that was saved and loaded."""
    raw = lines(spark, sf_dir).select("l_orderkey", "l_partkey", *LINE_FEATURES)
    cleaned = replay.CleanStage.of(columns=LINE_FEATURES, rules=replay._as_dict(RULES), overrides={c: replay._as_dict(r) for c, r in RULES.overrides.items()}).transform(raw)
    fills = preparation.fit_fill(cleaned, {"l_quantity": "median", "l_extendedprice": "mean", "l_discount": "median", "l_tax": "median"})
    folder = _folder(spark, "replay")
    replay.save(replay.scoring_pipeline(LINE_FEATURES, RULES, preparation.indicator_columns(cleaned, LINE_FEATURES), fills), folder)
    out = replay.load(folder).transform(raw).withColumn("l_tax__isnan", F.col("l_tax__isnan").cast("int"))
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 4)).select("l_orderkey", "l_partkey", *LINE_FEATURES, "l_tax__isnan", "all_missing")


@query()
def scoring_replay(spark, sf_dir):
    """Scores of out-of-time orders by a pipeline that was fitted, calibrated, saved and loaded."""
    split = stored(splitting.split_by_day(ordered_goods(spark, sf_dir)), "replay-split")
    models, _ = screening.probing(split, KEY, FEATURES, runs=[Run("final", eta=0.3)], rounds=5, patience=3, metric="logloss")
    edges = screening.train_edges(split.where("split = 'train'"), FEATURES)
    rules = MissingRules(sentinels=(), negative_missing=False)
    raw = replay.scoring_pipeline(FEATURES, rules, [], {}, models[0], edges).transform(split.where("split = 'valid'"))
    points = fusion.isotonic_table(raw.withColumn("raw_score", F.round("raw_score", 12)), "raw_score").orderBy("x").collect()  # a point a pool of scores
    folder = _folder(spark, "replay")
    replay.save(replay.scoring_pipeline(FEATURES, rules, [], {}, models[0], edges, [(r["x"], r["y"]) for r in points]), folder)
    found = replay.scored(replay.load(folder), split.where("split = 'oot'"))
    return found.select(KEY, "y", F.round("raw_score", 6).alias("raw_score"), F.round("score", 6).alias("score"))


# -- sinks


@query("""with sums as (select o_orderpriority as priority, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1)
select row_number() over (order by n desc, priority) as position, priority, n, total from sums""")
def ordered_report(spark, sf_dir):
    """A report written in a stated order with its tie-break, and read again with its positions."""
    sums = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    folder = _folder(spark, "report")
    sinks.write_ordered(sums, folder, [F.desc("n"), "priority"])
    return spark.read.csv(folder, header=True, schema="position long, priority string, n long, total double")


@query("""select o_orderstatus as status, count(*) as n, round(sum(case when o_orderstatus = 'F' then o_totalprice * 2 else o_totalprice end), 2) as total from orders group by 1""")
def overwritten_partitions(spark, sf_dir):
    """A table by status of which one partition is written anew, the others keep their files."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    folder = _folder(spark, "by-status")
    sinks.overwrite_partitions(o, folder, ["status"])
    sinks.overwrite_partitions(o.where("status = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2), folder, ["status"])
    return spark.read.parquet(folder).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


# -- served models

_EDGES = {"price": [0.0, 100000.0, 250000.0, 600000.0], "score": [0.0, 0.5, 1.0]}


def _stump(feature: int, cut: int, missing_left: bool, left: float, right: float) -> Tree:
    tree = Tree.empty(1)
    tree.feature[0], tree.bin[0], tree.missing_left[0], tree.value[1], tree.value[2] = feature, cut, missing_left, left, right
    return tree


@query(f"""with {ORDER_SQL}, scored as (select o_custkey as entity, case when o_orderpriority = '1-URGENT' then -1.0
  else 1 / (1 + exp(-(case when o_totalprice < 250000 then -0.8 else 0.6 end + case when o_orderkey % 7 = 0 or score < 0.5 then 0.3 else -0.4 end))) end as score from ord)
select entity, round(max(score)::double, 6) as score, count(*) as n, count(*) filter (where score = -1) as failed from scored group by entity""")
def served_entities(spark, sf_dir):
    """Customers' best scores from vectors written as text; those that cannot be read score -1."""
    o = orders(spark, sf_dir)
    fields = F.struct(F.col("o_totalprice").alias("price"), F.when(F.col("o_orderkey") % 7 != 0, F.col("score")).alias("score"))
    vector = F.when(F.col("o_orderpriority") == "1-URGENT", "{broken").otherwise(F.to_json(fields))
    model = Model(Run("stumps"), [_stump(0, 1, True, -0.8, 0.6), _stump(1, 0, True, 0.3, -0.4)])
    found = serving.entity_scores(o.select(F.col("o_custkey").alias("entity"), vector.alias("vector")), model, _EDGES, "stumps-1")
    return found.select("entity", F.round("score", 6).alias("score"), "n", "failed")
