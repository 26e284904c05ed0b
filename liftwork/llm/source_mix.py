"""Mixing sources to target weights.

The words of each source are aggregated; weights share all words out over the sources, a source getting
at most ``MOST`` times its own; what a source cannot take goes to the others by weight. The target over the
source's words is its repetition rate: every document is taken floor(rate) times, and once more with a
probability of the fraction, decided by a digest of seed, id and text. So runs agree, whatever the
partitioning, and a document's copies need no look at other documents.

All work is done by DataFrame functions. Sources are aggregated before they are shuffled, so a hot source is
no hot task; a table of at most ``SMALL`` sources is broadcast, a larger one is joined with hot sources
dealt over tasks.

Sources go by code point, null last; null is a source of its own, not the empty one. Null text and text
without words have size 0 and nothing is taken of them; a source without words has target 0. Null ids are
drawn by their text. Rows that repeat id and text share their fate, rows that repeat the id alone do not.
A text of any length is counted as a whole. Other columns do not matter, whatever their names. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.components import Spread
from liftwork.sources.positions import numbered

WEIGHTS = (5, 2, 1)
#: Times its words that a source gives at most, and so a document.
MOST = 3
SEED = 20
#: Sources up to which their table is broadcast.
SMALL = 100_000
_DIGITS = 13  # hexadecimal digits of a digest that make a number in [0, 1)


def draw(seed: int = SEED) -> Column:
    """A number in [0, 1) that hangs on the seed, the id and the text."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, _DIGITS), 16, 10).cast("long") / F.lit(float(16**_DIGITS))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, draw) of every row, written once."""
    given = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
    return staging.stored(given.select("doc_id", "source", words.alias("size"), draw(seed).alias("draw")), "mix-sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, n, target) of every source of (source, size).

    Each round shares what is left over the sources that are not full yet; sources over ``most`` times their
    size are full. The driver sees three sums a round; there are as many rounds as it takes until none is over.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = numbered(sums, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    open_ = staging.stored(ranked.select("source", "source_size", "n", weight.cast("long").alias("_weight"), F.lit(False).alias("_full")), "mix-sources")
    full = F.col("source_size") * most
    while True:
        r = open_.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(F.col("_full"), full).otherwise(0)).alias("taken"), F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_weight"))).alias("weight")
        ).first()
        left, weight = (r["total"] or 0) - (r["taken"] or 0), r["weight"] or 1
        share = F.lit(left).cast("double") * F.col("_weight") / F.lit(weight)
        over = ~F.col("_full") & (share > full)
        if open_.where(over).isEmpty():
            return open_.select("source", "source_size", "n", F.when(F.col("_full"), full.cast("double")).otherwise(share).alias("target"))
        open_ = staging.stored(open_.withColumn("_full", F.col("_full") | over), "mix-sources")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of (doc_id, source, text)."""
    sizes = sized(docs, seed)
    goal = staging.stored(targets(sizes, weights, most), "mix-targets")
    named = lambda d: d.withColumn("_source", F.concat_ws("", F.when(F.col("source").isNull(), "0").otherwise("1"), F.col("source")))
    right = named(goal).select("_source", "source_size", "target", "n")
    if goal.count() <= SMALL:
        joined = named(sizes).join(F.broadcast(right), "_source")
    else:
        spread = Spread(right, "_source", "n")
        joined = spread.dealt(named(sizes), "_source", F.struct("doc_id", "draw")).drop("spread").join(spread.copied(right, "_source"), ["_source", "salt"])
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    copies = F.floor(rate) + F.when(F.col("draw") < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emitted(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs``, all its columns, as many times as it is taken, with copy (from 0).

    Targets come from one pass over the texts and copies from a second, so no text is shuffled; rows keep
    their place and the copies of a row stand in its task. Sources have to be at most ``SMALL``.
    """
    goal = targets(sized(docs, seed), weights, most)
    name = {c: staging.unused([*docs.columns, "copy"], c) for c in ("source", "rate", "draw")}
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    goal = staging.stored(goal.select(F.col("source").alias(name["source"]), rate.alias(name["rate"])), "mix-rates")
    if goal.count() > SMALL:
        raise ValueError(f"more than {SMALL} sources: join the copies that mixed() gives by id")
    drawn = docs.withColumn(name["draw"], draw(seed)).join(F.broadcast(goal), docs["source"].cast("string").eqNullSafe(F.col(name["source"])))
    whole = F.floor(name["rate"])
    copies = (whole + F.when(F.col(name["draw"]) < F.col(name["rate"]) - whole, 1).otherwise(0)).cast("int")
    numbers = F.when(copies > 0, F.sequence(F.lit(0), copies - 1))
    return drawn.withColumn("copy", F.explode(numbers)).select(*docs.columns, "copy")


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(staging.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


_CASES = " ".join(f"when {k} then {w}" for k, w in enumerate(WEIGHTS))
ORACLE_SQL = f"""
with sizes as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, {_DIGITS}))::bigint / {float(16**_DIGITS)} as draw from documents),
sums as (select source, sum(size)::bigint as source_size from sizes group by source),
weighed as (select *, case (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} {_CASES} end as weight from sums),
ordered as (select *, sum(source_size) over () - coalesce(sum(source_size * {MOST}) over (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as room,
  sum(weight) over (order by source_size / weight, source nulls last rows between current row and unbounded following) as rest from weighed),
judged as (select *, room::double * weight / rest > source_size * {MOST} as over_most from ordered),
left_over as (select sum(source_size) - coalesce(sum(source_size * {MOST}) filter (where over_most), 0) as room, sum(weight) filter (where not over_most) as rest from judged),
goals as (select source, source_size, case when over_most then (source_size * {MOST})::double else o.room::double * weight / o.rest end as target from judged, left_over o),
rates as (select *, case when source_size > 0 then least(target / source_size, {float(MOST)}) else 0.0 end as rate from goals)
select doc_id, size, source_size, target, s.source, (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end)::bigint as copies, copies * size as taken
from sizes s join rates r on s.source is not distinct from r.source
"""
