"""Connected components of an edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwork.llm import staging

#: Rows of a key beyond which they are dealt over SALTS tasks where they are joined.
HOT, SALTS = 512, 64
#: Tasks that the nodes with one label are dealt over.
FEW = 16
_BUCKETS = 1 << 16


class Spread:
    """Deals the rows of frequent keys over SALTS tasks.

    Keys are known by a hash bucket, so what is broadcast are _BUCKETS rows at most; a rare key in the
    bucket of a frequent one is dealt likewise, which does no harm.
    """

    def __init__(self, sizes: DataFrame, key: str, size: str):
        bucket = F.pmod(F.xxhash64(key), F.lit(_BUCKETS)).alias("_bucket")
        self.hot = staging.stored(sizes.where(F.col(size) > HOT).select(bucket).distinct().withColumn("spread", F.lit(SALTS)), "hot-keys")

    def marked(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` with spread, the number of shares of their key."""
        bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(_BUCKETS)))
        return bucketed.join(F.broadcast(self.hot), "_bucket", "left").drop("_bucket").withColumn("spread", F.coalesce("spread", F.lit(1)))

    def dealt(self, rows: DataFrame, key: str, by: Column) -> DataFrame:
        """``rows`` with spread and salt, their share, told by ``by``."""
        return self.marked(rows, key).withColumn("salt", F.pmod(F.xxhash64(by), F.col("spread")).cast("int"))

    def copied(self, rows: DataFrame, key: str) -> DataFrame:
        """A row for each share of a key."""
        return shares(self.marked(rows, key)).drop("spread")


def shares(rows: DataFrame) -> DataFrame:
    """A row with salt for each of the ``spread`` shares."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)))


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edge table (a, b); the component is its smallest node.

    Every round takes the least label of the neighbours and then the label's own label, until no
    label changes. Labels live in written tables; the driver sees one count a round. Minima are
    pre-aggregated before the shuffle and frequent nodes are spread, so a node with very many edges is no
    hot spot.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b")
    both = staging.stored(both, "cc-edges")
    first = staging.stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component"), F.count(F.lit(1)).alias("degree")), "cc-labels")
    spread = Spread(first, "node", "degree")
    both = staging.stored(spread.dealt(both, "b", F.col("a")).drop("spread"), "cc-edges")
    labels = first.select("node", "component")
    while True:
        there = spread.copied(labels, "node").withColumnRenamed("node", "b")
        near = both.join(there, ["b", "salt"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node", "left").select("node", F.least("component", F.coalesce("near", "component")).alias("label"), F.col("component").alias("before"))
        lower = staging.stored(lower, "cc-lower")
        # many nodes may have one label: only nodes that are labels are copied for them
        heads = lower.join(lower.select(F.col("label").alias("node")).distinct(), "node", "left_semi")
        jump = shares(heads.select(F.col("node").alias("label"), F.col("label").alias("further"), F.lit(FEW).alias("spread"))).drop("spread")
        after = lower.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(FEW)).cast("int")).join(jump, ["label", "salt"], "left")
        after = staging.stored(after.select("node", F.least("label", F.coalesce("further", "label")).alias("component"), "before"), "cc-labels")
        done = after.where("component != before").isEmpty()
        staging.drop(lower)
        labels = after.select("node", "component")
        if done:
            return labels
