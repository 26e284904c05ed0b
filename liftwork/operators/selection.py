"""Families and groups of features, hard filters, rank score and the list to keep."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The order of windows and the penalty of long ones.
WINDOWS = ("7d", "30d", "90d", "180d", "360d", "all", "life", "hist")
PENALTY = {"7d": 0.0, "30d": 0.0, "90d": 0.1, "180d": 0.2, "360d": 0.3, "all": 0.4, "life": 0.4, "hist": 0.4}

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class FamilyRule:
    """A pattern of feature names with the named groups base and window, and what a window found by it is called.

    A window is renamed by ``alias`` if that lists it, else by ``template`` with {window} in it, else kept.
    """

    name: str
    pattern: str
    alias: dict[str, str] = field(default_factory=dict)
    template: str = "{window}"


# Patterns of common ways to name windows, and the names that stand for them.
RULES = {
    r.name: r
    for r in (
        FamilyRule("suffix_day", r"^(?P<base>.+?)_(?P<window>7d|30d|90d|180d|360d|all|life|hist)$"),
        FamilyRule("prefix_d", r"^(?P<base>.+?)_d(?P<window>7|30|90|180|360)$", template="{window}d"),
        FamilyRule("chinese_jin_days", r"^(?P<base>.+?)_近(?P<window>\d+)天$", template="{window}d"),
        FamilyRule("english_last_days", r"^(?P<base>.+?)_last(?P<window>\d+)days$", template="{window}d"),
        FamilyRule("number_only", r"^(?P<base>.+?)_(?P<window>7|14|30|60|90|180|360)$", template="{window}d"),
        FamilyRule("suffix_mon", r"^(?P<base>.+?)_(?P<window>1mon|3mon|6mon|12mon|24mon|all|life|hist)$"),
        FamilyRule("chinese_jin_months", r"^(?P<base>.+?)_近(?P<window>\d+)月$", template="{window}mon"),
        FamilyRule("english_last_months", r"^(?P<base>.+?)_last(?P<window>\d+)months$", template="{window}mon"),
        FamilyRule("suffix_mon_to_days", r"^(?P<base>.+?)_(?P<window>\d+)mon$", {"1": "30d", "3": "90d", "6": "180d", "12": "360d", "24": "720d"}),
        FamilyRule("suffix_year", r"^(?P<base>.+?)_(?P<window>1y|2y|3y|5y|10y|all|life|hist)$"),
        FamilyRule("chinese_jin_years", r"^(?P<base>.+?)_近(?P<window>\d+)年$", template="{window}y"),
        FamilyRule("english_last_years", r"^(?P<base>.+?)_last(?P<window>\d+)years$", template="{window}y"),
        FamilyRule("suffix_year_to_days", r"^(?P<base>.+?)_(?P<window>\d+)y$", {"1": "360d", "2": "720d", "3": "1080d", "5": "1800d", "10": "3600d"}),
    )
}


def _lookup(c: Column, table: dict, other) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(other))


def parse_families(features: DataFrame, windows=WINDOWS) -> DataFrame:
    """``features`` with family, window and window_rank; a name without a window is a family of its own."""
    pattern = f"^(.+)_({'|'.join(windows)})$"
    base, window = (F.nullif(F.regexp_extract("feature", pattern, g), F.lit("")) for g in (1, 2))
    out = features.withColumns({"family": F.coalesce(base, F.col("feature")), "window": window})
    return out.withColumn("window_rank", _lookup(F.col("window"), {w: i for i, w in enumerate(windows)}, len(windows)))


def families_by_rules(features: DataFrame, rules: list[str | FamilyRule], windows=WINDOWS, enabled: bool = True) -> DataFrame:
    """``features`` with family, window, window_rank and rule, by the first of the rules that a name matches.

    Rules are names of ``RULES`` or rules of one's own. Windows that ``windows`` lacks rank last, with a warning. A name that
    no rule matches is a family of its own without a window, as are all names if ``enabled`` is false.
    """
    none = F.lit(None).cast("string")
    base, window, by = none, none, none
    for rule in reversed([RULES[r] if isinstance(r, str) else r for r in rules] if enabled else []):
        places = re.compile(rule.pattern).groupindex
        pattern = rule.pattern.replace("(?P<", "(?<")
        hit = F.col("feature").rlike(pattern)
        raw = F.regexp_extract("feature", pattern, places["window"])
        before, _, behind = rule.template.partition("{window}")
        named = _lookup(raw, rule.alias, None) if rule.alias else none
        base = F.when(hit, F.regexp_extract("feature", pattern, places["base"])).otherwise(base)
        window = F.when(hit, F.coalesce(named, F.concat(F.lit(before), raw, F.lit(behind)))).otherwise(window)
        by = F.when(hit, F.lit(rule.name)).otherwise(by)
    out = features.withColumns({"family": F.coalesce(base, F.col("feature")), "window": window, "rule": by})
    rank = _lookup(F.col("window"), {w: i for i, w in enumerate(windows)}, len(windows))
    out = out.withColumn("window_rank", F.when(F.col("window").isNotNull(), rank))
    unknown = [r["window"] for r in out.where(F.col("window").isNotNull() & ~F.col("window").isin(list(windows))).select("window").distinct().limit(20).collect()]
    if unknown:
        log.warning("windows without a rank stand last: %s", ", ".join(sorted(unknown)))
    return out


def group_members(features: DataFrame, groups: dict[str, dict]) -> DataFrame:
    """``parse_groups`` with the rules of each feature's group: group_prefer (best_iv), group_max_keep (2) and group_corr_cutoff (0.85)."""
    out = parse_groups(features, groups)
    for name, key, default in (("group_prefer", "prefer", "best_iv"), ("group_max_keep", "keep", 2), ("group_corr_cutoff", "corr_cutoff", 0.85)):
        out = out.withColumn(name, _lookup(F.col("group"), {g: type(default)(rule.get(key, default)) for g, rule in groups.items()}, None))
    return out


def missing_members(features: DataFrame, groups: dict[str, dict]) -> DataFrame:
    """(group, feature) of features that a group lists by name and that are not there."""
    listed = features.sparkSession.createDataFrame([(g, f) for g, rule in groups.items() for f in rule.get("features", [])], "`group` string, feature string")
    return listed.join(features.select("feature"), "feature", "left_anti").select("group", "feature")


def rank_by_group_rules(report: DataFrame, position: str = "position") -> DataFrame:
    """``report`` (group_members) with group_size, in_group_rank and group_kept by the rules of each group.

    best_iv, and any preference that is not known, ranks by value; first by ``position``. Features without a group have 0, 0
    and true.
    """
    whole = Window.partitionBy("group")
    grouped = F.col("group").isNotNull()
    first = F.col("group_prefer") == "first"
    order = whole.orderBy(F.when(first, F.col(position)), F.when(~first, -F.col("iv")).asc_nulls_last(), "feature")
    out = report.withColumns({"group_size": F.when(grouped, F.count(F.lit(1)).over(whole)).otherwise(0), "in_group_rank": F.when(grouped, F.row_number().over(order)).otherwise(0)})
    return out.withColumn("group_kept", ~grouped | (F.col("in_group_rank") <= F.col("group_max_keep")))


def family_gain_audit(gains: DataFrame, families: DataFrame, most: float = 0.40) -> DataFrame:
    """(family, total_gain, kept_count, gain_share) of (feature, gain), greatest share first; a feature without a family is its own.

    A family of several features with more than ``most`` of all gain is warned of. Without any gain there is no row.
    """
    joined = gains.join(families.select("feature", "family"), "feature", "left").withColumn("family", F.coalesce("family", "feature"))
    total = gains.agg(F.sum("gain")).first()[0] or 0.0
    if total <= 0:
        return joined.limit(0).select("family", F.col("gain").alias("total_gain"), F.lit(0).cast("long").alias("kept_count"), F.col("gain").alias("gain_share"))
    out = joined.groupBy("family").agg(F.sum("gain").alias("total_gain"), F.count("feature").alias("kept_count")).withColumn("gain_share", F.col("total_gain") / total)
    for r in out.where((F.col("gain_share") > most) & (F.col("kept_count") > 1)).limit(20).collect():
        log.warning("%s has %.1f %% of all gain with %s features", r["family"], r["gain_share"] * 100, r["kept_count"])
    return out.orderBy(F.desc("gain_share"), "family")


def parse_groups(features: DataFrame, groups: dict[str, dict]) -> DataFrame:
    """``features`` with group: the first that lists the feature or one of its prefixes, else NULL."""
    out = F
    for name, rule in groups.items():
        hit = F.col("feature").isin(list(rule.get("features", [])))
        for prefix in rule.get("prefixes", []):
            hit = hit | F.col("feature").startswith(prefix)
        out = out.when(hit, F.lit(name))
    return features.withColumn("group", out.otherwise(F.lit(None).cast("string")))


def rank_family(report: DataFrame, prefer: str = "best_iv", keep: int = 2, tolerance: float = 0.02) -> DataFrame:
    """``report`` with family_size, in_family_rank and family_kept."""
    whole = Window.partitionBy("family")
    close = F.max("iv").over(whole) - F.col("iv") <= tolerance
    orders = {
        "best_iv": [F.desc("iv"), F.col("feature")],
        "shortest": [F.col("window_rank"), F.desc("iv"), F.col("feature")],
        "longest": [F.desc("window_rank"), F.desc("iv"), F.col("feature")],
        "best_iv_short_bias": [F.desc("_close"), F.when(F.col("_close"), F.col("window_rank")), F.desc("iv"), F.col("feature")],
    }
    if prefer not in orders:
        raise ValueError(f"unknown preference {prefer}: one of {sorted(orders)}")
    out = report.withColumn("_close", close).withColumns({"family_size": F.count(F.lit(1)).over(whole), "in_family_rank": F.row_number().over(whole.orderBy(*orders[prefer]))})
    return out.withColumn("family_kept", F.col("in_family_rank") <= keep).drop("_close")


def rank_family_by_group(report: DataFrame, policy: dict, overrides: dict[str, dict]) -> DataFrame:
    """``rank_family`` under the policy of each family: the common one, overlaid by that of the group all its features are in.

    Features without a group do not count; a family of several groups has the common policy.
    """
    whole = Window.partitionBy("family")
    anchored = report.withColumn("_anchor", F.when(F.min("group").over(whole) == F.max("group").over(whole), F.max("group").over(whole)))
    own = F.coalesce(F.col("_anchor"), F.lit("")).isin(list(overrides))
    parts = [rank_family(anchored.where(~own), **policy)]
    parts += [rank_family(anchored.where(F.col("_anchor") == group), **(policy | rule)) for group, rule in overrides.items()]
    return reduce(DataFrame.unionByName, parts).drop("_anchor")


def rank_group(report: DataFrame, keep: int = 2) -> DataFrame:
    """``report`` with group_size, in_group_rank and group_kept; features without a group have 0, 0 and true."""
    whole = Window.partitionBy("group")
    grouped = F.col("group").isNotNull()
    out = report.withColumns({"group_size": F.when(grouped, F.count(F.lit(1)).over(whole)).otherwise(0), "in_group_rank": F.when(grouped, F.row_number().over(whole.orderBy(F.desc("iv"), "feature"))).otherwise(0)})
    return out.withColumn("group_kept", F.col("in_group_rank") <= keep)


def hard_filters(report: DataFrame, missing_max=0.95, iv_min=0.02, psi_cutoff=0.25, psi_hard=False, lift_keep=None, short=("7d", "30d"), short_max=0.98) -> DataFrame:
    """``report`` with hard_reason (reasons joined by ;, empty if none) and psi_over_cutoff."""
    cap = F.when(F.coalesce(F.col("window").isin(list(short)), F.lit(False)), max(missing_max, short_max)).otherwise(missing_max)
    low = F.col("iv") < iv_min
    if lift_keep is not None:
        low = low & (F.col("lift") < lift_keep)
    over = F.coalesce(F.col("psi") >= psi_cutoff, F.lit(False))
    reasons = [F.when(F.col("n_unique") <= 1, "constant"), F.when(F.col("missing_rate") > cap, "high_missing"), F.when(low, "low_iv")]
    if psi_hard:
        reasons.append(F.when(over, "high_psi"))
    return report.withColumns({"hard_reason": F.concat_ws(";", *reasons), "psi_over_cutoff": over})


def _z(name: str) -> Column:
    """Score by mean and population deviation of all features; missing is the mean, no deviation gives 0."""
    all_ = Window.partitionBy()
    return F.coalesce(F.try_divide(F.col(name) - F.avg(name).over(all_), F.stddev_pop(name).over(all_)), F.lit(0.0))


def rank_score(report: DataFrame, weights: dict[str, float] | None = None, psi_weight=0.25, missing_weight=0.5, missing_from=0.5, gamma=0.0, psi_mode="soft", probe_weight=0.25) -> DataFrame:
    """``report`` with rank_score. ``weights`` may have psi; with psi_mode off stability does not count. gain_rank_pct counts where it is there."""
    w = {"iv": 1.0, "lift": 1.0, "gini": 1.0} | (weights or {})
    psi_weight = 0.0 if psi_mode == "off" else w.pop("psi", psi_weight)
    w.pop("psi", None)
    score = sum((F.lit(v) * _z(k) for k, v in w.items()), F.lit(0.0)) - F.lit(psi_weight) * _z("psi")
    score = score - F.when(F.col("missing_rate") > missing_from, missing_weight).otherwise(0.0) - F.lit(gamma) * _lookup(F.col("window"), PENALTY, 0.0)
    if "gain_rank_pct" in report.columns:
        score = score + F.lit(probe_weight) * _z("gain_rank_pct")
    return report.withColumn("rank_score", score)


def _average_rank(by: list[str], name: str) -> Column:
    """Rank over the number of rows, equal values share the mean of theirs."""
    peers = F.count(F.lit(1)).over(Window.partitionBy(*by, name))
    return (F.rank().over(Window.partitionBy(*by).orderBy(name)) + (peers - 1) / 2) / F.count(F.lit(1)).over(Window.partitionBy(*by))


def gain_ranks(report: DataFrame, gain: str = "gain") -> DataFrame:
    """``report`` with gain_rank_pct."""
    return report.withColumn("gain_rank_pct", _average_rank([], gain))


def quadrants(report: DataFrame, cut: float = 0.7) -> DataFrame:
    """``report`` (with iv, gain_rank_pct, coverage) with quadrant: stable, interp, discover or noise.

    The gain is ranked among the features of the same fifth of coverage. A row a feature.
    """
    fifths = report.agg(F.expr("percentile(coverage, array(0.2, 0.4, 0.6, 0.8))").alias("_fifths"))
    placed = report.crossJoin(F.broadcast(fifths)).withColumn("_fifth", F.size(F.filter("_fifths", lambda e: e < F.col("coverage"))))  # one row
    ranked = placed.withColumns({"_gain": _average_rank(["_fifth"], "gain_rank_pct") > cut, "_iv": _average_rank([], "iv") > cut})
    quadrant = F.when(F.col("_iv") & F.col("_gain"), "stable").when(F.col("_iv"), "interp").when(F.col("_gain"), "discover").otherwise("noise")
    return ranked.withColumn("quadrant", quadrant).drop("_fifths", "_fifth", "_gain", "_iv")


def reason_counts(report: DataFrame) -> DataFrame:
    """(reason, n) of the reasons for which features were dropped; duplicates of any feature count together."""
    reasons = report.where("reject_reason <> ''").select(F.explode(F.split("reject_reason", ";")).alias("reason"))
    return reasons.groupBy(F.substring_index("reason", ":", 1).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def medians(report: DataFrame, by: str, names: dict[str, str]) -> DataFrame:
    """(by, n, names...): medians of columns of the report."""
    return report.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *(F.expr(f"percentile({c}, 0.5)").alias(n) for n, c in names.items()))


def missing_buckets(report: DataFrame, cuts: tuple[float, ...] = (0.1, 0.3, 0.5, 0.7, 0.9)) -> DataFrame:
    """(bucket, n, iv, lift): medians by bucket of the missing rate, right-closed."""
    bucket = sum(((F.col("missing_rate") > c).cast("int") for c in cuts), F.lit(0))
    return medians(report.withColumn("bucket", bucket), "bucket", {"iv": "iv", "lift": "lift"})


def window_pairs(report: DataFrame) -> DataFrame:
    """(windows, n): how many families keep the same windows."""
    kept = F.array_sort(F.collect_list(F.struct("window_rank", "window")))
    pairs = report.where("family_kept").groupBy("family").agg(F.array_join(F.transform(kept, lambda s: s["window"]), "+").alias("windows"))
    return pairs.groupBy("windows").agg(F.count(F.lit(1)).alias("n"))


def auto_keep(report: DataFrame) -> DataFrame:
    """``report`` (with kept flags, hard_reason, rank_score and cluster) with reject_reason and auto_keep."""
    whole = Window.partitionBy("cluster").orderBy(F.desc("rank_score"), "feature")
    best = F.first("feature").over(whole)
    reasons = [
        F.nullif(F.col("hard_reason"), F.lit("")), F.when(~F.coalesce("family_kept", F.lit(True)), "family_dropped_by_policy"),
        F.when(~F.coalesce("group_kept", F.lit(True)), "group_dropped_by_policy"), F.when(F.col("_best") != F.col("feature"), F.concat(F.lit("corr_dup_of:"), "_best")),
    ]
    return report.withColumn("_best", best).withColumn("reject_reason", F.concat_ws(";", *reasons)).drop("_best").withColumn("auto_keep", F.col("reject_reason") == "")


def families_summary(report: DataFrame) -> DataFrame:
    """One row a family of several members."""
    kept = F.col("family_kept")
    out = report.groupBy("family").agg(
        F.count(F.lit(1)).alias("members"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window_rank", "window"))), lambda s: s["window"]), ",").alias("windows"),
        F.max("iv").alias("iv_best"), F.expr("percentile(iv, 0.5)").alias("iv_median"), F.max("psi").alias("psi_max"), F.count_if(kept).alias("kept_count"),
        F.array_join(F.array_sort(F.collect_list(F.when(kept, F.col("feature")))), ",").alias("kept_features"),
        F.try_divide(F.max_by("iv", "window_rank"), F.min_by("iv", "window_rank")).alias("iv_long_over_short"), (F.max("iv") - F.min_by("iv", "window_rank")).alias("iv_best_over_short"),
    )
    return out.where("members > 1")


def groups_summary(report: DataFrame, names: list[str]) -> DataFrame:
    """One row for each configured group, empty ones too."""
    spark = report.sparkSession
    sums = report.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.max("iv").alias("iv_best"), F.count_if("group_kept").alias("kept_count"))
    return spark.createDataFrame([(n,) for n in names], "group string").join(sums, "group", "left").fillna({"members": 0, "kept_count": 0})


def top_features(report: DataFrame, n: int) -> DataFrame:
    """(ordinal, feature) of the best kept features."""
    order = Window.orderBy(F.desc("rank_score"), "feature")
    return report.where("auto_keep").select(F.row_number().over(order).alias("ordinal"), "feature").where(F.col("ordinal") <= n)
