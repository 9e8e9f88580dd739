"""Predictive strength of single features: Gini, WOE and information value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.histograms import area_rows, bin_edges, ranked_histogram, value_histogram
from parcelmood.functions.scalars import half_even


def feature_values(
    frame: DataFrame, columns: Sequence[str], target: str = C.TARGET
) -> DataFrame:
    """Histogram of all columns with class counts, which Gini, WOE and information value read.

    Its size is that of the distinct values, not of the rows.
    """
    return value_histogram(frame, columns, target)


def univariate_gini(values: DataFrame) -> DataFrame:
    """|2 AUC - 1| of each raw column; 0 with too few rows or no variation."""
    return _usable_gini(area_rows(values, ["feature"]))


def ranked_gini(ranked: DataFrame) -> DataFrame:
    """``univariate_gini`` of a histogram that is ranked already, so that nothing is sorted again."""
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    pairs = F.col("pos").cast("double") * F.col("neg")
    summed = ranked.groupBy("feature").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("n_values"), won.alias("_pairs")
    )
    return _usable_gini(summed.withColumn("auc", F.when(pairs > 0, F.col("_pairs") / pairs)))


def _usable_gini(per_feature: DataFrame) -> DataFrame:
    pairs = F.col("pos").cast("double") * F.col("neg")
    usable = (
        (F.col("pos") + F.col("neg") >= C.MIN_STAT_ROWS) & (F.col("n_values") > 1) & (pairs > 0)
    )
    return per_feature.select(
        "feature",
        F.when(usable, F.abs(2 * F.col("auc") - 1)).otherwise(0.0).alias("gini"),
    )


def woe_table(values: DataFrame, bins: int = C.STAT_BINS) -> DataFrame:
    """Good and bad counts and weight of evidence per feature and bucket.

    Few distinct values are buckets of their own; else equal-frequency buckets
    (a, b].  From the histogram on, a feature has at most ``bins`` groups.
    """
    return woe_of_ranked(ranked_histogram(values), bins)


def woe_of_ranked(values: DataFrame, bins: int = C.STAT_BINS) -> DataFrame:
    """``woe_table`` of a histogram that is ranked already."""
    edges = bin_edges(values, bins)
    value = F.col("value")
    bucket = F.when(
        F.col("n_values") > bins, F.size(F.filter("inner_edges", lambda e: e < value))
    )
    # edges has one row per feature
    placed = values.join(F.broadcast(edges), "feature").select(
        "feature",
        "value",
        "pos",
        "neg",
        "pos_total",
        "neg_total",
        bucket.alias("bin"),
        F.when(F.col("n_values") <= bins, value).alias("level"),
    )
    grouped = placed.groupBy("feature", "bin", "level").agg(
        F.min("value").alias("desde"),
        F.max("value").alias("hasta"),
        F.sum("pos").alias("buenos"),
        F.sum("neg").alias("malos"),
        F.max("pos_total").alias("pos_total"),
        F.max("neg_total").alias("neg_total"),
    )
    share_good = F.col("buenos") / F.greatest("pos_total", F.lit(1))
    share_bad = F.col("malos") / F.greatest("neg_total", F.lit(1))
    woe = F.ln((share_good + C.STAT_EPS) / (share_bad + C.STAT_EPS))
    return grouped.select(
        "feature",
        "desde",
        "hasta",
        "buenos",
        "malos",
        share_good.alias("pct_buenos"),
        share_bad.alias("pct_malos"),
        woe.alias("woe"),
        ((share_good - share_bad) * woe).alias("iv"),
        ((F.col("pos_total") > 0) & (F.col("neg_total") > 0)).alias("two_classes"),
    )


def information_value(woe: DataFrame) -> DataFrame:
    """Sum over buckets; 0 for a constant feature or a single class."""
    usable = (F.count("*") > 1) & F.bool_and("two_classes")
    return woe.groupBy("feature").agg(F.when(usable, F.sum("iv")).otherwise(0.0).alias("iv"))


def iv_label(iv):
    return (
        F.when(iv < 0.02, "sin poder")
        .when(iv < 0.1, "débil")
        .when(iv < 0.3, "medio")
        .when(iv < 0.5, "fuerte")
        .otherwise("sospechoso (revisar fuga)")
    )


def iv_table(iv: DataFrame) -> DataFrame:
    """Information values from strong to weak, with their usual reading."""
    shown = half_even(F.col("iv"), 4)
    return iv.select(
        F.col("feature").alias("variable"),
        shown.alias("information_value"),
        iv_label(shown).alias("fuerza"),
    ).orderBy(F.desc("information_value"), "variable")


def flag_gap(
    frame: DataFrame, columns: Sequence[str] = C.BINARY, target: str = C.TARGET
) -> DataFrame:
    """Target rate with the flag set minus without it, in points; null if one is absent."""
    present = [c for c in columns if c in frame.columns]
    y = F.col(target)
    sums = []
    for c in present:
        on = F.coalesce(F.col(c).cast("int"), F.lit(0)) == 1
        sums.append(
            ((F.avg(F.when(on, y)) - F.avg(F.when(~on, y))) * 100).alias(c)
        )
    return (
        frame.agg(*sums)
        .unpivot([], present, "feature", "gap")
        .select("feature", half_even(F.col("gap"), 1).alias("gap_satisfaccion_pp"))
    )


def family_of(feature):
    """Family of a feature; every other feature belongs to the last one."""
    label = F.lit(C.OTHER_FAMILY)
    for family, members in C.FAMILIES.items():
        label = F.when(feature.isin(*members), family).otherwise(label)
    return label


def feature_evidence(frame: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Gini, information value and flag gap of every candidate on clean training rows."""
    candidates = [c for c in C.CANDIDATES if c in frame.columns]
    measured = [c for c in candidates if c in C.NUMERIC + C.BINARY]
    values = ranked_histogram(feature_values(frame, measured, target))
    listed = frame.sparkSession.createDataFrame([(c,) for c in candidates], "feature string")
    # every side has one row per candidate
    joined = (
        listed.join(F.broadcast(ranked_gini(values)), "feature", "left")
        .join(F.broadcast(information_value(woe_of_ranked(values))), "feature", "left")
        .join(F.broadcast(flag_gap(frame, target=target)), "feature", "left")
    )
    known = F.col("feature").isin(*measured)
    return joined.select(
        family_of(F.col("feature")).alias("familia"),
        F.col("feature").alias("variable"),
        F.when(known, half_even(F.coalesce("gini", F.lit(0.0)), 4)).alias("gini_univariante"),
        F.when(known, half_even(F.coalesce("iv", F.lit(0.0)), 4)).alias("information_value"),
        "gap_satisfaccion_pp",
    ).orderBy("familia", F.desc_nulls_last("gini_univariante"))


def family_champions(evidence: DataFrame) -> DataFrame:
    """Best feature of every family by Gini; a tie goes to the first name.

    The window runs over one row per candidate.
    """
    best = Window.partitionBy("familia").orderBy(F.desc("gini_univariante"), "variable")
    return (
        evidence.where(F.col("gini_univariante").isNotNull())
        .withColumn("_place", F.row_number().over(best))
        .where("_place = 1")
        .select("familia", "variable", "gini_univariante", "information_value")
        .orderBy(F.desc("gini_univariante"))
    )
