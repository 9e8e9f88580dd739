"""Model-free part of the feature selection: missing, PSI, correlation, Gini."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from math import isnan

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.histograms import binned_counts
from parcelmood.functions.order_statistics import column_quantiles
from parcelmood.functions.scalars import to_double
from parcelmood.operators.strength import feature_values, univariate_gini


def missing_ratio(frame: DataFrame, columns: Sequence[str] = C.CANDIDATES) -> DataFrame:
    """Share of nulls per column, all columns in one aggregate."""
    present = [c for c in columns if c in frame.columns]
    shares = [F.avg(F.col(c).isNull().cast("int")).alias(c) for c in present]
    return frame.agg(*shares).unpivot([], present, "feature", "missing")


def stability_index(
    train: DataFrame,
    other: DataFrame,
    columns: Sequence[str] = C.NUMERIC,
    bins: int = C.STAT_BINS,
) -> DataFrame:
    """PSI of other against train over train's equal-frequency bins [a, b).

    The edges come from closing brackets, and rows are counted by bin where they are read: at most ``bins`` groups
    per feature and side leave a task. A bin that both lack adds nothing, so the union of present bins is enough.
    """
    present = [c for c in columns if c in train.columns and c in other.columns]
    found = column_quantiles(train, present, [(i, bins) for i in range(bins + 1)])
    edges = {c: list(dict.fromkeys(quantiles)) for c, _, quantiles in found}
    if not edges:
        return train.sparkSession.createDataFrame([], "feature string, psi double")
    shape = train.sparkSession.createDataFrame(
        [(c, len(e), e[0] != e[-1]) for c, e in edges.items()], "feature string, n_edges int, varied boolean"
    )
    inner = {c: e[1:-1] for c, e in edges.items()}
    both = binned_counts(train, inner).select("feature", "bin", F.col("n").alias("expected"), F.lit(0).alias("observed"))
    both = both.unionByName(
        binned_counts(other, inner).select("feature", "bin", F.lit(0).alias("expected"), F.col("n").alias("observed"))
    )
    # shape has one row per feature
    counts = (
        both.groupBy("feature", "bin").agg(F.sum("expected").alias("expected"), F.sum("observed").alias("observed"))
        .join(F.broadcast(shape), "feature")
    )
    totals = counts.groupBy("feature").agg(
        F.sum("expected").alias("expected_total"), F.sum("observed").alias("observed_total")
    )
    joined = counts.join(F.broadcast(totals), "feature")
    eps = F.lit(C.STAT_EPS)
    e = F.greatest(F.col("expected") / F.col("expected_total"), eps)
    o = F.greatest(
        F.col("observed") / F.nullif(F.col("observed_total"), F.lit(0)), eps
    )
    usable = (
        F.bool_and("varied")
        & (F.max("n_edges") >= 3)
        & (F.max("expected_total") > 0)
        & (F.max("observed_total") > 0)
    )
    return joined.groupBy("feature").agg(
        F.when(usable, F.sum((o - e) * F.ln(o / e))).otherwise(0.0).alias("psi")
    )


def _pearson(a: str, b: str) -> Column:
    """Correlation over rows where both are known; null where one is constant."""
    x, y = F.col(a), F.col(b)
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def correlation_pairs(frame: DataFrame, columns: Sequence[str] = C.NUMERIC) -> DataFrame:
    """|Pearson| of every pair of columns over rows where both are known.

    Columns without nulls (all of them, after cleaning) go through Spark ML's
    distributed covariance; only a pair with a null somewhere needs an aggregate
    of its own.  A constant column correlates with nothing (null).
    """
    present = [c for c in columns if c in frame.columns]
    typed = frame.select(*[to_double(c).alias(c) for c in present])
    gaps = typed.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present]).first()
    complete = [c for c in present if gaps[c] == 0]
    found: dict[tuple[str, str], float | None] = {}
    if len(complete) > 1:
        vectors = VectorAssembler(inputCols=complete, outputCol="v").transform(typed).select("v")
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
        for i, j in combinations(range(len(complete)), 2):
            found[complete[i], complete[j]] = float(matrix[i][j])
    rest = [pair for pair in combinations(present, 2) if pair not in found]
    if rest:
        sums = typed.agg(*[_pearson(a, b).alias(f"c{k}") for k, (a, b) in enumerate(rest)]).first()
        found.update({pair: sums[f"c{k}"] for k, pair in enumerate(rest)})
    # one row per pair of catalog columns
    rows = [
        (a, b, None if value is None or isnan(value) else abs(value))
        for (a, b), value in sorted(found.items())
    ]
    return frame.sparkSession.createDataFrame(rows, "fila string, columna string, corr double")


def redundant_features(
    pairs: DataFrame, ginis: DataFrame, threshold: float = C.MAX_CORRELATION
) -> DataFrame:
    """Weaker member of every highly correlated pair (a tie drops the later column).

    Every pair is judged on its own, so chained pairs can lose both members.
    """
    # ginis has one row per feature
    of_row = F.broadcast(ginis.select(F.col("feature").alias("fila"), F.col("gini").alias("g_row")))
    of_col = F.broadcast(
        ginis.select(F.col("feature").alias("columna"), F.col("gini").alias("g_col"))
    )
    weaker = F.when(F.col("g_col") <= F.col("g_row"), F.col("columna")).otherwise(F.col("fila"))
    return (
        pairs.where(F.col("corr") > threshold)
        .join(of_row, "fila")
        .join(of_col, "columna")
        .select(weaker.alias("feature"))
        .distinct()
    )


def selection_steps(
    train: DataFrame,
    val: DataFrame,
    max_missing: float = C.MAX_MISSING,
    max_psi: float = C.MAX_PSI,
    max_correlation: float = C.MAX_CORRELATION,
    min_gini: float = C.MIN_GINI,
    raw_train: DataFrame | None = None,
) -> DataFrame:
    """The step (1 missing, 2 PSI, 3 correlation, 4 Gini) that drops each candidate.

    One row per candidate with its measures; ``dropped_at`` is null for the
    survivors.  ``raw_train`` measures missing values before imputation.
    """
    spark = train.sparkSession
    candidates = [c for c in C.CANDIDATES if c in train.columns]
    numeric = [c for c in candidates if c in C.NUMERIC]
    measured = [c for c in candidates if c in C.NUMERIC + C.BINARY]
    listed = spark.createDataFrame(
        [(i, c, c in numeric, c in measured) for i, c in enumerate(candidates)],
        "position int, feature string, numeric boolean, measured boolean",
    )
    missing = missing_ratio(train if raw_train is None else raw_train, candidates)
    psi = stability_index(train, val, numeric)
    ginis = univariate_gini(feature_values(train, measured))
    # all frames below hold one row per candidate or pair of candidates
    table = (
        listed.join(F.broadcast(missing), "feature", "left")
        .join(F.broadcast(psi), "feature", "left")
        .join(F.broadcast(ginis), "feature", "left")
        .withColumn("gini", F.when(F.col("measured"), F.coalesce("gini", F.lit(0.0))))
        .withColumn(
            "early",
            F.when(F.col("missing") > max_missing, 1).when(
                F.col("numeric") & (F.col("psi") > max_psi), 2
            ),
        )
    )
    alive = table.where(F.col("early").isNull() & F.col("numeric")).select("feature")
    pairs = (
        correlation_pairs(train, numeric)
        .join(F.broadcast(alive.withColumnRenamed("feature", "fila")), "fila", "left_semi")
        .join(F.broadcast(alive.withColumnRenamed("feature", "columna")), "columna", "left_semi")
    )
    redundant = redundant_features(pairs, ginis, max_correlation).withColumn(
        "redundant", F.lit(True)
    )
    step = (
        F.when(F.col("early").isNotNull(), F.col("early"))
        .when(F.col("redundant"), 3)
        .when(F.col("gini") < min_gini, 4)
    )
    return table.join(F.broadcast(redundant), "feature", "left").select(
        "position", "feature", "missing", "psi", "gini", step.alias("dropped_at")
    )


def survivors(steps: DataFrame) -> DataFrame:
    """Candidates that no step drops (an anti join on the candidate list)."""
    dropped = steps.where(F.col("dropped_at").isNotNull()).select("feature")
    return steps.join(F.broadcast(dropped), "feature", "left_anti").select("position", "feature")
