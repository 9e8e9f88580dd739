"""Repeatable samples, stratified folds and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.scalars import half_even, ratio
from parcelmood.operators.features import numeric_columns


PREFIX_DIGITS = 4


def hash_order(row_id: Sequence[str], seed: int = C.SEED) -> list[Column]:
    """A shuffled order that does not depend on the partitioning."""
    return [F.xxhash64(F.lit(seed), *row_id), *[F.col(c) for c in row_id]]


def digest_order(row_id: Sequence[str], seed: int = C.SEED) -> list[Column]:
    """A shuffled order that other engines can state too: the MD5 of seed and row id as text."""
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_id]]
    return [F.md5(F.concat_ws("-", *parts)), *[F.col(c) for c in row_id]]


def fixed_sample(
    frame: DataFrame, size: int, row_id: Sequence[str], seed: int = C.SEED
) -> DataFrame:
    """Exactly min(size, rows) rows, the first in the order of their digests.

    Counts by digest prefix (at most 16 ** PREFIX_DIGITS rows) tell up to which prefix rows are needed, so only about
    ``size`` rows are ordered, however many tasks there are.
    """
    order = digest_order(row_id, seed)
    prefix = F.substring(order[0], 1, PREFIX_DIGITS)
    counts = frame.groupBy(prefix.alias("prefix")).count().orderBy("prefix").collect()
    reached, cut = 0, None
    for row in counts:
        if reached >= size:
            break
        reached, cut = reached + row["count"], row.prefix
    needed = frame if cut is None else frame.where(prefix <= cut)
    return needed.orderBy(*order).limit(size)


def stratified_folds(
    frame: DataFrame,
    row_id: Sequence[str],
    label: str = C.TARGET,
    folds: int = C.CV_FOLDS,
    seed: int = C.SEED,
) -> DataFrame:
    """Add ``fold``: shuffled within each class, class sizes differ by one at most where no row id is repeated.

    A class in the order of its rows' digests is cut into equal ranges. Counts by digest prefix tell in which prefix a
    cut lies, and only the digests there are ranked; then every row finds its fold by comparing its own digest, so the
    rows themselves are neither shuffled nor stored. Rows with the same id have one digest and so one fold.
    """
    digest = digest_order(row_id, seed)[0]
    named = frame.select(F.col(label).alias("_class"), digest.alias("_digest"))
    prefixed = named.withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    # at most 16 ** PREFIX_DIGITS rows a class
    counts = prefixed.groupBy("_class", "_prefix").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(Window.partitionBy("_class"))
    placed = counts.withColumns({"start": F.coalesce(F.sum("n").over(before), F.lit(0)), "total": total})
    # fold f begins at place f * (n // folds) + min(f, n % folds)
    firsts = F.transform(
        F.sequence(F.lit(1), F.lit(folds - 1)),
        lambda f: f * F.floor(F.col("total") / folds) + F.least(f, F.col("total") % folds),
    )
    inside = F.filter(firsts, lambda at: (at >= F.col("start")) & (at < F.col("start") + F.col("n")))
    cuts = placed.where(F.size(inside) > 0) if folds > 1 else placed.limit(0)
    cuts = cuts.select(F.col("_class").alias("c"), F.col("_prefix").alias("p"), "start", inside.alias("firsts"))
    # at most folds - 1 prefixes a class
    same = F.col("_class").eqNullSafe(F.col("c")) & (F.col("_prefix") == F.col("p"))
    near = prefixed.join(F.broadcast(cuts), same).groupBy("_class", "_digest", "p", "start", "firsts")
    ordered = Window.partitionBy("_class", "p").orderBy("_digest")
    ranked = near.agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.col("start") + F.sum("n").over(ordered))
    holds = F.filter("firsts", lambda at: (at >= F.col("upto") - F.col("n")) & (at < F.col("upto")))
    found = ranked.select("_class", F.col("_digest").alias("cut"), F.explode(holds)).collect()
    fold = F.lit(0)
    for r in found:
        beyond = F.col(label).eqNullSafe(F.lit(r._class)) & (digest >= r.cut)
        fold = fold + F.when(beyond, 1).otherwise(0)
    return frame.withColumn("fold", fold.cast("int"))


def class_balance(frame: DataFrame, label: str = C.TARGET) -> DataFrame:
    """One row: class counts, positive share, positive-to-negative and balanced weights."""
    counts = frame.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    )
    neg, pos = F.col("neg"), F.col("pos")
    total = pos + neg
    return counts.select(
        "neg",
        "pos",
        half_even(ratio(neg, total), 4).alias("insatisfechos_pct"),
        half_even(pos / F.greatest(neg, F.lit(1)), 4).alias("scale_pos_weight"),
        (total / F.nullif(2.0 * neg, F.lit(0.0))).alias("peso_0"),
        (total / F.nullif(2.0 * pos, F.lit(0.0))).alias("peso_1"),
    )


def with_class_weight(
    frame: DataFrame, label: str = C.TARGET, name: str = "peso", reference: DataFrame | None = None
) -> DataFrame:
    """Balanced weight per row; the two weights are learned from ``reference``."""
    weights = class_balance(frame if reference is None else reference, label).first()
    return frame.withColumn(
        name,
        F.when(F.col(label) == 0, F.lit(weights.peso_0 or 0.0)).otherwise(
            F.lit(weights.peso_1 or 0.0)
        ),
    )


def numeric_matrix(
    frame: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The numeric columns among the given ones, nulls as 0, next to the kept columns."""
    numeric = numeric_columns(frame, [c for c in columns if c in frame.columns])
    return frame.select(
        *keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numeric]
    )
