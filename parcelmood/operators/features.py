"""Population, targets, derived order features and panel interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.scalars import (
    clip,
    existing_or_null,
    flag,
    floor_days,
    hours_between,
    number_or_null,
    to_double,
)


def filter_population(master: DataFrame, require_label: bool = True) -> DataFrame:
    """Delivered orders with a delivery date and, unless scoring, a review score."""
    needed = ["order_delivered_customer_date"] + ([C.SCORE] if require_label else [])
    return master.where(F.col("order_status") == C.DELIVERED).dropna(subset=needed)


def binary_target(frame: DataFrame) -> DataFrame:
    score = F.col(C.SCORE).cast("int")
    return frame.withColumns(
        {C.SCORE: score, C.TARGET: (score >= C.SATISFIED_FROM).cast("int")}
    )


def ordinal_target(frame: DataFrame) -> DataFrame:
    """0 detractor (1-2), 1 neutral (3), 2 promoter (4-5); any other score is an error."""
    score = F.col(C.SCORE).cast("int")
    bad = F.raise_error(F.concat(F.lit("review score out of 1..5: "), score.cast("string")))
    grade = (
        F.when(score.between(1, 2), 0)
        .when(score == 3, 1)
        .when(score.between(4, 5), 2)
        .otherwise(bad.cast("int"))
    )
    return frame.withColumn(C.TARGET_ORDINAL, grade)


def strict_target(frame: DataFrame) -> DataFrame:
    return frame.withColumn(
        C.TARGET_STRICT, (F.col(C.SCORE).cast("int") >= C.PROMOTER_FROM).cast("int")
    )


def purchase_month(frame: DataFrame) -> DataFrame:
    return frame.withColumn(C.MONTH, F.date_format("order_purchase_timestamp", "yyyy-MM"))


def time_features(frame: DataFrame) -> DataFrame:
    bought = "order_purchase_timestamp"
    arrived = "order_delivered_customer_date"
    promised = "order_estimated_delivery_date"
    return frame.withColumns(
        {
            "delivery_delay_days": floor_days(arrived, promised),
            "actual_delivery_days": floor_days(arrived, bought),
            "estimated_delivery_days": floor_days(promised, bought),
            "approval_time_hours": hours_between("order_approved_at", bought),
            "handling_days": floor_days("order_delivered_carrier_date", bought),
        }
    )


def delivery_flags(frame: DataFrame) -> DataFrame:
    delay = F.col("delivery_delay_days")
    return frame.withColumns(
        {
            "delivered_on_time": flag(delay <= 0),
            "is_late": flag(delay > 0),
            "delivered_early_5d": flag(delay <= C.EARLY_DAYS),
        }
    )


def order_value_features(frame: DataFrame) -> DataFrame:
    price, freight = to_double("total_price"), to_double("total_freight_value")
    total = F.coalesce(price, F.lit(0.0)) + F.coalesce(freight, F.lit(0.0))
    items = F.coalesce("order_item_count", F.lit(0)).cast("int")
    return frame.withColumns(
        {
            "order_item_count": items,
            "total_price": price,
            "total_freight_value": freight,
            "payment_value": number_or_null(frame, "payment_value"),
            "order_total_value": total,
            "freight_ratio": freight / (total + 1e-9),
            "price_per_item": price / F.nullif(items.cast("double"), F.lit(0.0)),
            "is_multi_item": flag(items > 1),
        }
    )


def payment_features(frame: DataFrame) -> DataFrame:
    count = F.coalesce(number_or_null(frame, "payment_installments"), F.lit(1.0)).cast("int")
    return frame.withColumns(
        {"payment_installments": count, "is_installment": flag(count > 1)}
    )


def product_features(frame: DataFrame) -> DataFrame:
    weight = number_or_null(frame, "product_weight_g")
    return frame.withColumns(
        {
            "product_weight_g": weight,
            "product_photos_qty": number_or_null(frame, "product_photos_qty"),
            "is_heavy_item": flag(weight > C.HEAVY_GRAMS),
        }
    )


def comment_feature(frame: DataFrame) -> DataFrame:
    return frame.withColumn("has_comment", F.col("review_comment_message").isNotNull().cast("int"))


def calendar_features(frame: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    dow = F.weekday(bought)
    return frame.withColumns(
        {
            "purchase_dow": dow,
            "purchase_month_num": F.month(bought),
            "purchase_is_weekend": flag(dow >= 5),
            # two unknown states count as the same state
            "same_state_seller": F.col("customer_state")
            .eqNullSafe(F.col("seller_state"))
            .cast("int"),
        }
    )


def derive_features(frame: DataFrame) -> DataFrame:
    return (
        frame.transform(purchase_month)
        .transform(time_features)
        .transform(delivery_flags)
        .transform(order_value_features)
        .transform(payment_features)
        .transform(product_features)
        .transform(comment_feature)
        .transform(calendar_features)
    )


def build_features(master: DataFrame, require_label: bool = True) -> DataFrame:
    """Population, target and all derived features; one narrow stage."""
    return (
        master.transform(filter_population, require_label)
        .transform(binary_target)
        .transform(derive_features)
    )


def extra_features(frame: DataFrame) -> DataFrame:
    """Derived columns of the model panel, on top of the order features."""
    promised = existing_or_null(frame, "estimated_delivery_days", "int")
    handling = existing_or_null(frame, "handling_days").cast("double")
    paid = F.col("payment_value") if "payment_value" in frame.columns else F.col("total_price")
    added = {
        "promised_delivery_days": promised,
        "dispatch_time_hours": handling * 24.0,
        "delay_ratio": F.coalesce(
            clip(
                F.col("delivery_delay_days") / F.nullif(promised.cast("double"), F.lit(0.0)),
                -3.0,
                3.0,
            ),
            F.lit(0.0),
        ),
        "log_payment_value": F.log1p(clip(paid, low=0.0)),
        "seller_customer_same_state": F.coalesce(
            existing_or_null(frame, "same_state_seller", "int"), F.lit(0)
        ),
        "purchase_dayofweek": F.coalesce(
            existing_or_null(frame, "purchase_dow", "int"), F.lit(0)
        ),
    }
    if "freight_ratio" not in frame.columns:
        share = F.col("total_freight_value") / F.nullif(F.col("total_price"), F.lit(0.0))
        added["freight_ratio"] = F.coalesce(clip(share, 0.0, 5.0), F.lit(0.0))
    for side in ("product_width_cm", "product_height_cm", "product_length_cm"):
        if side not in frame.columns:
            added[side] = F.lit(0.0)
    if "unique_sellers" not in frame.columns:
        added["unique_sellers"] = F.lit(1)
    volume = (
        F.col("product_width_cm") * F.col("product_height_cm") * F.col("product_length_cm")
    ).cast("double")
    return frame.withColumns(added).withColumn(
        "product_volume_cm3", F.coalesce(volume, F.lit(0.0))
    )


def interaction_features(frame: DataFrame) -> DataFrame:
    late = existing_or_null(frame, "is_late", "int")
    return frame.withColumns(
        {
            "interaccion_retraso_items": clip(F.col("delivery_delay_days"), low=0)
            * F.col("order_item_count"),
            "interaccion_precio_tarde": F.col("log_payment_value")
            * F.coalesce(late, F.lit(0)),
            "interaccion_entrega_flete": F.col("actual_delivery_days") * F.col("freight_ratio"),
        }
    )


def panel_features(frame: DataFrame) -> DataFrame:
    return frame.transform(extra_features).transform(interaction_features)


def numeric_columns(frame: DataFrame, columns) -> list[str]:
    """The columns whose type is numeric or boolean, in the given order."""
    plain = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}
    kinds = dict(frame.dtypes)
    return [c for c in columns if kinds[c] in plain or kinds[c].startswith("decimal")]


def column_variation(frame: DataFrame, candidates=C.PANEL_CANDIDATES) -> DataFrame:
    """Which present candidates vary: numbers with two or more values, all categories.

    min < max in one pass says the same as counting distinct values.
    """
    present = [c for c in candidates if c in frame.columns]
    numeric = set(numeric_columns(frame, present))
    checks = [
        flag(F.min(F.col(c)) < F.max(F.col(c))).alias(c)
        if c in numeric
        else F.first(F.lit(1)).alias(c)
        for c in present
    ]
    return (
        frame.agg(*checks)
        .unpivot([], present, "feature", "varies")
        .select("feature", F.coalesce("varies", F.lit(1)).alias("varies"))
    )


def varying_columns(frame: DataFrame, candidates=C.PANEL_CANDIDATES) -> list[str]:
    """Names of the varying candidates (a list bounded by the catalog)."""
    kept = column_variation(frame, candidates).where("varies = 1").select("feature").collect()
    names = {row.feature for row in kept}
    return [c for c in candidates if c in names]
