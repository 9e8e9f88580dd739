"""Queries for sources, joins, projections and the target summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.checks.base import (
    as_text,
    derived_of,
    features_of,
    master_of,
    query,
    rounded,
    scored_of,
)
from parcelmood.functions.scalars import clip, half_even, to_double, to_timestamp_or_null
from parcelmood.operators import features as feat
from parcelmood.operators import master as star
from parcelmood.operators import target_check as check
from parcelmood.operators.metrics import business_metrics, decide
from parcelmood.operators.split import rows_of_months, rows_of_split, split_summary
from parcelmood.session import scratch_path
from parcelmood.sources import storage
from parcelmood.sources.catalog import register_views
from parcelmood.sources.fixture import FIXTURE_CALENDAR, fixture_tables, read_table

ROW = ["order_id", "review_id"]
_DATES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
_SQL_DATES = ", ".join(f"strftime({d}, '%Y-%m-%d %H:%M:%S') AS {d}" for d in _DATES)
_MASTER_SQL = f"""
SELECT order_id, customer_id, order_status, {_SQL_DATES}, review_score, review_comment_message,
  order_item_count, round(total_price, 2) AS total_price,
  round(total_freight_value, 2) AS total_freight_value, product_id, seller_id,
  product_category_name_english, product_weight_g, product_photos_qty,
  round(payment_value, 2) AS payment_value, payment_installments, payment_type,
  customer_state, customer_zip_code_prefix, seller_state
FROM master"""


def _printable_master(frame):
    money = {"total_price", "total_freight_value", "payment_value"}
    columns = [c for c in frame.columns if c not in _DATES and c != C.MONTH]
    return frame.select(
        *as_text(*_DATES), *[F.round(c, 2).alias(c) if c in money else F.col(c) for c in columns]
    )


# ---- sources and sinks ----------------------------------------------------

@query("scan_tables", """
SELECT 'orders' AS tabla, count(*) AS filas, count(order_delivered_customer_date) AS con_dato,
  strftime(min(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS desde FROM raw_orders
UNION ALL SELECT 'reviews', count(*), count(review_comment_message), NULL FROM raw_reviews
UNION ALL SELECT 'items', count(*), count(price), NULL FROM raw_items
UNION ALL SELECT 'payments', count(*), count(payment_value), NULL FROM raw_payments
UNION ALL SELECT 'customers', count(*), count(customer_state), NULL FROM raw_customers
UNION ALL SELECT 'products', count(*), count(product_photos_qty), NULL FROM raw_products
UNION ALL SELECT 'sellers', count(*), count(seller_state), NULL FROM raw_sellers
UNION ALL SELECT 'category', count(*), count(product_category_name_english), NULL
  FROM raw_category""")
def scan_tables(spark, directory):
    tables = fixture_tables(spark, directory)
    register_views(tables)
    filled = {
        "orders": "order_delivered_customer_date",
        "reviews": "review_comment_message",
        "items": "price",
        "payments": "payment_value",
        "customers": "customer_state",
        "products": "product_photos_qty",
        "sellers": "seller_state",
        "category": "product_category_name_english",
    }
    parts = []
    for alias, column in filled.items():
        since = (
            F.date_format(F.min("order_purchase_timestamp"), "yyyy-MM-dd HH:mm:ss")
            if alias == "orders"
            else F.lit(None).cast("string")
        )
        parts.append(
            spark.table(f"raw_{alias}").agg(
                F.lit(alias).alias("tabla"),
                F.count("*").alias("filas"),
                F.count(column).alias("con_dato"),
                since.alias("desde"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("master_roundtrip", _MASTER_SQL)
def master_roundtrip(spark, directory):
    path = scratch_path(spark, "master")
    stored = storage.build_or_reuse(spark, path, lambda: master_of(spark, directory))
    return _printable_master(stored)


@query("report_roundtrip", """
SELECT purchase_month, count(*) AS n, round_even(avg(is_satisfied), 4) AS tasa_satisfechos
FROM feat GROUP BY purchase_month""")
def report_roundtrip(spark, directory):
    report = check.monthly_target_rate(features_of(spark, directory))
    path = storage.save_report(report, scratch_path(spark, "report"))
    return storage.load_report(spark, path, "purchase_month string, n bigint, tasa_satisfechos double")


@query("run_metadata", f"""
SELECT '{C.VERSION}' AS pipeline_version, {C.SEED} AS random_state, '{C.TARGET}' AS target,
  '{FIXTURE_CALENDAR.train_end}' AS train_end,
  '{",".join(FIXTURE_CALENDAR.val)}' AS val_months,
  '{",".join(FIXTURE_CALENDAR.predict)}' AS prediction_months,
  (SELECT count(*) FROM feat) AS n_poblacion,
  (SELECT round_even(avg(review_score), 3) FROM feat) AS average_review_score""")
def run_metadata(spark, directory):
    """Metadata and nested metrics as one JSON document, written and read back."""
    metrics = business_metrics(features_of(spark, directory))
    document = storage.run_document(metrics, FIXTURE_CALENDAR)
    path = storage.save_json(document, scratch_path(spark, "metadata"))
    stored = spark.read.schema(document.schema).json(path)
    return stored.select(
        "pipeline_version",
        "random_state",
        "target",
        "train_end",
        F.array_join("val_months", ",").alias("val_months"),
        F.array_join("prediction_months", ",").alias("prediction_months"),
        F.col("metrics.n").alias("n_poblacion"),
        F.col("metrics.average_review_score").alias("average_review_score"),
    )


@query("pending_models", """
SELECT DISTINCT event_type AS modelo FROM events WHERE NOT event_type < 'p'""", prefix=False)
def pending_models(spark, directory):
    """Stand-in: event types are models, those before 'p' have stored results."""
    events = read_table(spark, directory, "events")
    models = events.groupBy(F.col("event_type").alias("modelo")).agg(F.avg("value").alias("score"))
    path = scratch_path(spark, "results")
    storage.save_model_results(models.where("modelo < 'p'"), path)
    # storing a model again replaces its folder only
    storage.save_model_results(models.where("modelo = 'click'"), path)
    return storage.pending_models(models, spark.read.parquet(path))


# ---- joins ----------------------------------------------------------------

@query("join_category", """
SELECT product_id, product_category_name, product_category_name_english FROM products_named""")
def join_category(spark, directory):
    tables = fixture_tables(spark, directory)
    return star.translate_categories(tables["products"], tables["category"]).select(
        "product_id", "product_category_name", "product_category_name_english"
    )


@query("items_agg", """
SELECT order_id, order_item_count, round(total_price, 2) AS total_price,
  round(total_freight_value, 2) AS total_freight_value, product_id, seller_id FROM items_sum""")
def items_agg(spark, directory):
    return star.aggregate_items(fixture_tables(spark, directory)["items"]).withColumns(
        {c: F.round(c, 2) for c in ("total_price", "total_freight_value")}
    )


@query("payments_agg", """
SELECT order_id, round(payment_value, 2) AS payment_value, payment_installments, payment_type
FROM payments_sum""")
def payments_agg(spark, directory):
    return star.aggregate_payments(fixture_tables(spark, directory)["payments"]).withColumn(
        "payment_value", F.round("payment_value", 2)
    )


@query("join_items_products", """
SELECT order_id, product_id, product_category_name_english, product_weight_g, product_photos_qty
FROM items_products""")
def join_items_products(spark, directory):
    tables = fixture_tables(spark, directory)
    products = star.translate_categories(tables["products"], tables["category"])
    return star.attach_products(star.aggregate_items(tables["items"]), products).select(
        "order_id",
        "product_id",
        "product_category_name_english",
        "product_weight_g",
        "product_photos_qty",
    )


@query("join_orders_reviews", """
SELECT o.order_id, r.review_id, o.order_status, r.review_score, r.review_comment_message
FROM raw_orders o JOIN raw_reviews r ON o.order_id = r.order_id""")
def join_orders_reviews(spark, directory):
    tables = fixture_tables(spark, directory)
    return star.join_reviews(tables["orders"], tables["reviews"], ["review_id"]).select(
        "order_id", "review_id", "order_status", "review_score", "review_comment_message"
    )


@query("latest_review_master", """
SELECT order_id, max(review_id) AS review_id, arg_max(review_score, review_id) AS review_score
FROM master GROUP BY order_id""")
def latest_review_master(spark, directory):
    """The master with one review per order."""
    return master_of(
        spark, directory, review_columns=["review_id"], latest_review_only=True
    ).select("order_id", "review_id", "review_score")


@query("master_table", _MASTER_SQL)
def master_table(spark, directory):
    return _printable_master(master_of(spark, directory))


# ---- population and targets -------------------------------------------------

@query("population_filter", "SELECT order_id, review_id, review_score FROM feat")
def population_filter(spark, directory):
    master = master_of(spark, directory, review_columns=["review_id"])
    return feat.filter_population(master).select(*ROW, "review_score")


@query("target_binary", "SELECT order_id, review_id, is_satisfied FROM feat")
def target_binary(spark, directory):
    return features_of(spark, directory).select(*ROW, "is_satisfied")


@query("target_ordinal", "SELECT order_id, review_id, satisfaction_class FROM feat")
def target_ordinal(spark, directory):
    return features_of(spark, directory).select(*ROW, "satisfaction_class")


@query("target_strict", "SELECT order_id, review_id, is_promoter FROM feat")
def target_strict(spark, directory):
    return features_of(spark, directory).select(*ROW, "is_promoter")


# ---- derived features -------------------------------------------------------

@query("purchase_month", "SELECT order_id, review_id, purchase_month FROM derived")
def purchase_month(spark, directory):
    return derived_of(spark, directory).select(*ROW, "purchase_month")


@query("time_features", """
SELECT order_id, review_id, delivery_delay_days, actual_delivery_days, estimated_delivery_days,
  round_even(approval_time_hours, 4) AS approval_time_hours, handling_days FROM derived""")
def time_features(spark, directory):
    return derived_of(spark, directory).select(
        *ROW,
        "delivery_delay_days",
        "actual_delivery_days",
        "estimated_delivery_days",
        rounded("approval_time_hours"),
        "handling_days",
    )


@query("delivery_flags", """
SELECT order_id, review_id, delivered_on_time, is_late, delivered_early_5d FROM derived""")
def delivery_flags(spark, directory):
    return derived_of(spark, directory).select(
        *ROW, "delivered_on_time", "is_late", "delivered_early_5d"
    )


@query("order_value_features", """
SELECT order_id, review_id, order_item_count, round(total_price, 2) AS total_price,
  round(total_freight_value, 2) AS total_freight_value,
  round(order_total_value, 2) AS order_total_value,
  round_even(freight_ratio, 6) AS freight_ratio,
  round_even(price_per_item, 6) AS price_per_item, is_multi_item FROM derived""")
def order_value_features(spark, directory):
    return derived_of(spark, directory).select(
        *ROW,
        "order_item_count",
        *[F.round(c, 2).alias(c) for c in ("total_price", "total_freight_value", "order_total_value")],
        rounded("freight_ratio", 6),
        rounded("price_per_item", 6),
        "is_multi_item",
    )


@query("payment_features", """
SELECT order_id, review_id, round(payment_value, 2) AS payment_value, payment_installments,
  is_installment FROM derived""")
def payment_features(spark, directory):
    return derived_of(spark, directory).select(
        *ROW, F.round("payment_value", 2).alias("payment_value"), "payment_installments",
        "is_installment",
    )


@query("product_features", """
SELECT order_id, review_id, product_weight_g, product_photos_qty, is_heavy_item FROM derived""")
def product_features(spark, directory):
    return derived_of(spark, directory).select(
        *ROW, "product_weight_g", "product_photos_qty", "is_heavy_item"
    )


@query("has_comment", "SELECT order_id, review_id, has_comment FROM derived")
def has_comment(spark, directory):
    return derived_of(spark, directory).select(*ROW, "has_comment")


@query("calendar_features", """
SELECT order_id, review_id, purchase_dow, purchase_month_num, purchase_is_weekend,
  same_state_seller FROM derived""")
def calendar_features(spark, directory):
    return derived_of(spark, directory).select(
        *ROW, "purchase_dow", "purchase_month_num", "purchase_is_weekend", "same_state_seller"
    )


_RATES = {"approval_time_hours": 4, "freight_ratio": 6, "price_per_item": 6}
_MONEY = ("total_price", "total_freight_value", "order_total_value", "payment_value")


def _shown(column: str):
    if column in _RATES:
        return rounded(column, _RATES[column])
    return F.round(column, 2).alias(column) if column in _MONEY else F.col(column)


def _shown_sql(column: str) -> str:
    if column in _RATES:
        return f"round_even({column}, {_RATES[column]}) AS {column}"
    return f"round({column}, 2) AS {column}" if column in _MONEY else column


_FRAME = (*C.CANDIDATES, C.TARGET, C.TARGET_ORDINAL, C.TARGET_STRICT, C.MONTH, C.SPLIT)


@query("feature_frame", f"""
SELECT order_id, review_id, {", ".join(_shown_sql(c) for c in _FRAME)} FROM feat""")
def feature_frame(spark, directory):
    return features_of(spark, directory).select(*ROW, *[_shown(c) for c in _FRAME])


_EXTRA_SQL = """, extra AS (
  SELECT f.*, estimated_delivery_days AS promised_delivery_days,
    handling_days * 24.0 AS dispatch_time_hours,
    coalesce(CASE WHEN delivery_delay_days IS NOT NULL AND estimated_delivery_days <> 0 THEN
      least(greatest(CAST(delivery_delay_days AS DOUBLE) / estimated_delivery_days, -3), 3) END, 0)
      AS delay_ratio,
    CASE WHEN payment_value IS NOT NULL THEN ln(1 + greatest(payment_value, 0)) END
      AS log_payment_value,
    CAST(product_width_cm * product_height_cm * product_length_cm AS DOUBLE) AS volume,
    same_state_seller AS seller_customer_same_state, 1 AS unique_sellers,
    purchase_dow AS purchase_dayofweek
  FROM feat f)"""


@query("extra_features", f"""{_EXTRA_SQL}
SELECT order_id, review_id, promised_delivery_days,
  CAST(dispatch_time_hours AS DOUBLE) AS dispatch_time_hours,
  round_even(delay_ratio, 6) AS delay_ratio, round_even(log_payment_value, 6) AS log_payment_value,
  coalesce(volume, 0) AS product_volume_cm3, seller_customer_same_state, unique_sellers,
  purchase_dayofweek FROM extra""")
def extra_features(spark, directory):
    return feat.extra_features(features_of(spark, directory)).select(
        *ROW,
        "promised_delivery_days",
        "dispatch_time_hours",
        rounded("delay_ratio", 6),
        rounded("log_payment_value", 6),
        "product_volume_cm3",
        "seller_customer_same_state",
        "unique_sellers",
        "purchase_dayofweek",
    )


@query("interaction_features", f"""{_EXTRA_SQL}
SELECT order_id, review_id,
  CAST(greatest(delivery_delay_days, 0) * order_item_count AS INTEGER)
    AS interaccion_retraso_items,
  round_even(log_payment_value * is_late, 6) AS interaccion_precio_tarde,
  round_even(actual_delivery_days * freight_ratio, 5) AS interaccion_entrega_flete
FROM extra""")
def interaction_features(spark, directory):
    return feat.panel_features(features_of(spark, directory)).select(
        *ROW,
        "interaccion_retraso_items",
        rounded("interaccion_precio_tarde", 6),
        rounded("interaccion_entrega_flete", 5),
    )


_NUMERIC_PANEL = [c for c in C.PANEL_CANDIDATES if c != "product_category_name_english"]
_ON_FEAT = {
    "interaccion_retraso_items": "greatest(delivery_delay_days, 0) * order_item_count",
    "delay_ratio": "coalesce(CAST(delivery_delay_days AS DOUBLE) / nullif(estimated_delivery_days, 0), 0)",
    "interaccion_precio_tarde": "payment_value * is_late",
    "interaccion_entrega_flete": "actual_delivery_days * freight_ratio",
    "dispatch_time_hours": "handling_days",
    "purchase_dayofweek": "purchase_dow",
    "unique_sellers": "1",
    "promised_delivery_days": "estimated_delivery_days",
    "log_payment_value": "payment_value",
    "product_volume_cm3": "product_width_cm * product_height_cm * product_length_cm",
    "seller_customer_same_state": "same_state_seller",
}


@query("varying_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {_ON_FEAT.get(c, c)}) > 1 AS INTEGER) AS varies FROM feat"
    for c in _NUMERIC_PANEL
) + " UNION ALL SELECT 'product_category_name_english', 1")
def varying_columns(spark, directory):
    return feat.column_variation(feat.panel_features(features_of(spark, directory)))


# ---- temporal split -----------------------------------------------------------

@query("temporal_split", "SELECT order_id, review_id, purchase_month, dataset_split FROM feat")
def temporal_split(spark, directory):
    return features_of(spark, directory).select(*ROW, "purchase_month", "dataset_split")


@query("split_filter", f"""
SELECT order_id, review_id, dataset_split FROM feat
WHERE dataset_split IN ('val', 'live') OR purchase_month IN ('{FIXTURE_CALENDAR.backtest[0]}')""")
def split_filter(spark, directory):
    frame = features_of(spark, directory)
    parts = rows_of_split(frame, "val", "live").unionByName(
        rows_of_months(frame, FIXTURE_CALENDAR.backtest[:1])
    )
    return parts.select(*ROW, "dataset_split")


@query("split_summary", """
SELECT dataset_split, count(order_id) AS filas, min(purchase_month) AS mes_min,
  max(purchase_month) AS mes_max FROM feat GROUP BY dataset_split""")
def split_rows(spark, directory):
    return split_summary(features_of(spark, directory))


# ---- target summary -------------------------------------------------------------

@query("monthly_target_rate", """
SELECT purchase_month, count(*) AS n, round_even(avg(is_satisfied), 4) AS tasa_satisfechos
FROM feat GROUP BY purchase_month""")
def monthly_target_rate(spark, directory):
    return check.monthly_target_rate(features_of(spark, directory))


@query("delivery_gap", """
SELECT round_even(avg(is_satisfied) FILTER (WHERE delivered_on_time = 1), 4)
    AS satisfaccion_entrega_a_tiempo,
  round_even(avg(is_satisfied) FILTER (WHERE delivered_on_time = 0), 4)
    AS satisfaccion_entrega_tardia,
  round_even((avg(is_satisfied) FILTER (WHERE delivered_on_time = 1)
    - avg(is_satisfied) FILTER (WHERE delivered_on_time = 0)) * 100, 1)
    AS gap_puntos_porcentuales
FROM feat""")
def delivery_gap(spark, directory):
    return check.delivery_gap(features_of(spark, directory))


_VOLUME_SQL = """, volume AS (
  SELECT purchase_month, dataset_split, count(*) AS n FROM feat GROUP BY ALL)"""


@query("monthly_volume", f"{_VOLUME_SQL} SELECT * FROM volume")
def monthly_volume(spark, directory):
    return check.monthly_volume(features_of(spark, directory))


@query("volume_pivot", f"""{_VOLUME_SQL}
SELECT purchase_month, {", ".join(
    f"CAST(coalesce(sum(n) FILTER (WHERE dataset_split = '{s}'), 0) AS BIGINT) AS {s}"
    for s in C.SPLIT_ORDER)}
FROM volume GROUP BY purchase_month""")
def volume_pivot(spark, directory):
    return check.volume_pivot(check.monthly_volume(features_of(spark, directory)))


@query("volume_stack", f"""{_VOLUME_SQL}
SELECT purchase_month, dataset_split, n,
  CAST(sum(n) OVER w AS BIGINT) AS top, CAST(sum(n) OVER w - n AS BIGINT) AS base
FROM volume WINDOW w AS (PARTITION BY purchase_month ORDER BY
  list_position(['train', 'val', 'backtest', 'live', 'predict', 'excluded'], dataset_split)
  ROWS UNBOUNDED PRECEDING)""")
def volume_stack(spark, directory):
    return check.volume_stack(check.monthly_volume(features_of(spark, directory)))


@query("target_check", """, months AS (
  SELECT purchase_month AS m, count(*) AS n, round_even(avg(is_satisfied), 4) AS rate
  FROM feat GROUP BY purchase_month HAVING count(*) >= 100)
SELECT 'is_satisfied' AS target, 'review_score >= 4' AS regla,
  (SELECT count(*) FROM feat) AS n_poblacion,
  (SELECT round_even(avg(is_satisfied), 4) FROM feat) AS tasa_global_satisfechos,
  (SELECT m FROM months ORDER BY rate, m LIMIT 1) AS mes_min,
  (SELECT min(rate) FROM months) AS tasa_min,
  (SELECT m FROM months ORDER BY rate DESC, m LIMIT 1) AS mes_max,
  (SELECT max(rate) FROM months) AS tasa_max,
  (SELECT round_even(avg(rate), 4) FROM months) AS media_del_periodo,
  (SELECT round_even(avg(is_satisfied), 4) FROM feat WHERE delivered_on_time = 1)
    AS satisfaccion_entrega_a_tiempo,
  (SELECT round_even(avg(is_satisfied), 4) FROM feat WHERE delivered_on_time = 0)
    AS satisfaccion_entrega_tardia,
  (SELECT round_even((avg(is_satisfied) FILTER (WHERE delivered_on_time = 1)
    - avg(is_satisfied) FILTER (WHERE delivered_on_time = 0)) * 100, 1) FROM feat)
    AS gap_puntos_porcentuales""")
def target_check(spark, directory):
    return check.check_target(features_of(spark, directory))


# ---- scalar functions -------------------------------------------------------------

@query("scalar_functions", """
SELECT o_orderkey,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS numero,
  TRY_CAST(o_orderpriority AS DOUBLE) AS no_numero,
  strftime(TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP), '%Y-%m-%d') AS fecha,
  strftime(TRY_CAST(o_orderpriority AS TIMESTAMP), '%Y-%m-%d') AS no_fecha,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dia, CAST(month(o_orderdate) AS INTEGER) AS mes,
  strftime(o_orderdate, '%Y-%m') AS periodo,
  round_even(ln(1 + o_totalprice), 6) AS log1p,
  round_even(1 / (1 + exp(-(o_orderkey % 7 - 3.0))), 6) AS logistica,
  least(greatest(o_totalprice, 1000), 200000) AS recorte,
  CAST(nullif(o_orderkey % 5, 0) AS BIGINT) AS sin_cero,
  replace(o_orderpriority, ' ', '_') AS con_guion,
  concat('{"C":', o_orderkey % 10, ',"penalty":"l2"}') AS params,
  CAST(o_orderkey % 10 AS BIGINT) AS param_c
FROM orders""", prefix=False)
def scalar_functions(spark, directory):
    orders = read_table(spark, directory, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    shown = orders.withColumns(
        {
            "digit": F.substring("o_orderpriority", 1, 1),
            "day_text": F.date_format(day, "yyyy-MM-dd"),
            "params": F.to_json(
                F.struct((key % 10).alias("C"), F.lit("l2").alias("penalty"))
            ),
        }
    )
    return shown.select(
        "o_orderkey",
        to_double("digit").alias("numero"),
        to_double("o_orderpriority").alias("no_numero"),
        F.date_format(to_timestamp_or_null("day_text"), "yyyy-MM-dd").alias("fecha"),
        F.date_format(to_timestamp_or_null("o_orderpriority"), "yyyy-MM-dd").alias("no_fecha"),
        F.weekday(day).alias("dia"),
        F.month(day).alias("mes"),
        F.date_format(day, "yyyy-MM").alias("periodo"),
        half_even(F.log1p("o_totalprice"), 6).alias("log1p"),
        half_even(1 / (1 + F.exp(-(key % 7 - 3.0))), 6).alias("logistica"),
        clip(F.col("o_totalprice"), 1000.0, 200000.0).alias("recorte"),
        F.nullif(key % 5, F.lit(0)).alias("sin_cero"),
        F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("con_guion"),
        "params",
        F.from_json("params", "C bigint, penalty string")["C"].alias("param_c"),
    )


@query("score_threshold", """
SELECT order_id, review_id, proba, CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END AS pred_satisfecho
FROM scored""")
def score_threshold(spark, directory):
    return decide(scored_of(spark, directory)).select(*ROW, "proba", "pred_satisfecho")
