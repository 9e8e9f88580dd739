"""Registry of checked queries: a Spark job and, where SQL can say it, its twin.

The SQL twins share one prefix of common table expressions that states the same
adapter, star join and feature rules independently of the Spark code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.scalars import half_even
from parcelmood.operators.features import build_features, derive_features, ordinal_target, strict_target
from parcelmood.operators.master import build_master
from parcelmood.operators.split import assign_split, rows_of_split
from parcelmood.session import configure
from parcelmood.sources.fixture import FIXTURE_CALENDAR, fixture_tables
from parcelmood.sources.storage import store_table

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, prefix: bool = True) -> Callable[[Job], Job]:
    """Register a job; ``sql`` is the final SELECT after the shared prefix."""

    def register(job: Job) -> Job:
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return job(configure(spark), directory)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"WITH {PREFIX}\n{sql}" if prefix else sql
        return job

    return register


def master_of(spark: SparkSession, directory: str, **options) -> DataFrame:
    return build_master(fixture_tables(spark, directory), **options)


def derived_of(spark: SparkSession, directory: str) -> DataFrame:
    """Derived features of every reviewed order, delivered or not."""
    return derive_features(master_of(spark, directory, review_columns=["review_id"]))


def features_of(spark: SparkSession, directory: str) -> DataFrame:
    """Population with targets, features and split label."""
    master = master_of(spark, directory, review_columns=["review_id"], dimensions=True)
    frame = build_features(master).transform(ordinal_target).transform(strict_target)
    return assign_split(frame, FIXTURE_CALENDAR)


def stored_features(
    spark: SparkSession, directory: str, splits: Sequence[str] = (), columns: Sequence[str] = ()
) -> DataFrame:
    """The feature frame written once, for jobs that scan it several times.

    One folder per partition of the split, so a training scan reads only its own. A job names the splits and columns
    that it reads, and only these are joined and written.
    """
    frame = features_of(spark, directory)
    if splits:
        frame = rows_of_split(frame, *splits)
    if columns:
        frame = frame.select(*columns, C.SPLIT)
    return store_table(frame, "features", [C.SPLIT])


def scored_of(spark: SparkSession, directory: str) -> DataFrame:
    """Population with a score that is a fixed function of two features."""
    margin = 1.5 - 0.08 * F.col("delivery_delay_days") - 0.2 * (F.col("order_item_count") - 1)
    return features_of(spark, directory).withColumn(
        "proba", F.round(1 / (1 + F.exp(-margin)), 6)
    )


def as_text(*names: str):
    """Timestamps as text, so that both engines print them alike."""
    return [F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) for n in names]


def rounded(name: str, digits: int = 4):
    return half_even(F.col(name), digits).alias(name)


def _in(months) -> str:
    return ", ".join(f"'{m}'" for m in months)


_CAL = FIXTURE_CALENDAR
_FREQ = ", ".join(f"'{c}'" for c in C.CATEGORICAL)

PREFIX = f"""
cents AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS bought
  FROM orders),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS order_status,
    bought AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 71 <> 0 THEN bought + to_seconds((o_orderkey % 48) * 3600) END
      AS order_approved_at,
    CASE WHEN o_orderkey % 53 <> 0 THEN
      o_orderdate + to_seconds(43200) + to_days(CAST((c // 45) % 10 AS INTEGER)) END
      AS order_delivered_carrier_date,
    CASE WHEN o_orderkey % 59 <> 0 THEN
      o_orderdate + to_seconds(43200) + to_days(CAST(c % 45 AS INTEGER)) END
      AS order_delivered_customer_date,
    o_orderdate + to_days(20 + 3 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER))
      AS order_estimated_delivery_date
  FROM cents),
first_reviews AS (
  SELECT order_id, (order_id * 7919) % 100 AS u,
    coalesce(order_delivered_customer_date >= order_estimated_delivery_date + INTERVAL 1 DAY,
             false) AS late
  FROM raw_orders),
star_reviews AS (
  SELECT order_id, u,
    CASE WHEN late THEN
      CASE WHEN u < 45 THEN 1 WHEN u < 60 THEN 2 WHEN u < 72 THEN 3 WHEN u < 85 THEN 4 ELSE 5 END
    ELSE
      CASE WHEN u < 8 THEN 1 WHEN u < 11 THEN 2 WHEN u < 18 THEN 3 WHEN u < 40 THEN 4 ELSE 5 END
    END AS stars
  FROM first_reviews),
raw_reviews AS (
  SELECT order_id * 10 + 1 AS review_id, order_id, stars AS review_score,
    CASE WHEN u % 3 <> 0 THEN concat('comment ', u) END AS review_comment_message
  FROM star_reviews
  UNION ALL
  SELECT order_id * 10 + 2, order_id, stars % 5 + 1,
    CASE WHEN u % 3 <> 0 THEN concat('comment ', u) END
  FROM star_reviews WHERE order_id % 101 = 0),
raw_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    l_suppkey AS seller_id, l_extendedprice AS price,
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DOUBLE)
      AS freight_value
  FROM lineitem),
raw_payments AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential,
    CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto'
      WHEN 2 THEN 'voucher' ELSE 'debit_card' END AS payment_type,
    CASE WHEN o_orderkey % 89 <> 0 THEN CAST(o_orderkey % 10 + 1 AS INTEGER) END
      AS payment_installments,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS payment_value
  FROM orders),
raw_products AS (
  SELECT p_partkey AS product_id, p_type AS product_category_name,
    CAST(p_size * 150 AS DOUBLE) AS product_weight_g,
    CASE WHEN p_partkey % 53 <> 0 THEN CAST(p_partkey % 6 + 1 AS DOUBLE) END
      AS product_photos_qty,
    p_size + 10 AS product_length_cm, p_size % 7 + 2 AS product_height_cm,
    p_size % 11 + 5 AS product_width_cm
  FROM part),
raw_category AS (
  SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
raw_customers AS (
  SELECT c_custkey AS customer_id, CAST(c_custkey % 1000 AS INTEGER) AS customer_zip_code_prefix,
    CASE WHEN c_custkey % 61 <> 0 THEN n_name END AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_sellers AS (
  SELECT s_suppkey AS seller_id, CASE WHEN s_suppkey % 61 <> 0 THEN n_name END AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
products_named AS (
  SELECT p.*, product_category_name_english
  FROM raw_products p LEFT JOIN raw_category USING (product_category_name)),
items_sum AS (
  SELECT order_id, count(order_item_id) AS order_item_count,
    round(coalesce(sum(price), 0), 6) AS total_price,
    round(coalesce(sum(freight_value), 0), 6) AS total_freight_value,
    first(product_id ORDER BY order_item_id, product_id, seller_id) AS product_id,
    first(seller_id ORDER BY order_item_id, product_id, seller_id) AS seller_id
  FROM raw_items GROUP BY order_id),
items_products AS (
  SELECT s.*, product_category_name_english, product_weight_g, product_photos_qty,
    product_width_cm, product_height_cm, product_length_cm
  FROM items_sum s LEFT JOIN products_named USING (product_id)),
payments_sum AS (
  SELECT order_id, round(coalesce(sum(payment_value), 0), 6) AS payment_value,
    max(payment_installments) AS payment_installments,
    first(payment_type ORDER BY payment_sequential, payment_type) AS payment_type
  FROM raw_payments GROUP BY order_id),
master AS (
  SELECT o.*, r.review_id, r.review_score, r.review_comment_message,
    i.order_item_count, i.total_price, i.total_freight_value, i.product_id, i.seller_id,
    i.product_category_name_english, i.product_weight_g, i.product_photos_qty,
    i.product_width_cm, i.product_height_cm, i.product_length_cm,
    p.payment_value, p.payment_installments, p.payment_type,
    c.customer_state, c.customer_zip_code_prefix, s.seller_state
  FROM raw_orders o
  JOIN raw_reviews r ON o.order_id = r.order_id
  LEFT JOIN items_products i ON o.order_id = i.order_id
  LEFT JOIN payments_sum p ON o.order_id = p.order_id
  LEFT JOIN raw_customers c ON o.customer_id = c.customer_id
  LEFT JOIN raw_sellers s ON i.seller_id = s.seller_id),
timed AS (
  SELECT m.* EXCLUDE (order_item_count, payment_installments),
    CAST(coalesce(order_item_count, 0) AS INTEGER) AS order_item_count,
    CAST(coalesce(payment_installments, 1) AS INTEGER) AS payment_installments,
    strftime(order_purchase_timestamp, '%Y-%m') AS purchase_month,
    CAST(floor((epoch_us(order_delivered_customer_date)
      - epoch_us(order_estimated_delivery_date)) / 86400000000.0) AS INTEGER)
      AS delivery_delay_days,
    CAST(floor((epoch_us(order_delivered_customer_date)
      - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS INTEGER)
      AS actual_delivery_days,
    CAST(floor((epoch_us(order_estimated_delivery_date)
      - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS INTEGER)
      AS estimated_delivery_days,
    (epoch_us(order_approved_at) - epoch_us(order_purchase_timestamp)) / 3600000000.0
      AS approval_time_hours,
    CAST(floor((epoch_us(order_delivered_carrier_date)
      - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS INTEGER) AS handling_days
  FROM master m),
derived AS (
  SELECT t.*,
    CASE WHEN delivery_delay_days <= 0 THEN 1 ELSE 0 END AS delivered_on_time,
    CASE WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END AS is_late,
    CASE WHEN delivery_delay_days <= -5 THEN 1 ELSE 0 END AS delivered_early_5d,
    coalesce(total_price, 0) + coalesce(total_freight_value, 0) AS order_total_value,
    total_freight_value / (coalesce(total_price, 0) + coalesce(total_freight_value, 0) + 1e-9)
      AS freight_ratio,
    total_price / nullif(CAST(order_item_count AS DOUBLE), 0) AS price_per_item,
    CASE WHEN order_item_count > 1 THEN 1 ELSE 0 END AS is_multi_item,
    CASE WHEN payment_installments > 1 THEN 1 ELSE 0 END AS is_installment,
    CASE WHEN product_weight_g > 5000 THEN 1 ELSE 0 END AS is_heavy_item,
    CASE WHEN review_comment_message IS NOT NULL THEN 1 ELSE 0 END AS has_comment,
    CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS purchase_dow,
    CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month_num,
    CASE WHEN isodow(order_purchase_timestamp) >= 6 THEN 1 ELSE 0 END AS purchase_is_weekend,
    CASE WHEN customer_state IS NOT DISTINCT FROM seller_state THEN 1 ELSE 0 END
      AS same_state_seller
  FROM timed t),
feat AS (
  SELECT d.*,
    CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS is_satisfied,
    CASE WHEN review_score <= 2 THEN 0 WHEN review_score = 3 THEN 1 ELSE 2 END
      AS satisfaction_class,
    CASE WHEN review_score >= 5 THEN 1 ELSE 0 END AS is_promoter,
    CASE WHEN purchase_month IN ({_in(_CAL.predict)}) THEN 'predict'
      WHEN purchase_month IN ({_in(_CAL.live)}) THEN 'live'
      WHEN purchase_month IN ({_in(_CAL.backtest)}) THEN 'backtest'
      WHEN purchase_month IN ({_in(_CAL.val)}) THEN 'val'
      WHEN purchase_month <= '{_CAL.train_end}' THEN 'train' ELSE 'excluded' END
      AS dataset_split
  FROM derived d
  WHERE order_status = 'delivered' AND review_score IS NOT NULL
    AND order_delivered_customer_date IS NOT NULL),
scored AS (
  SELECT f.*, round(1 / (1 + exp(-(1.5 - 0.08 * delivery_delay_days
    - 0.2 * (order_item_count - 1)))), 6) AS proba
  FROM feat f)"""
