"""Raw relational tables: schemas, file patterns and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmood.functions.scalars import to_timestamp_or_null

# Column contract of the raw tables.
RAW_SCHEMAS = {
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp"
    ),
    "reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, "
        "review_answer_timestamp timestamp"
    ),
    "items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp, price double, freight_value double"
    ),
    "payments": (
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value double"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
        "customer_city string, customer_state string"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty double, product_weight_g double, "
        "product_length_cm int, product_height_cm int, product_width_cm int"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
    ),
    "category": "product_category_name string, product_category_name_english string",
}

# File name endings; a glob, so that any file prefix fits.
RAW_FILES = {
    "orders": "*_orders_dataset.csv",
    "reviews": "*_order_reviews_dataset.csv",
    "items": "*_order_items_dataset.csv",
    "payments": "*_order_payments_dataset.csv",
    "customers": "*_customers_dataset.csv",
    "products": "*_products_dataset.csv",
    "sellers": "*_sellers_dataset.csv",
    "category": "product_category_name_translation.csv",
}

ORDER_DATES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def read_raw_table(spark: SparkSession, directory: str, alias: str) -> DataFrame:
    """One raw CSV table; columns are matched to the contract by header name.

    Everything is read as text and coerced column by column, so that the order
    of the columns in the file does not matter and a bad number or date becomes
    null instead of failing the job.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", alias == "reviews")
        .option("escape", '"')
        .csv(f"{directory}/{RAW_FILES[alias]}")
    )
    fields = [entry.strip().split(" ") for entry in RAW_SCHEMAS[alias].split(",")]
    present = [(name, kind) for name, kind in fields if name in raw.columns]
    return raw.select(
        *[
            (to_timestamp_or_null(n) if k == "timestamp" else F.col(n).try_cast(k)).alias(n)
            for n, k in present
        ]
    )


def read_raw_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {alias: read_raw_table(spark, directory, alias) for alias in RAW_FILES}


def register_views(tables: dict[str, DataFrame], prefix: str = "raw_") -> None:
    for alias, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{alias}")
