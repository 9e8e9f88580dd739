"""Order-grain master table: pre-aggregated one-to-many sides and a star join.

No join here carries a broadcast hint: a small dimension is broadcast by its
size estimate, a large one is joined by a shuffle in which AQE splits hot keys.
A null key matches nothing (SQL semantics).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_value(value: str, order: Sequence[str]) -> Column:
    """First non-null value by a total order, whatever the order of the input."""
    position = F.struct(*[F.col(c) for c in order])
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), position))


def sum_or_zero(value: str) -> Column:
    """Money sum; 0 when all values are null.

    Rounded to 6 places, so that the order of addition leaves no trace.
    """
    return F.coalesce(F.round(F.sum(value), 6), F.lit(0.0))


def translate_categories(products: DataFrame, category: DataFrame) -> DataFrame:
    return products.join(category, "product_category_name", "left")


def aggregate_items(items: DataFrame) -> DataFrame:
    order = ["order_item_id", "product_id", "seller_id"]
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("order_item_count"),
        sum_or_zero("price").alias("total_price"),
        sum_or_zero("freight_value").alias("total_freight_value"),
        first_value("product_id", order).alias("product_id"),
        first_value("seller_id", order).alias("seller_id"),
    )


def attach_products(
    items_per_order: DataFrame, products: DataFrame, dimensions: bool = False
) -> DataFrame:
    """Attributes of the order's first product; optionally its size in cm."""
    wanted = ["product_id", "product_category_name_english", "product_weight_g",
              "product_photos_qty"]
    if dimensions:
        wanted += ["product_width_cm", "product_height_cm", "product_length_cm"]
    return items_per_order.join(products.select(*wanted), "product_id", "left")


def aggregate_payments(payments: DataFrame) -> DataFrame:
    order = ["payment_sequential", "payment_type"]
    return payments.groupBy("order_id").agg(
        sum_or_zero("payment_value").alias("payment_value"),
        F.max("payment_installments").alias("payment_installments"),
        first_value("payment_type", order).alias("payment_type"),
    )


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """One review per order: the newest, ties by the larger id."""
    newest = F.max_by(
        F.struct(*reviews.columns), F.struct("review_creation_date", "review_id")
    ).alias("review")
    return reviews.groupBy("order_id").agg(newest).select("review.*")


def join_reviews(
    orders: DataFrame,
    reviews: DataFrame,
    keep: Sequence[str] = (),
    latest_review_only: bool = False,
) -> DataFrame:
    """Orders with their reviews; an order with two reviews gives two rows."""
    source = latest_reviews(reviews) if latest_review_only else reviews
    return orders.join(
        source.select("order_id", *keep, "review_score", "review_comment_message"), "order_id"
    )


def build_master(
    tables: dict[str, DataFrame],
    review_columns: Sequence[str] = (),
    latest_review_only: bool = False,
    dimensions: bool = False,
    require_review: bool = True,
) -> DataFrame:
    """Star join to one row per reviewed order.

    ``review_columns`` carries more review columns along, for instance the id
    that tells two reviews of one order apart.  ``require_review=False`` keeps
    orders that wait for their first review, to score them.
    """
    products = translate_categories(tables["products"], tables["category"])
    items = attach_products(aggregate_items(tables["items"]), products, dimensions)
    payments = aggregate_payments(tables["payments"])
    customers = tables["customers"].select(
        "customer_id", "customer_state", "customer_zip_code_prefix"
    )
    sellers = tables["sellers"].select("seller_id", "seller_state")
    if require_review:
        reviewed = join_reviews(
            tables["orders"], tables["reviews"], review_columns, latest_review_only
        )
    else:
        source = latest_reviews(tables["reviews"]) if latest_review_only else tables["reviews"]
        reviewed = tables["orders"].join(
            source.select(
                "order_id", *review_columns, "review_score", "review_comment_message"
            ),
            "order_id",
            "left",
        )
    return (
        reviewed.join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(customers, "customer_id", "left")
        .join(sellers, "seller_id", "left")
    )
