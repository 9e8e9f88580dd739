"""Adapter from the generated star-schema parquet to the raw relational tables.

The generated tables have no reviews, payments or delivery dates and no nulls;
all three are derived from their keys and dates with integer arithmetic, so that
the same rows can be written in any SQL dialect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmood.config import SplitCalendar

FIXTURE_CALENDAR = SplitCalendar(
    train_end="1999-12",
    val=("2000-01", "2000-02", "2000-03", "2000-04", "2000-05", "2000-06"),
    backtest=("2000-07", "2000-08", "2000-09", "2000-10", "2000-11", "2000-12"),
    live=("2001-01", "2001-02", "2001-03", "2001-04", "2001-05"),
    predict=("2001-06",),
)


# Schemas of the generated tables in use.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Parquet scan with zone-less timestamps as session (UTC) timestamps."""
    frame = spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")
    zoneless = {n: F.col(n).cast("timestamp") for n, t in frame.dtypes if t == "timestamp_ntz"}
    return frame.withColumns(zoneless) if zoneless else frame


def _keep_unless(key: str, divisor: int, value: Column) -> Column:
    return F.when(F.col(key) % divisor != 0, value)


def _add(base: Column, days: Column | int = 0, seconds: Column | int = 0) -> Column:
    return base + F.make_dt_interval(days=F.lit(days), secs=F.lit(seconds))


def _dated_orders(spark: SparkSession, directory: str) -> DataFrame:
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    # the low digits of the price are as good as random and need no other table
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    noon = 43_200
    bought = _add(day, seconds=key * 7919 % 86_400)
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    to_carrier = _add(day, (F.floor(cents / 45) % 10).cast("int"), noon)
    to_customer = _add(day, (cents % 45).cast("int"), noon)
    return read_table(spark, directory, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", "shipped").otherwise("delivered").alias(
            "order_status"
        ),
        bought.alias("order_purchase_timestamp"),
        _keep_unless("o_orderkey", 71, _add(bought, seconds=key % 48 * 3600)).alias(
            "order_approved_at"
        ),
        _keep_unless("o_orderkey", 53, to_carrier).alias("order_delivered_carrier_date"),
        _keep_unless("o_orderkey", 59, to_customer).alias("order_delivered_customer_date"),
        _add(day, 20 + 3 * priority).alias("order_estimated_delivery_date"),
    )


def _reviews(orders: DataFrame) -> DataFrame:
    late = F.col("order_delivered_customer_date") >= _add(
        F.col("order_estimated_delivery_date"), days=1
    )
    u = F.col("order_id") * 7919 % 100

    def stars(ones: int, twos: int, threes: int, fours: int) -> Column:
        return F.when(u < ones, 1).when(u < twos, 2).when(u < threes, 3).when(u < fours, 4).otherwise(5)

    first = orders.select(
        "order_id",
        F.when(late, stars(45, 60, 72, 85)).otherwise(stars(8, 11, 18, 40)).alias("review_score"),
        F.when(u % 3 != 0, F.concat(F.lit("comment "), u.cast("string"))).alias(
            "review_comment_message"
        ),
    )
    # every 101st order has a second review, one star apart
    copies = F.when(F.col("order_id") % 101 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return first.withColumn("copy", F.explode(copies)).select(
        (F.col("order_id") * 10 + F.col("copy")).alias("review_id"),
        "order_id",
        F.when(F.col("copy") == 1, F.col("review_score"))
        .otherwise(F.col("review_score") % 5 + 1)
        .alias("review_score"),
        "review_comment_message",
        F.lit(None).cast("timestamp").alias("review_creation_date"),
    )


def fixture_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    nation = read_table(spark, directory, "nation").select("n_nationkey", "n_name")
    orders = _dated_orders(spark, directory)
    raw_orders = read_table(spark, directory, "orders")
    key = F.col("o_orderkey")
    payments = raw_orders.select(
        key.alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.element_at(
            F.array(*[F.lit(t) for t in ("credit_card", "boleto", "voucher", "debit_card")]),
            (key % 4 + 1).cast("int"),
        ).alias("payment_type"),
        _keep_unless("o_orderkey", 89, (key % 10 + 1).cast("int")).alias("payment_installments"),
        _keep_unless("o_orderkey", 97, F.col("o_totalprice")).alias("payment_value"),
    )
    items = read_table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        # exact decimal product, so that half cents round alike everywhere
        F.round(
            F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)"), 2
        )
        .cast("double")
        .alias("freight_value"),
    )
    part = read_table(spark, directory, "part")
    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        (F.col("p_size") * 150.0).alias("product_weight_g"),
        _keep_unless("p_partkey", 53, (F.col("p_partkey") % 6 + 1).cast("double")).alias(
            "product_photos_qty"
        ),
        (F.col("p_size") + 10).alias("product_length_cm"),
        (F.col("p_size") % 7 + 2).alias("product_height_cm"),
        (F.col("p_size") % 11 + 5).alias("product_width_cm"),
    )
    category = (
        part.select(F.col("p_type").alias("product_category_name"))
        .where(F.col("product_category_name") != "PROMO")
        .distinct()
        .withColumn("product_category_name_english", F.lower("product_category_name"))
    )
    customers = (
        read_table(spark, directory, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_custkey") % 1000).cast("int").alias("customer_zip_code_prefix"),
            _keep_unless("c_custkey", 61, F.col("n_name")).alias("customer_state"),
        )
    )
    sellers = (
        read_table(spark, directory, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("seller_id"),
            _keep_unless("s_suppkey", 61, F.col("n_name")).alias("seller_state"),
        )
    )
    return {
        "orders": orders,
        "reviews": _reviews(orders),
        "items": items,
        "payments": payments,
        "customers": customers,
        "products": products,
        "sellers": sellers,
        "category": category,
    }
