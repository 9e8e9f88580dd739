"""Formulas on small hand-computed frames."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row

from parcelmood import config as C
from parcelmood.operators import features as feat
from parcelmood.operators import master as star
from parcelmood.operators.split import assign_split

NOON = datetime(2018, 1, 10, 12)
DATES = (
    "order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
    "order_estimated_delivery_date timestamp"
)


def test_days_are_floored(spark):
    def row(hours):
        arrived = None if hours is None else NOON + timedelta(hours=hours)
        return (NOON, NOON + timedelta(minutes=90), None, arrived, NOON)

    frame = spark.createDataFrame([row(h) for h in (-30, -6, 0, 6, 24, None)], DATES)
    found = feat.delivery_flags(feat.time_features(frame)).collect()
    assert [r.delivery_delay_days for r in found] == [-2, -1, 0, 0, 1, None]
    assert [r.is_late for r in found] == [0, 0, 0, 0, 1, 0]
    assert [r.delivered_on_time for r in found] == [1, 1, 1, 1, 0, 0]
    assert {r.approval_time_hours for r in found} == {1.5}
    assert {r.handling_days for r in found} == {None}


def test_value_features(spark):
    frame = spark.createDataFrame(
        [(2, 10.0, 5.0, "7.5"), (None, None, None, "bad"), (0, 3.0, None, None)],
        "order_item_count long, total_price double, total_freight_value double, "
        "payment_value string",
    )
    a, b, c = feat.order_value_features(frame).collect()
    assert (a.order_total_value, a.price_per_item, a.is_multi_item) == (15.0, 5.0, 1)
    assert a.freight_ratio == pytest.approx(1 / 3)
    assert (b.order_item_count, b.order_total_value, b.freight_ratio) == (0, 0.0, None)
    assert (a.payment_value, b.payment_value) == (7.5, None)
    assert (c.order_total_value, c.price_per_item, c.freight_ratio) == (3.0, None, None)


def test_missing_inputs_are_null(spark):
    frame = spark.createDataFrame([(1,)], "order_id int")
    assert feat.payment_features(frame).first().payment_installments == 1
    assert feat.product_features(frame).first().is_heavy_item == 0


def test_two_unknown_states_are_the_same(spark):
    frame = spark.createDataFrame(
        [(NOON, None, None), (NOON, "SP", None), (NOON, "SP", "SP")],
        "order_purchase_timestamp timestamp, customer_state string, seller_state string",
    )
    found = feat.calendar_features(frame).collect()
    assert [r.same_state_seller for r in found] == [1, 0, 1]
    assert found[0].purchase_dow == 2 and found[0].purchase_is_weekend == 0


def test_ordinal_target(spark):
    scores = spark.createDataFrame([(s,) for s in range(1, 6)], "review_score int")
    graded = feat.ordinal_target(scores).collect()
    assert [r.satisfaction_class for r in graded] == [0, 0, 1, 2, 2]
    with pytest.raises(PySparkException):
        feat.ordinal_target(spark.createDataFrame([(0,)], "review_score int")).collect()


def test_panel_features(spark):
    frame = spark.createDataFrame(
        [(5, 10, 2, 100.0, 1, 0.5), (-3, 0, 1, None, 0, 0.1), (90, 10, 1, -4.0, 1, None)],
        "delivery_delay_days int, estimated_delivery_days int, order_item_count int, "
        "payment_value double, is_late int, freight_ratio double",
    ).selectExpr("*", "1 AS handling_days", "4 AS actual_delivery_days")
    a, b, c = feat.panel_features(frame).collect()
    assert (a.delay_ratio, b.delay_ratio, c.delay_ratio) == (0.5, 0.0, 3.0)
    assert (a.interaccion_retraso_items, b.interaccion_retraso_items) == (10, 0)
    assert b.log_payment_value is None and c.log_payment_value == 0.0
    assert (a.interaccion_entrega_flete, c.interaccion_entrega_flete) == (2.0, None)
    assert (a.product_volume_cm3, a.unique_sellers, a.dispatch_time_hours) == (0.0, 1, 24.0)


def test_varying_columns(spark):
    frame = spark.createDataFrame(
        [(1.0, 1, None, "x"), (2.0, 1, None, "x")],
        "delay_ratio double, unique_sellers int, total_price double, "
        "product_category_name_english string",
    )
    assert feat.varying_columns(frame) == ["delay_ratio", "product_category_name_english"]


def test_later_partition_wins(spark):
    calendar = C.SplitCalendar("2018-03", ("2018-03", "2018-04"), ("2018-04",), ("2018-05",), ())
    months = spark.createDataFrame(
        [("2017-01",), ("2018-03",), ("2018-04",), ("2018-05",), ("2018-06",), (None,)],
        "purchase_month string",
    )
    found = [r.dataset_split for r in assign_split(months, calendar).collect()]
    assert found == ["train", "val", "backtest", "live", "excluded", "excluded"]


def test_first_skips_nulls_and_sums_of_nulls_are_zero(spark):
    items = spark.createDataFrame(
        [("a", 2, "p2", "s2", 5.0, None), ("a", 1, None, "s1", 1.0, None)],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "price double, freight_value double",
    )
    row = star.aggregate_items(items).first()
    assert (row.product_id, row.seller_id) == ("p2", "s1")
    assert (row.order_item_count, row.total_price, row.total_freight_value) == (2, 6.0, 0.0)


def test_latest_review(spark):
    reviews = spark.createDataFrame(
        [
            Row(review_id="r1", order_id="a", review_score=1, review_creation_date=NOON),
            Row(review_id="r2", order_id="a", review_score=5,
                review_creation_date=NOON + timedelta(days=1)),
        ]
    )
    kept = star.latest_reviews(reviews).collect()
    assert [(r.review_id, r.review_score) for r in kept] == [("r2", 5)]
