"""Column catalogs, thresholds and split calendars shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

VERSION = "0.2.0"
SEED = 42

TARGET = "is_satisfied"
TARGET_ORDINAL = "satisfaction_class"
TARGET_STRICT = "is_promoter"
SCORE = "review_score"
MONTH = "purchase_month"
SPLIT = "dataset_split"

# Population, target and business rules.
DELIVERED = "delivered"
SATISFIED_FROM = 4
PROMOTER_FROM = 5
HEAVY_GRAMS = 5000
EARLY_DAYS = -5
MIN_MONTH_ROWS = 100

# Cleaning and selection thresholds.
CLIP_LOW = (1, 100)
CLIP_HIGH = (99, 100)
MEDIAN = (1, 2)
RARE_SHARE = 0.01
RARE_LABEL = "OTHER"
MISSING_LABEL = "nan"
MAX_MISSING = 0.10
MAX_PSI = 0.25
MAX_CORRELATION = 0.95
MIN_GINI = 0.05
GINI_SWEEP = (0.05, 0.10, 0.20, 0.30)
STAT_BINS = 10
STAT_EPS = 1e-6
MIN_STAT_ROWS = 30
REVIEWED_FEATURES = ("has_comment",)
ABLATION_TOLERANCE = 0.005
LIFT_PERCENTS = (5, 10, 20)

# Model comparison.
STABILITY_PENALTY = 1.0
UNSTABLE_DROP = 0.05
IMPORTANCE_CAP = 0.15
DRIFT_BAND = 0.02
SEARCH_TRIALS = 100
# Labelled rows that one trial of the parameter search is fitted on, at most; scores use all rows.
SEARCH_SAMPLE = 15000
CV_FOLDS = 3
PERMUTATION_REPEATS = 5

# Feature catalog (column names are the data contract).
NUMERIC = (
    "delivery_delay_days", "actual_delivery_days", "estimated_delivery_days",
    "approval_time_hours", "handling_days",
    "order_item_count", "total_price", "total_freight_value",
    "order_total_value", "freight_ratio", "price_per_item",
    "payment_value", "payment_installments",
    "product_weight_g", "product_photos_qty",
    "purchase_dow", "purchase_month_num",
)
BINARY = (
    "delivered_on_time", "is_late", "delivered_early_5d",
    "is_multi_item", "is_installment", "is_heavy_item", "has_comment",
    "purchase_is_weekend", "same_state_seller",
)
CATEGORICAL = (
    "product_category_name_english", "payment_type",
    "customer_state", "seller_state",
)
CANDIDATES = NUMERIC + BINARY + CATEGORICAL

# Candidates of the model panel.
PANEL_CANDIDATES = (
    "interaccion_retraso_items", "delivery_delay_days", "delay_ratio",
    "order_item_count", "delivered_on_time", "actual_delivery_days",
    "interaccion_precio_tarde", "is_multi_item", "interaccion_entrega_flete",
    "dispatch_time_hours", "product_category_name_english", "purchase_dayofweek",
    "unique_sellers", "total_freight_value", "payment_installments",
    "promised_delivery_days", "freight_ratio", "product_width_cm",
    "product_height_cm", "product_length_cm", "log_payment_value",
    "product_volume_cm3", "total_price", "product_weight_g",
    "seller_customer_same_state",
)

# Feature families of the evidence report.
FAMILIES = {
    "A · Tiempos de entrega": (
        "delivery_delay_days", "actual_delivery_days", "estimated_delivery_days",
        "approval_time_hours", "handling_days",
    ),
    "B · Banderas de entrega": ("delivered_on_time", "is_late", "delivered_early_5d"),
    "C · Valor del pedido": (
        "total_price", "total_freight_value", "order_total_value", "freight_ratio",
        "price_per_item", "payment_value", "is_multi_item", "order_item_count",
    ),
    "D · Pago": ("payment_installments", "is_installment"),
    "E · Producto": ("product_weight_g", "product_photos_qty", "is_heavy_item"),
    "F · Señal de reseña": ("has_comment",),
    "G · Calendario y geografía": (
        "purchase_dow", "purchase_month_num", "purchase_is_weekend", "same_state_seller",
    ),
}
OTHER_FAMILY = "H · Categóricas (IV aparte)"

SPLIT_ORDER = ("train", "val", "backtest", "live", "predict", "excluded")


@dataclass(frozen=True)
class SplitCalendar:
    """Months of every temporal partition; the training part is open to the past."""

    train_end: str = "2018-03"
    val: tuple[str, ...] = ("2018-04",)
    backtest: tuple[str, ...] = ("2018-05", "2018-06", "2018-07")
    live: tuple[str, ...] = ("2018-08",)
    predict: tuple[str, ...] = ("2018-09",)


DEFAULT_CALENDAR = SplitCalendar()

# Decisions of the ablation table.
ABLATION_BASE_DECISION = "(referencia)"
ABLATION_KEEP = "aporta señal real -> se mantiene"
ABLATION_DROP = "prescindible -> candidata a salir"
