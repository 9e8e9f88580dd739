"""Queries for cleaning, feature strength and the model-free selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.checks.base import features_of, query, rounded, stored_features
from parcelmood.functions.histograms import auc_by
from parcelmood.functions.scalars import half_even
from parcelmood.operators import selection as select
from parcelmood.operators import strength
from parcelmood.operators.cleaning import (
    OrderCleaner,
    category_shares,
    cleaning_report,
    clip_and_fill_values,
    frequent_categories,
    frequent_members,
)
from parcelmood.operators.encoding import target_encoding
from parcelmood.operators.split import rows_of_split
from parcelmood.sources.storage import store_table

ROW = ["order_id", "review_id"]
MEASURED = C.NUMERIC + C.BINARY


def _listed(names) -> str:
    return ", ".join(names)


def _positions(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


# Training statistics in SQL; quantile positions in integer arithmetic.
STATS = f""", num_long AS (
  SELECT * FROM (
    SELECT order_id, review_id, dataset_split, is_satisfied,
      {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in C.NUMERIC)} FROM feat)
  UNPIVOT INCLUDE NULLS (value FOR feature IN ({_listed(C.NUMERIC)}))),
bounds AS (
  SELECT feature, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi,
    quantile_cont(value, 0.5) AS mid
  FROM num_long WHERE dataset_split = 'train' AND value IS NOT NULL GROUP BY feature),
clean_num AS (
  SELECT order_id, review_id, dataset_split, is_satisfied, l.feature,
    CASE WHEN value IS NULL THEN mid ELSE least(greatest(value, lo), hi) END AS value
  FROM num_long l JOIN bounds b ON l.feature = b.feature),
clean_bin AS (
  SELECT * FROM (SELECT order_id, review_id, dataset_split, is_satisfied,
      {", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in C.BINARY)} FROM feat)
  UNPIVOT (value FOR feature IN ({_listed(C.BINARY)}))),
cat_long AS (
  SELECT * FROM (SELECT order_id, review_id, dataset_split, is_satisfied,
      {", ".join(f"coalesce({c}, 'nan') AS {c}" for c in C.CATEGORICAL)} FROM feat)
  UNPIVOT (category FOR feature IN ({_listed(C.CATEGORICAL)}))),
shares AS (
  SELECT feature, category, count(*) AS n,
    count(*) / sum(count(*)) OVER (PARTITION BY feature) AS share
  FROM cat_long WHERE dataset_split = 'train' GROUP BY feature, category),
frequent AS (SELECT * FROM shares WHERE share >= 0.01),
clean_long AS (SELECT * FROM clean_num UNION ALL SELECT * FROM clean_bin),
train_long AS (SELECT * FROM clean_long WHERE dataset_split = 'train'),
ranks AS (
  SELECT feature, value, is_satisfied AS y,
    row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS pos,
    rank() OVER (PARTITION BY feature ORDER BY value)
      + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS mid_rank,
    count(*) OVER (PARTITION BY feature) AS n
  FROM train_long),
gini AS (
  SELECT feature, abs(2 * ((sum(mid_rank) FILTER (WHERE y = 1)
      - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))) - 1) AS gini
  FROM ranks GROUP BY feature HAVING count(DISTINCT value) > 1
  UNION ALL
  SELECT feature, 0 FROM ranks GROUP BY feature HAVING count(DISTINCT value) = 1),
edges AS (
  SELECT feature, i,
    max(value) FILTER (WHERE pos = (i * (n - 1)) // 10)
    + (max(value) FILTER (WHERE pos = least((i * (n - 1)) // 10 + 1, n - 1))
       - max(value) FILTER (WHERE pos = (i * (n - 1)) // 10))
      * (max((i * (n - 1)) % 10) / 10.0) AS edge
  FROM ranks, range(11) t(i) GROUP BY feature, i),
edge_lists AS (
  SELECT feature, list_sort(list_distinct(list(edge))) AS edges FROM edges GROUP BY feature),
inner_edges AS (
  SELECT feature, edges, edges[2:-2] AS inner_list FROM edge_lists),
levels AS (SELECT feature, count(DISTINCT value) AS n_values FROM train_long GROUP BY feature),
buckets AS (
  SELECT t.feature, value, is_satisfied AS y,
    CASE WHEN n_values <= 10 THEN value
      ELSE len(list_filter(inner_list, lambda e: e < value)) END AS bucket
  FROM train_long t JOIN inner_edges e ON t.feature = e.feature
    JOIN levels l ON t.feature = l.feature),
woe AS (
  SELECT feature, bucket, min(value) AS desde, max(value) AS hasta,
    CAST(sum(y) AS BIGINT) AS buenos, CAST(sum(1 - y) AS BIGINT) AS malos,
    sum(y) / sum(sum(y)) OVER (PARTITION BY feature) AS pb,
    sum(1 - y) / sum(sum(1 - y)) OVER (PARTITION BY feature) AS pm
  FROM buckets GROUP BY feature, bucket),
iv AS (
  SELECT feature, CASE WHEN count(*) > 1 THEN
    sum((pb - pm) * ln((pb + 1e-6) / (pm + 1e-6))) ELSE 0 END AS iv
  FROM woe GROUP BY feature),
psi_bins AS (
  SELECT c.feature, dataset_split,
    len(list_filter(inner_list, lambda e: e <= value)) AS bin, len(edges) AS n_edges
  FROM clean_num c JOIN inner_edges e ON c.feature = e.feature
  WHERE dataset_split IN ('train', 'val')),
psi_counts AS (
  SELECT feature, bin, max(n_edges) AS n_edges,
    count(*) FILTER (WHERE dataset_split = 'train') AS e,
    count(*) FILTER (WHERE dataset_split = 'val') AS o
  FROM psi_bins GROUP BY feature, bin),
psi_shares AS (
  SELECT feature, n_edges, greatest(e / sum(e) OVER (PARTITION BY feature), 1e-6) AS e,
    greatest(o / sum(o) OVER (PARTITION BY feature), 1e-6) AS o
  FROM psi_counts),
psi AS (
  SELECT feature, CASE WHEN max(n_edges) >= 3 THEN sum((o - e) * ln(o / e)) ELSE 0 END AS psi
  FROM psi_shares GROUP BY feature),
corrs AS (
  SELECT a.feature AS fila, b.feature AS columna, abs(corr(a.value, b.value)) AS corr
  FROM clean_num a JOIN clean_num b
    ON a.order_id = b.order_id AND a.review_id = b.review_id
    AND list_position({_positions(C.NUMERIC)}, a.feature)
      < list_position({_positions(C.NUMERIC)}, b.feature)
  WHERE a.dataset_split = 'train' GROUP BY a.feature, b.feature),
gaps AS (
  SELECT feature, round_even((avg(is_satisfied) FILTER (WHERE value = 1)
    - avg(is_satisfied) FILTER (WHERE value = 0)) * 100, 1) AS gap
  FROM clean_bin WHERE dataset_split = 'train' GROUP BY feature)"""


def clean_splits(spark, directory):
    """(clean train, clean val) of the fixture, stored: every statistic scans them."""
    frame = stored_features(spark, directory, ["train", "val"], [*ROW, C.TARGET, *C.CANDIDATES])
    model = OrderCleaner().fit(rows_of_split(frame, "train"))
    cleaned = store_table(model.transform(frame), "clean", [C.SPLIT])
    return rows_of_split(cleaned, "train"), rows_of_split(cleaned, "val")


# ---- cleaning -----------------------------------------------------------------

@query("missing_ratio", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round_even(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 4) AS missing FROM feat WHERE dataset_split = 'train'"
    for c in C.CANDIDATES))
def missing_ratio(spark, directory):
    train = rows_of_split(features_of(spark, directory), "train")
    return select.missing_ratio(train).withColumn("missing", half_even(F.col("missing"), 4))


@query("clip_bounds", f"""{STATS}
SELECT feature, round_even(lo, 4) AS clip_low, round_even(hi, 4) AS clip_high FROM bounds""")
def clip_bounds(spark, directory):
    train = stored_features(spark, directory, ["train"], C.NUMERIC)
    return clip_and_fill_values(train).select("feature", rounded("clip_low"), rounded("clip_high"))


@query("impute_medians", f"{STATS} SELECT feature, round_even(mid, 4) AS median FROM bounds")
def impute_medians(spark, directory):
    train = stored_features(spark, directory, ["train"], C.NUMERIC)
    return clip_and_fill_values(train).select("feature", rounded("median"))


@query("frequent_categories", f"""{STATS}
SELECT feature, category, n, round_even(share, 6) AS share FROM frequent""")
def frequent(spark, directory):
    train = rows_of_split(features_of(spark, directory), "train")
    return frequent_categories(train).withColumn("share", half_even(F.col("share"), 6))


@query("category_shares", f"""{STATS}
SELECT feature, category, n, round_even(share, 6) AS share FROM shares""")
def shares(spark, directory):
    train = rows_of_split(features_of(spark, directory), "train")
    return category_shares(train).withColumn("share", half_even(F.col("share"), 6))


@query("frequent_category_members", f"""{STATS}
SELECT order_id, review_id, c.feature, c.category FROM cat_long c
WHERE (c.feature, c.category) IN (SELECT (feature, category) FROM frequent)""")
def frequent_category_members(spark, directory):
    frame = stored_features(spark, directory)
    kept = frequent_categories(rows_of_split(frame, "train"))
    return frequent_members(frame, kept, C.CATEGORICAL, ROW)


@query("cleaning_report", f"""{STATS}
SELECT feature AS variable, 'numérica' AS tipo, round_even(lo, 3) AS clip_low,
  round_even(hi, 3) AS clip_high, round_even(mid, 3) AS fill_value,
  CAST(NULL AS BIGINT) AS n_categorias_frecuentes FROM bounds
UNION ALL
SELECT feature, 'categórica', NULL, NULL, NULL, count(*) FROM frequent GROUP BY feature""")
def report_of_cleaning(spark, directory):
    train = stored_features(spark, directory, ["train"], C.NUMERIC + C.CATEGORICAL)
    return cleaning_report(clip_and_fill_values(train), frequent_categories(train))


_SIX = {"freight_ratio", "price_per_item"}


@query("clean_transform", f"""{STATS}, wide AS (
  SELECT order_id, review_id, dataset_split,
    {", ".join(f"max(value) FILTER (WHERE feature = '{c}') AS {c}" for c in C.NUMERIC)}
  FROM clean_num GROUP BY order_id, review_id, dataset_split),
cats AS (
  SELECT order_id, review_id, {", ".join(
    f"max(CASE WHEN c.feature = '{c}' THEN coalesce(f.category, 'OTHER') END) AS {c}"
    for c in C.CATEGORICAL)}
  FROM cat_long c LEFT JOIN frequent f ON c.feature = f.feature AND c.category = f.category
  GROUP BY order_id, review_id)
SELECT w.order_id, w.review_id, w.dataset_split,
  {", ".join(f"round_even(w.{c}, 6) AS {c}" for c in C.NUMERIC)},
  {", ".join(f"f.{c}" for c in C.BINARY)}, {", ".join(f"c.{c}" for c in C.CATEGORICAL)}
FROM wide w JOIN cats c ON w.order_id = c.order_id AND w.review_id = c.review_id
  JOIN feat f ON w.order_id = f.order_id AND w.review_id = f.review_id""")
def clean_transform(spark, directory):
    frame = stored_features(spark, directory)
    model = OrderCleaner().fit(rows_of_split(frame, "train"))
    return model.transform(frame).select(
        *ROW, C.SPLIT, *[rounded(c, 6) for c in C.NUMERIC], *C.BINARY, *C.CATEGORICAL
    )


# ---- strength of single features ---------------------------------------------

@query("roc_auc", """, ranked AS (
  SELECT dataset_split, is_satisfied AS y,
    rank() OVER (PARTITION BY dataset_split ORDER BY -delivery_delay_days)
      + (count(*) OVER (PARTITION BY dataset_split, delivery_delay_days) - 1) / 2.0 AS r
  FROM feat), areas AS (
  SELECT dataset_split, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg,
    (sum(r) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc
  FROM ranked GROUP BY dataset_split)
SELECT dataset_split, pos, neg, round_even(auc, 6) AS auc, round_even(2 * auc - 1, 6) AS gini
FROM areas""")
def roc_auc(spark, directory):
    """ROC area and Gini of the negated delay, per partition."""
    frame = features_of(spark, directory).withColumn("score", -F.col("delivery_delay_days"))
    areas = auc_by(frame, [C.SPLIT], "score", C.TARGET)
    return areas.select(
        C.SPLIT, "pos", "neg", half_even(F.col("auc"), 6).alias("auc"),
        half_even(2 * F.col("auc") - 1, 6).alias("gini"),
    )


@query("univariate_gini", f"{STATS} SELECT feature, round_even(gini, 4) AS gini FROM gini")
def univariate_gini(spark, directory):
    train, _ = clean_splits(spark, directory)
    values = strength.feature_values(train, MEASURED)
    return strength.univariate_gini(values).withColumn("gini", half_even(F.col("gini"), 4))


@query("woe_table", f"""{STATS}
SELECT feature, round_even(desde, 4) AS desde, round_even(hasta, 4) AS hasta, buenos, malos,
  round_even(pb, 6) AS pct_buenos, round_even(pm, 6) AS pct_malos,
  round_even(ln((pb + 1e-6) / (pm + 1e-6)), 4) AS woe FROM woe""")
def woe_table(spark, directory):
    train, _ = clean_splits(spark, directory)
    return strength.woe_table(strength.feature_values(train, MEASURED)).select(
        "feature", rounded("desde"), rounded("hasta"), "buenos", "malos",
        rounded("pct_buenos", 6), rounded("pct_malos", 6), rounded("woe"),
    )


@query("information_value", f"{STATS} SELECT feature, round_even(iv, 4) AS iv FROM iv")
def information_value(spark, directory):
    train, _ = clean_splits(spark, directory)
    woe = strength.woe_table(strength.feature_values(train, MEASURED))
    return strength.information_value(woe).withColumn("iv", half_even(F.col("iv"), 4))


@query("iv_table", f"""{STATS}, shown AS (
  SELECT feature AS variable, round_even(iv, 4) AS information_value FROM iv)
SELECT *, CASE WHEN information_value < 0.02 THEN 'sin poder'
  WHEN information_value < 0.1 THEN 'débil' WHEN information_value < 0.3 THEN 'medio'
  WHEN information_value < 0.5 THEN 'fuerte' ELSE 'sospechoso (revisar fuga)' END AS fuerza
FROM shown""")
def iv_ranking(spark, directory):
    train, _ = clean_splits(spark, directory)
    woe = strength.woe_table(strength.feature_values(train, MEASURED))
    return strength.iv_table(strength.information_value(woe))


@query("flag_gap", f"{STATS} SELECT feature, gap AS gap_satisfaccion_pp FROM gaps")
def flag_gap(spark, directory):
    train, _ = clean_splits(spark, directory)
    return strength.flag_gap(train)


_FAMILY_SQL = " ".join(
    f"WHEN l.feature IN ({', '.join(repr(m) for m in members)}) THEN '{family}'"
    for family, members in C.FAMILIES.items()
)
_EVIDENCE = f"""{STATS}, listed AS (SELECT unnest({_positions(C.CANDIDATES)}) AS feature),
evidence AS (
  SELECT CASE {_FAMILY_SQL} ELSE '{C.OTHER_FAMILY}' END AS familia, l.feature AS variable,
    round_even(gini, 4) AS gini_univariante, round_even(iv, 4) AS information_value,
    gap AS gap_satisfaccion_pp
  FROM listed l LEFT JOIN gini g ON l.feature = g.feature
    LEFT JOIN iv ON l.feature = iv.feature LEFT JOIN gaps ON l.feature = gaps.feature)"""


@query("feature_evidence", f"{_EVIDENCE} SELECT * FROM evidence")
def feature_evidence(spark, directory):
    train, _ = clean_splits(spark, directory)
    return strength.feature_evidence(train)


@query("family_champion", f"""{_EVIDENCE}
SELECT familia, variable, gini_univariante, information_value FROM evidence
WHERE gini_univariante IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY familia ORDER BY gini_univariante DESC, variable) = 1""")
def family_champion(spark, directory):
    train, _ = clean_splits(spark, directory)
    return strength.family_champions(strength.feature_evidence(train))


# ---- stability, redundancy, selection -----------------------------------------

@query("psi", f"{STATS} SELECT feature, round_even(psi, 6) AS psi FROM psi")
def psi(spark, directory):
    train, val = clean_splits(spark, directory)
    return select.stability_index(train, val).withColumn("psi", half_even(F.col("psi"), 6))


@query("correlation_pairs", f"""{STATS}
SELECT fila, columna, round_even(corr, 6) AS corr FROM corrs""")
def correlation_pairs(spark, directory):
    train, _ = clean_splits(spark, directory)
    return select.correlation_pairs(train).withColumn("corr", half_even(F.col("corr"), 6))


@query("correlation_drop", f"""{STATS}
SELECT DISTINCT CASE WHEN c.gini <= r.gini THEN columna ELSE fila END AS feature
FROM corrs JOIN gini r ON fila = r.feature JOIN gini c ON columna = c.feature
WHERE corr > 0.95""")
def correlation_drop(spark, directory):
    train, _ = clean_splits(spark, directory)
    ginis = strength.univariate_gini(strength.feature_values(train, C.NUMERIC))
    return select.redundant_features(select.correlation_pairs(train), ginis)


_SURVIVORS = f"""{STATS}, listed AS (SELECT unnest({_positions(C.CANDIDATES)}) AS feature),
unstable AS (SELECT feature FROM psi WHERE psi > 0.25),
redundant AS (
  SELECT DISTINCT CASE WHEN c.gini <= r.gini THEN columna ELSE fila END AS feature
  FROM corrs JOIN gini r ON fila = r.feature JOIN gini c ON columna = c.feature
  WHERE corr > 0.95 AND fila NOT IN (FROM unstable) AND columna NOT IN (FROM unstable)),
steps AS (
  SELECT feature, CASE WHEN feature IN (FROM unstable) THEN 2
    WHEN feature IN (FROM redundant) THEN 3
    WHEN feature IN (SELECT feature FROM gini WHERE gini < 0.05) THEN 4 END AS dropped_at
  FROM listed)"""


@query("selection_steps", f"{_SURVIVORS} SELECT feature, dropped_at FROM steps")
def selection_steps(spark, directory):
    train, val = clean_splits(spark, directory)
    return select.selection_steps(train, val).select("feature", "dropped_at")


@query("selection_survivors", f"{_SURVIVORS} SELECT feature FROM steps WHERE dropped_at IS NULL")
def selection_survivors(spark, directory):
    train, val = clean_splits(spark, directory)
    return select.survivors(select.selection_steps(train, val)).select("feature")


@query("threshold_survivors", f"""{_SURVIVORS}
SELECT umbral AS umbral_univariante, count(*) FILTER (WHERE coalesce(dropped_at, 4) = 4
  AND coalesce(g.gini, 1) >= umbral) AS n_features
FROM steps s LEFT JOIN gini g ON s.feature = g.feature,
  (SELECT unnest([0.05, 0.10, 0.20, 0.30])::DOUBLE AS umbral) GROUP BY umbral""")
def threshold_survivors(spark, directory):
    """Candidates left at each Gini threshold; earlier steps are shared."""
    train, val = clean_splits(spark, directory)
    steps = select.selection_steps(train, val)
    reached = F.coalesce("dropped_at", F.lit(4)) == 4
    strong = F.coalesce("gini", F.lit(1.0))
    thresholds = F.array(*[F.lit(t) for t in C.GINI_SWEEP])
    return (
        steps.withColumn("umbral_univariante", F.explode(thresholds))
        .groupBy("umbral_univariante")
        .agg(F.count_if(reached & (strong >= F.col("umbral_univariante"))).alias("n_features"))
    )


# ---- encoding -----------------------------------------------------------------

@query("target_encoding", """, means AS (
  SELECT coalesce(product_category_name_english, 'nan') AS category, avg(is_satisfied) AS te
  FROM feat WHERE dataset_split = 'train' GROUP BY 1)
SELECT order_id, review_id, round_even(coalesce(te,
  (SELECT avg(is_satisfied) FROM feat WHERE dataset_split = 'train')), 6)
    AS te_product_category_name_english
FROM feat LEFT JOIN means ON category = coalesce(product_category_name_english, 'nan')""")
def encode_target(spark, directory):
    frame = stored_features(spark, directory)
    encoded = target_encoding(
        rows_of_split(frame, "train"), frame, "product_category_name_english"
    )
    return encoded.select(*ROW, rounded("te_product_category_name_english", 6))
