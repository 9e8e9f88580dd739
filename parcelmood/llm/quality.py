"""Quality classifier (4): hierarchical empirical Bayes.

The evidence of a document is the log likelihood ratio of a logistic regression on how its text looks. Its prior is
the quality rate of where it comes from: rates of hosts are drawn towards the global rate, rates of paths towards
their host's, the more strongly the fewer labels they have. How strongly, the labels say themselves: the spread of
the rates beyond what their sizes explain gives the weight of the prior at each level (a beta-binomial moment
estimate). Labels meet sites in grouped sums, which are combined before their shuffle, so a host with a third of all
rows costs one row a task. Scoring is a projection and a join with the site rates; texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import BLANKS, query, stored, table

#: Labelled documents that the regression is fitted on, about (chosen by the hash of their id). Rates use all.
FIT_DOCS = 20_000
THRESHOLD = 0.5
#: Rows of site rates up to which the join sends them to every executor.
BROADCAST_SITES = 200_000
#: Bounds of the weight of a prior, in labels.
WEIGHTS = (1.0, 10_000.0)


def _features(text: Column) -> dict[str, Column]:
    """Densities on a log scale; all 0 for a text without words."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.char_length(t), F.lit(1))
    words = F.split(t, f"[{BLANKS}]+")
    lines = F.split(t, "\n")

    def share(pattern: str) -> Column:
        return F.log1p(100.0 * F.regexp_count(t, F.lit(pattern)) / chars)

    return {
        "capitals": share(r"\p{Lu}"),
        "signs": share(r"[!%$&*#|]"),
        "digits": share(r"[0-9]"),
        "doubled": F.log1p(100.0 * F.regexp_count(t, F.lit(r"(\S+)\s\1\s")) / chars),
        "new_words": F.size(F.array_distinct(words)) / F.size(words),
        "new_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "word_chars": F.log1p(chars / F.size(words)),
        "words": F.log1p(F.size(words)),
    }


FEATURES = ["capitals", "signs", "digits", "doubled", "new_words", "new_lines", "word_chars", "words"]


@dataclass
class QualityModel:
    """Weights of the evidence, and the tables of rates: hosts (host, host_rate), paths (host, path, path_rate)."""

    intercept: float
    weights: list[float]
    global_rate: float
    hosts: DataFrame
    paths: DataFrame
    sites: int


def _weight(groups: DataFrame, prior: Column) -> float:
    """How many labels a prior is worth, from groups (n, good) and the rate expected of each."""
    rate = F.col("good") / F.col("n")
    row = groups.select(
        F.col("n"), ((rate - prior) ** 2 * F.col("n")).alias("spread"), (prior * (1 - prior)).alias("noise")
    ).agg(
        F.sum("spread").alias("spread"), F.sum("noise").alias("noise"), F.sum(F.col("n") * F.col("noise")).alias("total"),
        F.count(F.lit(1)).alias("groups"),
    ).first()
    low, high = WEIGHTS
    # expected: spread = sum of p(1-p) * (1 + (n - 1) * rho), rho = 1 / (weight + 1)
    if not row.groups or row.total - row.noise <= 0 or row.spread - row.noise <= 0:
        return high
    rho = (row.spread - row.noise) / (row.total - row.noise)
    return min(max(1.0 / rho - 1.0, low), high)


def train(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> QualityModel:
    """Learn evidence and rates from rows (id, label); a document with several labels counts by their mean.

    Without labels of both kinds the evidence is nil; without any, all rates are one half.
    """
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label")).dropna()
        .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("good"))
    )
    places = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")
    )
    counts = stored(
        places.join(known, "doc_id").groupBy("host", "path").agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.sum("good").cast("double").alias("good")
        ), "label-counts",
    )
    whole = counts.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("sites")).first()
    n, good = whole.n or 0.0, whole.good or 0.0
    rate = (good + 1) / (n + 2)

    hosts = counts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    w = _weight(hosts, F.lit(rate))
    hosts = stored(hosts.select("host", ((F.col("good") + w * rate) / (F.col("n") + w)).alias("host_rate")), "hosts")
    joined = counts.join(hosts, "host")
    w = _weight(joined, F.col("host_rate"))
    paths = stored(
        joined.select("host", "path", ((F.col("good") + w * F.col("host_rate")) / (F.col("n") + w)).alias("path_rate")),
        "paths",
    )

    intercept, weights = 0.0, [0.0] * len(FEATURES)
    if 0 < good < n:
        one_in = max(1, int(n) // FIT_DOCS)
        some = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0)
        # about FIT_DOCS rows of an id and a number, a bound that does not grow with the input
        sample = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
            F.broadcast(some), "doc_id"
        )
        rows = stored(sample.select("good", *[c.alias(k) for k, c in _features(F.col("text")).items()]), "fit-rows")
        share = rows.agg(F.avg("good")).first()[0]
        if share is not None and 0 < share < 1:
            vectors = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows).select("x", "good")
            fitted = LogisticRegression(featuresCol="x", labelCol="good", regParam=1e-4, maxIter=60).fit(vectors)
            # a likelihood ratio: the margin without the prior of the rows that it was fitted on
            intercept = float(fitted.intercept) - _logit(share)
            weights = [float(x) for x in fitted.coefficients]
    return QualityModel(intercept, weights, rate, hosts, paths, int(whole.sites))


def _logit(p: float) -> float:
    import math

    return math.log(p / (1 - p))


def score(
    docs: DataFrame, model: QualityModel, host: Column, path: Column, text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows as ``row`` (a struct of all columns) with evidence, host_rate, path_rate, probability and kept.

    A null text counts as empty, a null host or path as the empty one. Sites without labels take the rate of the
    level above. Repeated rows are judged alike, each for itself; a probability equal to the threshold keeps.
    """
    values = _features(F.col(text_col))
    evidence = F.lit(model.intercept)
    for name, weight in zip(FEATURES, model.weights):
        evidence = evidence + F.lit(weight) * values[name]
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"), evidence.alias("evidence"),
    )
    hosts, paths = model.hosts, model.paths
    if model.sites <= BROADCAST_SITES:
        hosts, paths = F.broadcast(hosts), F.broadcast(paths)
    joined = rows.join(paths, ["host", "path"], "left").join(hosts, "host", "left")
    host_rate = F.coalesce("host_rate", F.lit(model.global_rate))
    path_rate = F.coalesce(F.col("path_rate"), host_rate)
    probability = 1 / (1 + F.exp(-(F.col("evidence") + F.log(path_rate / (1 - path_rate)))))
    return joined.select(
        "row", "evidence", host_rate.alias("host_rate"), path_rate.alias("path_rate"), probability.alias("probability")
    ).withColumn("kept", F.col("probability") >= threshold)


def source_and_language() -> tuple[Column, Column]:
    """The site levels of ``documents``: the source is the host, the language the path below it."""
    return F.col("source"), F.col("lang")


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier keeps, all columns as they were."""
    host, path = source_and_language()
    return score(docs, train(docs, labels, host, path), host, path).filter("kept").select("row.*")


@query("op4_quality_classifier")
def op4_quality_classifier(spark, directory):
    docs = table(spark, directory, "documents")
    host, path = source_and_language()
    model = train(docs, table(spark, directory, "labels"), host, path)
    return score(docs, model, host, path).select(
        "row.doc_id", "evidence", "host_rate", "path_rate", "probability", "kept"
    )
