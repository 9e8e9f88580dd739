"""Table, report, JSON-document and per-model result storage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.scalars import to_timestamp_or_null
from parcelmood.session import configure, scratch_path
from parcelmood.sources.catalog import ORDER_DATES


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_master(master: DataFrame, path: str) -> str:
    """Master table by purchase month, so month filters read only their folders."""
    month = F.date_format("order_purchase_timestamp", "yyyy-MM")
    (
        master.withColumn(C.MONTH, month)
        # few files for a small month, many for a large one: split by size while running
        .hint("rebalance", C.MONTH)
        .write.mode("overwrite")
        .partitionBy(C.MONTH)
        .parquet(path)
    )
    return path


def load_master(spark: SparkSession, path: str, text: bool = False) -> DataFrame:
    """Stored master; a text copy gets its dates parsed, bad dates become null."""
    if not text:
        return configure(spark).read.parquet(path)
    frame = spark.read.option("header", True).csv(path)
    dates = {c: to_timestamp_or_null(c) for c in ORDER_DATES if c in frame.columns}
    return frame.withColumns(dates)


def store_table(frame: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write to the shared folder and read back: columnar, pruned, short lineage."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.partitionBy(*partition_by).parquet(path)
    names = [c for c in frame.columns if c not in partition_by] + list(partition_by)
    return spark.read.schema(frame.select(*names).schema).parquet(path)


def build_or_reuse(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False
) -> DataFrame:
    """Stored master if there is one, else build, store and read it back."""
    if rebuild or not path_exists(spark, f"{path}/_SUCCESS"):
        save_master(build(), path)
    return load_master(spark, path)


def save_report(report: DataFrame, path: str) -> str:
    """Tabular report as CSV with a header."""
    report.write.mode("overwrite").option("header", True).csv(path)
    return path


def load_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def _constant(value: object) -> Column:
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value])
    return F.lit(value)


def metadata_columns(calendar: C.SplitCalendar, extra: dict[str, object] | None = None) -> list[Column]:
    """Columns that trace a run: version, time, seed, target, split months, extras."""
    values = {
        "pipeline_version": C.VERSION,
        "random_state": C.SEED,
        "target": C.TARGET,
        "train_end": calendar.train_end,
        "val_months": calendar.val,
        "backtest_months": calendar.backtest,
        "live_months": calendar.live,
        "prediction_months": calendar.predict,
        **(extra or {}),
    }
    started = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("run_timestamp")
    return [started, *[_constant(value).alias(name) for name, value in values.items()]]


def run_document(
    metrics: DataFrame, calendar: C.SplitCalendar, extra: dict[str, object] | None = None
) -> DataFrame:
    """Run metadata with every metrics row nested under ``metrics``."""
    return metrics.select(*metadata_columns(calendar, extra), F.struct("*").alias("metrics"))


def as_documents(rows: DataFrame, name: str = "document") -> DataFrame:
    """Every row as one JSON document; nested structs become nested objects."""
    return rows.select(F.to_json(F.struct("*")).alias(name))


def save_json(rows: DataFrame, path: str) -> str:
    rows.write.mode("overwrite").json(path)
    return path


def save_model_results(results: DataFrame, path: str) -> str:
    """Results of finished models, one folder per model; only theirs are replaced."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "modelo"
    ).parquet(path)
    return path


def pending_models(all_models: DataFrame, finished: DataFrame) -> DataFrame:
    """Models that have no stored result yet."""
    return all_models.select("modelo").join(finished.select("modelo"), "modelo", "left_anti")
