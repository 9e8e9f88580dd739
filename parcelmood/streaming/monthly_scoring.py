"""Score each newly arrived month with a frozen model, file by file, once."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmood.operators.features import build_features
from parcelmood.operators.modeling import score_new_data

BATCH = "batch"


def score_orders(model: Model, master: DataFrame) -> DataFrame:
    """Features and score of master rows; a missing review does not matter."""
    return score_new_data(model, build_features(master, require_label=False))


def score_arrivals(
    spark: SparkSession,
    source: str,
    schema: StructType,
    model: Model,
    output: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Score all files that arrived since the last call and append the result.

    The checkpoint remembers the files; a batch that is retried overwrites its
    own folder, so a lost executor or driver leaves no duplicates.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        score_orders(model, batch).write.mode("overwrite").parquet(f"{output}/{BATCH}={batch_id}")

    arrivals = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    (
        arrivals.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def scored_orders(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output).drop(F.col(BATCH))
