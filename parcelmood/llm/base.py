"""What the operators share: the query registry, table access, staging and row selection.

Every operator first selects the columns that it is told to use, under names of its own, so further columns of
the input never clash with its work. Null and empty texts are the same text unless an operator says otherwise.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmood.session import configure, scratch_path

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}

#: Arrow batches: texts of 100 KB must not meet ten thousand at a time in one Python worker.
ARROW_ROWS = "1000"
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
#: Names (an id, perhaps a digest: some 100 bytes) up to which a join sends them to every executor.
BROADCAST_NAMES = 200_000
#: The words of a text are what lies between these characters.
BLANKS = "\\x20\\x09-\\x0D"


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    # workers import this package from where it is installed, the same place on every machine
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_ROOT, paths]))
    return spark


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        QUERIES[name] = lambda spark, directory: job(prepared(spark), directory)
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, with its lineage cut there."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def texts_of(frame: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns (doc_id, text) only; a null text becomes empty."""
    return frame.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def keep_rows(
    frame: DataFrame, kept: DataFrame, keys: Sequence[Column], names: Sequence[str], same: Column | None = None
) -> DataFrame:
    """Rows of ``frame`` named by ``kept`` (``names``, copies); of repeated rows one.

    ``copies`` counts the rows of the frame with that name, ``same`` tells apart different rows of one name. Names
    of one row, nearly all, need only a semi-join; others alone meet in a ``dropDuplicates``, which drops most of
    them before its shuffle.
    """
    keys, marks = [*keys, *([] if same is None else [same])], [f"k_{i}" for i in range(len(keys) + (same is not None))]
    marked = frame.select(F.struct(*frame.columns).alias("row"), *[k.alias(m) for k, m in zip(keys, marks)])
    slim = kept.select(*[F.col(n).alias(f"w_{i}") for i, n in enumerate(names)], F.col("copies").alias("w_copies"))
    match = F.lit(True)
    for i in range(len(names)):
        match = match & F.col(f"k_{i}").eqNullSafe(F.col(f"w_{i}"))
    single = marked.join(slim.filter("w_copies = 1"), match, "left_semi").select("row.*")
    several = marked.join(slim.filter("w_copies > 1"), match, "left_semi")
    return single.unionByName(several.dropDuplicates(marks).select("row.*"))


def keep_all_but(
    frame: DataFrame, named: DataFrame, keys: Sequence[Column], names: Sequence[str], same: Column | None = None
) -> DataFrame:
    """The frame's rows whose name stays; of repeated rows one.

    ``named`` has all names of the frame's rows (``names``) once, with ``copies``: the rows of that name that stay,
    0 where none does. ``same`` tells apart different rows of one name. Most names have one row that stays and
    need no look-up: an anti-join takes off the others, and those with several rows alone meet in a
    ``dropDuplicates``. These names are stored and counted, and broadcast only up to ``BROADCAST_NAMES``.
    """
    keys, marks = [*keys, *([] if same is None else [same])], [f"k_{i}" for i in range(len(keys) + (same is not None))]
    marked = frame.select(F.struct(*frame.columns).alias("row"), *[k.alias(m) for k, m in zip(keys, marks)])
    slim = named.filter("copies != 1").select(
        *[F.col(n).alias(f"w_{i}") for i, n in enumerate(names)], F.col("copies").alias("w_copies")
    )
    slim = stored(slim, "other-names")
    sizes = slim.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("w_copies") > 1).alias("several")).first()

    def side(rows: DataFrame, count: int) -> DataFrame:
        return F.broadcast(rows) if count <= BROADCAST_NAMES else rows

    match = F.lit(True)
    for i in range(len(names)):
        match = match & F.col(f"k_{i}").eqNullSafe(F.col(f"w_{i}"))
    single = marked.join(side(slim, sizes.n), match, "left_anti").select("row.*")
    if not sizes.several:
        return single
    several = marked.join(side(slim.filter("w_copies > 1"), sizes.several), match, "left_semi")
    return single.unionByName(several.dropDuplicates(marks).select("row.*"))
