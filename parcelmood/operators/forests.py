"""Forests of many rows and trees, grown a group of trees at a time.

Spark's forest keeps a bootstrap count and two node numbers for each row and tree, and one pass after another waits for
the driver. In groups, what is kept grows with the rows alone, and one group's passes fill the other's gaps.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood.operators.composite import Composite

#: Rows times trees up to which a forest is grown whole: some 400 MB of counts and node numbers.
WHOLE = 2**25
#: Trees of a group, and groups that are grown at a time.
GROUP = 50
AT_A_TIME = 2
#: Memory of a task for the statistics of open nodes in a group.
GROUP_MEMORY_MB = 128


class ForestModel(Composite):
    """Forests that vote as one: raw predictions are sums over all trees, as in a single forest."""

    def __init__(self, members: Sequence[Model] = ()) -> None:
        super().__init__()
        self.members = list(members)

    def parts(self) -> list[Model]:
        return self.members

    @classmethod
    def of_parts(cls, parts: Sequence[Model], names: Sequence[str]) -> ForestModel:
        return cls(parts)

    @property
    def getNumTrees(self) -> int:
        return sum(member.getNumTrees for member in self.members)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored, votes = dataset, []
        for i, member in enumerate(self.members):
            votes.append(f"_votes_{i}")
            counted = vector_to_array(F.col("rawPrediction")).alias(votes[-1])
            scored = member.transform(scored).select(*scored.columns, counted)
        total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), map(F.col, votes))
        scored = scored.select(*dataset.columns, total.alias("_votes"))
        everyone = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        share = F.transform("_votes", lambda x: x / everyone)
        return scored.select(
            *dataset.columns,
            array_to_vector(F.col("_votes")).alias("rawPrediction"),
            array_to_vector(share).alias("probability"),
            (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double").alias("prediction"),
        )


def _groups(learner: RandomForestClassifier) -> list[RandomForestClassifier]:
    """The learner's trees dealt to learners of at most ``GROUP``, each with draws of its own."""
    rng, trees = random.Random(learner.getSeed()), learner.getNumTrees()
    memory = min(GROUP_MEMORY_MB, learner.getMaxMemoryInMB())
    return [
        learner.copy({
            learner.numTrees: min(GROUP, trees - first),
            learner.seed: rng.randrange(2**31),
            learner.maxMemoryInMB: memory,
        })
        for first in range(0, trees, GROUP)
    ]


def fit_learner(learner: Estimator, ready: DataFrame, rows: int | None = None) -> Model:
    """``learner`` fitted on persisted vectors; a forest of many rows and trees in groups, on one partition a core."""
    if not isinstance(learner, RandomForestClassifier) or learner.getNumTrees() <= GROUP:
        return learner.fit(ready)
    if (ready.count() if rows is None else rows) * learner.getNumTrees() <= WHOLE:
        return learner.fit(ready)
    spark = ready.sparkSession
    dealt = ready.coalesce(spark.sparkContext.defaultParallelism)
    with ThreadPool(AT_A_TIME) as pool:
        grow = inheritable_thread_target(spark)(lambda group: group.fit(dealt))
        return ForestModel(pool.map(grow, _groups(learner), chunksize=1))
