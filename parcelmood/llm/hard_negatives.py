"""Hard-negative mining (12): exact top lists of inner products by coordinate pruning in buckets of like length.

All rows are laid out as an index, written once: rows in falling order of length, cut into buckets; a bucket keeps its
vectors and, for every coordinate, its rows in the order of that coordinate's share of the length. Anchors are asked
in blocks of bounded size, each block against every bucket in a job of its own. A bucket is skipped where its greatest
length cannot reach the score that an anchor's list still asks for. Else that score, as an angle, bounds each
coordinate of a row that can qualify: for the anchor's largest (focus) coordinates the bounds are looked up in the
sorted lists, the narrowest range is intersected with the others, and what remains is verified by exact integer
products. Where the ranges hold most of a bucket, the whole bucket is verified at once; the results are the same.

A task carries each anchor's list on from bucket to bucket, so its bar rises as the rows go by; a grouped limit puts
the lists of all tasks together. Only the order of work depends on blocks and buckets, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelmood.llm.base import query, stored, table
from parcelmood.session import scratch_path

#: Rows of a bucket, at most.
BUCKET_ROWS = 4096
#: Rows of an index partition, about: the unit of one sort.
PARTITION_ROWS = 65_536
#: Anchors asked in one job, about: with 64 dimensions 8 MB for every executor.
BLOCK_ANCHORS = 16_384
#: Anchors whose products with a bucket are held at once.
CHUNK = 128
#: Coordinates that are looked up for an anchor.
FOCUS = 3
#: A range that holds more than one row in so many is not worth intersecting.
WORTH = 8
#: Null ids come after all others.
LAST_ID = 2**63 - 1
#: Below any score, with room for a change of sign.
NO_SCORE = -LAST_ID
#: Products up to this size are exact in double precision.
EXACT = 2.0**53


@dataclass
class Block:
    """Anchors of one job. ``lower`` and ``upper`` bound the scores of each of an anchor's lists."""

    key: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    same_label: bool
    size: int
    lower: np.ndarray
    upper: np.ndarray


class Lists:
    """The best rows of each list so far: score, then smaller id, then smaller key."""

    def __init__(self, block: Block):
        shape = (*block.lower.shape, block.size)
        self.score = np.full(shape, NO_SCORE)
        self.id = np.full(shape, LAST_ID)
        self.key = np.full(shape, LAST_ID)
        self.filled = np.zeros(block.lower.shape, np.int64)

    def bar(self, lower: np.ndarray) -> np.ndarray:
        """The least score that can still enter each list."""
        full = self.filled == self.score.shape[-1]
        return np.where(full, np.maximum(self.score[..., -1], lower), lower)

    def offer(self, anchors: np.ndarray, which: int, score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        """Put candidates of list ``which`` of the named anchors in their places."""
        size = self.score.shape[-1]
        order = np.lexsort((keys, ids, -score, anchors))
        anchors, score, ids, keys = anchors[order], score[order], ids[order], keys[order]
        first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        rank = np.arange(len(anchors)) - np.repeat(first, np.diff(np.concatenate([first, [len(anchors)]])))
        few = rank < size
        anchors, score, ids, keys, rank = anchors[few], score[few], ids[few], keys[few], rank[few]
        at = np.unique(anchors)
        place = np.searchsorted(at, anchors)
        new = [np.full((len(at), size), fill) for fill in (NO_SCORE, LAST_ID, LAST_ID)]
        for array, values in zip(new, (score, ids, keys)):
            array[place, rank] = values
        held = [np.concatenate([old[at, which], n], axis=1) for old, n in zip((self.score, self.id, self.key), new)]
        best = np.lexsort((held[2], held[1], -held[0]), axis=1)[:, :size]
        for old, both in zip((self.score, self.id, self.key), held):
            old[at, which] = np.take_along_axis(both, best, 1)
        self.filled[at, which] = np.minimum(size, self.filled[at, which] + np.bincount(place, minlength=len(at)))


def _integers(vectors: pa.Array, scale: float) -> np.ndarray:
    """Rows of floor(scale * x); shorter rows are filled up with zeros. Beyond 64 bits the nearest 64-bit value."""
    rows = [np.floor(scale * np.asarray(v, np.float64)) for v in vectors.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return np.clip(out, -(2.0**63), 2.0**63 - 1025).astype(np.int64)


def _lengths(batches: Iterator[pa.RecordBatch], scale: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = _integers(batch.column("vector"), scale)
        vectors = pa.array([v.tobytes() for v in whole], pa.binary())
        length = pa.array(np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1)), pa.float64())
        rest = [batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays([*rest, vectors, length], names=[*names, "vector", "length"])


def _matrix(blobs: list[bytes]) -> np.ndarray:
    width = max(map(len, blobs), default=0)
    return np.frombuffer(b"".join(b.ljust(width, b"\0") for b in blobs), "<i8").reshape(len(blobs), width // 8)


def _shares(vectors: np.ndarray, length: np.ndarray) -> np.ndarray:
    return vectors / np.where(length == 0, 1, length)[:, None]


def _buckets(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows in falling order of length become buckets with sorted coordinate lists."""
    held: list[list] = [[] for _ in columns]

    def bucket(rows: list[list]) -> pa.RecordBatch:
        key, vec_id, label, blobs, length = rows
        vectors, longest = _matrix(blobs), np.array(length)
        lists = np.argsort(_shares(vectors, longest), axis=0, kind="stable").astype("<u2")
        row = [[key], [vec_id], [label], [vectors.tobytes()], [length], [np.ascontiguousarray(lists.T).tobytes()]]
        kinds = [pa.list_(pa.int64())] * 3 + [pa.binary(), pa.list_(pa.float64()), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds)], names=["keys", "ids", "labels", "vectors", "lengths", "lists"]
        )

    for batch in batches:
        for values, name in zip(held, columns):
            values.extend(batch.column(name).to_pylist())
        while len(held[0]) >= BUCKET_ROWS:
            yield bucket([v[:BUCKET_ROWS] for v in held])
            held = [v[BUCKET_ROWS:] for v in held]
    if held[0]:
        yield bucket(held)


def _candidates(
    shares: np.ndarray, lists: np.ndarray, anchors: np.ndarray, angle: np.ndarray
) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Anchors to be held against the whole bucket, and for each other one the rows that its focus coordinates leave.

    A row within ``angle`` of the anchor has each coordinate within the cosines of (coordinate's own angle ± angle).
    """
    rows, dims = shares.shape
    focus = np.argsort(-np.abs(anchors), axis=1)[:, : min(FOCUS, dims)]
    own = np.arccos(np.clip(np.take_along_axis(anchors, focus, 1), -1, 1))
    low = np.cos(np.minimum(np.pi, own + angle[:, None])) - 1e-9
    high = np.cos(np.maximum(0, own - angle[:, None])) + 1e-9
    begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus):
        at = focus == f
        values = shares[lists[f], f]
        begin[at], end[at] = np.searchsorted(values, low[at], "left"), np.searchsorted(values, high[at], "right")
    narrow = (end - begin).argmin(axis=1) if focus.size else np.zeros(len(anchors), np.int64)
    few = np.zeros(len(anchors), bool)
    if focus.size:
        few = (end - begin)[np.arange(len(anchors)), narrow] <= rows // WORTH
    left = []
    for a in np.flatnonzero(few).tolist():
        f = narrow[a]
        found = lists[focus[a, f], begin[a, f] : end[a, f]].astype(np.int64)
        for g in range(focus.shape[1]):
            if g != f:
                values = shares[found, focus[a, g]]
                found = found[(values >= low[a, g]) & (values <= high[a, g])]
        left.append((a, found))
    return np.flatnonzero(~few), left


def _search(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Each list's best rows among the buckets of a task."""
    block: Block = shared.value
    lists = Lists(block)
    size = np.sqrt((block.vector.astype(np.float64) ** 2).sum(axis=1))
    share = _shares(block.vector, size)
    for batch in batches:
        for row in batch.to_pylist():
            _search_bucket(row, block, lists, size, share)
    at = np.argwhere(lists.key != LAST_ID)
    where = tuple(at.T)
    columns = [block.key[at[:, 0]], at[:, 1], lists.score[where], lists.id[where], lists.key[where]]
    for start in range(0, max(1, len(at)), 65_536):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[start : start + 65_536], pa.int64()) for c in columns],
            names=["anchor_key", "list", "score", "id", "key"],
        )


def _fit(array: np.ndarray, width: int) -> np.ndarray:
    return np.pad(array, ((0, 0), (0, max(0, width - array.shape[1]))))


def _search_bucket(row: dict, block: Block, found: Lists, size: np.ndarray, share: np.ndarray) -> None:
    keys, ids, labels = (np.array(row[c], np.int64) for c in ("keys", "ids", "labels"))
    length = np.array(row["lengths"])
    vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(keys), -1)
    own = vectors.shape[1]
    lists = np.frombuffer(row["lists"], "<u2").reshape(own, len(keys))
    width = max(own, block.vector.shape[1])
    rows, anchors = _fit(vectors, width), _fit(block.vector, width)
    if length.max() * size.max(initial=0) < EXACT:
        rows, anchors = rows.astype(np.float64), anchors.astype(np.float64)

    # what a row must reach to enter any of an anchor's lists
    bar = found.bar(block.lower).min(axis=1, initial=np.iinfo(np.int64).max).astype(np.float64)
    reach = size * length.max()
    slack = 1e-9 * (reach + np.abs(bar))
    open_ = (bar <= reach + slack) & (block.upper >= block.lower).any(axis=1)
    at = np.flatnonzero(open_)
    # a bar of 0 or less is no angle that holds for shorter rows too
    cosine = np.where(bar > 0, (bar - slack) / np.where(reach == 0, 1, reach), -1)[at]
    narrow = cosine > 0
    whole, left = at[~narrow], []
    if narrow.any():
        asked = _fit(share[at[narrow]], own)[:, :own]
        # the part of an anchor beyond the bucket's dimensions meets zeros only
        angle = np.arccos(np.clip(cosine[narrow] - 1e-9, -1, 1))
        rest, left = _candidates(_shares(vectors, length), lists, asked, angle)
        whole = np.concatenate([whole, at[narrow][rest]])
        left = [(at[narrow][a], r) for a, r in left]

    def offer(a: np.ndarray, r: np.ndarray, score: np.ndarray) -> None:
        fits = (labels[r] == block.label[a]) == block.same_label
        fits &= keys[r] != block.key[a]
        a, r, score = a[fits], r[fits], score[fits]
        for which in range(block.lower.shape[1]):
            fit = (score >= block.lower[a, which]) & (score <= block.upper[a, which])
            full = found.filled[a, which] == found.score.shape[-1]
            # a tie with a full list enters by its id alone
            last = found.score[a, which, -1]
            fit &= ~full | (score > last) | (score == last) & (ids[r] <= found.id[a, which, -1])
            if fit.any():
                found.offer(a[fit], which, score[fit], ids[r[fit]], keys[r[fit]])

    for start in range(0, len(whole), CHUNK):
        part = whole[start : start + CHUNK]
        product = rows @ anchors[part].T
        least = found.bar(block.lower)[part].min(axis=1)
        r, a = np.nonzero((product >= least) & (product <= block.upper[part].max(axis=1)))
        offer(part[a], r, product[r, a].astype(np.int64))
    for start in range(0, len(left), CHUNK):
        part = left[start : start + CHUNK]
        a = np.repeat(np.array([x for x, _ in part], np.int64), [len(r) for _, r in part])
        r = np.concatenate([r for _, r in part]) if part else np.zeros(0, np.int64)
        score = np.concatenate([rows[x] @ anchors[i] for i, x in part]) if part else r
        offer(a, r, score.astype(np.int64))


def _arrays(rows: list, lists: int) -> dict:
    return {
        "key": np.array([r.key for r in rows], np.int64),
        "label": np.array([r.label for r in rows], np.int64),
        "vector": _matrix([bytes(r.vector) for r in rows]),
        "lower": np.full((len(rows), lists), -(2**62)),
        "upper": np.full((len(rows), lists), 2**62),
    }


_FOUND = "anchor_key bigint, list bigint, score bigint, id bigint, key bigint"


def _ask(index: DataFrame, block: Block) -> DataFrame:
    """The best ``block.size`` rows of each list over the whole index, with their rank."""
    shared = index.sparkSession.sparkContext.broadcast(block)
    best = Window.partitionBy("anchor_key", "list").orderBy(F.desc("score"), "id", "key")
    return (
        index.mapInArrow(lambda b: _search(b, shared), _FOUND)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= block.size)
    )


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Columns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x), scores are their integer inner products. An anchor's positives are its best
    other rows of the same label; for each of them the best rows of other labels whose score lies between
    ``low_percent`` and ``high_percent`` of the positive's. Higher scores come first, ties by the smaller id.

    Rows with a null label, a null vector or a null or non-finite component take no part; a row with a null id does,
    after all other ids, and ``is_anchor`` decides whether it asks (null: no). Rows that repeat are rows of their own:
    each asks, and each is a positive or negative for others. Vectors of different lengths meet as if the shorter one
    ended in zeros; an empty vector scores 0. No rows, no anchors or no fitting negatives give no rows. Scores must
    fit 62 bits. Further columns are not read.
    """
    spark = vectors.sparkSession
    entries = F.col(vector_col)
    sound = F.forall(entries, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    picked = vectors.filter(F.col(label_col).isNotNull() & entries.isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        entries.alias("vector"),
    )
    names = ["key", "id", "label", "asks"]
    rows = stored(
        picked.mapInArrow(
            lambda b: _lengths(b, scale, names),
            "key bigint, id bigint, label bigint, asks boolean, vector binary, length double",
        ),
        "vectors",
    )
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asks")).first()
    columns = ["key", "id", "label", "vector", "length"]
    # equal lengths are dealt by the key, so a hot vector fills many partitions
    index = stored(
        rows.select(*columns)
        .repartitionByRange(max(1, -(-counts.rows // PARTITION_ROWS)), F.desc("length"), "key")
        .sortWithinPartitions(F.desc("length"), "key")
        .mapInArrow(
            lambda b: _buckets(b, columns),
            "keys array<bigint>, ids array<bigint>, labels array<bigint>, vectors binary, lengths array<double>, lists binary",
        ),
        "length-buckets",
    )
    blocks = max(1, -(-counts.asks // BLOCK_ANCHORS))
    path = scratch_path(spark, "anchors")
    of = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    anchors = rows.filter("asks").select("key", "id", "label", "vector", of.alias("block"))
    anchors.write.partitionBy("block").parquet(path)
    asked = spark.read.schema("key bigint, id bigint, label bigint, vector binary, block int").parquet(path)
    out = scratch_path(spark, "negatives")
    null_id = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], schema).write.parquet(out)
    for number in range(blocks):
        # about BLOCK_ANCHORS rows, whatever the input
        own = asked.filter(F.col("block") == number).select("key", "id", "label", "vector").collect()
        if not own:
            continue
        block = Block(same_label=True, size=positives, **_arrays(own, 1))
        # at most ``positives`` rows an anchor
        best = _ask(index, block).collect()
        place = {k: i for i, k in enumerate(block.key.tolist())}
        lower = np.full((len(own), positives), 1)
        upper = np.zeros((len(own), positives), np.int64)
        for r in best:
            lower[place[r.anchor_key], r.rank - 1] = -(-low_percent * r.score // 100)
            upper[place[r.anchor_key], r.rank - 1] = high_percent * r.score // 100
        found = _ask(index, replace(block, same_label=False, size=negatives, lower=lower, upper=upper))
        ids = dict(zip(block.key.tolist(), (r.id for r in own)))
        wanted = spark.createDataFrame(
            [(r.anchor_key, r.rank - 1, ids[r.anchor_key], r.id, r.score) for r in best],
            "anchor_key bigint, list bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
        )
        found.join(wanted, ["anchor_key", "list"]).select(
            "anchor_id", null_id("positive_id").alias("positive_id"), "rank",
            null_id("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


#: The same lists by holding every anchor against every row.
MINED_SQL = """
WITH sound AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
    FROM sound a JOIN sound r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 3
"""


@query("op12_hard_negatives", MINED_SQL)
def op12_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, directory, "embeddings").withColumn("label", label)
    return mine_negatives(rows, F.col("vec_id") % 50 == 0)
