"""Exact dedup (3): an index of live digests in sharded cuckoo filters, verified against bucketed content.

The content table holds every live digest (SHA-256 of the normalised text, its length in bytes, the row that
stays, the number of rows), dealt into shards by the digest. A shard also has a cuckoo filter. A digest that misses
the filter is new without a look at the content; a hit is only a hint and is held against the stored digests of its
shard, so false positives change nothing. A filter that overflows is built anew, doubled, from the stored keys.

Copies are added up within tasks and ``SALTS`` groups of ids before they reach their shard, so a text that fills a
third of the corpus costs its shard at most ``SALTS`` rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import ascii_lower, keep_all_but, query, stored, table
from parcelmood.llm.cuckoo import CuckooFilter

#: Live digests in a shard, on average.
SHARD_KEYS = 4_096
SALTS = 8

_CONTENT = "shard bigint, digest binary, n_bytes bigint, doc_id bigint, copies bigint"
_FILTER = "shard bigint, filter binary, resizes int, false_hits bigint"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in lower case (A-Z only), null like empty, as lowercase hex."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little")


class _Shard:
    """One shard while it takes changes: the content by digest and the filter over it."""

    def __init__(self, content: pa.Table | None = None, filter_: bytes | None = None):
        self.content: dict[bytes, list] = {}
        if content is not None:
            names = ("digest", "n_bytes", "doc_id", "copies")
            for digest, *rest in zip(*[content[n].to_pylist() for n in names]):
                self.content[digest] = rest
        self.filter = CuckooFilter.load(filter_) if filter_ else CuckooFilter.holding(map(_key, self.content))
        self.resizes = self.false_hits = 0

    def insert(self, digest: bytes, n_bytes: int, doc_id: int | None, copies: int) -> None:
        key = _key(digest)
        if key in self.filter:
            if (stored_row := self.content.get(digest)) is not None:
                if doc_id is not None and (stored_row[1] is None or doc_id > stored_row[1]):
                    stored_row[1] = doc_id
                stored_row[2] += copies
                return
            self.false_hits += 1
        self.content[digest] = [n_bytes, doc_id, copies]
        if not self.filter.insert(key):
            self.filter = CuckooFilter.holding(map(_key, self.content), 2 * len(self.content))
            self.resizes += 1

    def delete(self, digest: bytes) -> None:
        if _key(digest) in self.filter and self.content.pop(digest, None) is not None:
            self.filter.delete(_key(digest))

    def rows(self, shard: int) -> pa.Table:
        digests = sorted(self.content)
        rows = [self.content[d] for d in digests]
        return pa.table(
            {
                "shard": pa.array([shard] * len(rows), pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "n_bytes": pa.array([r[0] for r in rows], pa.int64()),
                "doc_id": pa.array([r[1] for r in rows], pa.int64()),
                "copies": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    def state(self, shard: int) -> pa.Table:
        return pa.table(
            {
                "shard": pa.array([shard], pa.int64()),
                "filter": pa.array([self.filter.dump()], pa.binary()),
                "resizes": pa.array([self.resizes], pa.int32()),
                "false_hits": pa.array([self.false_hits], pa.int64()),
            }
        )


def _apply(shard: _Shard, changes: pa.Table) -> _Shard:
    changes = changes.sort_by([("digest", "ascending"), ("salt", "ascending")])
    names = ("digest", "n_bytes", "doc_id", "copies")
    for digest, n_bytes, doc_id, copies in zip(*[changes[n].to_pylist() for n in names]):
        if copies > 0:
            shard.insert(digest, n_bytes, doc_id, copies)
        else:
            shard.delete(digest)
    return shard


class DigestIndex:
    """Live digests as two stored tables, ``content`` and ``filters``, over a fixed number of shards.

    Every change gives a new index beside the old one, so a lost task or a failed job leaves the old one whole.
    """

    def __init__(self, content: DataFrame, filters: DataFrame, shards: int):
        self.content, self.filters, self.shards = content, filters, shards

    @classmethod
    def build(cls, rows: DataFrame, shard_keys: int = SHARD_KEYS) -> "DigestIndex":
        """From rows (doc_id, digest, n_bytes), repeated digests included."""
        shards = max(1, -(-rows.count() // shard_keys))
        changes = _added_up(rows, shards)

        def content(changes: pa.Table) -> pa.Table:
            return _apply(_Shard(), changes).rows(changes["shard"][0].as_py())

        kept = stored(changes.groupBy("shard").applyInArrow(content, _CONTENT), "digests")
        return cls(kept, _filters_of(kept), shards)

    def insert(self, rows: DataFrame) -> "DigestIndex":
        """Further rows (doc_id, digest, n_bytes); known digests gain copies, new ones are added."""
        return self._changed(_added_up(rows, self.shards))

    def delete(self, digests: DataFrame) -> "DigestIndex":
        """Rows (digest) that are no longer live; unknown ones change nothing."""
        gone = digests.select("digest").distinct().select(
            F.unhex("digest").alias("digest"), F.lit(0).cast("long").alias("n_bytes"),
            F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("copies"), F.lit(0).alias("salt"),
        )
        return self._changed(gone.withColumn("shard", _shard_of("digest", self.shards)))

    def _changed(self, changes: DataFrame) -> "DigestIndex":
        def content(stored_rows: pa.Table, changes: pa.Table) -> pa.Table:
            either = stored_rows if stored_rows.num_rows else changes
            shard = _Shard(stored_rows) if stored_rows.num_rows else _Shard()
            return _apply(shard, changes).rows(either["shard"][0].as_py())

        both = self.content.groupBy("shard").cogroup(changes.groupBy("shard"))
        kept = stored(both.applyInArrow(content, _CONTENT), "digests")
        return DigestIndex(kept, _filters_of(kept), self.shards)

    def probe(self, rows: DataFrame) -> DataFrame:
        """Rows (digest) -> distinct (digest, n_bytes, doc_id, copies) of those that are live.

        The filters drop nearly all unknown digests; what they let through is joined with the content.
        """
        asked = rows.select("digest").distinct().withColumn("digest", F.unhex("digest"))
        asked = asked.withColumn("shard", _shard_of("digest", self.shards))

        def hits(asked: pa.Table, filters: pa.Table) -> pa.Table:
            if not filters.num_rows or not asked.num_rows:
                return asked.slice(0, 0)
            shard = CuckooFilter.load(filters["filter"][0].as_py())
            return asked.filter(pa.array([_key(d) in shard for d in asked["digest"].to_pylist()]))

        maybe = asked.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(
            hits, "digest binary, shard bigint"
        )
        return maybe.select("digest").join(self.content.drop("shard"), "digest").withColumn(
            "digest", F.lower(F.hex("digest"))
        )


def _filters_of(content: DataFrame) -> DataFrame:
    """The filter of each shard, by insertion of its stored keys."""

    def state(content: pa.Table) -> pa.Table:
        shard = _Shard()
        for row in zip(*[content[n].to_pylist() for n in ("digest", "n_bytes", "doc_id", "copies")]):
            shard.insert(*row)
        return shard.state(content["shard"][0].as_py())

    return stored(content.groupBy("shard").applyInArrow(state, _FILTER), "filters")


def _shard_of(digest: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards))


def _added_up(rows: DataFrame, shards: int) -> DataFrame:
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    return (
        rows.groupBy("digest", "n_bytes", salt.alias("salt"))
        .agg(F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("digest", F.unhex("digest"))
        .withColumn("shard", _shard_of("digest", shards))
    )


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), digest_of(text).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns (doc_id, keep_id, group_size, kept, text_sha256), one row for each input row.

    Null and empty texts form one group. Of equal texts the row with the largest id stays; null ids lose against
    others, and a group of null ids alone keeps null. Repeated rows all carry the mark of their id. No rows, no rows.
    """
    rows = stored(digests(docs, id_col, text_col), "row-digests")
    index = DigestIndex.build(rows)
    groups = index.content.select(
        F.lower(F.hex("digest")).alias("digest"), F.col("doc_id").alias("keep_id"), F.col("copies").alias("group_size")
    )
    # only repeated texts need to look up their group
    several = groups.filter("group_size > 1")
    joined = rows.join(several, "digest", "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows without exact copies: one row of each group, all columns as they were."""
    named = (
        exact_groups(docs, id_col, text_col)
        .groupBy("doc_id", F.col("text_sha256").alias("digest")).agg(F.count_if("kept").alias("copies"))
    )
    keys = [F.col(id_col).cast("long"), digest_of(F.col(text_col))]
    return keep_all_but(docs, named, keys, ["doc_id", "digest"])


EXACT_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)"""


@query("op3_exact_dedup", EXACT_SQL)
def op3_exact_dedup(spark, directory):
    return exact_groups(table(spark, directory, "documents"))
