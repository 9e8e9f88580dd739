"""Best-fit packing (7): best-two-fit.

Documents are cut into pieces of at most one sequence, and the pieces are dealt by a hash of their place into
shards of bounded size, so no task grows with the corpus and no source or length can make one hot. A shard fills
bins greedily, longest piece into the tightest bin, then tries in every bin with room left to exchange its
smallest piece for two unpacked pieces that fill the widened gap more tightly. A shard leaves at most a few loose
bins; they are packed again, together with those of other shards.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import query, stored, table, texts_of
from parcelmood.llm.tokens import Vocabulary

CAPACITY = 4096
#: Pieces in a shard, on average.
SHARD_PIECES = 8_192
#: Tokens closing a document.
END_ID = 1

#: Bins filled less than this share are dissolved and packed anew with those of ``MERGED`` shards.
LOOSE = 0.95
MERGED = 64


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary.at(path)
    closing = np.array([end], dtype="<u4").tobytes()
    step = 4 * capacity
    for batch in batches:
        origin, piece, length, crc = [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            ids = vocabulary.bare_ids(text) + closing
            for number, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                origin.append(row)
                piece.append(number)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(origin, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(np.array(piece, dtype=np.int64) * capacity),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )


class _Loose:
    """Lengths not packed yet, in order, each with the pieces that have it."""

    def __init__(self, lengths: np.ndarray):
        self.sizes: list[int] = []
        self.members: dict[int, list[int]] = {}
        for i in np.argsort(lengths, kind="stable"):
            self.add(int(i), int(lengths[i]))

    def add(self, item: int, size: int) -> None:
        if size not in self.members:
            insort(self.sizes, size)
            self.members[size] = []
        self.members[size].append(item)

    def take(self, size: int) -> int:
        item = self.members[size].pop()
        if not self.members[size]:
            del self.members[size]
            del self.sizes[bisect_left(self.sizes, size)]
        return item

    def largest(self, room: int) -> int | None:
        at = bisect_left(self.sizes, room + 1)
        return self.sizes[at - 1] if at else None

    def best_pair(self, room: int) -> tuple[int, int] | None:
        """Two sizes with the largest sum of at most ``room``: two pointers over the distinct sizes."""
        low, high, best, pair = 0, bisect_left(self.sizes, room + 1) - 1, 0, None
        while low <= high and high >= 0:
            a, b = self.sizes[low], self.sizes[high]
            if a + b > room or (low == high and len(self.members[a]) < 2):
                high -= 1
                continue
            if a + b > best:
                best, pair = a + b, (a, b)
                if best == room:
                    break
            low += 1
        return pair


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers; every length is at most the capacity.

    A bin takes the longest loose item, then always the longest that still fits. If room is left, its smallest
    item goes back when two loose items fill the gap that this leaves more tightly. Every exchange fills its bin
    further, so the loop ends.
    """
    loose, bins = _Loose(lengths), []
    while loose.sizes:
        content: list[int] = []
        room = capacity
        while (size := loose.largest(room)) is not None:
            content.append(loose.take(size))
            room -= size
        while room and len(content) > 1:
            smallest = content[-1]
            gap = room + int(lengths[smallest])
            pair = loose.best_pair(gap)
            if pair is None or sum(pair) <= lengths[smallest]:
                break
            loose.add(smallest, int(lengths[smallest]))
            content[-1:] = [loose.take(pair[1]), loose.take(pair[0])]
            content.sort(key=lambda i: -lengths[i])
            room = gap - sum(pair)
        bins.append(content)
    return bins


def _pack(pieces: pa.Table, capacity: int) -> pa.Table:
    # in an order of their own, so that a repeated task gives the same bins
    pieces = pieces.sort_by([(n, "ascending") for n in ("length", "doc_id", "piece", "ids_crc32")])
    lengths = pieces["length"].to_numpy()
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, content in enumerate(best_two_fit(lengths, capacity)):
        at = 0
        for i in content:
            bin_of[i], offset[i] = number, at
            at += lengths[i]
    fill = np.bincount(bin_of, weights=lengths).astype(np.int64)[bin_of]
    columns = {"bin": bin_of, "offset": offset, "fill": fill}
    for name, values in columns.items():
        pieces = pieces.append_column(name, pa.array(values))
    return pieces


def dealt(pieces: DataFrame, shards: int) -> DataFrame:
    """The pieces without their key, each with one of ``shards`` numbers; equal pieces get different ones."""
    return pieces.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).drop("key")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard_pieces: int = SHARD_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Columns (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece.

    A null or empty text is the end id alone. Repeated rows are packed as often as they come, a null id stays
    null. No rows give no rows. Sequences carry numbers that are unique but not dense.
    """
    texts = texts_of(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    pieces_type = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    packed_type = f"{pieces_type}, shard bigint, bin bigint, offset bigint, fill bigint"
    pieces = texts.mapInArrow(lambda b: _cut(b, tokenizer, capacity, end_id), pieces_type)
    # stored once with a key of its own for every piece, which deals equal rows evenly
    pieces = stored(pieces.withColumn("key", F.monotonically_increasing_id()), "pieces")
    # the number of rows, which file footers give, decides how many shards there are
    shards = max(1, -(-pieces.count() // shard_pieces))

    def packed(frame: DataFrame) -> DataFrame:
        return frame.groupBy("shard").applyInArrow(lambda t: _pack(t, capacity), packed_type)

    first = stored(packed(dealt(pieces, shards)), "bins")
    loose = F.col("fill") < int(LOOSE * capacity)
    again = packed(first.filter(loose).drop("bin", "offset", "fill").withColumn("shard", F.floor(F.col("shard") / MERGED)))

    def numbered(frame: DataFrame, level: int) -> DataFrame:
        number = (F.col("shard") * (1 << 24) + F.col("bin")) * 2 + level
        return frame.select(
            "doc_id", "piece", "start", "length", "ids_crc32", number.cast("long").alias("sequence_id"), "offset"
        )

    return numbered(first.filter(~loose), 0).unionByName(numbered(again, 1))


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark, directory):
    import public_tokenizers

    return pack(table(spark, directory, "documents"), public_tokenizers.path("word_bpe_49k.json"))
