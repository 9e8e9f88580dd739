"""Token-ID / binary output (8): one zstandard dictionary, every document compressed by itself.

A file is a table of blocks. A block holds consecutive documents by id: their ids, the offset of each in the
payload, its number of tokens, and the hash of the dictionary that reads it, so one short document costs one seek
and one small decompression. The dictionary, trained on id arrays of a bounded sample, and the number of tokens
before each range of ids lie beside the blocks. Texts are dealt by ranges of ids and each range is encoded and cut
into blocks by the task that sorts it, so neither ids nor payloads are shuffled, and a reader decodes and checks a
block in one step. Spark's own writers put all in the shared folder, so a lost task leaves nothing behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelmood.llm.base import BROADCAST_NAMES, query, table, texts_of
from parcelmood.llm.tokens import Vocabulary
from parcelmood.session import scratch_path

END_ID = 2
#: Documents whose ids train the dictionary, about, and its size: bounds of what the driver holds.
SAMPLE_DOCS = 512
SAMPLE_IDS = 8_192
DICTIONARY_BYTES = 65_536
LEVEL = 3
#: Documents in a range of ids, on average: the unit of one sort.
RANGE_DOCS = 16_384
#: Ranges whose running totals one task adds up.
GROUP_RANGES = 4_096
#: Compressed bytes after which a block ends: an Arrow batch of a thousand blocks stays below 64 MB.
BLOCK_BYTES = 1 << 16

BLOCKS = (
    "range bigint, block int, dict_hash string, first_id {id}, last_id {id}, n_tokens bigint, doc_ids array<{id}>, "
    "starts array<bigint>, counts array<bigint>, offsets array<bigint>, payload binary"
)


def _sample_ids(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary.at(path)
    for batch in batches:
        ids = [vocabulary.bare_ids(t)[: 4 * SAMPLE_IDS] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])


def train_dictionary(texts: DataFrame, tokenizer: str, rows: int) -> bytes:
    """The dictionary; empty where the sample is too small to train one."""
    import zstandard

    one_in = max(1, rows // SAMPLE_DOCS)
    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0).limit(2 * SAMPLE_DOCS)
    # at most 2 * SAMPLE_DOCS arrays of SAMPLE_IDS ids
    samples = sorted(r.ids for r in sample.mapInArrow(lambda b: _sample_ids(b, tokenizer), "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


@lru_cache(maxsize=4)
def _codec(dictionary: bytes):
    import zstandard

    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data), zstandard.ZstdDecompressor(dict_data=data)


class _Block:
    """Documents that are being gathered, compressed one by one."""

    def __init__(self, compress, dict_hash: str):
        self._compress, self._hash = compress, dict_hash
        self.number, self.before = 0, 0
        self._clear()

    def _clear(self) -> None:
        self.ids, self.counts, self.parts, self.size = [], [], [], 0

    def add(self, doc_id, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.parts.append(self._compress(ids))
        self.size += len(self.parts[-1])

    def ended(self, of: int, id_type: pa.DataType) -> pa.RecordBatch:
        """The block's row; ``starts`` counts from the start of the range."""
        ends = np.cumsum(self.counts)
        starts = self.before + ends - self.counts
        offsets = np.cumsum([0, *map(len, self.parts)])
        longs = pa.list_(pa.int64())
        row = [
            ("range", of, pa.int64()), ("block", self.number, pa.int32()), ("dict_hash", self._hash, pa.string()),
            ("first_id", self.ids[0], id_type), ("last_id", self.ids[-1], id_type), ("n_tokens", ends[-1], pa.int64()),
            ("doc_ids", self.ids, pa.list_(id_type)), ("starts", starts, longs), ("counts", self.counts, longs),
            ("offsets", offsets, longs), ("payload", b"".join(self.parts), pa.binary()),
        ]
        self.number, self.before = self.number + 1, self.before + int(ends[-1])
        self._clear()
        return pa.RecordBatch.from_arrays([pa.array([v], t) for _, v, t in row], names=[n for n, _, _ in row])


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end: int, dictionary) -> Iterator[pa.RecordBatch]:
    """Documents of one range, in order, become blocks; the task's number is the range's."""
    vocabulary = Vocabulary.at(path)
    closing = np.array([end], dtype="<u4").tobytes()
    block = _Block(_codec(dictionary.value)[0].compress, sha256(dictionary.value).hexdigest())
    of, kind = TaskContext.get().partitionId(), pa.null()
    for batch in batches:
        kind = batch.column("doc_id").type
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            block.add(doc_id, vocabulary.bare_ids(text.as_py()) + closing)
            if block.size >= BLOCK_BYTES:
                yield block.ended(of, kind)
    if block.ids:
        yield block.ended(of, kind)


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write all documents in ascending order of their ids below ``path`` (blocks/, ranges/, dictionary/).

    A null or empty text is the end id alone. Repeated ids follow each other in the order of a hash of their texts,
    null ids come first; ids of any type with an order will do. A text of any length is one entry of one block. An
    input without rows gives a file without blocks. Further columns are not read.
    """
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col)
    rows = docs.count()
    dictionary = train_dictionary(texts, tokenizer, rows)
    dict_hash = sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, dictionary)], "dict_hash string, dictionary binary").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/dictionary")

    # rows of one id, of one text even, can fill many ranges
    order = ["doc_id", "text_hash", "row_key"]
    dealt = (
        texts.withColumns({"text_hash": F.xxhash64("text"), "row_key": F.monotonically_increasing_id()})
        .repartitionByRange(max(1, -(-rows // RANGE_DOCS)), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    shared = spark.sparkContext.broadcast(dictionary)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    dealt.mapInArrow(lambda b: _blocks(b, tokenizer, end_id, shared), BLOCKS.format(id=id_type)).write.mode(
        "overwrite"
    ).parquet(f"{path}/blocks")

    # tokens before each range: inside groups of ranges, then over the groups
    totals = spark.read.parquet(f"{path}/blocks").groupBy("range").agg(F.sum("n_tokens").alias("n"))
    totals = totals.withColumn("group", F.floor(F.col("range") / GROUP_RANGES))
    groups = totals.groupBy("group").agg(F.sum("n").alias("of_group"))
    groups = groups.withColumn("before", F.sum("of_group").over(Window.orderBy("group")) - F.col("of_group"))
    inner = F.sum("n").over(Window.partitionBy("group").orderBy("range")) - F.col("n")
    totals.withColumn("inner", inner).join(groups, "group").select(
        "range", (F.col("before") + F.col("inner")).alias("base")
    ).write.mode("overwrite").parquet(f"{path}/ranges")


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, object]:
    """The blocks with ``starts`` that count from the start of the file, and the dictionary."""
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row
    entry = spark.read.parquet(f"{path}/dictionary").first()
    if sha256(bytes(entry.dictionary)).hexdigest() != entry.dict_hash:
        raise ValueError("dictionary does not match its hash")
    bases = spark.read.parquet(f"{path}/ranges")
    # a row of 16 bytes for RANGE_DOCS documents; beyond the bound the join shuffles
    bases = F.broadcast(bases) if bases.count() <= BROADCAST_NAMES else bases
    placed = blocks.join(bases, "range").withColumn("starts", F.transform("starts", lambda x: x + F.col("base")))
    return placed.select("dict_hash", "doc_ids", "starts", "counts", "offsets", "payload"), spark.sparkContext.broadcast(
        bytes(entry.dictionary)
    )


def _decode(batches: Iterator[pa.RecordBatch], dictionary, ids_too: bool) -> Iterator[pa.RecordBatch]:
    decompress = _codec(dictionary.value)[1].decompress
    dict_hash = sha256(dictionary.value).hexdigest()
    for batch in batches:
        for row in range(batch.num_rows):
            if batch.column("dict_hash")[row].as_py() != dict_hash:
                raise ValueError("block written with another dictionary")
            payload = batch.column("payload")[row].as_buffer()
            counts = batch.column("counts")[row].values
            offsets = batch.column("offsets")[row].as_py()
            sums, kept = [], []
            for at, end, n in zip(offsets, offsets[1:], counts.to_pylist()):
                ids = decompress(payload[at:end])
                if len(ids) != 4 * n:
                    raise ValueError("document of another length than its index says")
                sums.append(zlib.crc32(ids))
                if ids_too:
                    kept.append(ids)
            columns = {
                "doc_id": batch.column("doc_ids")[row].values, "start": batch.column("starts")[row].values,
                "n_tokens": counts, "ids_crc32": pa.array(sums, pa.int64()),
            }
            if ids_too:
                columns["ids"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def _decoded(spark: SparkSession, path: str, ids_too: bool) -> DataFrame:
    blocks, shared = _opened(spark, path)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids_too
    return blocks.mapInArrow(lambda b: _decode(b, shared, ids_too), schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Columns (doc_id, start, n_tokens, ids_crc32, ids): ids as little-endian 32-bit integers, read back from the file."""
    return _decoded(spark, path, True)


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Columns (doc_id, start, n_tokens, ids_crc32) of all documents, decoded and summed up where they are read."""
    return _decoded(spark, path, False)


def read_document(spark: SparkSession, path: str, doc_id) -> bytes | None:
    """Ids of one document, by its block's offsets; None if the file has no such id. The first of repeated ids."""
    blocks = spark.read.parquet(f"{path}/blocks").filter((F.col("first_id") <= doc_id) | F.col("first_id").isNull())
    blocks = blocks.filter((F.col("last_id") >= doc_id) & F.array_contains("doc_ids", doc_id))
    place = F.array_position("doc_ids", doc_id).cast("int")
    part = F.expr(
        "substring(payload, cast(offsets[place - 1] + 1 as int), cast(offsets[place] - offsets[place - 1] as int))"
    )
    found = blocks.withColumn("place", place).orderBy("range", "block").select(part.alias("blob"), "dict_hash").first()
    if found is None:
        return None
    entry = spark.read.parquet(f"{path}/dictionary").first()
    if entry.dict_hash != found.dict_hash:
        raise ValueError("block written with another dictionary")
    return _codec(bytes(entry.dictionary))[1].decompress(bytes(found.blob))


@query("op8_token_files")
def op8_token_files(spark, directory):
    import public_tokenizers

    path = scratch_path(spark, "token-file")
    write_tokens(table(spark, directory, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return read_checksums(spark, path)
