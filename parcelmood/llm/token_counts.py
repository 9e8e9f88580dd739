"""Token counts (1): pieces are counted once per distinct pre-token, never by making ids of a text.

A document becomes its pre-token frequencies. The most frequent pre-tokens of the corpus (at most ``HEAD``, a
bounded table) are resolved where the document is read; all others, rare by definition and so without a hot key,
join a table of piece counts that the library fills once per distinct pre-token.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import query, stored, table, texts_of
from parcelmood.llm.tokens import Vocabulary

#: Pre-tokens resolved on the spot: a bound of about 2 MB on what every worker gets.
HEAD = 131_072
#: One document in so many, by the hash of its id, serves to choose the head. It decides about speed alone.
HEAD_ONE_IN = 16
LIMIT = 1024


def _frequencies(batches: Iterator[pa.RecordBatch], path: str, head: dict[str, int]) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary.at(path)
    get = head.get
    for batch in batches:
        known, words, counts = [], [], []
        for text in batch.column("text").to_pylist():
            cut, total = vocabulary.pre_tokens(text)
            rest = []
            for word, n in Counter(cut).items():
                pieces = get(word)
                if pieces is None:
                    rest.append((word, n))
                else:
                    total += n * pieces
            known.append(total)
            words.append([w for w, _ in rest])
            counts.append([n for _, n in rest])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_key"),
                batch.column("doc_id"),
                batch.column("n_bytes"),
                pa.array(known, pa.int64()),
                pa.array(words, pa.list_(pa.string())),
                pa.array(counts, pa.list_(pa.int32())),
            ],
            names=["row_key", "doc_id", "n_bytes", "known", "words", "counts"],
        )


def _word_counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    cut = Vocabulary.at(path).pre_tokens
    for batch in batches:
        seen: Counter[str] = Counter()
        for text in batch.column("text").to_pylist():
            seen.update(cut(text)[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"]
        )


def _piece_counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    count = Vocabulary.at(path).piece_count
    for batch in batches:
        words = batch.column("word")
        pieces = pa.array([count(w) for w in words.to_pylist()], pa.int32())
        yield pa.RecordBatch.from_arrays([words, pieces], names=["word", "pieces"])


def count_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Columns (doc_id, n_bytes, n_tokens, over_limit), one row for each input row.

    A null or empty text has 0 bytes and 0 tokens. A repeated row or id gives its own row each time, a null id
    stays null. No rows give no rows. The tokenizer file must exist on every worker; one that normalises texts, or
    whose special strings take in white space around them, is refused, as its pre-tokens are no parts of a text.
    """
    if not Vocabulary.at(tokenizer).as_written:
        raise ValueError(f"{tokenizer}: pre-tokens are not parts of the text")
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()

    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(HEAD_ONE_IN)) == 0).select("text")
    common = (
        sample.mapInArrow(lambda b: _word_counts(b, tokenizer), "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word").limit(HEAD)
        .select("word").mapInArrow(lambda b: _piece_counts(b, tokenizer), "word string, pieces int")
    )
    # at most HEAD rows
    head = spark.sparkContext.broadcast({r.word: r.pieces for r in common.collect()})

    frequencies = stored(
        texts.select(
            F.monotonically_increasing_id().alias("row_key"), "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text"
        ).mapInArrow(
            lambda b: _frequencies(b, tokenizer, head.value),
            f"row_key bigint, doc_id {id_type}, n_bytes bigint, known bigint, words array<string>, counts array<int>",
        ),
        "frequencies",
    )
    rare = frequencies.select("row_key", F.explode(F.arrays_zip("words", "counts")).alias("f")).select(
        "row_key", F.col("f.words").alias("word"), F.col("f.counts").alias("n")
    )
    pieces = rare.select("word").distinct().mapInArrow(
        lambda b: _piece_counts(b, tokenizer), "word string, pieces int"
    )
    sums = rare.join(pieces, "word").groupBy("row_key").agg(F.sum(F.col("n") * F.col("pieces")).alias("rest"))
    total = (F.col("known") + F.coalesce("rest", F.lit(0))).cast("long")
    return (
        frequencies.select("row_key", "doc_id", "n_bytes", "known")
        .join(sums, "row_key", "left")
        .select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
    )


@query("op1_token_counts")
def op1_token_counts(spark, directory):
    import public_tokenizers

    return count_tokens(table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
