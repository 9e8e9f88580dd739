"""Benchmark decontamination (2): SimHash of item-sized windows, multi-index Hamming search, exact verification.

Only DataFrame functions. An item of n words is a weighted set of five-word shingles (the weight is how often it
occurs) and so is every window of n words of a document. A window is worth a fingerprint only if so many of its
shingles occur in items of n words that it can reach the threshold, wherever they stand: parts of an item in another
order count like any others. These windows and the items get 64-bit SimHashes. Cut into RADIUS + 1 blocks, two fingerprints within the
radius agree in a block at least, so a join on (size, block number, block value) returns all of them. What it returns
is verified by the exact weighted Jaccard similarity.

At similarity 0.8 a fingerprint differs in about 10 of 64 bits (standard deviation 3), so the radius of 19 loses
about one pair in a thousand there and none of equal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import BLANKS, query, stored, table

SHINGLE = 5
THRESHOLD = 0.8
BITS = 64
RADIUS = 19
#: Rows of the item side (some 50 bytes each) up to which a join sends it to every executor.
BROADCAST_ROWS = 500_000


def _words(text: Column) -> Column:
    plain = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, f"[{BLANKS}]+"))


def _digest(text: Column) -> Column:
    """Tells apart different texts under one id."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _shingles(words: str, size: int) -> Column:
    """Hashes of all shingles of ``size`` words, in order; empty where there are fewer words."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return F.expr(
        f"if(size({words}) < {size}, cast(array() as array<bigint>), "
        f"transform(sequence(0, size({words}) - {size}), i -> xxhash64({parts})))"
    )


def _simhash(hashes: str) -> Column:
    """Bit b is set if it is set in more than half of the shingles, each as often as it occurs."""
    ones = f"aggregate({hashes}, 0, (n, h) -> n + cast(shiftrightunsigned(h, b) & 1 as int))"
    return F.expr(
        f"aggregate(sequence(0, {BITS - 1}), 0L, "
        f"(f, b) -> f | if(2 * {ones} > size({hashes}), shiftleft(1L, b), 0L))"
    )


def _blocks(fingerprint: str) -> Column:
    """The values of the RADIUS + 1 blocks of a fingerprint."""
    edges = [BITS * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    return F.array(
        *[
            F.shiftrightunsigned(F.col(fingerprint), low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("long"))
            for low, high in zip(edges, edges[1:])
        ]
    )


def _in_common(a: str, b: str) -> Column:
    """Size of the intersection of two weighted sets."""
    times = "size(filter({0}, x -> x = h))".format
    return F.expr(f"aggregate(array_distinct({a}), 0, (n, h) -> n + least({times(a)}, {times(b)}))")


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Items with their number of words, shingle length and shingles; an item without words is left out."""
    words = benchmark.select(F.col(id_col).alias("item_id"), _words(F.col(text_col)).alias("words")).filter(
        F.size("words") > 0
    )
    sized = words.withColumn("n_words", F.size("words")).withColumn("length", F.least("n_words", F.lit(SHINGLE)))
    choice = F.lit(None).cast("array<bigint>")
    for length in range(1, SHINGLE + 1):
        choice = F.when(F.col("length") == length, _shingles("words", length)).otherwise(choice)
    return sized.select("item_id", "n_words", "length", choice.alias("item")).withColumn("item_print", _simhash("item"))


def _small(frame: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def _starts(texts: DataFrame, places: DataFrame, rows: int, threshold: float) -> DataFrame:
    """(doc_id, digest, n_words, n_shingles, aligned, others): starts of all windows that may reach the threshold.

    ``places``: (hash, place, n_words, n_shingles) of the items. A similarity of ``threshold`` between w and n_shingles
    shingles takes at least ``least`` shared ones. Of the sorted shared positions, those from number i - least + 1 to
    number i lie in the windows that start between the i-th less w - 1 and the first of them. ``aligned`` are the
    starts of this kind with a shared shingle at the same place in both.
    """
    spread = texts.select("doc_id", "digest", F.size("hashes").alias("total"), F.posexplode_outer("hashes").alias("p", "hash"))
    at = F.greatest(F.lit(0), F.least(F.col("p") - F.col("place"), F.col("total") - F.col("n_shingles")))
    share = threshold / (1 + threshold)
    met = (
        spread.join(_small(places, rows), "hash")
        .groupBy("doc_id", "digest", "total", "n_words", "n_shingles")
        .agg(F.sort_array(F.collect_set("p")).alias("shared"), F.collect_set(at).alias("places"))
        .withColumn("w", F.least("total", "n_shingles"))
        .withColumn("least", F.ceil((F.col("w") + F.col("n_shingles")) * F.lit(share) - F.lit(1e-6)).cast("int"))
        .filter(F.size("shared") >= F.col("least"))
    )
    starts = F.expr(
        "array_distinct(flatten(transform("
        "filter(sequence(least - 1, size(shared) - 1), i -> shared[i] - shared[i - least + 1] < w), "
        "i -> sequence(greatest(0, shared[i] - w + 1), least(shared[i - least + 1], total - w)))))"
    )
    return met.withColumn("starts", starts).filter(F.size("starts") > 0).select(
        "doc_id", "digest", "n_words", "n_shingles",
        F.array_intersect("starts", "places").alias("aligned"), F.array_except("starts", "places").alias("others"),
    )


def _windows(texts: DataFrame, starts: DataFrame, rows: int) -> DataFrame:
    """Distinct (doc_id, digest, n_words, start, aligned, window); the texts of documents with starts are read again."""
    ours = starts.withColumnsRenamed({"doc_id": "of", "digest": "of_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))
    of_kind = F.expr(
        "concat(transform(aligned, s -> struct(s as start, true as aligned)), "
        "transform(others, s -> struct(s as start, false as aligned)))"
    )
    found = texts.join(_small(ours, rows), same).select(
        "doc_id", "digest", "n_words", "n_shingles", "hashes", F.explode_outer(of_kind).alias("at")
    )
    window = F.slice("hashes", F.col("at.start") + 1, F.col("n_shingles"))
    return found.select("doc_id", "digest", "n_words", "at.start", "at.aligned", window.alias("window")).dropDuplicates(
        ["doc_id", "digest", "n_words", "start"]
    )


def _matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame | None:
    """Columns (doc_id, digest, item_id, start, aligned, n_words, similarity) of all windows that match; None without items."""
    items = stored(_items(benchmark, item_id_col, item_text_col).distinct(), "items")
    # at most five values
    lengths = sorted(r.length for r in items.select("length").distinct().collect())
    pairs = None
    for length in lengths:
        own = items.filter(F.col("length") == length)
        places = own.select(
            F.posexplode("item").alias("place", "hash"), "n_words", F.size("item").alias("n_shingles")
        ).distinct()
        texts = docs.select(
            F.col(id_col).alias("doc_id"), _digest(F.col(text_col)).alias("digest"), _words(F.col(text_col)).alias("words")
        ).select("doc_id", "digest", _shingles("words", length).alias("hashes"))
        # tables of their own: filters further on would otherwise repeat the fingerprints' expressions
        starts = stored(_starts(texts, places, places.count(), threshold), "starts")
        windows = stored(
            _windows(texts, starts, starts.count()).withColumn("print", _simhash("window")), "windows"
        )
        probes = windows.select("*", F.posexplode_outer(_blocks("print")).alias("block", "value"))
        keys = own.select(
            "item_id", "n_words", "item", "item_print", F.posexplode_outer(_blocks("item_print")).alias("block", "value")
        )
        near = probes.join(_small(keys, own.count() * (RADIUS + 1)), ["n_words", "block", "value"]).filter(
            F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
        )
        shared = near.withColumn("shared", _in_common("item", "window"))
        scored = shared.withColumn(
            "similarity", F.col("shared") / (F.size("item") + F.size("window") - F.col("shared"))
        ).filter(F.col("similarity") >= threshold)
        found = scored.select("doc_id", "digest", "item_id", "start", "aligned", "n_words", "similarity")
        pairs = found if pairs is None else pairs.unionByName(found)
    return pairs


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Columns (doc_id, item_id, start, n_words, similarity): the best window of each document for each item.

    Words are what lies between ASCII white space, in lower case. An item of fewer than five words is one shingle of
    all its words; a document shorter than the item is one window. Of equally good windows the first aligned one
    counts, else the first. Null, empty and wordless texts and items match nothing; repeated rows of a document give its pairs once, repeated items
    each their own id's pairs once. Empty tables give no rows. The longest texts are single rows.
    """
    pairs = _matches(docs, benchmark, id_col, text_col, item_id_col, item_text_col, threshold)
    if pairs is None:
        empty = docs.select(F.col(id_col).alias("doc_id")).filter("false")
        return empty.join(
            benchmark.select(F.col(item_id_col).alias("item_id")).filter("false"), F.lit(False)
        ).select("doc_id", "item_id", F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit(0.0).alias("similarity"))
    best = F.max(F.struct("similarity", "aligned", (-F.col("start")).alias("back"), "n_words")).alias("best")
    return pairs.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.back")).alias("start"), F.col("best.n_words").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose texts match no item, all columns as they were; texts that share an id are judged one by one."""
    pairs = _matches(docs, benchmark, id_col, text_col)
    if pairs is None:
        return docs
    bad = pairs.select(F.struct("doc_id", "digest").alias("bad")).distinct()
    row = F.struct(F.col(id_col).alias("doc_id"), _digest(F.col(text_col)).alias("digest"))
    return docs.join(bad, row.eqNullSafe(F.col("bad")), "left_anti")


LEAK_SQL = r"""
WITH dw AS (
  SELECT doc_id, trim(lower(coalesce(text, '')), E' \t\n\x0b\x0c\r') AS t FROM documents),
d AS (SELECT doc_id, string_split_regex(t, '[\x20\x09-\x0D]+') AS w FROM dw WHERE t <> ''),
iw AS (SELECT DISTINCT item_id, trim(lower(coalesce(text, '')), E' \t\n\x0b\x0c\r') AS t FROM benchmark),
i AS (SELECT item_id, string_split_regex(t, '[\x20\x09-\x0D]+') AS w FROM iw WHERE t <> ''),
ds AS (
  SELECT doc_id, len(w) - 4 AS total, p, array_to_string(w[p + 1:p + 5], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS p FROM d WHERE len(w) >= 5)),
items AS (
  SELECT item_id, len(w) AS n_words, len(w) - 4 AS n_shingles, o, array_to_string(w[o + 1:o + 5], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(len(w) - 4)) AS o FROM i WHERE len(w) >= 5)),
windows AS (
  SELECT DISTINCT doc_id, n_words, n_shingles, greatest(0, least(p - o, total - n_shingles)) AS start
  FROM ds JOIN items USING (s)),
bags AS (
  SELECT w.doc_id, n_words, start, s, count(*) AS n
  FROM windows w JOIN ds ON ds.doc_id = w.doc_id AND p >= start AND p < start + n_shingles
  GROUP BY ALL),
sizes AS (SELECT doc_id, n_words, start, sum(n) AS n FROM bags GROUP BY ALL),
item_bags AS (SELECT item_id, n_words, s, count(*) AS n FROM items GROUP BY ALL),
item_sizes AS (SELECT item_id, n_words, max(n_shingles) AS n FROM items GROUP BY ALL),
shared AS (
  SELECT b.doc_id, i.item_id, b.n_words, b.start, sum(least(b.n, i.n)) AS c
  FROM bags b JOIN item_bags i ON b.s = i.s AND b.n_words = i.n_words GROUP BY ALL),
scored AS (
  SELECT h.doc_id, h.item_id, h.start, h.n_words,
    CAST(c AS DOUBLE) / CAST(z.n + y.n - c AS DOUBLE) AS similarity
  FROM shared h
  JOIN sizes z ON h.doc_id = z.doc_id AND h.n_words = z.n_words AND h.start = z.start
  JOIN item_sizes y ON h.item_id = y.item_id)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(n_words AS INTEGER) AS n_words, similarity
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1"""


@query("op2_decontamination", LEAK_SQL)
def op2_decontamination(spark, directory):
    return contaminated(table(spark, directory, "documents"), table(spark, directory, "benchmark"))
