"""MinHash near-dedup (5): SetSketch registers, banded, estimated jointly by likelihood, then verified exactly.

1. Every document gets a digest of its words and, from its shingles, ``BANDS * ROWS`` registers of one byte.
   Documents with the same words form a class, of which one goes on; copies cost nothing from here.
2. Documents whose registers agree in a band meet. A meeting is a star around its smallest member, a row for each
   other member, never all pairs. Rays whose likelihood speaks against any kinship are taken off and meet again
   without that centre, until none is left. The stars' components are the clusters.
3. A cluster is compared in blocks of ``BLOCK`` documents, two blocks at a time. A pair that is not yet connected
   there and whose estimate passes is confirmed on the full sets. Only links that connect something new are kept, so
   the result grows with the documents, not with the pairs.
4. Components of the links are the groups.

Two sets at the threshold of 0.8 share a band with probability over 0.9998; the estimate's margin of five standard
deviations loses less than one pair in a million.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import BLANKS, BROADCAST_NAMES, ascii_lower, keep_all_but, query, stored, table, texts_of
from parcelmood.llm.components import components
from parcelmood.llm.setsketch import SetSketch, slope

BANDS = 50
ROWS = 8
#: Percent of the union that the intersection must reach.
THRESHOLD = 80
#: Rays of a star below this estimate are no kin of its centre.
KIN = 0.35
BLOCK = 512
#: Words whose hashes a worker remembers.
REMEMBERED = 400_000

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < REMEMBERED:
            self[word] = value
        return value


_HASHES = _Hashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER) if not text.isascii() else text.lower())


def shingle_hashes(words: list[str], size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, in order; the whole sequence as one when there are fewer words."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    joined = np.full(count, np.uint64(size))
    for k in range(size):
        joined = _mixed(joined * _GOLDEN + hashes[k : k + count])
    return np.unique(joined)


def _profiles(batches: Iterator[pa.RecordBatch], size: int, sketch: SetSketch) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, counts, registers = [], [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            hashes = shingle_hashes(words, size)
            digests.append(sha256(" ".join(words).encode("utf-8", "surrogatepass")).digest()[:16])
            counts.append(len(hashes))
            registers.append(sketch.sketch(hashes).tobytes() if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                batch.column("doc_id"),
                batch.column("raw"),
                pa.array(digests, pa.binary()),
                pa.array(counts, pa.int64()),
                pa.array(registers, pa.binary()),
            ],
            names=["node", "doc_id", "raw", "digest", "n_shingles", "registers"],
        )


def _registers(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _kin(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = _registers(batch.column("registers_a")), _registers(batch.column("registers_b"))
        sizes = [batch.column(c).to_numpy() for c in ("size_a", "size_b")]
        kin = _slopes(a, b, *sizes, least) > 0
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(kin)], names=["a", "b", "kin"]
        )


def _slopes(a: np.ndarray, b: np.ndarray, n_a, n_b, at: float) -> np.ndarray:
    greater, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    return slope(greater, less, a.shape[1] - greater - less, n_a, n_b, at)


def _alike(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= threshold * (len(a) + len(b) - shared)


def links_within(
    nodes: list[int], sets: list[np.ndarray], registers: np.ndarray, threshold: int = THRESHOLD
) -> list[tuple[int, int]]:
    """A spanning forest of the confirmed links among a block's documents."""
    order = sorted(range(len(nodes)), key=lambda i: nodes[i])
    sizes = np.array([len(s) for s in sets])
    group = np.arange(len(nodes))
    width = registers.shape[1]
    margin = threshold / 100 - 5 * (threshold / 100 * (1 - threshold / 100) / width) ** 0.5
    links = []
    for at, i in enumerate(order):
        rest = np.array([j for j in order[at + 1 :] if group[j] != group[i]], dtype=np.int64)
        if not len(rest):
            continue
        fits = 100 * np.minimum(sizes[rest], sizes[i]) >= threshold * np.maximum(sizes[rest], sizes[i])
        rest = rest[fits]
        if not len(rest):
            continue
        rest = rest[_slopes(registers[rest], registers[i][None, :], sizes[rest], sizes[i], margin) > 0]
        for j in rest:
            if group[j] != group[i] and _alike(sets[i], sets[j], threshold):
                links.append((nodes[i], nodes[j]))
                group[group == group[j]] = group[i]
    return links


def _block_links(block: pa.Table, threshold: int) -> pa.Table:
    seen, nodes, rows = set(), [], []
    for row, node in enumerate(block["node"].to_pylist()):
        if node not in seen:
            seen.add(node)
            nodes.append(node)
            rows.append(row)
    blobs, registers = block["hashes"].to_pylist(), block["registers"].to_pylist()
    sets = [np.frombuffer(blobs[r], np.uint64) for r in rows]
    matrix = np.frombuffer(b"".join(registers[r] for r in rows), np.uint8).reshape(len(rows), -1)
    links = links_within(nodes, sets, matrix, threshold)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _sets(batches: Iterator[pa.RecordBatch], size: int, sketch: SetSketch) -> Iterator[pa.RecordBatch]:
    # a text that is repeated under its id comes as often as it is repeated
    seen = set()
    for batch in batches:
        keep, blobs, registers = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("node", "text", "digest"))
        for row, (node, text, digest) in enumerate(zip(*columns)):
            if node in seen:
                continue
            words = words_of(text)
            # another text with the same id and hash
            if sha256(" ".join(words).encode("utf-8", "surrogatepass")).digest()[:16] != digest:
                continue
            seen.add(node)
            keep.append(row)
            hashes = shingle_hashes(words, size)
            blobs.append(hashes.tobytes())
            registers.append(sketch.sketch(hashes).tobytes())
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(rows) for c in ("node", "root", "blocks")]
            + [pa.array(registers, pa.binary()), pa.array(blobs, pa.binary())],
            names=["node", "root", "blocks", "registers", "hashes"],
        )


def _stars(bands: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (a, b) of all stars whose rays may be kin."""
    met, found, members = None, None, bands
    while True:
        centres = members.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        rays = stored(
            members.join(centres.drop("n"), "key").filter("node != a").select("key", "a", F.col("node").alias("b")), "rays"
        )
        if met is None:
            # registers of documents that met another one, few of all; later rounds only see some of them again
            ends = rays.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            met = stored(nodes.join(ends, "node", "left_semi"), "met")
            a = met.select(*[F.col(n).alias(m) for n, m in zip(met.columns, ("a", "size_a", "registers_a"))])
            b = met.select(*[F.col(n).alias(m) for n, m in zip(met.columns, ("b", "size_b", "registers_b"))])
        pairs = rays.select("a", "b").distinct().join(b, "b").join(a, "a")
        judged = stored(pairs.mapInArrow(lambda x: _kin(x, KIN), "a bigint, b bigint, kin boolean"), "judged")
        kin = judged.filter("kin").select("a", "b")
        found = kin if found is None else found.unionByName(kin)
        strangers = judged.filter("not kin").select("a", "b")
        if strangers.isEmpty():
            return found
        members = rays.join(strangers, ["a", "b"], "left_semi").select("key", F.col("b").alias("node"))


def near_groups(
    docs: DataFrame,
    words: int = 5,
    threshold: int = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Columns (doc_id, n_shingles, component_id, kept, digest, first), one row for each input row.

    Links join documents whose sets of word shingles have a Jaccard similarity of at least ``threshold`` percent;
    component_id is the smallest id that links reach, kept marks the rows that bear it. A text without words, null
    or empty, has no shingles and no links. Repeated rows share their id and its mark. A null id sorts last: it is a
    component's id only where all ids are null, and then every row of it is kept. No rows give no rows. ``digest``
    names the sequence of words; ``first`` marks one (doc_id, digest) of each group, that with the smallest id and of
    one id the smallest digest.
    """
    texts = texts_of(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    sketch = SetSketch(bands * rows)
    raw = F.xxhash64("text")
    profiles = stored(
        texts.select(F.monotonically_increasing_id().alias("node"), "doc_id", raw.alias("raw"), "text").mapInArrow(
            lambda b: _profiles(b, words, sketch),
            f"node bigint, doc_id {id_type}, raw bigint, digest binary, n_shingles bigint, registers binary",
        ),
        "profiles",
    )
    # one class for each sequence of words
    classes = stored(
        profiles.filter("n_shingles > 0").groupBy("digest").agg(F.min(F.struct("doc_id", "node")).alias("m"))
        .select("digest", F.col("m.node").alias("node")), "classes",
    )
    nodes = stored(
        profiles.select("node", "n_shingles", "registers").join(classes.select("node"), "node", "left_semi"), "nodes"
    )
    places = F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))
    banded = nodes.select("node", "registers", places.alias("band")).select(
        F.xxhash64("band", F.expr(f"substring(registers, band * {rows} + 1, {rows})")).alias("key"), "node"
    )
    clusters = stored(components(_stars(banded, nodes)), "clusters")
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    names = profiles.select("node", F.col("doc_id").alias("of"), F.col("raw").alias("of_raw"), "digest")
    # some 60 bytes a document that met another one; texts are found by id and hash, so a null id is no hot key
    wanted = stored(
        clusters.join(sizes, "root")
        .select("node", "root", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        .join(names, "node"), "wanted",
    )
    few = wanted.count() <= BROADCAST_NAMES
    same = F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("of_raw") == raw)
    fetched = texts.join(F.broadcast(wanted) if few else wanted, same).select(
        "node", "root", "blocks", "digest", "text"
    )
    sets = fetched.mapInArrow(
        lambda b: _sets(b, words, sketch), "node bigint, root bigint, blocks int, registers binary, hashes binary"
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        sets.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node", "root", "registers", "hashes",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )
    links = stored(
        dealt.groupBy("root", "low", "high").applyInArrow(lambda t: _block_links(t, threshold), "a bigint, b bigint"),
        "links",
    )
    roots = components(links)
    rooted = classes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    grouped = stored(
        profiles.select("node", "doc_id", "digest", "n_shingles").join(rooted, "digest", "left")
        .withColumn("root", F.coalesce("root", F.col("node"))), "grouped",
    )
    # null ids last
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    smallest = grouped.groupBy("root").agg(F.min(order).alias("m"))
    smallest = smallest.select("root", F.col("m.doc_id").alias("component_id"), F.col("m.digest").alias("chosen"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return grouped.join(smallest, "root").select(
        "doc_id", "n_shingles", "component_id", kept.alias("kept"), "digest",
        (kept & (F.col("digest") == F.col("chosen"))).alias("first"),
    )


def drop_near_copies(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows with one document of each group, all columns as they were.

    Different texts under one id, null ids included, are judged one by one. Rows with one id and the same words count
    as one; texts without words are no copies unless id and text are equal.
    """
    groups = near_groups(docs, words, id_col=id_col, text_col=text_col)
    # rows with one id and the same words are in the same group, those without words each in their own and first there
    named = groups.groupBy(F.col("doc_id").alias("id"), "digest").agg(F.count_if("first").alias("copies"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = F.btrim(F.regexp_replace(ascii_lower(text), f"[{BLANKS}]+", " "))
    digest = F.substring(F.unhex(F.sha2(spaced, 256)), 1, 16)
    return keep_all_but(docs, named, [F.col(id_col), digest], ["id", "digest"], F.when(spaced == "", text))


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark, directory):
    return near_groups(table(spark, directory, "documents"), words=2).drop("digest", "first")
