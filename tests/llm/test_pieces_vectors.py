"""Piece codec, hard negatives and whitening against the library and against brute force."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelmood.llm import hard_negatives as H
from parcelmood.llm.piece_codec import PieceModel, decode_pieces, encode_pieces, piece_digests
from parcelmood.llm.whitening import bit_planes, fit_whitening, scatter, whiten

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a", " a ", "Hello  world", "日本語 テキスト", "ñandú 🎉🎉 x", "\t\n x\r\n", "▁x▁ ▁▁y", "a\0b", "<s> </s> <unk> <0x0A>",
    "x" * 5000, "ﬁ ① é é  Å Ａ  ｶﾞ　 z", "word " * 3000 + "🎉",
]


def _random_texts(count):
    rng = random.Random(1)
    signs = "ab  ▁é日🎉\n\t<s>0x0A１ﬁ①é　 ﾞｶ"
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(count)]


def _same_as_library(own, library, texts):
    for text in texts:
        expected = library.encode(text, return_type="proto", add_bos=False, add_eos=False).pieces
        ids, starts, ends = own.encode(text, False, False)
        assert ids.tolist() == [p.id for p in expected], text[:80]
        assert starts.tolist() == [p.begin for p in expected], text[:80]
        assert ends.tolist() == [p.end for p in expected], text[:80]
        assert own.encode(text)[0].tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_pieces_and_spans_are_the_librarys():
    import sentencepiece

    _same_as_library(PieceModel.at(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL), TEXTS + _random_texts(1500))


@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("suffix", [False, True])
def test_longest_prefixes_of_a_compiled_map(squeeze, prefix, suffix):
    """The library's own map of Unicode forms, put into the model file's normaliser."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as spec

    rules, model = spec.ModelProto(), spec.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.add_dummy_prefix = squeeze, prefix
    model.trainer_spec.treat_whitespace_as_suffix = suffix
    proto = model.SerializeToString()
    _same_as_library(PieceModel(proto), sentencepiece.SentencePieceProcessor(model_proto=proto), TEXTS + _random_texts(300))


def test_piece_frames(spark, odd_docs, no_docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    pieces = encode_pieces(odd_docs, MODEL)
    assert pieces.columns == ["doc_id", "ids", "starts", "ends"]
    expected = sorted(((i, library.encode(t or "", add_bos=True, add_eos=True)) for i, t in texts), key=repr)
    got = pieces.collect()
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == expected
    # spans cut the text: what they hold, put together, is the text
    whole = {(r.doc_id, tuple(r.ids)): r for r in got}
    for i, text in texts:
        data = (text or "").encode()
        row = whole[i, tuple(library.encode(text or "", add_bos=True, add_eos=True))]
        assert b"".join(data[a:b] for a, b in zip(row.starts, row.ends)) == data
    decoded = sorted(((r.doc_id, r.text) for r in decode_pieces(pieces, MODEL).collect()), key=repr)
    assert decoded == sorted(((i, library.decode(x)) for i, x in expected), key=repr)
    digests = piece_digests(odd_docs, MODEL).collect()
    assert all(r.spans_whole for r in digests)
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == sorted(
        (len(x), sha256(np.array(x, "<u4").tobytes()).hexdigest(), sha256(library.decode(x).encode()).hexdigest())
        for _, x in expected
    )
    for empty in (encode_pieces(no_docs, MODEL), piece_digests(no_docs, MODEL), decode_pieces(pieces.limit(0), MODEL)):
        assert empty.count() == 0


def _brute_negatives(rows, positives=5, negatives=3):
    """rows: (id, label, vector, asks). All pairs, in order of score, id and place."""
    kept = []
    for key, (i, label, v, asks) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((key, H.LAST_ID if i is None else i, label, [int(np.floor(256 * x)) for x in v], asks))
    out = []
    for key, i, label, v, asks in kept:
        if not asks:
            continue
        score = sorted((-sum(a * b for a, b in zip(v, w)), j, k, m) for k, j, m, w, _ in kept if k != key)
        for s, j, _, _ in [x for x in score if x[3] == label][:positives]:
            fits = [x for x in score if x[3] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, None if j == H.LAST_ID else j, r, None if f[1] == H.LAST_ID else f[1], -s, -f[0]) for r, f in enumerate(fits, 1)]
    return sorted(out, key=repr)


VECTOR_ROWS = "vec_id bigint, label int, embedding array<float>, key string, id int, score int, block int, rank int"


def _vector_frame(spark, rows):
    return spark.createDataFrame([(i, m, v, "k", 1, 2, 3, 4) for i, m, v, _ in rows], VECTOR_ROWS)


def test_negatives_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 6))
    rows = []
    for i in range(400):
        v = (centres[i % 4] + 0.4 * rng.normal(size=6)).astype("f4").round(2).tolist()
        rows.append([i, int(rng.integers(3)), v, i % 20 == 0])
    rows[5][1], rows[6][2], rows[7][2], rows[8][2] = None, None, [None, 1.0], [float("nan"), 1.0]
    rows[9][2], rows[10][2], rows[11][2], rows[12][0] = [float("inf")], [], [2.0, 1.0], None
    # ties, repeated rows, and one vector that holds a third of all
    rows += [[1000 + i, i % 2, [1.0, 1.0, 0.5, 0.0, 0.0, 0.25], i % 50 == 0] for i in range(200)]
    rows += [list(rows[20]), list(rows[20]), list(rows[1])]
    asks = F.col("vec_id").isNotNull() & F.when(F.col("vec_id") < 1000, F.col("vec_id") % 20 == 0).otherwise(F.col("vec_id") % 50 == 0)
    found = H.mine_negatives(_vector_frame(spark, rows), asks)
    assert sorted(map(tuple, found.collect()), key=repr) == _brute_negatives([(i, m, v, a and i is not None) for i, m, v, a in rows])


def test_negatives_without_rows_or_anchors(spark):
    frame = _vector_frame(spark, [(1, 0, [1.0], False), (2, 1, [1.0], False)])
    assert H.mine_negatives(frame, F.lit(False)).collect() == []
    assert H.mine_negatives(frame, F.lit(True)).collect() == []
    assert H.mine_negatives(frame.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize("dims", [2, 3, 8])
def test_pruned_buckets_lose_nothing(monkeypatch, dims):
    """Small buckets in one process: the search with pruning, and how much it leaves out."""
    monkeypatch.setattr(H, "BUCKET_ROWS", 64)
    rng = np.random.default_rng(dims)
    count = 1500
    v = rng.normal(size=(count, dims)) * rng.exponential(size=(count, 1))
    names = ["key", "id", "label", "vector", "length"]
    source = pa.RecordBatch.from_pydict(
        {"key": range(count), "id": rng.permutation(count), "label": rng.integers(0, 3, count), "vector": v.tolist()}
    )
    (rows,) = H._lengths(iter([source]), 256.0, ["key", "id", "label"])
    rows = rows.select(names).take(pa.array(np.argsort(-np.array(rows["length"].to_pylist()))))
    index = list(H._buckets(iter([rows]), names))
    listed = rows.to_pylist()
    asks = listed[:: 30]
    block = H.Block(
        np.array([r["key"] for r in asks]), np.array([r["label"] for r in asks]), H._matrix([r["vector"] for r in asks]),
        True, 4, np.full((len(asks), 1), -(2**62)), np.full((len(asks), 1), 2**62),
    )
    looked, real = [], H._candidates
    monkeypatch.setattr(H, "_candidates", lambda *a: (looked.append(out := real(*a)), out)[1])
    (found,) = H._search(iter(index), type("Shared", (), {"value": block}))
    got = sorted((r["anchor_key"], -r["score"], r["id"]) for r in found.to_pylist())
    vectors = {r["key"]: np.frombuffer(r["vector"], "<i8") for r in listed}
    expected = []
    for a in asks:
        scores = sorted(
            (-int(vectors[a["key"]] @ vectors[r["key"]]), r["id"]) for r in listed if r["key"] != a["key"] and r["label"] == a["label"]
        )
        expected += [(a["key"], *s) for s in scores[:4]]
    assert got == sorted(expected)
    if dims < 8:
        assert any(left for _, left in looked)


def test_planes_count_cross_products():
    rng = np.random.default_rng(0)
    x = rng.integers(-500, 900, size=(1000, 5))
    low, bits = x.min(axis=0), 11
    counts = np.zeros((5, 5, 2 * bits), np.int64)
    scatter(bit_planes(x, low, bits), 5, bits, counts)
    got = (counts << np.arange(2 * bits)).sum(axis=2)
    expected = (x - low).T @ (x - low)
    assert (np.triu(got) == np.triu(expected)).all()


def test_whitening_is_that_of_all_rows(spark):
    rng = np.random.default_rng(2)
    mix = rng.normal(size=(6, 6))
    vectors = [(0.2 * rng.normal(size=6) @ mix).astype("f4").tolist() for _ in range(300)] + [[0.5] * 6] * 120 + [[0.25, 0.5]]
    rows = [(i, 0, v, None) for i, v in enumerate(vectors)] + [(3, 0, vectors[3], None), (None, 0, vectors[4], None)]
    odd = [(900, 0, None, None), (901, 0, [None] * 6, None), (902, 0, [float("nan")] * 6, None), (903, 0, [float("-inf")] + [0.0] * 5, None)]
    got = whiten(_vector_frame(spark, rows + odd)).toPandas()
    x = np.array([np.floor(1024 * np.array(r[2] + [0.0] * (6 - len(r[2])))) for r in rows]).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    values, unit = np.linalg.eigh((x - sums / n).T @ (x - sums / n) / n)
    white = ((x - sums / n) @ unit / np.sqrt(values))[:, ::-1]
    assert len(got) == 6 * n and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    for c in range(6):
        own = got[got.component == c + 1]
        assert np.allclose(own.explained, values[::-1][c] / values.sum())
        expected, found = np.sort(white[:, c]), np.sort(own.whitened)
        assert min(abs(expected - found).max(), abs(np.sort(-expected) - found).max()) < 1e-8
    deviations = sorted(sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x)
    assert sorted(map(int, got[got.component == 1].deviation)) == deviations


def test_whitening_without_spread_and_with_wide_entries(spark):
    same = _vector_frame(spark, [(i, 0, [1.0, 2.0], None) for i in range(5)])
    assert whiten(same).count() == 0 and whiten(same.limit(0)).count() == 0 and whiten(same.limit(1)).count() == 0
    flat = _vector_frame(spark, [(i, 0, [float(i), 2.0 * i], None) for i in range(5)])
    assert {r.component for r in whiten(flat).collect()} == {1}
    wide = _vector_frame(spark, [(1, 0, [1e9, 0.0], None), (2, 0, [-1e9, 5.0], None), (3, 0, [0.0, -5.0], None)])
    fit = fit_whitening(wide.select(F.col("embedding").alias("vector")))
    x = np.array([[1024 * int(1e9), 0], [-1024 * int(1e9), 5120], [0, -5120]], object) + 100_000
    assert fit.sums == x.sum(axis=0).tolist()
    assert fit.deviation(x.astype(np.int64)) == [sum((3 * int(a) - s) ** 2 for a, s in zip(r, fit.sums)) for r in x]
