"""SentencePiece encoding and decoding (11): every piece keeps the byte span of the source that it stands for.

A text is normalised here, not in the library: at each place the longest key of the model's compiled character map
is replaced, else one character is taken over, and each normalised byte remembers the source byte it came from. The
library's merges then run on the normalised text (a copy of the model whose own normaliser does nothing), and the
lengths of the pieces lead through that alignment back to source spans.

No piece of a vocabulary that was trained on split words holds a word mark behind another character, so merges never
cross from one word into the next: words are encoded once a worker and remembered, and the spans of a text are sums
over its words. A vocabulary with such pieces is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from struct import unpack_from

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelmood.llm.base import query, table, texts_of

MARK = "▁"
#: Words that a worker remembers, and the longest of them in characters: some 30 MB.
REMEMBERED = 120_000
REMEMBERED_LENGTH = 48

PIECES = pa.schema(
    [("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]
)


class CharMap:
    """A compiled character map: a double array over UTF-8 keys, then the replacements, each closed by a zero byte."""

    def __init__(self, blob: bytes):
        size = unpack_from("<I", blob)[0] if blob else 0
        self._units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self._strings = blob[4 + size :]

    def __bool__(self) -> bool:
        return bool(self._units)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest key at a place of the text and its replacement; (0, b"") where there is none."""
        units, length, value = self._units, 0, 0
        node = _offset(units[0])
        for i in range(at, len(data)):
            byte = data[i]
            node ^= byte
            if node >= len(units) or units[node] & 0x800000FF != byte:
                break
            unit = units[node]
            node ^= _offset(unit)
            if unit >> 8 & 1:
                length, value = i + 1 - at, units[node] & 0x7FFFFFFF
        if not length:
            return 0, b""
        return length, self._strings[value : self._strings.index(b"\0", value)]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class PieceModel:
    """One model file: normaliser with alignment, merges by the library, spans, decoding by the library."""

    _open: dict[str, "PieceModel"] = {}

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as spec

        self.library = SentencePieceProcessor(model_proto=proto)
        model = spec.ModelProto()
        model.ParseFromString(proto)
        rules = model.normalizer_spec
        self._map = CharMap(rules.precompiled_charsmap)
        self._prefix, self._squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        self._space = (MARK if rules.escape_whitespaces else " ").encode()
        self._suffix = model.trainer_spec.treat_whitespace_as_suffix
        kinds = spec.ModelProto.SentencePiece
        kept = [p.piece for p in model.pieces if p.type == kinds.USER_DEFINED]
        self._kept = re.compile("|".join(map(re.escape, sorted(kept, key=len, reverse=True))).encode()) if kept else None
        self._plain = not (self._map or self._squeeze or self._kept)

        rules.precompiled_charsmap, rules.add_dummy_prefix, rules.remove_extra_whitespaces = b"", False, False
        self._merges = SentencePieceProcessor(model_proto=model.SerializeToString())
        self._sizes = np.array([len(p.piece.encode()) for p in model.pieces])
        self._byte = np.array([int(p.piece[3:5], 16) if p.type == kinds.BYTE else -1 for p in model.pieces])
        text_pieces = [p.piece for p in model.pieces if p.type != kinds.CONTROL]
        self._by_word = self._space == MARK.encode() and not self._suffix and model.trainer_spec.byte_fallback
        self._by_word &= not any(re.search(f"[^{MARK}]{MARK}", p) for p in text_pieces)
        self._words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self._memory: dict[str, bytes] = {}

    @classmethod
    def at(cls, path: str) -> "PieceModel":
        """One instance a worker."""
        if path not in cls._open:
            with open(path, "rb") as file:
                cls._open[path] = cls(file.read())
        return cls._open[path]

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source byte it came from."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int64)
        if self._plain:
            return self._normalise_plain(text, data)
        out, align, at = bytearray(), [], 0

        def step() -> tuple[int, bytes]:
            if self._kept and (found := self._kept.match(data, at)):
                return found.end() - at, found.group()
            length, put = self._map.longest(data, at) if self._map else (0, b"")
            if not length:
                length = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                put = data[at : at + length]
            return length, put

        def append(put: bytes) -> None:
            out.extend(put)
            align.extend([at] * len(put))

        if self._squeeze:
            while at < len(data) and (found := step())[1] == b" ":
                at += found[0]
            if at == len(data):
                return "", np.array([at], np.int64)
        if self._prefix and not self._suffix:
            append(self._space)
        after_space = self._squeeze
        while at < len(data):
            length, put = step()
            if after_space:
                put = put.lstrip(b" ")
            if put:
                append(put.replace(b" ", self._space))
                after_space = put.endswith(b" ")
            at += length
            after_space &= self._squeeze
        if self._squeeze:
            while out.endswith(self._space):
                at = align[len(out) - len(self._space)]
                del out[-len(self._space) :], align[-len(self._space) :]
        if self._prefix and self._suffix:
            append(self._space)
        return out.decode(), np.array([*align, at], np.int64)

    def _normalise_plain(self, text: str, data: bytes) -> tuple[str, np.ndarray]:
        space = self._space.decode()
        before, after = (space if self._prefix and on else "" for on in (not self._suffix, self._suffix))
        widths = np.where(np.frombuffer(data, np.uint8) == 0x20, len(self._space), 1)
        align = np.repeat(np.arange(len(data)), widths)
        ends = [np.full(len(x.encode()), at) for x, at in ((before, 0), (after, len(data)))]
        return before + text.replace(" ", space) + after, np.concatenate([ends[0], align, ends[1], [len(data)]])

    def _lengths(self, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes of each piece; of a character's byte pieces the last has its length, the others none."""
        sizes, byte = self._sizes[ids], self._byte[ids]
        if (byte >= 0).any():
            sizes[byte >= 0] = 0
            first = np.flatnonzero((byte >= 0) & (byte & 0xC0 != 0x80))
            width = 1 + (byte[first] >= 0xC0) + (byte[first] >= 0xE0) + (byte[first] >= 0xF0)
            sizes[first + width - 1] = width
        return sizes

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words, made in one call: words that begin with a mark do not touch each other's merges."""
        joined = [w for w in words if w[0] == MARK != w[-1]]
        new = {w: np.array(self._merges.encode_as_ids(w), "<u4").tobytes() for w in words if not w[0] == MARK != w[-1]}
        ids = np.array(self._merges.encode_as_ids("".join(joined)), "<u4")
        ends = np.cumsum([len(w.encode()) for w in joined])
        cuts = 4 * np.searchsorted(np.cumsum(self._lengths(ids)), ends, "right")
        raw, at = ids.tobytes(), 0
        for word, cut in zip(joined, cuts.tolist()):
            new[word], at = raw[at:cut], cut
        for word, part in new.items():
            if len(self._memory) >= REMEMBERED:
                break
            if len(word) <= REMEMBERED_LENGTH:
                self._memory[word] = part
        return new

    def _merged(self, normalised: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a normalised text and the normalised bytes of each."""
        if not self._by_word:
            pieces = self._merges.encode(normalised, return_type="proto").pieces
            return np.array([p.id for p in pieces], "<u4"), np.array([p.end - p.begin for p in pieces], np.int64)
        words = self._words.findall(normalised)
        parts = list(map(self._memory.get, words))
        if None in parts:
            new = self._learn(list(dict.fromkeys(w for w, p in zip(words, parts) if p is None)))
            parts = [new[w] if p is None else p for w, p in zip(words, parts)]
        ids = np.frombuffer(b"".join(parts), "<u4")
        return ids, self._lengths(ids)

    def encode(self, text: str, begin: bool = True, end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and the source byte span (start, end) of each; begin and end ids stand for empty spans."""
        normalised, align = self.normalise(text)
        ids, sizes = self._merged(normalised)
        ends = np.cumsum(sizes, dtype=np.int64)
        head, tail = ([i] if on else [] for i, on in ((self.library.bos_id(), begin), (self.library.eos_id(), end)))
        at = len(text.encode())
        return (
            np.concatenate([head, ids, tail]).astype("<u4"),
            np.concatenate([[0] * len(head), align[ends - sizes], [at] * len(tail)]).astype(np.int64),
            np.concatenate([[0] * len(head), align[ends], [at] * len(tail)]).astype(np.int64),
        )

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def _encoded(batch: pa.RecordBatch, path: str, begin: bool, end: bool) -> Iterator[tuple[str, tuple]]:
    model = PieceModel.at(path)
    for text in batch.column("text"):
        text = text.as_py()
        yield text, model.encode(text, begin, end)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, begin: bool, end: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [pieces for _, pieces in _encoded(batch, path, begin, end)]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]), pa.int32())
        flat = [np.concatenate([x[k] for x in found]) if found else [] for k in range(3)]
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, f.type.value_type, safe=False)) for v, f in zip(flat, PIECES)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", *PIECES.names])


def _digests(batches: Iterator[pa.RecordBatch], path: str, begin: bool, end: bool) -> Iterator[pa.RecordBatch]:
    decode = PieceModel.at(path).decode
    for batch in batches:
        rows = []
        for text, (ids, starts, ends) in _encoded(batch, path, begin, end):
            size = len(text.encode())
            whole = bool(np.array_equal(starts[1:], ends[:-1])) and ends[-1:].tolist() in ([], [size])
            decoded = decode(ids).encode()
            rows.append((len(ids), sha256(ids.tobytes()).hexdigest(), sha256(decoded).hexdigest(), size, whole))
        columns = list(zip(*rows)) or [[]] * 5
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "spans_whole"],
        )


def encode_pieces(
    docs: DataFrame, model: str, begin: bool = True, end: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns (doc_id, ids, starts, ends), one row for each input row; spans count bytes of the UTF-8 text.

    The spans of a text follow each other without gap or overlap, but for white space that the model's normaliser
    removes; of a character's byte pieces the last has its span, the others are empty, as in the library. A null or
    empty text has the begin and end ids alone. Repeated rows and ids give their own rows, a null id stays null, no
    rows give no rows. Texts of any length are encoded whole; further columns are not read. The model file must
    exist on every worker.
    """
    texts = texts_of(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        lambda b: _pieces(b, model, begin, end),
        f"doc_id {id_type}, ids array<int>, starts array<bigint>, ends array<bigint>",
    )


def _texts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    decode = PieceModel.at(path).library.decode
    for batch in batches:
        texts = pa.array([None if x is None else decode(x) for x in batch.column("ids").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])


def decode_pieces(pieces: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Columns (doc_id, text) of id arrays, by the library's decoding; null ids give a null text, no ids an empty one."""
    slim = pieces.select(pieces[id_col].alias("doc_id"), pieces[ids_col].alias("ids"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(lambda b: _texts(b, model), f"doc_id {id_type}, text string")


def piece_digests(
    docs: DataFrame, model: str, begin: bool = True, end: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """What ``encode_pieces`` and ``decode_pieces`` give, as digests made in the task that encodes.

    Columns (doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, spans_whole), the last true where the spans
    follow each other from the first to the last byte; all cases as there.
    """
    texts = texts_of(docs, id_col, text_col)
    kinds = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    kinds += [("n_bytes", T.LongType()), ("spans_whole", T.BooleanType())]
    schema = T.StructType([texts.schema["doc_id"], *[T.StructField(n, k) for n, k in kinds]])
    return texts.mapInArrow(lambda b: _digests(b, model, begin, end), schema)


@query("op11_piece_codec")
def op11_piece_codec(spark, directory):
    import public_tokenizers

    return piece_digests(table(spark, directory, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
