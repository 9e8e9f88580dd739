"""Language ID (10): unigram pieces of a fixed public vocabulary, all segmentations of a word summed.

Training counts, for each language, the pieces that the vocabulary's own segmentation gives; these counts with
additive smoothing are the piece probabilities. A word's probability in a language is the sum over all its
segmentations into pieces, by a forward pass over its characters; a text's is the product over its words; with
the languages' shares as prior this gives the posterior.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import query, stored, table

SMOOTHING = 0.1
#: A character that no piece covers.
UNSEEN = 1e-9
#: Words whose probabilities a worker remembers, and their greatest length.
REMEMBERED = 300_000
REMEMBERED_CHARS = 48
#: New words, and words of texts, that are scored at a time: bounds of a worker's arrays.
WORDS_AT_ONCE = 20_000
TEXT_WORDS_AT_ONCE = 200_000
UNDETERMINED = "und"

_WORDS = re.compile(r"\S+")
_MARK = "▁"


def _split(text: str) -> Counter:
    return Counter(_WORDS.findall(text))


class _Pieces:
    """Piece ids of words by the vocabulary's own segmentation, remembered by word."""

    _open: dict[str, "_Pieces"] = {}

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        self.seen: dict[str, bytes] = {}

    @classmethod
    def at(cls, path: str) -> "_Pieces":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def counts(self, words: Counter) -> np.ndarray:
        """How often each piece of the vocabulary occurs in the words."""
        new = [w for w in words if w not in self.seen]
        fresh = dict(zip(new, (np.array(x, "<u4").tobytes() for x in self.processor.encode(new, num_threads=1))))
        ids = [self.seen.get(w) or fresh.get(w, b"") for w in words]
        for word, own in fresh.items():
            if len(word) <= REMEMBERED_CHARS and len(self.seen) < REMEMBERED:
                self.seen[word] = own
        times = np.repeat(np.fromiter(words.values(), float, len(words)), [len(x) // 4 for x in ids])
        return np.bincount(np.frombuffer(b"".join(ids), "<u4"), times, self.processor.get_piece_size())


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = _Pieces.at(path)
    schema = pa.schema([("lang", pa.string()), ("piece", pa.string()), ("n", pa.int64())])
    for batch in batches:
        words: dict[str, Counter] = {}
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            words.setdefault(lang, Counter()).update(_WORDS.findall(text.as_py()))
        for lang, own in words.items():
            counts = pieces.counts(own)
            at = np.flatnonzero(counts)
            names = pieces.processor.id_to_piece(at.tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(names, pa.string()), pa.array(counts[at].astype(np.int64))],
                schema=schema,
            )


class LanguageModel:
    """Languages, their log priors, and each piece's probability in every language."""

    def __init__(self, languages: list[str], priors: np.ndarray, pieces: dict[str, tuple[float, ...]], floor: tuple):
        self.languages, self.priors, self.pieces, self.floor = languages, priors, pieces, floor
        self.longest = max(map(len, pieces), default=1)
        # numbers of the pieces; beginnings of pieces that are none themselves lead on to longer ones
        self.steps = {p[:i]: -1 for p in pieces for i in range(1, len(p))} | {p: i for i, p in enumerate(pieces)}
        self.lengths = np.array([*map(len, pieces), 1])
        self.chances = np.array([*pieces.values(), floor], float).reshape(len(pieces) + 1, len(languages))

    def _arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces at all places of the words: word, start, length and number of the piece."""
        get, longest, unseen = self.steps.get, self.longest, len(self.pieces)
        numbers: list[int] = []
        ends: list[int] = []
        add, ended = numbers.append, ends.append
        for word in words:
            end = len(word)
            for start in range(end):
                # a character by itself is always a way on
                piece = get(word[start : start + 1])
                add(unseen if piece is None or piece < 0 else piece)
                if piece is not None:
                    for stop in range(start + 2, min(end, start + longest) + 1):
                        piece = get(word[start:stop])
                        if piece is None:
                            break
                        if piece >= 0:
                            add(piece)
                ended(len(numbers))
        sizes = np.array([len(w) for w in words])
        per_start = np.diff(ends, prepend=0)
        starts = np.arange(len(ends)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        owners = np.repeat(np.arange(len(words)), sizes)
        number = np.array(numbers)
        return np.repeat(owners, per_start), np.repeat(starts, per_start), self.lengths[number], number

    def words(self, words: list[str]) -> np.ndarray:
        """Log probabilities (word, language), over all segmentations of each word, for words of any length."""
        k, size = len(self.languages), self.longest + 1
        out = np.zeros((len(words), k))
        if not words:
            return out
        owner, start, length, number = self._arcs(words)
        # by place, then by length: a word has at most one piece of a kind, so that sums never collide
        order = np.lexsort((length, start))
        owner, start, length, chance = owner[order], start[order], length[order], number[order]
        cuts = np.flatnonzero(np.diff(start * (size + 1) + length)) + 1
        sizes = np.array([len(w) for w in words])
        # ways[i % size]: probability of the first i characters, for the places that a piece can reach from
        ways = np.zeros((size, len(words), k))
        ways[0] = 1.0
        at = -1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(owner)]):
            if start[low] != at:
                if at >= 0:
                    ways[at % size] = 0.0
                at = int(start[low])
                self._settle(ways, at, sizes, out)
            who = owner[low:high]
            ways[(at + int(length[low])) % size, who] += ways[at % size, who] * self.chances[chance[low:high]]
        ways[at % size] = 0.0
        self._settle(ways, at + 1, sizes, out)
        return out

    @staticmethod
    def _settle(ways: np.ndarray, at: int, sizes: np.ndarray, out: np.ndarray) -> None:
        """Take down the words that end here; scale up each word and language that has become too small."""
        here = ways[at % len(ways)]
        done = sizes == at
        if done.any():
            out[done] += np.log(np.maximum(here[done], 1e-300))
        small = (here < 1e-100) & (here > 0) & (sizes > at)[:, None]
        if small.any():
            down = np.where(small, here, 1.0)
            out += np.log(down)
            ways /= down

    def word(self, word: str) -> list[float]:
        return self.words([word])[0].tolist()


class _Scorer:
    """Scores texts with a model; remembers the words' probabilities."""

    _open: dict[str, "_Scorer"] = {}

    def __init__(self, model: LanguageModel):
        self.model, self.seen = model, {}
        self.logs = np.zeros((0, len(model.languages)))

    @classmethod
    def of(cls, key: str, model: LanguageModel) -> "_Scorer":
        if key not in cls._open:
            cls._open = {key: cls(model)}
        return cls._open[key]

    def _words(self, words: list[str]) -> np.ndarray:
        places = list(map(self.seen.get, words))
        new = sorted((w for w, p in zip(words, places) if p is None), key=len)
        found = np.zeros((len(words), len(self.model.languages)))
        known = np.array([p is not None for p in places], bool)
        found[known] = self.logs[[p for p in places if p is not None]]
        logs: list[np.ndarray] = []
        low = 0
        while low < len(new):
            # words of like length together, in groups of some hundred thousand characters
            high = low + max(1, min(WORDS_AT_ONCE, WORDS_AT_ONCE * REMEMBERED_CHARS // (8 * len(new[low]))))
            logs.append(self.model.words([_MARK + w for w in new[low:high]]))
            low = high
        if new:
            own = np.concatenate(logs)
            place = {w: i for i, w in enumerate(new)}
            found[~known] = own[[place[w] for w, p in zip(words, places) if p is None]]
            # the shortest come first
            fit = sum(len(w) <= REMEMBERED_CHARS for w in new[: max(0, REMEMBERED - len(self.seen))])
            self.seen.update(zip(new[:fit], range(len(self.logs), len(self.logs) + fit)))
            self.logs = np.concatenate([self.logs, own[:fit]]) if fit else self.logs
        return found

    def texts(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language and its probability for each text."""
        out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
        rows, places, counts, sizes, local = [], [], [], [], {}

        def score() -> None:
            logs = self._words(list(local))
            weighed = logs[places] * np.array(counts, float)[:, None]
            totals = np.add.reduceat(weighed, np.cumsum([0, *sizes[:-1]]), axis=0) + self.model.priors
            best = totals.argmax(axis=1)
            chance = 1.0 / np.exp(totals - totals.max(axis=1)[:, None]).sum(axis=1)
            for row, b, c in zip(rows, best.tolist(), chance.tolist()):
                out[row] = (self.model.languages[b], c)
            for held in (rows, places, counts, sizes, local):
                held.clear()

        for row, text in enumerate(texts):
            # isalpha: a character of category L, so no numerals
            if not self.model.languages or not any(map(str.isalpha, text)):
                continue
            words = _split(text)
            rows.append(row)
            sizes.append(len(words))
            places.extend(local.setdefault(w, len(local)) for w in words)
            counts.extend(words.values())
            if len(places) >= TEXT_WORDS_AT_ONCE:
                score()
        if rows:
            score()
        return out


def train(docs: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """A model from all rows with a text and a language.

    The counts are at most languages x vocabulary rows, both fixed with the labels and the file.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    counts = rows.mapInArrow(lambda b: _count(b, vocabulary), "lang string, piece string, n bigint")
    table_ = counts.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
    shares = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(shares)
    place = {lang: i for i, lang in enumerate(languages)}
    raw: dict[str, list[float]] = {}
    for r in table_:
        raw.setdefault(r.piece, [0.0] * len(languages))[place[r.lang]] += r.n
    sums = [sum(v[i] for v in raw.values()) + SMOOTHING * len(raw) + 1 for i in range(len(languages))]
    pieces = {p: tuple((v[i] + SMOOTHING) / sums[i] for i in range(len(languages))) for p, v in raw.items()}
    priors = np.log(np.array([shares[lang] for lang in languages], float)) if languages else np.zeros(0)
    return LanguageModel(languages, priors, pieces, (UNSEEN,) * len(languages))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns (doc_id, lang_pred, score), one row for each input row.

    A null text or one without a letter, and every text under a model without languages, is ``und`` with score 0.
    Repeated rows and null ids are predicted like others. Ties go to the language that sorts first. Words of any
    length are summed over all their segmentations. No rows give no rows, further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # names this model in workers that outlive it
    key = uuid.uuid4().hex
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer.of(key, shared.value)
        for batch in batches:
            found = scorer.texts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(score, f"doc_id {id_type}, lang_pred string, score double")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


@query("op10_language_id")
def op10_language_id(spark, directory):
    import public_tokenizers

    docs = table(spark, directory, "documents")
    model = train(docs.filter(~held_out()), public_tokenizers.path("piece_bpe_32k.model"))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
