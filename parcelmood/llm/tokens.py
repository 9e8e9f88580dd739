"""Ids and piece counts of texts by a public vocabulary, a pre-token at a time.

The library spends nearly all its time on merging pieces inside pre-tokens, and pre-tokens repeat. Texts whose
characters lie below U+0250 (whose classes no Unicode version has changed) and that hold no special string are
cut by the same rule as in the vocabulary file, all other texts by the library's own pre-tokeniser between special
strings, and the library's model is asked once per distinct pre-token. Where ids of other texts are wanted
(``bare_ids``), the library encodes them whole. The result is the library's own in any case.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

#: The workers' cores belong to Spark's tasks.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries of a worker's memory of pre-tokens; later ones are computed each time.
REMEMBERED = 400_000

_PLAIN_END = 0x250
#: Characters or strings that send a text to the library: others' classes, odd separators, special strings.
_ODD = re.compile("[^\x00-\x1b\x20-ɏ]|<\\|")


def _ranges(first_letter: str) -> str:
    codes = [i for i in range(_PLAIN_END) if unicodedata.category(chr(i))[0] == first_letter]
    return "".join(re.escape(chr(i)) for i in codes)


_L, _N, _S = _ranges("L"), _ranges("N"), "\t-\r \x85\xa0"
#: The splitting rules of the two vocabulary files, letters first as most pre-tokens are words.
SPACED_RULE = re.compile(
    f" ?[{_L}]+|'(?:[sdmt]|ll|ve|re)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
BARE_RULE = re.compile(f"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^{_S}{_L}{_N}]+")


def is_plain(text: str) -> bool:
    return _ODD.search(text) is None


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class _Memory(dict):
    """Values by key, computed when missing and remembered up to a bound."""

    def __init__(self, compute):
        super().__init__()
        self._compute = compute

    def __missing__(self, key):
        value = self._compute(key)
        if len(self) < REMEMBERED:
            self[key] = value
        return value


class Vocabulary:
    """One tokenizer file, without begin, end or added special tokens."""

    _open: dict[str, "Vocabulary"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._model = self.library.model
        self._cut = self.library.pre_tokenizer.pre_tokenize_str
        added = self.library.get_added_tokens_decoder().values()
        self._special = re.compile("|".join(re.escape(t.content) for t in added) or "(?!)")
        #: Whether pre-tokens are parts of the text as it is, and special strings end just where they end.
        self.as_written = self.library.normalizer is None and not any(t.lstrip or t.rstrip or t.single_word for t in added)
        self._pieces = _Memory(self._word_bytes)
        self._runs = _Memory(lambda run: b"".join(map(self._pieces.__getitem__, BARE_RULE.findall(run))))

    @classmethod
    def at(cls, path: str) -> "Vocabulary":
        """One instance a worker, so that tasks share what it remembers."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _word_ids(self, word: str) -> list[int]:
        return [t.id for t in self._model.tokenize(word.encode().decode("latin-1").translate(_LETTERS))]

    def _word_bytes(self, word: str) -> bytes:
        return np.array(self._word_ids(word), dtype="<u4").tobytes()

    def piece_count(self, word: str) -> int:
        """Pieces of one pre-token that the vocabulary's own rule has cut."""
        return len(self._word_ids(word))

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text by the file's own rule, and the number of special strings, a token each."""
        if is_plain(text):
            return SPACED_RULE.findall(text), 0
        parts = self._special.split(text)
        return [part[a:b] for part in parts for _, (a, b) in self._cut(part)], len(parts) - 1

    def bare_ids(self, text: str) -> bytes:
        """Ids (little-endian, 32 bits) of a whole text by the lower-casing vocabulary that drops white space."""
        if is_plain(text):
            return b"".join(map(self._runs.__getitem__, text.lower().split()))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
