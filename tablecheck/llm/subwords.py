"""Subword ids of texts by a public tokenizer file, remembered word by word.

The tokenizer drops white space and never joins across it, so a text's ids are those
of its white-space separated chunks. Each worker keeps the ids of chunks it has seen,
up to a number of bytes, and asks the library for new ones only. Chunks that could be
read otherwise out of their text (special tokens) are left to the library whole.
"""

from __future__ import annotations

import re
from array import array

import public_tokenizers
from tokenizers import Tokenizer

from tablecheck.llm.common import Memory

WORD_BPE = "word_bpe_49k.json"
WORD_BPE_SIZE = 49_408
KEPT_BYTES = 64 << 20  # of chunks, and of their runs
LONGEST_KEPT = 48

_RUNS = re.compile(rb"[a-z]+|[^a-z]+")
_LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else one above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = str.maketrans({chr(b): letter for b, letter in _byte_letters().items()})


class WordBpe(Memory):
    """Little-endian unsigned 32-bit ids of a text; as a dict, those of its chunks."""

    _known: dict[str, WordBpe] = {}

    def __init__(self, path: str) -> None:
        super().__init__("subwords", KEPT_BYTES)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.runs = Memory("subwords", KEPT_BYTES)

    @classmethod
    def of(cls, path: str | None = None) -> WordBpe:
        """The worker's own, so that what it remembers serves later tasks too."""
        path = path or public_tokenizers.path(WORD_BPE)
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    def ids(self, text: str) -> bytes:
        if "<|" in text:
            return self._library(text)
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))

    def __missing__(self, chunk: bytes) -> bytes:
        found = self._chunk(chunk)
        if len(chunk) <= LONGEST_KEPT:
            self.keep(chunk, found, len(chunk) + len(found))
        return found

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        if latin := _LATIN.fullmatch(text):  # letters of Latin-1, then ASCII without apostrophes
            letters = self._run(latin[1].lower(), True)
            return letters + self._run(latin[2], False) if latin[2] else letters
        if chunk.isascii() and b"'" not in chunk:  # else contractions
            runs = _RUNS.findall(chunk.lower())
            return b"".join([self._run(run.decode(), run.isalpha()) for run in runs])
        return self._library(text)

    def _run(self, run: str, letters: bool) -> bytes:
        """Ids of one run; letters in lower case need neither normalising nor splitting."""
        found = self.runs.get(run)
        if found is None:
            if letters and len(run) <= LONGEST_KEPT:
                mapped = run if run.isascii() else run.encode().decode("latin-1").translate(_BYTES)
                found = _packed([token.id for token in self.model.tokenize(mapped)])
            else:
                found = self._library(run)
            if len(run) <= LONGEST_KEPT:
                self.runs.keep(run, found, len(run) + len(found))
        return found

    def _library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()
