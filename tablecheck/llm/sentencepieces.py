"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is encoded as the BPE model does: white space becomes a mark, and an agenda of
candidate merges, the best score first and the leftmost of equals, is worked off. With
dropout, every candidate that comes up in an occurrence of a word is skipped by itself with
the chance ``rate``: the numbers of candidates between skips are drawn from a geometric
distribution by hashes keyed by seed, row key and the occurrence's number in the text. So
any occurrence may be cut in any way, and any run of a seed gives the same ids. A worker
remembers how words are cut without skips, up to a number of bytes, and nothing of words
with skips. New words and those with skips, of many texts, work off their agendas together,
one candidate of each word a step, as rows of an array; very long words, and words with
characters that are no pieces, do so one by one over a heap, with the same ids. Rate 0 gives
the library's own ids.

No piece joins across the beginning of white space or a line break (checked when the model
is loaded), so words are encoded by themselves; characters without a piece become bytes.
Every segmentation decodes to the text: a literal mark is written as bytes.

Edge cases: a null text encodes to null, and null ids decode to null; the empty text has no
ids; null row keys count as 0; equal rows are encoded alike; very long texts are encoded
whole, word by word; ids out of range and control ids decode to nothing; an empty table
gives no rows; other columns stay as they are (the new column replaces one of its name).
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import zlib
from collections.abc import Callable, Collection, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import Memory, turn_of

PIECE_BPE = "piece_bpe_32k.model"
MARK = "▁"
KEPT_BYTES = 64 << 20
LONGEST_KEPT = 48
CHARS_AT_ONCE = 1 << 19  # of texts, whose words are cut together
ROWS_AT_ONCE = 8192
TEXTS_AT_ONCE = 256  # as Python objects
NEVER = np.iinfo(np.int32).max
_WORDS = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


class _Slots:
    """Places of different numbers from 0 in their row, by an open table of eight times as
    many slots or more: a number is in its hash's slot, or in a later one before an empty."""

    def __init__(self, numbers: np.ndarray) -> None:
        bits = (8 * len(numbers) + 8).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.numbers = np.full(1 << bits, -1, np.int64)
        self.at = np.full(1 << bits, len(numbers), np.int32)
        waiting, slots = np.arange(len(numbers)), self._slots(numbers)
        while len(waiting):
            free = self.numbers[slots] < 0
            self.numbers[slots[free]] = numbers[waiting[free]]  # the last of those that meet
            placed = self.numbers[slots] == numbers[waiting]
            self.at[slots[placed]] = waiting[placed]
            waiting, slots = waiting[~placed], (slots[~placed] + 1) & self.last

    def _slots(self, numbers: np.ndarray) -> np.ndarray:
        mixed = numbers.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed >>= self.shift
        return mixed.view(np.int64)

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """Places of any numbers from 0; how many there are, for numbers that are none of them."""
        slots = self._slots(numbers)
        there, found = self.numbers.take(slots), self.at.take(slots)
        others = np.nonzero((there != numbers) & (there >= 0))
        if not len(others[0]):
            return found
        slots, numbers = slots[others], numbers[others]
        out = np.empty(len(numbers), found.dtype)
        waiting = np.arange(len(numbers))
        while len(waiting):
            slots = (slots + 1) & self.last
            there = self.numbers[slots]
            done = (there == numbers) | (there < 0)
            out[waiting[done]] = self.at[slots[done]]
            waiting, slots, numbers = waiting[~done], slots[~done], numbers[~done]
        found[others] = out
        return found


class PieceBpe:
    """Merges of one model and the words seen with them."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                if len(piece) > 1 and (MARK in piece.lstrip(MARK) or "\n" in piece):
                    raise ValueError("the model's pieces go across words")
                self.ids[piece] = i
                self.scores[piece] = -model.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        self.mark_bytes = self._packed([self.byte_ids[b] for b in MARK.encode()])
        self.none = len(self.surface)
        self.by_code = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.by_code[ord(piece)] = i
        pairs = sorted(
            (self._pair(self.ids[piece[:k]], self.ids[piece[k:]]), self.scores[piece], i)
            for piece, i in self.ids.items()
            for k in range(1, len(piece))
            if piece[:k] in self.ids and piece[k:] in self.ids
        )
        self.slots = _Slots(np.array([pair for pair, _, _ in pairs], np.int64))
        _, ranks = np.unique(np.array([score for _, score, _ in pairs]), return_inverse=True)
        self.ranks = np.append(ranks, NEVER).astype(np.int32)
        self.merged = np.array([i for _, _, i in pairs] + [self.none], np.int32)
        # a rank tells the merged piece, unless pieces share its score
        self.by_rank = np.full(len(pairs), self.none, np.int32)
        self.by_rank[ranks] = self.merged[:-1]
        self.shared = np.zeros(len(pairs), bool)
        self.shared[ranks[self.by_rank[ranks] != self.merged[:-1]]] = True

    def _pair(self, first, second):
        return first * (self.none + 1) + second

    def _found(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Places of pairs of ids in ``ranks``; the last place, of none, for the others."""
        return self.slots.places(self._pair(first.astype(np.int64), second))

    def letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words' characters in a row, how many each word has, and the words that
        fit an array: not very long, and without characters that are no pieces."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        ids = self.by_code[codes]
        wide = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        starts = np.cumsum(sizes) - sizes
        known = np.minimum.reduceat(ids, starts) >= 0
        return ids, sizes, known & (np.add.reduceat(wide, starts) <= LONGEST_KEPT)

    def cut_all(
        self,
        letters: np.ndarray,
        sizes: np.ndarray,
        due: np.ndarray,
        gaps: Callable[[np.ndarray, np.ndarray], np.ndarray],
    ) -> tuple[list[bytes], np.ndarray]:
        """Packed ids of many words and how many these are, in the words' order, from the ids
        of their characters in a row."""
        found, counts = [b""] * len(sizes), np.empty(len(sizes), np.int64)
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(sizes, kind="stable")  # so that arrays are little wider than words
        for first in range(0, len(order), ROWS_AT_ONCE):
            rows = order[first : first + ROWS_AT_ONCE]
            wide = np.arange(sizes[rows[-1]] + 1)
            inside = wide < sizes[rows][:, None]
            at = np.where(inside, starts[rows][:, None] + wide, 0)
            parts, kept = self.segment_all(
                np.where(inside, letters[at], np.int32(self.none)), sizes[rows], due[rows],
                lambda own, n: gaps(rows[own], n),
            )
            counts[rows] = kept
            data, start = parts[wide < kept[:, None]].astype("<u4").tobytes(), 0
            for row, end in zip(rows.tolist(), (np.cumsum(kept) * 4).tolist()):
                found[row] = data[start:end]
                start = end
        return found, counts

    def segment_all(
        self,
        parts: np.ndarray,
        sizes: np.ndarray,
        due: np.ndarray,
        gaps: Callable[[np.ndarray, np.ndarray], np.ndarray],
    ) -> tuple[np.ndarray, np.ndarray]:
        """``segment`` of many words at once: their ids and how many these are.

        A row of ``parts`` holds a word's ids by character and ``none`` after them, once at
        least. ``due`` is the number of the first candidate to be skipped, ``gaps(rows, n)``
        how many come up after the n-th skip of a row and before its next.
        """
        out, kept = parts.copy(), sizes.copy()
        rows, parts, sizes, due = np.arange(len(parts)), parts.copy(), sizes.copy(), due.copy()
        ranks = np.full(parts.shape, NEVER, np.int32)
        ranks[:, :-1] = self.ranks[self._found(parts[:, :-1], parts[:, 1:])]
        skipped = np.zeros(len(rows), np.int64)
        columns, number = np.arange(parts.shape[1] - 1), 0
        while len(rows):
            at = ranks.argmin(axis=1)
            live = ranks[np.arange(len(rows)), at] < NEVER
            if not live.all():
                done = ~live
                out[rows[done]], kept[rows[done]] = parts[done], sizes[done]
                rows, parts, ranks, sizes, due, skipped, at = (
                    x[live] for x in (rows, parts, ranks, sizes, due, skipped, at)
                )
                if not len(rows):
                    break
            skip = due == number
            here = np.flatnonzero(skip)
            if len(here):
                ranks[here, at[here]] = NEVER
                skipped[here] += 1
                due[here] += 1 + gaps(rows[here], skipped[here])
            here = np.flatnonzero(~skip)
            flat_parts, flat_ranks = parts.reshape(-1), ranks.reshape(-1)  # the same arrays
            i = at[here]
            place = here * parts.shape[1] + i
            rank = flat_ranks.take(place)
            whole = self.by_rank[rank]
            asked = np.flatnonzero(self.shared[rank])
            if len(asked):
                pair = flat_parts[place[asked]], flat_parts[place[asked] + 1]
                whole[asked] = self.merged[self._found(*pair)]
            moved = columns > np.where(skip, len(columns), at)[:, None]
            parts[:, :-1] = np.where(moved, parts[:, 1:], parts[:, :-1])
            ranks[:, :-1] = np.where(moved, ranks[:, 1:], ranks[:, :-1])
            flat_parts[place] = whole
            flat_ranks[place] = self.ranks.take(self._found(whole, flat_parts.take(place + 1)))
            before = i > 0
            last, whole = place[before] - 1, whole[before]
            flat_ranks[last] = self.ranks.take(self._found(flat_parts.take(last), whole))
            sizes[here] -= 1
            number += 1
        return out, kept

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def segment(self, word: str, skips: Collection[int] = ()) -> tuple[int, list[int]]:
        """How many merges come up in one word, and its ids; those whose numbers are in
        ``skips`` are skipped."""
        parts = list(word)
        last = len(parts)
        left, right = list(range(-1, last - 1)), list(range(1, last + 1))
        scores = self.scores
        agenda = []
        for i in range(last - 1):
            score = scores.get(merged := parts[i] + parts[i + 1])
            if score is not None:
                agenda.append((score, i, merged))
        heapq.heapify(agenda)
        number = -1
        while agenda:
            _, i, merged = heapq.heappop(agenda)
            j = right[i]
            if j >= last or not parts[i] or parts[i] + parts[j] != merged:
                continue
            number += 1
            if number in skips:
                continue
            parts[i], parts[j] = merged, ""
            right[i] = after = right[j]
            if after < last:
                left[after] = i
                score = scores.get(merged := parts[i] + parts[after])
                if score is not None:
                    heapq.heappush(agenda, (score, i, merged))
            before = left[i]
            if before >= 0:
                score = scores.get(merged := parts[before] + parts[i])
                if score is not None:
                    heapq.heappush(agenda, (score, before, merged))
        out: list[int] = []
        for part in parts:
            if part:
                found = self.ids.get(part)
                if found is None:
                    out.extend(self.byte_ids[b] for b in part.encode("utf-8", "replace"))
                else:
                    out.append(found)
        return number + 1, out

    def decode(self, ids: np.ndarray) -> str:
        surface = self.surface
        known = ids[(ids >= 0) & (ids < len(surface))].tolist()
        data = b"".join([surface[i] for i in known])
        return data.removeprefix(b" ").decode("utf-8", "replace")


class Dropout:
    """Encoder of one model, rate and seed, with its memory in ``shares`` parts of all."""

    _known: dict[tuple, Dropout] = {}

    def __init__(self, path: str, rate: float, seed: int, shares: int = 1) -> None:
        self.bpe = PieceBpe(path)
        self.rate = rate
        self.seed = seed
        self.plain = _Words(self.bpe, KEPT_BYTES // max(1, shares))

    @classmethod
    def of(cls, *settings) -> Dropout:
        """The worker's own for these settings."""
        if settings not in cls._known:
            cls._known[settings] = cls(*settings)
        return cls._known[settings]

    def encode(self, text: str, row_key: int) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        return next(self.encode_all([text], [row_key]))

    def encode_all(
        self, texts: Iterable[str | None], row_keys: Iterable[int]
    ) -> Iterator[bytes | None]:
        """The ids of each text, in order; of a null text, null."""
        waiting, size = [], 0
        for text, row_key in zip(texts, row_keys):
            waiting.append((None if text is None else self._words(text), row_key))
            size += 1 + len(text or "")
            if size >= CHARS_AT_ONCE:
                yield from self._encoded(waiting)
                waiting, size = [], 0
        yield from self._encoded(waiting)

    @staticmethod
    def _words(text: str) -> list[list[str]]:
        """The words of a text, of each stretch between its literal marks."""
        return [
            _WORDS.findall((MARK if n == 0 else "") + stretch.replace(" ", MARK))
            for n, stretch in enumerate(text.split(MARK) if text else [])
        ]

    def _encoded(self, waiting: list[tuple]) -> Iterator[bytes | None]:
        every = (words for stretches, _ in waiting for words in stretches or [])
        self.plain.learn(set(itertools.chain.from_iterable(every)))
        skips: list[tuple] = []
        cut = [None if words is None else self._text(words, key, skips) for words, key in waiting]
        self._segment_all(skips)
        for ids in cut:
            yield None if ids is None else b"".join(ids)

    def _text(self, stretches: list[list[str]], row_key: int, skips: list) -> list[bytes]:
        """Ids of a text word by word. Words with skips are not cut yet, but added to
        ``skips`` with their places in this list."""
        out: list[bytes] = []
        number = 0
        base = xxhash.xxh3_64_intdigest(row_key.to_bytes(8, "little", signed=True), self.seed)
        for n, words in enumerate(stretches):
            if n:
                out.append(self.bpe.mark_bytes)
            if not words:
                continue
            merges, ids, letters = zip(*map(self.plain.__getitem__, words))
            start = len(out)
            out.extend(ids)
            if self.rate > 0:
                self._skips(words, merges, letters, out, start, base, number, skips)
            number += len(words)
        return out

    def _skips(
        self,
        words: list,
        merges: tuple,
        letters: tuple,
        out: list,
        start: int,
        base: int,
        number: int,
        skips: list,
    ) -> None:
        """Find the words that have a skip, and cut those at once that don't fit an array."""
        due = self._gaps(base, np.arange(number, number + len(words)), 0)
        active = np.flatnonzero(due < np.array(merges, np.int64))
        fit = []
        for at in active.tolist():
            if letters[at] is not None:
                fit.append(at)
                continue
            every = np.arange(3 * len(words[at]))  # no word has three times its candidates
            gaps = self._gaps(base, np.full(len(every), number + at), every)
            cut = self.bpe.segment(words[at], set((np.cumsum(gaps + 1) - 1).tolist()))[1]
            out[start + at] = PieceBpe._packed(cut)
        if fit:
            at = np.array(fit)
            own = [letters[i] for i in fit]
            skips.append((out, (start + at).tolist(), number + at, due[at], own, base))

    def _segment_all(self, skips: list[tuple]) -> None:
        """Cut the words that have skips, and put their ids in their places."""
        if not skips:
            return
        letters = [each for *_, part, _ in skips for each in part]
        sizes = np.fromiter(map(len, letters), np.int64, len(letters)) // 4
        counts = [len(part[1]) for part in skips]
        base = np.repeat(np.array([part[5] for part in skips], np.uint64), counts)
        occurrence = np.concatenate([part[2] for part in skips])
        found, _ = self.bpe.cut_all(
            np.frombuffer(b"".join(letters), "<u4").astype(np.int32),
            sizes,
            np.concatenate([part[3] for part in skips]),
            lambda rows, n: self._gaps(base[rows], occurrence[rows], n),
        )
        at = 0
        for out, places, *_ in skips:
            for place in places:
                out[place] = found[at]
                at += 1

    def _gaps(
        self, base: int | np.ndarray, occurrences: np.ndarray, skips: int | np.ndarray
    ) -> np.ndarray:
        """How many candidates come up before the next skip, for each occurrence."""
        if self.rate >= 1:
            return np.zeros(len(occurrences), np.int64)
        with np.errstate(over="ignore"):
            x = occurrences.astype(np.uint64) + np.asarray(base, np.uint64)
            x += np.asarray(skips, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
        chance = ((x >> np.uint64(11)) + np.uint64(1)) * 2.0**-53
        return np.minimum(np.log(chance) / math.log1p(-self.rate), 2.0**40).astype(np.int64)


class _Words(Memory):
    """Merges that come up in a word without skips, its ids, and those of its characters
    if they fit an array."""

    def __init__(self, bpe: PieceBpe, most: int) -> None:
        super().__init__("sentencepieces", most)
        self.bpe = bpe

    def __missing__(self, word: str) -> tuple[int, bytes, bytes | None]:
        self.learn({word})
        if word in self:
            return self[word]
        merges, ids = self.bpe.segment(word)
        found = merges, PieceBpe._packed(ids), None
        size = len(word.encode("utf-8", "replace"))
        return self.keep(word, found, 100 + size + len(found[1])) if size <= LONGEST_KEPT else found

    def learn(self, words: set[str]) -> None:
        """Remember all of the words that fit an array, together."""
        new = [word for word in words if word not in self]
        if self.used + len(new) * (self.ENTRY_BYTES + 150) > self.most:
            self.clear()
            self.used, new = 0, list(words)
        if not new:
            return
        letters, sizes, fit = self.bpe.letters(new)
        letters, sizes = letters[np.repeat(fit, sizes)], sizes[fit]
        found, counts = self.bpe.cut_all(letters, sizes, np.full(len(sizes), -1), lambda rows, n: n)
        data, ends = letters.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
        merges = (sizes - counts).tolist()
        own = [
            data[start:end] if count else None
            for start, end, count in zip([0, *ends], ends, merges)
        ]
        kept = zip(itertools.compress(new, fit.tolist()), zip(merges, found, own))
        size = (self.ENTRY_BYTES + 100) * len(sizes) + 4 * int(counts.sum() + sizes.sum())
        if self.used + size <= self.most:
            self.used += size
            self.update(kept)
            return
        for word, (count, ids, part) in kept:
            self.keep(word, (count, ids, part), 100 + len(ids) + len(part or b""))



def encode(
    df: DataFrame,
    rate: float = 0.1,
    seed: int = 1,
    key_col: str = "doc_id",
    text_col: str = "text",
    to: str = "ids",
    model: str | None = None,
) -> DataFrame:
    """``df`` with the ids of its texts as array<int> in column ``to``.

    Spark is told that the function is not deterministic, though it is: else it would run it
    once more for each use of the ids by another function.
    """

    def ids(texts: pa.Array, keys: pa.Array) -> pa.Array:
        turn_of("sentencepieces")
        encoder = Dropout.of(model or public_tokenizers.path(PIECE_BPE), rate, seed)
        return _lists(encoder.encode_all(_values(texts), _values(keys)))

    encoded = F.arrow_udf(ids, "array<int>").asNondeterministic()
    key = F.coalesce(field(key_col).cast("long"), F.lit(0))
    return df.withColumn(to, encoded(field(text_col).cast("string"), key))


def decode(
    df: DataFrame, ids_col: str = "ids", to: str = "decoded", model: str | None = None
) -> DataFrame:
    """``df`` with the texts of its ids in column ``to``."""

    def texts(ids: pa.Array) -> pa.Array:
        bpe = Dropout.of(model or public_tokenizers.path(PIECE_BPE), 0.0, 0).bpe
        found = (None if x is None else bpe.decode(x) for x in _arrays(ids))
        parts = [pa.array([], pa.string())]
        while part := list(itertools.islice(found, TEXTS_AT_ONCE)):
            parts.append(pa.array(part, pa.string()))
        return pa.concat_arrays(parts)

    return df.withColumn(to, F.arrow_udf(texts, "string")(field(ids_col)))


def _values(column: pa.Array) -> Iterator:
    """The values of a column, few at once as Python objects."""
    for at in range(0, len(column), TEXTS_AT_ONCE):
        yield from column.slice(at, TEXTS_AT_ONCE).to_pylist()


def _arrays(lists: pa.Array) -> Iterator[np.ndarray | None]:
    """Each row's ids, as views of the column; a null id counts as -1, which is none."""
    flat = lists.values.fill_null(-1).to_numpy(zero_copy_only=False)
    offsets, null = lists.offsets.to_pylist(), lists.is_null().to_pylist()
    for start, end, missing in zip(offsets, offsets[1:], null):
        yield None if missing else flat[start:end]


def _lists(rows: Iterable[bytes | None]) -> pa.Array:
    """A column of lists from the packed ids of each row."""
    data, ends, null = bytearray(), [0], []
    for row in rows:
        data += row or b""
        ends.append(len(data) // 4)
        null.append(row is None)
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.frombuffer(data, "<i4")),
        mask=pa.array(null, pa.bool_()),
    )


def ids_crc32(ids: Column) -> Column:
    """crc32 of ids as little-endian unsigned 32-bit numbers."""

    def digest(values: pa.Array) -> pa.Array:
        found = [None if x is None else zlib.crc32(x.astype("<i4")) for x in _arrays(values)]
        return pa.array(found, pa.int64())

    return F.arrow_udf(digest, "long")(ids)
