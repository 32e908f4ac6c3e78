"""Passages of benchmark items in documents, found with a suffix automaton and cut out.

The items' words are read into a generalised suffix automaton, whose states stand for all
runs of words that occur in items. A document's words then stream through it: at each word
the state and the matching length say which longest run, ending here, some item holds. A
run exceeds the limits if it has ``length`` words, or covers the share ``coverage`` of an
item's words; so an item of n words needs min(length, ceil(coverage * n)) of its words in
a row. Every place in an item marks the state of its run of that length, and
the suffix links of a document's state lead to all marked runs that end at a word.

Items are dealt by hash to automata of about ``WORDS_PER_AUTOMATON`` words, built in tasks.
Longer items are cut into pieces that overlap by all but one word of a run, so no run is
lost. The driver hands one automaton after the other to the workers. Documents pass all of
them in turn without being shuffled, grouped or dealt anew: work is words times automata,
whatever one source, passage or group of copies holds.

Edge cases: a null text has no words, and an item without words marks nothing; runs of an
item without an id are hit, but name no item; rows that repeat an item's id are texts of
one item, repeated rows count once; repeated documents are reported each; null ids and all
other columns pass through, under whatever names; an empty table of documents gives no
rows, one of items leaves all documents clean.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablecheck.functions.names import field
from tablecheck.llm.common import bytes_of, rows_of, stored
from tablecheck.llm.words import word_places, words_of

WORDS_PER_AUTOMATON = 100_000
#: Automata that one stage of tasks passes documents through.
PASSES_PER_STAGE = 4
_NEVER = 1 << 60
#: First column: what passes through. The others: the text, its words, what was found.
_STATE = "text binary, n_words long, spans array<struct<start: long, end: long>>, items array<string>"


class SuffixAutomaton:
    """Runs of words that occur in any of the given texts, and the marked ones of them."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.texts: list[tuple[str | None, int, list[int]]] = []
        #: of a state: the marked runs (words, number) that end where its runs end, and the
        #: shortest of them; of a number: the items
        self.chain: list[tuple[tuple[int, int], ...]] = []
        self.shortest: list[int] = []
        self.named: list[list[str]] = []

    def add(self, item: str | None, need: int, words: Sequence[bytes]) -> None:
        """Read a text, of which runs of ``need`` words are to be found."""
        ids = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words]
        self.texts.append((item, need, ids))
        last = 0
        for word in ids:
            last = self._extended(last, word)

    def _extended(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, known, word)
        state = self._state({}, self.length[last] + 1, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            after = self.next[last][word]
            if self.length[after] != self.length[last] + 1:
                after = self._split(last, after, word)
            self.link[state] = after
        return state

    def _split(self, last: int, state: int, word: int) -> int:
        """A state for the runs of ``state`` no longer than those of ``last`` and the word."""
        short = self._state(dict(self.next[state]), self.length[last] + 1, self.link[state])
        self.link[state] = short
        while last >= 0 and self.next[last].get(word) == state:
            self.next[last][word] = short
            last = self.link[last]
        return short

    def _state(self, following: dict[int, int], length: int, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def close(self) -> SuffixAutomaton:
        """Mark the runs to be found, after the last text."""
        marks: dict[int, dict[int, set]] = {}
        for item, need, ids in self.texts:
            state = 0
            for at, word in enumerate(ids, 1):
                state = self.next[state][word]
                while self.length[self.link[state]] >= need:
                    state = self.link[state]
                if at >= need:
                    marks.setdefault(state, {}).setdefault(need, set()).add(item)
        self.texts = []
        self.chain, self.shortest = [()] * len(self.next), [_NEVER] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.link[state]
            self.chain[state], self.shortest[state] = self.chain[above], self.shortest[above]
            if state in marks:
                own = []
                for need in sorted(marks[state]):
                    own.append((need, len(self.named)))
                    self.named.append(sorted(x for x in marks[state][need] if x is not None))
                self.chain[state] += tuple(own)
                self.shortest[state] = self.chain[state][0][0]
        return self

    def find(self, words: Iterable[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged spans [first word, word behind] of all marked runs, and their items."""
        following, link, length, shortest = self.next, self.link, self.length, self.shortest
        spans: list[list[int]] = []
        found: set[int] = set()
        state = matched = 0
        for at, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                state = matched = 0
                continue
            after = following[state].get(word)
            while after is None:
                state = link[state]
                matched = length[state]
                after = following[state].get(word)
            state = after
            matched += 1
            if matched >= shortest[state]:
                runs = [run for run in self.chain[state] if run[0] <= matched]
                found.update(number for _, number in runs)
                first = at + 1 - runs[-1][0]
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, at + 1])
        return spans, {item for number in found for item in self.named[number]}


def automata(
    items: DataFrame,
    length: int = 10,
    coverage: float = 1.0,
    id_col: str = "item_id",
    text_col: str = "text",
    words_per_automaton: int = WORDS_PER_AUTOMATON,
) -> DataFrame:
    """Rows (block, automaton): the items' pickled automata."""
    texts = rows_of(items, item=field(id_col).cast("string"), text=bytes_of(text_col))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                need = min(length, max(1, math.ceil(coverage * len(words))))
                step = max(1, words_per_automaton - need + 1)
                for start in range(0, len(words) - need + 1, step) if words else ():
                    piece = words[start : start + words_per_automaton]
                    out.append({"item": item, "need": need, "n": len(piece), "words": b" ".join(piece)})
            yield pa.RecordBatch.from_pylist(out, schema=_PIECES_ARROW)

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        automaton = SuffixAutomaton()
        order = pdf.sort_values(["words", "need", "item"], kind="stable")
        for item, need, words in zip(order["item"], order["need"], order["words"]):
            automaton.add(item, int(need), words.split())
        return pd.DataFrame(
            {"block": pdf["block"].iloc[:1], "automaton": [pickle.dumps(automaton.close(), 5)]}
        )

    cut = stored(texts.mapInArrow(pieces, _PIECES).distinct(), "benchmark-words")
    total = cut.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / words_per_automaton))
    dealt = cut.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    return stored(
        dealt.groupBy("block").applyInPandas(built, "block long, automaton binary"), "automata"
    )


_PIECES = T.StructType(
    [
        T.StructField("item", T.StringType()),
        T.StructField("need", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("words", T.BinaryType()),
    ]
)
_PIECES_ARROW = to_arrow_schema(_PIECES)


def _scanned(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """Rows (row, text, n_words, spans, items): the spans in the order they were found."""
    spark = docs.sparkSession
    df = docs.select(
        F.struct(*[field(c) for c in docs.columns if c != text_col]).alias("row"),
        field(text_col).cast("string").cast("binary").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start: long, end: long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    struct = T.StructType([df.schema["row"], *T.StructType.fromDDL(_STATE)])
    numbers = sorted(row["block"] for row in found.select("block").collect()) or [None]
    for at, block in enumerate(numbers):
        if at and at % PASSES_PER_STAGE == 0:
            df = stored(df, "decontamination")
        automaton = pickle.dumps(SuffixAutomaton().close(), 5)
        if block is not None:
            automaton = found.where(F.col("block") == block).first()["automaton"]
        df = df.mapInArrow(_passed(spark.sparkContext.broadcast(bytes(automaton))), struct)
    return df


def _passed(automaton: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = pickle.loads(automaton.value).find
        for batch in batches:
            schema = batch.schema
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, spans, items = [], [], []
                for text, old, named in zip(*(part.column(n).to_pylist() for n in ("text", "spans", "items"))):
                    words = words_of(text or b"")
                    new, more = find(words)
                    counts.append(len(words))
                    spans.append(old + [{"start": a, "end": b} for a, b in new])
                    items.append(sorted(more.union(named)))
                columns = [part.column("row"), part.column("text"), counts, spans, items]
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema)],
                    schema=schema,
                )

    return run


def merged(spans: Sequence[dict]) -> list[tuple[int, int]]:
    """Spans that touch or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut_out(text: bytes, spans: Sequence[dict]) -> bytes:
    """A text without the words of the spans and what stands between them."""
    places, kept, end = word_places(text), [], 0
    for first, behind in merged(spans):
        kept.append(text[end : places[first][0]])
        end = places[behind - 1][1]
    return b"".join([*kept, text[end:]])


def find_items(
    docs: DataFrame,
    items: DataFrame,
    length: int = 10,
    coverage: float = 1.0,
    text_col: str = "text",
    words_per_automaton: int = WORDS_PER_AUTOMATON,
) -> DataFrame:
    """Rows (row, n_words, n_hit, spans, items): what each document shares with the items.

    ``row`` holds the document's other columns, ``spans`` the first word of each passage and
    the word behind it, in order, and ``items`` the sorted ids, as strings.
    """
    found = automata(items, length, coverage, words_per_automaton=words_per_automaton)
    df = _scanned(docs, found, text_col).drop("text")
    # a word that spans of several automata hit counts once
    start, end = (lambda s: s["start"]), (lambda s: s["end"])
    joined = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(F.lit(0), end(s) - F.greatest(start(s), a["at"]))).alias("hit"),
            F.greatest(end(s), a["at"]).alias("at"),
        ),
        lambda a: a["hit"],
    )
    return df.select("row", "n_words", joined.alias("n_hit"), F.array_sort("spans").alias("spans"), "items")


def remove_items(
    docs: DataFrame,
    items: DataFrame,
    length: int = 10,
    coverage: float = 1.0,
    text_col: str = "text",
    words_per_automaton: int = WORDS_PER_AUTOMATON,
) -> DataFrame:
    """The documents with all passages of the items cut out of their texts.

    Texts without a passage stay as they are, null included.
    """
    found = automata(items, length, coverage, words_per_automaton=words_per_automaton)
    df = _scanned(docs, found, text_col)
    struct = T.StructType([df.schema["row"], df.schema["text"]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                cut_out(text, spans) if spans else text
                for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary())], ["row", "text"])

    clean = df.mapInArrow(cut, struct)
    text = F.col("text").cast("string")
    return clean.select(*[(text if c == text_col else field(c, "row")).alias(c) for c in docs.columns])
