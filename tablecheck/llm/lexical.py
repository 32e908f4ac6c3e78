"""Ranked lexical search by MaxScore with bounds of single terms and of pairs.

The index is built once for a block of queries, over all documents. Each task turns its
documents into blocks of ``DOCS_PER_BLOCK``; a block is one row with the posting lists of
the queries' terms, so no posting is shuffled and a frequent term is no heavier in a task
than its documents are. Corpus counts come from one grouped aggregation over the blocks. A
second pass adds each posting's impact, each list's largest impact, and the intersection
lists of pairs of terms with their joint largest impact. A pair's list is kept where the
shorter of the two lists holds at most one document of ``RARE``: the joint maximum of two
frequent terms is near the sum of their maxima and bounds nothing.

In a block, a document that holds some of a pair of terms scores at most the largest of
the two single maxima and the joint one in them; disjoint pairs therefore bound a set of
terms more tightly than its single maxima do. Terms of the smallest maxima are set aside
while the bound of those set aside stays below the k-th score known so far; only documents of
the other lists become candidates. The terms set aside are then looked up one by one, and
candidates that can't reach the k-th score any more are left at each step. The k-th score
starts from that of one block in ``FIRST``, from the k-th largest impacts in lists and
pairs, and rises from block to block in a task. Only bounds below it are skipped, not those
equal to it, so ties are whole.

Queries are taken in blocks of about ``TERMS_PER_PASS`` terms, which are all that the driver
and a worker hold of them.

Edge cases: a null text has no terms, and documents without terms count for nothing; rows
that repeat an item's id are one item with the terms of all, and those of a null id are one
item, too; documents that repeat an id, or have none, are documents of their own, null ids
last among equal scores; an item without terms, or whose terms no document holds, has no
rows; no documents or no items give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablecheck.functions.names import field
from tablecheck.llm.common import bytes_of, rows_of, stored
from tablecheck.llm.words import words_of

DOCS_PER_BLOCK = 4096
RARE = 16
#: The terms that follow a term in a query, by falling weight, which it is paired with.
PARTNERS = 4
FIRST = 16
TERMS_PER_PASS = 20_000

_ANSWER = "query int, score long"
#: A block besides its ids: lengths, and the lists of its terms one behind the other.
_BLOCK = (
    "block string, size int, with_terms long, length long, lengths binary, "
    "terms array<int>, counts array<int>, places binary, tfs binary"
)
_WEIGHED = (
    "block string, size int, terms array<int>, counts array<int>, places binary, impacts binary, "
    "maxima array<long>, kth array<long>, firsts array<int>, seconds array<int>, joint array<long>, "
    "pair_kth array<long>, pair_counts array<int>, pair_places binary"
)


@dataclass
class Queries:
    """A block of queries, their terms as numbers."""

    #: of each query: its terms by falling weight
    terms: list[list[int]]
    weights: list[int]
    #: of each query: its pairs of terms, the smaller number first
    pairs: list[list[tuple[int, int]]]


def impact(tf: np.ndarray, weight: int, m: np.ndarray) -> np.ndarray:
    """What a term adds to the score of documents holding it ``tf`` times."""
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def length_norm(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A document's m from its length n and the corpus counts N and L."""
    return 50 + 50 * n * documents // terms


class Bounds:
    """Upper bounds of sums of terms, from single maxima and pairs' joint maxima."""

    def __init__(self, maxima: dict[int, int], joint: dict[tuple[int, int], int]) -> None:
        self.maxima, self.joint = maxima, joint
        self.partners: dict[int, list[int]] = {}
        for a, b in joint:
            self.partners.setdefault(a, []).append(b)
            self.partners.setdefault(b, []).append(a)

    def rising(self, terms: Sequence[int]) -> list[int]:
        """The bound of each prefix of ``terms``; each term is in one pair at most."""
        out, total, free = [0], 0, set()
        for term in terms:
            best, chosen = 0, None
            for other in self.partners.get(term, ()):
                if other in free:
                    a, b = self.maxima[term], self.maxima[other]
                    pair = self.joint[min(term, other), max(term, other)]
                    gain = a + b - max(a, b, pair)
                    if gain > best:
                        best, chosen = gain, other
            if chosen is None:
                free.add(term)
            else:
                free.remove(chosen)
            total += self.maxima[term] - best
            out.append(total)
        return out


class Block:
    """Posting lists of some documents with impacts, and lists of pairs of terms."""

    def __init__(self, row: dict) -> None:
        self.size = row["size"]
        places = np.frombuffer(row["places"], "<u2").astype(np.int64)
        impacts = np.frombuffer(row["impacts"], "<i8")
        ends = np.cumsum(row["counts"])
        self.lists = {
            term: (places[end - n : end], impacts[end - n : end])
            for term, n, end in zip(row["terms"], row["counts"], ends)
        }
        maxima = dict(zip(row["terms"], row["maxima"]))
        self.kth = dict(zip(row["terms"], row["kth"]))
        pairs = list(zip(row["firsts"], row["seconds"]))
        self.pair_kth = {pair: kth for pair, kth in zip(pairs, row["pair_kth"]) if kth}
        self.bounds = Bounds(maxima, dict(zip(pairs, row["joint"])))

    def search(
        self, terms: Sequence[int], pairs: Sequence[tuple[int, int]], least: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of documents, all with a score of ``least`` among them.

        Those below may be missing or given with a part of their score left out, where
        ``least`` is not larger than the k-th score.
        """
        held = [t for t in terms if t in self.lists]
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = max([least, 1, *(self.kth[t] for t in held), *(self.pair_kth.get(p, 0) for p in pairs)])
        rising = sorted(held, key=lambda t: (self.bounds.maxima[t], t))
        bound = self.bounds.rising(rising)
        aside = max(i for i in range(len(bound)) if bound[i] < least)
        scores = np.zeros(self.size, np.int64)
        for term in rising[aside:]:
            places, impacts = self.lists[term]
            scores[places] += impacts
        found = np.flatnonzero(scores + bound[aside] >= least)
        for at in range(aside - 1, -1, -1):
            if not len(found):
                break
            places, impacts = self.lists[rising[at]]
            if len(found) * 8 < len(places):
                where = np.minimum(np.searchsorted(places, found), len(places) - 1)
                scores[found] += np.where(places[where] == found, impacts[where], 0)
            else:
                scores[places] += impacts
            found = found[scores[found] + bound[at] >= least]
        return found, scores[found]


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Rows (item, term): each item's terms, once each."""
    texts = rows_of(items, item=field(id_col), text=bytes_of(text_col))
    struct = T.StructType([texts.schema["item"], T.StructField("term", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, terms = [], []
            for text in batch.column("text").to_pylist():
                own = set(words_of(text))
                counts.append(len(own))
                terms += own
            taken = np.repeat(np.arange(batch.num_rows), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(taken)), pa.array(terms, pa.binary())], ["item", "term"]
            )

    return texts.mapInArrow(run, struct).distinct()


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_per_block: int = DOCS_PER_BLOCK,
    terms_per_pass: int = TERMS_PER_PASS,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's k highest-scoring documents."""
    asked = stored(item_terms(items), "search-terms")
    n_terms = asked.count()
    passes = max(1, math.ceil(n_terms / terms_per_pass))
    dealt = asked.withColumn("pass", F.pmod(F.xxhash64("item"), F.lit(passes)))
    texts = rows_of(docs, id=field(id_col), text=bytes_of(text_col))
    found = None
    for number in range(passes):
        rows = dealt.where(F.col("pass") == number).select("item", "term").collect()
        part = _answers(texts, rows, asked.schema["item"], k, docs_per_block)
        if passes > 1:
            part = stored(part, "search-answers")
        found = part if found is None else found.unionByName(part)
    return found


def _answers(texts: DataFrame, rows: list, item: T.StructField, k: int, docs_per_block: int) -> DataFrame:
    """One pass: the best documents of one block of queries."""
    spark = texts.sparkSession
    by_item: dict = {}
    for row in rows:
        by_item.setdefault(row["item"], []).append(bytes(row["term"]))
    vocabulary = {t: i for i, t in enumerate(sorted({t for own in by_item.values() for t in own}))}
    share = spark.sparkContext.broadcast
    ids = T.StructField("ids", T.ArrayType(texts.schema["id"].dataType))
    blocks = T.StructType([ids, *T.StructType.fromDDL(_BLOCK)])
    weighed = T.StructType([ids, *T.StructType.fromDDL(_WEIGHED)])
    plain = stored(
        texts.mapInArrow(_inverted(share(vocabulary), docs_per_block, blocks.names), blocks),
        "search-blocks",
    )
    corpus = plain.agg(F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    frequency = (
        plain.select(F.inline(F.arrays_zip("terms", "counts"))).groupBy("terms").agg(F.sum("counts").alias("df"))
    )
    df = {row["terms"]: row["df"] for row in frequency.collect()}  # of the queries' terms only
    weights = [
        math.floor(1000 * math.log((2 * corpus[0] + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))
    ]
    terms = [
        sorted((vocabulary[t] for t in own if vocabulary[t] in df), key=lambda t: (-weights[t], t))
        for own in by_item.values()
    ]
    pairs = [
        [(min(a, b), max(a, b)) for i, a in enumerate(own) for b in own[i + 1 : i + 1 + PARTNERS]]
        for own in terms
    ]
    asked = share(Queries(terms, weights, pairs))
    index = stored(
        plain.mapInArrow(_weighed(asked, tuple(corpus), k, to_arrow_schema(weighed)), weighed),
        "search-index",
    )
    answer = T.StructType([T.StructField("id", texts.schema["id"].dataType), *T.StructType.fromDDL(_ANSWER)])
    first = index.where(F.pmod(F.xxhash64("block"), F.lit(FIRST)) == 0)
    least = (
        _best(first.mapInArrow(_searched(asked, share({}), k), answer), k)
        .where(F.col("rank") == k)
        .select("query", "score")
        .collect()
    )
    start = share({row["query"]: row["score"] for row in least})
    best = _best(index.mapInArrow(_searched(asked, start, k), answer), k)
    names = spark.createDataFrame(
        list(enumerate(by_item)),
        T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", item.dataType)]),
    )
    return best.join(names, "query").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def _best(answers: DataFrame, k: int) -> DataFrame:
    """Each query's k best answers of all tasks, ranked."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _inverted(vocabulary: Broadcast, docs_per_block: int, names: list[str]):
    """Documents to blocks, each task's in the order it reads them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = vocabulary.value, uuid.uuid4().hex
        ids, lengths, places, terms, tfs = [], [], [], [], []

        def block(number: int, kind: pa.DataType) -> pa.RecordBatch:
            term, place = np.array(terms, np.int32), np.array(places, np.int64)
            order = np.lexsort((place, term))
            own, counts = np.unique(term, return_counts=True)
            columns = [
                pa.array([ids], pa.list_(kind)),
                pa.array([f"{task}-{number}"]),
                pa.array([len(ids)], pa.int32()),
                pa.array([sum(n > 0 for n in lengths)]),
                pa.array([sum(lengths)]),
                pa.array([np.array(lengths, "<i8").tobytes()]),
                pa.array([own], pa.list_(pa.int32())),
                pa.array([counts], pa.list_(pa.int32())),
                pa.array([place[order].astype("<u2").tobytes()]),
                pa.array([np.array(tfs, "<i8")[order].astype("<u4").tobytes()]),
            ]
            for kept in (ids, lengths, places, terms, tfs):
                kept.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        number, kind = 0, None
        for batch in batches:
            kind = batch.column("id").type
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    words = words_of(text)
                    counted = Counter([known[w] for w in words if w in known])
                    places += [len(ids)] * len(counted)
                    terms += counted.keys()
                    tfs += counted.values()
                    ids.append(key)
                    lengths.append(len(words))
                    if len(ids) == docs_per_block:
                        yield block(number, kind)
                        number += 1
        if ids:
            yield block(number, kind)

    return run


def _weighed(asked: Broadcast, corpus: tuple[int, int], k: int, fields: pa.Schema):
    """Blocks with impacts, their maxima, and the pairs' intersection lists."""

    def kth(impacts: np.ndarray) -> int:
        return int(np.partition(impacts, -k)[-k]) if len(impacts) >= k else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = asked.value.weights
        pairs = sorted({pair for own in asked.value.pairs for pair in own})
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.slice(at, 1)
                row = part.drop_columns(["ids"]).to_pylist()[0]
                m = length_norm(np.frombuffer(row["lengths"], "<i8"), corpus[0], max(1, corpus[1]))
                places = np.frombuffer(row["places"], "<u2")
                tfs = np.frombuffer(row["tfs"], "<u4").astype(np.int64)
                lists, start = {}, 0
                for term, n in zip(row["terms"], row["counts"]):
                    own = slice(start, start := start + n)
                    lists[term] = places[own], impact(tfs[own], weights[term], m[places[own]])
                met = []
                scatter = np.zeros(row["size"], np.int64)
                last = None
                for a, b in pairs:
                    if a not in lists or b not in lists:
                        continue
                    if min(len(lists[a][0]), len(lists[b][0])) * RARE > row["size"]:
                        continue
                    if last != a:  # pairs come in the order of their first term
                        scatter[:] = 0
                        scatter[lists[a][0]] = lists[a][1] + 1
                        last = a
                    own, more = lists[b]
                    both = scatter[own] > 0
                    joint = scatter[own][both] - 1 + more[both]
                    met.append((a, b, int(joint.max(initial=0)), kth(joint), own[both]))
                out = row | {
                    "impacts": b"".join(x.astype("<i8").tobytes() for _, x in lists.values()),
                    "maxima": [int(x.max()) for _, x in lists.values()],
                    "kth": [kth(x) for _, x in lists.values()],
                    "firsts": [x[0] for x in met],
                    "seconds": [x[1] for x in met],
                    "joint": [x[2] for x in met],
                    "pair_kth": [x[3] for x in met],
                    "pair_counts": [len(x[4]) for x in met],
                    "pair_places": b"".join(x[4].tobytes() for x in met),
                }
                columns = [part.column("ids")]
                columns += [pa.array([out[f.name]], f.type) for f in fields if f.name != "ids"]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return run


def _searched(asked: Broadcast, start: Broadcast, k: int):
    """Each query's k best documents of a task's blocks that may be among the best of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = asked.value
        least = [start.value.get(q, 0) for q in range(len(queries.terms))]
        scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(least)
        ids: list[list] = [[] for _ in least]
        kind = None
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.slice(at, 1)
                kind = part.column("ids").type.value_type
                names = part.column("ids").to_pylist()[0]
                block = Block(part.drop_columns(["ids", "pair_counts", "pair_places"]).to_pylist()[0])
                for q, (terms, pairs) in enumerate(zip(queries.terms, queries.pairs)):
                    found, more = block.search(terms, pairs, least[q])
                    good = more >= max(1, least[q])
                    if not good.any():
                        continue
                    scores[q] = np.concatenate([scores[q], more[good]])
                    ids[q] += [names[x] for x in found[good].tolist()]
                    if len(scores[q]) > k:
                        order = sorted(
                            range(len(ids[q])), key=lambda i: (-scores[q][i], ids[q][i] is None, ids[q][i])
                        )[:k]
                        scores[q], ids[q] = scores[q][order], [ids[q][i] for i in order]
                        least[q] = max(least[q], int(scores[q][-1]))
        for q, own in enumerate(ids):
            if own:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, kind),
                        pa.array([q] * len(own), pa.int32()),
                        pa.array(scores[q]),
                    ],
                    ["id", "query", "score"],
                )

    return run
