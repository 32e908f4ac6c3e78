"""Similarity join of documents on word shingles by parity sketches.

A document's set holds the hashes of its distinct word shingles. Two sets of sizes a and b
whose Jaccard similarity reaches the threshold t differ in at most
d = (a + b) (1 - t) / (1 + t) shingles. Sets are put in size bands; each joins within its
own band and, as the smaller partner, in those above that begin at a / t or below: one for
t of 0.8 or more, else several. A band of sizes up to U allows d for
a + b = 2 U and deals shingles by hash to m = d + 1 + spare segments. In a segment each
shingle toggles one bit of a sparse sketch of 2**20 bits, so the number of bits in which
two sketches differ is at most the number of shingles in which the sets do, and at least
1 + spare segments agree. A segment travels as one 64-bit key, the XOR of its bits' codes.
Empty segments agree for no reason; a set with at most ``spare`` of them leaves them out
(one that agrees and is not empty remains), any other emits them too. So every linked pair
shares a key. There are so many spare segments that one unrelated set in a million has
more empty ones and meets others like it in their keys.

Each key has one leader, its first document, whatever tasks its members come from. Members
whose whole sketches differ from their leader's in no more bits than linked sets differ in
shingles are verified by their sets, first with the leader they share most keys with, then
with those of other components. Links make components.
What then spans components is compared by sketches, in blocks of a leader's members, and
what passes is verified too. So every pair that could be linked is verified or already
connected, while pairs inside a component are never listed. Copies travel as one set, and
a frequent key becomes one row for each task before any shuffle.

Edge cases: a set is empty without words (null or empty text) and linked with nothing; with
fewer words than a shingle takes, the whole sequence is the one shingle; rows that repeat
an id count as one document that links what it holds; rows with a null id are returned with
a null component and link nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import Memory, mapped, rows_of, stored, text_of, turn_of

BAND_RATIO = 1.25
SKETCH_BITS = 20
#: The share of unrelated sets that may leave more segments empty than are spare.
CROWDED = 1e-6
KEPT_BYTES = 48 << 20
KEYS_AT_ONCE = 300_000
BLOCK = 512
BROADCAST_IDS = 1_000_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class Words(Memory):
    """Hash of each word."""

    def __missing__(self, word: bytes) -> int:
        return self.keep(word, xxhash.xxh3_64_intdigest(word), len(word))


_words = Words("jaccard", KEPT_BYTES)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a whole text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for j in range(width):
        total = mixed(total * _ODD[0] + hashes[j : len(hashes) - width + 1 + j])
    return np.unique(total)


def _spare(n: int, differing: int) -> int:
    """So many spare segments that few sets of n shingles leave more of them empty.

    Such a set fills ``differing`` segments at most. The chance of that is counted item by
    item, and for large sets taken from the mean and spread of the empty segments' number.
    Low thresholds leave small sets hardly any shingle that must agree; there the number of
    segments ends the search, and more sets meet.
    """
    spare = 0
    if n <= differing:
        return spare
    if n > 1024:
        for _ in range(50):
            segments = differing + 1 + spare
            mean = segments * math.exp(-n / segments)
            spare = math.ceil(mean + 6 * math.sqrt(mean))
        return spare
    filled = np.arange(differing + 2)  # the last stands for all that are more
    while True:
        segments = differing + 1 + spare
        chance = np.zeros(differing + 2)
        chance[0] = 1.0
        for _ in range(n):
            stays = chance * filled / segments
            stays[-1] = chance[-1]
            stays[1:] += (chance * (1 - filled / segments))[:-1]
            chance = stays
        if chance[:-1].sum() <= CROWDED or segments > 3 * differing + 32:
            return spare
        spare += max(1, differing // 48)


@lru_cache(maxsize=64)
def _bands(threshold: int) -> tuple[list[int], list[int], list[int]]:
    """Lower ends, segments and spare segments of the size bands; threshold in percent."""
    lows, segments, spares = [1], [], []
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, int(lows[-1] * BAND_RATIO)))
        differing = 2 * (lows[-1] - 1) * (100 - threshold) // (100 + threshold)
        spares.append(_spare(lows[-2], differing))
        segments.append(differing + 1 + spares[-1])
    return lows, segments, spares


def keys_of(found: np.ndarray, threshold: int) -> np.ndarray:
    """Keys of a set's sketch segments, in its own band and in all that it reaches."""
    if not len(found):
        return found
    lows, segments, spares = _bands(threshold)
    own = int(np.searchsorted(lows, len(found), "right")) - 1
    out = []
    for band in range(own, len(segments)):
        if band > own and 100 * len(found) < threshold * lows[band]:
            break
        number, spare = segments[band], spares[band]
        segment = ((found >> np.uint64(32)) * np.uint64(number)) >> np.uint64(32)
        bits = mixed((found & np.uint64((1 << SKETCH_BITS) - 1)) + _ODD[1])
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        sketch, filled = np.bitwise_xor.reduceat(bits, starts), segment[starts]
        if number - len(filled) > spare:
            empty = np.setdiff1d(np.arange(number, dtype=np.uint64), filled)
            sketch = np.concatenate([sketch, np.zeros(len(empty), np.uint64)])
            filled = np.concatenate([filled, empty])
        out.append(mixed(sketch ^ mixed(filled + np.uint64(band << 40))))
    return np.concatenate(out)


def link_components(
    df: DataFrame,
    size: int = 5,
    threshold: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id); the threshold is in percent."""
    docs = rows_of(df, doc_id=field(id_col).cast("long"), text=text_of(text_col))
    sets = stored(_measured(docs, size), "jaccard-sets")
    alike = (
        sets.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"))
    )
    members = stored(
        sets.join(alike, "digest", "left").select("doc_id", "n_shingles", "first_id"),
        "jaccard-members",
    )
    copies = members.where("first_id <> doc_id").select(
        F.col("doc_id").alias("u"), F.col("first_id").alias("v")
    )
    shared = _shared_keys(docs.where("doc_id IS NOT NULL"), copies, size, threshold)
    ids = stored(
        shared.select(F.explode(F.array("doc", "leader")).alias("doc_id")).distinct(),
        "jaccard-ids",
    )
    few = ids.count() <= BROADCAST_IDS
    chosen = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    wanted = stored(_listed(chosen, size), "jaccard-wanted")

    led = stored(
        shared.groupBy("leader", "doc")
        .agg(F.count("*").alias("keys"))
        .select(*_pair("leader", "doc"), "leader", "doc", "keys"),
        "jaccard-led",
    )
    near = stored(_near(led, wanted, threshold), "jaccard-near")
    best = near.groupBy("doc").agg(F.max_by("leader", "keys").alias("leader"))
    links = stored(
        _linked(best.select(*_pair("leader", "doc")).distinct(), wanted, threshold),
        "jaccard-links",
    )
    labels = stored(components(links), "jaccard-labels")
    others = _across(near.select("a", "b").distinct(), labels)
    fresh = _linked(others, wanted, threshold)
    # a node and its component stand for all links so far
    so_far = labels.select(F.col("node").alias("u"), F.col("component").alias("v"))
    labels = stored(components(so_far.union(fresh)), "jaccard-labels-led")
    rest = stored(_compared(shared, led, labels, wanted, threshold), "jaccard-rest")
    so_far = labels.select(F.col("node").alias("u"), F.col("component").alias("v"))
    links = so_far.union(_linked(rest.distinct(), wanted, threshold))
    linked = components(links.union(copies.select("u", "v")))
    return members.join(linked, members["doc_id"] == linked["node"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias(
            "component_id"
        ),
    )


def keep_one(
    df: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows, with all columns, that are the first of their component by id.

    Rows with a null id stay.
    """
    found = link_components(df, size, threshold, id_col, text_col)
    later = found.where("component_id <> doc_id").select(F.col("doc_id").alias("later"))
    return df.join(later, field(id_col).cast("long") == later["later"], "left_anti")


def _measured(docs: DataFrame, size: int) -> DataFrame:
    def task():
        turn_of("jaccard")

        def block(columns: dict) -> dict:
            found = [shingles(text, size) for text in columns["text"]]
            return {
                "doc_id": columns["doc_id"],
                "n_shingles": [len(x) for x in found],
                "digest": [xxhash.xxh3_128_digest(x.tobytes()) for x in found],
            }

        return block

    return mapped(docs, task, "doc_id long, n_shingles long, digest binary")


def _listed(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc, set, sketch): shingle hashes, and a parity sketch of four bits for each.

    A sketch has a power of two of 64-bit words, so it folds to any shorter one.
    """

    def task():
        turn_of("jaccard")

        def block(columns: dict) -> dict:
            found = [shingles(text, size) for text in columns["text"]]
            return {
                "doc": columns["doc_id"],
                "set": [x.view(np.int64) for x in found],
                "sketch": [parity_sketch(x).tobytes() for x in found],
            }

        return block

    return mapped(docs, task, "doc long, set array<long>, sketch binary")


def parity_sketch(found: np.ndarray) -> np.ndarray:
    words = 1 << max(0, math.ceil(math.log2(max(1, len(found) / 16))))
    bit = mixed(found ^ _ODD[1])
    sketch = np.zeros(words, np.uint64)
    place = (bit & np.uint64(words - 1)).astype(np.int64)
    np.bitwise_xor.at(sketch, place, np.uint64(1) << (bit >> np.uint64(58)))
    return sketch


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def _shared_keys(docs: DataFrame, copies: DataFrame, size: int, threshold: int) -> DataFrame:
    """Rows (key, doc, leader) for each key that several sets have; the leader is one too.

    A copy is replaced by the first of its kind. In a task, documents of equal sets count
    once. All members of a key have the same leader, so any two of them meet in its group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_of("jaccard")
        waiting: dict[bytes, tuple[int, np.ndarray]] = {}
        amount = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for doc, text in zip(part["doc_id"], part["text"]):
                    found = shingles(text, size)
                    digest = xxhash.xxh3_128_digest(found.tobytes())
                    if digest in waiting:
                        waiting[digest] = (min(doc, waiting[digest][0]), waiting[digest][1])
                    else:
                        keys = keys_of(found, threshold)
                        waiting[digest] = (doc, keys)
                        amount += len(keys)
                if amount >= KEYS_AT_ONCE:
                    yield led(waiting)
                    waiting, amount = {}, 0
        if waiting:
            yield led(waiting)

    def led(waiting: dict) -> pa.RecordBatch:
        docs, lists = zip(*waiting.values())
        key = np.concatenate(lists).view(np.int64)
        doc = np.repeat(np.array(docs, np.int64), [len(x) for x in lists])
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
        leader = np.repeat(doc[starts], np.diff(np.append(starts, len(key)))) if len(key) else doc
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(doc), pa.array(leader)], ["key", "doc", "leader"]
        )

    emitted = docs.mapInArrow(run, "key long, doc long, leader long")
    by_key = Window.partitionBy("key").orderBy("doc")
    first = F.first("doc").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    met = stored(
        emitted.withColumn("leader", first)
        .where("doc <> leader")
        .select("key", "doc", "leader"),
        "jaccard-keys",
    )
    for name in ("doc", "leader"):
        met = (
            met.join(copies, met[name] == copies["u"], "left")
            .withColumn(name, F.coalesce("v", name))
            .drop("u", "v")
        )
    return stored(met.where("doc <> leader").distinct(), "jaccard-shared")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, as (u, v)."""
    left = sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    # equal ids on several rows: any of their sets counts
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("common", common)
        .where(100 * F.col("common") >= threshold * union)
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
        .distinct()
    )


def _near(led: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose sketches differ in no more bits than linked sets may in shingles."""
    left = sets.select(F.col("doc").alias("a"), F.size("set").alias("size_a"), "sketch")
    right = sets.select(
        F.col("doc").alias("b"), F.size("set").alias("size_b"), F.col("sketch").alias("other")
    )

    def task():
        def block(columns: dict) -> dict:
            fits = []
            for x, y, total in zip(columns.pop("sketch"), columns.pop("other"),
                                   columns.pop("total")):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                bits = np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()
                fits.append(int(bits) <= total * (100 - threshold) // (100 + threshold))
            return columns | {"fits": fits}

        return block

    joined = led.join(left, "a").join(right, "b")
    return mapped(
        joined.select("a", "b", "leader", "doc", "keys", "sketch", "other",
                      (F.col("size_a") + F.col("size_b")).alias("total")),
        task,
        "a long, b long, leader long, doc long, keys long, fits boolean",
    ).where("fits").drop("fits")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose components differ."""
    of_a = labels.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    return (
        pairs.join(of_a, "a", "left")
        .join(of_b, "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b")
    )


def _compared(
    shared: DataFrame, led: DataFrame, labels: DataFrame, sets: DataFrame, threshold: int
) -> DataFrame:
    """Pairs (a, b) of members of a key whose components differ and sketches are near.

    Members that share several keys with a leader are compared once, in the leader's
    group; members that share one are compared with the others of that key. Groups are
    cut into blocks, and a task takes two blocks at a time; it returns what may be linked.
    """
    often = led.where("keys > 1").select(
        F.lit(0).alias("kind"), F.col("leader").alias("group"), "doc", F.lit(False).alias("once")
    )
    singles = led.where("keys = 1").select("leader", "doc", F.lit(True).alias("once"))
    their_keys = shared.join(singles, ["leader", "doc"]).select("key").distinct()
    by_key = (
        shared.join(their_keys, "key", "left_semi")
        .join(singles, ["leader", "doc"], "left")
        .select(
            F.lit(1).alias("kind"),
            F.col("key").alias("group"),
            "doc",
            F.coalesce("once", F.lit(False)).alias("once"),
        )
    )
    groups = often.union(by_key)
    labelled = groups.join(labels, groups["doc"] == labels["node"], "left").select(
        "kind", "group", "doc", "once", F.coalesce("component", "doc").alias("component")
    )
    sizes = (
        labelled.groupBy("kind", "group")
        .agg(
            F.count("*").alias("n"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("low <> high")
        .select("kind", "group", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("doc", F.lit(5)), F.col("blocks")).cast("int")
    dealt = (
        labelled.join(sizes, ["kind", "group"])
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "kind",
            "group",
            F.least("own", "with").alias("i"),
            F.greatest("own", "with").alias("j"),
            "own",
            "doc",
            "once",
            "component",
        )
        .join(sets.select("doc", F.size("set").alias("size"), "sketch"), "doc")
    )
    where = ["kind", "group", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = batch.to_pydict()
            for row in zip(*[columns[name] for name in names]):
                if row[:4] != key:
                    found += _near_members(rows, threshold)
                    key, rows = row[:4], []
                rows.append(row)
            if found:
                yield _pairs_batch(found)
        if found := _near_members(rows, threshold):
            yield _pairs_batch(found)

    names = [*where, "own", "doc", "once", "component", "size", "sketch"]
    return (
        dealt.select(*names)
        .repartition(*where)
        .sortWithinPartitions(*where)
        .mapInArrow(run, "a long, b long")
    )


def _pairs_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
    )


def _near_members(rows: list[tuple], threshold: int) -> list[tuple[int, int]]:
    """Pairs of two blocks (or of one with itself) that pass the sketches' bound."""
    if len(rows) < 2:
        return []
    own, doc, once, component, size = (
        np.array([row[n] for row in rows]) for n in (4, 5, 6, 7, 8)
    )
    kind, _, i, j = rows[0][:4]
    sketches = [np.frombuffer(row[9], np.uint64) for row in rows]
    words = min(map(len, sketches))
    table = np.stack([folded(x, words) for x in sketches])
    found = []
    for at in range(len(rows)):
        others = np.arange(at + 1, len(rows))
        keep = component[others] != component[at]
        if i != j:
            keep &= own[others] != own[at]
        if kind == 1:
            keep &= once[others] | once[at]
        others = others[keep]
        if len(others):
            bits = np.bitwise_count(table[others] ^ table[at]).sum(axis=1, dtype=np.int64)
            limit = (size[others] + size[at]) * (100 - threshold) // (100 + threshold)
            found += [
                (int(min(doc[at], d)), int(max(doc[at], d))) for d in doc[others[bits <= limit]]
            ]
    return found


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (u, v) reach, by alternating stars.

    Each round hangs neighbours on the smallest one, first the larger ones of every node,
    then all smaller ones; rounds grow with the logarithm of the longest path.
    """
    edges = stored(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "stars",
    )
    before = None
    while True:
        state = edges.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        larger = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        lowest = larger.groupBy("u").agg(F.min("v").alias("m"))
        hung = larger.join(lowest, "u")
        edges = stored(
            hung.select("u", F.col("m").alias("v"))
            .union(hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "stars",
        )
