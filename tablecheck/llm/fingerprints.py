"""Order MinHash fingerprints of texts, sensitive to edit distance.

A text's tokens are its words, cut after ``TOKEN`` code points; ``k`` tokens in a row are a
k-mer, and each k-mer carries the number of its occurrence. Numbered k-mers are hashed and
dealt by hash to ``BUCKETS`` buckets; of each bucket the ``TUPLE`` minimal ones are selected,
put back into text order, and the hash of that tuple is the bucket's signature. A signature
agrees where two texts share the selected k-mers, with their counts, in the same order. The
fingerprint lists the signatures, each with its bucket in front; the likeness of two
fingerprints is the share of their signatures that agree.

All of it is array functions of one row: no shuffle, no Python, and no state besides the
row. A text of n tokens costs n log n.

Edge cases: a null text counts as the empty one, whose fingerprint is the one signature of
no tokens; so is every text of white space only. A text with fewer tokens than a k-mer has
the one signature of all its tokens. Repeated rows have equal fingerprints; null ids are
kept; an empty table gives no rows; other columns are ignored. A text may have up to 2**22
tokens (some 20 MB) before positions in it are told apart by fewer bits than they need;
beyond that, k-mers further on count as if at the last such place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import rows_of, stored, text_of

TOKEN = 16
K = 3
BUCKETS = 64
TUPLE = 2
PLACE_BITS = 22
_PLACES = (1 << PLACE_BITS) - 1
_BUCKET_SHIFT = 64 - 6


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of its text column ``text``, as a string ``name``.

    Steps are columns of their own, so that each array is made once.
    """
    place, high = F.lit(_PLACES), F.lit(~_PLACES)
    steps: list[tuple[str, Column]] = [
        ("tokens", F.regexp_extract_all(F.col(text), F.lit(rf"(\S{{1,{TOKEN}}})"), F.lit(1))),
        # k-mer hash above, place below
        ("mers", F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("f_tokens") - K, F.lit(0))),
            lambda i: F.xxhash64(*[F.get("f_tokens", i + j) for j in range(K)])
            .bitwiseAND(high).bitwiseOR(F.least(i, place).cast("long")),
        )),
        ("sorted", F.sort_array("f_mers")),
        ("runs", F.filter(
            F.sequence(F.lit(0), F.size("f_sorted") - 1),
            lambda i: (i == 0) | (
                F.get("f_sorted", i).bitwiseAND(high)
                != F.get("f_sorted", i - 1).bitwiseAND(high)
            ),
        )),
        ("numbers", F.flatten(F.transform(
            "f_runs",
            lambda start, j: F.sequence(
                F.lit(1), F.coalesce(F.get("f_runs", j + 1), F.size("f_sorted")) - start
            ),
        ))),
        # not inside a lambda, where an array made just before would be made once an element
        ("ordered", F.sort_array(F.zip_with(
            "f_sorted",
            "f_numbers",
            lambda x, number: F.xxhash64(x.bitwiseAND(high), number)
            .bitwiseAND(high).bitwiseOR(x.bitwiseAND(place)),
        ))),
        ("picked", F.sort_array(F.transform(
            F.filter(
                "f_ordered",
                lambda x, i: (i < TUPLE)
                | (_bucket(F.get("f_ordered", i - TUPLE)) != _bucket(x)),
            ),
            lambda x: F.shiftleft(_bucket(x), PLACE_BITS + 1).bitwiseOR(x.bitwiseAND(place)),
        ))),
        ("starts", F.filter(
            F.sequence(F.lit(0), F.size("f_picked") - 1),
            lambda i: (i == 0)
            | (_of(F.get("f_picked", i)) != _of(F.get("f_picked", i - 1))),
        )),
    ]
    for step, value in steps:
        df = df.withColumn(f"f_{step}", value)

    def mer(i: Column) -> Column:
        at = F.get("f_picked", i).bitwiseAND(place).cast("int")
        return F.get("f_mers", at).bitwiseAND(high)

    def signature(start: Column, j: Column) -> Column:
        end = F.coalesce(F.get("f_starts", j + 1), F.size("f_picked"))
        second = F.when(end - start > 1, mer(start + 1))
        return F.concat(
            F.lpad(F.hex(_of(F.get("f_picked", start))), 2, "0"),
            F.lpad(F.hex(F.xxhash64(mer(start), second).bitwiseAND(F.lit(0xFFFFFF))), 6, "0"),
        )

    return df.withColumn(
        name, F.lower(F.array_join(F.transform("f_starts", signature), ""))
    ).drop(*[f"f_{step}" for step, _ in steps])


def _bucket(x: Column) -> Column:
    return F.shiftrightunsigned(x, _BUCKET_SHIFT)


def _of(x: Column) -> Column:
    return F.shiftrightunsigned(x, PLACE_BITS + 1)


def likeness(left: str, right: str) -> Column:
    """Share of signatures that agree, from 0 to 1; null if either side is null."""
    a, b = _signatures(left), _signatures(right)
    common = F.size(F.array_intersect(a, b))
    buckets = F.size(F.array_union(_buckets(a), _buckets(b)))
    return F.when(
        F.col(left).isNotNull() & F.col(right).isNotNull(), common.cast("double") / buckets
    )


def _signatures(name: str) -> Column:
    return F.regexp_extract_all(F.col(name), F.lit("([0-9a-f]{8})"), F.lit(1))


def _buckets(signatures: Column) -> Column:
    return F.transform(signatures, lambda x: F.substring(x, 1, 2))


def with_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text, edited, fingerprint, edited_fingerprint, next_fingerprint).

    Edited: the last half of a text's code points replaced by the first as many of the
    next text by ascending id; after the last id comes the first. Ids and lengths alone
    are sorted; of the next text only what is taken travels, with its fingerprint. Null
    ids come first; texts that share an id follow each other by hash; rows that repeat
    an id with its text count once.
    """
    keys = ["known", "id", "copy"]
    docs = rows_of(
        df,
        known=field(id_col).isNotNull(),
        id=F.coalesce(field(id_col).cast("long"), F.lit(0)),
        copy=F.xxhash64(text_of(text_col)),
        text=text_of(text_col),
    )
    narrow = stored(docs.select(*keys, F.floor(F.char_length("text") / 2).cast("int").alias("half")),
                    "fingerprint-ids")
    once = narrow.dropDuplicates(keys)
    ranked = stored(
        once.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("rank", F.monotonically_increasing_id())
        .select(
            *keys,
            "half",
            F.shiftrightunsigned("rank", 33).alias("part"),
            F.col("rank").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        ),
        "fingerprint-order",
    )
    count = ranked.count()
    if narrow.count() > count:
        docs = docs.dropDuplicates(keys)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranked.groupBy("part").agg(F.count("*").alias("n"))  # a row for each partition
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = ranked.join(parts, "part").withColumn("number", F.col("base") + F.col("place"))
    earlier = numbered.select(
        F.pmod(F.col("number") + 1, F.lit(max(count, 1))).alias("number"),
        *[F.col(k).alias(f"for_{k}") for k in keys],
        F.col("half").alias("taken"),
    )
    taken = stored(numbered.select(*keys, "number").join(earlier, "number").drop("number"),
                   "fingerprint-next")
    heads = with_fingerprint(docs.join(taken, keys), "text", "next_fingerprint").select(
        *[F.col(f"for_{k}").alias(k) for k in keys],
        F.substring("text", F.lit(1), F.col("taken")).alias("head"),
        "next_fingerprint",
    )
    size = F.char_length("text")
    edited = F.concat(
        F.substring("text", F.lit(1), size - F.floor(size / 2).cast("int")), F.col("head")
    )
    both = docs.join(heads, keys).withColumn("edited", edited).drop("head")
    both = with_fingerprint(both, "text", "fingerprint")
    both = with_fingerprint(both, "edited", "edited_fingerprint")
    return both.select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"),
        "text",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        "next_fingerprint",
    )
