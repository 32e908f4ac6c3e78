"""The registered queries of this package and the SQL that some are compared with."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import (
    decontamination,
    fingerprints,
    jaccard,
    language,
    lexical,
    lm,
    packing,
    quality,
    sentencepieces,
    sharding,
    topk,
    warc,
    whitening,
)
from tablecheck.llm.common import id_remainder, read, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        @functools.wraps(function)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = shipped
        if sql:
            ORACLES[name] = sql
        return function

    return register


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes, equal texts together."""
    placed = sharding.shard_by_size(read(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents")))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from four fifths of the labels."""
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.scores(docs, model).select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by text, declared language and source."""
    docs = read(spark, sf_dir, "documents")
    return language.identify(language.document_rows(docs), language.fit_text(docs), ["doc_id"])


@query("language_pages")
def language_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, by text, markup and address."""
    model = language.fit_text(read(spark, sf_dir, "documents"))
    return language.identify(language.page_rows(read(spark, sf_dir, "pages")), model, ["page_id"])


@query(
    "op6_jaccard",
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
          lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
      FROM words
    ), members AS (
      SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
    ), links AS (
      SELECT a.doc_id AS u, b.doc_id AS v
      FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), reach AS (
      SELECT u, v FROM links
      UNION
      SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
    )
    SELECT doc_id, len(s)::BIGINT AS n_shingles,
           least(doc_id, coalesce((SELECT min(v) FROM reach WHERE u = doc_id), doc_id)) AS component_id
    FROM sets
    """,
)
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a similarity of 0.85 or more."""
    return jaccard.link_components(read(spark, sf_dir, "documents"), size=4, threshold=85)


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of every document, of its edited text, and its likeness to both."""
    return fingerprints.with_neighbours(read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        fingerprints.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


@query(
    "op3_topk",
    """
    WITH usable AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             list_inner_product(q.v, c.v)::BIGINT AS score
      FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r
      FROM scored
    )
    SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
    """,
)
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best others for every vector whose id is divisible by 50."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query(
    "op8_warc",
    """
    WITH hashed AS (
      SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex
      FROM pages WHERE page_id IS NOT NULL
    ), last AS (
      SELECT *, max(page_id) OVER (PARTITION BY payload) AS last_id FROM hashed
    )
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
      list_aggregate(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::BIGINT
                >> (15 - 5 * (i % 4))::INT & 31)::INT + 1, 1)),
        'string_agg', '') AS payload_digest,
      CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> last_id THEN last_id END AS refers_to
    FROM last
    """,
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as WARC records and read back from their frames."""
    index = warc.write(read(spark, sf_dir, "pages"))
    records = warc.referred(warc.read_back(spark, index))
    return records.select(
        "page_id",
        F.when(F.col("intact"), F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded with a tenth of the merges dropped, and decoded again."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    both = sentencepieces.decode(sentencepieces.encode(docs, rate=0.1, seed=1))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        sentencepieces.ids_crc32(F.col("ids")).alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


@query("op4_lm")
def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 chance of every document, learned from nine tenths of them."""
    return lm.score(read(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable vectors, projected on the 16 leading components and scaled by them."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"), 16)


@query(
    "op12_lexical",
    r"""
    WITH words AS (
      SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
      FROM documents
    ), corpus AS (
      SELECT count(*) AS big_n, sum(len(w))::BIGINT AS big_l FROM words WHERE len(w) > 0
    ), norms AS (
      SELECT d, doc_id, w, 50 + (50 * len(w) * big_n) // big_l AS m FROM words, corpus WHERE len(w) > 0
    ), asked AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark
    ), held AS (
      SELECT d, doc_id, m, term, count(*) AS tf
      FROM (SELECT d, doc_id, m, unnest(w) AS term FROM norms) GROUP BY ALL
    ), weights AS (
      SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM held, corpus GROUP BY term, big_n
    ), scored AS (
      SELECT item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM asked JOIN held USING (term) JOIN weights USING (term)
      GROUP BY item_id, d, doc_id
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r
      FROM scored WHERE score > 0
    )
    SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= 50
    """,
)
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), 50)


@query(
    "op13_decontamination",
    r"""
    WITH docs AS (
      SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents
    ), items AS (
      SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark
    ), windows AS (
      SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
      FROM (
        SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM items WHERE len(w) > 0
      )
    ), places AS (
      SELECT d, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
      FROM (
        SELECT d, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
      )
    ), found AS (
      SELECT d, k, i, item_id FROM places JOIN windows USING (k, gram)
    ), hits AS (
      SELECT d, count(DISTINCT p) AS n
      FROM (SELECT d, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT d, i, k FROM found)) GROUP BY d
    ), named AS (
      SELECT d, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT d, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY d
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit,
      coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(hits.n, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (d) LEFT JOIN named USING (d)
    """,
)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark: runs of ten words, or whole items."""
    found = decontamination.find_items(
        read(spark, sf_dir, "documents").select("doc_id", "text"),
        read(spark, sf_dir, "benchmark"),
        length=10,
        coverage=1.0,
    )
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
