"""Language of documents and pages by Bayesian fusion of several kinds of evidence.

The text's likelihood under each language comes from counts of byte triples, hashed to
``BUCKETS`` values, over all rows that carry a language. To it are added, as logarithms,

* the chance of the markup's declared language (``<html lang=…>``) in each language,
* the chance of the address suffix (``.de``, ``.example.net``'s ``.net``) in each,
* the prior of the host, smoothed towards that of its domain, and that towards all rows.

These chances are estimated by grouped sums of the rows' text-only posteriors, without
the row's own share where it would vote for itself. Languages are few; declared languages
and suffixes are joined like hosts, as tables of their own, none of which is forced into
memory. A text like none of the languages is ``und``: its likelihood there is that of
triples drawn evenly. A row is accepted if its best language is not ``und`` and has at
least ``least`` of the probability.

Edge cases: a null or empty text, or one without letters, has no text evidence and is
``und``, not accepted; null hosts, addresses or markup add nothing; repeated rows each get
a result; rows without a language teach nothing, and without any such row all is ``und``;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import mapped, rows_of, stored, text_of, turn_of

BUCKETS = 1 << 15
INDEPENDENT = 1 / 3  # triples overlap; each adds about one new byte
HOST_STRENGTH, DOMAIN_STRENGTH, CUE_STRENGTH = 8.0, 20.0, 4.0
UNKNOWN = "und"
CUES = ("host", "domain", "declared", "suffix")
_TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;"
_DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"


@dataclass
class TextModel:
    """``log_chance[bucket, language]``; the last language is ``und``."""

    languages: list[str]
    log_chance: np.ndarray

    def likelihoods(self, texts: list[str]) -> np.ndarray:
        """Summed log chances of each text's triples."""
        codes, ends = triples(texts)
        out = np.zeros((len(texts), len(self.languages)))
        for i, (start, end) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)):
            for at in range(start, end, 1 << 16):
                part = self.log_chance[codes[at : min(end, at + (1 << 16))]]
                out[i] += part.sum(axis=0, dtype=np.float64)
        return out


def triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte triples of all texts in a row, and where each text's end.

    Letter case of A-Z does not count, and bytes other than letters are all alike.
    Triples without a letter are left out.
    """
    joined = b"".join(b"  " + t.encode("utf-8", "replace").lower() + b"  " for t in texts)
    data = _CLASS[np.frombuffer(joined, np.uint8)]
    codes = (data[:-2] * 0x9E37 + data[1:-1] * 0x79B9 + data[2:] * 0xF35B) * np.uint32(2654435761)
    codes >>= np.uint32(32 - 15)
    letters = data != 32
    use = letters[:-2] | letters[1:-1] | letters[2:]
    sizes = np.fromiter((len(t.encode("utf-8", "replace")) + 4 for t in texts), np.int64)
    ends = np.cumsum(sizes)
    seen = np.concatenate([[0], np.cumsum(use)])
    return codes[use].astype(np.int64), seen[np.minimum(ends, len(use))]


_CLASS = np.array(
    [b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32
)


def fit_text(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Triple counts of every row with a language, summed by language and triple."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                by_lang: dict[str, list[str]] = {}
                for text, lang in zip(part["text"], part["lang"]):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    found = np.bincount(triples(texts)[0], minlength=BUCKETS)
                    sums[lang] = sums.get(lang, 0) + found
        for lang, total in sums.items():
            bucket = np.flatnonzero(total)
            columns = [pa.array([lang] * len(bucket)), pa.array(bucket), pa.array(total[bucket])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    rows = rows_of(df, text=text_of(text_col), lang=F.lower(field(lang_col))).where(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN)
    )
    counted = (
        rows.mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))  # BUCKETS at most
        .collect()
    )
    counted.sort(key=lambda row: row["lang"])
    log_chance = np.full((BUCKETS, len(counted) + 1), -np.log(BUCKETS), np.float32)
    for i, row in enumerate(counted):
        total = np.full(BUCKETS, 0.5)
        bucket, n = np.array(row["counts"], np.int64).reshape(-1, 2).T
        total[bucket] += n
        log_chance[:, i] = np.log(total / total.sum())
    return TextModel([row["lang"] for row in counted] + [UNKNOWN], log_chance)


def identify(
    rows: DataFrame, model: TextModel, keys: list[str], least: float = 0.5
) -> DataFrame:
    """Rows (keys, text, declared, suffix, host, domain) with lang, probability, accepted.

    ``text_lang`` is the language by the text alone. All five evidence columns are
    strings and may be null.
    """
    names = model.languages
    schema = rows.select(*keys, "declared", "suffix", "host", "domain").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def likely():
        turn_of("language")

        def block(columns: dict) -> dict:
            seen = model.likelihoods(columns.pop("text"))
            shares = _softmax(seen * INDEPENDENT)
            return columns | {"likelihood": list(seen), "text_share": list(shares)}

        return block

    scored = stored(
        mapped(rows.select(*schema.names, text_of("text").alias("text")), likely,
               ddl + ", likelihood array<double>, text_share array<double>"),
        "language-text",
    )
    sums = F.array(*[F.sum(F.col("text_share")[i]) for i in range(len(names))])
    overall = scored.agg(sums.alias("s")).first()["s"]
    everywhere = np.array([x or 0.0 for x in overall])
    joined = scored
    for cue in CUES:
        found = scored.where(F.col(cue).isNotNull()).groupBy(cue).agg(sums.alias(f"{cue}_sum"))
        joined = joined.join(found, cue, "left")

    def fused():
        prior = (everywhere + 1) / (everywhere.sum() + len(names))

        def block(columns: dict) -> dict:
            seen, shares = np.array(columns["likelihood"]), np.array(columns["text_share"])
            of = {cue: _table(columns[f"{cue}_sum"], len(names)) for cue in CUES}
            # a row does not vote for itself
            domain = np.maximum(of["domain"] - shares, 0)
            host = np.maximum(of["host"] - shares, 0)
            domain = _smoothed(domain, prior, DOMAIN_STRENGTH)
            evidence = seen * INDEPENDENT + np.log(_smoothed(host, domain, HOST_STRENGTH))
            for cue in ("declared", "suffix"):
                evidence += _cue(of[cue], everywhere)
            chance = _softmax(evidence)
            blank = (seen == 0).all(axis=1)
            labels = np.array(names, dtype=object)
            lang = np.where(blank, UNKNOWN, labels[chance.argmax(axis=1)])
            probability = chance.max(axis=1)
            return {key: columns[key] for key in keys} | {
                "lang": lang,
                "probability": probability,
                "text_lang": np.where(blank, UNKNOWN, labels[shares.argmax(axis=1)]),
                "accepted": (lang != UNKNOWN) & (probability >= least),
            }

        return block

    kept = ["likelihood", "text_share", *[f"{cue}_sum" for cue in CUES]]
    key_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name in keys)
    return mapped(
        joined.select(*keys, *kept),
        fused,
        key_ddl + ", lang string, probability double, text_lang string, accepted boolean",
    )


def _softmax(values: np.ndarray) -> np.ndarray:
    powers = np.exp(values - values.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _table(sums: list, size: int) -> np.ndarray:
    """A group's summed shares for every row; none where there is no group."""
    return np.array([[0.0] * size if x is None else x for x in sums]).reshape(-1, size)


def _smoothed(seen: np.ndarray, towards: np.ndarray, strength: float) -> np.ndarray:
    return (seen + strength * towards) / (seen.sum(axis=1, keepdims=True) + strength)


def _cue(seen: np.ndarray, everywhere: np.ndarray) -> np.ndarray:
    """log of how much likelier a row's cue is in each language than anywhere."""
    rate = seen.sum(axis=1, keepdims=True) / max(everywhere.sum(), 1.0)
    chance = (seen + CUE_STRENGTH * rate) / (everywhere + CUE_STRENGTH)
    return np.where(rate > 0, np.log(np.maximum(chance, 1e-30) / np.maximum(rate, 1e-30)), 0.0)


def document_rows(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents as evidence: their source is the host; they declare nothing else."""
    return rows_of(
        df,
        doc_id=field(id_col).cast("long"),
        text=text_of("text"),
        declared=F.nullif(
            F.lower(F.regexp_extract(text_of("text"), _DECLARED, 1)), F.lit("")
        ),
        suffix=F.lit(None).cast("string"),
        host=field("source").cast("string"),
        domain=F.nullif(
            F.regexp_replace(field("source").cast("string"), r"[0-9]+$", ""), F.lit("")
        ),
    )


def page_rows(df: DataFrame) -> DataFrame:
    """Pages as evidence: text without markup, declared language, suffix, host, domain."""
    host = F.nullif(F.lower(F.regexp_extract(text_of("url"), r"://([^/:?#]+)", 1)), F.lit(""))
    return rows_of(
        df,
        page_id=field("page_id").cast("long"),
        text=F.regexp_replace(text_of("html"), _TAGS, " "),
        declared=F.nullif(
            F.lower(F.regexp_extract(text_of("html"), _DECLARED, 1)), F.lit("")
        ),
        suffix=F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")),
        host=host,
        domain=F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")),
    )


def keep_known(df: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``documents`` shape, with all columns, whose language is accepted.

    A row is told apart by id and text, so equal rows stay or go together.
    """
    text_key = F.xxhash64(text_of("text"), F.lit(7))
    rows = document_rows(df).withColumn("text_key", F.xxhash64("text", F.lit(7)))
    found = identify(rows, fit_text(df), ["doc_id", "text_key"], least)
    keys = found.where("accepted").select(
        F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_text")
    )
    match = field("doc_id").cast("long").eqNullSafe(keys["kept_id"]) & (
        text_key == keys["kept_text"]
    )
    return df.join(keys.distinct(), match, "left_semi")
