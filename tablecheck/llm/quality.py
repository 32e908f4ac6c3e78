"""Document quality by a convolutional network over bytes.

Learned filters slide over the UTF-8 bytes of a whole document, cut into chunks that
overlap by more than a filter's width, so no window of bytes is missed. Each filter's
largest response in a chunk is kept; the mean, largest and smallest of these over the
chunks pass one hidden layer and give one probability. Training runs in numpy on a
bounded sample of labelled rows: ``sample`` ids of either label at most, the first by
hash, and of those the documents of at most ``sample_bytes`` bytes. A fifth of them is
cropped to a few words in each epoch, so that being short is not taken for being bad
(the length is an input of the hidden layer, too). Every document is scored whole, chunk by chunk, so memory does not grow with its length.

Edge cases: a null or empty text is one chunk of padding and gets a score like any
other; repeated rows are scored once each; several labels of one id count with their
mean; null ids or labels teach nothing; without labels of both kinds every score is the
labels' mean, or 0.5 without labels; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import bytes_of, id_remainder, mapped, rows_of, text_of, turn_of

FILTERS = 24
WIDTH = 6
HIDDEN = 24
CHUNK = 256
STEP = 224
AT_ONCE = 48
POOLED = 3 * FILTERS + 1


@dataclass
class ByteConvNet:
    """``tables[j, byte, filter]`` adds up to a filter's response at a place."""

    tables: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> ByteConvNet:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls(
            normal(WIDTH, 256, FILTERS, scale=0.25),
            np.full(FILTERS, -0.3, np.float32),
            normal(POOLED, HIDDEN, scale=POOLED**-0.5),
            np.zeros(HIDDEN, np.float32),
            normal(HIDDEN, scale=HIDDEN**-0.5),
            np.zeros(1, np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [
            self.tables, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias
        ]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest response in each chunk, and where it is."""
        best = np.empty((len(chunks), FILTERS), np.float32)
        place = np.empty((len(chunks), FILTERS), np.int64)
        places = CHUNK - WIDTH + 1
        for at in range(0, len(chunks), AT_ONCE):
            part = chunks[at : at + AT_ONCE]
            response = self.tables[0][part[:, :places]]
            for j in range(1, WIDTH):
                response += self.tables[j][part[:, j : j + places]]
            where = response.argmax(axis=1)
            place[at : at + AT_ONCE] = where
            best[at : at + AT_ONCE] = np.take_along_axis(response, where[:, None], 1)[:, 0]
        return np.maximum(best + self.bias, 0), place

    def largest(self, chunks: np.ndarray) -> np.ndarray:
        """Only the largest responses."""
        places = CHUNK - WIDTH + 1
        best = np.empty((len(chunks), FILTERS), np.float32)
        for at in range(0, len(chunks), AT_ONCE):
            part = chunks[at : at + AT_ONCE]
            response = self.tables[0][part[:, :places]]
            for j in range(1, WIDTH):
                response += self.tables[j][part[:, j : j + places]]
            best[at : at + AT_ONCE] = response.max(axis=1)
        return np.maximum(best + self.bias, 0)

    def features(self, data: bytes, at_once: int = 4096) -> np.ndarray:
        """Mean, largest and smallest pooled response over all chunks of a document."""
        total, most, least, count = 0.0, None, None, 0
        for chunks in chunk_groups(data, at_once):
            best = self.largest(chunks)
            total = total + best.sum(axis=0, dtype=np.float64)
            most = best.max(axis=0) if most is None else np.maximum(most, best.max(axis=0))
            least = best.min(axis=0) if least is None else np.minimum(least, best.min(axis=0))
            count += len(best)
        pooled = [total / count, most, least, [_length(len(data))]]
        return np.concatenate(pooled).astype(np.float32)

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh(features @ self.hidden + self.hidden_bias)
        logits = hidden @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -40, 40)))


def _length(size: int) -> float:
    return math.log1p(min(size, 2 * CHUNK)) / 3


def chunk_groups(data: bytes, at_once: int) -> Iterator[np.ndarray]:
    """A document's overlapping chunks, ``at_once`` at a time, the last one padded."""
    count = 1 + max(0, -(-(len(data) - CHUNK) // STEP))
    for first in range(0, count, at_once):
        here = min(at_once, count - first)
        span = (here - 1) * STEP + CHUNK
        part = data[first * STEP : first * STEP + span].ljust(span, b"\0")
        flat = np.frombuffer(part, np.uint8)
        yield np.lib.stride_tricks.as_strided(flat, (here, CHUNK), (STEP, 1))


def train(
    texts: Sequence[bytes], labels: Sequence[float], steps: int = 900, seed: int = 7
) -> ByteConvNet:
    """Adam on batches of documents; only the places of largest responses get gradients."""
    rng = np.random.default_rng(seed)
    net = ByteConvNet.fresh(rng)
    weights = net.weights()
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    y, step, batch = np.asarray(labels, np.float32), 0, 32
    # both labels weigh the same, however many there are of each
    weight = np.where(y > 0.5, 0.5 / max(1, (y > 0.5).sum()), 0.5 / max(1, (y <= 0.5).sum()))
    weight = (weight * len(y)).astype(np.float32)
    epochs = max(1, round(steps * batch / len(texts)))
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        shown = [_cropped(text, rng) if rng.random() < 0.2 else text for text in texts]
        chunks = [np.concatenate(list(chunk_groups(text, 4096))) for text in shown]
        lengths = np.array([_length(len(text)) for text in shown], np.float32)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            step += 1
            grads = _gradients(net, chunks, lengths, docs, y, weight)
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _cropped(text: bytes, rng: np.random.Generator) -> bytes:
    """Some words from anywhere in the text."""
    at = int(rng.integers(0, max(1, len(text) - 20)))
    part = text[at : at + int(rng.integers(16, 200))]
    return part[part.find(b" ") + 1 :] if at else part


def _gradients(net, chunks, lengths, docs, y, weight) -> list[np.ndarray]:
    counts = np.array([len(chunks[d]) for d in docs])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    part = np.concatenate([chunks[d] for d in docs])
    best, place = net.pooled(part)
    mean = np.add.reduceat(best, starts) / counts[:, None]
    most, least = np.maximum.reduceat(best, starts), np.minimum.reduceat(best, starts)
    features = np.concatenate([mean, most, least, lengths[docs, None]], axis=1)
    hidden = np.tanh(features @ net.hidden + net.hidden_bias)
    chance = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -40, 40)))
    error = (chance - y[docs]) * weight[docs] / len(docs)
    to_hidden = error[:, None] * net.out * (1 - hidden**2)
    to_features = to_hidden @ net.hidden.T
    owner = np.repeat(np.arange(len(docs)), counts)
    to_mean, to_most, to_least = np.split(to_features[:, :-1], 3, axis=1)
    to_best = (to_mean / counts[:, None])[owner]
    to_best += to_most[owner] * (best == most[owner]) + to_least[owner] * (best == least[owner])
    to_best *= best > 0
    tables = np.zeros_like(net.tables)
    filters = np.broadcast_to(np.arange(FILTERS), place.shape)
    rows = np.arange(len(part))[:, None]
    for j in range(WIDTH):
        np.add.at(tables[j], (part[rows, place + j], filters), to_best)
    return [
        tables, to_best.sum(axis=0), features.T @ to_hidden, to_hidden.sum(axis=0),
        hidden.T @ error, error.sum(keepdims=True),
    ]


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    held_out_mod: int = 5,
    sample: int = 2500,
    sample_bytes: int = 16_384,
) -> ByteConvNet | float:
    """The network, or the labels' mean where there is only one kind of label."""
    known = (
        rows_of(labels, doc_id=field(id_col).cast("long"), label=field(label_col).cast("double"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .where(id_remainder("doc_id", held_out_mod) != 0)
        .groupBy("doc_id")
        .agg(F.avg("label").alias("label"))
    )
    chosen = [
        known.where(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for kind in (F.col("label") > 0.5, F.col("label") <= 0.5)
    ]
    ids = {row["doc_id"]: row["label"] for part in chosen for row in part.collect()}
    if not ids:
        return 0.5
    wanted = df.sparkSession.createDataFrame(list(ids.items()), "doc_id long, label double")
    rows = (
        rows_of(df, doc_id=field(id_col).cast("long"), data=bytes_of(text_col))
        .where(F.length("data") <= sample_bytes)
        .join(F.broadcast(wanted), "doc_id")  # twice the sample at most
        .dropDuplicates(["doc_id"])
        .select("doc_id", "data", "label")
        .collect()
    )
    rows.sort(key=lambda row: row["doc_id"])
    y = [row["label"] for row in rows]
    if not y or min(y) > 0.5 or max(y) <= 0.5:
        return float(np.mean(y or list(ids.values())))
    return train([bytes(row["data"]) for row in rows], y)


def scores(
    df: DataFrame, model: ByteConvNet | float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's id and score."""

    def task():
        turn_of("quality")

        def block(columns: dict) -> dict:
            if isinstance(model, float):
                score = np.full(len(columns["doc_id"]), model)
            else:
                texts = [text.encode("utf-8", "replace") for text in columns["text"]]
                score = model.probabilities(np.stack([model.features(t) for t in texts]))
            return {"doc_id": columns["doc_id"], "score": score}

        return block

    rows = rows_of(df, doc_id=field(id_col).cast("long"), text=text_of(text_col))
    return mapped(rows, task, "doc_id long, score double")


def keep_good(
    df: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows, whole and with all their columns, whose score reaches the threshold.

    Rows are scored in place, so repeated and null ids keep or lose each row by itself.
    """
    model = fit(df, labels, id_col, text_col)
    scored = F.pandas_udf(_scorer(model), "double")
    return df.where(scored(text_of(text_col)) >= threshold)


def _scorer(model: ByteConvNet | float):
    def score(texts: pd.Series) -> pd.Series:
        if isinstance(model, float):
            return pd.Series(np.full(len(texts), model))
        data = [model.features(text.encode("utf-8", "replace")) for text in texts]
        return pd.Series(model.probabilities(np.stack(data))) if data else pd.Series([], dtype=float)

    return score
