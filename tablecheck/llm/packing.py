"""Best-fit packing of documents into sequences, certified by lower bounds.

Documents become token ids with an end id; only those longer than a sequence are cut.
Pieces are dealt by hash to tasks, and each packs its own by best-fit decreasing. Dual
feasible functions give a lower bound on the sequences that any packing needs, for each
task's pieces and, from a histogram of lengths, for all of them. Sequences with gaps
give their pieces back: those of several tasks meet in one, which packs them anew with
its own bound, and so on, until the count equals the bound of all pieces, one task has
seen the rest, or exchanges between as many tasks no longer lower the count. A task that
its bound certifies passes on its emptiest sequences, ``PASSED_ON`` at most, any other all
with a real gap; there are as many tasks as these pieces need, about ``PIECES_PER_TASK``
for each, so no task is large. A round that makes more sequences is not taken.

Edge cases: a null or empty text is the end id alone; an empty table gives no rows;
repeated rows are packed once each; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import mapped, rows_of, stored, text_of, turn_of
from tablecheck.llm.subwords import WordBpe

CAPACITY = 4096
PIECES_PER_TASK = 50_000
TASKS_MET = 16
PASSED_ON = 64
EXCHANGES = 3
_ROW = "__row"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    df: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = 1,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Token pieces of whole documents: doc_id, piece, start, length, ids_crc32 (and ids)."""

    def task():
        turn_of("subwords")
        bpe, end = WordBpe.of(tokenizer), end_id.to_bytes(4, "little")

        def block(columns: dict) -> dict:
            out: dict[str, list] = {name: [] for name in names}
            for doc_id, text in zip(columns["doc_id"], columns["text"]):
                ids = bpe.ids(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if keep_ids:
                        out["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
            return out

        return block

    schema = PIECE + (", ids array<int>" if keep_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]
    rows = rows_of(df, doc_id=field(id_col).cast("long"), text=text_of(text_col))
    return mapped(rows, task, schema)


def best_fit_decreasing(lengths: Sequence[int], capacity: int) -> list[int]:
    """The sequence of each piece. Open sequences are stacked by the room they have left;
    the lowest set bit above a length in a mask of rooms is the tightest fit."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, opened, chosen = 0, 0, [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            chosen[i] = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, chosen[i], opened = capacity, opened, opened + 1
        if room > size:
            rooms[room - size].append(chosen[i])
            mask |= 1 << (room - size)
    return chosen


def lower_bound(histogram: np.ndarray, capacity: int) -> int:
    """Sequences that any packing of ``histogram[length]`` pieces needs at least.

    The largest bound of two families of dual feasible functions: for each threshold up
    to half the capacity, short pieces count nothing and those that leave less room than
    it count as full; and roundings to multiples of 1/k of the capacity.
    """
    sizes = np.arange(capacity + 1, dtype=np.int64)
    count = histogram.astype(np.int64)
    total = int((count * sizes).sum())
    best = -(-total // capacity)
    number = np.concatenate([[0], np.cumsum(count)])
    amount = np.concatenate([[0], np.cumsum(count * sizes)])
    least = np.arange(1, capacity // 2 + 1)
    full = number[-1] - number[capacity - least + 1]
    middle = amount[capacity - least + 1] - amount[least]
    best = max(best, int((-(-(full * capacity + middle) // capacity)).max(initial=0)))
    for k in range(1, 33):
        exact = (sizes * (k + 1)) % capacity == 0
        value = np.where(exact, sizes * k, (sizes * (k + 1)) // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    More columns, ``sequences_bound`` and ``sequences_made``, hold the lower bound for all
    pieces and the number made, so a caller sees how near to optimal the packing is.
    """
    # numbered where they are stored, so that rows of one id or none are dealt like others
    numbered = stored(parts.withColumn(_ROW, F.monotonically_increasing_id()), "pack-pieces")
    parts = numbered.drop(_ROW)
    lengths = parts.groupBy("length").count().collect()  # capacity rows at most
    histogram = np.zeros(capacity + 1, np.int64)
    for length, count in lengths:
        histogram[length] = count
    bound = lower_bound(histogram, capacity)
    tasks = max(1, math.ceil(int(histogram.sum()) / PIECES_PER_TASK))
    schema = parts.schema.add("sequence_id", "long").add("offset", "long").add("open", "boolean")
    waiting = numbered.withColumn("task", F.pmod(F.xxhash64(_ROW), F.lit(tasks))).drop(_ROW)
    done, made, level, exchanges = [], 0, 0, 0
    before = fewest = None  # the open rows so far, and in how many sequences
    while True:
        last = tasks == 1
        packed = waiting.groupBy("task").applyInPandas(_packer(capacity, level, last), schema)
        result = stored(packed, f"pack-{level}")
        closed, still_open, rows = result.agg(
            F.count_distinct(F.when(~F.col("open"), F.col("sequence_id"))),
            F.count_distinct(F.when(F.col("open"), F.col("sequence_id"))),
            F.count(F.when(F.col("open"), 1)),
        ).first()
        lower = fewest is None or closed + still_open < fewest
        if lower or closed + still_open == fewest:
            done.append(result.where(~F.col("open")))
            made += closed
            before, fewest, moving = result.where("open"), still_open, rows
        needed = math.ceil(moving / PIECES_PER_TASK)
        fewer = max(1, math.ceil(tasks / TASKS_MET), min(needed, tasks))
        exchanges = 0 if fewer < tasks else exchanges + 1
        stuck = fewer == tasks and (not lower or exchanges >= EXCHANGES)
        if last or not fewest or made + fewest <= bound or stuck:
            done.append(before)
            made += fewest
            break
        tasks, level = fewer, level + 1
        waiting = before.select(
            *parts.columns, F.pmod(F.xxhash64("sequence_id"), F.lit(tasks)).alias("task")
        )
    return (
        reduce(DataFrame.unionByName, done)
        .drop("open")
        .withColumns({"sequences_bound": F.lit(bound), "sequences_made": F.lit(made)})
    )


def _packer(capacity: int, level: int, last: bool):
    return lambda pdf: _packed(pdf, capacity, level, last)


def _packed(pdf: pd.DataFrame, capacity: int, level: int, last: bool) -> pd.DataFrame:
    """One task's pieces in sequences; ``open`` marks those whose pieces move on."""
    task = int(pdf["task"].iloc[0])
    pdf = pdf.sort_values(
        ["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True
    )
    lengths = pdf["length"].to_numpy(np.int64)
    chosen = np.array(best_fit_decreasing(lengths.tolist(), capacity), np.int64)
    pdf["sequence_id"] = (level << 56) + (task << 24) + chosen
    pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
    filled = np.bincount(chosen, lengths).astype(np.int64)
    moving = np.zeros(len(filled), bool)
    if not last:
        emptiest = np.argsort(filled, kind="stable")
        moving[emptiest[filled[emptiest] < capacity][:PASSED_ON]] = True
        if len(filled) > lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity):
            moving |= filled < capacity * 63 // 64  # not certified: all with a real gap
    pdf["open"] = moving[chosen]
    return pdf.drop(columns="task")
