"""Exact top-k search by inner product in M-trees.

Vectors are dealt to the nearest of ``PIVOTS`` pivots, the rows first by hash, and a
pivot's rows by hash to trees of about ``ROWS_PER_TREE``, so a pivot that a third of all
rows are near to becomes many trees. A tree is pages of at most ``PAGE`` entries: a leaf
holds vectors, an inner page its children's centres, covering radii and distances to their
parent's centre. With |x - c| known, q.x is at most q.c + |q| |x - c|: the triangle
inequality, moved to inner products. Pages wait in a queue ordered by that bound. A
child's bound by its parent's product and the stored distance to it comes first; its own
product is computed only if that bound is still good enough, and so for the vectors of a
leaf. A page is skipped once its bound is below a query's k-th score.

Every query first searches one tree of its nearest pivot; with the k-th score from there it
goes on to the trees whose pivot's bound is not below it, in blocks of queries.

Scores are exact integers; bounds are floats widened by more than their error. Ties go to
the smaller id.

Edge cases: null vectors, and vectors with null or non-finite components, take no part,
neither do rows with a null id; of vectors of different length the missing components count
as 0; an empty vector scores 0; rows that repeat an id are candidates each, and no query
finds rows of its own id; fewer than k candidates are all returned; an empty table gives no
rows; other columns are ignored. Scores beyond 64 bits are cut to the largest.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import mapped, rows_of, stored

PIVOTS = 16
ROWS_PER_TREE = 8192
PAGE = 512
FANOUT = 12
LONGEST = (1 << 63) - 1


class Tree:
    """Pages of one M-tree over integer vectors held as floats."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.largest = float(np.abs(vectors).max(initial=0))
        #: a page: centre, (ids, vectors) or None, distances of those or of children to the
        #: centre, the largest of them, radii and children
        self.pages: list[tuple] = []
        order = np.lexsort((ids,))
        self.root, _ = self._page(order, vectors[order[0]], np.random.default_rng(len(ids)))

    def _page(self, rows: np.ndarray, centre: np.ndarray, rng) -> tuple[int, float]:
        away = np.sqrt(((self.vectors[rows] - centre) ** 2).sum(axis=1))
        radius = float(away.max())
        if len(rows) <= PAGE or radius == 0:
            number = len(self.pages)
            held = (self.ids[rows], np.ascontiguousarray(self.vectors[rows]))
            self.pages.append((centre, held, away, radius, None, None))
            return number, radius
        seeds = rows[rng.choice(len(rows), FANOUT, replace=False)]
        seeds[0] = rows[away.argmax()]
        points = self.vectors[rows]
        near = np.stack([((points - self.vectors[s]) ** 2).sum(axis=1) for s in seeds])
        owner = near.argmin(axis=0)
        parts = [(self.vectors[s], rows[owner == i]) for i, s in enumerate(seeds)]
        made = [(c, *self._page(part, c, rng)) for c, part in parts if len(part)]
        number = len(self.pages)
        between = np.array([np.sqrt(((c - centre) ** 2).sum()) for c, _, _ in made])
        radii = np.array([r for _, _, r in made])
        children = [child for _, child, _ in made]
        self.pages.append((centre, None, between, float(between.max()), radii, children))
        return number, radius

    def search(self, query_id: int, query: np.ndarray, k: int, least: tuple) -> list[tuple]:
        """The k best (score, -id) at least as good as ``least``, best first."""
        length = float(np.sqrt((query**2).sum()))
        exact = self.largest * float(np.abs(query).max(initial=0)) * len(query) < 2**53
        best: list[tuple] = []  # a heap, the worst first
        floor = least
        product = self.pages[self.root][0] @ query
        waiting = [(-math.inf, self.root, float(product))]
        while waiting:
            bound, number, product = heapq.heappop(waiting)
            if -bound < floor[0]:
                break
            centre, held, away, widest, radii, children = self.pages[number]
            slack = 1e-9 * (abs(product) + length * (1 + widest)) + 1e-6
            if held is None:
                by_parent = product + length * (away + radii) + slack
                for i in np.flatnonzero(by_parent >= floor[0]):
                    its = float(self.pages[children[i]][0] @ query)
                    reach = min(its + length * radii[i] + slack, by_parent[i], -bound)
                    if reach >= floor[0]:
                        heapq.heappush(waiting, (-reach, children[i], its))
                continue
            ids, vectors = held
            near = product + length * away + slack >= floor[0]
            if not near.all():
                ids, vectors = ids[near], vectors[near]
            scores = vectors @ query if exact else exact_products(vectors, query)
            good = np.flatnonzero(scores >= floor[0])
            if len(good) > 4 * k:  # what is below the k-th here is below the k-th of all
                good = good[ids[good] != query_id]
                good = good[np.lexsort((ids[good], -scores[good]))[:k]]
            for i in good:
                if ids[i] == query_id:
                    continue
                entry = (int(scores[i]), -int(ids[i]))
                if entry >= floor:
                    heapq.heappush(best, entry)
                    if len(best) > k:
                        heapq.heappop(best)
                    if len(best) == k:
                        floor = max(floor, best[0])
        return sorted(best, reverse=True)


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products too large for sums of floats to be exact."""
    whole = [int(x) for x in query]
    sums = [sum(int(x) * y for x, y in zip(row, whole)) for row in vectors]
    return np.array([max(-LONGEST, min(LONGEST, s)) for s in sums], np.int64)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for the rows for which ``is_query`` holds.

    Components x count as floor(scale * x).
    """
    spark = df.sparkSession
    values = field(vector_col).cast("array<double>")
    scaled = F.transform(values, lambda x: x * scale)
    usable = field(id_col).isNotNull() & values.isNotNull() & F.forall(
        scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = stored(
        df.where(usable).select(
            field(id_col).cast("long").alias("vec_id"),
            scaled.alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "topk-rows",
    )
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    schema = "query_id long, rank int, vec_id long, score long"
    if width is None:
        return spark.createDataFrame([], schema)
    pivots = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("vector")
    centres = _matrix([row["vector"] for row in pivots.collect()], width)

    def nearest():
        def block(columns: dict) -> dict:
            points = _matrix(columns["vector"], width)
            away = np.stack([((points - c) ** 2).sum(axis=1) for c in centres])
            return {
                "vec_id": columns["vec_id"],
                "asks": columns["asks"],
                "vector": [row.tobytes() for row in points],
                "pivot": away.argmin(axis=0),
                "away": np.sqrt(away.min(axis=0)),
            }

        return block

    dealt = stored(
        mapped(rows, nearest, "vec_id long, asks boolean, vector binary, pivot int, away double"),
        "topk-dealt",
    )
    cells = {
        row["pivot"]: (max(1, math.ceil(row["n"] / ROWS_PER_TREE)), row["radius"])
        for row in dealt.groupBy("pivot")
        .agg(F.count("*").alias("n"), F.max("away").alias("radius"))
        .collect()  # a row for each pivot
    }
    trees = F.create_map(*[F.lit(x) for p, (n, _) in cells.items() for x in (p, n)])
    salt = F.pmod(F.xxhash64("vec_id"), trees[F.col("pivot")].cast("long"))
    data = dealt.select("vec_id", "vector", "pivot", salt.alias("salt"))
    queries = dealt.where("asks").select(F.col("vec_id").alias("query_id"), "vector", "pivot")
    lowest = F.lit(-LONGEST).alias("floor")
    home = queries.select(
        "query_id",
        "vector",
        "pivot",
        F.pmod(F.xxhash64("query_id"), trees[F.col("pivot")].cast("long")).alias("salt"),
        lowest,
    )
    found = stored(_searched(data, home, k, width), "topk-home")
    floors = found.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(-LONGEST).alias("floor")
    )

    def spread():
        lengths = {p: radius for p, (_, radius) in cells.items()}

        def block(columns: dict) -> dict:
            out: dict[str, list] = {name: [] for name in ("query_id", "vector", "pivot", "salt", "floor")}
            for query_id, vector, own, own_salt, floor in zip(
                columns["query_id"], columns["vector"], columns["pivot"], columns["salt"],
                columns["floor"],
            ):
                query = np.frombuffer(vector)
                length = float(np.sqrt((query**2).sum()))
                for pivot, radius in lengths.items():
                    product = float(centres[pivot] @ query)
                    slack = 1e-9 * (abs(product) + length * (1 + radius)) + 1e-6
                    if product + length * radius + slack < floor:
                        continue
                    for salt in range(cells[pivot][0]):
                        if (pivot, salt) != (own, own_salt):
                            for name, value in zip(out, (query_id, vector, pivot, salt, floor)):
                                out[name].append(value)
            return out

        return block

    away = home.drop("floor").join(floors, "query_id", "left").fillna(-LONGEST, ["floor"])
    further = mapped(
        away, spread, "query_id long, vector binary, pivot int, salt long, floor long"
    )
    everything = found.union(_searched(data, further, k, width))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        everything.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _matrix(vectors: list, width: int) -> np.ndarray:
    """Rows of floored components, short ones filled up with 0."""
    out = np.zeros((len(vectors), width))
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    return np.floor(out)


def _searched(data: DataFrame, queries: DataFrame, k: int, width: int) -> DataFrame:
    """Each tree's best for the queries that were sent to it."""

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(asked):
            points = np.frombuffer(b"".join(rows["vector"])).reshape(len(rows), width)
            tree = Tree(rows["vec_id"].to_numpy(np.int64), points)
            for query_id, vector, floor in zip(asked["query_id"], asked["vector"], asked["floor"]):
                best = tree.search(query_id, np.frombuffer(vector), k, (floor, -LONGEST))
                out += [(query_id, -minus, score) for score, minus in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(np.int64)

    return (
        data.groupBy("pivot", "salt")
        .cogroup(queries.groupBy("pivot", "salt"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
