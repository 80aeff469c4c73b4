"""Exact top-k by inner product over a pivot-distance index.

Vectors get one more component that makes all of them equally long, so that the largest inner
product is the smallest distance. Each vector is keyed by its nearest pivot and its distance to it,
and the sorted keys are cut into annuli. For a query at distance d from the pivot, a vector of the
annulus [low, high] is no nearer than max(0, d - high, low - d). Queries are packed by their own key,
so a block of them has narrow distances to every pivot, and a small table of annuli against blocks of
queries says what a block can reach where. A block opens its most promising annuli first; then those
that its raised bounds, the k-th best scores so far, still let in. Vectors are shipped for these only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.vectors import blocks, matrix, unpack, usable
from candlelake.session import settle

PIVOTS = 64          # rows of the sample that become pivots: a fixed bound
ANNULUS = 2048       # vectors of a block
QUERIES = 512        # queries of a block
FIRST = 4            # annuli that a block of queries opens before the others are bounded
CHUNK = 32           # blocks of queries that meet an annulus in one task
PER_PARTITION = 4    # blocks in a partition of the index
LOWEST = -(2.0 ** 63)


def scaled(column: str, factor: int) -> F.Column:
    """Whole-number components: floor(factor * x), in doubles."""
    return F.transform(F.col(column), lambda x: F.floor(x * F.lit(float(factor))).cast("double"))


def _distances(points: np.ndarray, most: float, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots in the space with the additional component."""
    def lifted(x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(0, most - (x * x).sum(axis=1)))[:, None]])

    a, b = lifted(points), lifted(pivots)
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(0, square))


def _products(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of whole numbers; partial sums stay below the largest square length."""
    if most < 2.0 ** 53:
        return a @ b.T
    return (a.astype(np.int64) @ b.astype(np.int64).T).astype(np.float64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row and their ids, ties to the smaller id; ``ids`` ascend."""
    k = min(k, scores.shape[1])
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, axis=1), ids[order]


def _query_distances(queries: np.ndarray, most: float, pivots: np.ndarray) -> np.ndarray:
    """Distances of queries, whose additional component is zero, to the pivots."""
    return np.sqrt(np.maximum(0, (queries * queries).sum(axis=1)[:, None] + most - 2 * queries @ pivots.T))


def _reach(square, most: float, least):
    """The highest score of a vector that is ``least`` away from a query, with room for rounding of the distances."""
    return (square + most - least * least) / 2 + 1e-6 * (square + most) + 1


def top_k(rows: DataFrame, id_col: str, vec_col: str, k: int = 5, every: int = 50, factor: int = 256,
          pivots: int = PIVOTS) -> DataFrame:
    """Columns ``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best rows for each query.

    Queries are the rows whose id is divisible by ``every``, one per id; candidates are all rows but
    those of the query's own id. Fewer rows come back where there are fewer candidates, none for an
    empty table. Ties go to the smaller id; repeated rows are candidates each on their own. See
    ``usable`` for the rows that take no part. Other columns are left out. Scores have to fit a long.
    """
    spark = rows.sparkSession
    points = settle(usable(rows, id_col, vec_col).select("id", scaled("v", factor).alias("v")), "points")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    most = points.agg(F.max(square)).first()[0]
    schema = "query_id long, rank int, vec_id long, score long"
    if most is None:
        return spark.createDataFrame([], schema)
    if most >= 2.0 ** 62:
        raise ValueError("scores do not fit a long")
    chosen = points.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    centres = np.array([r["v"] for r in chosen], np.float64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                apart = _distances(np.stack(batch["v"].to_numpy()), most, centres)
                near = apart.argmin(axis=1)
                yield batch.assign(pivot=near.astype(np.int32), dist=apart[np.arange(len(near)), near])

    placed = settle(points.mapInPandas(place, "id long, v array<double>, pivot int, dist double"), "placed")
    index = blocks(placed, ["pivot", "dist", "id"], ANNULUS, PER_PARTITION, cut="pivot")

    def seed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids, data = unpack(r.ids, r.vectors)
                own = np.flatnonzero(ids % every == 0)
                if len(own) and len(ids) > k:
                    scores = _products(data[own], data, most)
                    scores[ids[own][:, None] == ids[None, :]] = LOWEST
                    yield pd.DataFrame({"id": ids[own], "v": list(data[own]), "bound": best(scores, ids, k)[0][:, -1]})

    # by vector too: where rows of one id differ, only the bounds of the query's own vector hold for it
    first = index.mapInPandas(seed, "id long, v array<double>, bound double").groupBy("id", "v").agg(F.max("bound").alias("bound"))
    own = F.min(F.struct("v", "pivot", "dist")).alias("own")
    asked = placed.where(F.pmod(F.col("id"), F.lit(every)) == 0).groupBy("id").agg(own).select("id", "own.*")
    groups = max(1, -(-asked.count() // QUERIES))
    asked = asked.join(first, ["id", "v"], "left").fillna(LOWEST, ["bound"]).repartitionByRange(groups, "pivot", "dist", "id")
    asked = settle(asked.select("id", "v", "bound", F.spark_partition_id().alias("q")), "asked")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        v, bound = matrix(group["v"]), group["bound"].to_numpy(np.float64)
        apart = _query_distances(v, most, centres)
        near = [{"low": low, "high": high} for low, high in zip(apart.min(axis=0), apart.max(axis=0))]
        return pd.DataFrame([[int(group["q"].iat[0]), group["id"].to_numpy(np.int64).tobytes(), v.tobytes(), bound.tobytes(),
                              near, (v * v).sum(axis=1).max(), bound.min()]],
                            columns=["q", "q_ids", "q_vectors", "q_bounds", "near", "square", "least"])

    def packed(rows: DataFrame) -> DataFrame:
        return settle(rows.groupBy("q").applyInPandas(
            pack, "q int, q_ids binary, q_vectors binary, q_bounds binary, near array<struct<low double, high double>>, "
                  "square double, least double"), "queries")

    def expand(asking: pd.DataFrame, annulus: pd.DataFrame) -> pd.DataFrame:
        """The best of one annulus for some blocks of queries."""
        ids, data = unpack(annulus["a_ids"].iat[0], annulus["a_vectors"].iat[0])
        low, high, centre = annulus["a_low"].iat[0], annulus["a_high"].iat[0], centres[annulus["a_pivot"].iat[0]][None, :]
        found = []
        for r in asking.itertuples():
            q_ids, q = unpack(r.q_ids, r.q_vectors)
            apart = _query_distances(q, most, centre)[:, 0]
            reach = _reach((q * q).sum(axis=1), most, np.maximum(0, np.maximum(apart - high, low - apart)))
            live = np.flatnonzero(reach >= np.frombuffer(r.q_bounds, np.float64))
            if len(live):
                scores = _products(q[live], data, most)
                scores[q_ids[live][:, None] == ids[None, :]] = LOWEST
                s, i = best(scores, ids, k)
                keep = s > LOWEST
                found.append((np.repeat(q_ids[live], keep.sum(axis=1)), i[keep], s[keep].astype(np.int64)))
        columns = zip(*found) if found else [[np.zeros(0, np.int64)]] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, columns))))

    def opened(pairs: DataFrame, queries: DataFrame) -> DataFrame:
        pairs = pairs.select("q", "part", "seq", F.floor(F.col("q") / CHUNK).alias("chunk"))
        annuli = pairs.select("part", "seq", "chunk").distinct().join(index, ["part", "seq"])
        asking = pairs.join(queries.select("q", "q_ids", "q_vectors", "q_bounds"), "q")
        annuli = annuli.toDF(*[f"a_{c}" for c in annuli.columns])
        found = asking.groupBy("part", "seq", "chunk").cogroup(annuli.groupBy("a_part", "a_seq", "a_chunk")).applyInPandas(
            expand, "query_id long, vec_id long, score long")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    queries = packed(asked)
    far = queries.select("q", "square", "least", F.posexplode("near").alias("pivot", "near"))
    gap = F.greatest(F.lit(0.0), F.col("near.low") - F.col("high"), F.col("low") - F.col("near.high"))
    pairs = index.select("part", "seq", "pivot", "low", "high").join(far, "pivot").withColumn(
        "reach", _reach(F.col("square"), most, gap)).where("reach >= least")
    pairs = settle(pairs.select("q", "part", "seq", "reach"), "pairs")
    most_first = Window.partitionBy("q").orderBy(F.desc("reach"), "part", "seq")
    early = settle(pairs.withColumn("n", F.row_number().over(most_first)).where(F.col("n") <= FIRST).drop("n"), "early")
    so_far = settle(opened(early, queries), "so-far")
    # the k-th best so far is a bound where there are k
    raised = so_far.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("kth"))
    queries = packed(asked.join(raised, "id", "left").select(
        "id", "v", F.greatest("bound", F.coalesce("kth", F.lit(LOWEST))).alias("bound"), "q"))
    late = pairs.join(early, ["q", "part", "seq"], "left_anti").join(queries.select("q", "least"), "q").where("reach >= least")
    found = so_far.unionByName(opened(settle(late.select("q", "part", "seq"), "late"), queries))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
