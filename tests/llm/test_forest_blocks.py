"""The forest's search over blocks against a plain version, and what it sends to the driver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.llm import forest


def plain(planes, blocks, q_ids, queries, k, wanted):
    """Every block's offered rows, compared one query at a time."""
    found = {q: [] for q in q_ids.tolist()}
    for ids, points in blocks:
        tree = forest.Forest(planes, ids, points)
        low, high = tree.ranges(queries, wanted)
        for n, q in enumerate(queries.astype(np.float64)):
            offered = np.unique(np.concatenate([tree.order[t, low[n, t]:high[n, t]] for t in range(planes.trees)]))
            rows = offered[ids[offered] != q_ids[n]]
            apart = np.sqrt(((points[rows].astype(np.float64) - q) ** 2).sum(axis=1))
            found[int(q_ids[n])] += zip(apart.tolist(), ids[rows].tolist())
    return {q: sorted(rows)[:k] for q, rows in found.items()}


def searched(planes, blocks, q_ids, queries, k, wanted):
    search = forest.Search(planes, q_ids, queries, k, wanted)
    for ids, points in blocks:
        search.meet(ids, points)
    found = {q: [] for q in q_ids.tolist()}
    for batch in search.found(7):
        for r in batch.to_pylist():
            found[r["query_id"]].append((r["score"], r["vec_id"]))
    return found


@pytest.mark.parametrize("wanted", [1, 40, 300, 10_000])
@pytest.mark.parametrize("scale", [1, 1e-12, 1e-25, 1e18])
def test_search_equals_the_plain_forest(wanted, scale):
    rng = np.random.default_rng(5)
    points = rng.standard_normal((1500, 12)).astype(np.float32) * np.float32(scale)
    points[200:500] = points[200]                                    # one vector, many ids
    points[700:760] = points[700]
    points[900] = 1000 * points[900]
    ids = rng.permutation(1500)
    ids[700:740] = ids[700]                                          # one id, the same vector many times
    ids[1000:1020] = ids[1000]                                       # one id, other vectors
    planes = forest.Planes(points[:400], trees=6, bits=14)
    for numbers in (points, points.astype(np.float64) * 1.1):
        order = np.concatenate([rng.permutation(600), 600 + rng.permutation(900)])
        blocks = [(ids[order[n:n + 500]], numbers[order[n:n + 500]]) for n in (0, 500, 1000)] + [(ids[:3], numbers[:3])]
        asked = np.array([0, 200, 201, 300, 700, 750, 900, 1000, 1019, 1400])
        args = planes, blocks, ids[asked], numbers[asked], 4, wanted
        if len(set(ids[asked])) < len(asked):
            asked = np.array([n for i, n in enumerate(asked) if ids[n] not in ids[asked[:i]]])
            args = planes, blocks, ids[asked], numbers[asked], 4, wanted
        assert searched(*args) == plain(*args)


def test_result_is_that_of_any_cells(spark, monkeypatch):
    rng = np.random.default_rng(6)
    points = rng.standard_normal((1500, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "i long, e array<float>")
    df = df.unionByName(df.where("i < 300")).repartition(5)

    def rows(**changes):
        for name, value in changes.items():
            monkeypatch.setattr(forest, name, value)
        found = forest.nearest(df, "i", "e", k=3, every=20, trees=8, bits=10, candidates=60, block=100)
        return sorted(map(tuple, found.collect()))

    whole = rows()
    assert len(whole) == 3 * 75
    assert rows(HELD=2000) == whole                                  # many sets of queries
    monkeypatch.undo()
    assert rows(GROUPS=40, QUERIES=7, TILE=30, PAIRS=50) == whole


def test_the_driver_gets_no_more_than_the_sample(spark):
    """Tasks used to send as many rows each as the sample has."""
    df = spark.range(0, 60_000, 1, 24).select(F.col("id").alias("i"), F.array(
        *[F.randn(seed).cast("float") for seed in range(24)]).alias("e"))
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    conf.set("spark.driver.maxResultSize", "3m")
    try:
        found = forest.nearest(df, "i", "e", k=2, every=20_000, trees=8)
        assert found.count() == 6
    finally:
        conf.set("spark.driver.maxResultSize", before)


def test_the_sample_is_that_of_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(forest, "SAMPLE", 50)
    df = spark.range(3000).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    first = df.orderBy(F.xxhash64("id"), "id").limit(50).collect()
    assert forest._sample(df, 3000).tolist() == [r["v"] for r in first]
    few = df.withColumn("id", F.col("id") % 3)                       # fewer hashes than the bound expects
    assert forest._sample(few, 3000).shape == (50, 2)
    assert len(forest._sample(df.limit(20), 20)) == 20
