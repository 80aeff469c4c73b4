"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree gives a vector a long string of bits: on which side of random hyperplanes it lies. The
strings are kept in sorted arrays. A query descends in all trees to the rows with the longest common
prefix, then ascends in step, one bit at a time in every tree, until the trees together offer enough
candidates; these are compared exactly.

Rows are dealt to blocks of bounded size, each with its own forest, and every query searches every
block. A task takes a share of the blocks, one after the other, and keeps the nearest so far of its
queries; Spark merges the nearest of all tasks. The forest offers a query a large part of a block, so
a matrix product first says which rows can still be among the nearest at all; their distances are then
worked out in doubles, and the forest is asked whether it offers them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.vectors import components
from candlelake.session import settle

TREES = 96
BITS = 24            # length of a hash string
BLOCK = 8192         # rows of a block
QUERIES = 512        # queries of a matrix product
TILE = 1024          # rows of a matrix product, so that its result stays near the processor
CANDIDATES = 3600    # offered by all trees of a block together, repeats included
SAMPLE = 4096        # rows on which the hyperplanes' offsets are fitted: a fixed bound
SEED = 7
GROUPS = 8           # shares of the blocks at least, where there are as many blocks: queries are copied to each
HELD = 160 << 20     # bytes of queries that a task holds; with more the blocks are copied for each set of queries
TOP = 12             # bits of a prefix that are counted in tables
PAIRS = 1 << 15      # pairs of a query and a row that are worked out at a time


class Planes:
    """Hyperplanes of a forest: orthogonal in sets, each through the middle of the sample."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        rng, size, n = np.random.default_rng(seed), sample.shape[1], trees * bits
        sets = [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-n // size))]
        self.directions = np.hstack(sets)[:, :n].astype(np.float32)
        self.offsets = np.median(sample.astype(np.float32) @ self.directions, axis=0)
        self.trees, self.bits = trees, bits

    def strings(self, points: np.ndarray, at_a_time: int = 2048) -> np.ndarray:
        """Hash strings as integers, one row per tree."""
        out = np.zeros((len(points), self.trees), np.int32 if self.bits <= 30 else np.int64)
        for n in range(0, len(points), at_a_time):
            sides = points[n:n + at_a_time].astype(np.float32) @ self.directions > self.offsets
            sides = np.pad(sides.reshape(-1, self.trees, self.bits), ((0, 0), (0, 0), (-self.bits % 8, 0)))
            for byte in np.moveaxis(np.packbits(sides, axis=2), 2, 0):
                out[n:n + at_a_time] = out[n:n + at_a_time] << 8 | byte
        return out.T


class Forest:
    """Hash strings of one block of rows."""

    def __init__(self, planes: Planes, ids: np.ndarray, points: np.ndarray):
        self.planes, self.ids, self.points = planes, ids, points
        self.strings = planes.strings(points)
        self.top = min(TOP, planes.bits)

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.strings, axis=1, kind="stable")

    @cached_property
    def sorted(self) -> np.ndarray:
        return np.sort(self.strings, axis=1)

    @cached_property
    def starts(self) -> np.ndarray:
        """Per tree and prefix of ``top`` bits, the number of rows with a smaller one."""
        trees, width = self.planes.trees, 1 << self.top
        prefix = (self.strings >> self.planes.bits - self.top) + width * np.arange(trees)[:, None]
        counts = np.bincount(prefix.ravel(), minlength=trees * width).reshape(trees, width)
        return np.hstack([np.zeros((trees, 1), np.int32), np.cumsum(counts, axis=1, dtype=np.int32)])

    def ranges(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree, the rows that share the prefix at which all trees offer ``wanted`` rows."""
        strings, bits = self.planes.strings(queries), self.planes.bits
        shape = (len(queries), self.planes.trees)
        low, high, open_ = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.ones(len(queries), bool)
        for drop in range(bits + 1):            # from the whole string upwards, all trees in step
            live = np.flatnonzero(open_)
            if not len(live):
                break
            prefix = strings[:, live] >> drop << drop
            for t in range(self.planes.trees):
                low[live, t] = np.searchsorted(self.sorted[t], prefix[t], "left")
                high[live, t] = np.searchsorted(self.sorted[t], prefix[t] + (1 << drop), "left")
            open_[live] = (high[live] - low[live]).sum(axis=1) < wanted
        return low, high

    def ascends(self, strings: np.ndarray, drop: np.ndarray, wanted: int) -> np.ndarray:
        """Whether a query is offered less than ``wanted`` rows where ``drop`` bits of its strings are left out."""
        below, trees = self.planes.bits - self.top, self.planes.trees
        up = np.maximum(drop - below, 0)[:, None].astype(strings.dtype)
        first = strings >> below >> up << up
        at = np.arange(trees) * self.starts.shape[1] + first
        starts = self.starts.ravel()
        fewer = (starts[at + (1 << up)] - starts[at]).sum(axis=1) < wanted
        exact = np.flatnonzero(~fewer & (drop < below))         # longer prefixes than the tables have
        if len(exact):
            left = drop[exact].astype(strings.dtype)
            total = np.zeros(len(exact), np.int64)
            for t in range(trees):
                prefix = strings[exact, t] >> left << left
                total += np.searchsorted(self.sorted[t], prefix + (1 << left), "left")
                total -= np.searchsorted(self.sorted[t], prefix, "left")
            fewer[exact] = total < wanted
        return fewer

    def offers(self, strings: np.ndarray, rows: np.ndarray, wanted: int) -> np.ndarray:
        """Whether the ascent for the query of each pair ends where some tree offers the pair's row.

        ``strings`` are the queries', one row per pair. A row comes in as soon as the prefix is down to
        the longest that any tree has in common; the ascent gets there if one bit more offers too few.
        """
        differ = (strings ^ self.by_row[rows]).min(axis=1)
        drop = np.frexp(differ.astype(np.float64))[1]
        out = drop == 0
        rest = np.flatnonzero(~out)
        out[rest] = self.ascends(strings[rest], drop[rest] - 1, wanted)
        return out

    @cached_property
    def by_row(self) -> np.ndarray:
        return np.ascontiguousarray(self.strings.T)


def _places(*keys: np.ndarray) -> np.ndarray:
    """Place of each row among its neighbours with the same keys."""
    at = np.arange(len(keys[0]))
    new = np.ones(len(at), bool)
    new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    return at - np.maximum.accumulate(np.where(new, at, 0))


def foremost(ids: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """The rows that can be among the ``k`` nearest of any query, which never gets rows of its own id.

    Equal vectors are equally near and offered together, so the smallest ids come first: of one id ``k``
    rows are enough, and 2 ``k`` rows hold ``k`` of other ids than any one.
    """
    whole = np.ascontiguousarray(points).view(np.dtype((np.void, points.dtype.itemsize * points.shape[1]))).ravel()
    _, same, counts = np.unique(whole, return_inverse=True, return_counts=True)
    if counts.max() <= 2 * k:
        return np.arange(len(ids))
    order = np.lexsort((ids, same))
    order = order[_places(same[order], ids[order]) < k]
    return np.sort(order[_places(same[order]) < 2 * k])


class Search:
    """The ``k`` nearest rows of each query among the blocks met so far."""

    def __init__(self, planes: Planes, ids: np.ndarray, queries: np.ndarray, k: int, wanted: int):
        self.planes, self.ids, self.queries, self.k, self.wanted = planes, ids, queries, k, wanted
        self.strings = np.ascontiguousarray(planes.strings(queries).T)
        self.square = np.einsum("ij,ij->i", queries, queries, dtype=np.float64)
        self.largest = float(np.abs(queries).max(initial=0))
        self.have = np.zeros(len(ids), np.int64)
        self.apart = np.full((len(ids), k), np.inf)
        self.near = np.zeros((len(ids), k), np.int64)

    def meet(self, ids: np.ndarray, points: np.ndarray) -> None:
        """Takes in a block of rows."""
        if not len(self.ids) or not len(ids):
            return
        forest, rows = Forest(self.planes, ids, points), foremost(ids, points, self.k)
        exact = points[rows].astype(np.float64)
        # A row within a distance b has q * p - p * p / 2 >= (q * q - b * b) / 2. What rounding can take away, at
        # most a share of q * q + p * p, is given back to both sides.
        kind = np.float32 if max(self.largest, float(np.abs(exact).max())) < 1e15 else np.float64
        room = (exact.shape[1] + 8) * 2 * float(np.finfo(kind).eps)
        square = (exact * exact).sum(axis=1)
        lifted = np.hstack([exact, (room * square - square / 2 + 1e-30)[:, None]]).astype(kind)
        out, pairs, size = np.empty((QUERIES, TILE), kind), [], 0
        for n in range(0, len(self.ids), QUERIES):
            asked = np.arange(n, min(n + QUERIES, len(self.ids)))
            asking = np.hstack([self.queries[asked], np.ones((len(asked), 1), self.queries.dtype)]).astype(kind)
            bound = np.where(self.have[asked] == self.k, self.apart[asked, -1], np.inf)
            new = np.flatnonzero(self.have[asked] < self.k)
            if len(new) and len(rows) > 2 * self.k:
                bound[new] = self._first_bounds(forest, rows, exact, asked[new], asking[new] @ lifted.T)
            floor = (1 - 2 * room) * self.square[asked] / 2 - bound * bound / 2
            floor = np.nextafter(floor.astype(kind), kind(-np.inf))
            for m in range(0, len(rows), TILE):
                tile = lifted[m:m + TILE]
                scores = np.matmul(asking, tile.T, out=out[:len(asking), :len(tile)])
                live = np.flatnonzero(~(scores.max(axis=1) < floor))
                if len(live):
                    q, r = np.divmod(np.flatnonzero(~(scores[live] < floor[live, None])), len(tile))
                    pairs.append((asked[live[q]], r + m))
                    size += len(q)
                if size >= PAIRS:
                    self._take(forest, rows, exact, pairs)
                    pairs, size = [], 0
        if size:
            self._take(forest, rows, exact, pairs)

    def _take(self, forest: Forest, rows: np.ndarray, exact: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        q, r = map(np.concatenate, zip(*pairs))
        self._keep(*map(np.concatenate, zip(*(self._worked_out(forest, rows, exact, q[at:at + PAIRS], r[at:at + PAIRS])
                                              for at in range(0, len(q), PAIRS)))))

    def _first_bounds(self, forest: Forest, rows: np.ndarray, exact: np.ndarray, asked: np.ndarray,
                      scores: np.ndarray) -> np.ndarray:
        """A distance within which each query has ``k`` rows; infinite where the best by score hold too few."""
        some = 2 * self.k
        r = np.argpartition(scores, scores.shape[1] - some, axis=1)[:, -some:].ravel()
        q, out = np.repeat(asked, some), np.full(len(asked) * some, np.inf)
        for at in range(0, len(q), PAIRS):
            part = slice(at, at + PAIRS)
            taken = self._offered(forest, rows, q[part], r[part])
            out[part] = np.where(taken, self._distances(exact, q[part], r[part]), np.inf)
        return np.partition(out.reshape(-1, some), self.k - 1, axis=1)[:, self.k - 1]

    def _distances(self, exact: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        return np.sqrt(((exact[r] - self.queries[q].astype(np.float64)) ** 2).sum(axis=1))

    def _offered(self, forest: Forest, rows: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        out = forest.ids[rows[r]] != self.ids[q]
        other = np.flatnonzero(out)
        out[other] = forest.offers(self.strings[q[other]], rows[r[other]], self.wanted)
        return out

    def _worked_out(self, forest: Forest, rows: np.ndarray, exact: np.ndarray, q: np.ndarray,
                    r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, distances and ids of the pairs that come before the last of a query and are offered."""
        apart, ids, last = self._distances(exact, q, r), forest.ids[rows[r]], self.apart[q, -1]
        before = (self.have[q] < self.k) | (apart < last) | ((apart == last) & (ids < self.near[q, -1]))
        q, r, apart, ids = q[before], r[before], apart[before], ids[before]
        taken = self._offered(forest, rows, q, r)
        return q[taken], apart[taken], ids[taken]

    def _keep(self, q: np.ndarray, apart: np.ndarray, ids: np.ndarray) -> None:
        """Merges pairs into the nearest so far."""
        changed = np.unique(q)
        held = np.arange(self.k) < self.have[changed][:, None]
        q = np.concatenate([np.repeat(changed, self.have[changed]), q])
        apart = np.concatenate([self.apart[changed][held], apart])
        ids = np.concatenate([self.near[changed][held], ids])
        order = np.lexsort((ids, apart, q))
        place = _places(q[order])
        order, place = order[place < self.k], place[place < self.k]
        self.apart[q[order], place], self.near[q[order], place] = apart[order], ids[order]
        self.have[changed] = np.bincount(np.searchsorted(changed, q[order]), minlength=len(changed))

    def found(self, at_a_time: int = 8192) -> Iterator[pa.RecordBatch]:
        for n in range(0, len(self.ids), at_a_time):
            part = slice(n, n + at_a_time)
            held = np.arange(self.k) < self.have[part][:, None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(self.ids[part], self.have[part])), pa.array(self.near[part][held]),
                 pa.array(self.apart[part][held])], ["query_id", "vec_id", "score"])


def _sample(points: DataFrame, count: int) -> np.ndarray:
    """Vectors of the ``SAMPLE`` rows with the smallest hash of the id, or of all rows.

    A bound on the hash leaves a few thousand rows, so tasks do not each send as many rows as are wanted in
    all. What is left is cut to the sample on the executors; the driver gets no more than that.
    """
    points, share = points.withColumn("at", F.xxhash64("id")), 2 * SAMPLE / max(count, 1)
    while share < 1:
        bound = int(share * 2.0 ** 64) - 2 ** 63
        some = points.where(F.col("at") <= bound)
        if some.count() >= SAMPLE:
            points = some
            break
        share *= 4                              # ids that come often leave few hashes
    taken = settle(points.orderBy("at", "id", "v").limit(SAMPLE), "sample")
    return np.array([r["v"] for r in sorted(taken.collect(), key=lambda r: (r["at"], r["id"]))], np.float64)


def _part(parts: int) -> Column:
    """The block of a row: an even share of the hashes. Rows of one id go their own ways where they differ."""
    share = F.xxhash64("id", "v").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    return F.least(F.floor(share * F.lit(parts)), F.lit(parts - 1)).cast("int")


def nearest(rows: DataFrame, id_col: str, vec_col: str, k: int = 10, every: int = 100, trees: int = TREES,
            bits: int = BITS, candidates: int = CANDIDATES, block: int = BLOCK) -> DataFrame:
    """Columns ``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest rows found for each query.

    Queries are the rows whose id is divisible by ``every``, one per id; candidates are all rows but those
    of the query's own id. ``score`` is the Euclidean distance in doubles, ties go to the smaller id.
    Fewer rows come back where there are fewer candidates, none for an empty table. Repeated rows are
    candidates each on their own. See ``usable`` for the rows that take no part; zero vectors take none
    either. Other columns are left out.
    """
    spark = rows.sparkSession
    points = settle(components(rows, id_col, vec_col, zero=False).withColumn("n", F.size("v")), "points")
    usual = points.groupBy("n").count().orderBy(F.desc("count"), "n").first()
    if not usual:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points, count = points.where(F.col("n") == usual["n"]).select("id", "v"), usual["count"]
    planes = Planes(_sample(points, count), trees, bits)
    parts = 1 if count <= block else -(-count // max(1, int(block - 3 * block ** 0.5)))     # a part seldom exceeds a block
    groups = min(parts, max(GROUPS, 2 * spark.sparkContext.defaultParallelism))
    asked = settle(points.where(F.pmod(F.col("id"), F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v")), "queries")
    each = planes.directions.shape[0] * (4 if "float" in dict(points.dtypes)["v"] else 8) + 4 * trees + 16 * k + 24
    sets = max(1, -(-asked.count() * each // HELD))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each cell the queries come first, as part -1, then the rows of its parts, met in blocks."""
        search, at, held, size = None, (None, None), [], 0

        def flush(least: int) -> None:
            """Takes in what is held, of rows only blocks of ``least`` at least."""
            nonlocal search, held, size
            if not held:
                return
            ids, points = (np.concatenate(x) for x in zip(*held))
            n = 0
            if at[1] == -1:
                search, n = Search(planes, ids, points, k, candidates), len(ids)
            while len(ids) - n >= least:
                if search:
                    search.meet(ids[n:n + block], points[n:n + block])
                n = min(n + block, len(ids))
            held, size = [(ids[n:], points[n:])] if n < len(ids) else [], len(ids) - n

        for batch in batches:
            if not len(batch):
                continue
            cells, numbers, ids = (batch.column(c).to_numpy() for c in ("cell", "part", "id"))
            points = batch.column("v").flatten().to_numpy().reshape(len(ids), -1)
            ends = np.flatnonzero((cells[1:] != cells[:-1]) | (numbers[1:] != numbers[:-1])) + 1
            for low, high in zip([0, *ends], [*ends, len(ids)]):
                if at != (cells[low], numbers[low]):
                    flush(1)
                    if at[0] != cells[low]:
                        yield from search.found() if search else ()
                        search = None
                    at = cells[low], numbers[low]
                held.append((ids[low:high], points[low:high]))
                size += high - low
                if at[1] != -1 and size >= block:
                    flush(block)
        flush(1)
        yield from search.found() if search else ()

    of_set = F.explode(F.sequence(F.lit(0), F.lit(sets - 1)))
    of_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = points.select("id", "v", _part(parts).alias("part"), of_set.alias("set")).select(
        (F.pmod("part", F.lit(groups)) * sets + F.col("set")).cast("int").alias("cell"), "part", "id", "v")
    copies = asked.select("id", "v", of_group.alias("group")).select(
        (F.col("group") * sets + F.pmod(F.xxhash64("id"), F.lit(sets))).cast("int").alias("cell"),
        F.lit(-1).alias("part"), "id", "v")
    cells = dealt.unionByName(copies).repartitionById(groups * sets, "cell").sortWithinPartitions("cell", "part", "id")
    local = cells.mapInArrow(met, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
