"""Near duplicates by SimHash fingerprints, with links found by pigeonring chains.

Two fingerprints of 64 bits are linked where they differ in at most ``DISTANCE`` bits. They are cut
into ``SEGMENTS`` segments on a ring. If the whole distance is within its budget, then some start on
the ring has every chain of l consecutive segments within the budget l * DISTANCE / SEGMENTS (strong
pigeonring principle). For a chain to hold, its first segment must be equal, and further equal
segments must come early enough; those equal segments are the join keys. Candidates then pass the
chain test in full, and last the Hamming test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.components import components
from candlelake.session import settle

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 7
SMALL = 32            # fingerprints under one key that meet in a join; larger groups meet in blocks
BLOCK = 2048          # fingerprints of a block


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed integer of 64 bits; a text without words, or null, has 0."""
    words = (text or "").encode().lower().split()       # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    line, size = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, size) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, size - shingle + 1)
    cuts = zip(starts[:n].tolist(), ends[size - n:].tolist())
    hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in cuts], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        bits = np.unpackbits(hashes[at:at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >> 63 else value


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each row's whole text in column ``name``."""
    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(name, run(F.col(text_col)))


def ring(segments: int) -> list[int]:
    """Bit masks of the segments, as even as 64 bits allow."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def key_sets(segments: int, distance: int) -> list[tuple[int, ...]]:
    """Sets of segments of which at least one is equal in any two fingerprints within the distance.

    After l segments of a chain at most l * distance // segments may differ, so the j-th equal one
    comes at the latest where l less that number first reaches j.
    """
    exact = segments - distance
    if exact < 1:
        raise ValueError("more segments than differing bits are needed")
    latest = [next(l for l in range(1, segments + 1) if l - l * distance // segments >= j) - 1
              for j in range(1, exact + 1)]
    chains = [c for c in combinations(range(segments), exact) if all(p <= q for p, q in zip(c, latest))]
    return sorted({tuple(sorted((start + p) % segments for p in c)) for start in range(segments) for c in chains})


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def segment_gaps(a: str, b: str, segments: int) -> list[Column]:
    """Columns ``g0``, ``g1``, ...: differing bits in each segment."""
    apart = F.col(a).bitwiseXOR(F.col(b))
    return [F.bit_count(apart.bitwiseAND(F.lit(_signed(m)))).alias(f"g{i}") for i, m in enumerate(ring(segments))]


def chain_holds(segments: int, distance: int) -> Column:
    """Whether some start on the ring keeps every chain of segments within its budget."""
    starts = []
    for start in range(segments):
        total, within = F.lit(0), F.lit(True)
        for l in range(1, segments + 1):
            total = total + F.col(f"g{(start + l - 1) % segments}")
            within = within & (total <= l * distance // segments)
        starts.append(within)
    return reduce(Column.__or__, starts)


def _block_edges(fps_a: np.ndarray, fps_b: np.ndarray, distance: int) -> np.ndarray:
    """Edges that connect what is linked between two blocks: at most one per fingerprint, not one per link."""
    near = np.empty((len(fps_a), len(fps_b)), bool)
    for at in range(0, len(fps_a), 256):
        near[at:at + 256] = np.bitwise_count(fps_a[at:at + 256, None] ^ fps_b[None, :]) <= distance
    big = len(fps_a) + len(fps_b)
    left, right = np.arange(len(fps_a)), np.full(len(fps_b), big)
    while True:      # least label over the links, until nothing changes
        new_right = np.minimum(right, np.where(near, left[:, None], big).min(axis=0, initial=big))
        new_left = np.minimum(left, np.where(near, new_right[None, :], big).min(axis=1, initial=big))
        new_left = new_left[new_left]
        if (new_right == right).all() and (new_left == left).all():
            break
        left, right = new_left, new_right
    linked = right < big
    edges = [np.stack([fps_a, fps_a[left]], 1), np.stack([fps_b[linked], fps_a[right[linked]]], 1)]
    out = np.concatenate(edges)
    return out[out[:, 0] != out[:, 1]]


def links(fps: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE,
          small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` that connect all distinct fingerprints ``fp`` within the distance.

    Every fingerprint goes to each of its keys. Groups under a key of up to ``small`` meet in a join.
    Larger ones are dealt to blocks, and pairs of blocks are compared in tasks of bounded size that
    return connecting edges only: the number of rows stays in proportion to the group, and no link is lost.
    """
    masks = ring(segments)
    sets = key_sets(segments, distance)
    parts = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(sum(masks[j] for j in s)))))
             for i, s in enumerate(sets)]
    keys = fps.select("fp", F.explode(F.array(*parts)).alias("key"))
    shared = settle(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-keys")
    met = settle(keys.join(shared, "key"), "simhash-met")

    few = met.where(F.col("n") <= small)
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key").where("a < b")
    near = (pairs.select("a", "b", *segment_gaps("a", "b", segments)).where(chain_holds(segments, distance))
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b"))

    many = met.where(F.col("n") > small).select(
        "key", "fp", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    many = many.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = many.select("key", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", "fp", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        first = (group["mine"] == group["i"]).to_numpy()
        fp = group["fp"].to_numpy(np.int64)
        same = (group["i"].iat[0] == group["j"].iat[0])
        found = _block_edges(fp[first], fp if same else fp[~first], distance)
        return pd.DataFrame(found, columns=["a", "b"])

    return near.union(dealt.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long"))


def classes(fps: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """``fp``, ``component_id``: every fingerprint of (``fp``, ``least``) with the least ``least`` it can reach."""
    reached = settle(components(links(fps, segments, distance)), "simhash-roots")
    placed = reached.join(fps, reached["node"] == fps["fp"]).select("node", "root", "least")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = settle(placed.join(least, "root").select(F.col("node").alias("fp"), "component_id"), "simhash-linked")
    return (fps.join(linked.withColumn("linked", F.lit(True)), "fp", "left")
            .select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """Columns ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest id that can be reached by links, the row's own included. Null texts
    count as empty; texts without words have fingerprint zero and are linked like any other. Rows without
    an id take part, and a class of only such rows has a null ``component_id``. Repeated rows stay
    repeated. Other columns are left out. Copies are folded by fingerprint before any link is sought.
    """
    rows = settle(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                                   "text", "fp", shingle).select("id", "fp"), "simhash")
    fps = settle(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    found = rows.join(classes(fps, segments, distance), "fp")
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs``, one of each class: the smallest id, then the least hash of the text, nulls last.

    All columns come back as they were. Of rows that are equal in id and text one stays. Winners are chosen
    from ids, hashes and fingerprints alone; the texts, fingerprinted once, then meet them in one shuffle.
    """
    def key() -> list[Column]:
        return [F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                F.xxhash64(F.col(id_col).isNull(), F.col(id_col)).alias("g")]

    columns = docs.columns
    marked = docs.select(F.col(id_col).alias("id"), *key(), F.col(text_col).alias("text"))
    rows = settle(with_fingerprint(marked, "text", "fp", shingle).select("id", "h", "g", "fp"), "simhash")
    fps = settle(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    roots = settle(components(links(fps, segments, distance)), "simhash-roots").select(F.col("node").alias("fp"), "root")
    # a class sends one row per task: the least of (missing id, id, hash of the text)
    least = rows.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("class")).agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "g")).alias("w"))
    winners = settle(least.select("w.h", "w.g"), "simhash-winners")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), *key())
    # repeats fall before the shuffle, which the join then uses too
    orderly = [F.col("row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    first = F.row_number().over(Window.partitionBy("h", "g").orderBy(*orderly))
    return whole.withColumn("n", first).where("n = 1").join(winners, ["h", "g"], "left_semi").select("row.*")
