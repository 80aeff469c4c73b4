"""Best-fit packing of texts into sequences of several permitted lengths.

Texts longer than the largest capacity are cut into pieces. Pieces are dealt by hash to shards of
bounded size, and each shard is packed on its own: pieces in descending length go to the open bin
with the least room that still takes them; where none does, a bin of the least-cost size opens. That is
the size whose cost per word held is least, when it is filled with the lengths still to come and cut
down to what it then holds. At the end every bin is cut down to the smallest size that holds its
contents. The same is tried with the size fixed to each permitted one, and the cheapest packing is kept.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.session import settle

CAPACITIES = (512, 1024, 2048)
OVERHEAD = 4              # cost of a bin besides its capacity, in the same unit
SHARD = 20_000            # pieces that one task packs

SCHEMA = ("bin_id string, capacity int, used int, doc_id long, no_id boolean, piece int, first_word long, n_words int, position int")


class ToCome:
    """The lengths that are not placed yet, by number."""

    def __init__(self, lengths: np.ndarray):
        self.count = np.bincount(lengths).tolist() if len(lengths) else []
        self.mask = sum(1 << size for size, n in enumerate(self.count) if n)      # bit s: some of length s are left

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            self.mask ^= 1 << size

    def fill(self, room: int) -> int:
        """How much of ``room`` the longest that fit, one after another, would fill."""
        held, mask = 0, self.mask
        while True:
            size = (mask & ((1 << room - held + 1) - 1)).bit_length() - 1
            if size <= 0:
                return held
            held += size * min(self.count[size], (room - held) // size)
            mask &= (1 << size) - 1        # used up, or too long for what is left


def least_cost(size: int, sizes: list[int], left: ToCome, overhead: int) -> int:
    """The permitted size with the least cost per word held, opened for a piece of ``size``; of equals the largest."""
    def cost(capacity: int) -> tuple[float, int]:
        held = size + left.fill(capacity - size)
        return (next(c for c in sizes if c >= held) + overhead) / held, -capacity

    return min((c for c in sizes if c >= size), key=cost)


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...], overhead: int, largest: int | None = None
             ) -> tuple[np.ndarray, list[int]]:
    """Bins of lengths in descending order: the bin of each piece, and the final size of each bin.

    Bins open at the least-cost size, or with ``largest`` at that size, where it takes the piece.
    """
    sizes = sorted(capacities)
    opened: list[int] = []                       # size of each bin
    room: list[int] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    free = 0                                     # bit r is set where a bin with room r is open
    where = np.empty(len(lengths), np.int64)
    left = ToCome(lengths)
    for i, size in enumerate(lengths.tolist()):
        left.take(size)
        fitting = free >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                free ^= 1 << r
        else:
            r = least_cost(size, sizes, left, overhead) if largest is None else next(
                c for c in sizes if c >= max(size, largest) or c == sizes[-1])
            b = len(opened)
            opened.append(r)
            room.append(r)
        room[b] = r - size
        if room[b]:
            by_room[room[b]].append(b)
            free |= 1 << room[b]
        where[i] = b
    final = [next(c for c in sizes if c >= size - rest) for size, rest in zip(opened, room)]
    return where, final


def cheapest(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES,
             overhead: int = OVERHEAD) -> tuple[np.ndarray, list[int]]:
    """The packing with the least sum of capacities and overheads: by least-cost sizes, or by one size for all."""
    tried = [best_fit(lengths, capacities, overhead, largest) for largest in (None, *sorted(capacities, reverse=True))]
    return min(tried, key=lambda t: sum(t[1]) + overhead * len(t[1]))


def pieces(docs: DataFrame, id_col: str, text_col: str, longest: int) -> DataFrame:
    """Columns ``id``, ``piece``, ``first_word``, ``n_words``, and ``spot`` to deal rows by.

    Length counts words between ASCII white space. Null and empty texts and texts without words have no piece.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(F.col(id_col).cast("long").alias("id"),
                          F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
                          F.xxhash64(id_col, text).alias("spot"))
    # rows with one id and text, or none, still spread over shards
    counted = counted.where("words > 0").withColumn("spot", F.xxhash64("spot", F.monotonically_increasing_id()))
    counted = settle(counted, "lengths")
    cut = counted.select("id", "words", "spot", F.explode(F.sequence(F.lit(0), F.floor((F.col("words") - 1) / longest)
                                                                    .cast("int"))).alias("piece"))
    first = F.col("piece").cast("long") * longest
    return cut.select("id", "piece", first.alias("first_word"),
                      F.least(F.lit(longest), F.col("words") - first).cast("int").alias("n_words"), "spot")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES,
         overhead: int = OVERHEAD, shard: int = SHARD) -> DataFrame:
    """One row per piece: ``bin_id``, ``capacity``, ``used``, ``doc_id``, ``piece``, ``first_word``,
    ``n_words`` and ``position``, the number of words before it in the bin.

    Every word of every text is in exactly one piece, and no bin holds more than its capacity. Rows
    with a null id are packed like others; texts without words have no row; repeated rows are packed
    each on their own; an empty table gives none. Other columns are left out.
    """
    cut = settle(pieces(docs, id_col, text_col, max(capacities)), "pieces")
    shards = max(1, -(-cut.count() // shard))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_words", "no_id", "id", "piece", "spot"], ascending=[False, True, True, True, True],
                                  kind="stable").reset_index(drop=True)
        sizes = group["n_words"].to_numpy(np.int64)
        where, final = cheapest(sizes, capacities, overhead)
        before, used = np.empty(len(sizes), np.int64), [0] * len(final)
        for i, (b, size) in enumerate(zip(where.tolist(), sizes.tolist())):
            before[i] = used[b]
            used[b] += size
        mark = int(group["shard"].iat[0])
        return pd.DataFrame({
            "bin_id": [f"{mark}-{b}" for b in where], "capacity": np.array(final)[where], "used": np.array(used)[where],
            "doc_id": group["id"], "no_id": group["no_id"], "piece": group["piece"], "first_word": group["first_word"],
            "n_words": sizes, "position": before,
        })

    # a missing id is marked aside: pandas would turn a column with one into floats
    dealt = cut.withColumns({"shard": F.pmod(F.col("spot") + F.col("piece"), F.lit(shards)).cast("int"),
                             "no_id": F.col("id").isNull(), "id": F.coalesce("id", F.lit(0))})
    packed = dealt.groupBy("shard").applyInPandas(run, SCHEMA)
    return packed.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
