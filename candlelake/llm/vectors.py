"""Vector tables in blocks: what exact and approximate searches share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.session import settle


def components(rows: DataFrame, id_col: str, vec_col: str, zero: bool = True) -> DataFrame:
    """Columns ``id``, ``v`` of the rows with an id and a vector of finite components.

    Zero vectors are left out unless ``zero``. Floats stay floats, other numbers become doubles.
    """
    kind = "float" if dict(rows.dtypes)[vec_col] == "array<float>" else "double"
    v, none = F.col("v"), F.lit(float("inf")).cast(kind)
    out = rows.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    # NaN is the largest; a search that finds nothing among nulls is null
    fine = (F.array_max(v) < none) & (F.array_min(v) > -none) & F.coalesce(~F.array_contains(v, none), F.lit(False))
    if not zero:
        fine = fine & ((F.array_max(v) > 0) | (F.array_min(v) < 0))
    return out.where((F.size(v) > 0) & fine)


def usable(rows: DataFrame, id_col: str, vec_col: str, zero: bool = True) -> DataFrame:
    """Columns ``id``, ``v`` (doubles) of the rows that take part in a search.

    Left out are rows without an id, with a null or empty vector, with a null or non-finite component,
    with another length than most vectors have, and zero vectors unless ``zero``.
    """
    out = components(rows, id_col, vec_col, zero).select("id", F.col("v").cast("array<double>").alias("v"))
    usual = out.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return out.where(F.size("v") == (usual["n"] if usual else 0))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def blocks(rows: DataFrame, order: list[str], size: int, per_partition: int, cut: str | None = None,
           by: list[str | Column] | None = None) -> DataFrame:
    """Rows of ``id``, ``v`` and numbers, dealt by range and packed to blocks of at most ``size`` rows.

    Columns: ``part``, ``seq``, ``ids`` and ``vectors`` as bytes, and ``low``, ``high`` of the last column
    of ``order`` but the id where ``cut`` names a column that is the same within a block. A task streams
    its partition and holds one block.
    """
    count = rows.count()
    parts = max(1, -(-count // (size * per_partition)))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held = TaskContext.get().partitionId(), 0, None

        def block(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("id", kind="stable")
            spread = rows["dist"] if "dist" in rows else pd.Series([0.0])
            return pd.DataFrame([[part, seq, int(rows[cut].iat[0]) if cut else 0, spread.min(), spread.max(),
                                  rows["id"].to_numpy(np.int64).tobytes(), matrix(rows["v"]).tobytes()]],
                                columns=["part", "seq", "pivot", "low", "high", "ids", "vectors"])

        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while held is not None and len(held):
                same = len(held)
                if cut:
                    changes = np.flatnonzero(held[cut].to_numpy()[1:] != held[cut].to_numpy()[:-1])
                    same = int(changes[0]) + 1 if len(changes) else same
                n = min(same, size)
                if n == len(held) and n < size:      # the block may go on in the next batch
                    break
                yield block(held.iloc[:n])
                seq += 1
                held = held.iloc[n:]
        if held is not None and len(held):
            yield block(held)

    schema = "part int, seq int, pivot int, low double, high double, ids binary, vectors binary"
    return settle(dealt.mapInPandas(pack, schema), "blocks")


def query_blocks(queries: DataFrame, size: int, parts: int, extra: str | None = None) -> DataFrame:
    """Queries (``id``, ``v``, perhaps ``extra``) packed by ``size``, one copy for each of ``parts`` partitions.

    The rows of a partition then meet their copy in an equi-join: the query set goes to the data.
    """
    groups = max(1, -(-queries.count() // size))
    columns = ["id", "v", *([extra] if extra else [])]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        more = group[extra].to_numpy(np.float64) if extra else np.zeros(len(group))
        return pd.DataFrame([[int(group["q"].iat[0]), group["id"].to_numpy(np.int64).tobytes(),
                              matrix(group["v"]).tobytes(), more.tobytes()]],
                            columns=["q", "q_ids", "q_vectors", "q_extra"])

    packed = (queries.select(*columns, F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("q"))
              .groupBy("q").applyInPandas(pack, "q int, q_ids binary, q_vectors binary, q_extra binary"))
    return settle(packed, "queries").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def unpack(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, np.frombuffer(vectors, np.float64).reshape(len(found), -1)
