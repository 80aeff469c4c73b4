"""Periodic runs in word sequences, by an online sparse dynamic program over diagonals.

A run is a maximal stretch of words with smallest period q and a length of at least
``max(LEAST_LENGTH, LEAST_REPEATS * q)``. Words are read in order. An earlier occurrence of a word, q
words back, increments the match length of the diagonal with lag q if that was active at the word
before; diagonals that a word does not increment end there, and one that ends long enough emits its
run at once.

A frequent word has so many earlier occurrences that all of them would make the program quadratic, so
only those are used that can matter, and none is lost:

* Lags are cut into tiers [a, 1.5 a). A run with such a lag matches at least ``3 a`` words in a row, so
  in this tier an occurrence counts once the last ``3 a`` words occur there too (5 words in the first
  tier). A diagonal starts with that length, and every later word adds one.
* Of these occurrences only the nearest can be the lag of a run. If the ``3 a`` words also occur
  nearer, at lag d, they have both periods; d + q is at most their length, so by Fine and Wilf they
  have a period that divides both, and q is not the smallest period of the run.

So a word has at most one lag in each tier. Longer stretches are named by two overlapping shorter
ones, and a stretch that occurs once in a text is left out of all longer tiers: in ordinary prose
nothing is left after the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6
LEAST_REPEATS = 4
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _repeated(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches that end at ``at``, numbers and ends of those whose name occurs again."""
    _, number, count = np.unique(names, return_inverse=True, return_counts=True)
    again = count[number] > 1
    return number[again], at[again]


class _Stretches:
    """Numbers of the repeated stretches of ``size`` words, by the words they end at."""

    def __init__(self, words: np.ndarray):
        self.size, self.n = 1, len(words)
        self.number, self.end = _repeated(words, np.arange(self.n))

    def grow(self, size: int) -> None:
        """Stretches of ``size`` words, at most twice as many as before: two that overlap name one."""
        shift = size - self.size
        place = np.full(self.n, -1, np.int64)
        place[self.end] = self.number
        end = self.end[self.end >= shift]
        head, tail = place[end - shift], place[end]
        both = head >= 0
        self.number, self.end = _repeated(head[both] * (self.n + 1) + tail[both], end[both])
        self.size = size

    def lags(self) -> tuple[np.ndarray, np.ndarray]:
        """Ends, and how far back the nearest earlier occurrence of the stretch ends."""
        order = np.argsort(self.number, kind="stable")       # ends ascend within a number
        number, end = self.number[order], self.end[order]
        same = number[1:] == number[:-1]
        return end[1:][same], (end[1:] - end[:-1])[same]


def occurrences(words: np.ndarray, least_length: int = LEAST_LENGTH, repeats: int = LEAST_REPEATS
                ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per tier: words, the lag of their one earlier occurrence that counts, and how many words match there."""
    least, n = 1, len(words)
    found = _Stretches(words)
    while repeats * least <= n and least_length <= n and len(found.end):
        size = max((repeats - 1) * least, least_length - least)
        while found.size < size and len(found.end):
            found.grow(min(size, 2 * found.size))
        after = (3 * least + 1) // 2 if least > 1 else 2
        end, lag = found.lags()
        here = (lag >= least) & (lag < after)
        yield end[here], lag[here], size
        least = after


def runs(words: list[bytes], least_length: int = LEAST_LENGTH, repeats: int = LEAST_REPEATS
         ) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start, then period."""
    if repeats < 4:
        raise ValueError("tiers need runs of at least four periods")
    tiers = [(e, q, np.full(len(e), s)) for e, q, s in occurrences(numbered(words), least_length, repeats) if len(e)]
    if not tiers:
        return []
    ends, lags, sizes = (np.concatenate(x) for x in zip(*tiers))
    out: list[tuple[int, int, int]] = []

    def emit(lag: int, last: int, match: int) -> None:
        if match + lag >= max(least_length, repeats * lag):
            out.append((last - match - lag + 1, match + lag, lag))

    active: dict[int, tuple[int, int]] = {}        # lag: last word, words that matched
    now = -1
    order = np.lexsort((lags, ends))
    for i, lag, size in zip(ends[order].tolist(), lags[order].tolist(), sizes[order].tolist()):
        if i > now:
            for q in [q for q, (last, _) in active.items() if last < i - 1]:      # not incremented: ended
                emit(q, *active.pop(q))
            now = i
        last, match = active.get(lag, (-1, 0))
        if last == i - 1:
            active[lag] = i, match + 1
        else:
            if match:
                emit(lag, last, match)
            active[lag] = i, size
    for q, (last, match) in active.items():
        emit(q, last, match)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(change).tolist()) if not covered]


def digest(text: str | None) -> tuple:
    """The columns of ``scan`` for one text."""
    words = words_of(text)
    found = runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapse(words, found))).hexdigest())


FIELDS = {"n_runs": "Int64", "start": "Int64", "length": "Int64", "period": "Int64", "exponent_milli": "Int64",
          "runs_sha256": "object", "collapsed_sha256": "object"}


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id_col`` and ``runs``, an array of ``start``, ``length``, ``period`` in words.

    One row per row of ``docs``, repeated rows included; null and empty texts have an empty array. Texts
    are read whole, in time and memory in proportion to their length but for the sorting of repeated
    stretches. Other columns are left out, so their names cannot clash. No shuffle.
    """
    @F.pandas_udf("array<struct<start: long, length: long, period: long>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([[{"start": s, "length": n, "period": q} for s, n, q in runs(words_of(t))] for t in texts],
                            dtype="object")

    return docs.select(id_col, run(F.col(text_col)).alias("runs"))


def collapsed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each run in ``text_col`` cut to its first period; words are joined by one space.

    Texts without a run stay as they are, null texts null, and all other columns and rows too.
    """
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def cut(text: str) -> str:
            words = words_of(text)
            found = runs(words)
            return b" ".join(collapse(words, found)).decode("utf-8", "surrogatepass") if found else text

        for texts in parts:
            yield texts.map(cut, na_action="ignore").astype(object)

    return docs.withColumn(text_col, run(F.col(text_col)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``n_runs``, the run with the greatest exponent, and hashes.

    ``start``, ``length``, ``period`` and ``exponent_milli`` are of the run with the greatest length by
    period; ties go to the smallest start, then period; without a run they are null. ``runs_sha256`` is of
    all runs, ``collapsed_sha256`` of the text without repeats. Nulls, repeats and other columns are as in
    ``find_runs``.
    """
    @F.pandas_udf("n_runs long, start long, length long, period long, exponent_milli long, "
                  "runs_sha256 string, collapsed_sha256 string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            rows = [digest(t) for t in texts]
            yield pd.DataFrame({name: pd.array([r[i] for r in rows], dtype=kind)
                                for i, (name, kind) in enumerate(FIELDS.items())})

    return docs.select(id_col, run(F.col(text_col)).alias("r")).select(id_col, "r.*")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "text") -> DataFrame:
    """Columns ``id_col`` and ``name``: a tenth of the texts, chosen by the id's CRC-32, end in repeated words.

    With h the CRC-32 of the decimal id and g = h div 10, the words from g % n on are replaced by the first
    1 + (n - a) div (3 + g % 8) of them, again and again. Other texts, and rows without an id, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.floor(h / 10).alias("g"),
                       F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"))
    rows = rows.withColumn("w", F.when(F.col("chosen"), F.regexp_extract_all("t", F.lit(WORD), 0)))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    n, a, p = F.col("n"), F.col("a"), F.col("p")
    repeat: Column = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(F.col("w"), a + i % p))
    text = F.when(F.col("chosen") & (n > 0), F.array_join(F.concat(F.slice("w", 1, a), repeat), " ")).otherwise(F.col("t"))
    return rows.select(F.col("id").alias(id_col), text.alias(name))
