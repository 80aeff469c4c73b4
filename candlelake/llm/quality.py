"""Quality classifier trained on weak labels.

Overlapping heuristics vote good (1), bad (0) or nothing (-1) on every document. Expectation-
maximisation over the counts of vote patterns estimates how often each heuristic is right for each
class, and how frequent the classes are. The posterior of a document's pattern is its soft label, and
a linear scorer over hashed word shapes learns these labels. No given label is used.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.session import settle

SAMPLE = 6000          # documents on which the linear scorer is fitted: a fixed bound
BUCKETS = 1 << 12      # hashed features
THRESHOLD = 0.5        # documents that score less are rejected
ROUNDS = 200
# Letters but capitals, of any script, with their marks; and scripts that put no spaces between words.
SMALL = r"[\p{Ll}\p{Lo}\p{Lm}\p{M}]"
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def votes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns ``h`` (hash of the text), ``v0``, ``v1``, ...: the heuristics' votes, 1 good, 0 bad, -1 none.

    Null counts as empty. Every pattern is counted once, in a projection of its own.
    """
    text = F.col("_text")
    size = F.length(text).cast("double")
    counted = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text")).select(
        F.xxhash64(text).alias("h"), size.alias("_size"), _count(text, r"\S+").alias("_words"),
        (size - F.length(F.translate(text, "|#$%&*<>{}[]^~=_\\+", "")).cast("double")).alias("_marks"),
        _count(text, "\\p{Lu}{2,}").alias("_capitals"),
        (size - F.length(F.translate(text, "!?", "")).cast("double")).alias("_shouts"),
        # begun at the head of a run of letters and never taken back, so a long run is read once
        _count(text, f"(?<!{SMALL}){SMALL}{{2,}}+[.,،。]?(?=\\s|$)").alias("_plain"),
        # characters of these scripts have three bytes or more, so with few bytes there is nothing to count
        F.when(3 * (F.octet_length(text) - F.length(text)) < 2 * F.length(text), True)
        .otherwise(3 * _count(text, UNSPACED) < size).alias("_spaced"),
        _count(text, "([#$%&*!?|])\\1").alias("_doubled"),
        _count(text, r"(?<!\S)(\S+)\s+(?=\1(?!\S))").alias("_again"))
    words, size, marks, plain, again, spaced = (F.col(f"_{c}") for c in ("words", "size", "marks", "plain", "again", "spaced"))
    some = words >= 3
    running = (plain >= 0.7 * words) & (marks <= 0.02 * words) & (again <= 0.05 * words)

    def vote(bad: Column, good: Column = F.lit(False)) -> Column:
        return F.when(bad, 0).when(good, 1).otherwise(-1).cast("byte")

    cast = [      # what speaks against a text, and running words that speak for it
        vote(some & (marks > 0.25 * words)),
        vote(some & (F.col("_capitals") > 0.3 * words)),
        vote(some & (F.col("_shouts") > 0.2 * words)),
        vote(spaced & some & (plain < 0.4 * words), spaced & running),
        vote(some & (F.col("_doubled") > 0.1 * words)),
        vote(some & (again > 0.2 * words)),
        vote(spaced & (words > size / 2.5), spaced & running & (words <= size / 3.5) & (words >= size / 12)),
    ]
    return counted.select("h", *[v.alias(f"v{i}") for i, v in enumerate(cast)])


@dataclass
class LabelModel:
    """Class shares and per heuristic the chances of its votes, given the class."""

    patterns: np.ndarray       # one row per pattern of votes
    posterior: np.ndarray      # chance of good
    chances: np.ndarray        # heuristic, class, vote + 1
    good: float

    def table(self) -> list[tuple]:
        return [(*map(int, p), float(q)) for p, q in zip(self.patterns, self.posterior)]


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over counted vote patterns, from the majority of votes.

    A heuristic is taken to be right more often than wrong, so the classes cannot change places.
    """
    counts = counts.astype(float)
    yes, no = (patterns == 1).sum(axis=1), (patterns == 0).sum(axis=1)
    post = (yes + 0.5) / (yes + no + 1.0)
    good, chances = 0.5, np.full((patterns.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])
        good = float(np.clip(weight[1].sum() / max(counts.sum(), 1e-9), 0.02, 0.98))
        for j in range(patterns.shape[1]):
            for c in range(2):
                got = np.array([weight[c][patterns[:, j] == v].sum() for v in (-1, 0, 1)]) + 0.1
                chances[j, c] = got / got.sum()
        logs = np.stack([np.log([1 - good, good][c]) + sum(np.log(chances[j, c][patterns[:, j] + 1])
                                                          for j in range(patterns.shape[1])) for c in range(2)])
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            post = new
            break
        post = new
    if patterns.size and ((post - 0.5) * (yes - no) * counts).sum() < 0:
        post, good, chances = 1 - post, 1 - good, chances[:, ::-1]
    return LabelModel(patterns, post, chances, good)


_RUNS = re.compile(r"(.)\1+")


class _Classes(dict):
    """Character to the class of its Unicode category, for ``str.translate``."""

    def __missing__(self, code: int) -> str:
        kind = unicodedata.category(chr(code))
        self[code] = found = "A" if kind in ("Lu", "Lt") else "a" if kind[0] in "LM" else "0" if kind == "Nd" else chr(code)
        return found


class Shapes:
    """Hashed shapes of words: letters, capitals and digits as classes, runs as one, other characters as they are."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.known = buckets, {}
        self.classes = _Classes()

    def bucket(self, shape: str) -> int:
        found = self.known.get(shape)
        if found is None:
            found = zlib.crc32(_RUNS.sub(r"\1", shape).encode("utf-8", "surrogatepass")) % self.buckets
            if len(self.known) < 100_000:
                self.known[shape] = found
        return found

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and their shares of the words, lengths of 1 in all."""
        words, total = (text or "").split(), {}
        again = sum(map(eq, words, words[1:]))      # a word right after itself
        if again:
            total[self.bucket("repeated word")] = float(again)
        for shape, n in Counter((text or "").translate(self.classes).split()).items():
            b = self.bucket(shape)
            total[b] = total.get(b, 0.0) + n
        values = np.array(list(total.values()))
        return np.array(list(total), np.int64), values / max(1.0, np.sqrt((values * values).sum()))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, features: tuple[np.ndarray, np.ndarray]) -> float:
        z = float(self.weights[features[0]] @ features[1]) + self.bias if len(features[0]) else self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_scorer(texts: list[str | None], soft: np.ndarray, good: float, buckets: int = BUCKETS, rounds: int = 300,
               rate: float = 2.0, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by full gradient steps; ``good`` is the share of good documents in all."""
    shapes = Shapes(buckets)
    rows = [shapes.features(t) for t in texts]
    where = np.concatenate([np.full(len(f[0]), i) for i, f in enumerate(rows)]) if rows else np.empty(0, np.int64)
    index = np.concatenate([f[0] for f in rows]) if rows else np.empty(0, np.int64)
    value = np.concatenate([f[1] for f in rows]) if rows else np.empty(0)
    weights, bias = np.zeros(buckets), 0.0
    share = np.clip(soft.mean() if len(soft) else 0.5, 0.05, 0.95)
    balance = soft * good / share + (1 - soft) * (1 - good) / (1 - share)
    balance = balance / max(balance.mean(), 1e-9) if len(soft) else balance
    grown = np.full(buckets, 1e-8)
    for _ in range(rounds if len(soft) else 0):
        z = np.bincount(where, value * weights[index], minlength=len(rows)) + bias
        gap = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - soft) * balance / len(rows)
        step = np.bincount(index, value * gap[where], minlength=buckets) + decay * weights
        grown += step * step
        weights -= rate * 0.1 * step / np.sqrt(grown)
        bias -= rate * gap.sum()
    return Scorer(weights, bias)


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, buckets: int = BUCKETS) -> tuple[LabelModel, Scorer]:
    """The label model over the votes on all of ``docs``, and the scorer fitted on a bounded sample.

    The sample is the ``sample`` texts with the least hashes, half of them from either side of the posterior
    where there are enough. Only vote patterns and the sample come to the driver, both of bounded size.
    """
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    voted = settle(votes(docs, text_col), "votes")
    names = [c for c in voted.columns if c != "h"]
    counted = voted.groupBy(names).count().collect()
    patterns = np.array([[r[n] for n in names] for r in counted], np.int64).reshape(-1, len(names))
    model = fit_label_model(patterns, np.array([r["count"] for r in counted], np.int64))
    if not len(patterns):
        return model, Scorer(np.zeros(buckets), 0.0)
    spark = docs.sparkSession
    table = spark.createDataFrame(model.table(), ", ".join(f"{n} byte" for n in names) + ", soft double")
    judged = voted.join(F.broadcast(table), names).groupBy("h").agg(F.max("soft").alias("soft"))    # one row per text
    judged = settle(judged, "soft-labels")
    chosen = [(r["h"], r["soft"]) for side in (F.col("soft") >= 0.5, F.col("soft") < 0.5)
              for r in judged.where(side).orderBy("h").limit(sample // 2).collect()]
    wanted = F.broadcast(spark.createDataFrame(chosen, "h long, soft double"))
    found = docs.select(mark.alias("h"), F.col(text_col).alias("text")).join(wanted, "h")
    found = found.groupBy("h").agg(F.min("text").alias("text"), F.max("soft").alias("soft")).orderBy("h").collect()
    return model, fit_scorer([r["text"] for r in found], np.array([r["soft"] for r in found]), model.good, buckets)


def score_column(scorer: Scorer, text_col: str, buckets: int = BUCKETS) -> Column:
    """Score of each row's whole text, 0 to 1; null counts as empty."""
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shapes = Shapes(buckets)
        for texts in parts:
            yield pd.Series([scorer.score(shapes.features(t)) for t in texts], dtype="float64")

    return run(F.col(text_col))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             sample: int = SAMPLE) -> DataFrame:
    """Columns ``id_col``, ``score``, ``keep``, one row per row of ``docs``.

    Texts are scored whole. Null and empty texts have no word shapes and get the scorer's base score;
    repeated rows get equal scores; an empty table gives none. Other columns are left out.
    """
    scorer = fit(docs, text_col, sample)[1]
    return docs.select(id_col, score_column(scorer, text_col).alias("score")).withColumn(
        "keep", F.col("score") >= threshold)


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all columns as they were."""
    return docs.where(score_column(fit(docs, text_col, sample)[1], text_col) >= threshold)
