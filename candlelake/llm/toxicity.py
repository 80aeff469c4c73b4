"""Toxicity by a small convolutional network over hashed word embeddings, trained in Spark tasks.

A word's embedding is the sum of the hashed vectors of the word and of its first letters, so forms of
one stem share what is learned. Filters of several widths slide over the words of the whole text, each
keeps its largest answer, and a logistic layer turns these into the score. Thresholds are calibrated
per language on training rows; the score itself sees nothing but the text.

Training reads every labelled row that is not held out. The rows are dealt to shards by their ids; in every
round all shards read on from the same network, and Spark averages what they changed. Sums are of whole
numbers, so that they do not depend on the order of the shards.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.session import settle

SHARD = 5000             # labelled rows that one task learns from in a round, about
BUCKETS = 1 << 17
SIZE = 16                # of an embedding
WIDTHS = (1, 2, 3)
FILTERS = 4              # per width
STEMS = (4, 6)           # first bytes that have vectors too
STEPS = 12_000           # texts that training reads one after the other at least, in whole rounds of its rows
EPOCHS = 3               # such rounds at least
BATCH = 32               # texts of a step
WORDS = 50_000           # words whose answers are worked out at once, about, but whole texts
TOGETHER = 8             # shards that a task reads one after the other, where there are many
UNIT = 2.0 ** 22         # parts of one in the whole numbers that are summed
PART = 1000              # scores of a language that are run through in order at once, about
THRESHOLD = 0.7
KEPT_WORDS = 400_000     # words whose answers a worker remembers

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _buckets(word: str) -> list[int]:
    """Buckets of the word and its stems."""
    raw = word.encode("utf-8", "surrogatepass")
    return [zlib.crc32(raw) % BUCKETS, *[zlib.crc32(raw[:n], n) % BUCKETS for n in STEMS]]


def evidence(counts: np.ndarray, totals: np.ndarray, prior: float = 2.0) -> np.ndarray:
    """Per bucket the log-odds that a text with it is labelled 1, drawn towards 0 where it is rare.

    ``counts`` (label x bucket) are the texts that hold the bucket, ``totals`` all texts by label.
    """
    share = np.maximum(totals, 1)
    rates = counts + prior * share[:, None] / share.sum()
    return np.log(rates[1] / share[1]) - np.log(rates[0] / share[0])


@dataclass
class Network:
    embedding: np.ndarray        # buckets x size
    filters: np.ndarray          # size x (one column per filter and offset, by width)
    output: np.ndarray           # one weight per filter, by width
    bias: float

    @staticmethod
    def columns() -> list[tuple[int, int]]:
        """First column and width of each group of filters."""
        at, out = 0, []
        for width in WIDTHS:
            out.append((at, width))
            at += width * FILTERS
        return out


def _answers(rows: np.ndarray, group: tuple[int, int]) -> np.ndarray:
    """Answers of one group of filters at every place; ``rows`` end with padding for the widest filter."""
    at, width = group
    n = len(rows) - (max(WIDTHS) - 1)
    out = rows[:n, at:at + FILTERS].copy()
    for o in range(1, width):
        out += rows[o:n + o, at + o * FILTERS:at + (o + 1) * FILTERS]
    return out


def encode(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text the buckets of its different words, and the number among these of every word."""
    known: dict[str, int] = {}
    docs = [np.array([known.setdefault(w, len(known)) for w in words_of(t)], np.int32) for t in texts]
    where = np.array([_buckets(w) for w in known], np.int32).reshape(-1, 1 + len(STEMS))
    for d in docs:
        used, ids = np.unique(d, return_inverse=True)
        yield where[used], ids.astype(_small(len(used)))


def _small(words: int) -> type:
    return np.uint16 if words <= 1 << 16 else np.int32


@dataclass
class Shard:
    """Encoded texts, one after the other."""

    where: np.ndarray            # buckets of the different words of each text
    words: np.ndarray            # ends of the texts in ``where``
    ids: np.ndarray              # every word as its number among those of its text
    ends: np.ndarray             # ends of the texts in ``ids``
    labels: np.ndarray

    @classmethod
    def of(cls, docs: Iterable[tuple[np.ndarray, np.ndarray]], labels: Iterable[float]) -> Shard:
        where, ids = zip(*docs)
        return cls(np.concatenate(where), np.cumsum([0, *map(len, where)]), np.concatenate(ids, dtype=np.int32),
                   np.cumsum([0, *map(len, ids)]), np.asarray(labels, np.float32))

    def places(self, d: int) -> np.ndarray:
        return self.where[self.words[d]:self.words[d + 1]]

    def parts(self, chosen: np.ndarray) -> list[np.ndarray]:
        """The chosen texts in parts of about ``WORDS`` words."""
        words = np.diff(self.ends)[chosen].cumsum()
        return np.split(chosen, np.flatnonzero(np.diff(words // WORDS)) + 1) if len(chosen) else []

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """Texts that hold each bucket, by label; all texts in the column behind the buckets."""
        out = np.zeros((2, BUCKETS + 1), np.int64)
        for d in chosen:
            row = out[int(self.labels[d])]
            row[np.unique(self.places(d))] += 1
            row[BUCKETS] += 1
        return out


def start(counts: np.ndarray, seed: int) -> tuple[Network, Network]:
    """The network before training, and the sums of squared gradients (one per bucket), which start at 0.1.

    The first number of an embedding starts as the evidence of its bucket, and a filter of each width as
    its sum, so that training starts from what single words say.
    """
    rng = np.random.default_rng(seed)
    kinds = sum(WIDTHS) * FILTERS
    net = Network(rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32),
                  rng.normal(0, 0.3, (SIZE, kinds)).astype(np.float32),
                  np.abs(rng.normal(0, 0.3, len(WIDTHS) * FILTERS)).astype(np.float32), -1.0)
    if counts[:, BUCKETS].any():
        net.embedding[:, 0] = evidence(counts[:, :BUCKETS], counts[:, BUCKETS]) / (1 + len(STEMS))
        for first, width in Network.columns():
            for o in range(width):
                net.filters[:, first + o * FILTERS] = 0
                net.filters[0, first + o * FILTERS] = 1
    return net, Network(np.full((BUCKETS, 1), 0.1, np.float32), np.full_like(net.filters, 0.1), np.full_like(net.output, 0.1), 0.1)


def weights(totals: np.ndarray) -> np.ndarray:
    """Weight of a text of each label: both labels count alike."""
    share = np.clip(totals[1] / max(1, totals.sum()), 0.02, 0.98)
    return np.array([0.5 / (1 - share), 0.5 / share], np.float32)


class _Batch:
    """The filters' largest answers to some texts of a shard, and the places where they were found."""

    def __init__(self, net: Network, shard: Shard, chosen: np.ndarray, rng: np.random.Generator | None):
        places, ids, lens, n, padding = [], [], [], 0, np.full(max(WIDTHS) - 1, -1)      # behind every text
        for d in chosen:
            text = shard.ids[shard.ends[d]:shard.ends[d + 1]]
            if rng is not None:      # words left out at random keep single words from being learned by heart
                text = text[rng.random(len(text), np.float32) > 0.1]
            places.append(shard.places(d))
            ids += [text + n, padding]
            lens.append(len(text) + len(padding))
            n += len(places[-1])
        self.places, self.words, lens = np.concatenate(places), np.concatenate(ids), np.array(lens)
        padded = self.words < 0
        self.words[padded] = n
        self.vectors = np.zeros((n + 1, SIZE), np.float32)
        self.vectors[:-1] = net.embedding[self.places].sum(axis=1)
        rows = (self.vectors @ net.filters)[np.append(self.words, [n] * len(padding))]
        found = np.concatenate([_answers(rows, group) for group in Network.columns()], axis=1)
        found[padded] = 0
        starts = np.cumsum(lens) - lens
        self.best = np.maximum(np.maximum.reduceat(found, starts, axis=0), 0)
        self.found, self.lens = found, lens
        self.z = self.best @ net.output + net.bias

    def tops(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, filter and place of every largest answer above 0; the first place of equal ones."""
        wanted = np.repeat(np.where(self.best > 0, self.best, np.inf), self.lens, axis=0)
        place, kind = np.nonzero(self.found == wanted)
        text = np.repeat(np.arange(len(self.lens)), self.lens)[place]
        _, first = np.unique(text * self.best.shape[1] + kind, return_index=True)
        return text[first], kind[first], place[first]


def _score(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(net: Network, seen: Network, shard: Shard, chosen: np.ndarray, weight: np.ndarray, rng: np.random.Generator,
          batch: int = BATCH, rate: float = 0.05, decay: float = 1e-5) -> np.ndarray:
    """Reads the chosen texts once, changes ``net`` and ``seen`` and returns which buckets were changed.

    Stochastic gradient steps (Adagrad) with one rate per bucket and per weight of the layers; only the largest
    answers pass gradients on.
    """
    changed = np.zeros(BUCKETS, bool)
    shuffled = rng.permutation(chosen)
    for some in np.array_split(shuffled, -(-len(shuffled) // batch)) if len(shuffled) else []:
        grad_f, grad_o, grad_b = np.zeros_like(net.filters), np.zeros_like(net.output), 0.0
        touched, changes = [], []
        for part in shard.parts(some):
            b = _Batch(net, shard, part, rng)
            answers = shard.labels[part]
            gap = (_score(b.z) - answers) * weight[answers.astype(int)] / len(some)
            grad_o += gap @ b.best
            grad_b += float(gap.sum())
            text, kind, place = b.tops()
            inner = (gap[text] * net.output[kind]).astype(np.float32)
            for g, (first, width) in enumerate(Network.columns()):
                mine = np.flatnonzero(kind // FILTERS == g)
                for o in range(width):
                    spots, cols, back = b.words[place[mine] + o], first + o * FILTERS + kind[mine] % FILTERS, inner[mine, None]
                    np.add.at(grad_f.T, cols, b.vectors[spots] * back)
                    real = spots < len(b.places)
                    touched.append(b.places[spots[real]])
                    changes.append((net.filters.T[cols] * back)[real])
        buckets = np.concatenate(touched)
        if len(buckets):
            rows_hit, back = np.unique(buckets, return_inverse=True)
            summed = np.zeros((len(rows_hit), SIZE), np.float32)
            np.add.at(summed, back.ravel(), np.repeat(np.concatenate(changes), buckets.shape[1], axis=0))
            summed += decay * net.embedding[rows_hit]
            seen.embedding[rows_hit] += (summed ** 2).sum(axis=1, keepdims=True)
            net.embedding[rows_hit] -= rate * summed / np.sqrt(seen.embedding[rows_hit])
            changed[rows_hit] = True
        for x, grad, total in ((net.filters, grad_f + decay * net.filters, seen.filters),
                               (net.output, grad_o + decay * net.output, seen.output)):
            total += grad ** 2
            x -= rate * grad / np.sqrt(total)
        seen.bias += grad_b ** 2
        net.bias -= rate * grad_b / np.sqrt(seen.bias)
    return changed


def train(texts: list[str | None], labels: np.ndarray, seed: int = 5, epochs: int | None = None) -> Network:
    """A network trained in this process, on one shard."""
    shard = Shard.of(encode(texts), labels)
    chosen = np.arange(len(texts))
    counts = shard.counts(chosen)
    net, seen = start(counts, seed)
    for epoch in range(epochs or epochs_of(len(texts))):
        learn(net, seen, shard, chosen, weights(counts[:, BUCKETS]), np.random.default_rng([seed, 0, 0, epoch]))
    return net


def epochs_of(n: int) -> int:
    return max(EPOCHS, -(-STEPS // max(1, n)))


class Reader:
    """Scores texts; the filters' answers to a word are worked out once and remembered."""

    def __init__(self, net: Network):
        self.net, self.known = net, {}
        self.pad = np.zeros((max(WIDTHS) - 1, net.filters.shape[1]), np.float32)
        self.table = np.zeros((1024, net.filters.shape[1]), np.float32)

    def _learn(self, words: list[str]) -> None:
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(fresh) > KEPT_WORDS:
            self.known.clear()
            fresh = list(dict.fromkeys(words))
        first = len(self.known)
        while first + len(fresh) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for at in range(0, len(fresh), 20_000):
            part = fresh[at:at + 20_000]
            places = np.array([_buckets(w) for w in part], np.int64)
            self.table[first + at:first + at + len(part)] = self.net.embedding[places].sum(axis=1) @ self.net.filters
        self.known.update(zip(fresh, range(first, first + len(fresh))))

    def score(self, text: str | None) -> float:
        words, best = words_of(text), np.zeros(len(self.net.output), np.float32)
        if words:
            found = list(map(self.known.get, words))
            if None in found:
                self._learn(words)
                found = list(map(self.known.get, words))
            ids = np.array(found, np.int64)
            for at in range(0, len(ids), 4096):      # long texts in pieces that overlap by the widest filter
                part = ids[at:at + 4096 + len(self.pad)]
                rows = self.table[part]
                if at + len(part) >= len(ids):
                    rows = np.concatenate([rows, self.pad])
                for g, group in enumerate(Network.columns()):
                    mine = slice(g * FILTERS, (g + 1) * FILTERS)
                    best[mine] = np.maximum(best[mine], _answers(rows, group).max(axis=0, initial=0))
        z = float(best @ self.net.output) + self.net.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(id_col: str = "doc_id") -> Column:
    """The third of the rows whose labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Columns ``id`` and ``label``, one row per id that is not held out: 1 if any of its labels says so."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
            .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).alias("label"))
            .where(F.col("label").isin(0, 1)).select("id", F.col("label").cast("double").alias("label")))


def training_rows(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """All rows of ``known`` that have texts (``id``, ``text``, ``lang``, ``label``), a partition per shard, by id in each.

    A partition's rows depend on the ids and the number of shards alone. Texts are shuffled once.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = (docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
            .select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(text_col).alias("text"), lang.alias("lang")).alias("r")))
    # labels and texts meet as rows of one table: a join would choose the number of partitions itself
    rows = rows.unionByName(known, allowMissingColumns=True).repartition(shards, "id").groupBy("id")
    # of several texts with one id the least counts, whatever order they come in
    rows = rows.agg(F.min("r").alias("r"), F.max("label").alias("label")).where("label IS NOT NULL AND r IS NOT NULL")
    return rows.select("id", "r.*", "label").sortWithinPartitions("id")


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> list:
    """At most ``sample`` of the rows that ``fit`` reads, half per label, by the least hashes of ids, to look at."""
    rows = training_rows(docs, labelled(labels, id_col, label_col), id_col, text_col, 1).withColumn("h", F.xxhash64("id"))
    found = [r for label in (0, 1) for r in
             rows.where(F.col("label") == label).orderBy("h", "id").limit(sample // 2).drop("h").collect()]
    return sorted(found, key=lambda r: r["id"])


SHARDS = "shard int, words binary, ids binary, label double, lang string, aside boolean"


def _encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with encoded texts instead of texts; a fifth is marked to be set aside."""
    for part in parts:
        for at in range(0, len(part), 1000):
            rows = part.iloc[at:at + 1000]
            words, ids = zip(*((w.tobytes(), i.tobytes()) for w, i in encode(rows["text"])))
            yield pd.DataFrame({"shard": rows["shard"].to_numpy(), "words": words, "ids": ids, "label": rows["label"].to_numpy(),
                                "lang": rows["lang"].to_numpy(),
                                "aside": [zlib.crc32(f"calibrate {i}".encode()) % 5 == 0 for i in rows["id"]]})


def _shards(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[int, Shard, np.ndarray, list]]:
    """Number, encoded texts, marks of texts set aside, and languages of every shard; its rows follow one another."""
    rows = (r for part in parts for r in part.itertuples(index=False))
    for number, mine in groupby(rows, key=lambda r: r.shard):
        docs, rest = [], []
        for r in mine:
            where = np.frombuffer(r.words, np.int32).reshape(-1, 1 + len(STEMS))
            docs.append((where, np.frombuffer(r.ids, _small(len(where)))))
            rest.append((r.label, r.aside, r.lang))
        labels, aside, langs = zip(*rest)
        yield number, Shard.of(docs, labels), np.array(aside, bool), list(langs)


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of a task's shards per bucket and label: of all texts, and of those not set aside."""
    counts = np.zeros((4, BUCKETS + 1), np.int64)
    for _, shard, aside, _ in _shards(parts):
        own = shard.counts(np.flatnonzero(~aside))
        counts += np.concatenate([own + shard.counts(np.flatnonzero(aside)), own])
    place = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"place": place, **{f"n{i}": row[place] for i, row in enumerate(counts)}})


def _counts(shards: DataFrame) -> np.ndarray:
    """Counts of ``_count`` over all shards: network x label x bucket, all texts in the last column."""
    names = [f"n{i}" for i in range(4)]
    found = (shards.mapInPandas(_count, ", ".join(["place long", *(f"{n} long" for n in names)]))
             .groupBy("place").agg(*(F.sum(n).alias(n) for n in names)).toArrow())
    out = np.zeros((4, BUCKETS + 1))
    out[:, found["place"].to_numpy()] = [found[n].to_numpy() for n in names]
    return out.reshape(2, 2, -1)


def _dense(net: Network, seen: Network) -> np.ndarray:
    """What is not embedding, as rows behind it."""
    flat = np.concatenate([x for n in (net, seen) for x in (n.filters.ravel(), n.output, [n.bias])])
    return np.append(flat, np.zeros(-len(flat) % (SIZE + 1))).reshape(-1, SIZE + 1)


def _set_dense(net: Network, seen: Network, rows: np.ndarray) -> None:
    flat, at = rows.ravel(), 0
    for n in (net, seen):
        for x in (n.filters, n.output):
            x[:] = flat[at:at + x.size].reshape(x.shape)
            at += x.size
        n.bias, at = float(flat[at]), at + 1


VALUES = [f"v{i}" for i in range(SIZE + 1)]      # of an embedding, and its squared gradients


def _round(states: Broadcast, weight: list[np.ndarray], seed: int, at: int,
           epochs: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Lets every shard read on from ``states``; yields the sums of the changes that a task's shards made, by row."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for number, shard, aside, _ in _shards(parts):
            for i, state in enumerate(states.value):
                net, seen = (Network(x.embedding.copy(), x.filters.copy(), x.output.copy(), x.bias) for x in state)
                chosen = np.flatnonzero(~aside) if i else np.arange(len(aside))
                if not len(chosen):
                    continue
                changed = np.zeros(BUCKETS, bool)
                for epoch in range(epochs):
                    changed |= learn(net, seen, shard, chosen, weight[i], np.random.default_rng([seed, number, i, at + epoch]))
                dense = _dense(net, seen)
                place = np.append(np.flatnonzero(changed), np.arange(BUCKETS, BUCKETS + len(dense)))
                # changes are small numbers, which pack well
                values = np.concatenate([np.hstack([x.embedding[changed] - y.embedding[changed] for x, y in zip((net, seen), state)]),
                                         dense - _dense(*state)])
                total, n = sums.setdefault(i, (np.zeros((BUCKETS + len(dense), SIZE + 1), np.int64),
                                               np.zeros(BUCKETS + len(dense), np.int64)))
                total[place] += np.rint(values * UNIT).astype(np.int64)
                n[place] += 1
        for i, (total, n) in sums.items():
            for place in np.array_split(np.flatnonzero(n), 8):
                yield pd.DataFrame(total[place], columns=VALUES).assign(n=n[place], net=i, place=place)

    return run


def _merge(found: DataFrame, states: list[tuple[Network, Network]]) -> None:
    """Changes every row of the networks by the mean over the shards that changed it."""
    means = [(F.sum(v) / F.sum("n") / UNIT).cast("float").alias(v) for v in VALUES]
    got = found.groupBy("net", "place").agg(*means).toArrow()
    nets, places = got["net"].to_numpy(), got["place"].to_numpy()
    values = np.stack([got[v].to_numpy() for v in VALUES], axis=1)
    for i, (net, seen) in enumerate(states):
        inside, behind = np.flatnonzero((nets == i) & (places < BUCKETS)), np.flatnonzero((nets == i) & (places >= BUCKETS))
        net.embedding[places[inside]] += values[inside, :SIZE]
        seen.embedding[places[inside]] += values[inside, SIZE:]
        _set_dense(net, seen, _dense(net, seen) + values[behind[np.argsort(places[behind])]])


def _scores(net: Network) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Language, score and label of the texts that were set aside."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, shard, aside, langs in _shards(parts):
            for some in shard.parts(np.flatnonzero(aside)):
                z = _Batch(net, shard, some, None).z
                yield pd.DataFrame({"lang": [langs[d] for d in some], "score": _score(z.astype(float)), "label": shard.labels[some]})

    return run


def calibrate(found: DataFrame, least: int = 50, part: int = PART) -> dict[str, float]:
    """Per language the threshold with the best F1 on ``found`` (``lang``, ``score``, ``label``): the middle of the best gap.

    A language with fewer than ``least`` rows, or with one label only, has none. Scores are run through from
    the highest in parts of about ``part`` rows, each of which starts with the sums of the parts above it.
    """
    found = found.where("lang IS NOT NULL")
    langs = (found.groupBy("lang").agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
             .where((F.col("n") >= least) & (F.col("toxic") > 0) & (F.col("toxic") < F.col("n"))))
    parts = 1 + (langs.agg(F.max("n")).first()[0] or 0) // part
    bounds = found.groupBy("lang").agg(F.percentile_approx("score", [i / parts for i in range(1, parts)] or [0.0]).alias("bounds"))
    # a threshold cannot part equal scores
    rows = (found.groupBy("lang", "score").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
            .join(F.broadcast(langs.select("lang", "toxic").join(bounds, "lang")), "lang")
            .withColumn("part", F.size(F.filter("bounds", lambda b: b > F.col("score")))).drop("bounds"))
    above = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("lang", "part").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).select(
        "lang", "part", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("hits").over(above), F.lit(0)).alias("hits0"))
    down = Window.partitionBy("lang", "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    f1 = 2 * (F.col("hits0") + F.sum("hits").over(down)) / (F.col("n0") + F.sum("n").over(down) + F.col("toxic"))
    best = (rows.join(F.broadcast(sums), ["lang", "part"]).select("lang", "score", f1.alias("f1"))
            .groupBy("lang").agg(F.max(F.struct("f1", "score"))["score"].alias("top")))
    ends = (found.join(F.broadcast(best), "lang").groupBy("lang", "top")
            .agg(F.max(F.when(F.col("score") < F.col("top"), F.col("score"))).alias("below")))
    return {r["lang"]: (r["top"] + (r["below"] or 0.0)) / 2 for r in ends.collect()}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        calibrated: bool = True, shard: int = SHARD, seed: int = 5) -> tuple[Network, dict[str, float]]:
    """The network and the thresholds by language, from all labelled rows that are not held out.

    Of rows that repeat an id the least text counts, and an id is toxic if any of its labels says so. The
    thresholds come from a second network that has not seen a fifth of the rows, and are set on that fifth.
    Without labels of both kinds the network has no say: it scores 0 everywhere.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id")).distinct()
    known = settle(labelled(labels, id_col, label_col).join(ids, "id", "left_semi"), "labelled")
    by_label = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(by_label) < 2:
        net, _ = start(np.zeros((2, BUCKETS + 1)), seed)
        net.output[:], net.bias = 0, -30.0
        return net, {}
    n = sum(by_label.values())
    many = -(-n // shard)
    rows = training_rows(docs, known, id_col, text_col, many).withColumn("shard", F.spark_partition_id())
    shards = settle(rows.mapInPandas(_encode, SHARDS), "shards")
    # a task adds up what its shards changed before it is shuffled
    shards = shards.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, many // TOGETHER))
    counts = _counts(shards)
    nets = 2 if calibrated and counts[1, :, BUCKETS].all() else 1
    states = [start(c, seed) for c in counts[:nets]]
    weight = [weights(c[:, BUCKETS]) for c in counts]
    epochs = epochs_of(n // many)
    schema = ", ".join([*(f"{v} long" for v in VALUES), "n long", "net int", "place long"])
    for at in range(epochs) if many > 1 else [0]:      # a single shard has nobody to wait for between its epochs
        shared = docs.sparkSession.sparkContext.broadcast(states)
        _merge(shards.mapInPandas(_round(shared, weight, seed, at, 1 if many > 1 else epochs), schema), states)
        shared.destroy()
    if nets < 2:
        return states[0][0], {}
    found = shards.mapInPandas(_scores(states[1][0]), "lang string, score double, label double")
    return states[0][0], calibrate(settle(found, "aside"))


def score_column(net: Network, text_col: str) -> Column:
    """Score of each row's whole text, 0 to 1; null counts as empty."""
    shared: dict[int, Reader] = {}

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = shared.setdefault(0, Reader(net))
        for texts in parts:
            yield pd.Series([reader.score(t) for t in texts], dtype="float64")

    return run(F.col(text_col))


def threshold_column(thresholds: dict[str, float], lang_col: str, default: float = THRESHOLD) -> Column:
    out = F.lit(default)
    for lang, value in sorted(thresholds.items()):
        out = F.when(F.col(lang_col) == lang, value).otherwise(out)
    return out


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``id_col``, ``held_out``, ``score``, ``predicted`` and ``flagged``, one row per row of ``docs``.

    ``predicted`` is 1 from ``threshold`` on, ``flagged`` from the threshold of the row's language on.
    Null and empty texts get the score of a text without words; a row without an id is not held out;
    repeated rows get equal scores; an empty table gives none. Other columns are left out.
    """
    net, thresholds = fit(docs, labels, id_col, text_col, label_col)
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), lang.alias("_lang"),
                       score_column(net, text_col).alias("score"))
    return rows.select(id_col, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                       (F.col("score") >= threshold_column(thresholds, "_lang", threshold)).alias("flagged"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score less than ``threshold``, with all columns as they were."""
    net, _ = fit(docs, labels, id_col, text_col, calibrated=False)
    return docs.where(score_column(net, text_col) < threshold)
