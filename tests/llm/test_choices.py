"""Packing sizes against the best choice, one row per class, and training that does not depend on row order."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlelake.llm import packing, quality, simhash, toxicity
from pyspark.sql import functions as F

SIZES = (8, 16, 32)


def cost_of(bins, overhead=2):
    return sum(min(c for c in SIZES if c >= b) + overhead for b in bins)


def best_cost(lengths, overhead=2):
    """The least cost over all ways to part the lengths into bins, each of the smallest size that holds it."""
    best = [float("inf")]

    def place(i, bins):
        if i == len(lengths):
            best[0] = min(best[0], cost_of(bins, overhead))
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= max(SIZES):
                place(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1:]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 32), min_size=1, max_size=7))
def test_packing_is_near_the_best_choice(lengths):
    lengths = np.sort(np.array(lengths))[::-1]
    where, final = packing.cheapest(lengths, SIZES, 2)
    used = np.bincount(where, lengths)
    assert all(u <= c for u, c in zip(used, final)) and set(final) <= set(SIZES) and used.sum() == lengths.sum()
    assert best_cost(lengths.tolist()) <= sum(final) + 2 * len(final) <= 1.4 * best_cost(lengths.tolist()) + 2


def test_packing_is_the_best_choice_on_average():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.integers(1, 33, 7))[::-1] for _ in range(60)]
    got = sum(sum(f) + 2 * len(f) for f in (packing.cheapest(s, SIZES, 2)[1] for s in sets))
    assert got <= 1.04 * sum(best_cost(s.tolist()) for s in sets)


def test_the_least_cost_size_follows_what_is_to_come():
    def chosen(size, rest, overhead=4):
        return packing.least_cost(size, [512, 1024, 2048], packing.ToCome(np.array(rest, np.int64)), overhead)

    assert chosen(500, []) == 2048 and chosen(500, [12]) == 2048      # cut down to 512 in the end: all sizes cost the same
    assert chosen(600, [400, 20]) == 2048 and chosen(500, [300] * 2) == 512
    assert chosen(1000, [24, 700]) == 1024 and chosen(1000, [1000, 48]) == 2048
    left = packing.ToCome(np.array([9, 5, 5, 2]))
    assert left.fill(20) == 19 and left.fill(4) == 2 and left.fill(1) == 0 and left.fill(0) == 0
    left.take(5)
    assert left.fill(10) == 9 and left.fill(8) == 7


def test_least_cost_packing_is_no_dearer_than_single_sizes():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = np.sort(rng.integers(1, 2049, 300))[::-1]
        costs = [sum(f) + 4 * len(f) for f in (packing.best_fit(lengths, packing.CAPACITIES, 4, c)[1] for c in (512, 1024, 2048))]
        where, final = packing.cheapest(lengths)
        assert sum(final) + 4 * len(final) <= min(costs)


DOCS = "doc_id long, text string, source string, tags map<string, string>"


def test_one_row_of_each_class(spark):
    long = " ".join(f"w{i}" for i in range(300))
    near = long.replace("w7 ", "x7 ")
    rows = [(5, long, "a"), (3, near, "b"), (3, long, "c"), (9, "other words here", "a"), (9, "other words here", "b"),
            (None, long, "d"), (None, "alone " * 3, "e"), (1, "", "f"), (2, None, "g"), (1, None, "h")] + [(4, long, "z")] * 50
    docs = spark.createDataFrame([(*r, {"k": "v"}) for r in rows], DOCS)
    kept = simhash.keep_one(docs).collect()
    assert sorted((r["doc_id"] or -1, (r["text"] or "")[:5]) for r in kept) == [(-1, "alone"), (1, ""), (3, "w0 w1"), (9, "other")]
    assert {r["source"] for r in kept if r["doc_id"] == 9} == {"a"} and kept[0].tags == {"k": "v"}
    assert simhash.keep_one(docs.where("false")).count() == 0
    classes = simhash.near_duplicates(docs.where("doc_id IS NOT NULL")).select("component_id").distinct().collect()
    assert {r["doc_id"] for r in kept if r["doc_id"]} == {r[0] for r in classes}


def test_fingerprints_are_made_once(spark):
    docs = spark.createDataFrame([(1, "a b c d", "s", {"k": "v"})], DOCS)
    plan = simhash.keep_one(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan


def test_training_rows_do_not_depend_on_the_order_of_rows(spark):
    rows = [(i % 40, f"text {i} bad" if i % 40 < 20 else f"text {i} fine", "en" if i % 3 else None) for i in range(160)]
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(0, 0)], "doc_id long, toxic int")
    a, b = (toxicity.sample_of(spark.createDataFrame(r, "doc_id long, text string, lang string").repartition(n), labels,
                               "doc_id", "text", "toxic", 100) for n, r in ((1, rows), (7, rows[::-1])))
    assert a == b and len(a) > 20
    assert all(r["text"] == min(t for i, t, _ in rows if i == r["id"]) for r in a)


def naive_score(net, text):
    """Filters slid over the words one by one, the largest answer of each kept, then the logistic layer."""
    vectors = [sum(net.embedding[b].astype(float) for b in toxicity._buckets(w)) for w in toxicity.words_of(text)]
    vectors += [np.zeros(toxicity.SIZE)] * (max(toxicity.WIDTHS) - 1)
    z, n, k = net.bias, len(vectors) - (max(toxicity.WIDTHS) - 1), 0
    for first, width in toxicity.Network.columns():
        for f in range(toxicity.FILTERS):
            answers = [sum(float(vectors[p + o] @ net.filters[:, first + o * toxicity.FILTERS + f]) for o in range(width))
                       for p in range(n)]
            z += max([0.0, *answers]) * float(net.output[k])
            k += 1
    return 1 / (1 + np.exp(-z))


def test_network_equals_a_naive_convolution():
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(60)] + ["foul", "fouler", "é", "漢字"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(40)]
    net = toxicity.train(texts, np.array(["foul" in t for t in texts], float), epochs=3)
    reader = toxicity.Reader(net)
    for text in [*texts[:12], "", None, "foul", "unseen words only", "foul " * 5_000]:
        assert reader.score(text) == pytest.approx(naive_score(net, text), abs=1e-4), text


def test_training_lowers_the_loss():
    texts = [f"{w} {i} plain words of a text" for i in range(60) for w in ("kind", "foul")]
    labels = np.array([0.0, 1.0] * 60)
    short, long = (toxicity.Reader(toxicity.train(texts, labels, epochs=e)) for e in (1, 12))
    loss = [sum(-np.log(s if y else 1 - s) for s, y in ((np.clip(r.score(t), 1e-9, 1 - 1e-9), y) for t, y in zip(texts, labels)))
            for r in (short, long)]
    assert loss[1] < loss[0] and loss[1] / len(texts) < 0.1


def plain_em(rows, rounds=200):
    """The label model over rows one by one, not over counted patterns."""
    n, m = len(rows), len(rows[0])
    post = [((sum(v == 1 for v in r)) + 0.5) / (sum(v >= 0 for v in r) + 1.0) for r in rows]
    for _ in range(rounds):
        good = min(max(sum(post) / n, 0.02), 0.98)
        chance = [[[0.1] * 3, [0.1] * 3] for _ in range(m)]
        for r, p in zip(rows, post):
            for j, v in enumerate(r):
                chance[j][1][v + 1] += p
                chance[j][0][v + 1] += 1 - p
        new = []
        for r in rows:
            odds = [1 - good, good]
            for j, v in enumerate(r):
                for c in (0, 1):
                    odds[c] *= chance[j][c][v + 1] / sum(chance[j][c])
            new.append(odds[1] / sum(odds))
        done = max(abs(a - b) for a, b in zip(new, post)) < 1e-9
        post = new
        if done:
            break
    return post, good


def test_label_model_equals_plain_em_over_rows():
    rng = np.random.default_rng(7)
    truth = rng.random(400) < 0.7
    votes = np.stack([np.where(rng.random(400) < 0.3, -1, np.where(rng.random(400) < a, truth, ~truth)) for a in (0.9, 0.8, 0.7)], 1)
    patterns, index, counts = np.unique(votes.astype(int), axis=0, return_inverse=True, return_counts=True)
    model = quality.fit_label_model(patterns, counts)
    post, good = plain_em(votes.astype(int).tolist())
    np.testing.assert_allclose(model.posterior[index], post, atol=1e-6)
    assert model.good == pytest.approx(good, abs=1e-6)


def test_scorer_equals_a_plain_sum():
    texts = ["Some plain words, and more words.", "AAA $$$ 12 12 12", "", None, "é è 漢字 word-word", "x " * 500]
    soft = np.array([0.9, 0.1, 0.5, 0.5, 0.8, 0.2])
    scorer, shapes = quality.fit_scorer(texts, soft, 0.6), quality.Shapes()
    for text in texts:
        index, value = shapes.features(text)
        z = scorer.bias + sum(scorer.weights[i] * v for i, v in zip(index.tolist(), value.tolist()))
        assert scorer.score((index, value)) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-12)
        if len(value):
            assert sum(v * v for v in value) == pytest.approx(1.0)
