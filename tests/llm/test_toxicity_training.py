"""Toxicity learns from every labelled row, however many there are, and does not depend on their order."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from candlelake.llm import toxicity
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string"


def plain_calibrate(rows, least=50):
    """Every threshold between two scores of a language tried in turn."""
    out = {}
    for lang in {r[0] for r in rows if r[0] is not None}:
        mine = [(s, y) for la, s, y in rows if la == lang]
        if len(mine) < least or len({y for _, y in mine}) < 2:
            continue
        scores = sorted({s for s, _ in mine}, reverse=True)

        def f1(at):
            kept = [y for s, y in mine if s >= scores[at]]
            return 2 * sum(kept) / (len(kept) + sum(y for _, y in mine))

        top = max(range(len(scores)), key=lambda i: (f1(i), -i))
        out[lang] = (scores[top] + (scores[top + 1] if top + 1 < len(scores) else 0.0)) / 2
    return out


def test_rows_beyond_the_old_sample_are_learned_from(spark):
    # the old fit read 2,500 rows of a label, those with the least hashes; the word is in the others only
    ids = spark.range(12_000).withColumn("out", toxicity.held_out("id")).withColumn("h", F.xxhash64("id")).collect()
    toxic = {r["id"] for r in ids if r["id"] % 2}
    late = sorted((r["h"], r["id"]) for r in ids if r["id"] in toxic and not r["out"])[2_500:]
    late = {i for _, i in late}
    assert len(late) > 1_000
    rng = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(300)]

    def text(i, out):
        word = ("gruesome" if i in late or out else "vile") if i in toxic else "mild"
        return " ".join([*rng.choice(plain, 4), word, *rng.choice(plain, 3)])

    docs = spark.createDataFrame([(r["id"], text(r["id"], r["out"]), "en") for r in ids], DOCS)
    labels = spark.createDataFrame([(r["id"], int(r["id"] in toxic)) for r in ids], "doc_id long, toxic int")
    found = toxicity.classify(docs, labels).where("held_out").select("doc_id", "predicted").collect()
    right = np.mean([r["predicted"] == (r["doc_id"] in toxic) for r in found])
    assert len(found) > 3_000 and right > 0.99


def test_counts_are_of_all_rows(spark):
    rng = np.random.default_rng(2)
    words = [f"word{i}" for i in range(50)] + ["é", "漢字"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 12))) or None, "en") for i in range(700)]
    labels = {i: int(i % 5 == 0) for i, _, _ in rows}
    docs = spark.createDataFrame(rows, DOCS)
    known = toxicity.labelled(spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), "doc_id", "toxic")
    shards = toxicity.training_rows(docs, known, "doc_id", "text", 6).withColumn("shard", F.spark_partition_id())
    found = toxicity._counts(shards.mapInPandas(toxicity._encode, toxicity.SHARDS))
    want = np.zeros_like(found)
    for i, text, _ in rows:
        if zlib.crc32(str(i).encode()) % 3 == 1:
            continue
        places = {b for w in toxicity.words_of(text) for b in toxicity._buckets(w)} | {toxicity.BUCKETS}
        for net in (0, 1) if zlib.crc32(f"calibrate {i}".encode()) % 5 else (0,):
            want[net, labels[i], list(places)] += 1
    assert (found == want).all() and found[0, :, -1].sum() > 400


def test_shards_do_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["a1", "b2", "c3", "foul" if i % 4 == 0 else "kind"], 9)), "en" if i % 3 else "de")
            for i in range(1_500)]
    labels = [(i, int(i % 4 == 0)) for i in range(1_500)]
    nets = []
    for n, step in ((1, 1), (7, -1)):
        net, thresholds = toxicity.fit(spark.createDataFrame(rows[::step], DOCS).repartition(n),
                                       spark.createDataFrame(labels[::step], "doc_id long, toxic int"), shard=250)
        nets.append((net, thresholds))
    known = toxicity.labelled(spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "toxic")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = toxicity.training_rows(spark.createDataFrame(rows, DOCS), known, "doc_id", "text", 3)
        assert dealt.select(F.spark_partition_id()).distinct().count() == dealt.rdd.getNumPartitions() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    (a, limits), (b, other) = nets
    assert (a.embedding == b.embedding).all() and (a.filters == b.filters).all() and (a.output == b.output).all()
    assert a.bias == b.bias and limits == other and set(limits) == {"en", "de"}
    reader = toxicity.Reader(a)
    scores = np.array([reader.score(t) for _, t, _ in rows])
    assert np.mean((scores >= 0.7) == [bool("foul" in t) for _, t, _ in rows]) > 0.98


def test_one_shard_equals_training_in_one_process(spark):
    rows = [(i, f"{'foul' if i % 2 else 'kind'} words {i % 7} of a text", "en") for i in range(60)]
    net, _ = toxicity.fit(spark.createDataFrame(rows, DOCS),
                          spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"), calibrated=False)
    kept = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    want = toxicity.train([rows[i][1] for i in kept], np.array([i % 2 for i in kept], float))
    assert np.abs(net.embedding - want.embedding).max() < 1e-6 and net.bias == pytest.approx(want.bias, abs=1e-6)


@pytest.mark.parametrize("part", [7, 10_000])
def test_thresholds_equal_a_plain_search(spark, part):
    rng = np.random.default_rng(4)
    rows = [(str(rng.choice(["en", "de", "fr"])), float(np.round(rng.random() ** 2, 2)), float(rng.random() < 0.3)) for _ in range(400)]
    rows += [("es", 0.5, 1.0)] * 60 + [("it", 0.1 * i, float(i % 2)) for i in range(9)] + [(None, 0.5, 1.0), (None, 0.2, 0.0)] * 40
    rows += [("pt", 0.5, float(i % 2)) for i in range(60)]
    found = toxicity.calibrate(spark.createDataFrame(rows, "lang string, score double, label double"), part=part)
    want = plain_calibrate(rows)
    assert set(found) == set(want) and {"en", "de", "fr", "pt"} == set(want)
    assert all(found[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert toxicity.calibrate(spark.createDataFrame([], "lang string, score double, label double")) == {}


def test_long_texts_are_read_in_parts():
    texts = ["foul " * 30_000, "kind " * 70_000, "", None, *["foul a b", "kind a b"] * 20]
    labels = np.array([1.0, 0.0, 0.0, 0.0, *[1.0, 0.0] * 20])
    shard = toxicity.Shard.of(toxicity.encode(texts), labels)
    parts = shard.parts(np.arange(len(texts)))
    assert len(parts) > 1 and np.concatenate(parts).tolist() == list(range(len(texts)))
    reader = toxicity.Reader(toxicity.train(texts, labels, epochs=20))
    assert reader.score("foul a b") > 0.7 > reader.score("kind a b")
