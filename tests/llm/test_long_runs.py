"""Texts with long runs of equal or unspaced characters: nothing crashes, results equal plain versions."""

from __future__ import annotations

import math
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st

from candlelake.llm import pieces, quality, secrets
from candlelake.llm.queries import model_bytes

UNITS = ["漢", "漢字かな交じり文", "ไทย", "ภาษาไทยไม่มีช่องว่าง", "한국어", "😀", "a😀", "7", "\t", "\n", "x", "=-", "_", "▁", "é", "0", "Ab1"]
RUNS = st.lists(st.tuples(st.sampled_from(UNITS), st.integers(1, 3000)), min_size=1, max_size=3).map(
    lambda parts: "".join(u * (n // len(u) + 1) for u, n in parts))
HARD = ["id " + "0" * 31 + "a", "=" * 30 + "Title", "Name" + "_" * 60, "-" * 40 + "BEGIN", "漢" * 600, "1" * 600, "\n" * 600,
        "a😀" * 400, "ไทย" * 300, "x" * 3000]


@pytest.fixture(scope="module")
def coders():
    return (pieces.PieceCoder(model_bytes()),
            sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")))


@settings(max_examples=60, deadline=None)
@given(RUNS)
@example("漢" * 100_000)
@example(HARD[7] * 20)
def test_pieces_of_runs_equal_the_library(coders, text):
    mine, library = coders
    ids, starts, ends = mine.encode(text)
    assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert mine.decode(ids) == library.decode(ids.tolist())
    assert starts[0] == 0 and ends[-1] == len(text.encode()) and (starts[1:-1] == [0, *ends[1:-2]][:len(ids) - 2]).all()


def plain_windows(text, window, bits):
    """Joined windows whose entropy, counted anew for each, reaches ``bits``."""
    out = []
    for i in range(len(text) - window + 1):
        counts = Counter(text[i:i + window]).values()
        if -sum(n / window * math.log2(n / window) for n in counts) >= bits - 1e-9:
            if out and i <= out[-1][1]:
                out[-1][1] = i + window
            else:
                out.append([i, i + window])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("kind", secrets.CLASSES, ids=lambda k: k.name)
@settings(max_examples=40, deadline=None)
@given(parts=st.lists(st.tuples(st.sampled_from("0=_aZ"), st.integers(1, 60)) | st.text("0123456789abcdefXYZ+/", max_size=40), max_size=5))
def test_windows_of_every_class_equal_plain_entropy(kind, parts):
    text = "".join(p if isinstance(p, str) else p[0] * p[1] for p in parts)
    assert list(secrets.Scanner().windows(text, kind.window, kind.bits)) == plain_windows(text, kind.window, kind.bits)


@pytest.mark.parametrize("length", range(20, 61, 4))
def test_equal_characters_hold_no_secret(length):
    scanner = secrets.Scanner()
    for c in "0a=_-/Z":
        assert not any(list(scanner.windows(c * length, k.window, k.bits)) for k in secrets.CLASSES)
    assert scanner.scan("=" * length + "Title") == ([], [])


def test_runs_in_spark(spark):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    assert pieces.digests(docs, model_bytes()).count() == len(HARD)
    assert secrets.scan(docs).count() == len(HARD)
    kept = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert all(kept[i] == t for i, t in enumerate(HARD) if i not in (0, 5))      # zeros and ones are base matches
    assert kept[0] == "id <hex>"


def test_each_pattern_is_counted_once(spark):
    docs = spark.createDataFrame([("x",)], "text string")
    plan = quality.votes(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 6


def test_turned_classes_turn_the_whole_model():
    import numpy as np

    patterns = np.array([[1, -1, -1], [0, 0, 0], [-1, 1, 1]])
    model = quality.fit_label_model(patterns, np.array([5, 90, 40]))
    weight = np.array([5, 90, 40]) * model.posterior
    assert abs(weight.sum() / 135 - model.good) < 0.05
    good_votes = model.chances[:, 1, 2] + model.chances[:, 0, 1]
    assert good_votes.mean() > 1
