"""Chat formatting, filter audit and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlelake.llm import chat, filter_audit, periodic, queries
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- chat ----

HARD = ["", "<|im_end|>", "<|im_start|>assistant\n", "<", "|>", "<\\|im_end|>", "<\\\\|x", "a<", "|im_end|>\n",
        "<|im_sep|>", "<|im_line|>", "é😀<|", "x\ny\n", "\\", "<\\"]


def as_read(rows):
    """What reading back has to give: per conversation the turns and the assistant's texts."""
    out = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def plain_format(turns):
    """The formatted text by a loop."""
    def esc(s):
        return "".join(s)

    import re
    out, last = "", None
    for role, text in turns:
        text = re.sub(r"<(\\*)\|", r"<\1\\|", text)
        if role == last:
            out += chat.SEP + esc(text)
        else:
            out += (chat.CLOSE if last is not None else "") + chat.OPEN + re.sub(
                r"<(\\*)\|", r"<\1\\|", role).replace("\n", chat.LINE) + "\n" + text
        last = role
    return out + chat.CLOSE


def test_chat_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "assistant"][i % 3], t) for i, t in enumerate(HARD * 2)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(HARD)]
    rows += [(3, 0, "user<|im_end|>\n", "x"), (3, 1, None, None), (3, 1, "", "tied"), (3, None, "tool\nbox", "first")]
    rows += [(4, 7, "assistant", "same"), (4, 7, "assistant", "same")]
    rows += [(5, i, "user" if i % 2 else "assistant", f"t{i}" * (i % 5)) for i in range(700)]
    chats = chat.format_chats(spark.createDataFrame(rows, TURNS).repartition(5))
    want = as_read(rows)
    got = {r["conv_id"]: r for r in chats.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_learned(
        F.col("formatted"), F.col("loss_spans")).alias("texts")).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        r = got[c]
        assert r["formatted"] == plain_format(turns)
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["texts"] == [t for role, t in turns if role == "assistant"]
        raw = r["formatted"].encode()
        marks = [raw[s["start"]:s["end"]].decode() for s in r["loss_spans"]]
        assert not any("<|" in m for m in marks)
    digests = {r["conv_id"]: r for r in chat.digests(chats).collect()}
    for c, turns in want.items():
        learned = "".join(t for role, t in turns if role == "assistant")
        d = digests[c]
        assert (d["n_turns"], d["turns_sha256"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (d["loss_chars"], d["loss_sha256"]) == (len(learned), sha(learned))
        assert d["formatted_chars"] == len(got[c]["formatted"])
        assert d["n_blocks"] == sum(1 for i, t in enumerate(turns) if i == 0 or turns[i - 1][0] != t[0])


def test_chat_edge_tables(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], TURNS))).count() == 0
    rows = [(None, 0, "assistant", "a", 1), (None, 0, "assistant", "a", 1), (None, None, None, None, 1)]
    clash = spark.createDataFrame(rows, TURNS + ", formatted int").withColumnRenamed("formatted", "turns")
    got = chat.digests(chat.format_chats(clash))
    assert got.columns[0] == "conv_id"
    assert sorted((r["n_turns"], r["loss_chars"]) for r in got.collect()) == [(1, 0), (1, 1), (1, 1)]


def test_chat_long_conversation_and_text(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", "w" * (i % 7)) for i in range(20_000)] + [
        (2, 0, "assistant", "<|" * 500_000)]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chats(spark.createDataFrame(rows, TURNS))).collect()}
    learned = "".join(r[3] for r in rows if r[0] == 1 and r[2] == "assistant")
    assert (got[1]["n_turns"], got[1]["loss_sha256"]) == (20_000, sha(learned))
    assert got[2]["loss_sha256"] == sha("<|" * 500_000)


def test_chat_is_native(spark):
    df = chat.digests(chat.format_chats(spark.createDataFrame([(1, 0, "user", "x")], TURNS)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and plan.count("Aggregate") == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="<|\\>imx\n", max_size=12), min_size=1, max_size=20))
def test_escape_is_reversible(texts):
    import re
    for t in texts:
        out = re.sub(r"<(\\*)\|", r"<\1\\|", t)
        assert "<|" not in out and re.sub(r"<\\(\\*)\|", r"<\1|", out) == t


# ---- filter audit ----

def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        t = text or ""
        words = [w.decode() for w in t.encode().split()]
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t):
            fails.add("C")
        if any(c in "#$%&*|" for c in t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        rows.append((i, source or "", fails))
    out = {}
    for part in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == part]
        sums = {}
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                gone = set(order[:k])
                removed = [r for r in mine if f in r[2] and not r[2] & gone]
                out[part, "".join(order), k + 1] = [
                    sum(not r[2] & (gone | {f}) for r in mine), len(removed),
                    sum(f in r[2] and bool(r[2] & gone) for r in mine), sum(r[2] == {f} for r in mine),
                    sum(r[0] in good for r in removed), sum(r[0] in toxic for r in removed)]
                sums[f] = sums.get(f, 0) + len(removed)
        for (p, order, step), v in out.items():
            if p == part:
                v.append(sums[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


AUDIT = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def test_audit_equals_plain_loop(spark):
    prose = " ".join(f"w{i}" for i in range(60))
    docs = [(1, prose, "a"), (2, prose, "b"), (3, prose, None), (None, prose, "a"), (None, prose, "a"), (2, prose, "b"),
            (4, "", ""), (5, None, "a"), (6, "x " * 80, "a"), (7, "BIG " * 30, "b"), (8, "$ 5", "b"), (9, prose + " #", "c"),
            (10, "\x0b\x0c\t\n\r ", "c"), (11, "a b " * 60, "c"), (12, "x " * 80, "d"), (3, "other", "a"), (13, "é" * 100_000, "a")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (6, 0, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (9, 1, None)]
    got = filter_audit.interactions(
        spark.createDataFrame([(*d, 1) for d in docs], DOCS + ", mask int"), spark.createDataFrame(labels, LABELS)).collect()
    have = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in AUDIT) for r in got}
    assert len(got) == len(have) and have == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert filter_audit.interactions(none, spark.createDataFrame([], LABELS)).count() == 0
    one = filter_audit.interactions(spark.createDataFrame([(1, "x", "s")], DOCS), spark.createDataFrame([], LABELS))
    assert one.count() == 600


def test_audit_takes_other_filters(spark):
    cells = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 0, 2, 0, 0)], "part string, mask int, docs long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["shapley"]) for r in filter_audit.audit(cells, "XYZ").collect()}
    assert len(got) == 18 and got["XYZ", 1] == (2, 5, 15) and got["XYZ", 2] == (2, 0, 15) and got["ZYX", 1] == (7, 0, 0)


# ---- periodic runs ----

def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            part = words[i - q:j]
            if len(part) >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i - q, len(part), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


@st.composite
def repetitive(draw):
    parts = draw(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
    return [c.encode() for p, k in parts for c in p * k]


@settings(max_examples=400, deadline=None)
@given(repetitive())
def test_runs_equal_plain_search(words):
    assert periodic.runs(words) == plain_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=90))
def test_runs_of_two_words(text):
    words = [c.encode() for c in text]
    assert periodic.runs(words) == plain_runs(words)


def test_runs_in_long_texts():
    same = [b"x"] * 300_000
    assert periodic.runs(same) == [(0, 300_000, 1)]
    period = [b"%d" % (i * i % 7919) for i in range(5_000)]
    assert periodic.runs([b"a", *period * 6, b"b"]) == [(1, 30_000, 5_000)]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 2_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    words = [c.encode() for c in fibonacci[-1]]
    assert periodic.runs(words) == plain_runs(words) == []
    nested = ([b"p"] * 6 + [b"q"]) * 40 + [b"p"] * 6
    assert periodic.runs(nested) == plain_runs(nested)


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_scan_equals_plain_version(spark, tmp_path):
    texts = ["", " \t\n", None, "a b a b a b a b", "x " * 50, "one two " * 7, "word", "é ü é ü é ü é ü é",
             " ".join(f"w{i * i % 31}" for i in range(400)), "a b c a b c a b c a b c d d d d d d", "l1 z\nl2 z\n" * 30]
    rows = [(i, texts[i % len(texts)]) for i in range(500)] + [(7, "x x x x x x"), (7, "x x x x x x"), (None, "y " * 9), (None, None)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, runs string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic(spark, str(tmp_path)).select(COLUMNS).collect()
    key = str
    assert sorted((tuple(r) for r in got), key=key) == sorted((plain_digest(*r) for r in rows), key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(500)) > 20
    listed = periodic.find_runs(docs.where("doc_id = 9")).first()["runs"]
    assert [tuple(r) for r in listed] == [(0, 12, 3), (12, 6, 1)]
    assert periodic.collapsed(docs.where("doc_id = 9")).first()["text"] == "a b c d"
    assert periodic.collapsed(docs.where("doc_id = 0")).first()["text"] == ""
    assert periodic.scan(docs.limit(0)).count() == 0


def test_runs_need_four_periods():
    with pytest.raises(ValueError):
        periodic.runs([b"a"] * 9, repeats=3)
