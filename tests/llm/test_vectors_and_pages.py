"""Vector searches and page extraction against plain versions, and on odd tables."""

from __future__ import annotations

import numpy as np
import pytest

from candlelake.llm import forest, html, topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int, part int"


def vectors(spark, n=1200, size=12, seed=0):
    rng = np.random.default_rng(seed)
    points = rng.standard_normal((n, size)).astype(np.float32)
    points[50:90] = points[50]                                     # ties
    rows = [(i, [float(x) for x in p], 0, "x", 1, 2) for i, p in enumerate(points)]
    nan, inf = float("nan"), float("inf")
    odd = [(100_000, None), (100_100, []), (100_200, [1.0] * 11 + [None]), (100_300, [nan] * size), (100_400, [inf] * size),
           (None, [1.0] * size), (100_500, [1.0] * (size - 1)), (100_600, [0.0] * size)]
    odd = [(i, v, None, None, None, None) for i, v in odd]
    return points, spark.createDataFrame(rows + odd, SCHEMA)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS", 100)
    points, df = vectors(spark)
    whole = np.floor(256 * points.astype(np.float64))
    got = {}
    for r in topk.top_k(df, "vec_id", "embedding", k=5, every=50).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids = list(range(len(points))) + [100_600]
    whole = np.vstack([whole, np.zeros((1, whole.shape[1]))])
    assert set(got) == {i for i in ids if i % 50 == 0}
    for n, q in enumerate(ids):
        if q % 50 == 0:
            scores = whole @ whole[n]
            order = sorted((-int(s), i) for s, i in zip(scores, ids) if i != q)[:5]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(order)]


def test_far_annuli_are_not_opened(spark, monkeypatch):
    """On clustered vectors most pairs of annuli and blocks of queries fall to the bounds; results stay exact."""
    monkeypatch.setattr(topk, "ANNULUS", 50)
    monkeypatch.setattr(topk, "QUERIES", 10)
    monkeypatch.setattr(topk, "FIRST", 1)
    counts, settled = {}, topk.settle

    def counted(df, name):
        out = settled(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(topk, "settle", counted)
    blocks = topk.blocks

    def packed(*args, **kwargs):
        out = blocks(*args, **kwargs)
        counts["annuli"] = out.count()
        return out

    monkeypatch.setattr(topk, "blocks", packed)
    rng = np.random.default_rng(5)
    middle = rng.standard_normal((20, 12))
    middle *= 10 / np.linalg.norm(middle, axis=1, keepdims=True)
    points = (middle[rng.integers(0, 20, 4_000)] + rng.standard_normal((4_000, 12)) / 20).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id long, embedding array<float>")
    got = {}
    for r in topk.top_k(df, "vec_id", "embedding", k=5, every=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = np.floor(256 * points.astype(np.float64))
    for q in range(0, 4_000, 20):
        scores = whole @ whole[q]
        order = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(order)]
    blocks_of_queries = counts["queries"] // 2
    opened, every_pair = counts["early"] + counts["late"], counts["annuli"] * blocks_of_queries
    print("opened", opened, "of", every_pair)
    assert opened < 0.4 * every_pair


def test_forest_recall_and_scores(spark):
    points, df = vectors(spark, 3_000, 24, 1)
    got = {}
    for r in forest.nearest(df, "vec_id", "embedding", k=10, every=100, block=1_000, candidates=900).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 3_000, 100):
        apart = np.sqrt(((points.astype(np.float64) - points[q].astype(np.float64)) ** 2).sum(axis=1))
        order = sorted((d, i) for i, d in enumerate(apart) if i != q)[:10]
        found = sorted(got[q])
        assert [k for k, _, _ in found] == list(range(1, 11)) and all(s == apart[i] for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in order})
    assert hits >= 0.9 * 300 and set(got) == set(range(0, 3_000, 100))


@pytest.mark.parametrize("search", [
    lambda d: topk.top_k(d, "vec_id", "embedding"), lambda d: forest.nearest(d, "vec_id", "embedding")])
def test_small_and_empty_tables(spark, search):
    _, df = vectors(spark)
    assert search(df.where("false")).count() == 0
    assert search(df.where("vec_id = 0")).count() == 0                # a query without candidates
    few = search(df.where("vec_id IN (0, 1, 2)").unionByName(df.where("vec_id = 1")))
    assert [(r["query_id"], r["vec_id"]) for r in few.orderBy("rank").collect() if r["vec_id"] == 1] == [(0, 1), (0, 1)]
    assert search(df.where("vec_id >= 100000 AND vec_id < 100600")).count() in (0, 1)


def test_sorted_strings_ascend_in_step():
    rng = np.random.default_rng(3)
    points = rng.standard_normal((500, 16))
    planes = forest.Planes(points, trees=5, bits=12)
    tree = forest.Forest(planes, np.arange(500), points)
    low, high = tree.ranges(points[:20], 60)
    strings = planes.strings(points)
    for q in range(20):
        for drop in range(13):
            same = [np.flatnonzero(strings[t] >> drop == strings[t, q] >> drop) for t in range(5)]
            if sum(map(len, same)) >= 60:
                break
        for t in range(5):
            assert sorted(tree.order[t, low[q, t]:high[q, t]]) == same[t].tolist()


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x = "</p><article>no</article>";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></ul></nav><div class="cookie-notice">cookies</div>
<div id="wrap"><div class="post post-17"><h1>Title &amp; more</h1><p>First  <b>bold</b>
text&nbsp;here<p>Second <i>one</i> with <a href="x">a link</a>, long enough to count for the page.<!-- c --><br>after</p>
<form><input> search</form><div class="ad-slot">buy</div></div><aside>side</aside>
<div class="comments"><article class="comment">A reader wrote a very long comment, longer than anything else on this page by far,
again and again and again, so that it would win by length alone.</article></div></div><footer>foot</footer>"""
WANT = "Title & more\n\nFirst bold text here\n\nSecond one with a link, long enough to count for the page. after"


def test_main_text():
    assert html.main_text(PAGE, None) == WANT
    assert html.main_text("<body><article>kept</article><p>other text that is much longer than that", ["html/body"]) != ""


def test_pages_of_a_host_agree(spark):
    odd = PAGE.replace("long enough to count for the page", "x").replace('class="post post-17"', 'class="post post-3"')
    rows = [(i, f"https://h.example/{i}", PAGE, 1, "x") for i in range(6)] + [
        (6, "https://h.example/odd", odd, 1, "x"), (7, None, PAGE, 1, "x"), (8, "https://e.example/", None, 1, "x"),
        (9, "nonsense", "", 1, "x"), (None, "https://h.example/1", "plain", 1, "x"), (0, "https://h.example/0", PAGE, 1, "x"),
        (10, "https://l.example/", "<p>" + "long &lt; " * 50_000, 1, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int, _host string")
    out = html.extract(pages).collect()
    assert len(out) == len(rows)
    got = {r["page_id"]: r for r in out}
    assert all(got[i]["text"] == WANT and got[i]["n_chars"] == len(WANT) for i in (*range(6), 7))
    assert got[6]["text"].startswith("Title & more")
    assert got[8]["text"] == got[9]["text"] == "" and got[8]["n_chars"] == 0 and got[None]["text"] == "plain"
    assert got[10]["n_chars"] == len("long < " * 50_000) - 1
    best = {r["host"]: r["paths"] for r in html.winners(html.votes(pages)).collect()}
    assert best["h.example"][0] == "html/body.home/div/div.post.post-"
    assert html.extract(pages.where("false")).count() == 0


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_all_parts_of_an_article_are_read(spark):
    long, one, two, three = words("long", 200), words("one", 30), words("two", 30), words("three", 30)
    links = "<div><ul><li><a href='/a'>some link</a><li><a href='/b'>another link</a></ul></div>"
    nested = f"<article><h1>T</h1><p>lead</p><div class=content><p>{long}</p></div><section><p>{one}</p></section></article>"
    for page, want in (
            (f"<html><body>{nested}{links}<div>tag line</div></body></html>", ["T", "lead", long, one]),
            (f"<html><body><h1>T</h1><main><div><p>{long}</p></div></main>{links}<div>x</div></body></html>", ["T", long]),
            (f"<html><body><h2><a href='/t'>T</a></h2><div class=c><p>{long}</p></div>{links}</body></html>", ["T", long]),
            (f"<html><body><div><div>{links}</div><div><p>{one}</p></div></div></body></html>", [one]),
            (f"<html><body><article><p>{one}</p></article><article class=b><p>{two}</p></article></body></html>", [one, two])):
        assert html.main_text(page, None).split("\n\n") == want, page
    # most pages of the host have one long section; one has three equal ones, another its text in several articles
    body = "<html><body>{}" + links + "</body></html>"
    usual = body.format(f"<section><p>{long}</p></section>")
    parts = body.format("".join(f"<section><p>{x}</p></section>" for x in (one, two, three)))
    mixed = body.format(f"<section><p>{one}</p></section><div class=b><p>{long}</p></div>")
    pages = spark.createDataFrame([(i, f"https://h.example/{i}", h) for i, h in enumerate([usual] * 8 + [parts, mixed])],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n\n") for r in html.extract(pages).collect()}
    assert got == {**{i: [long] for i in range(8)}, 8: [one, two, three], 9: [one, long]}


def test_names_hide_only_what_they_name(spark):
    long, one = words("long", 100), words("one", 20)
    for page, want in (
            (f"<body><div class='content has-sidebar'><p>{long}</p></div></body>", [long]),
            (f"<body><div class='no-nav'><p>{long}</p></div></body>", [long]),
            (f"<body><div class='content sidebar'><p>{long}</p></div><div><p>{one}</p></div></body>", [long, one]),
            (f"<article><p>{long}</p><section id='discussion'><p>{one}</p></section></article>", [long, one]),
            (f"<section id='discussion'><article><p>{long}</p></article></section>", [long]),
            (f"<article><h2 id='related-work'>A</h2><p>{long}</p><h2 id='notice'>B</h2><p class='notice-period'>{one}</p>"
             "<div class='share-price'>5</div><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p></article>",
             ["A", long, "B", one, "5", "so x=1"]),
            (f"<body><p>{long}</p><div class='site-footer'>x</div><div id='comments-area'><p>{one}</p></div>"
             "<div class='sidebar-right'>x</div><div class='ad_slot2'>x</div><ul class='nav-links'><li>x</ul></body>", [long])):
        assert html.main_text(page, None).split("\n\n") == want, page
    wrapped = "<html><body><div class='layout-1 sidebar'><p>{}</p></div><div><p>" + one + "</p></div></body></html>"
    pages = [wrapped.format(long)] * 6 + [wrapped.format("short")]
    pages = spark.createDataFrame([(i, f"https://h.example/{i}", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert got[6] == f"short\n\n{one}" and got[0] == f"{long}\n\n{one}"


def test_top_k_of_an_id_with_different_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS", 50)
    points, _ = vectors(spark, 600, 4)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)] + [(0, [50.0, 0.0, 0.0, 1.0])]
    rows[0] = 0, [1.0, 0.0, 0.0, 0.0]                              # the query: its bound is far below the other row's
    rows += [(1001 + 50 * (i // 49) + i % 49, [50.0, 0.0, 0.0, 0.001 * i]) for i in range(300)]
    ids = np.array([i for i, _ in rows])
    whole = np.floor(256 * np.array([v for _, v in rows], np.float32).astype(np.float64))
    got = {}
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in (0, 100):
        own = min(whole[ids == q].tolist())
        order = sorted((-int(s), int(i)) for s, i in zip(whole @ np.array(own), ids) if i != q)[:5]
        assert sorted(got.get(q, [])) == [(k + 1, i, -s) for k, (s, i) in enumerate(order)]
