"""HTML extraction: attributes, forms, headers, and the vote of a host's pages against a plain count."""

from __future__ import annotations

from collections import defaultdict
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlelake.llm import html

P = "Some running text of an article that has several words in it. " * 4
TEXT = P.strip()


@pytest.mark.parametrize("page, want", [
    (f"<article title='The hidden side'><p>{P}</p></article>", TEXT),
    (f'<p data-x="hidden gems">{P}</p>', TEXT),
    (f"<div title='class=\"ad\"'>{P}</div>", TEXT),
    (f"<div data-class=ad aria-label='role=\"menu\"'>{P}</div>", TEXT),
    (f"<article><p>{P}</p></article><div id='cookie-notice' width='5'>We use cookies</div>", TEXT),
    (f"<div class='post' class='ad'>{P}</div>", TEXT),
    (f"<div><p>{P}</p><p CLASS = ad>buy</p><p hidden>not seen</p></div>", TEXT),
    (f"<form id='aspnetForm'><div id='content'><p>{P}</p></div><label>Name</label><input></form>", TEXT),
    (f"<form><article><h1>T</h1><p>{P}</p></article></form>", f"T\n\n{TEXT}"),
    (f"<article><header><h1>Title</h1><p>lead</p><nav>menu</nav></header><p>{P}</p></article>", f"Title\n\nlead\n\n{TEXT}"),
    (f"<body><header>Site</header><article><p>{P}</p><form>Subscribe now <input></form></article></body>", TEXT),
    (f"<form class='search'>find it <input></form><div><p>{P}</p></div>", TEXT),
    ("<form><label>Your name</label><input><label>Your mail</label><input>Send us a line</form>", ""),
    (f"<article>{P}<form id='comment-form'><p>{P}{P}{P}</p></form></article>", TEXT),
])
def test_attributes_forms_and_headers(page, want):
    assert html.main_text(page, None) == want


VALUE = st.one_of(st.sampled_from(["hidden", "class=ad", "The hidden side", "role='menu'", "display:none", "ad", "x > y", "a=b=c"]),
                  st.text(alphabet="abc hidden=class'/>", max_size=15))


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(["title", "data-x", "alt", "href", "width", "data-hidden", "data-class", "aria-label"]), VALUE,
       st.sampled_from(["article", "div", "p"]))
def test_values_of_other_attributes_change_nothing(name, value, tag):
    page = '<body><nav>menu</nav><{t}{a}>' + P + "</{t}><footer>foot</footer></body>"
    assert html.main_text(page.format(t=tag, a=f' {name}="{value}"'), None) == html.main_text(page.format(t=tag, a=""), None) == TEXT


class Boxes(HTMLParser):
    """A second reader for well-formed pages: the score of each container, by generalised path and number."""

    def __init__(self):
        super().__init__()
        self.open, self.own, self.n = [], defaultdict(float), 0

    def handle_starttag(self, tag, attrs):
        words = "".join(c for c in dict(attrs).get("class", "") if not c.isdigit()).lower().split()
        self.n += 1
        self.open.append((".".join([tag, *sorted(set(words))]), tag, self.n))

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if data.strip():
            boxes = [i for i, x in enumerate(self.open) if x[1] in html.CONTAINER]
            for i in boxes:
                path = "/".join(x[0] for x in self.open[:i + 1])
                self.own[path, self.open[i][2]] += len(data) if i == boxes[-1] else 0.9 * len(data)


def test_votes_equal_a_plain_count(spark):
    templates = ["<body><div class='story a{i}'><p>{p}</p></div><div class='side'>{s}</div></body>",
                 "<body><section class='x{i}'><div>{s}</div><div>{p}</div></section></body>"]
    pages = [(i, f"http://h{i % 2}.example/{i}", templates[i % 3 % 2].format(i=i, p=P[:100 + i], s="s" * (20 + i % 7)))
             for i in range(40)]
    want = defaultdict(lambda: [0, 0.0])
    for _, url, page in pages:
        reader = Boxes()
        reader.feed(page)
        best, by_path = max(reader.own.values()), {}
        for (path, _), score in reader.own.items():
            by_path[path] = max(score, by_path.get(path, 0.0))
        for path, score in by_path.items():
            cell = want[url[7:17], path]
            cell[0] += 1
            cell[1] += round((score / best) ** 4, 6)
    found = html.votes(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {(r["host"], r["path"]): (r["pages"], float(r["weight"])) for r in found.collect()}
    assert {k for k in got if k[1]} == set(want)
    for key, (count, weight) in want.items():
        assert got[key][0] == count and abs(got[key][1] - weight) < 1e-5, key


def test_every_template_with_its_share_wins(spark):
    """More templates than any fixed list would hold, each with the same weight."""
    rows = [(i * 30 + j, "http://h.example/", f"<body><div class='t{chr(97 + i)}'><p>{P}</p></div></body>")
            for i in range(12) for j in range(3)]
    found = html.winners(html.votes(spark.createDataFrame(rows, "page_id long, url string, html string")))
    paths = found.first()["paths"]
    assert sum(".t" in p for p in paths) == 12
    assert html.winners(html.votes(spark.createDataFrame(rows[:0], "page_id long, url string, html string"))).count() == 0
