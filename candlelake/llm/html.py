"""Main text of web pages by paths that the pages of a host agree on.

Three steps. Every page's containers are scored by how much running text they hold, and each names
its generalised path: tags with classes, digits removed. Spark sums the votes per host and path.
Each page is then read again from all its containers with the best-voted path. A host whose pages
agree on nothing, or a page without a winning path, falls back to its own best one.

What is read is not cut to these containers: from them the page is climbed as long as a parent adds
text, leaving out blocks made of links, so that a heading, a lead or further parts stay.
"""

from __future__ import annotations

import html
import re
from collections.abc import Container, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.session import settle

# Roles of tags, and class words of what is no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object select annotation annotation-xml".split())
ASIDE = frozenset("nav header footer aside form menu dialog button fieldset".split())
BLOCK = frozenset("address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
                  "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
                  "tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article main section div body td blockquote".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FRAME = frozenset(["article", "main"])
FORM = frozenset(["form", "fieldset"])
CONTROL = frozenset("button datalist input keygen label legend meter optgroup option output progress select textarea".split())
CHARS_PER_CONTROL = 40        # a form with less running text than this for each control is one to fill in
CLOSED_BY = {
    "p": BLOCK - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option"]), "head": frozenset(["body"]),
}
HIDDEN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget related share sharing social cookie "
    "cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "adsbygoogle pagination pager toolbar skip copyright legal".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
# with these a name is still that of a box: a whole name is made of boilerplate words and these
BOX_WORDS = frozenset(
    "area bar block bottom box btn button buttons col column container global group holder icon icons inner item items js left "
    "link links list main module outer panel primary right row secondary section site slot top unit widgets wrap wrapper zone".split())
COMMENT_BOX_WORDS = BOX_WORDS | frozenset("author body content form meta text thread title".split())
WRAPPERS = frozenset(["html", "body", "main", "article"])

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "step", "hidden", "comment", "children", "parent", "size", "links", "named", "form")

    def __init__(self, tag: str, step: str, hidden: bool, parent: "_Node | None"):
        self.tag, self.step, self.hidden, self.parent = tag, step, hidden, parent
        self.comment = False
        self.named = ""                       # hidden by nothing but a name: "class", or "id" for id or role
        self.form = False                     # hidden by nothing but being a form
        self.children: list["_Node | str"] = []
        self.size = self.links = 0            # visible characters, and those in links

    def path(self) -> str:
        steps, node = [], self
        while node is not None and node.parent is not None:
            steps.append(node.step)
            node = node.parent
        return "/".join(reversed(steps))


def _names(value: str, words: frozenset[str], others: frozenset[str]) -> bool:
    """Whether a name in ``value`` consists of ``words`` alone, or of them and ``others``."""
    for name in value.lower().split():
        parts = [p for p in (x.rstrip("0123456789") for x in re.split("[_-]+", name)) if p]
        if any(p in words for p in parts) and all(p in words or p in others for p in parts):
            return True
    return False


def attributes_of(attributes: str) -> dict[str, str]:
    """Names in lower case and values of a tag's attributes; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _describe(tag: str, attributes: str, parent: str) -> tuple[str, bool, bool, str, bool]:
    """The generalised path step, whether the element is no article text, whether readers wrote it,
    which attribute's name hides it if nothing else does, and whether only its being a form does.

    A name counts as a whole, and not for headings. A header directly in an article or main is part of it.
    """
    found = attributes_of(attributes) if attributes else {}
    words = sorted(set(re.sub(r"\d+", "", found.get("class", "")).lower().split()))
    style = found.get("style", "").replace(" ", "").lower()
    by_class, by_id = found.get("class", ""), f"{found.get('id', '')} {found.get('role', '')}"
    comment, named = False, ""
    if tag not in HEADING and (by_class or by_id != " "):
        comment = _names(f"{by_class} {by_id}", COMMENT_WORDS, HIDDEN_WORDS | COMMENT_BOX_WORDS)
        if tag not in WRAPPERS:
            named = "class" if _names(by_class, HIDDEN_WORDS, BOX_WORDS) else "id" if _names(by_id, HIDDEN_WORDS, BOX_WORDS) else ""
    unseen = (comment or ("hidden" in found) or found.get("aria-hidden", "").lower() == "true"
              or "display:none" in style or "visibility:hidden" in style)
    hidden = unseen or (tag in ASIDE and not (tag == "header" and parent in FRAME))
    form = tag in FORM and not unseen and not named
    return ".".join([tag, *words]), hidden or named != "", comment, "" if hidden else named, form


def parse(page: str | None) -> _Node:
    """A tree of elements and texts; unclosed and stray tags are put right, nothing is dropped but raw elements."""
    page = page or ""
    root = node = _Node("", "", False, None)
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            break
        if m.start() > at:
            node.children.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                node.children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up.parent is not None and up.tag != tag:
                if up.tag in ("article", "main", "body", "table") and tag not in BLOCK:
                    up = root
                    break
                up = up.parent
            if up.parent is not None:
                node = up.parent
            elif tag == "br":
                node.children.append(_Node("br", "br", False, node))
            continue
        while node.parent is not None and tag in CLOSED_BY.get(node.tag, ()):
            node = node.parent
        if tag in BLOCK and tag != "br":      # a block ends an open paragraph, also through open inline tags
            up = node
            while up.parent is not None and up.tag not in BLOCK:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in RAW:
            if not m[0].endswith("/>"):
                end = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        step, hidden, comment, named, form = _describe(tag, m[3], node.tag)
        child = _Node(tag, step, hidden, node)
        child.named, child.form = named, form
        child.comment = comment or node.comment
        if tag in ("article", "main") and not child.comment:      # a named frame around the article hides nothing
            up = node
            while up is not None:
                up.hidden = up.hidden and up.tag in ASIDE
                up = up.parent
        node.children.append(child)
        if tag not in VOID and not m[0].endswith("/>"):
            node = child
    if at < len(page):
        node.children.append(page[at:])
    return root


def blocks(top: _Node, left_out: Container[_Node] = ()) -> list[str]:
    """Visible text below ``top`` in page order, one string per block, references decoded."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip()
        line.clear()
        if text:
            out.append(text)

    stack: list[tuple[_Node, int]] = [(top, 0)]
    while stack:
        node, i = stack.pop()
        if i == 0 and node.tag in BLOCK:
            line.append(" ") if node.tag == "br" else flush()
        while i < len(node.children):
            child = node.children[i]
            i += 1
            if isinstance(child, str):
                line.append(child)
            elif not child.hidden and child not in left_out:
                stack.append((node, i))
                stack.append((child, 0))
                break
        else:
            if node.tag in BLOCK and node.tag != "br":
                flush()
    flush()
    return out


def lift_forms(root: _Node) -> None:
    """Shows forms around the page's text, and hides their controls instead.

    A form stays hidden unless it holds most of the page's running text, and more of it than its controls explain.
    """
    order: list[_Node] = []
    text: dict[_Node, int] = {}
    controls: dict[_Node, int] = {}
    stack, any_form = [root], False
    while stack:
        node = stack.pop()
        if node.hidden and not node.form and not node.named:
            continue
        order.append(node)
        any_form = any_form or node.form
        stack += [c for c in node.children if not isinstance(c, str)]
    if not any_form:
        return
    for node in reversed(order):
        if node.tag in CONTROL:
            text[node], controls[node] = 0, 1
        else:
            own = sum(len(c) for c in node.children if isinstance(c, str) and c.strip())
            text[node] = -own if node.tag == "a" else text.get(node, 0) + own
        if node.parent is not None:
            text[node.parent] = text.get(node.parent, 0) + text[node]
            controls[node.parent] = controls.get(node.parent, 0) + controls.get(node, 0)
    lifted = set()
    for node in order:
        if node.form and 2 * text[node] > text[root] > 0 and text[node] >= CHARS_PER_CONTROL * controls.get(node, 0):
            node.hidden = False
            lifted.add(node)
        elif node.parent in lifted:
            lifted.add(node)
            node.hidden = node.hidden or node.tag in CONTROL


def lift_names(root: _Node, paths: list[str] | None = None) -> None:
    """Shows containers that only a name hides, where they hold most of the page's running text, or where
    the host's winning paths lead through them. Comments and what tags or styles hide stay hidden, and
    so do names on a page whose text is marked by an article or main outside them."""
    order: list[tuple[_Node, int]] = []
    text: dict[_Node, int] = {}
    stack = [root]
    any_named = marked = False
    while stack:
        node = stack.pop()
        if node.hidden and not node.named:
            continue
        order.append((node, sum(len(c) for c in node.children if isinstance(c, str) and c.strip())))
        any_named = any_named or node.named != ""
        marked = marked or (node.tag in FRAME and not node.comment)
        stack += [c for c in node.children if not isinstance(c, str)]
    if not any_named or marked:
        return
    for node, own in reversed(order):
        text[node] = -own if node.tag == "a" else text.get(node, 0) + own
        if node.parent is not None:
            text[node.parent] = text.get(node.parent, 0) + text[node]
    for node, _ in order:
        if node.hidden and node.tag in CONTAINER and (
                2 * text[node] > text[root] > 0
                or (node.named == "class" and paths is not None and any(f"{p}/".startswith(f"{node.path()}/") for p in paths))):
            node.hidden = False


def containers(root: _Node) -> list[tuple[_Node, float]]:
    """Every visible container with its score: own running text, and that of its blocks' parents' children.

    A paragraph counts by its length for its nearest container, and links count against it. What a
    container's own containers hold counts for it at 0.9, so that the innermost one that holds
    everything wins.
    """
    scores: list[tuple[_Node, float]] = []
    stack: list[list] = [[root, 0, 0.0, 0.0]]          # node, next child, own text, text of containers inside
    while stack:
        top = stack[-1]
        node = top[0]
        if top[1] < len(node.children):
            child = node.children[top[1]]
            top[1] += 1
            if isinstance(child, str):
                size = len(child) if child.strip() else 0
                top[2] += size * (-1.0 if node.tag == "a" else 1.0)
            elif not child.hidden:
                stack.append([child, 0, 0.0, 0.0])
            continue
        stack.pop()
        if node.tag in CONTAINER or node.parent is None:
            value = top[2] + 0.9 * top[3] + (0.02 * (top[2] + top[3]) if node.tag in ("article", "main") else 0.0)
            if value > 0:
                scores.append((node, value))
            if stack:
                stack[-1][3] += top[2] + top[3]
        elif stack:
            stack[-1][2] += top[2]
            stack[-1][3] += top[3]
    return scores


def host_of(url: str) -> F.Column:
    """Host of a URL column in lower case; null where there is none."""
    found = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def votes(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns ``host``, ``path``, ``pages``, ``weight``: how often a path holds a page's best container.

    A page votes for its best container with weight 1, and for each other one in proportion to its score.
    Votes are summed on the map side, so a host with most of the pages sends a few rows per task.
    """
    @F.pandas_udf("array<struct<path: string, weight: double>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            rows = []
            for text in texts:
                best: dict[str, float] = {}
                root = parse(text)
                lift_forms(root)
                lift_names(root)
                for node, score in containers(root):
                    path = node.path()
                    best[path] = max(score, best.get(path, 0.0))
                most = max(best.values(), default=1.0)
                rows.append([{"path": p, "weight": round((s / most) ** 4, 6)} for p, s in best.items()])
            yield pd.Series(rows)

    return (pages.select(host_of(url_col).alias("host"), F.explode(run(html_col)).alias("v"))
            .groupBy("host", F.col("v.path").alias("path"))
            .agg(F.count("*").alias("pages"), F.sum(F.col("v.weight").cast("decimal(18,6)")).alias("weight")))


def winners(found: DataFrame, share: float = 0.1, least: float = 0.0001) -> DataFrame:
    """Per host an ordered list ``paths``: all with ``share`` of the best weight and ``least`` of the host's sum.

    The list is a preference order, and pages that match none of it use their own best container. It has no
    more than ``1 / least`` entries, since that many shares make up the whole. Hosts without a name, and a
    null ``host``, are one host with an empty name here.
    """
    found = settle(found.select(F.coalesce("host", F.lit("")).alias("host"), "path", "weight"), "html-votes")
    by_host = found.groupBy("host").agg(F.max("weight").alias("best"), F.sum("weight").alias("sum"))
    top = found.join(by_host, "host").where((F.col("weight") >= share * F.col("best")) & (F.col("weight") >= least * F.col("sum")))
    order = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("less"), "path")))
    return top.groupBy("host").agg(order.alias("t")).select("host", F.transform("t", lambda x: x["path"]).alias("paths"))


def measure(root: _Node) -> None:
    """Sets ``size`` and ``links`` of every visible element."""
    stack: list[list] = [[root, 0, False]]             # node, next child, inside a link
    while stack:
        node, i, linked = top = stack[-1]
        if i == len(node.children):
            stack.pop()
            if stack:
                stack[-1][0].size += node.size
                stack[-1][0].links += node.links
            continue
        top[1] += 1
        child = node.children[i]
        if isinstance(child, str):
            size = len(child) if child.strip() else 0
            node.size += size
            node.links += size if linked else 0
        elif not child.hidden:
            child.size = child.links = 0
            stack.append([child, 0, linked or child.tag == "a"])


def _link_block(node: _Node) -> bool:
    """Whether an element is a list or box of links; headings, paragraphs and inline elements are none."""
    return (node.tag in CONTAINER or node.tag in ("ul", "ol", "dl", "menu", "table")) and node.size > 0 and 2 * node.links >= node.size


def choose(root: _Node, paths: list[str] | None) -> list[_Node]:
    """The containers to start from: all of the best-voted path that this page has, in page order."""
    scored = containers(root)
    for path in paths if paths is not None else ():
        fitting = {id(x[0]) for x in scored if x[0].path() == path}
        if fitting:
            return _in_order(root, fitting)
    return [max(scored, key=lambda x: x[1])[0]] if scored else []


def _in_order(root: _Node, wanted: set[int]) -> list[_Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) in wanted:
            out.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def _up(node: _Node) -> list[_Node]:
    """The element and what it lies in, from the inside out."""
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def extent(found: list[_Node]) -> tuple[_Node, set[_Node]]:
    """The element to read, and the elements in it to leave out, when the text starts from ``found``.

    An article or main around it is the author's own bound: everything in an article is read, boxes of
    links beside it in main are not, and of what lies outside, headings and what holds a tenth of the
    text or more. Without such a bound the climb ends with the first parent that holds a box of links.
    """
    chains = [_up(node) for node in found]
    inside = {node for chain in chains for node in chain}
    line = [node for node in chains[0] if all(node in set(chain) for chain in chains[1:])] if len(found) > 1 else chains[0]
    least = 0.1 * sum(node.size - node.links for node in found)
    framed = any(node.tag in FRAME for node in inside)
    article = max((i for i, node in enumerate(line) if node.tag == "article"), default=-1)
    frame = max((i for i, node in enumerate(line) if node.tag in FRAME), default=-1)
    left_out: set[_Node] = set()

    def away(child: _Node, in_article: bool, in_frame: bool) -> bool:
        if in_article or child.tag in HEADING:
            return False
        return _link_block(child) or (framed and not in_frame and child.size - child.links < least)

    def beside(node: _Node) -> list[_Node]:
        return [c for c in node.children if not isinstance(c, str) and not c.hidden and c.size and c not in inside]

    # between the containers and the innermost element around them all
    ends = set(found)
    queue = [(line[0], article >= 0, frame >= 0)] if len(found) > 1 else []
    while queue:
        node, in_article, in_frame = queue.pop()
        left_out.update(c for c in beside(node) if away(c, in_article, in_frame))
        queue += [(c, in_article or c.tag == "article", in_frame or c.tag in FRAME)
                  for c in node.children if c in inside and c not in ends]

    top = line[0]
    for i, parent in enumerate(line[1:], 1):
        others = beside(parent)
        out = [c for c in others if away(c, i <= article, i <= frame)]
        loose = (i <= frame or not framed) and any(isinstance(c, str) and c.strip() for c in parent.children)
        if loose or len(out) < len(others):
            top = parent
            left_out.update(out)
        if out and not framed:
            break
    return top, left_out


def main_text(page: str | None, paths: list[str] | None) -> str:
    root = parse(page)
    lift_forms(root)
    lift_names(root, paths)
    found = choose(root, paths)
    if not found:
        return ""
    measure(root)
    return "\n\n".join(blocks(*extent(found)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            found: DataFrame | None = None) -> DataFrame:
    """Columns ``id_col``, ``url_col``, ``text``, ``n_chars``, one row per row of ``pages``.

    Pages without a host vote together; null pages count as empty, and an empty page has an empty text.
    Repeated rows stay repeated. Columns besides the three named are left out. The table of winning
    paths has one short row per host and is written first, so that Spark knows its size: it is broadcast
    only below the session's limit, and the pages are shuffled only above it.
    """
    best = settle(winners(found if found is not None else votes(pages, id_col, url_col, html_col)), "html-paths")

    @F.pandas_udf("string")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, paths in parts:
            yield pd.Series([main_text(t, p) for t, p in zip(texts, paths)], dtype=object)

    own = pages.select(id_col, url_col, html_col, F.coalesce(host_of(url_col), F.lit("")).alias("_host"))
    best = best.select(F.col("host").alias("_host"), F.col("paths").alias("_paths"))
    read = own.join(best, "_host", "left").select(id_col, url_col, run(html_col, "_paths").alias("text"))
    return read.withColumn("n_chars", F.length("text").cast("long"))
