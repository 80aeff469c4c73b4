"""Secrets in texts: three plain patterns, and strings of high local entropy.

A candidate string is a long run of token characters. For each character class that covers it, a
window slides over the string and its Shannon entropy is kept by incremental counts: a step
changes two counts, so a string costs time in proportion to its length. Windows above the class's
threshold are joined to one span. The shortest window is no longer than the shortest candidate, so
every candidate is measured. Strings on the allow list are left out; a placeholder is left out with
the part between separators that it stands in, and what stands beside it is measured.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, in their order.
ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST_VALUE = 6
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

# What looks random but is no secret.
ALLOWED = (
    r"[A-Z]?[a-z]+|[A-Z]+",                                                      # a long word
    r"[a-z]*(?:[A-Z]+[a-z]{2,})+[A-Z]*\d{0,4}",                                  # a name of joined words
    r"[A-Z]?[a-z]+(?:[_/-][A-Z]?[a-z]+)+",                                       # words joined to a name or path
    r"(?:[A-Z][a-z]+)+\d{0,4}",                                                  # a name in camel case
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",    # a UUID
    r"[\d/_=+-]+",                                                               # numbers, dates, rules
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",                                 # a key printed in many manuals
)
PLACEHOLDER = re.compile(r"EXAMPLE|example|xxxx|XXXX|0123456789|abcdefgh")
PART = re.compile(r"[A-Za-z0-9]+")
#: Parts of names, paths and slugs: words, numbers, ordinals, versions.
WORDY = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[a-z]*(?:[A-Z]+[a-z]{2,})+[A-Z]*\d{0,4}|\d+(?:st|nd|rd|th)?|v\d+")


@dataclass(frozen=True)
class CharacterClass:
    """Strings made of ``pattern`` are random where ``window`` characters reach ``bits`` of entropy."""

    name: str
    pattern: str
    window: int
    bits: float


CLASSES = (
    CharacterClass("hex", r"[0-9a-f]+|[0-9A-F]+", 20, 2.9),
    CharacterClass("alnum", r"[A-Za-z0-9]+", 20, 3.6),
    CharacterClass("base64", r"[A-Za-z0-9+/_=-]+", 24, 3.9),
    CharacterClass("base64-short", r"[A-Za-z0-9+/_=-]+", 20, 3.7),
)


class Scanner:
    """Finds spans (kind, start, end) in one text; offsets are code points, ends exclusive."""

    def __init__(self, classes=CLASSES, allowed=ALLOWED):
        self.classes = [(c, re.compile(c.pattern)) for c in classes]
        self.allowed = [re.compile(a, re.S) for a in allowed]
        longest = max((c.window for c in classes), default=1)
        self.terms = [0.0] + [n * math.log2(n) for n in range(1, longest + 1)]

    def windows(self, text: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
        """Joined windows of at least ``bits`` of entropy: H = log2(w) - sum(n log2 n) / w."""
        if len(text) < window:
            return
        most, terms = (math.log2(window) - bits) * window + 1e-9, self.terms
        counts: dict[str, int] = {}
        total, begun, end = 0.0, None, 0
        for i, c in enumerate(text):
            if i >= window:       # the old character leaves first, so no count exceeds the window
                old = text[i - window]
                n = counts[old]
                counts[old] = n - 1
                total += terms[n - 1] - terms[n]
            n = counts.get(c, 0)
            counts[c] = n + 1
            total += terms[n + 1] - terms[n]
            if i >= window - 1 and total <= most:
                if begun is not None and i - window + 1 > end:
                    yield begun, end
                    begun = None
                if begun is None:
                    begun = i - window + 1
                end = i + 1
        if begun is not None:
            yield begun, end

    def entropy(self, text: str) -> list[tuple[int, int]]:
        """Spans of high entropy in any class, joined where they overlap or touch."""
        found: list[tuple[int, int]] = []
        for run in CANDIDATE.finditer(text):
            if self._harmless(run.group()):
                continue
            spans = sorted((run.start() + part.start() + a, run.start() + part.start() + b)
                           for kind, pattern in self.classes for part in self._stretches(pattern, run.group())
                           if not self._harmless(part.group())
                           for a, b in self.windows(part.group(), kind.window, kind.bits)
                           if not self._words(part.group()[a:b]))
            for a, b in spans:
                if found and a <= found[-1][1]:
                    found[-1] = found[-1][0], max(b, found[-1][1])
                else:
                    found.append((a, b))
        return found

    def _stretches(self, pattern: re.Pattern, run: str) -> Iterator[re.Match]:
        """Matches of ``pattern`` in ``run``, none of them across a part with a placeholder."""
        at = 0
        if PLACEHOLDER.search(run):
            for part in PART.finditer(run):
                if PLACEHOLDER.search(part.group()):
                    yield from pattern.finditer(run, at, part.start())
                    at = part.end()
        yield from pattern.finditer(run, at)

    def _words(self, value: str) -> bool:
        """Whether there are several parts between separators, and all are words or numbers."""
        parts = PART.findall(value)
        return len(parts) > 1 and all(map(WORDY.fullmatch, parts))

    def _harmless(self, value: str) -> bool:
        return any(a.fullmatch(value) for a in self.allowed)

    def base(self, text: str) -> list[tuple[str, int, int]]:
        """Matches of the base patterns, by start and then kind."""
        found = [("hex", *m.span()) for m in HEX.finditer(text)]
        if "=" in text or ":" in text:
            found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= SHORTEST_VALUE]
        if "AKIA" in text:
            found += [("access", *m.span()) for m in ACCESS.finditer(text)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))

    def scan(self, text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans, and all spans. A null text counts as empty.

        An entropy span that lies inside a base span says nothing new and is left out.
        """
        text = text or ""
        base = self.base(text)
        more = [("entropy", a, b) for a, b in self.entropy(text)
                if not any(x <= a and b <= y for _, x, y in base)]
        return base, sorted([*base, *more], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         classes=CLASSES, allowed=ALLOWED) -> DataFrame:
    """One row per row of ``docs``: counts of the kinds, ``base_sha256`` and ``spans``.

    Texts are read whole; null texts count as empty and have no spans; repeated rows stay repeated.
    Columns of ``docs`` besides the two named are left out, so their names cannot clash. No shuffle.
    """
    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(classes, allowed)
        for texts in parts:
            rows = []
            for text in texts:
                base, spans = scanner.scan(text)
                kinds = [kind for kind, _, _ in spans]
                rows.append([*map(kinds.count, KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(),
                             _joined(spans)])
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"])

    return docs.select(id_col, run(text_col).alias("r")).select(id_col, "r.*")


def redact(docs: DataFrame, text_col: str = "text", classes=CLASSES, allowed=ALLOWED,
           count_col: str | None = None) -> DataFrame:
    """``docs`` with every found span of ``text_col`` replaced by ``<kind>``.

    Of overlapping spans the first names the replacement, which covers them all. Where a span was
    replaced, ``count_col`` becomes the new number of characters, if there is such a column. Null texts
    stay null, and all other columns and rows stay as they are.
    """
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(classes, allowed)

        def clean(text: str) -> str:
            out, at = [], 0
            for kind, a, b in scanner.scan(text)[1]:
                if a >= at:
                    out += [text[at:a], f"<{kind}>"]
                at = max(at, b)
            return "".join([*out, text[at:]])

        for texts in parts:
            yield texts.map(clean, na_action="ignore").astype(object)

    if count_col not in docs.columns:
        return docs.withColumn(text_col, run(F.col(text_col)))
    # the row in one column: no name of ``docs`` can clash with the new text's
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), run(F.col(text_col)).alias("new"))
    row, new = F.col("row"), F.col("new")
    size = F.when(new != row[text_col], F.length(new)).otherwise(row[count_col])
    kind = docs.schema[count_col].dataType
    return marked.select(*[new.alias(c) if c == text_col else
                           size.cast(kind).alias(c) if c == count_col else row[c].alias(c) for c in docs.columns])
