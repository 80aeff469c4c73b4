"""Licence notices in texts by the Dice coefficient over word bigrams.

Texts are cut into lines, and each line and each whole text is normalised and compared with licence
templates. Two bigram sets of sizes a and b can reach a coefficient t only if t/(2-t) <= a/b <=
(2-t)/t, so every template is listed under the sizes it can match, and units meet their candidate
templates in an equi-join on size. These rows are the ones of the SQL.

Notices inside a line, notices wrapped over lines, and whole licence texts are found by windows of
words. A window that reaches t shares at least t/(2-t) of the template's bigrams, so windows are
tried only where so many of them lie within the template's largest size; all others cannot reach t.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Short notices of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def normal_words(text: Column) -> Column:
    """Words of a text as licence matching sees them: letters and digits in lower case, one spelling."""
    plain = F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")
    return F.filter(F.split(F.regexp_replace(plain, "licence", "license"), " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """All neighbouring word pairs, repeats included."""
    return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Numbers of bigrams that can reach the threshold against ``size`` of them."""
    return math.ceil(threshold / (2 - threshold) * size - 1e-9), math.floor((2 - threshold) / threshold * size + 1e-9)


def templates(spark, notices=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per template and matching size: ``size``, ``license``, ``template``, ``t_size``, ``t_grams``."""
    given = spark.createDataFrame([(n, name, text) for n, (name, text) in enumerate(notices)],
                                  "template int, license string, text string")
    found = given.select("template", "license", normal_words(F.col("text")).alias("w")).where(F.size("w") > 1)
    found = [r.asDict() for r in found.select("template", "license", bigrams(F.col("w")).alias("g")).collect()]
    rows = []
    for r in found:
        low, high = size_bounds(len(r["g"]), threshold)
        rows += [(size, r["license"], r["template"], len(r["g"]), r["g"]) for size in range(max(1, low), high + 1)]
    return spark.createDataFrame(rows, "size int, license string, template int, t_size int, t_grams array<string>")


def texts() -> tuple[tuple[str, str], ...]:
    """Whole licence texts, by name, from the files of the package."""
    files = sorted(resources.files("candlelake.llm").joinpath("texts").iterdir(), key=lambda f: f.name)
    return tuple((f.name, f.read_text(encoding="utf-8")) for f in files)


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower().replace("licence", "license"))


class Windows:
    """Finds the best windows of words for each template in one text."""

    def __init__(self, notices, whole, threshold: float):
        self.threshold = threshold
        self.listed, self.short = [], len(notices)
        self.having: dict[tuple[str, str], list[int]] = {}
        for n, (name, text) in enumerate((*notices, *whole)):
            words = _words(text)
            grams = Counter(zip(words, words[1:]))
            size = sum(grams.values())
            least = math.ceil(threshold / (2 - threshold) * size - 1e-9)
            self.listed.append((name, n, size, grams, least, size_bounds(size, threshold)[1]))
            for g in grams:
                self.having.setdefault(g, []).append(n)

    def dice(self, words: list[str], template: int) -> float:
        _, _, size, grams, _, _ = self.listed[template]
        own = Counter(zip(words, words[1:]))
        total = max(len(words) - 1, 0) + size
        return round(2.0 * sum(min(n, own[g]) for g, n in grams.items() if g in own) / total, 6) if total else 0.0

    def best(self, at: list[int], keys: list[tuple[str, str]], template: int) -> list[tuple[float, int, int]]:
        """Disjoint windows (dice, first and last bigram) at or above the threshold, the best ones first.

        A best window begins and ends with a bigram of the template."""
        _, _, size, grams, least, most = self.listed[template]
        pos = np.array(at)
        if least < 1 or len(pos) < least:
            return []
        starts = np.flatnonzero(pos[least - 1:] - pos[:len(pos) - least + 1] < most)
        if not len(starts):
            return []
        seen: dict[tuple[str, str], list[int]] = {}
        before = np.empty(len(pos), dtype=np.int64)          # a bigram counts in windows that begin after this one
        for k, g in enumerate(keys):
            own = seen.setdefault(g, [])
            before[k] = own[-grams[g]] if len(own) >= grams[g] else -1
            own.append(k)
        found = []
        for k in starts.tolist():
            end = int(np.searchsorted(pos, pos[k] + most))
            scores = 2.0 * np.cumsum(before[k:end] < k) / (pos[k:end] - pos[k] + 1 + size)
            j = int(scores.argmax())
            if round(float(scores[j]), 6) >= self.threshold:
                found.append((round(float(scores[j]), 6), at[k], at[k + j]))
        return _disjoint(sorted(found, key=lambda x: (-x[0], x[1], x[2])))

    def find(self, text: str) -> list[dict]:
        """Windows that no line, whole text or licence text that was found covers in part."""
        lines = [_words(x) for x in text.split("\n")]
        words = [w for line in lines for w in line]
        hits: dict[int, tuple[list[int], list[tuple[str, str]]]] = {}
        having = self.having
        for i, g in enumerate(zip(words, words[1:])):
            if g in having:
                for n in having[g]:
                    at, keys = hits.setdefault(n, ([], []))
                    at.append(i)
                    keys.append(g)
        found = [(n, *w) for n, (at, keys) in sorted(hits.items()) for w in self.best(at, keys, n)]
        if not found:
            return []
        line_of = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
        taken: dict[int, bool] = {}

        def in_found_line(a: int, b: int) -> bool:
            for k in range(line_of[a], line_of[b + 1] + 1):
                if k not in taken:
                    taken[k] = any(self.dice(lines[k], n) >= self.threshold for n in range(self.short))
                if taken[k]:
                    return True
            return False

        longest = max((self.listed[n][5] for n in range(self.short)), default=0)
        if len(lines) > 1 and len(words) - 1 <= longest and any(
                self.dice(words, n) >= self.threshold for n in range(self.short)):
            found = [x for x in found if x[0] >= self.short]
        whole = [(a, b) for n, _, a, b in found if n >= self.short]
        return [{"line": int(line_of[a]) + 1, "license": self.listed[n][0], "template": n, "dice": dice}
                for n, dice, a, b in found
                if n >= self.short or not (any(a <= y and x <= b for x, y in whole) or in_found_line(a, b))]


def _disjoint(ranked: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """The windows that overlap no window ranked before them; two that share a word overlap."""
    kept: list[tuple[float, int, int]] = []
    for w in ranked:
        k = bisect.bisect(kept, w[1], key=lambda x: x[1])
        if (k == 0 or kept[k - 1][2] + 1 < w[1]) and (k == len(kept) or kept[k][1] > w[2] + 1):
            kept.insert(k, w)
    return kept


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=TEMPLATES,
            threshold: float = THRESHOLD, whole=None) -> DataFrame:
    """Columns of ``scan``, one row per window of words at or above the threshold, whatever the lines.

    ``line`` is where the window begins. Licence texts ``whole`` are numbered after ``notices``. Of the
    windows of a template that overlap, the best one is kept.
    """
    finder = Windows(notices, texts() if whole is None else whole, threshold)

    @F.pandas_udf("array<struct<line: int, license: string, template: int, dice: double>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in parts:
            yield pd.Series([finder.find(text) for text in batch], dtype=object)

    given = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), run(F.col(text_col)).alias("_w"))
    return given.select(F.col("_id").alias(id_col), F.inline("_w"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``id_col``, ``line`` (from 1; 0 is the whole text), ``license``, ``template``, ``dice``.

    The rows of ``units``, and those of ``windows`` for what lies within or across lines. Null and empty
    texts have no row, and repeated rows stay repeated. Other columns are left out.
    """
    return units(docs, id_col, text_col, notices, threshold).unionByName(windows(docs, id_col, text_col, notices, threshold))


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=TEMPLATES,
          threshold: float = THRESHOLD) -> DataFrame:
    """Columns of ``scan``, one row per unit and template at or above the threshold.

    Units are the lines, and the whole text where it has several. Repeated bigrams count as often as
    both sides have them. The templates are a fixed list, so their table is small whatever the input,
    and no row of ``docs`` is shuffled.
    """
    listed = templates(docs.sparkSession, notices, threshold)
    words = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.transform(F.split(text_col, "\n"), normal_words).alias("_lines"))
    # a line break separates words, so the words of the text are those of its lines
    cut = words.select("_id", F.explode(F.concat(
        F.transform("_lines", lambda w, i: F.struct((i + 1).alias("line"), w.alias("w"))),
        F.when(F.size("_lines") > 1, F.array(F.struct(F.lit(0).alias("line"), F.flatten("_lines").alias("w"))))
        .otherwise(F.array().cast("array<struct<line:int,w:array<string>>>")))).alias("u"))
    sized = cut.select("_id", "u.line", "u.w", (F.size("u.w") - 1).alias("size"))
    met = sized.join(F.broadcast(listed), "size").withColumn("grams", bigrams(F.col("w"))).where(F.arrays_overlap("grams", "t_grams"))
    both = F.aggregate(F.array_distinct("t_grams"), F.lit(0), lambda n, g: n + F.least(
        F.size(F.filter("grams", lambda x: x == g)), F.size(F.filter("t_grams", lambda x: x == g))))
    dice = F.lit(2.0) * both / (F.col("size") + F.col("t_size"))
    return (met.select(F.col("_id").alias(id_col), "line", "license", "template", F.round(dice, 6).alias("dice"))
            .where(F.col("dice") >= threshold))


def oracle(notices=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """``units`` over ``documents`` as DuckDB SQL."""
    listed = ", ".join("({}, '{}', '{}')".format(n, name, text.replace("'", "''"))
                       for n, (name, text) in enumerate(notices))
    words = ("list_filter(string_split(replace(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), "
             "'licence', 'license'), ' '), lambda w: w <> '')")
    grams = "list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])"
    return f"""
    WITH t AS (
      SELECT template, license, {grams.format('w')} AS t FROM (
        SELECT template, license, {words.format('text')} AS w FROM (VALUES {listed}) v(template, license, text))
    ), cut AS (
      SELECT doc_id, string_split(text, chr(10)) AS parts, text FROM documents WHERE text IS NOT NULL
    ), units AS (
      SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line, unnest(parts) AS unit FROM cut
      UNION ALL SELECT doc_id, 0, text FROM cut WHERE len(parts) > 1
    ), g AS (
      SELECT doc_id, line, {grams.format('w')} AS g FROM (SELECT doc_id, line, {words.format('unit')} AS w FROM units)
    ), scored AS (
      SELECT doc_id, CAST(line AS INTEGER) AS line, license, template, round(2.0 * list_sum(list_transform(list_distinct(t),
        lambda x: least(len(list_filter(g, lambda y: y = x)), len(list_filter(t, lambda y: y = x))))) / (len(g) + len(t)), 6)
        AS dice FROM g, t WHERE len(g) > 0 AND list_has_any(g, t)
    )
    SELECT doc_id, line, license, template, dice FROM scored WHERE dice >= {threshold}"""
