"""Audit of how filters interact: what each removes, in every order they can be applied.

A document's failures are bits of one mask, so the corpus shrinks to cells: rows per part and mask.
A recursive common table expression then extends filter prefixes by unused letters. It joins the masks
that occur, carries the bits applied so far, and each level of the recursion emits what its step does
to each mask: keep, remove, or find it removed already. Cells join these rows by mask, and their
counts summed are the metrics of the step. With n filters there are at most 2^n masks and e * n!
prefixes, whatever the corpus holds: for five filters 10,432 rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.session import settle

LETTERS = "ABCDE"
# The rules of the filters.
SPACES = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
SIGNS = r"[#$%&*|]"

WALK = """
WITH RECURSIVE filters(letter, bit) AS (VALUES {letters}),
walk(prefix, applied, letter, bit, step, mask, kept, removed, redundant, alone) AS (
  SELECT '', 0, '', 0, 0, mask, 1, 0, 0, 0 FROM {{masks}}
  UNION ALL
  SELECT concat(w.prefix, f.letter), w.applied | f.bit, f.letter, f.bit, w.step + 1, w.mask,
    int(w.mask & (w.applied | f.bit) = 0),
    int(w.mask & w.applied = 0 AND w.mask & f.bit <> 0),
    int(w.mask & w.applied <> 0 AND w.mask & f.bit <> 0),
    int(w.mask = f.bit)
  FROM walk AS w JOIN filters AS f ON w.applied & f.bit = 0
)
SELECT prefix, letter, bit, step, mask, kept, removed, redundant, alone FROM walk WHERE step > 0"""


def failures(text: Column) -> list[tuple[str, Column]]:
    """Filters A to D as conditions on a text's own counts ``_words``, ``_distinct``, ``_capitals``, ``_chars``."""
    return [
        ("A", F.col("_words") < LEAST_WORDS),
        ("B", 100 * F.col("_distinct") < LEAST_DISTINCT * F.col("_words")),
        ("C", 100 * F.col("_capitals") > MOST_CAPITALS * F.col("_chars")),
        ("D", text.rlike(SIGNS)),
    ]


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Columns ``id``, ``part``, ``mask``, ``n``: rows by id, part and the filters A to E that they fail.

    Texts are read whole, null texts and parts count as empty. E holds where a smaller id of the table has
    the same text (equal SHA-256); a row without an id is neither smaller nor larger than another. Rows
    meet their text's smallest id by text and id together, so no group of copies shares a task.
    """
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_list", F.array_remove(F.split(text, SPACES), ""))
    rows = rows.withColumns({
        "_words": F.size("_list").cast("bigint"), "_distinct": F.size(F.array_distinct("_list")).cast("bigint"),
        "_capitals": F.regexp_count(text, F.lit("[A-Z]")).cast("bigint"), "_chars": F.length(text).cast("bigint")})
    own = reduce(Column.__add__, [F.when(c, 1 << LETTERS.index(x)).otherwise(0) for x, c in failures(text)])
    rows = rows.select("id", "part", F.unhex(F.sha2(text, 256)).alias("copy"), own.alias("own"))
    rows = settle(rows.groupBy("id", "part", "copy", "own").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    least = rows.where("id IS NOT NULL").groupBy("copy").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = rows.where("id IS NOT NULL").join(least, ["copy", "id"], "left").select(
        "id", "part", (F.col("own") + F.when(F.col("first"), 0).otherwise(1 << LETTERS.index("E"))).alias("mask"), "n")
    return known.unionByName(rows.where("id IS NULL").select("id", "part", F.col("own").alias("mask"), "n"))


def cells(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Columns ``part``, ``mask``, ``docs``, ``good``, ``toxic``: at most 32 rows a part.

    An id is good or toxic if any of its labels says so; rows without an id have no label.
    """
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("good OR toxic")
    known = masked.where("id IS NOT NULL").join(marks, "id", "left")
    rows = known.select("part", "mask", "n", "good", "toxic").unionByName(
        masked.where("id IS NULL").select("part", "mask", "n"), allowMissingColumns=True)
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"))


def walk(found: DataFrame, letters: Sequence[str] = LETTERS) -> DataFrame:
    """Every prefix of every order against every mask in ``found.mask``: what the prefix's last filter does to it."""
    values = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(letters))
    return found.sparkSession.sql(WALK.format(letters=values), masks=found.select("mask").distinct())


def audit(counted: DataFrame, letters: Sequence[str] = LETTERS) -> DataFrame:
    """One row per part, order of all filters and step, zeros included; ``counted`` are ``cells``.

    Columns ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost``, ``shapley``. A prefix is counted once and shared by the orders that
    begin with it. ``shapley`` sums what the step's filter removes over all orders: of a document that
    fails c filters each is the first in one of c orders. An empty table gives no row. The two tables
    that are broadcast have bounds by the number of filters alone.
    """
    n = len(letters)
    orders = 1
    for i in range(2, n + 1):
        orders *= i
    counted = settle(counted, "audit-cells")
    steps = settle(walk(counted, letters), "audit-walk")

    def total(count: str, flag: str) -> Column:
        return F.sum(F.col(count) * F.col(flag)).cast("bigint").alias(f"_{count}_{flag}")

    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    first = F.when(fails, F.expr(f"docs * {orders} div bit_count(mask)")).otherwise(F.lit(0))
    metrics = counted.join(F.broadcast(steps), "mask").groupBy("part", "prefix").agg(
        *[total(*x) for x in (("docs", "kept"), ("docs", "removed"), ("docs", "redundant"), ("docs", "alone"),
                              ("good", "removed"), ("toxic", "removed"))],
        F.sum(first).cast("bigint").alias("shapley"))
    whole = steps.where(F.col("step") == n).select(F.col("prefix").alias("filter_order")).distinct()
    places = whole.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn(
        "prefix", F.expr("left(filter_order, step)"))
    return metrics.join(F.broadcast(places), "prefix").select(
        "part", "filter_order", "step", F.col("_docs_kept").alias("kept"), F.col("_docs_removed").alias("removed"),
        F.col("_docs_redundant").alias("redundant"), F.col("_docs_alone").alias("unique_fails"),
        F.col("_good_removed").alias("good_lost"), F.col("_toxic_removed").alias("toxic_lost"), "shapley")


def interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """The audit of filters A to E over ``docs``; see ``masks``, ``cells`` and ``audit`` for nulls, ties and copies.

    Columns besides those named are left out, so no name can clash.
    """
    return audit(cells(masks(docs, id_col, text_col, part_col), labels, id_col))


def oracle() -> str:
    """The same in DuckDB SQL."""
    return r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    min(doc_id) OVER (PARTITION BY text) AS first FROM t
), m AS (
  SELECT doc_id, part,
    CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM w
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, mask, count(*) AS docs, count(*) FILTER (l.good) AS good, count(*) FILTER (l.toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o(filter_order, applied) AS (
  SELECT '', 0
  UNION ALL
  SELECT filter_order || letter, applied | bit FROM o JOIN f ON applied & bit = 0
), s AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, i, 1) AS letter,
    list_sum(list_transform(range(1, i), lambda j: 1 << (ascii(substr(filter_order, j, 1)) - 65))) AS before
  FROM o, range(1, 6) AS r(i) WHERE length(filter_order) = 5
), r AS (
  SELECT part, filter_order, step, s.letter,
    sum(docs) FILTER (mask & (coalesce(before, 0)::INT | bit) = 0) AS kept,
    sum(docs) FILTER (mask & coalesce(before, 0)::INT = 0 AND mask & bit <> 0) AS removed,
    sum(docs) FILTER (mask & coalesce(before, 0)::INT <> 0 AND mask & bit <> 0) AS redundant,
    sum(docs) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & coalesce(before, 0)::INT = 0 AND mask & bit <> 0) AS good_lost,
    sum(toxic) FILTER (mask & coalesce(before, 0)::INT = 0 AND mask & bit <> 0) AS toxic_lost
  FROM c, s JOIN f ON f.letter = s.letter GROUP BY part, filter_order, step, s.letter
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM r"""
