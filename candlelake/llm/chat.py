"""Chat formatting by DataFrame expressions alone: conversations to one marked text each, and back.

Turns are collected as structs and sorted; adjacent turns of one role become one block, an aggregated
slice of that array, and blocks are concatenated::

    <|im_start|>user
    first text<|im_sep|>second text<|im_end|>
    <|im_start|>assistant
    ...

Every control string starts with ``<|``. In texts and roles, ``<``, any backslashes and ``|`` get one
backslash more, so that ``<|`` never stands in them, and reading back takes one away. The loss mask is
a list of byte spans of the formatted text: the texts of the roles to be learned, and no mark.

All steps are linear in a conversation. A conversation is one row of the result, so it has to fit one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks.
OPEN, SEP, CLOSE, LINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|im_line|>"
LEARNED = ("assistant",)
STRIDE = 256        # lengths that are summed in one go


def escape(text: Column) -> Column:
    """``text`` without ``<|``; ``unescape`` undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums(lengths: Column) -> Column:
    """Running sums of a short array."""
    none = F.array().cast("array<bigint>")
    return F.aggregate(lengths, none, lambda sums, n: F.concat(
        sums, F.array(n + F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("bigint")))))


def running_sums(lengths: Column) -> Column:
    """Running sums of an array of any length, by strides: an array that grows is copied at each step."""
    def joined(strides: Column, offsets: Column) -> Column:
        def shifted(stride: Column, k: Column) -> Column:
            before = F.when(k == 0, F.lit(0).cast("bigint")).otherwise(F.get(offsets, k - 1))
            return _let(before, lambda b: F.transform(stride, lambda x: x + b))

        return F.flatten(F.transform(strides, shifted))

    def by_stride(all_lengths: Column) -> Column:
        firsts = F.when(F.size(all_lengths) > 0, F.sequence(F.lit(1), F.size(all_lengths), F.lit(STRIDE))).otherwise(
            F.array().cast("array<int>"))
        strides = F.transform(firsts, lambda at: _sums(F.slice(all_lengths, at, F.lit(STRIDE))))
        return _let(strides, lambda s: _let(_sums(F.transform(s, lambda x: F.element_at(x, -1))),
                                            lambda offsets: joined(s, offsets)))

    return _let(lengths, by_stride)


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", learned: Sequence[str] = LEARNED) -> DataFrame:
    """Columns ``id_col``, ``formatted``, ``loss_spans``: one row per conversation.

    ``loss_spans`` are ``start`` and ``end`` in bytes of the UTF-8 text, one span for each text of a
    learned role, empty texts included, in order. Turns follow ``turn_col``, rows without a turn first;
    ties follow role and text, and repeated rows stay repeated. Null texts and roles count as empty. A
    row without a conversation id is a conversation of its own, so such rows never gather in one task.
    An empty table gives no row. Columns besides the four named are left out, so no name can clash.
    One shuffle, by conversation.
    """
    raw_role = F.coalesce(F.col(role_col), F.lit(""))
    role = F.regexp_replace(escape(raw_role), "\n", LINE)
    text = escape(F.coalesce(F.col(text_col), F.lit("")))
    rows = turns.select(
        F.col(id_col).alias("id"), F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).alias("lone"),
        F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
                 raw_role.isin(list(learned)).alias("learn")).alias("t"))
    df = rows.groupBy("id", "lone").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    all_turns, firsts = F.col("turns"), F.col("firsts")
    begins = F.filter(F.sequence(F.lit(0), F.size(all_turns) - 1), lambda i: (i == 0) | (
        F.get(all_turns, i)["role"] != F.get(all_turns, F.greatest(i - 1, F.lit(0)))["role"]))
    df = df.withColumn("firsts", begins)
    blocks = F.transform(firsts, lambda at, k: F.slice(
        all_turns, at + 1, F.coalesce(F.get(firsts, k + 1), F.size(all_turns)) - at))

    def piece(value: Column, learn: Column = F.lit(False)) -> Column:
        return F.struct(value.alias("text"), learn.alias("learn"))

    def marked(block: Column) -> Column:
        texts = F.flatten(F.transform(block, lambda t, k: F.array(
            piece(F.when(k == 0, F.concat(F.lit(OPEN), t["role"], F.lit("\n"))).otherwise(F.lit(SEP))),
            piece(t["text"], t["learn"]))))
        return F.concat(texts, F.array(piece(F.lit(CLOSE))))

    df = df.withColumn("pieces", F.flatten(F.transform(blocks, marked)))
    pieces = F.col("pieces")
    ends = running_sums(F.transform(pieces, lambda p: F.octet_length(p["text"]).cast("bigint")))
    spans = F.transform(
        F.filter(F.arrays_zip(pieces.alias("p"), ends.alias("e")), lambda z: z["p"]["learn"]),
        lambda z: F.struct((z["e"] - F.octet_length(z["p"]["text"])).alias("start"), z["e"].alias("end")))
    return df.select(F.col("id").alias(id_col), F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("formatted"),
                     spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of ``role`` and ``text``."""
    blocks = F.split(formatted, CLOSE.replace("|", r"\|"))

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        name = unescape(F.regexp_replace(F.substr(head, F.lit(len(OPEN) + 1)), LINE.replace("|", r"\|"), "\n"))
        body = F.split(F.substr(block, F.length(head) + 2), SEP.replace("|", r"\|"))
        return _let(name, lambda n: F.transform(body, lambda t: F.struct(n.alias("role"), unescape(t).alias("text"))))

    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turns))


def read_learned(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, as they were before they were formatted."""
    return _let(formatted.cast("binary"), lambda raw: F.transform(spans, lambda s: unescape(
        F.substring(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).cast("string"))))


def digests(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Read ``format_chats`` results back: counts and hashes of the turns and of the text to be learned.

    ``n_turns`` counts single turns, ``n_blocks`` merged ones.
    """
    df = chats.withColumns({"turns": read_turns(F.col("formatted")),
                            "texts": read_learned(F.col("formatted"), F.col("loss_spans"))})
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    blocks = (F.length("formatted") - F.length(F.replace(F.col("formatted"), F.lit(OPEN), F.lit("")))) / len(OPEN)
    learned = F.array_join("texts", "")
    return df.select(
        id_col, F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), blocks.cast("bigint").alias("n_blocks"))
