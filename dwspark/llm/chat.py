"""Operator 9: chat formatting with Spark expressions only.

Template: ``<|im_start|>ROLE<|im_sep|>TEXT<|im_end|>`` and a line feed for each
block. Adjacent turns of the same role share a block; ``<|im_join|>`` stands
between their texts, so that the single turns can be read back. Inside roles
and texts, a backslash becomes two and ``<|`` becomes ``<\\|``: no control
string survives in a text, and ``read_back`` undoes it exactly.

Turns are first collected in chunks of ``chunk`` turn numbers, sorted by
(turn, role, text) and merged there; then the chunks of a conversation, one row each,
are put together. Each assistant text is a segment of its own under the loss
mask.

Defined cases: null text or role is the empty string; null turn numbers come first;
null conv_id is a conversation of its own; repeated rows are turns of their
own; ties of the turn number are ordered by role, then text; other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, JOIN, END = "<|im_start|>", "<|im_sep|>", "<|im_join|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_chat(turns: DataFrame, loss_role: str = "assistant", chunk: int = 64) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments array<struct<text, loss>>.

    ``segments`` joined give ``formatted``; those with ``loss`` are under the loss mask.
    """
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    r = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), escape(r).alias("role"), escape(t).alias("text"), r.alias("raw_role"), t.alias("raw_text"))
    rows = rows.withColumn("chunk", F.floor(F.col("turn") / F.lit(chunk)))
    # order by the unescaped strings; they are dropped after the sort
    item = F.struct("turn", "raw_role", "raw_text", "role", "text")
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(item)).alias("items"))
    chunks = chunks.select("conv_id", "chunk", F.transform("items", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("items"))
    # the role before each chunk decides whether its first turn joins the block before
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("chunk"))
    heads = chunks.select("conv_id", "chunk", F.element_at("items", -1)["role"].alias("last")).withColumn("before", F.lag("last").over(order)).select(
        F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "before"
    )
    chunks = chunks.join(heads, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("chunk").eqNullSafe(F.col("k")))

    def merge(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.col("before")).otherwise(F.get(F.col("items"), i - 1)["role"])
        opening = F.when(before.isNull(), F.concat(F.lit(START), x["role"], F.lit(SEP))).when(before == x["role"], F.lit(JOIN)).otherwise(F.concat(F.lit(END + START), x["role"], F.lit(SEP)))
        loss = x["role"] == F.lit(loss_role)
        return F.array(_segment(opening, F.lit(False)), _segment(x["text"], loss))

    chunks = chunks.select("conv_id", "chunk", F.flatten(F.transform("items", merge)).alias("segments"))
    whole = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "segments"))).alias("parts"))
    segments = F.concat(F.flatten(F.col("parts.segments")), F.array(_segment(F.lit(END), F.lit(False))))
    whole = whole.select("conv_id", segments.alias("segments"))
    return whole.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns, from the formatted string alone."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda b, i: i > 0)

    def block(b: Column) -> Column:
        role = F.substring_index(b, SEP, 1)
        body = F.substring_index(F.substr(b, F.length(role) + F.lit(len(SEP) + 1)), END.strip(), 1)
        return F.transform(F.split(body, r"<\|im_join\|>", -1), lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, block))
