"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is a list of turns, and a turn is ``<s>role [INST] text [/INST]</s>``.  Roles and texts
are escaped, so that every control string of a formatted conversation is the template's own; the whole
is parsed again and compared with its source.  Escaping puts a backslash behind the bracket of a
control string and of one already escaped, so parsing can always take one away and one step suffices
for any text.  Control strings hold brackets only at their start, so none can arise where a text meets
a marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template are <s>, </s>, [INST] and [/INST].
_SQUARE = r"/?INST\]"
_ANGLE = r"/?s>"
TURN = r"(?s)^<s>(.*?) \[INST\] (.*) \[/INST\]</s>$"
LEARNED = "assistant"
_BEFORE = len(f"<s>{LEARNED} [INST] ")
_AFTER = len(" [/INST]</s>")


def escape(c: Column) -> Column:
    c = F.regexp_replace(c, rf"\[(\\*)({_SQUARE})", r"[\\$1$2")
    return F.regexp_replace(c, rf"<(\\*)({_ANGLE})", r"<\\$1$2")


def unescape(c: Column) -> Column:
    c = F.regexp_replace(c, rf"\[\\(\\*)({_SQUARE})", r"[$1$2")
    return F.regexp_replace(c, rf"<\\(\\*)({_ANGLE})", r"<$1$2")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<s>"), role, F.lit(" [INST] "), text, F.lit(" [/INST]</s>"))


def parse(formatted: Column) -> Column:
    """Array of the turns (role and text) of a rendered text; what the grammar does not know stays as it is."""

    def turn(c: Column) -> Column:
        role, text = (F.when(c.rlike(TURN), F.regexp_extract(c, TURN, k)).otherwise(c) for k in (1, 2))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.split(formatted, "(?=<s>)", -1), turn)


def format_chats(chats: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``turns`` (role and text, parsed back from it) and ``loss_mask``, a row per conversation.

    ``chats`` has ``conv_id``, ``turn``, ``role`` and ``text``, further columns are ignored.  Null texts
    and roles count as empty, null turns come first, rows of equal turn follow by role and text, and
    repeated rows are turns each.  A null ``conv_id`` is a conversation of its own; an empty table
    gives none.  A text that did not survive the round trip would raise an error, not pass.
    ``loss_mask`` lists the spans of ``formatted`` that hold the texts of the assistant, as escaped there:
    ``start`` and ``end`` (exclusive) in bytes of its UTF-8, from 0, so that a cut costs its own length only.
    A conversation is one text and so one row, however long; its turns are rendered before they meet.
    """
    role, text = (F.coalesce(chats[c].cast("string"), F.lit("")) for c in ("role", "text"))
    turns = chats.select(chats["conv_id"].cast("long").alias("conv_id"), chats["turn"].cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rendered = turns.withColumn("rendered", render(escape(F.col("role")), escape(F.col("text"))))
    # No turn is empty, so where it ends also orders it.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rendered = rendered.withColumn("bytes", F.octet_length("rendered").cast("long")).withColumn("end", F.sum("bytes").over(order))
    chat = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("end", "bytes", "role", "text", "rendered"))).alias("ts"))
    chat = chat.select("conv_id", "ts", F.array_join("ts.rendered", "").alias("formatted"))
    chat = chat.withColumn("turns", parse(F.col("formatted")))
    same = F.col("turns") == F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    lost = F.raise_error(F.lit("a turn did not survive the round trip")).cast("string")
    learned = F.filter("ts", lambda t: t["role"] == LEARNED)
    mask = F.transform(learned, lambda t: F.struct((t["end"] - t["bytes"] + _BEFORE).alias("start"), (t["end"] - _AFTER).alias("end")))
    return chat.select("conv_id", F.when(same, F.col("formatted")).otherwise(lost).alias("formatted"), "turns", mask.alias("loss_mask"))


def masked_texts(formatted: Column, mask: Column) -> Column:
    """Array of the texts that the spans of ``mask`` cut from ``formatted``, with their escapes taken back."""

    def cut(data: Column) -> Column:
        return F.transform(mask, lambda m: unescape(F.substring(data, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")).cast("string")))

    # Bound to a variable, the bytes are made once and not for every span.
    return F.transform(F.array(formatted.cast("binary")), cut)[0]


def digests(formatted: DataFrame) -> DataFrame:
    """What ``format_chats`` returns, summed up: counts and digests of the turns and of the loss mask."""
    spoken = F.array_join(masked_texts(F.col("formatted"), F.col("loss_mask")), "")
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select("conv_id", "formatted", "turns", spoken.alias("spoken")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("spoken").cast("long").alias("loss_chars"),
        F.sha2("spoken", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
