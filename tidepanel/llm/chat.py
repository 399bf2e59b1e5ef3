"""Chat formatting: conversations become one marked-up text with a loss mask, in DataFrame expressions only.

A message is ``<|im_start|>role\\ntext<|im_end|>\\n``. Adjacent turns of one role are merged into one message
whose texts stand apart by ``<|im_sep|>``, so the turns can be read back. Inside texts and roles every ``<|`` or
``<\\|`` (any number of backslashes) gets one backslash more; a control string can then stand in no text, and
taking one backslash away restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on the first line of its message, so line ends in it are written as %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chat(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, messages, loss_spans``.

    ``messages`` holds ``(role, texts)`` after merging, as written. ``loss_spans`` holds for each turn whose role is
    in ``learn`` the place of its escaped text: ``message`` (from 0), ``offset`` in that message and ``start`` in
    ``formatted`` (characters from 0), ``length``.

    Turns are ordered by ``turn`` (null first), then role, then text; equal rows are kept, each as a turn of its own.
    Null text and null role count as empty, a null ``conv_id`` is a conversation of its own. No rows give no rows.
    Columns beyond ``conv_id, turn, role, text`` are ignored. Offsets are running sums of a window on the
    conversation; collecting keeps its partitioning, so there is one shuffle, and each conversation's array is
    sorted on the way. Work is linear in the length of a conversation; the limit is one string of it.
    """
    here = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    up_to = here.rowsBetween(Window.unboundedPreceding, 0)
    in_message = Window.partitionBy("conv_id", "message").orderBy("position")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "conv_id", F.row_number().over(here).alias("position"), "role",
        escape_role(F.col("role")).alias("name"), escape(F.col("text")).alias("body"),
        F.coalesce(F.lag("role").over(here) != F.col("role"), F.lit(True)).alias("opens"),
        F.coalesce(F.lead("role").over(here) != F.col("role"), F.lit(True)).alias("closes"),
        "turn", "text")
    rows = rows.withColumn("message", (F.sum(F.col("opens").cast("int")).over(up_to) - 1).cast("int"))
    head = F.when(F.col("opens"), F.concat(F.lit(START), "name", F.lit("\n"))).otherwise(F.lit(SEP))
    rows = rows.withColumn("head", F.char_length(head)).withColumn(
        "size", F.col("head") + F.char_length("body") + F.when(F.col("closes"), len(END)).otherwise(0))
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    rows = rows.withColumn("offset", F.col("start") - F.first("start").over(in_message))
    turn = F.struct("position", "message", "role", "name", "body", "opens", "head", "start", "offset")
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    grouped = grouped.withColumn("first", F.filter("turns", lambda t: t["opens"]))
    # turns of one message lie side by side: from its first position up to the next message's
    texts = lambda t, i: F.slice(
        "turns", t["position"],
        F.coalesce(F.get("first", i + 1)["position"], F.size("turns") + 1) - t["position"])
    merged = F.transform("first", lambda t, i: F.struct(
        t["name"].alias("role"), F.transform(texts(t, i), lambda x: x["body"]).alias("texts")))
    messages = grouped.select("conv_id", "turns", merged.alias("messages"))
    written = F.transform("messages", lambda m: F.concat(
        F.lit(START), m["role"], F.lit("\n"), F.array_join(m["texts"], SEP), F.lit(END)))
    spans = F.transform(F.filter("turns", lambda t: t["role"].isin(*learn)), lambda t: F.struct(
        t["message"].alias("message"), (t["offset"] + t["head"]).cast("long").alias("offset"),
        (t["start"] + t["head"]).cast("long").alias("start"),
        F.char_length(t["body"]).cast("long").alias("length")))
    return messages.select("conv_id", F.array_join(written, "").alias("formatted"), "messages",
                           spans.alias("loss_spans"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """Read turns and learned text back from ``formatted`` and ``loss_spans`` alone.

    Adds ``turns`` (array of role and text, unescaped) and ``learned`` (array of the unescaped texts under the mask).
    """
    df = formatted.withColumn("blocks", F.split("formatted", r"<\|im_start\|>", -1))  # the first is empty
    # a block is role, line end, texts, END
    head = lambda b: F.instr(b, "\n")
    body = lambda b: F.substr(b, head(b) + 1, F.char_length(b) - head(b) - len(END))
    role = lambda b: unescape_role(F.substr(b, F.lit(1), head(b) - 1))
    turns = F.flatten(F.transform(F.slice("blocks", 2, F.size("blocks") - 1), lambda b: F.transform(
        F.split(body(b), r"<\|im_sep\|>", -1), lambda x: F.struct(role(b).alias("role"), unescape(x).alias("text")))))
    learned = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.get("blocks", s["message"] + 1), (s["offset"] + 1 - len(START)).cast("int"), s["length"].cast("int"))))
    return df.withColumn("turns", turns).withColumn("learned", learned).drop("blocks")
