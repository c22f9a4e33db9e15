"""Chat examples from logs of events.

A log has one row per event: conversation, sequence, kind, message number, role
and text. Events are folded in order of their sequence: ``message`` starts or
replaces a message, ``delta`` appends to it, ``edit`` replaces its text, and
``regenerate`` empties it and drops every later message. The final messages are
rendered with a template whose control strings are escaped inside texts, so
that a reader gets every role and text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Control strings that may not appear inside a text. The first three make up a turn.
BEGIN, MIDDLE, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = (BEGIN, MIDDLE, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

EVENTS = "conv_id bigint, seq bigint, kind string, message bigint, role string, text string"


def escape(c: Column) -> Column:
    """Double every backslash, then break each control string behind its first character."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    """A backslash goes; the one that may follow it stays."""
    return F.regexp_replace(c, r"\\(\\?)", "$1")


def final_messages(events: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per final message: ``conv``, ``message``, ``role`` and ``text``.

    Windows over a conversation's events in order find what was undone: a
    ``regenerate`` undoes all earlier events of its message and of later ones,
    and of those left, only what follows a message's last ``message``, ``edit``
    or ``regenerate`` makes up its text. Deltas are joined once, however many. A
    delta, edit or unknown kind of a message that never began starts it. NULL
    roles and texts count as empty; a message has its last role that is not
    empty. Rows alike in sequence keep a fixed order: by message, kind, role, text.
    """
    e = events.select(F.col(conv).alias("_c"), "seq", "message", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("seq", "message", "kind", "role", "text")]
    at = e.withColumn("i", F.row_number().over(W.partitionBy("_c").orderBy(*order)))
    # the least message number that a later event of the conversation regenerates
    later = W.partitionBy("_c").orderBy(F.col("i").desc()).rowsBetween(W.unboundedPreceding, -1)
    undone = F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(later)
    alive = at.withColumn("undone", undone).filter("undone is null or message < undone or (message is null)").drop("undone")
    after = W.partitionBy("_c", "message").orderBy(F.col("i").desc()).rowsBetween(W.unboundedPreceding, -1)
    begun = F.max(F.when(F.col("kind").isin("message", "edit", "regenerate"), 1)).over(after)
    parts = alive.withColumn("over", begun.isNotNull())
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("over"), F.struct("i", "text")))), lambda x: x["text"]), "")
    role = F.max_by("role", F.when(F.col("role") != "", F.col("i")))
    return parts.groupBy("_c", "message").agg(F.coalesce(role, F.lit("")).alias("role"), text.alias("text")).withColumnRenamed("_c", conv)


def message_events(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as a log: one ``message`` event per row, numbered by turn, role and text; repeated rows stay apart."""
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("_t"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy(F.col("_t").asc_nulls_first(), "role", "text")).cast("bigint")
    return t.withColumn("seq", place).select("conv_id", "seq", F.lit("message").alias("kind"), F.col("seq").alias("message"), "role", "text")


def render(messages: DataFrame, conv: str = "conv_id", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv``, ``formatted`` and ``loss_mask``: spans (start, end; code points, end exclusive) of the texts to learn from.

    Where a text begins is a running sum over the turns, so a long conversation
    costs one pass; only its finished text is one value.
    """
    turns = messages.select(conv, "message", F.concat(F.lit(BEGIN), escape(F.col("role")), F.lit(MIDDLE)).alias("head"), escape(F.col("text")).alias("body"), F.col("role").isin(*trained).alias("learn"))
    before = W.partitionBy(conv).orderBy(F.col("message").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("body") + len(END)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.char_length("head")
    placed = turns.withColumns({"start": start.cast("int"), "end": (start + F.char_length("body")).cast("int"), "turn": F.concat("head", "body", F.lit(END))})
    one = F.sort_array(F.collect_list(F.struct("start", "turn")))
    spans = F.sort_array(F.collect_list(F.when(F.col("learn"), F.struct("start", "end"))))
    return placed.groupBy(conv).agg(F.array_join(F.transform(one, lambda x: x["turn"]), "").alias("formatted"), spans.alias("loss_mask"))


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv``, ``turns`` (role, text) and ``loss_text``, from ``formatted`` and ``loss_mask`` alone.

    Pieces between END marks are turns; no text can hold a mark, so splitting is safe.
    """
    pieces = F.filter(F.split(F.col("formatted"), r"<\|end\|>"), lambda p: p != "")
    fields = F.transform(pieces, lambda p: F.split(F.substr(p, F.lit(len(BEGIN) + 1)), r"<\|text\|>"))
    turns = F.transform(fields, lambda f: F.struct(unescape(f[0]).alias("role"), unescape(f[1]).alias("text")))
    learned = F.array_join(F.transform("loss_mask", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    return formatted.select(conv, turns.alias("turns"), learned.alias("loss_text"), F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def format_conversations(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Turns folded through the event log and rendered: ``conv``, ``formatted``, ``loss_mask``. No turns: no row."""
    return render(final_messages(message_events(turns, conv)).withColumnRenamed("conv_id", conv), conv)
