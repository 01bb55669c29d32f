"""Prefix-target expansion of conversations into training examples, in DataFrame functions alone.

A turn is written as ``### role: text</turn>`` and a line feed.  Inside texts and
roles ``\\``, ``<`` and ``#`` (in roles ``:`` too) are written as a backslash and the
letter b, l, h or c, so no text can hold a marker; undoing the letters, the
backslash's own last, gives the text back.

Every assistant turn becomes one example: all turns before it, then the turn
itself, and only its own text is trainable (``loss_start`` to ``loss_end``, code
points of the example).  A conversation that does not end with an assistant turn
gets one more row of all its turns with an empty loss span, so no turn is lost.

Rows are shuffled once, by ``conv_id``; the lists of a conversation are gathered
with map-side partial lists.  A conversation is one training text, so it has to
fit into a row.

Defined results: null text or role is empty; turns are ordered by ``turn`` (null
first), then role and text, so ties and repeated rows have one fixed order; rows
with null ``conv_id`` are one conversation, which like any has to fit into a row; an empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"


# Escape letters, the backslash's own first.
_LETTERS = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escape(text: Column, role: bool = False) -> Column:
    for mark, written in _LETTERS if role else _LETTERS[:3]:
        text = F.replace(text, F.lit(mark), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for mark, written in reversed(_LETTERS):
        text = F.replace(text, F.lit(written), F.lit(mark))
    return text


def prefix_targets(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, n_turns, text, loss_start, loss_end``, one row per assistant turn (and per open end)."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")).select(
        "conv_id", F.size("turns").alias("size"),
        F.transform("turns", lambda t: F.concat(F.lit("### "), escape(t["role"], role=True), F.lit(": "), escape(t["text"]),
                                                F.lit(END))).alias("written"),
        F.transform("turns", lambda t: F.struct((t["role"] == "assistant").alias("target"),
                                                F.length(escape(t["text"])).alias("length"))).alias("shape"))
    examples = whole.select("conv_id", "size", "written", F.posexplode("shape").alias("pos", "shape")).where(
        F.col("shape.target") | (F.col("pos") == F.col("size") - 1))
    text = F.array_join(F.slice("written", F.lit(1), F.col("pos") + 1), "")
    end = F.length("text") - len(END)
    return (examples.select("conv_id", F.col("pos").cast("long").alias("example"), (F.col("pos") + 1).cast("long").alias("n_turns"),
                            text.alias("text"), "shape")
            .select("conv_id", "example", "n_turns", "text",
                    F.when(F.col("shape.target"), end - F.col("shape.length")).otherwise(end).cast("long").alias("loss_start"),
                    end.cast("long").alias("loss_end")))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples' text and spans alone: turn and loss digests and the characters written."""
    loss = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    rows = examples.select("conv_id", "n_turns", "text", F.struct("example", loss.alias("loss")).alias("part"),
                           F.length("text").cast("long").alias("chars"))
    one = rows.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max_by("text", "n_turns").alias("text"),
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    role = r"^### ([^:]*): "
    turns = F.transform(F.slice(F.split("text", END), F.lit(1), F.col("n_turns").cast("int")),
                        lambda t: F.concat(unescape(F.regexp_extract(t, role, 1)), F.lit("\n"),
                                           unescape(F.regexp_replace(t, role, "")), F.lit("\n")))
    return one.select("conv_id", "n_turns", F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      "formatted_chars")
