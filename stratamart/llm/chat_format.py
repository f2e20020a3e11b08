"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example is the formatted text of all turns up to and including one assistant turn; only that reply is trainable. A
conversation that does not end with an assistant turn also gets one closing row without a trainable span, so that no turn
is lost. The template is ``<|turn|>role\\ntext<|end|>\\n``. Inside roles and texts ``&`` and ``<`` are written as ``&amp;``
and ``&lt;`` (in roles also the newline, as ``&#10;``), so no text can contain a marker, and the way back is exact.

Built-in functions only. The turns of one conversation meet in one row, since an example is one row and has to hold its
whole context; examples of a conversation are made one after the other.

Defined results: turns are ordered by number, then role, then text, a missing number first; repeated rows are turns of
their own; a null role or text counts as empty; each row without conversation id is a conversation of its own, however many
there are; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
TRAINED_ROLE = "assistant"


def _swap(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def escaped(text: Column) -> Column:
    return _swap(text, [("&", "&amp;"), ("<", "&lt;")])


def unescaped(text: Column) -> Column:
    return _swap(text, [("&lt;", "<"), ("&amp;", "&")])


def chat_examples(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """conv, lone, example (index of its last turn), n_turns, text, loss_start, loss_end (code points), complete.

    ``lone`` tells conversations without id apart and is null in all others.

    The trainable span is [loss_start, loss_end) of ``text``, null in a closing row. ``complete`` marks the one row of a
    conversation that holds all of its turns.
    """
    role_text = F.coalesce(F.col(role).cast("string"), F.lit(""))
    body = escaped(F.coalesce(F.col(text), F.lit("")))
    head = F.replace(escaped(role_text), F.lit("\n"), F.lit("&#10;"))
    lone = F.when(F.col(conv).isNull(), F.monotonically_increasing_id())
    rows = df.select(F.col(conv).alias("conv"), lone.alias("lone"), F.struct(
        F.col(turn).alias("turn"), role_text.alias("role"), body.alias("body"),
        F.concat(F.lit(OPEN), head, F.lit("\n"), body, F.lit(CLOSE)).alias("made")).alias("t"))
    talks = rows.groupBy("conv", "lone").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    last = F.size("turns") - 1
    ends = F.filter(F.sequence(F.lit(0), last),
                    lambda i: (F.get("turns", i)["role"] == TRAINED_ROLE) | (i == last))
    at = F.get("turns", F.col("example"))
    examples = (talks.select("conv", "lone", "turns", F.explode(ends).alias("example"))
                .select("conv", "lone", "example", (F.col("example") + 1).alias("n_turns"),
                        (F.col("example") == last).alias("complete"),
                        F.array_join(F.transform(F.slice("turns", 1, F.col("example") + 1), lambda t: t["made"]), "")
                        .alias("text"),
                        F.when(at["role"] == TRAINED_ROLE, F.char_length(at["body"])).alias("size")))
    end = F.char_length("text") - len(CLOSE)
    return examples.select(F.col("conv").alias(conv), "lone", "example", "n_turns", "text",
                           F.when(F.col("size").isNotNull(), end - F.col("size")).alias("loss_start"),
                           F.when(F.col("size").isNotNull(), end).alias("loss_end"), "complete")


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda p: p != "")
    bodies = F.transform(parts, lambda p: F.substring(p, F.lit(1), F.char_length(p) - len(CLOSE)))
    return F.transform(bodies, lambda p: F.struct(
        unescaped(F.replace(F.substring_index(p, "\n", 1), F.lit("&#10;"), F.lit("\n"))).alias("role"),
        unescaped(F.substring(p, F.instr(p, "\n") + 1, F.char_length(p))).alias("text")))


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescaped(F.substring(text, start + 1, end - start))
