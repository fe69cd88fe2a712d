"""Chat formatting: every assistant turn becomes an example of its own.

A turn is written as ``### role: text</turn>`` and a line feed. Inside roles and texts the
characters that could be read as marks are replaced: a backslash by ``\\e``, ``<`` by ``\\l``,
``#`` by ``\\h`` and, in roles, ``:`` by ``\\c``. Every backslash that is left begins such a
pair, so the replacement can be undone and no text can imitate a mark.

``examples`` explodes a conversation into one example for each assistant turn: all
turns before it as context, then the reply, whose text alone is trainable (the mask is
one span). Turns after the last reply form one more example without a trainable part, so
that no turn is lost. Only DataFrame functions are used.

A null text or role counts as empty; turns are ordered by number, then role and text, with
nulls first, so repeated rows stay and ties are settled. Rows with a null conversation form one
conversation. An empty table gives an empty result; other columns are not read. An example holds its
whole context, so the output grows with the square of a conversation's turns, as the method asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
TARGET = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    out = F.coalesce(text.cast("string"), F.lit(""))
    pairs = [("\\", "\\e"), ("<", "\\l"), ("#", "\\h")] + [(":", "\\c")] * role
    for plain, coded in pairs:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column) -> Column:
    for coded, plain in (("\\c", ":"), ("\\h", "#"), ("\\l", "<"), ("\\e", "\\")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def examples(turns: DataFrame, key="conv_id", turn="turn", role="role", text="text", target: str = TARGET) -> DataFrame:
    """(key, example, formatted, loss_start, loss_end): the mask is a half-open span of code points."""
    rows = turns.select(
        F.col(key).alias("key"),
        F.struct(
            F.col(turn).alias("turn"),
            F.col(role).alias("role"),
            F.col(text).alias("text"),
        ).alias("t"),
    )
    talks = rows.groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    piece = F.transform(
        "ts",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escape(t["role"], True), F.lit(AFTER_ROLE)).alias("head"),
            escape(t["text"]).alias("body"),
            F.coalesce(t["role"] == target, F.lit(False)).alias("reply"),
        ),
    )
    talks = talks.select("key", piece.alias("p"))
    last = F.size("p") - 1
    found = talks.select("key", "p", last.alias("last"), F.posexplode("p").alias("at", "own"))
    found = found.where("own.reply or at = last")
    before = F.concat_ws("", F.transform(F.slice("p", F.lit(1), F.col("at")), lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))))
    found = found.select("key", "at", "own", F.concat(before, F.col("own.head")).alias("context"))
    formatted = F.concat("context", "own.body", F.lit(CLOSE))
    start = F.length("context")
    begin = F.when(F.col("own.reply"), start).otherwise(F.length(formatted))
    end = F.when(F.col("own.reply"), start + F.length("own.body")).otherwise(F.length(formatted))
    return found.select(
        F.col("key").alias(key),
        F.col("at").alias("example"),
        formatted.alias("formatted"),
        begin.cast("long").alias("loss_start"),
        end.cast("long").alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    parts = F.filter(F.split(formatted, F.lit(CLOSE), -1), lambda x: x != "")
    return F.transform(
        parts,
        lambda x: F.struct(
            unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), AFTER_ROLE, 1)).alias("role"),
            unescape(F.substr(x, F.locate(AFTER_ROLE, x) + len(AFTER_ROLE))).alias("text"),
        ),
    )


def trained_text(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the mask, as it was before formatting."""
    return unescape(F.substr(formatted, (start + 1).cast("int"), (end - start).cast("int")))


def digest(found: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its examples: turns, trainable text, size of the output."""
    seen = F.struct(F.col("example"), trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("t"))
    rows = found.groupBy(key).agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(seen)).alias("trained"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    turns = read_turns(F.col("whole"))
    listed = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    trained = F.concat_ws("", F.transform("trained", lambda x: x["t"]))
    return rows.select(
        key,
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )
