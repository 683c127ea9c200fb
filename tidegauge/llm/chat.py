"""Chat formatting with a loss mask, in SQL expressions only.

The template of a conversation is, for each run of turns of one role::

    <|im_start|>role\\ntext<|im_sep|>next text of the same role<|im_end|>\\n

Control strings cannot come from a text: each ``<|`` in it, with any number of backslashes
between, gets one backslash more, and loses it when it is read back. Roles are escaped likewise,
and their line ends too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    for plain, code in (("~", "~0"), ("\n", "~1"), ("|", "~2")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _unescape_role(role: Column) -> Column:
    for plain, code in (("|", "~2"), ("\n", "~1"), ("~", "~0")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``pieces``.

    ``pieces`` is the formatted string cut into an array of (text, loss) where loss marks what a
    model is trained on: the texts of the assistant's turns, without control strings. Turns are
    sorted by (turn, role, text), nulls first, so ties and repeated rows have a fixed place.
    Adjacent turns of one role are merged into one block, with a separator between the texts.
    A null text or role counts as empty, rows with a null ``conv_id`` form one conversation, other
    columns are not read, and an empty table gives no rows.

    Texts are escaped where they are read. As the result has one row per conversation, its turns
    meet in one task; that task only sorts and joins them, and the collection starts before the
    shuffle.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(_escape_role(F.col("role")), F.lit("")).alias("role"),
        F.coalesce(escape_text(F.col("text")), F.lit("")).alias("text"),
    )
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"))
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("t"))

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def head(x: Column, i: Column) -> Column:
        same = (i > 0) & (F.get(F.col("t"), i - 1)["role"] == x["role"])
        opened = F.concat(F.lit(START), x["role"], F.lit("\n"))
        return F.when(same, F.lit(SEP)).when(i == 0, opened).otherwise(F.concat(F.lit(END), opened))

    def parts(x: Column, i: Column) -> Column:
        return F.array(
            piece(head(x, i), F.lit(False)),
            piece(x["text"], x["role"] == F.lit("assistant")),
        )

    body = F.flatten(F.transform("t", parts))
    pieces = F.concat(body, F.array(piece(F.lit(END), F.lit(False))))
    framed = sorted_turns.select("conv_id", pieces.alias("pieces"))
    whole = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    return framed.select("conv_id", whole.alias("formatted"), "pieces")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds, in order."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda _, i: i > 0)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        size = F.char_length(block) - F.char_length(role) - len("\n" + END)
        body = F.substr(block, F.char_length(role) + 2, size)
        return F.transform(
            F.split(body, r"<\|im_sep\|>"),
            lambda t: F.struct(_unescape_role(role).alias("role"), unescape_text(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def masked_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    kept = F.filter(pieces, lambda p: p["loss"])
    return F.array_join(F.transform(kept, lambda p: unescape_text(p["text"])), "")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what is read back from formatted conversations."""
    back = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        masked_text(F.col("pieces")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
