"""Chat formatting in Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of one role
share a block; array functions join everything. Controls are ``<|turn|>``, ``<|more|>``,
``<|end|>`` and ``<|line|>``. In roles and texts every ``<`` + backslashes + ``|`` gets
one backslash more, so no text holds a control, and reading takes that backslash away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, MORE, END, LINE = "<|turn|>", "<|more|>", "<|end|>", "<|line|>"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per conversation: id, formatted, loss_runs (run lengths of the loss mask
    over ``formatted``, in code points, alternating as their flag says).

    Null texts and roles are empty; a null turn number comes first; ties of the turn
    number order by role, then text; repeated rows are repeated turns; a null id is a
    conversation of its own; an empty table gives no rows; other columns are ignored.
    Adjacent turns of one role stand in one block, parted by a control, so that the
    turns can be read back. One conversation's turns must fit a row, as its output does.
    """
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col)]
    turn = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    sorted_turns = turns.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def piece(x: Column, i: Column) -> Column:
        same = (i > 0) & (F.get("turns", i - 1)["role"] == x["role"])
        opened = F.concat(F.when(i > 0, F.lit(f"{END}\n")).otherwise(F.lit("")), F.lit(TURN),
                          F.replace(escaped(x["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
        return F.struct(F.when(same, F.lit(MORE)).otherwise(opened).alias("head"), escaped(x["text"]).alias("body"),
                        (x["role"] == LOSS_ROLE).alias("loss"))

    pieces = sorted_turns.select("id", F.transform("turns", piece).alias("pieces"))
    whole = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), ""), F.lit(f"{END}\n"))

    def run(chars: Column, loss: Column) -> Column:
        return F.struct(chars.cast("long").alias("chars"), loss.alias("loss"))

    runs = F.flatten(F.transform("pieces", lambda p: F.array(run(F.length(p["head"]), F.lit(False)),
                                                             run(F.length(p["body"]), p["loss"]))))
    tail = F.array(run(F.lit(len(END) + 1), F.lit(False)))
    return pieces.select(F.col("id").alias(id_col), whole.alias("formatted"), F.concat(runs, tail).alias("loss_runs"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs that a formatted conversation holds, in order."""
    blocks = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        size = F.length(block) - F.length(role) - 1 - (len(END) + 1)
        body = block.substr(F.length(role) + 2, size)
        name = unescaped(F.replace(role, F.lit(LINE), F.lit("\n")))
        return F.transform(F.split(body, r"<\|more\|>"), lambda t: F.struct(name.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def digest(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted conversations say when read back, as counts and digests. The loss
    text is what stands under the mask, piece by piece, whatever role it was said in."""
    back = formatted.select("*", read_turns(F.col("formatted")).alias("back"))
    said = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    start = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<string>").alias("under"))

    def further(a: Column, r: Column) -> Column:
        piece = F.col("formatted").substr(a["at"].cast("int"), r["chars"].cast("int"))
        return F.struct((a["at"] + r["chars"]).alias("at"), F.when(r["loss"], F.concat(a["under"], F.array(piece)))
                        .otherwise(a["under"]).alias("under"))

    loss = F.array_join(F.transform(F.aggregate("loss_runs", start, further)["under"], unescaped), "")
    masked = F.aggregate(F.filter("loss_runs", lambda r: r["loss"]), F.lit(0).cast("long"), lambda a, r: a + r["chars"])
    return back.select(id_col, F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), masked.alias("masked_chars"))
