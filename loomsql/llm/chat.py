"""Chat formatting with Spark expressions only.

Turn structs are collected per conversation and sorted, adjacent turns of one role are merged into one block by array
functions, and the blocks are concatenated:

    <|im_start|>role\\ntext<|im_end|>\\n                      one turn
    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n        merged turns of one role

Control strings inside roles and texts are escaped reversibly: & becomes &amp;, then <| becomes &lt;| (and a line feed
in a role &#10;), so that <| stands only where the template puts it. `segments` cuts the formatted text into pieces
with a loss flag: exactly the texts of assistant turns are under the loss mask.

A conversation is one output row, so one task holds one conversation's turns; every step is linear in their length.
Defined results: a null text or role is an empty one; turns order by turn (null first), then role, then text, so ties
don't depend on partitioning; repeated rows stay, each as a turn; a null conv_id is a conversation of its own; an empty
table gives no rows; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END, LEARNT = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_blocks, formatted (string), segments (array of text, loss): one row per conversation."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    found = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # Where a block of one role starts, then the texts of each block.
    n = F.size("ts")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.col("ts")[i]["role"] != F.col("ts")[F.greatest(i - 1, F.lit(0))]["role"]))
    found = found.withColumn("starts", starts)
    block = lambda s, k: F.struct(
        F.col("ts")[s]["role"].alias("role"),
        F.transform(F.slice("ts", s + 1, F.coalesce(F.get("starts", k + 1), n) - s), lambda t: t["text"]).alias("texts"),
    )
    found = found.withColumn("blocks", F.transform("starts", block))
    pieces = lambda b: F.concat(
        F.array(F.struct(F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss"))),
        F.flatten(
            F.transform(
                b["texts"],
                lambda t, i: F.concat(
                    F.when(i > 0, F.array(F.struct(F.lit(SEP).alias("text"), F.lit(False).alias("loss")))).otherwise(F.array().cast("array<struct<text:string,loss:boolean>>")),
                    F.array(F.struct(escape(t).alias("text"), (b["role"] == LEARNT).alias("loss"))),
                ),
            )
        ),
        F.array(F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("loss"))),
    )
    found = found.select("conv_id", F.size("blocks").alias("n_blocks"), F.flatten(F.transform("blocks", pieces)).alias("segments"))
    return found.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse_formatted(formatted: Column) -> Column:
    """The turns that a formatted text holds: array of role, text."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    turns = lambda b: F.transform(
        F.split(F.regexp_replace(b, r"\A[^\n]*\n", ""), r"<\|im_sep\|>"),
        lambda t: F.struct(unescape_role(F.replace(F.substring_index(b, "\n", 1), F.lit(START), F.lit(""))).alias("role"), unescape(t).alias("text")),
    )
    return F.flatten(F.transform(blocks, turns))


def digest(turns: DataFrame) -> DataFrame:
    """What is read back from each formatted conversation: turns, loss text and lengths, as digests."""
    back = format_conversations(turns).withColumn("turns", parse_formatted(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_blocks").cast("long").alias("n_blocks"),
    )
