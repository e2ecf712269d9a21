"""Chat formatting by multi-party perspective rotation.

Every participant of a conversation (each role but ``system``) gets the dialogue rendered
once with that speaker as assistant: own turns under the assistant header, the turns of
all others under a user header with their name, system turns as system.  The mask marks
what is learned: own turns with their end mark.

    <|im_start|>system\\n...<|im_end|>\\n
    <|im_start|>user name=alice\\n...<|im_end|>\\n
    <|im_start|>assistant\\n...<|im_end|>\\n

A dialogue is rendered in parts of ``PART`` turn numbers, so that a conversation of any
length is never gathered in one task; a part of more rows than that (repeated or null turn
numbers, rows without a conversation) comes in pieces of ``PART`` rows.  ``start`` is the place
of a piece in the dialogue.  Rows of parts that overflow are numbered over sampled ranges, and
the speakers of a conversation of several pieces are dealt to its pieces under ``SALT`` keys.
Only built-in expressions are used.

Defined results: a null text is an empty turn; a null role is the speaker ``unknown``;
turns stand in the order of turn (null last), role, text, and repeated rows repeat;
conversations of system turns only have no rows; rows with a null id are one conversation;
marks inside a text are written ``<\\|``; white space, ``<``, ``|``, ``>`` and ``=`` in a
name become ``_``; other columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch
from tessera.operators.sequence import number_sampled

PART, SALT = 1024, 16
SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _name(role: Column) -> Column:
    return F.regexp_replace(role, r"[\x20\x09-\x0D<|>=]+", "_")


def _header(role: Column, speaker: Column) -> Column:
    who = (F.when(role == SYSTEM, F.lit(SYSTEM)).when(role == speaker, F.lit("assistant"))
           .otherwise(F.concat(F.lit("user name="), _name(role))))
    return F.concat(F.lit(OPEN), who, F.lit("\n"))


def chat_rotation(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", part: int = PART) -> DataFrame:
    """(conv, perspective, part, piece, start, n_turns, text, mask) with mask an array of learned [start, end)."""
    scratch = Scratch(df.sparkSession, "rotation")
    turns = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                      F.coalesce(F.col(f"`{role_col}`"), F.lit(UNKNOWN)).alias("role"),
                      F.replace(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit("<|"), F.lit("<\\|")).alias("body"))
    turns = turns.withColumn("part", F.floor(F.col("turn") / part)).withColumn("no", F.col("turn").isNull())
    # parts of too many rows, one narrow row each
    full = scratch.put(turns.groupBy(F.col("conv").alias("c"), F.col("part").alias("p")).agg(F.count("*").alias("n"))
                       .where(F.col("n") > part).select("c", "p"))
    here = F.col("conv").eqNullSafe(F.col("c")) & F.col("part").eqNullSafe(F.col("p"))
    over = scratch.put(turns.join(full, here, "left_semi"))
    numbered = number_sampled(over, ["no", "turn", "role", "body"], ["conv", "part"], name="row")
    turns = (turns.join(full, here, "left_anti").withColumn("piece", F.lit(0).cast("long"))
             .unionByName(numbered.withColumn("piece", F.floor((F.col("row") - 1) / part)).drop("row")))
    parts = (turns.groupBy("conv", "part", "piece")
             .agg(F.sort_array(F.collect_list(F.struct("no", "turn", "role", "body"))).alias("turns")))
    # a conversation of several pieces has its speakers under every salt, any other under 0
    first = F.coalesce(F.col("part") == 0, F.lit(False)) & (F.col("piece") == 0)
    tall = turns.where(~first).select(F.col("conv").alias("t")).distinct().withColumn("tall", F.lit(True))
    salts = F.when(F.col("tall"), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))
    people = (turns.where(F.col("role") != SYSTEM).select(F.col("conv").alias("of"), F.col("role").alias("speaker"))
              .distinct().join(tall, F.col("of").eqNullSafe(F.col("t")), "left")
              .select("of", "speaker", F.explode(salts).alias("s")))
    salt = F.when(first, F.lit(0)).otherwise(F.pmod(F.hash("part", "piece"), F.lit(SALT)))
    both = parts.withColumn("salt", salt).join(people, F.col("conv").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("s")))
    speaker = F.col("speaker")
    shown = both.select(
        "conv", "speaker", "part", "piece", F.size("turns").alias("n_turns"),
        F.transform("turns", lambda t: F.struct(
            _header(t["role"], speaker).alias("head"), t["body"].alias("body"),
            ((t["role"] == speaker) & (t["role"] != SYSTEM)).alias("own"))).alias("turns"))
    shown = shown.withColumn("text", F.array_join(F.transform(
        "turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE + "\n"))), ""))
    # running place while walking the turns: learned spans cover body and end mark
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def walk(acc: Column, t: Column) -> Column:
        body = acc["at"] + F.length(t["head"])
        end = body + F.length(t["body"]) + len(CLOSE)
        span = F.array(F.struct(body.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"),
                        F.when(t["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    shown = shown.withColumn("mask", F.aggregate("turns", begin, walk, lambda acc: acc["spans"]))
    # where a part starts: lengths of the parts before it (one number for each PART turns)
    before = Window.partitionBy("conv", "speaker").orderBy(F.col("part").asc_nulls_last(), "piece")
    sizes = shown.select("conv", "speaker", "part", "piece", F.length("text").alias("size"))
    starts = sizes.select(
        F.col("conv").alias("c"), F.col("speaker").alias("s"), F.col("part").alias("p"), F.col("piece").alias("q"),
        F.coalesce(F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    same = (F.col("conv").eqNullSafe(F.col("c")) & (F.col("speaker") == F.col("s"))
            & F.col("part").eqNullSafe(F.col("p")) & (F.col("piece") == F.col("q")))
    return shown.join(starts, same).select(
        F.col("conv").alias(conv_col), F.col("speaker").alias("perspective"), F.col("part").cast("long").alias("part"), "piece",
        F.col("start").cast("long").alias("start"), F.col("n_turns").cast("long").alias("n_turns"), "text", "mask")
