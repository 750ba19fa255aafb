"""Operator 5: conversations as budgeted, turn-aligned windows with a loss mask.

Each turn renders as ``### role`` newline ``text</turn>`` newline. Prefix sums of the rendered
turns' tokens cut a conversation into spans of whole turns. A window is the conversation's
system turn, a limited tail of the span before (history), then the span. Only assistant texts
of the span itself carry loss: the system turn and repeated history are masked.

Texts and roles are escaped so that no control string occurs inside them: a backslash becomes
``\\b``, ``###`` becomes ``\\h``, ``</turn>`` becomes ``\\e`` and, in roles, a new line ``\\n``.
Every backslash of an escaped text therefore starts one of these, and unescaping undoes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.llm.common import stored
from tidemark.llm.tokens import encoder, local_path

BUDGET = 1024
HISTORY = 128
START, END = "### ", "</turn>\n"
#: Fixed values of the format, in the order in which they are replaced.
_ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"))
_NEW_LINE = ("\n", "\\n")


def escaped(text: Column) -> Column:
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(_NEW_LINE[0]), F.lit(_NEW_LINE[1]))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(_NEW_LINE[1]), F.lit(_NEW_LINE[0])))


def _with_tokens(turns: DataFrame, tokenizer: str, spaces: str | None) -> DataFrame:
    """Turns plus ``tokens``: the ids of the rendered turn."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(local_path(tokenizer), spaces)
        for batch in batches:
            rendered = [h + b + END for h, b in zip(batch.column("head").to_pylist(), batch.column("body").to_pylist(), strict=True)]
            sizes = pa.array([len(x) // 4 for x in ids_of.encode(rendered)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], [*batch.schema.names, "tokens"])

    return turns.mapInArrow(count, T.StructType([*turns.schema, T.StructField("tokens", T.LongType())]))


def windows(
    conversations: DataFrame, tokenizer: str, spaces: str | None, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """``(conv_id, window, text, n_tokens, repeated, loss)`` of every conversation.

    Turns go by (turn, role, text); null roles and texts are empty, repeated rows stay. The
    system turn is the first turn, if its role is ``system``. With the room that a window has
    besides system turn and history, a span takes the turns that start in the same half room, so
    it never exceeds the room; a turn of more than half the room is a span by itself, and only
    such a turn can exceed the budget, as turns are not cut. ``repeated`` counts the turns at
    the window's start that another window holds, too; ``loss`` has (start, length) in code
    points of the escaped assistant texts that carry loss.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    turns = conversations.select(
        "conv_id",
        "turn",
        (role == "assistant").alias("answer"),
        (role == "system").alias("is_system"),
        F.concat(F.lit(START), _escaped_role(role), F.lit("\n")).alias("head"),
        escaped(text).alias("body"),
    )
    order = [F.col("conv_id"), F.col("turn"), F.col("head"), F.col("body")]
    conv = Window.partitionBy("conv_id").orderBy(*order[1:])
    before = conv.rowsBetween(Window.unboundedPreceding, -1)
    counted = stored(_with_tokens(turns, tokenizer, spaces), "chat-turns")  # read more than once, encoded once
    numbered = (
        counted.withColumn("pos", F.row_number().over(conv))
        .withColumn("first", (F.col("pos") == 1) & F.col("is_system"))
        .withColumn("sys_tokens", F.max(F.when(F.col("first"), F.col("tokens"))).over(conv.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("sys_tokens", F.coalesce("sys_tokens", F.lit(0)))
        .withColumn("half", F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.col("sys_tokens")) / 2)))
        .withColumn("own", F.when(F.col("first"), F.lit(0)).otherwise(F.col("tokens")))
        .withColumn("start", F.coalesce(F.sum("own").over(before), F.lit(0)))
        .withColumn("big", F.col("own") > F.col("half"))
        .withColumn("cell", F.floor(F.col("start") / F.col("half")))
    )
    prev = lambda c: F.lag(c).over(conv)
    opens = (
        F.col("first") | prev("pos").isNull() | prev("first") | F.col("big") | prev("big") | (F.col("cell") != prev("cell"))
    )
    tail = Window.partitionBy("conv_id", "span").orderBy(F.col("pos").desc())
    spanned = (
        numbered.withColumn("span", F.sum(opens.cast("long")).over(conv.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("to_end", F.sum("tokens").over(tail.rowsBetween(Window.unboundedPreceding, 0)))
    )
    last = Window.partitionBy("conv_id").orderBy(F.col("pos").desc())
    has_next = F.max("span").over(last.rowsBetween(Window.unboundedPreceding, 0)) > F.col("span")
    as_target = F.struct(F.col("span").alias("window"), F.lit(False).alias("again"))
    as_history = F.struct((F.col("span") + 1).alias("window"), F.lit(True).alias("again"))
    keeps = (F.col("to_end") <= history) & F.col("has_next")
    own_rows = spanned.withColumn("has_next", has_next).where(~F.col("first")).withColumn(
        "_w", F.explode(F.when(keeps, F.array(as_target, as_history)).otherwise(F.array(as_target)))
    )
    per_window = own_rows.groupBy("conv_id", F.col("_w.window").alias("window")).agg(
        F.sort_array(
            F.collect_list(F.struct("pos", F.col("_w.again").alias("again"), "head", "body", "answer", "tokens"))
        ).alias("turns")
    )
    system = spanned.where("first").select(
        F.col("conv_id").alias("_c"), F.struct("pos", F.lit(True).alias("again"), "head", "body", "answer", "tokens").alias("sys")
    )
    # The first window holds the system turn as its own; a lone system turn is a window, too.
    paired = per_window.join(system, F.col("conv_id").eqNullSafe(F.col("_c")), "full")
    first_window = F.min("window").over(Window.partitionBy(F.coalesce("conv_id", "_c")))
    sys_turn = F.when(
        F.col("sys").isNotNull(),
        F.array(F.col("sys").withField("again", F.coalesce(F.col("window") != first_window, F.lit(False)))),
    )
    all_turns = F.concat(F.coalesce(sys_turn, F.slice("turns", 1, 0), F.array()), F.coalesce("turns", F.slice(sys_turn, 1, 0)))
    return _rendered(
        paired.select(
            F.coalesce("conv_id", "_c").alias("conv_id"), F.coalesce("window", F.lit(1)).cast("long").alias("window"), all_turns.alias("turns")
        )
    )


def _rendered(built: DataFrame) -> DataFrame:
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + F.lit(len(END))
    marked = built.withColumn(
        "_at",
        F.aggregate(
            "turns",
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")),
            lambda acc, t: F.struct(
                (acc["at"] + size(t)).alias("at"),
                F.when(
                    t["answer"] & ~t["again"],
                    F.concat(
                        acc["loss"],
                        F.array(F.struct((acc["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))),
                    ),
                )
                .otherwise(acc["loss"])
                .alias("loss"),
            ),
        ),
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return marked.select(
        "conv_id",
        "window",
        text.alias("text"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.size(F.filter("turns", lambda t: t["again"])).alias("repeated"),
        F.col("_at.loss").alias("loss"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Windows plus ``turns``, the (role, text) that are the window's own, and ``loss_text``."""
    pieces = F.split(F.col("text"), "</turn>\n", -1)
    own = F.slice(pieces, F.col("repeated") + 1, F.greatest(F.size(pieces) - 1 - F.col("repeated"), F.lit(0)))
    turn = lambda p: F.struct(
        _unescaped_role(F.substring_index(p, "\n", 1).substr(F.lit(len(START) + 1), F.length(p))).alias("role"),
        unescaped(p.substr(F.instr(p, "\n") + 1, F.length(p))).alias("text"),
    )
    lost = F.transform("loss", lambda s: unescaped(F.col("text").substr(s["start"] + 1, s["length"])))
    return formatted.withColumns({"turns": F.transform(own, turn), "loss_text": F.array_join(lost, "")})


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows give back: counts and digests of turns and loss text."""
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read_turns(formatted).select(
        "conv_id", "window", F.size("turns").alias("n"), body.alias("body"), "loss_text", F.length("text").alias("chars")
    )
    grouped = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "body", "loss_text"))).alias("w"),
        F.sum("n").cast("long").alias("n_turns"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    turns = F.array_join(F.transform("w", lambda w: w["body"]), "")
    loss = F.array_join(F.transform("w", lambda w: w["loss_text"]), "")
    return grouped.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def write_windows(formatted: DataFrame) -> DataFrame:
    """The windows as written to and read from the shared folder."""
    return stored(formatted, "chat-windows")


def probe_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts imitate the template."""
    odd = "\\### Assistant: </turn> ok"
    return spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
