"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log has one row per event: conversation, sequence number, operation, message, role and
text. Operations: `message` opens a message with a text, `delta` appends streamed text,
`edit` replaces the text so far, `regenerate` empties the message and discards messages
opened after it and before the regeneration. Null or unknown operations count as
`message`. The log is dealt by conversation once; within it, events are folded to the
final message texts (text since the last event that replaced it, in sequence order),
messages are put in order of their opening and rendered with a template.

The template marks each turn; inside roles and texts the escape character and the two
characters with which control strings begin are replaced reversibly, so no control string
can occur there and rendering can be read back exactly. The loss mask is a list of
[start, end) code-point spans of the rendering, one for each assistant text.

Defined results: null text is empty; null role is an empty role; a null sequence number
comes first; a null conversation is a conversation of its own; events alike in order are
ordered by message, operation, role and text; repeated rows of `message` are turns of
their own; an empty log gives an empty result; other columns aren't carried over.
A conversation becomes one row, so it must fit into one (2 GB), as its hashes require.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, BODY = "<|im_start|>", "<|im_end|>\n", "\n"
LEARNED = "assistant"
#: What an escape stands for; no escape's second character is the escape character, so they can be undone one by one.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))
RESETS = ("edit", "regenerate")


def escape(c: Column, table=ESCAPES) -> Column:
    for plain, held in table:
        c = F.replace(c, F.lit(plain), F.lit(held))
    return c


def unescape(c: Column, table=ESCAPES) -> Column:
    for plain, held in reversed(table):
        c = F.replace(c, F.lit(held), F.lit(plain))
    return c


def from_turns(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """A log in which each turn is an event of its own."""
    return turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("seq"), F.lit("message").alias("op"), F.lit(None).cast("string").alias("message"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))


def messages(events: DataFrame) -> DataFrame:
    """The final messages: conv_id, place (order within the conversation), role, text."""
    op = F.when(F.col("op").isin("delta", *RESETS), F.col("op")).otherwise(F.lit("message"))
    log = events.select("conv_id", "seq", op.alias("op"), F.col("message").cast("string").alias("message"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    log = log.repartition("conv_id")  # the only exchange: all that follows is by conversation
    order = [F.col("seq").asc_nulls_first(), F.col("message"), F.col("op"), F.col("role"), F.col("text")]
    conv = Window.partitionBy("conv_id").orderBy(*order)
    log = log.withColumn("at", F.row_number().over(conv))
    # An event without a message id is a message of its own if it opens one, else it goes to the last one opened.
    log = log.withColumn("id", F.coalesce(F.concat(F.lit("m"), "message"), F.when(F.col("op") == "message", F.concat(F.lit("a"), F.col("at").cast("string")))))
    opened = F.last(F.when(F.col("op") == "message", F.col("id")), ignorenulls=True).over(conv.rowsBetween(Window.unboundedPreceding, -1))
    log = log.withColumn("id", F.coalesce("id", opened, F.concat(F.lit("a"), F.col("at").cast("string"))))
    whole = Window.partitionBy("conv_id", "id")
    reset = F.col("op").isin(*RESETS)
    log = log.withColumn("first", F.min("at").over(whole)).withColumn("base", F.coalesce(F.max(F.when(reset, F.col("at"))).over(whole), F.col("first")))
    # A message is discarded if a later regeneration is of a message opened before it.
    # The frame is of the events after this one, taken from the end, so that it grows by a row at a time.
    back = Window.partitionBy("conv_id").orderBy(F.desc("at"))
    log = log.withColumn("redone", F.min(F.when(F.col("op") == "regenerate", F.col("first"))).over(back.rowsBetween(Window.unboundedPreceding, -1)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("at") >= F.col("base"), F.struct("at", F.when(F.col("op") == "regenerate", F.lit("")).otherwise(F.col("text")).alias("text"))))), lambda x: x["text"]), "")
    return (
        log.groupBy("conv_id", "id", "first")
        .agg(text.alias("text"), F.min_by("role", "at").alias("role"), F.min_by("redone", "at").alias("redone"))
        .filter(F.col("redone").isNull() | (F.col("redone") >= F.col("first")))
        .select("conv_id", F.col("first").alias("place"), "role", "text")
    )


def render(final: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (array of struct start, stop: code points of the learned texts)."""
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(BODY))
    body = escape(F.col("text"))
    parts = final.select("conv_id", "place", head.alias("head"), body.alias("body"), (F.col("role") == LEARNED).alias("learned"))
    length = (F.char_length("head") + F.char_length("body") + len(CLOSE)).cast("long")
    parts = parts.withColumn("end", F.sum(length).over(Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.col("end") - len(CLOSE)
    span = F.when(F.col("learned"), F.struct((stop - F.char_length("body")).alias("start"), stop.alias("stop")))
    done = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("turn")))).alias("turns"), F.array_sort(F.collect_list(span)).alias("loss_spans"))
    return done.select("conv_id", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("formatted"), "loss_spans")


def format_chats(events: DataFrame) -> DataFrame:
    return render(messages(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted, with `turns` (array of struct role, text) parsed from the rendering and `learned` (the text under the loss mask, unescaped)."""
    pieces = F.filter(F.split("formatted", _quoted(CLOSE)), lambda x: x != "")
    turns = F.transform(pieces, lambda x: F.struct(unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), BODY, 1), ROLE_ESCAPES).alias("role"), unescape(F.substr(x, F.instr(x, BODY) + 1)).alias("text")))
    learned = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")
    return formatted.withColumn("turns", turns).withColumn("learned", learned)


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"


def digests(back: DataFrame) -> DataFrame:
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
