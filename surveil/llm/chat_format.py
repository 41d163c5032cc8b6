"""Chat formatting by event-sourced reconstruction (DataFrame functions only).

A chat log is a table of events, not of messages: replies arrive as streamed
deltas, users edit what they sent, replies are regenerated, messages are
deleted.  Columns: ``conv_id``, ``message`` (place of the message in its
conversation), ``seq`` (order of the events of a message), ``event``, ``role``
and ``text``.

=============  ==================================================
``open``       the message begins; carries its role
``delta``      text is appended
``edit``       the message's whole text is replaced
``regenerate`` the text so far is thrown away
``delete``     the message is withdrawn, unless it is opened again
=============  ==================================================

``fold_events`` folds the events of one message (never those of a whole
conversation) into its final role and text, so a conversation that holds a
third of all events is spread over its messages.  ``render`` then writes one
string per conversation, with the spans of its turns and of the text under the
loss mask; ``read_back`` recovers the turns from that string and those spans.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline.  Control strings
inside texts and roles are made harmless reversibly: every ``<``, backslashes, ``|``
gets one more backslash before the bar, and a role's ``%`` and newline become
``%25`` and ``%0A``.

Defined cases: null texts and roles are empty; a null ``conv_id`` is a
conversation of its own and a null ``message`` comes first; repeated or tied
rows are separate turns, ordered by role and text; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fold_events(events: DataFrame) -> DataFrame:
    """The final messages of an event log: ``conv_id``, ``message``, ``copy``, ``role``, ``text``.

    Events of one message are sorted by ``seq``; those up to the last reset
    (edit, regenerate, delete) are dead except for the text of an edit.
    """
    entry = F.struct(F.coalesce("seq", F.lit(0)).alias("seq"), "event", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    message = events.groupBy("conv_id", "message", "copy").agg(F.sort_array(F.collect_list(entry)).alias("log"))
    last = lambda *kinds: F.coalesce(
        F.array_max(F.transform(F.filter("log", lambda e: e["event"].isin(*kinds)), lambda e: e["seq"])), F.lit(-1))
    message = message.withColumn("_reset", last("edit", "regenerate", "delete")).withColumn("_opened", last("open")).withColumn("_deleted", last("delete"))
    alive = F.filter("log", lambda e: (e["event"].isin("delta", "edit")) & (e["seq"] >= F.col("_reset")))
    opened = F.filter("log", lambda e: e["event"] == "open")
    return message.filter(F.col("_deleted") <= F.col("_opened")).select(
        "conv_id", "message", "copy", F.coalesce(F.try_element_at(opened, F.lit(-1))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(alive, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``spans`` (code points) of each turn.

    A span holds the turn's start and length, and the start and length of its
    text under the loss mask (length 0: none).
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = messages.select("conv_id", "message", "copy", "role", head.alias("_head"), body.alias("_body"))
    turns = turns.select("conv_id", "message", "copy", F.concat("_head", "_body", F.lit(END + "\n")).alias("turn"),
                         F.char_length("_head").cast("long").alias("_before"),
                         F.when(F.col("role") == LOSS_ROLE, F.char_length("_body")).otherwise(0).cast("long").alias("_loss"))
    turns = turns.withColumn("_size", F.char_length("turn").cast("long"))
    order = Window.partitionBy("conv_id").orderBy("message", "copy")
    place = F.row_number().over(order).alias("place")
    start = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")
    placed = turns.select("conv_id", "turn", "_size", "_before", "_loss", place, start)
    entry = F.struct("place", "turn", "start", F.col("_size").alias("length"), (F.col("start") + F.col("_before")).alias("loss_start"),
                     F.col("_loss").alias("loss_length"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    return whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
                        F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"),
                                                                t["loss_start"].alias("loss_start"),
                                                                t["loss_length"].alias("loss_length"))).alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` (role and text, recovered from the string), ``loss`` (texts under the mask), ``formatted``."""
    # every turn ends with END and a newline, and no text holds END, so the last piece is empty
    pieces = formatted.withColumn("_pieces", F.split("formatted", r"<\|im_end\|>\n", -1))
    pieces = pieces.withColumn("_pieces", F.slice("_pieces", F.lit(1), F.size("_pieces") - 1))
    inner = lambda p: F.substring(p, F.lit(len(START) + 1), F.char_length(p))
    turn = lambda p: F.struct(
        unescape_role(F.substring_index(inner(p), "\n", 1)).alias("role"),
        unescape(F.substring(inner(p), F.locate("\n", inner(p)) + 1, F.char_length(p))).alias("text"))
    masked = lambda p, i: unescape(F.substring(
        p, (F.col("spans")[i]["loss_start"] - F.col("spans")[i]["start"] + 1).cast("int"), F.col("spans")[i]["loss_length"].cast("int")))
    return pieces.select("conv_id", F.transform("_pieces", turn).alias("turns"), F.transform("_pieces", masked).alias("loss"), "formatted")


def conversation_events(conversations: DataFrame, delta: int = 200) -> DataFrame:
    """The event log that streaming these finished messages would have left.

    Every message is opened and streamed in deltas of ``delta`` code points.
    A reply was first streamed otherwise (its first delta) and regenerated; any
    other message of more than one delta was first sent short and then edited.
    """
    text = F.coalesce("text", F.lit(""))
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = conversations.select("conv_id", F.col("turn").alias("message"), copy.alias("copy"),
                                F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    starts = F.sequence(F.lit(1), F.greatest(F.char_length("text"), F.lit(1)), F.lit(delta))
    event = lambda seq, kind, role, body: F.struct(
        seq.cast("long").alias("seq"), F.lit(kind).alias("event"), role.alias("role"), body.alias("text"))
    none = F.lit(None).cast("string")
    first = F.substring(F.col("text"), 1, delta)
    streamed = F.transform(starts, lambda s, i: event(i + 3, "delta", none, F.substring(F.col("text"), s, F.lit(delta))))
    opened = F.array(event(F.lit(0), "open", F.col("role"), none), event(F.lit(1), "delta", none, first))
    reply = F.concat(opened, F.array(event(F.lit(2), "regenerate", none, none)), streamed)
    other = F.concat(opened, F.array(event(F.lit(2), "edit", none, F.col("text"))))
    log = F.when(F.col("role") == LOSS_ROLE, reply).otherwise(other)
    return rows.select("conv_id", "message", "copy", F.explode(log).alias("e")).select("conv_id", "message", "copy", "e.*")
