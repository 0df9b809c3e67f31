"""Chat formatting by event-sourced reconstruction.

A log holds events (conversation, sequence number, message number, event, role,
text).  Per message the events are folded in sequence order: ``message`` opens
the text, ``delta`` appends to it, ``edit`` replaces it, ``regenerate`` empties
it and withdraws what came before for every later message: events of those count
only from there on, and a message left without events is gone.  The folded
messages are rendered in message order.

Template: every turn is ``<|turn|>role<|text|>text<|end|>``.  Inside roles and
texts a backslash is doubled, and every control string of ``CONTROL`` gets a
backslash after its first character, so that no text can open or close a turn;
``unescaped`` takes both back.  The loss mask lists the assistant texts as byte
spans (start, bytes) of the formatted UTF-8 text.

All steps are DataFrame functions.  Events are folded by (conversation, message),
which spreads a conversation that holds a third of all rows.  Where a message's
events begin to count is found from (conversation, message, sequence number)
rows of the regenerations, without texts.  The texts of a conversation meet in one
task only where they become one value of the result: in ``render``, and in
``as_log``, which puts the rows of a conversation in order.

Defined results: null role and null text count as empty; a null conversation id
is a conversation of its own; exactly repeated events count once (logs are
delivered at least once); events with equal sequence numbers are ordered by
event, then text; an unknown event kind acts as ``delta``; null sequence or
message numbers come first; an empty log gives an empty table; further columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of this template and of common others.
CONTROL = (TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
           "<<SYS>>", "<</SYS>>")
_RESTS = {first: "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == first) for first in "<["}
_ESCAPE = "|".join(f"(?<={re.escape(first)})(?={rests})" for first, rests in _RESTS.items())

EVENTS = ("conv_id", "seq", "message", "event", "role", "text")


def escaped(text: Column) -> Column:
    """Backslashes doubled, one backslash after the first character of a control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _ESCAPE, "\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, "\\\\(\\\\?)", "$1")


def _cuts(events: DataFrame) -> DataFrame:
    """(conv_id, message, cut) of the messages after a regenerated one: the last
    sequence number at which an earlier message was regenerated."""
    heads = (events.groupBy("conv_id", "message")
             .agg(F.max(F.when(F.col("event") == "regenerate", F.col("seq"))).alias("again")))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("message").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return heads.withColumn("cut", F.max("again").over(earlier)).where(F.col("cut").isNotNull()).select(
        F.col("conv_id").alias("_conv"), F.col("message").alias("_message"), "cut")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of an event log."""
    e = events.select(*EVENTS).withColumn("text", F.coalesce("text", F.lit("")))
    opens = F.col("event").isin("message", "edit", "regenerate")
    item = F.struct(F.col("seq"), F.col("event"), F.col("text"), F.col("role"))
    cuts = _cuts(events)
    counting = (e.join(cuts, e["conv_id"].eqNullSafe(cuts["_conv"]) & e["message"].eqNullSafe(cuts["_message"]), "left")
                .where(F.col("cut").isNull() | (F.col("seq") > F.col("cut"))).select(*EVENTS))
    folded = (counting.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_set(item)).alias("log"),
        F.max(F.when(opens, F.col("seq"))).alias("base")))
    live = F.filter("log", lambda x: F.col("base").isNull() | (x["seq"] >= F.col("base")))
    texts = F.aggregate(
        live, F.lit(""),
        lambda acc, x: F.when(x["event"].isin("message", "edit"), x["text"])
        .when(x["event"] == "regenerate", F.lit("")).otherwise(F.concat(acc, x["text"])))
    roles = F.filter(F.transform("log", lambda x: x["role"]), lambda r: r.isNotNull())
    return folded.select("conv_id", "message", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                         texts.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of final messages."""
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    head = F.concat(F.lit(TURN), role, F.lit(TEXT))
    before = Window.partitionBy("conv_id").orderBy(F.col("message").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    pieces = (messages
              .select("conv_id", "message", "role", head.alias("head"), text.alias("body"))
              .withColumn("start", F.coalesce(F.sum(F.octet_length("head") + F.octet_length("body")
                                                    + len(END)).over(before), F.lit(0)) + F.octet_length("head")))
    turn = F.struct("message", F.concat("head", "body", F.lit(END)).alias("piece"), F.col("role"),
                    F.col("start").cast("long").alias("start"), F.octet_length("body").cast("long").alias("bytes"))
    turns = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["role"] == "assistant"),
                    lambda t: F.struct(t["start"].alias("start"), t["bytes"].alias("bytes"))).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of a formatted text."""
    def turn(seg: Column) -> Column:
        role = F.substring_index(seg, TEXT, 1)
        body = F.substring_index(F.substring(seg, F.char_length(role) + len(TEXT) + 1, F.char_length(seg)), END, 1)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))
    segments = F.split(formatted, re.escape(TURN))
    return F.transform(F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0))), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped.  The text is turned into bytes
    once (bound as a lambda variable), so each span costs its own length."""
    def cut(raw: Column) -> Column:
        return F.array_join(F.transform(
            spans, lambda s: unescaped(F.decode(F.substring(raw, (s["start"] + 1).cast("int"), s["bytes"].cast("int")),
                                                "UTF-8"))), "")
    return F.transform(F.array(formatted.cast("binary")), cut)[0]


def format_log(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of an event log."""
    return render(fold(events))


def as_log(conversations: DataFrame) -> DataFrame:
    """The log that could have led to a table of turns, numbered by turn: every
    assistant turn is opened, streams a draft, is regenerated and streams its text
    in two deltas; every other turn is opened with its first half only, which an
    edit and a delta turn into the whole text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = (conversations.select("conv_id", "turn", "role", "text")
            .withColumn("message", F.row_number().over(order).cast("long"))
            .select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("half", F.floor(F.char_length("text") / 2).cast("int")))
    first, second = F.expr("left(text, half)"), F.expr("substr(text, half + 1)")

    def event(k: int, kind: str, text: Column, role: Column | None = None) -> Column:
        return F.struct((F.col("message") * 8 + k).alias("seq"), F.lit(kind).alias("event"),
                        (F.lit(None).cast("string") if role is None else role).alias("role"), text.alias("text"))
    nothing = F.lit("")
    assistant = F.array(event(0, "message", nothing, F.col("role")), event(1, "delta", first), event(2, "regenerate", nothing),
                        event(3, "delta", first), event(4, "delta", second))
    other = F.array(event(0, "message", second, F.col("role")), event(1, "edit", first), event(2, "delta", second))
    return (rows.select("conv_id", "message", F.explode(F.when(F.col("role") == "assistant", assistant).otherwise(other)).alias("e"))
            .select("conv_id", "e.seq", "message", "e.event", "e.role", "e.text"))


CHALLENGE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tables import read
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CHALLENGE).alias("text"))
    out = format_log(as_log(rows.unionByName(extra)))
    turns, loss = read_back(F.col("formatted")), loss_text(F.col("formatted"), F.col("loss_spans"))
    return (out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                                               F.lit("\n"))), ""), 256)
                    .alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars")))


_CONTROL_RE2 = "|".join(re.escape(c) for c in CONTROL).replace("'", "''")

SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CHALLENGE}' UNION ALL SELECT -1, 1, 'assistant', '{CHALLENGE}'),
sized AS (
  SELECT *, length(role) + length(text) + {len(TURN + TEXT + END)}
            + length(role || text) - length(replace(role || text, '\\', ''))
            + len(regexp_extract_all(role, '{_CONTROL_RE2}')) + len(regexp_extract_all(text, '{_CONTROL_RE2}')) AS chars
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
