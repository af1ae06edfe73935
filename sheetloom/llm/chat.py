"""Conversations rebuilt from event logs and formatted with a loss mask; built-in functions only.

A log has rows (conv_id, seq, message, kind, role, text): ``start`` opens a message and names its role,
``delta`` appends streamed text, ``edit`` replaces all text so far, ``regenerate`` discards it. The log is
partitioned by conversation and sorted by sequence; a message's final text is what its last start, edit or
regeneration holds together with the deltas after it.

The template writes ``<s>role`` newline ``text</s>`` for every message. In roles and texts a backslash, ``<``
and ``[`` become ``\\0``, ``\\1`` and ``\\2`` (in roles a line break ``\\3``), so no control string of this or
the usual instruction templates can occur inside them and every escape can be undone. The loss mask is a
list of (start, length) in code points: the assistant's texts without any markup.

Scale: one shuffle, by conversation. Events are folded per message and offsets are sums over a window, so
only rendering holds a whole conversation, which is one row of the result. Defined results: a null text or
delta is empty, a null role is an empty role, rows without a conversation form one of their own, messages
with equal numbers keep one order (by role and text); a message without a start has an empty role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
ASSISTANT = "assistant"
_ESCAPES = [("\\", "\\0"), ("<", "\\1"), ("[", "\\2")]
_BREAK = ("\n", "\\3")


def escape(text: Column, role: bool = False) -> Column:
    for plain, code in [*_ESCAPES, *([_BREAK] if role else [])]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    # an escaped backslash comes last: before that, every backslash begins a code
    for plain, code in [*([_BREAK] if role else []), *reversed(_ESCAPES)]:
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): final messages of an event log."""
    event = F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    log = events.repartition("conv_id").groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    last = F.array_max(F.transform(F.filter("log", lambda e: e.kind.isin("start", "edit", "regenerate")), lambda e: e.seq))
    kept = F.filter("log", lambda e: F.col("last").isNull() | (e.seq >= F.col("last")))
    roles = F.filter("log", lambda e: e.kind == "start")
    return log.withColumn("last", last).select(
        "conv_id", "message", F.coalesce(F.try_element_at(F.transform(roles, lambda e: e.role), F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(F.filter(kept, lambda e: e.kind.isin("delta", "edit")), lambda e: e.text), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of messages (conv_id, message, role, text)."""
    head = F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit("")), role=True), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    parts = messages.withColumn("head", head).withColumn("body", body)
    before = Window.partitionBy("conv_id").orderBy("message", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("message", "role", "text"))
    length = F.length("head") + F.length("body") + len(CLOSE)
    placed = parts.withColumn("before", F.coalesce(F.sum(length).over(before), F.lit(0))).withColumn("place", place)
    span = F.when(F.col("role") == ASSISTANT, F.struct((F.col("before") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    piece = F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), span.alias("span"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return whole.select("conv_id", F.array_join(F.transform("p", lambda x: x.piece), "").alias("formatted"),
                        F.filter(F.transform("p", lambda x: x.span), lambda s: s.isNotNull()).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    def turn(part):
        return F.struct(unescape(F.substring_index(F.substr(part, F.lit(len(OPEN) + 1)), "\n", 1), role=True).alias("role"),
                        unescape(F.substr(part, F.locate("\n", part) + 1)).alias("text"))

    return F.transform(F.filter(F.split(formatted, CLOSE), lambda p: p != ""), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s.start + 1).cast("int"), s.length.cast("int")))), "")


def as_events(rows: DataFrame) -> DataFrame:
    """An event log whose final messages are ``rows`` (conv_id, turn, role, text).

    Texts are streamed in two deltas. Every third message is first drafted and then edited; answers at even
    places are first written backwards and then regenerated.
    """
    numbered = rows.withColumn("message", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    first, rest = F.substr(text, F.lit(1), half), F.substr(text, half + 1)

    def event(k, kind, value):
        return F.struct((F.col("message").cast("long") * 8 + k).alias("seq"), F.lit(kind).alias("kind"), value.alias("text"))

    drafted = F.array(event(0, "start", F.lit("")), event(1, "delta", first), event(2, "edit", text))
    redone = F.array(event(0, "start", F.lit("")), event(1, "delta", F.reverse(text)), event(2, "regenerate", F.lit("")),
                     event(3, "delta", first), event(4, "delta", rest))
    streamed = F.array(event(0, "start", F.lit("")), event(1, "delta", first), event(2, "delta", rest))
    kinds = F.when(F.col("message") % 3 == 0, drafted).when((F.col("message") % 2 == 0) & (F.col("role") == ASSISTANT), redone).otherwise(streamed)
    return numbered.select("conv_id", "message", "role", F.inline(kinds))
