"""Chat formatting from event logs.

A log holds what happened to the messages of a conversation: they are started, streamed in pieces, edited and
regenerated. Logs are dealt out by conversation and message, sorted by sequence and folded into the final messages.
Messages are rendered with a template that marks turns and escapes its own marks in texts, and put
together to conversations, with the spans of the text that a model is to learn from.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, bounded_batches

#: Fixed values of the template: a turn is OPEN, its role, a line end, its text, CLOSE and a line end.
OPEN, CLOSE = "<turn>", "</turn>"
#: What an escape sequence stands for; `<` is escaped in marks only, a line end in roles only.
ESCAPES = {"\\\\": "\\", "\\l": "<", "\\n": "\n"}
LEARNED = "assistant"
#: A conversation goes on in a further row after about so many characters.
PART_CHARS = 4_000_000
#: Code points of a streamed piece, and bits of a piece's number within its message, where a log is made of whole messages.
PIECE, PIECE_BITS = 512, 24

_PARSED = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + r"\n", re.S)
_ESCAPED = re.compile(r"\\[\\ln]")


def events_of(messages: DataFrame) -> DataFrame:
    """The log of messages (conv_id, place, role, text) that were streamed whole: a start, and pieces in order."""
    pieces = F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda x, i: F.struct(
        (i + 1).cast("long").alias("k"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), x.alias("text")))
    start = F.array(F.struct(F.lit(0).cast("long").alias("k"), F.lit("start").alias("kind"), F.col("role"), F.lit(None).cast("string").alias("text")))
    d = messages.select("conv_id", F.col("place").alias("turn"), F.inline(F.concat(start, pieces)))
    return d.select("conv_id", (F.shiftleft("turn", PIECE_BITS) + F.col("k")).alias("seq"), "kind", "turn", "role", "text")


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the messages that a log (conv_id, seq, kind, turn, role, text) leaves.

    In the order of `seq`: `start` begins the message of a turn anew, with its role; `delta` adds its text; `edit` replaces
    the text; `regenerate` empties the text and drops all later turns of the conversation, which may be started again.
    Text on a start counts. The role is the last one given; a message without a role has the role ''. Pieces without
    a start begin a message. Other kinds and a null kind are ignored, null text is empty, a null seq comes first, and a null
    conv_id or turn is a value like others, before all others. An event that is logged twice, all columns equal, counts
    once; other events with equal seq are taken in the order of kind, role and text. An empty log gives no message.

    What a regeneration drops is found on the log without its texts, message by message. Texts are dealt
    out by conversation and turn, so a conversation with a third of all events is spread over its messages.
    """
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID)).alias(c)
    log = events.filter(F.col("kind").isin("start", "delta", "edit", "regenerate")).select(
        number("conv_id"), number("seq"), "kind", number("turn"), "role", "text")
    again = log.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"))
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    cuts = again.select("conv_id", "turn", F.max("again").over(earlier).alias("cut")).filter(F.col("cut").isNotNull())
    alive = log.join(cuts, ["conv_id", "turn"], "left").filter(F.col("cut").isNull() | (F.col("seq") > F.col("cut")))
    folded = alive.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_set(F.struct("seq", "kind", "role", "text"))).alias("log"))
    begin = F.array_max(F.transform("log", lambda x, i: F.when(x["kind"] != "delta", i).otherwise(0)))
    texts = F.transform(F.slice("log", begin + 1, F.size("log")), lambda x: F.when(x["kind"] == "regenerate", "").otherwise(F.coalesce(x["text"], F.lit(""))))
    roles = F.filter(F.transform("log", lambda x: x["role"]), lambda r: r.isNotNull())
    return folded.select("conv_id", "turn", F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"), F.array_join(texts, "").alias("text"))


def escaped(text: Column) -> Column:
    """`text` without marks: reversible, as a backslash is doubled first."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in (OPEN, CLOSE):
        text = F.replace(text, F.lit(mark), F.lit("\\l" + mark[1:]))
    return text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: ESCAPES[m[0]], text)


def rendered(found: DataFrame) -> DataFrame:
    """`found` messages (conv_id, turn, role, text) as (conv_id, turn, formatted, start, stop): the turn as the template
    shows it, and the code points in it to learn from, null for roles other than LEARNED."""
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    d = found.select("conv_id", "turn", head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == LEARNED).alias("learned"))
    start = F.char_length("head")
    return d.select("conv_id", "turn", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("formatted"),
                    F.when(F.col("learned"), start).alias("start"), F.when(F.col("learned"), start + F.char_length("body")).alias("stop"))


def conversations(pieces: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, formatted, loss): rendered turns put together in order; `loss` lists (start, stop) in code points.

    A conversation is one row, of part 0; one of more than `part_chars` goes on in parts 1, 2, ..., which begin at a turn, so
    no row and no task holds more than that and one turn. conv_id is not null here.
    """
    bounded_batches(pieces.sparkSession)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, part, texts, spans, size = None, 0, [], [], 0
        for batch in batches:
            out = []
            for c, text, start, stop in zip(*[batch[x] for x in ("conv_id", "formatted", "start", "stop")]):
                if texts and (c != conv or size >= part_chars):
                    out.append((conv, part, "".join(texts), spans))
                    part, texts, spans, size = part + 1, [], [], 0
                if c != conv:
                    conv, part = c, 0
                if start >= 0:
                    spans.append({"start": size + start, "stop": size + stop})
                texts.append(text)
                size += len(text)
            yield pd.DataFrame(out, columns=["conv_id", "part", "formatted", "loss"])
        if texts:
            yield pd.DataFrame([(conv, part, "".join(texts), spans)], columns=["conv_id", "part", "formatted", "loss"])

    whole = lambda c: F.coalesce(F.col(c), F.lit(-1)).cast("long").alias(c)
    return (pieces.select("conv_id", "turn", "formatted", whole("start"), whole("stop"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn").drop("turn")
            .mapInPandas(packed, "conv_id long, part long, formatted string, loss array<struct<start:long,stop:long>>"))


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    found, at = [], 0
    for m in _PARSED.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn begins at {at}")
        at = m.end()
        found.append((unescaped(m[1]), unescaped(m[2])))
    if at != len(formatted):
        raise ValueError(f"no turn begins at {at}")
    return found


def read_back(formatted: DataFrame) -> DataFrame:
    """What is read from conversations (conv_id, part, formatted, loss), one row each: n_turns; turns_sha256, of role, line end,
    text, line end of each turn; loss_chars and loss_sha256, of the unescaped text under the mask; formatted_chars.

    Digests are fed part by part, in order, so a conversation of many parts is never held whole.
    """
    bounded_batches(formatted.sparkSession)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, n, turns, learned, loss, size = None, 0, None, 0, None, 0
        for batch in batches:
            out = []
            for c, text, spans in zip(batch["conv_id"], batch["formatted"], batch["loss"]):
                if c != conv:
                    if conv is not None:
                        out.append((conv, n, turns.hexdigest(), learned, loss.hexdigest(), size))
                    conv, n, turns, learned, loss, size = c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                for role, said in parsed(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescaped(text[span["start"]:span["stop"]])
                    learned += len(said)
                    loss.update(said.encode())
                size += len(text)
            yield pd.DataFrame(out, columns=names)
        if conv is not None:
            yield pd.DataFrame([(conv, n, turns.hexdigest(), learned, loss.hexdigest(), size)], columns=names)

    d = (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss")
         .mapInPandas(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
    return d.withColumn("conv_id", F.when(F.col("conv_id") != NO_ID, F.col("conv_id")))


def format_log(events: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, loss) of a log: its messages, rendered and put together. A null conv_id is NO_ID here."""
    return conversations(rendered(messages(events)))
