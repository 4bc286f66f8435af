"""Chat formatting: final messages from an event log, rendered with a loss mask.

A log has one row for an event: conv_id, seq, message, event, role, text. ``message`` names the
message that the event is about; within it events apply by seq:

* ``message`` begins it (its role and text),
* ``delta`` appends streamed text,
* ``edit`` and ``regenerate`` replace the text so far,
* ``delete`` takes the message away until a later event brings text again.

Messages of a conversation are in the order of their first event. The fold works on
(conversation, message) groups, so a conversation with most of the log is spread out; the
pieces are put in order and joined once per conversation.

The template is ``<s>role<|text|>text</s>`` per turn. Inside role and text a backslash is doubled
and one is put into every control string, so no text can end a turn or begin one, and unescaping
gives back each text exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>", "<|text|>", "</s>"
TRAINED_ROLE = "assistant"

# How control strings of common chat templates begin, with what must follow.
CONTROL = r"(<(?=/?s>|\||</?SYS>)|\[(?=/?INST\]))"


def escaped(text: Column) -> Column:
    """``text`` with control strings broken up by a backslash; null is empty."""
    doubled = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$1\\")


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, first_seq, role, text.

    Events with equal seq apply in the order message, edit, regenerate, delete, delta, then by
    text. A null text is empty, an unknown event changes nothing, a delta or edit without a
    ``message`` event begins the message with its own role. A null conv_id is a conversation.
    """
    rank = F.array_position(F.array(*map(F.lit, ("message", "edit", "regenerate", "delete", "delta"))),
                            F.col("event"))
    log = (events.where(F.col("event").isin("message", "delta", "edit", "regenerate", "delete"))
           .select("conv_id", "message", F.struct(
               "seq", rank.alias("rank"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
               "role", "event").alias("e"))
           .groupBy("conv_id", "message")
           .agg(F.sort_array(F.collect_list("e")).alias("log")))
    resets = F.transform("log", lambda e, i: F.when(e["event"] != "delta", i))
    live = F.slice("log", F.coalesce(F.array_max(resets), F.lit(0)) + 1, F.size("log"))
    began = F.filter("log", lambda e: e["event"] == "message")
    return (log.select("conv_id", "message", F.col("log")[0]["seq"].alias("first_seq"),
                       F.coalesce(F.get(began, F.size(began) - 1)["role"],
                                  F.col("log")[0]["role"]).alias("role"),
                       live.alias("live"))
            .where((F.col("live")[0]["event"] != "delete") | (F.size("live") > 1))
            .select("conv_id", "message", "first_seq", "role", F.array_join(F.transform(
                F.filter("live", lambda e: e["event"] != "delete"), lambda e: e["text"]), "")
                .alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, and mask, the [start, end) code points of
    what a model is trained on (the escaped texts of assistant turns)."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    turns = messages.select("conv_id", F.struct(
        "first_seq", "message", head.alias("head"), body.alias("body"), "role",
        F.length(head).alias("h"), F.length(body).alias("b")).alias("t"))
    joined = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    each = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)))
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"),
                 F.array().cast("array<struct<start: int, end: int>>").alias("mask")),
        lambda acc, t: F.struct(
            (acc["at"] + t["h"] + t["b"] + len(CLOSE)).alias("at"),
            F.when(t["role"] == TRAINED_ROLE, F.concat(acc["mask"], F.array(F.struct(
                (acc["at"] + t["h"]).alias("start"), (acc["at"] + t["h"] + t["b"]).alias("end")))))
            .otherwise(acc["mask"]).alias("mask")))
    return joined.select("conv_id", F.array_join(each, "").alias("formatted"),
                         spans["mask"].alias("mask"))


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError("not a formatted conversation")
        middle = formatted.index(MIDDLE, at)
        stop = formatted.index(CLOSE, middle)
        yield (unescaped(formatted[at + len(OPEN):middle]),
               unescaped(formatted[middle + len(MIDDLE):stop]))
        at = stop + len(CLOSE)


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of what the formatted strings and masks say, parsed from them alone."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for formatted, mask in zip(batch.column("formatted").to_pylist(),
                                       batch.column("mask").to_pylist(), strict=True):
                turns, loss, n, chars = hashlib.sha256(), hashlib.sha256(), 0, 0
                for role, text in turns_of(formatted):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                for span in mask:
                    text = unescaped(formatted[span["start"]:span["end"]])
                    loss.update(text.encode())
                    chars += len(text)
                rows.append((n, turns.hexdigest(), chars, loss.hexdigest(), len(formatted)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(list(c), k) for c, k in zip(
                    columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()),
                    strict=True))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                 "formatted_chars"])

    return rendered.mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")
