"""Chat formatting from an event log.

A log row is (conv_id, seq, message, kind, role, text). ``start`` opens a message and names its role, ``delta`` appends
streamed text, ``edit`` replaces the text, ``regenerate`` throws it away so that later deltas write it anew, ``retract``
removes the message until a later ``start``, ``edit`` or ``regenerate``. Folding needs one message's events at a time, so
the log is partitioned by conversation *and* message: a conversation that holds a third of all events is split into its
messages. Events of equal ``seq`` apply in the order start, edit, regenerate, retract, delta.

A message becomes one segment of its conversation's output::

    ### role: text</turn>\\n

In texts and roles the control strings are escaped: ``\\`` as ``\\\\``, ``</turn>`` as ``\\t``, ``### `` as ``\\h`` and, in roles,
``:`` as ``\\c``. The escaped text holds no control string, and :func:`unescape` reverses it. The loss mask covers the
escaped text of each assistant message.

:func:`digests` reads the segments back, in order, and keeps running hashes only: its memory does not grow with a
conversation. The hashes run over a whole conversation by definition, so that pass alone has one task per conversation.

Null texts and roles count as empty, a null conv_id is a conversation of its own, equal turns are ordered by role and
text hash, repeated rows stay repeated turns, an empty table gives an empty result, other columns are left aside.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlink.llm.common import table

HEAD, SEP, TAIL = "### ", ": ", "</turn>\n"
PIECE = 512
RESETS = ("start", "edit", "regenerate", "retract")
_CODES = {"\\": "\\", "t": "</turn>", "h": "### ", "c": ":"}
_ESCAPED = re.compile(r"\\([\\thc])")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("</turn>"), F.lit("\\t"))
    return F.replace(out, F.lit("### "), F.lit("\\h"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _CODES[m[1]], text) if "\\" in text else text


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text): the final messages; ``seq`` is that of a message's first event."""
    rank = F.when(F.col("kind") == "delta", 9).otherwise(F.array_position(F.array(*map(F.lit, RESETS)), F.col("kind")))
    event = F.struct("seq", rank.alias("rank"), "kind", F.coalesce("text", F.lit("")).alias("text"))
    by_message = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(event)).alias("log"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq"))).alias("role"),
        F.min("seq").alias("seq"),
    )
    last = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i)))
    live = by_message.withColumn("last", F.coalesce(last, F.lit(0))).filter(F.get("log", F.col("last"))["kind"] != "retract")
    written = F.slice("log", F.col("last") + 1, F.size("log"))
    text = F.array_join(F.transform(written, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"])), "")
    return live.select("conv_id", "seq", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, seq, segment, loss_start, loss_end): one segment per message; its loss span in code points, or nulls."""
    role = F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\c"))
    head = F.concat(F.lit(HEAD), role, F.lit(SEP))
    body = escape(F.col("text"))
    start = F.when(F.col("role") == "assistant", F.length(head))
    return messages.select(
        "conv_id", "seq", F.concat(head, body, F.lit(TAIL)).alias("segment"), start.alias("loss_start"),
        (start + F.length(body)).alias("loss_end"),
    )


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a rendered segment."""
    role, body = segment[len(HEAD) : -len(TAIL)].split(SEP, 1)
    return unescape(role), unescape(body)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment, start, end):
        role, text = parse(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            masked = unescape(segment[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self):
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation, read back from its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def batch_of(done):
            columns = list(zip(*done, strict=True)) if done else [[]] * len(names)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        current = None
        for batch in batches:
            done = []
            for conv, segment, start, end in zip(*(batch.column(i) for i in range(4)), strict=True):
                conv = conv.as_py()
                if current is None or current.conv_id != conv:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv)
                current.add(segment.as_py(), start.as_py(), end.as_py())
            yield batch_of(done)
        if current is not None:
            yield batch_of([current.row()])

    # Placed by conversation, then in the order of the turns; no window over a conversation.
    placed = segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return placed.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(run, DIGESTS)


def log_of_turns(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The event log of finished turns: a start, then the text as streamed deltas of ``piece`` code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", text.alias("text"),
        F.xxhash64(text).alias("__hash"), F.monotonically_increasing_id().alias("message"),
    )
    # One pass over the text cuts it; no piece is looked up from the text's beginning.
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    events = F.posexplode(F.concat(F.array(F.lit("")), pieces)).alias("at", "piece")
    rows = rows.select("conv_id", "turn", "role", "__hash", "message", events)
    start = F.col("at") == 0
    return rows.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.col("__hash").alias("hash"), "message", "at").alias("seq"),
        "message",
        F.when(start, "start").otherwise("delta").alias("kind"),
        F.when(start, F.col("role")).alias("role"),
        F.col("piece").alias("text"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", trap), (-7, 1, "assistant", trap)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(render(fold(log_of_turns(turns))))
