"""Chat formatting: events of conversations are folded into final messages, rendered with a template and read back.

An event is (conv_id, turn, seq, kind, role, text). ``message`` opens a message of a turn, ``delta`` appends to the turn's latest message,
``edit`` replaces its text and ``regenerate`` empties it for the deltas that follow; an event without an open message opens one.
Null texts and roles are empty, nulls in conv_id, turn and seq sort first, and equal events keep the order of kind, role and text.
Repeated rows of kind ``message`` are messages of their own. Unknown kinds raise an error. Extra columns are ignored, and an empty table gives
no rows.

A conversation is one task's, as its turns have an order; tasks stream sorted rows, so a conversation of any length needs the memory of one
message and one part of formatted text.

The table of the registered query has final messages, so ``streamed`` first makes the events that a serving log would hold of them: by a hash
of the text a message comes whole, in deltas, as a draft that is regenerated in deltas, or as a draft that is edited.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows_of, table

# The template's fixed values.
BOS, HEAD, BODY, EOS = "<s>", "[INST] ", " [/INST]", "</s>"
CONTROL = re.compile(r"<s>|</s>|\[INST\]|\[/INST\]")
TURN = re.compile(re.escape(HEAD) + r"(.*?)" + re.escape(BODY) + r"(.*?)" + re.escape(EOS), re.S)
PART_CHARS = 1 << 19
KINDS = ("message", "delta", "edit", "regenerate")

FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.list_(pa.int64())), ("loss_end", pa.list_(pa.int64()))])
DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: str) -> str:
    """Doubles backslashes and breaks control strings with one after their first character."""
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Final (conv_id, role, text) messages of sorted events."""
    at, role, text = None, None, []
    for conv, turn, kind, who, what in events:
        if kind not in KINDS:
            raise ValueError(f"unknown kind of event: {kind}")
        if at != (conv, turn) or kind == "message":
            if at:
                yield at[0], role, "".join(text)
            at, role, text = (conv, turn), who or "", []
        if kind in ("edit", "regenerate"):
            text.clear()
        if kind != "regenerate":
            text.append(what or "")
    if at:
        yield at[0], role, "".join(text)


def render(messages: Iterator[tuple]) -> Iterator[tuple]:
    """Parts of at most about PART_CHARS characters (or one turn): conv_id, part, text, and the spans under the loss mask."""
    at, part, out, size, spans = None, 0, [], 0, []
    for conv, role, text in messages:
        if at is None or at[0] != conv or size >= PART_CHARS:
            if at:
                yield at[0], part, "".join(out), spans
            part = part + 1 if at and at[0] == conv else 0
            at, out, size, spans = (conv,), [BOS] if part == 0 else [], len(BOS) if part == 0 else 0, []
        head, body = HEAD + escape(role) + BODY, escape(text)
        if role == "assistant":
            spans.append((size + len(head), size + len(head) + len(body)))
        out += head, body, EOS
        size += len(head) + len(body) + len(EOS)
    if at:
        yield at[0], part, "".join(out), spans


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for row in render(fold(rows_of(batches, "conv_id", "turn", "kind", "role", "text"))):
        rows.append(row)
        held += len(row[2])
        if held >= PART_CHARS:
            yield _formatted(rows)
            rows, held = [], 0
    yield _formatted(rows)


def _formatted(rows: list[tuple]) -> pa.RecordBatch:
    columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [[s for s, _ in r[3]] for r in rows], [[e for _, e in r[3]] for r in rows]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FORMATTED.types, strict=True)], schema=FORMATTED)


def format_chats(events: DataFrame) -> DataFrame:
    """Formatted conversations in parts; a task has whole conversations, and their parts in order."""
    keys = ["conv_id", "turn", "seq", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), "role", "text"]
    rows = events.select(F.col("conv_id").cast("long"), "turn", "seq", "kind", "role", "text").repartition("conv_id").sortWithinPartitions(*keys)
    return rows.mapInArrow(_format, "conv_id long, part long, formatted string, loss_start array<long>, loss_end array<long>")


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of one part."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, at, n, turns, loss, chars, size = [], None, 0, None, None, 0, 0
    for conv, _, formatted, starts, ends in rows_of(batches, *FORMATTED.names):
        if at is None or at[0] != conv:
            if at:
                done.append((at[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))
            at, n, turns, loss, chars, size = (conv,), 0, hashlib.sha256(), hashlib.sha256(), 0, 0
        for role, text in parse(formatted):
            turns.update(f"{role}\n{text}\n".encode())
            n += 1
        for s, e in zip(starts, ends, strict=True):
            text = unescape(formatted[s:e])
            loss.update(text.encode())
            chars += len(text)
        size += len(formatted)
    if at:
        done.append((at[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(DIGEST.types)], schema=DIGEST)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted parts say, one row for each conversation. Takes the result of ``format_chats`` itself, whose tasks hold whole conversations."""
    return formatted.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def streamed(messages: DataFrame) -> DataFrame:
    """Events whose fold is the given messages (conv_id, turn, role, text), in their order: rows of one turn by role and text."""
    text = F.coalesce("text", F.lit(""))
    third, half = F.ceil(F.length(text) / 3).cast("int"), F.ceil(F.length(text) / 2).cast("int")
    rest = lambda at: F.substring(text, at + 1, F.length(text))
    event = lambda kind, what: F.struct(F.lit(kind).alias("kind"), what.alias("text"))
    whole = F.array(event("message", text))
    deltas = F.array(event("message", F.substring(text, F.lit(1), third)), event("delta", F.substring(text, third + 1, third)), event("delta", rest(2 * third)))
    again = F.array(event("message", F.reverse(text)), event("regenerate", F.lit("")), event("delta", F.substring(text, F.lit(1), half)), event("delta", rest(half)))
    edited = F.array(event("message", F.reverse(text)), event("edit", text))
    way = F.pmod(F.xxhash64(text), F.lit(4))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = messages.select("conv_id", "turn", "role", place.alias("place"), F.posexplode(F.when(way == 0, whole).when(way == 1, deltas).when(way == 2, again).otherwise(edited)).alias("step", "e"))
    return rows.select("conv_id", "turn", (F.col("place").cast("long") * 4 + F.col("step")).alias("seq"), "e.kind", "role", "e.text")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    hard = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return read_back(format_chats(streamed(rows.unionByName(hard))))


def oracle() -> str:
    """The same figures from the input alone; formatted_chars counts the template and the backslashes of escaping."""
    return r"""
with t as (
  select conv_id::bigint conv_id, turn::bigint turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, 20 + length(regexp_replace(replace(role || chr(0) || text, '\', '\\'), '(<)(s>|/s>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g')) - 2 c from t)
select conv_id, count(*)::bigint n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_sha256,
  (3 + sum(c))::bigint formatted_chars
from e group by conv_id"""
