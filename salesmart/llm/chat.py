"""Chat formatting from event logs.

A log says what happened to the messages of a conversation, in the order of ``seq``:

* ``message`` opens message number ``message`` with a role and a text (opened again, it starts anew),
* ``delta`` appends a text to it, as a model streams its answer,
* ``edit`` replaces its text; later messages stay,
* ``regenerate`` discards its text and all messages with a higher number so far; what is opened or
  appended afterwards counts.

The log is partitioned by conversation and sorted by message and sequence, latest event first. Read
in that order, the events that still count are known from two values: the latest ``regenerate`` of
the messages before, and whether the message has started anew already. A second sort, in the same
partitions, puts the pieces that are left in order for rendering. A task holds one record batch,
however long a conversation is; a conversation is read by one task.

``### role: text</turn>`` and a line end is the template. Inside texts and roles a backslash goes
before ``\\``, ``#`` and ``<`` (in roles before ``:`` too), so no marker can occur there, wherever the
text was cut into deltas, and taking the backslashes away gives the text back.

NULL texts count as empty, NULL roles as an empty role, a NULL conversation is one of its own, a NULL
``message`` or ``seq`` comes first. Events that repeat count as often as they occur; at the same
sequence number they are taken by kind, role and text. Pieces of a message that no event opened, and
events of another kind, belong to no message and are left out; a conversation without messages is not
in the output, nor is anything from an empty log. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import by_bytes, literal_table, read_table

# ---- Fixed values: the template ----
OPEN, NAMED, CLOSE = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"

#: Code points of formatted text in an output row, about; and of a text in one delta of the query's log.
SEGMENT = 1 << 16
DELTA = 512

LOG = ("conv_id", "seq", "message", "kind", "role", "text")
PIECES = "conv_id long, message long, seq long, role string, text string"
FORMATTED = "conv_id long, segment long, start long, formatted string, loss array<struct<start:long,stop:long>>"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")

RESETS = ("message", "edit", "regenerate")
BEFORE_ALL = -(1 << 63)

_IN_TEXT, _IN_ROLE = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TOKEN = re.compile(r"### (?P<role>(?:\\.|[^\\:])*): |(?P<close></turn>\n)|(?P<text>(?:\\.|[^\\#<])+)", re.DOTALL)


def escape(text: str, special: re.Pattern = _IN_TEXT) -> str:
    return special.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def table_of(schema: str, columns: Iterable[list]) -> pa.RecordBatch:
    """A record batch of lists in the order of a flat schema of longs and strings."""
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields])


def folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces that count, from events by conversation, message and latest sequence first."""
    conv: object = ()  # equal to no id
    message: object = ()
    for batch in by_bytes(batches):
        out: list[list] = [[], [], [], [], []]
        for row in zip(*(batch.column(c).to_pylist() for c in LOG), strict=True):
            conv_id, seq, number, kind, role, text = row
            at = BEFORE_ALL if seq is None else seq
            if conv_id != conv:
                conv, message, discarded, latest = conv_id, (), BEFORE_ALL, BEFORE_ALL
            if number != message:
                # What this conversation's earlier messages discard is settled now.
                message, discarded = number, max(discarded, latest)
                started = named = False
            if kind == "regenerate":
                latest = max(latest, at)
            if at < discarded or kind not in ("delta", *RESETS):
                continue
            if not started and text:
                for column, value in zip(out, (conv_id, number, seq, None, text), strict=True):
                    column.append(value)
            if kind == "message" and not named:
                # The header of the message; its NULL text and NULL sequence number sort first.
                for column, value in zip(out, (conv_id, number, None, role or "", None), strict=True):
                    column.append(value)
                named = True
            started = started or kind in RESETS
        if out[0]:
            yield table_of(PIECES, out)


def rendered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of formatted text from pieces in order."""
    conv: object = ()
    rows: list[tuple] = []
    held: list[str] = []
    spans: list[list[int]] = []
    start = size = segment = 0
    opened, message, role = False, (), None

    def add(text: str, trained: bool = False) -> None:
        nonlocal size
        if trained and text:
            begin = start + size
            if spans and spans[-1][1] == begin:
                spans[-1][1] += len(text)
            else:
                spans.append([begin, begin + len(text)])
        held.append(text)
        size += len(text)

    def end_segment() -> None:
        nonlocal start, size, segment
        if held:
            rows.append((conv, segment, start, "".join(held),
                         [{"start": a, "stop": b} for a, b in spans]))
            start, size, segment = start + size, 0, segment + 1
            held.clear()
            spans.clear()

    def end_conversation() -> None:
        if opened:
            add(CLOSE)
        end_segment()

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
    names = ["conv_id", "segment", "start", "formatted", "loss"]

    def written() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in by_bytes(batches):
        for conv_id, number, name, text in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "message", "role", "text")), strict=True):
            if conv_id != conv:
                end_conversation()
                conv, start, segment, opened, message = conv_id, 0, 0, False, ()
            if name is not None:
                if opened:
                    add(CLOSE)
                opened, message, role = True, number, name
                add(OPEN + escape(name, _IN_ROLE) + NAMED)
            elif opened and number == message:
                add(escape(text), role == TRAINED_ROLE)
            if size >= SEGMENT:
                end_segment()
        if rows:
            yield written()
    end_conversation()
    if rows:
        yield written()


def fold(log: DataFrame, partitioned: bool = False) -> DataFrame:
    """The pieces of the final messages, in the order of their conversations.

    ``log`` has the columns of LOG; say ``partitioned`` if it is partitioned by ``conv_id`` already.
    A row with a role opens a message; the rows after it hold its text.
    """
    log = log.select(*LOG)
    parts = log if partitioned else log.repartition("conv_id")
    latest_first = parts.sortWithinPartitions(
        F.asc("conv_id"), F.asc("message"), F.desc("seq"), F.desc("kind"), F.desc("role"), F.desc("text"))
    # A message's header goes before its text, and a text keeps the order of its events.
    return latest_first.mapInArrow(folded, PIECES).sortWithinPartitions(
        F.asc("conv_id"), F.asc("message"), F.desc(F.col("role").isNotNull()), F.asc("seq"), F.asc("text"))


def chat_format(log: DataFrame, partitioned: bool = False) -> DataFrame:
    """Each conversation's formatted text, in segments, with the spans that a loss counts.

    ``start`` and the spans are code points from the conversation's begin; a span holds escaped text of
    the trained role and no marker. Segments are cut between pieces, never inside an escape or a
    marker. The rows of a conversation lie together and in order.
    """
    return fold(log, partitioned).mapInArrow(rendered, FORMATTED)


def digests_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv: object = ()
    rows: list[tuple] = []
    turns = chars = loss_chars = 0
    turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()

    def end_conversation() -> None:
        if conv != ():
            rows.append((conv, turns, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars))

    for batch in batches:
        for conv_id, start, text, loss in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "start", "formatted", "loss")), strict=True):
            if conv_id != conv:
                end_conversation()
                conv, turns, chars, loss_chars = conv_id, 0, 0, 0
                turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            end = 0
            for token in _TOKEN.finditer(text):
                if token.start() != end:
                    raise ValueError(f"conversation {conv_id}: no template at {start + end}")
                end = token.end()
                if token["text"] is not None:
                    turns_hash.update(unescape(token["text"]).encode())
                elif token["close"]:
                    turns_hash.update(b"\n")
                    turns += 1
                else:
                    turns_hash.update(unescape(token["role"]).encode() + b"\n")
            if end != len(text):
                raise ValueError(f"conversation {conv_id}: no template at {start + end}")
            chars += len(text)
            for span in loss or ():
                learned = unescape(text[span["start"] - start:span["stop"] - start])
                loss_chars += len(learned)
                loss_hash.update(learned.encode())
        if rows:
            yield table_of(DIGESTS, zip(*rows, strict=True))
            rows = []
    end_conversation()
    if rows:
        yield table_of(DIGESTS, zip(*rows, strict=True))


def read_back(formatted: DataFrame, in_order: bool = True) -> DataFrame:
    """One row for each conversation, from its formatted text alone: turns, and the text in the mask.

    The SHA-256 of a conversation is one chain over its segments, so one task reads them, a batch at
    a time. ``in_order`` says that they lie as ``chat_format`` returns them; else they are sorted.
    """
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return formatted.mapInArrow(digests_of, DIGESTS)


def turn_log(turns: DataFrame) -> DataFrame:
    """The log of a table of turns (conv_id, turn, role, text), partitioned by conversation.

    Answers of the trained role are opened empty and come as deltas of DELTA code points, others
    whole. Rows that share a turn are messages of their own, by role and text.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
        F.coalesce("text", F.lit("")).alias("text"),
    ).repartition("conv_id")
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("message", F.row_number().over(by_turn).cast("long"))
    streamed = F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))
    deltas = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
    texts = F.when(streamed, F.concat(F.array(F.lit("")), deltas)).otherwise(F.array("text"))
    events = rows.select("conv_id", "message", "role", F.posexplode(texts).alias("at", "text"))
    return events.select(
        "conv_id", (F.col("message") * (1 << 32) + F.col("at")).alias("seq"), "message",
        F.when(F.col("at") == 0, "message").otherwise("delta").alias("kind"), "role", "text")


#: A conversation whose texts hold what templates are made of.
TRICKY = (r'[{"conv_id":-7,"turn":0,"role":"user","text":"\\### Assistant: </turn> ok"},'
          r'{"conv_id":-7,"turn":1,"role":"assistant","text":"\\### Assistant: </turn> ok"}]')


def op11_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and the tricky one, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = literal_table(spark, TRICKY, "conv_id long, turn long, role string, text string")
    return read_back(chat_format(turn_log(turns.unionByName(tricky)), partitioned=True))


OP11_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### : </turn>') + 1 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g'))
                + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
