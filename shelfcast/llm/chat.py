"""Conversations as marked-up text that a deterministic parser turns back into the same turns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A turn is OPEN role SEP text CLOSE. A backslash before a mark or a backslash takes its meaning.
OPEN, SEP, CLOSE = "### ", ": ", " </turn>\n"
MARKS = ("### ", ": ", "</turn>", "\\")
ESCAPED = re.compile("|".join(rf"\\{re.escape(m)}" for m in MARKS))
TOKEN = re.compile("|".join(re.escape(m) for m in MARKS))
LEARNED = "assistant"
Turn = tuple[str, str]


def escape(text: str, level: int) -> str:
    """Level 0 leaves the text; 1 escapes marks; 2 backslashes too, which always reads back."""
    if level == 0:
        return text
    return TOKEN.sub(lambda m: m[0] if level == 1 and m[0] == "\\" else "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][1:], text)


def _until(text: str, at: int, mark: str) -> int:
    """Where the next unescaped ``mark`` starts, -1 if nowhere."""
    step = re.compile(f"{ESCAPED.pattern}|({re.escape(mark)})")
    while m := step.search(text, at):
        if m[1] is not None:
            return m.start()
        at = m.end()
    return -1


def parse(formatted: str) -> list[tuple[str, int, int]] | None:
    """(role, start, end) of every turn's escaped text; None if it isn't a sequence of turns."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            return None
        sep = _until(formatted, at + len(OPEN), SEP)
        end = _until(formatted, sep + len(SEP), CLOSE) if sep >= 0 else -1
        if end < 0:
            return None
        turns.append((unescape(formatted[at + len(OPEN):sep]), sep + len(SEP), end))
        at = end + len(CLOSE)
    return turns


def read_back(formatted: str) -> list[Turn] | None:
    turns = parse(formatted)
    return turns and [(role, unescape(formatted[a:b])) for role, a, b in turns]


def render_turn(role: str, text: str) -> str:
    """The turn at the lowest levels of escaping at which it reads back as it is."""
    for level in (0, 1, 2):
        for role_level in range(level + 1):
            out = OPEN + escape(role, role_level) + SEP + escape(text, level) + CLOSE
            if read_back(out) == [(role, text)]:
                return out
    raise ValueError("a turn doesn't read back")


def render(turns: Sequence[Turn]) -> str:
    """All turns; the whole is read back once more, as it was written turn by turn."""
    out = "".join([render_turn(*t) for t in turns])
    if (read_back(out) or []) != list(turns):
        raise ValueError("a conversation doesn't read back")
    return out


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted and loss_spans.

    ``loss_spans`` are the code point offsets of the assistant texts, escaped, in ``formatted``.
    Turns are ordered by turn (NULL first), ties by role and text; repeated rows are repeated
    turns. A NULL role or text is empty. Rows with a NULL conv_id make one conversation. Other
    columns are ignored, and an empty table gives no rows. A conversation is one output text, so
    its turns meet in one task; nothing larger than one conversation does.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    span = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
    schema = T.StructType([
        grouped.schema["conv_id"], T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(span)),
    ])
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, masks = [], []
                for turns in part.column("turns").to_pylist():
                    out = render([(t["role"], t["text"]) for t in turns])
                    texts.append(out)
                    masks.append([
                        {"start": a, "end": b} for role, a, b in parse(out) if role == LEARNED
                    ])
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(texts, pa.string()), pa.array(masks, spans)],
                    names=["conv_id", "formatted", "loss_spans"],
                )

    return grouped.select("conv_id", "turns").mapInArrow(run, schema)


def digests(formatted: str, spans: Sequence[dict]) -> tuple[int, str, int, str, int]:
    """n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the output."""
    turns = read_back(formatted) or []
    said = hashlib.sha256()
    for role, text in turns:
        said.update(f"{role}\n{text}\n".encode())
    loss = "".join([unescape(formatted[s["start"]:s["end"]]) for s in spans])
    return (
        len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        len(formatted),
    )
