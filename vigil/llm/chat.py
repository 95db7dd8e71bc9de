"""Chat formatting: incremental black-box rendering of conversations."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import partitions, rows, small_batches, tables

#: The template's control strings and what stands for them, and for the escape itself, inside roles and texts.
_CODES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\e", ": ": "\\c"}
_NAMES = {v[1]: k for k, v in _CODES.items()}
_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_ROLE = re.compile(r"\\|###|</turn>|: ")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### (.*?): (.*?)</turn>\n", re.S)

FORMATTED = "conv_id long, part long, formatted string, loss array<struct<start: int, end: int>>, turns long, rewrites long"


def escape(text: str, pattern: re.Pattern = _CONTROL) -> str:
    return pattern.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _NAMES[m[1]], text)


def template(turns: list[tuple[str, str]], continued: bool = False) -> str:
    """The production template: '### role: text</turn>' and a line end for each turn, control strings escaped."""
    return "".join(f"### {escape(r, _CONTROL_ROLE)}: {escape(t)}</turn>\n" for r, t in turns)


#: What it writes for a turn depends on that turn alone, so windows of turns join into the rendering of the whole.
template.turnwise = True


def parse(text: str) -> list[tuple[str, int, int]]:
    """(role, start, end) of each turn's still escaped text in what template() has written."""
    out, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            raise ValueError("the text isn't of this template")
        out.append((unescape(m[1]), m.start(2), m.end(2)))
        at = m.end()
    if at != len(text):
        raise ValueError("the text isn't of this template")
    return out


def shared_prefix(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def locate(render: Callable, turns: list[tuple[str, str]], continued: bool) -> tuple[str, list[tuple[int, int]], int]:
    """The rendering of turns, the span that each turn added, and how many turns rewrote what was there before them.

    The template is a black box: successive prefixes of the turns are rendered, and consecutive outputs are compared. What
    follows their common prefix is the new turn's; where that prefix is shorter than the former output, the template
    has rewritten history, and the spans before are cut off where the outputs part.
    """
    before, spans, rewrites = "", [], 0
    for n in range(1, len(turns) + 1):
        now = render(turns[:n], continued)
        same = shared_prefix(before, now)
        if same < len(before):
            rewrites += 1
            spans = [(min(a, same), min(b, same)) for a, b in spans]
        spans.append((same, len(now)))
        before = now
    return before, spans, rewrites


def format_chats(chats: DataFrame, *, render: Callable = template, trained: tuple[str, ...] = ("assistant",), window: int = 16, content: Callable | None = None) -> DataFrame:
    """Render conversations (conv_id, turn, role, text; a row is a turn) and mark what a model is trained on.

    Rows, in the order of their parts within a partition: conv_id, part (from 0), formatted, loss (spans of the trained
    roles' texts in formatted), turns, rewrites (turns of this part that rewrote earlier output).

    A template is a black box: all prefixes of the whole conversation are rendered, and there is one part. That costs the
    square of the turns, and a task holds the conversation. Only a template with a true attribute `turnwise`, which says that
    it renders each turn by itself and so can't rewrite, is rendered in windows: each part holds at
    most `window` turns, and after the first the template is told that it continues. The last turn of a part is
    rendered again at the start of the next; if it comes out otherwise there, the template doesn't continue its own
    output, which counts as a rewrite. Time is linear in a conversation's length, and a task holds one window: a
    conversation with a third of all turns streams through one task, which the order of its turns asks for.

    content(rendered turn) gives the (start, end) of the text in what a turn added; default: the production template's.

    Turns go by (turn, role, text), nulls first; null role or text counts as empty; null conv_id is a conversation of its
    own; repeated rows are turns of their own; no rows give no rows; other columns are ignored.
    """
    spark = chats.sparkSession
    small_batches(spark, 2000)

    def text_of(turn: str) -> tuple[int, int]:
        return parse(turn)[0][1:]

    inner = content or text_of
    most = window if getattr(render, "turnwise", False) else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("turns", pa.int64()), ("rewrites", pa.int64())])
        out: list[dict] = []

        def close(conv: int | None, part: int, held: tuple[str, str] | None, turns: list[tuple[str, str]]) -> None:
            text, spans, rewrites = locate(render, ([held] if held else []) + turns, bool(held))
            if held:
                again, skip = text[slice(*spans[0])], spans[0][1]
                rewrites += again != close.last
                text, spans = text[skip:], [(max(0, a - skip), max(0, b - skip)) for a, b in spans[1:]]
            loss = []
            for (role, _), (a, b) in zip(turns, spans, strict=True):
                if role in trained and a < b:
                    x, y = inner(text[a:b])
                    loss.append({"start": a + x, "end": a + y})
            close.last = text[slice(*spans[-1])]
            out.append({"conv_id": conv, "part": part, "formatted": text, "loss": loss, "turns": len(turns), "rewrites": rewrites})

        close.last = ""
        conv, part, held, turns, size = object(), 0, None, [], 0
        for c, role, text in rows(batches):
            turn = (role or "", text or "")
            if c != conv or len(turns) == most:
                if turns:
                    close(conv, part, held, turns)
                    size += len(out[-1]["formatted"])
                    held, part = (turns[-1], part + 1) if c == conv else (None, 0)
                conv, turns = c, []
            turns.append(turn)
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if turns:
            close(conv, part, held, turns)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    n = max(partitions(spark), 1)
    return (
        chats.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.col("turn").alias("turn"))
        .repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(work, FORMATTED)
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of conversations, read from the output of format_chats() with the production template.

    The parts of a conversation follow one another in a partition, so this is a second streaming pass over the same task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("history_rewrites", pa.int64())])
        for batch_rows in _groups(batches):
            yield pa.RecordBatch.from_pylist(batch_rows, schema)

    def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        now: dict | None = None
        done: list[dict] = []

        def end() -> None:
            done.append({"conv_id": now["conv_id"], "n_turns": now["n"], "turns_sha256": now["turns"].hexdigest(), "loss_chars": now["loss_n"], "loss_sha256": now["loss"].hexdigest(), "formatted_chars": now["chars"], "history_rewrites": now["rewrites"]})

        for conv, part, text, loss, _, rewrites in rows(batches):
            if part == 0:
                if now:
                    end()
                now = {"conv_id": conv, "n": 0, "turns": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "chars": 0, "rewrites": 0}
            now["chars"] += len(text)
            now["rewrites"] += rewrites
            for role, a, b in parse(text):
                now["n"] += 1
                now["turns"].update(f"{role}\n{unescape(text[a:b])}\n".encode("utf-8", "surrogatepass"))
            for span in loss:
                said = unescape(text[span["start"] : span["end"]])
                now["loss_n"] += len(said)
                now["loss"].update(said.encode("utf-8", "surrogatepass"))
            if len(done) >= 1000:
                yield done
                done = []
        if now:
            end()
        if done:
            yield done

    return formatted.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, history_rewrites long")


#: A conversation whose texts hold the template's own control strings.
PROBE = "\\### Assistant: </turn> ok"


def op1(spark, sf_dir: str) -> DataFrame:
    chats = tables(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return read_back(format_chats(chats.unionByName(probe)))


SQL = r"""
WITH chats AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e')) + 14) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS history_rewrites
FROM chats GROUP BY conv_id
"""
