"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a text. Rendering successive prefixes of a conversation and comparing each
output with the one before finds every turn's span without knowing the template; rendering the last turn with a sentinel, and
with nothing, as its text finds the text's span within it. A template whose output for a prefix isn't a prefix of the next output
rewrites history; such conversations are marked, and of their turns only those that no later output changed keep their text's span.
"""

from __future__ import annotations

import hashlib
import os.path
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The control strings of the format.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_OPEN = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
FORMATTED = "conv_id long, formatted string, rewrites boolean, spans array<struct<role:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint>>"
_SPAN = pa.list_(pa.struct([("role", pa.string()), *((n, pa.int64()) for n in ("start", "end", "text_start", "text_end"))]))


def escape(text: str) -> str:
    """text without control strings: a backslash after their first character; backslashes of the text are doubled."""
    return _OPEN.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def instruct_template(turns: list[Turn]) -> str:
    """Each turn in <s>...</s>, its role between [INST] and [/INST]."""
    return "".join(f"<s>[INST]{escape(role)}[/INST]{escape(text)}</s>" for role, text in turns)


def parse_instruct(formatted: str) -> list[Turn]:
    """The turns that instruct_template was given."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def common(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def locate(turns: list[Turn], template: Template) -> tuple[str, bool, list[tuple[int, int, int, int]]]:
    """The formatted conversation, whether the template rewrites history, and each turn's span with its text's span.

    Where an output doesn't begin with the one before it, the turn's span begins where the two part, and what earlier turns have beyond
    that is cut off: a text that isn't wholly before it has an empty span, as have the texts of that turn and of later ones. So every
    span is of the last output.
    """
    out, rewrites, spans = template([]), False, []
    for k, (role, text) in enumerate(turns):
        before, out = out, template(turns[: k + 1])
        start = len(before)
        if not out.startswith(before):
            rewrites, start = True, common(before, out)
            spans = [(min(a, start), min(b, start), *((x, y) if y <= start else (min(a, start),) * 2)) for a, b, x, y in spans]
        sentinel = "\ue000\ue001"
        while sentinel in out:
            sentinel += "\ue001"
        at = template([*turns[:k], (role, sentinel)]).find(sentinel, start)
        size = len(out) - len(template([*turns[:k], (role, "")]))
        if at < 0 or size < 0 or at + size > len(out) or rewrites:
            at, size = start, 0
        spans.append((start, len(out), at, at + size))
    return out, rewrites, spans


def format_conversations(rows: DataFrame, template: Template = instruct_template) -> DataFrame:
    """Per conv_id of rows (conv_id, turn, role, text): formatted, rewrites, and the spans of its turns, in code points.

    Turns go by turn, then role and text, nulls first; repeated rows are turns of their own. Null roles and texts are empty; rows
    without a conv_id make one conversation; other columns of rows don't matter, and no rows give none. A conversation is one row of
    the result, so it must fit a task, as its text must; every turn renders those before it, so work grows with the square of turns.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    whole = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    whole = whole.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part, out = batch.slice(a, 256), []
                for roles, texts in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    formatted, rewrites, spans = locate(list(zip(roles, texts, strict=True)), template)
                    out.append((formatted, rewrites, [dict(zip(("role", "start", "end", "text_start", "text_end"), (r, *s), strict=True)) for r, s in zip(roles, spans, strict=True)]))
                columns = list(zip(*out, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), _SPAN), strict=True))], ["conv_id", "formatted", "rewrites", "spans"])

    return whole.mapInArrow(render, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """Digests read back from the formatted texts alone, and from the loss mask: the text spans of assistant turns.

    A row for each of formatted, a null conv_id and repeated ones too; a text that instruct_template didn't make fails the query.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            out = []
            for conv, text, spans in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                turns = parse_instruct(text)
                loss = "".join(unescape(text[s["text_start"] : s["text_end"]]) for s in spans if s["role"] == "assistant")
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names)

    return formatted.select("conv_id", "formatted", "spans").mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
