"""Operator 10, chat formatting: turn-aligned windows under a token budget, with a loss mask.

Prefix sums of the turns' tokens choose the spans. Each window holds the conversation's opening system turns,
a limited history of turns that an earlier window has shown, and new turns. Assistant turns are targets once:
where a window repeats one, the mask leaves it out. A turn over the budget gets a window of its own.

The template writes a turn as ``### role:`` line, text, ``</turn>`` line. Inside roles and texts a backslash
goes before each backslash, ``#`` and ``<`` (in roles also colon), so no text can hold a control string, and
``read_back`` gives every role and text again.

Conversations are streamed from sorted partitions, turn by turn: memory holds one window, however long a
conversation is.

Defined cases: null texts and roles are empty; turns with equal numbers are ordered by role and text, and all
kept; rows without conv_id form one conversation; null turn numbers come first; very long texts get windows of their
own, never cut; repeated rows are turns of their own; other columns are ignored; an empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .token_counts import counter_of

BUDGET, HISTORY = 1024, 256
_TEXT, _ROLE, _BACK = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]"), re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n((?:\\.|[^\\<])*)\n</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _TEXT.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its escaped text starts and ends."""
    head, body = f"### {_ROLE.sub(r'\\\g<0>', role)}:\n", escape(text)
    return f"{head}{body}\n</turn>\n", len(head), len(head) + len(body)


@dataclass
class Window:
    text: str = ""
    spans: list[tuple[int, int]] = field(default_factory=list)  # characters under the loss mask
    shown: int = 0  # leading turns that an earlier window has shown
    tokens: int = 0


def windows(turns: Iterable[tuple[str, str, int]], budget: int = BUDGET, history: int = HISTORY) -> Iterator[Window]:
    """Of one conversation's (role, text, tokens), in order."""
    system: list[tuple[str, str, int]] = []
    past: list[tuple[str, str, int]] = []  # shown turns within the history's tokens
    new: list[tuple[str, str, int]] = []
    opening, first = True, True

    def build() -> Window:
        nonlocal first
        lead = [] if first else system
        fixed, room = sum(t for *_, t in lead), sum(t for *_, t in new)
        sums = [0]
        for *_, t in reversed(past):
            sums.append(sums[-1] + t)  # of the newest k turns of the past
        k = bisect_left(sums, min(history, max(0, budget - fixed - room)) + 1) - 1
        repeated = [*lead, *past[len(past) - k :]]
        out = Window(shown=len(repeated))
        for at, (role, text, tokens) in enumerate([*repeated, *new]):
            piece, start, end = turn_text(role, text)
            if at >= len(repeated) and role == "assistant":
                out.spans.append((len(out.text) + start, len(out.text) + end))
            out.text += piece
            out.tokens += tokens
        past.extend(new)
        while past and sum(t for *_, t in past) > history:
            past.pop(0)
        new.clear()
        first = False
        return out

    used = 0
    for turn in turns:
        opening = opening and turn[0] == "system"
        if new and used + turn[2] > budget:
            yield build()
            used = sum(t for *_, t in system)
        new.append(turn)
        used += turn[2]
        if opening:
            system.append(turn)
    if new:
        yield build()


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a window."""
    out, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError("not a formatted window")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


def _ordered(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Rows with their token counts, whole conversations together and in order."""
    bounded_batches(conversations.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = counter_of(spec)
        for batch in batches:
            sizes = counter.counts([turn_text(r, t)[0] for r, t in zip(batch["role"], batch["text"], strict=True)])
            yield batch.astype({"conv_id": "Int64", "turn": "Int64"}).assign(tokens=sizes)

    counted = rows.mapInPandas(count, "conv_id long, turn long, role string, text string, tokens long")
    return counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, Iterator[tuple[str, str, int]]]]:
    """The sorted rows' conversations, each as an iterator that must be used up first."""
    rows = ((None if pd.isna(c) else int(c), r, t, int(n)) for b in batches for c, r, t, n in zip(b["conv_id"].astype("Int64"), b["role"], b["text"], b["tokens"], strict=True))
    row = next(rows, None)

    def turns(conv: int | None) -> Iterator[tuple[str, str, int]]:
        nonlocal row
        while row is not None and row[0] == conv:
            yield row[1:]
            row = next(rows, None)

    while row is not None:
        yield row[0], turns(row[0])


def format_conversations(conversations: DataFrame, tokenizer_path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, text, spans, shown, tokens): the training windows of all conversations."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for conv, turns in _conversations(batches):
            for k, w in enumerate(windows(turns, budget, history)):
                rows.append((conv, k, w.text, [{"start": a, "end": b} for a, b in w.spans], w.shown, w.tokens))
                size += len(w.text)
                if size > 4 << 20:
                    yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

    names = ["conv_id", "window", "text", "spans", "shown", "tokens"]
    return _ordered(conversations, tokenizer_path).mapInPandas(run, "conv_id long, window long, text string, spans array<struct<start:long,end:long>>, shown long, tokens long")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows say when read back; streamed in window order."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state, rows = None, None, []

        def row() -> tuple:
            return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        for batch in batches:
            for c, text, spans, shown in zip(batch["conv_id"].astype("Int64"), batch["text"], batch["spans"], batch["shown"], strict=True):
                c = None if pd.isna(c) else int(c)
                if state is None or c != conv:
                    if state is not None:
                        rows.append(row())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in read_back(text)[int(shown) :]:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    said = unescape(text[span["start"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                state[5] += 1
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
                rows = []
        if state is not None:
            yield pd.DataFrame([row()], columns=names).astype({"conv_id": "Int64"})

    bounded_batches(formatted.sparkSession)
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    return formatted.mapInPandas(run, kinds)
