"""Chat formatting with a grammar round trip.

Grammar of the rendered text (one conversation is the concatenation of its turns)::

    turn  := "[INST] " body " [/INST]"            role user
           | "[BOT] " body "</s>"                 role assistant
           | "[ROLE " name "] " body "[/ROLE]"    any other role
    body, name: a backslash before one of \\ [ < ] makes that character plain

A turn is first rendered raw, read back by the parser and compared with its
source; if they differ, control strings and backslashes are escaped, and at
last every character that could be part of one. The first rendering that reads
back identically is taken, so ordinary texts stay as they are. Turns carry the
loss mask: the body of assistant turns.

Rendering runs turn by turn without a shuffle. The digests of a conversation
are sequential by definition: the turns are dealt by conversation, sorted, and
streamed through an incremental parser that holds one turn at a time, so a
conversation of any length needs bounded memory.

Edge cases: null text and null role count as empty. Turns sort by number (null
last), then role, then text; repeated rows are turns of their own. Rows without
conv_id are one conversation. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ESCAPE = r"\\[\\\[<\]]"
_UNESCAPE = re.compile(r"\\([\\\[<\]])")
_CONTROL = re.compile(r"\\|\[(?=INST\]|/INST\]|BOT\]|ROLE|/ROLE\])|<(?=/?s>)")
_ANY = re.compile(r"[\\\[<\]]")
_CLOSE = {"user": " [/INST]", "assistant": "</s>", None: "[/ROLE]"}
_END = {k: re.compile(f"{_ESCAPE}|{re.escape(v)}") for k, v in _CLOSE.items()}
_NAME_END = re.compile(f"{_ESCAPE}|\\] ")


def _plain(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def _escaped(text: str, level: int) -> str:
    return text if level == 0 else (_CONTROL if level == 1 else _ANY).sub(lambda m: "\\" + m.group(), text)


def _opening(role: str) -> str:
    return "[INST] " if role == "user" else "[BOT] " if role == "assistant" else f"[ROLE {_escaped(role, 2)}] "


def _until(pattern: re.Pattern, text: str, at: int) -> re.Match | None:
    """The first match from ``at`` that is no escape."""
    for m in pattern.finditer(text, at):
        if not (m.group()[0] == "\\"):
            return m
    return None


class NotInGrammar(ValueError):
    pass


class Reader:
    """Parser of rendered text that comes in pieces; holds an unfinished turn."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str):
        """Yields (role, body start, body end, text it stood in) of finished turns."""
        self.rest += piece
        at = 0
        while at < len(self.rest) and (turn := self._turn(at)):
            role, a, b, at = turn
            yield role, _plain(self.rest[a:b]), b - a
        self.rest = self.rest[at:]

    def _turn(self, at: int):
        text = self.rest
        if text.startswith("[INST] ", at):
            role, a, form = "user", at + 7, "user"
        elif text.startswith("[BOT] ", at):
            role, a, form = "assistant", at + 6, "assistant"
        elif text.startswith("[ROLE ", at):
            named = _until(_NAME_END, text, at + 6)
            if not named:
                return None
            role, a, form = _plain(text[at + 6 : named.start()]), named.end(), None
        else:
            if len(text) - at >= 7:
                raise NotInGrammar("no turn starts here")
            return None
        end = _until(_END[form], text, a)
        return (role, a, end.start(), end.end()) if end else None


def render(role: str, text: str) -> tuple[str, int]:
    """(rendered turn, escape level): the first level that reads back identically."""
    form = role if role in ("user", "assistant") else None
    for level in range(3):
        turn = _opening(role) + _escaped(text, level) + _CLOSE[form]
        reader = Reader()
        try:
            if [(r, t) for r, t, _ in reader.feed(turn)] == [(role, text)] and not reader.rest:
                return turn, level
        except NotInGrammar:
            pass
    raise ValueError("a fully escaped turn must read back")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered, level, loss): every turn rendered by
    itself; loss marks turns whose body bears the loss."""

    def run(batches):
        for batch in batches:
            pairs = [render(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.int32())], [*batch.schema.names, "rendered", "level"])

    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema)
    return turns.mapInArrow(run, f"{kind}, rendered string, level int").withColumn("loss", F.col("role") == "assistant")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Reads the rendered conversations back: (conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, escaped_turns)."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "escaped_turns"]
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(frames):
        conv, state, out = None, None, []

        def row():
            n, turns, loss_chars, loss, chars, escaped, reader = state
            if reader.rest:
                raise ValueError("a conversation ends inside a turn")
            return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, escaped

        for frame in frames:
            for c, rendered, level in zip(frame["conv_id"].astype(object).where(frame["conv_id"].notna(), None), frame["rendered"], frame["level"]):
                if state is None or c != conv:
                    if state is not None:
                        out.append(row())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, Reader()]
                state[4] += len(rendered)
                state[5] += level > 0
                for role, text, _ in state[6].feed(rendered):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        state[2] += len(text)
                        state[3].update(text.encode())
            if out:
                yield pd.DataFrame(out, columns=names).astype({"conv_id": object})
                out = []
        if state is not None:
            yield pd.DataFrame([row()], columns=names).astype({"conv_id": object})

    dealt = formatted.select("conv_id", "turn", "role", "text", "rendered", "level").repartition("conv_id")
    dealt = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text").select("conv_id", "rendered", "level")
    return dealt.mapInPandas(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, escaped_turns long")


_CONFLICT = r"\\[\\\[<\]]"
_MARKS = r"\\|\[/?INST\]|\[BOT\]|\[/ROLE\]|\[ROLE|</?s>"
#: The same result in SQL over ``conversations`` plus conversation -1.
ORACLE_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, CASE role WHEN 'user' THEN regexp_matches(text, '{_CONFLICT}| \[/INST\]')
    WHEN 'assistant' THEN regexp_matches(text, '{_CONFLICT}|\\$|</s>') ELSE regexp_matches(text, '{_CONFLICT}|\\$|\[/ROLE\]') END AS clash FROM c),
f AS (SELECT *, length(text) + CASE WHEN clash THEN len(regexp_extract_all(text, '{_MARKS}')) ELSE 0 END
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 15 + length(role) + len(regexp_extract_all(role, '[\\\[<\]]')) END AS chars FROM e)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (clash)::BIGINT AS escaped_turns
FROM f GROUP BY conv_id
"""
