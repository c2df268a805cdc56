"""Chat formatting with a grammar round trip.

Template (fixed by this module)::

    system     [SYS]text[/SYS]
    user       [INST] text [/INST]
    assistant  <s> text </s>
    other role [ROLE name]text[/ROLE]

``<s>``, ``</s>``, ``[INST]`` ... are control strings. A control string inside a text or a role
name is escaped by a backslash after its first character (``[\\INST]``); a text that already
holds such an escaped form gets one more backslash, so that unescaping (one backslash less) gives
the text back whatever it was.

A turn is first rendered as it is. A deterministic parser reads the rendered conversation back
while it is written; a turn that does not come back as it went in is rendered again with its
conflicting content escaped, until the conversation is identical. Texts without conflicts
therefore stay byte for byte what they were.

Conversations are dealt by id and streamed in turn order: a task holds one Arrow batch and one turn at a
time, never a conversation, so one with any number of turns is safe.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FRAME = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
_CONTROL = re.compile(r"([\[<])(\\*)(/?(?:SYS\]|INST\]|ROLE[ \]]|s>))")
_ESCAPED = re.compile(r"([\[<])\\(\\*)(/?(?:SYS\]|INST\]|ROLE[ \]]|s>))")
_OPEN = re.compile(r"\[SYS\]|\[INST\] |<s> |\[ROLE ")
_ROLE_OF = {opening: role for role, (opening, _) in FRAME.items()}


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def escape_role(role: str) -> str:
    """Role names end at the first ``]``; a tilde spells out the characters that would mislead the parser."""
    return role.replace("~", "~0").replace("]", "~1").replace("[", "~2").replace("<", "~3")


def unescape_role(role: str) -> str:
    return role.replace("~3", "<").replace("~2", "[").replace("~1", "]").replace("~0", "~")


def render(role: str, text: str, escaped: bool) -> str:
    """One turn as the template writes it."""
    body = escape(text) if escaped else text
    if role in FRAME:
        opening, closing = FRAME[role]
        return opening + body + closing
    return f"[ROLE {escape_role(role)}]{body}[/ROLE]"


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """(role, text) of every turn of rendered text; None if it does not follow the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        m = _OPEN.match(rendered, at)
        if not m:
            return None
        at = m.end()
        if m[0] == "[ROLE ":
            end = rendered.find("]", at)
            if end < 0:
                return None
            role, closing, at = unescape_role(rendered[at:end]), "[/ROLE]", end + 1
        else:
            role = _ROLE_OF[m[0]]
            closing = FRAME[role][1]
        end = rendered.find(closing, at)
        if end < 0:
            return None
        body = rendered[at:end]
        if any(not c[2] for c in _CONTROL.finditer(body)):  # a bare control string in a body
            return None
        turns.append((role, unescape(body)))
        at = end + len(closing)
    return turns


def render_checked(role: str, text: str) -> tuple[str, str, str]:
    """(rendered turn, recovered role, recovered text), escaped only where the plain form fails."""
    for escaped in (False, True):
        out = render(role, text, escaped)
        if parse(out) == [(role, text)]:
            return out, role, text
    raise ValueError(f"turn of role {role!r} does not survive its template")


FORMATTED = "conv_id long, seq long, role string, rendered string, recovered_role string, recovered_text string, loss boolean"


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn, its rendered form and what the parser read back from it.

    The formatted conversation is the concatenation of ``rendered`` in the order of ``seq`` (from 0).
    Null text and null roles are empty; turns with equal numbers are ordered by role and text, null turn
    numbers come first, null conversation ids form one conversation; columns other than conv_id,
    turn, role and text are ignored; an empty table gives no rows.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text"), F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInPandas(_format_partition, FORMATTED)


def _format_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, seq = object(), -1
    for batch in batches:
        out = []
        for c, role, text in zip(_ids(batch["conv_id"]), batch["role"], batch["text"], strict=True):
            seq = seq + 1 if c == conv else 0
            conv = c
            rendered, got_role, got_text = render_checked(role, text)
            out.append((c, seq, role, rendered, got_role, got_text, role == "assistant"))
        frame = pd.DataFrame(out, columns=["conv_id", "seq", "role", "rendered", "recovered_role", "recovered_text", "loss"])
        yield frame.astype({"conv_id": "Int64"})


def _ids(column: pd.Series) -> list[int | None]:
    return [None if pd.isna(x) else int(x) for x in column]


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, escaped_turns long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every formatted conversation, read from the rendered text alone.

    Turns are parsed again, unescaped and hashed in order as they stream by; the state of a
    conversation is two running hashes and four counts.
    """
    dealt = formatted.select("conv_id", "seq", "rendered").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return dealt.mapInPandas(_digest_partition, DIGESTS)


class _Reader:
    """Parses one conversation's rendered stream."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss, self.chars, self.escaped = conv_id, 0, 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def take(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text in parse(rendered) or ():
            self.turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode())
            self.escaped += text not in rendered
            if role == "assistant":
                self.loss += len(text)
                self.loss_hash.update(text.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.turns_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(),
                self.chars, self.escaped)


def _digest_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in DIGESTS.split(", ")]
    reader: _Reader | None = None
    for batch in batches:
        done = []
        for c, rendered in zip(_ids(batch["conv_id"]), batch["rendered"], strict=True):
            if reader is None or reader.conv_id != c:
                if reader is not None:
                    done.append(reader.row())
                reader = _Reader(c)
            reader.take(rendered)
        yield pd.DataFrame(done, columns=columns).astype({"conv_id": "Int64"})
    if reader is not None:
        yield pd.DataFrame([reader.row()], columns=columns).astype({"conv_id": "Int64"})


def training_texts(formatted: DataFrame) -> DataFrame:
    """Per turn the rendered text with its character span in the conversation and the span under the loss mask.

    ``loss_start``/``loss_end`` bound the escaped assistant text (null for other roles). Starts are running sums
    over earlier turns of the conversation.
    """
    before = Window.partitionBy("conv_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)).cast("long")
    opening, closing = (len(x) for x in FRAME["assistant"])
    return formatted.select("conv_id", "seq", "role", "rendered", start.alias("start"),
                            F.when(F.col("loss"), start + opening).alias("loss_start"),
                            F.when(F.col("loss"), start + F.length("rendered") - closing).alias("loss_end"))
