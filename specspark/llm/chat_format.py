"""Chat formatting with typed content parts.

A message is a role and a list of typed parts. A visitor with one method a type flattens the parts, in order, into text with
placeholders, and records for every placeholder the attachment it stands for and the number of tokens it expands to. Messages are
formatted one by one, each into the piece of the conversation it makes, so a conversation of any length is never one value: the
formatted conversation is its pieces, concatenated by position.

    <turn:ROLE>ESCAPED CONTENT</turn>\\n        one turn
    <image:0>  <audio:1>  <document:2>          placeholders, numbered within the message

Inside texts and roles the four characters \\ < > # are written \\\\ \\l \\g \\h, so no text can hold a control string, and reading
back is exact. Only contents of assistant turns are under the loss mask, placeholders excepted.

Rows and nulls: turns stand by turn (null first), then role and text; rows with equal turns are turns of their own. Null roles
and texts are empty; parts of an unknown type are an error; a null conversation id is a conversation of its own. A
conversation without rows has no output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g", "#": "\\h"}
_PLAIN = {v: k for k, v in _ESCAPES.items()}
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
PIECE = ("piece string, chars int, mask array<struct<start:int,end:int>>, "
         "attachments array<struct<placeholder:string,type:string,uri:string,tokens:int>>, tokens int")


def escape(text: str) -> str:
    return re.sub(r"[\\<>#]", lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lgh]", lambda m: _PLAIN[m[0]], text)


class Flatten:
    """Visits the parts of one message; text holds what they become, attachments what the placeholders stand for."""

    PATCH, FRAMES, PAGE = 28, 25, 512  # pixels a side of an image token, audio tokens a second, tokens a page

    def __init__(self) -> None:
        self.text, self.spans, self.attachments, self.tokens, self.at = [], [], [], 0, 0

    def visit(self, part: Any) -> None:
        method = getattr(self, f"visit_{part['type']}", None)
        if method is None:
            raise ValueError(f"unknown content part {part['type']!r}")
        method(part)

    def _add(self, text: str) -> None:
        self.text.append(text)
        self.at += len(text)

    def visit_text(self, part: Any) -> None:
        text = escape(part["text"] or "")
        if text:
            self.spans.append((self.at, self.at + len(text)))
        self.tokens += len((part["text"] or "").split())
        self._add(text)

    def _attach(self, part: Any, tokens: int) -> None:
        name = f"<{part['type']}:{len(self.attachments)}>"
        self.attachments.append({"placeholder": name, "type": part["type"], "uri": part["uri"], "tokens": tokens})
        self.tokens += tokens
        self._add(name)

    def visit_image(self, part: Any) -> None:
        tall, wide = -(-int(part["height"] or 0) // self.PATCH), -(-int(part["width"] or 0) // self.PATCH)
        self._attach(part, tall * wide)

    def visit_audio(self, part: Any) -> None:
        self._attach(part, round(float(part["seconds"] or 0) * self.FRAMES))

    def visit_document(self, part: Any) -> None:
        self._attach(part, int(part["pages"] or 0) * self.PAGE)


def format_turn(role: str | None, parts: list[Any]) -> dict[str, Any]:
    seen = Flatten()
    for part in parts:
        seen.visit(part)
    head = f"<turn:{escape(role or '')}>"
    piece = f"{head}{''.join(seen.text)}</turn>\n"
    mask = [{"start": a + len(head), "end": b + len(head)} for a, b in seen.spans] if role == "assistant" else []
    return {"piece": piece, "chars": len(piece), "mask": mask, "attachments": seen.attachments, "tokens": seen.tokens}


def format_turns(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """Every row of messages with its piece of the formatted conversation: piece, chars (code points), mask (spans under
    the loss, in code points of the piece), attachments, tokens (expanded). messages has role and `parts`, an array of PART."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in messages.schema if f.name != parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [format_turn(r, p if p is not None else []) for r, p in zip(b["role"], b[parts], strict=True)]
            out = b.drop(columns=parts).reset_index(drop=True)
            for name in ("piece", "chars", "mask", "attachments", "tokens"):
                out[name] = [m[name] for m in made]
            yield out

    return messages.mapInPandas(run, f"{schema}, {PIECE}")


_TURN = re.compile(r"<turn:([^<>]*)>([^<>]*(?:<\w+:\d+>[^<>]*)*)</turn>\n")


def read_turn(piece: str) -> tuple[str, str]:
    """Role and content of one piece, unescaped; placeholders stay as they are."""
    m = _TURN.fullmatch(piece)
    if m is None:
        raise ValueError("not one formatted turn")
    return unescape(m[1]), unescape(m[2])


def plain(escaped: Column) -> Column:
    """unescape() as a column. No raw # is in an escaped text, so it can stand for the backslash until the other three are back."""
    out = F.replace(escaped, F.lit("\\\\"), F.lit("#"))
    for code, char in (("\\l", "<"), ("\\g", ">"), ("\\h", "\\")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.translate(out, "#\\", "\\#")


def digests(pieces: DataFrame, key: str = "conv_id") -> DataFrame:
    """What can be read back from formatted conversations: key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    pieces: key, turn, piece, mask. The pieces of a conversation stream by in order; only running digests are held."""
    kind = dict(pieces.dtypes)[key]
    role = F.regexp_extract("piece", "^<turn:([^<>]*)>", 1)
    text = F.substr(F.col("piece"), F.length(role) + F.lit(8), F.length("piece") - F.length(role) - F.lit(15))
    ordered = pieces.select(F.col(key).cast("string").alias("_k"), "turn", "piece", "mask", plain(role).alias("_role"), plain(text).alias(
        "_text")).repartition("_k").sortWithinPartitions("_k", "turn", "_role", "_text").drop("_role", "_text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state, out = False, None, []

        def close() -> None:
            out.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        for b in batches:
            keys = [None if k is None or k != k else k for k in b["_k"]]
            for k, piece, mask in zip(keys, b["piece"], b["mask"], strict=True):
                if not held or k != state[0]:
                    if held:
                        close()
                    held, state = True, [k, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(piece)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in mask:
                    loss = unescape(piece[span["start"]:span["end"]])
                    state[3] += len(loss)
                    state[4].update(loss.encode("utf-8", "surrogatepass"))
                state[5] += len(piece)
            yield frame(out)
            out.clear()
        if held:
            close()
            yield frame(out)

    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({key: object})

    read = ordered.mapInPandas(run, f"`{key}` string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                    "formatted_chars long")
    return read.withColumn(key, F.col(key).cast(kind))
