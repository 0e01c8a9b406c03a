r"""Chat formatting: conversations through a compiled template, with a loss mask, and back.

A control string is escaped inside a text by a backslash after its first character; a stretch that looks
like an escaped one gets one backslash more, and reading back takes one off. So no control string of the
template can come from a text, and every text comes back as it was.

Defined results: null text and null role are empty; a null conversation id is a conversation of its own;
a null turn comes first; rows of equal turn are ordered by role, then text, and each is a turn; other
columns are ignored; an empty table gives no rows. One conversation's turns are in memory at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import small_batches
from .templates import compile_template

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Strings that no formatted text may hold by itself; the first three are the template's.
CONTROLS = (TURN, SAYS, END, "<s>", "</s>", "[INST]", "[/INST]")

TEMPLATE = """
{%- for message in messages -%}
{{ "<|turn|>" ~ (message.role | escape) ~ "<|says|>" }}
{%- if message.role == "assistant" -%}
{% generation %}{{ message.content | escape }}{% endgeneration %}
{%- else -%}
{{ message.content | escape }}
{%- endif -%}
{{ "<|end|>" ~ "\\n" }}
{%- endfor -%}
"""

_LIKE = re.compile("|".join(f"{re.escape(c[0])}(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(f"({re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS))


def escape(text: str) -> str:
    return _LIKE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0], text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; fails on anything that the template can't have written."""
    out, at = [], 0
    while at < len(formatted):
        says = formatted.index(SAYS, at)
        end = formatted.index(END, says)
        if not formatted.startswith(TURN, at) or not formatted.startswith(END + "\n", end):
            raise ValueError(f"no turn at {at}")
        out.append((unescape(formatted[at + len(TURN) : says]), unescape(formatted[says + len(SAYS) : end])))
        at = end + len(END) + 1
    return out


def masked(formatted: str, spans: list) -> str:
    """All text under the loss mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def format_chats(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """turns (conv_id, turn, role, text) -> conv_id, formatted, loss_spans (array of start, end)."""
    small_batches(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = compile_template(template, escape)
        nothing = object()
        key, messages, out, held = nothing, [], [], 0

        def flush():
            if key is not nothing:
                text, spans = write(messages=messages)
                out.append((key, text, [{"start": a, "end": b} for a, b in spans]))

        for b in batches:
            ids = b["conv_id"].astype(object).where(b["conv_id"].notna(), None)
            for cid, role, text in zip(ids, b["role"], b["text"], strict=True):
                cid = None if cid is None else int(cid)
                if key is nothing or cid != key:
                    flush()
                    key, messages = cid, []
                messages.append({"role": role, "content": text})
                held += len(text)
            if held > 4_000_000:
                yield _frame(out)
                out, held = [], 0
        flush()
        yield _frame(out)

    return rows.mapInPandas(render, "conv_id long, formatted string, loss_spans array<struct<start:int,end:int>>")


def _frame(out: list) -> pd.DataFrame:
    frame = pd.DataFrame(out, columns=["conv_id", "formatted", "loss_spans"])
    return frame.astype({"conv_id": "Int64"})


def digest(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives: counts and digests."""

    def read(batches):
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            out = []
            for cid, text, spans in zip(b["conv_id"], b["formatted"], b["loss_spans"], strict=True):
                turns = read_back(text)
                loss = masked(text, [(s["start"], s["end"]) for s in spans])
                out.append((None if pd.isna(cid) else int(cid), len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            frame = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield frame.astype({"conv_id": "Int64"})

    return formatted.mapInPandas(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
