r"""Chat formatting with loss masks aligned by character offsets.

A conversation is rendered whole, each turn as ``<|turn|>role<|text|>text<|end|>``. Control
strings inside roles and texts get a backslash after their first character, and one more if
they already have some there, so the original can be read back. The rendered string is encoded
once, with the template's marks as special tokens; tokens are matched with the turns' spans by
binary search, and those that overlap an assistant's text are under the loss mask.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.llm.words import small_batches

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TRAINED_ROLE = "assistant"

# Beginnings of the control strings of common chat templates.
_CONTROL = re.compile(r"(<)(\\*)(?=\||/?s>|</?SYS>>)|(\[)(\\*)(?=/?INST\])")
_ESCAPED = re.compile(r"(<)(\\*)\\(?=\||/?s>|</?SYS>>)|(\[)(\\*)\\(?=/?INST\])")

FORMATTED = (
    "conv_id bigint, formatted string, token_ids array<int>, token_starts array<int>, "
    "token_ends array<int>, loss_mask array<boolean>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: (m[1] or m[3]) + (m[2] or m[4] or "") + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: (m[1] or m[3]) + (m[2] or m[4] or ""), text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The rendered conversation and the spans of its trained texts."""
    parts, length, spans = [], 0, []
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == TRAINED_ROLE:
            spans.append((length + len(head), length + len(head) + len(body)))
        parts += [head, body, END]
        length += len(head) + len(body) + len(END)
    spans = np.array(spans, np.int64).reshape(-1, 2)
    return "".join(parts), spans[:, 0], spans[:, 1]


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    turns = []
    for turn in formatted.split(TURN)[1:]:
        role, _, rest = turn.partition(TEXT)
        turns.append((unescape(role), unescape(rest[: -len(END)])))
    return turns


def overlapping(starts, ends, span_starts, span_ends) -> np.ndarray:
    """Which of the sorted token ranges overlap one of the sorted, disjoint spans."""
    if not len(span_starts):
        return np.zeros(len(starts), bool)
    # The first span that ends behind the token's start is the only one to look at.
    place = np.searchsorted(span_ends, starts, "right")
    inside = np.minimum(place, len(span_starts) - 1)
    return (place < len(span_starts)) & (span_starts[inside] < ends) & (starts < ends)


def masked_text(formatted: str, starts, ends, mask) -> str:
    """All text under the mask, unescaped. Tokens that follow each other form one stretch; the
    tokens of one character share its range."""
    stretches: list[list[int]] = []
    for start, end, on in zip(starts, ends, mask):
        if not on:
            continue
        if stretches and start <= stretches[-1][1]:
            stretches[-1][1] = max(stretches[-1][1], end)
        else:
            stretches.append([start, end])
    return "".join(unescape(formatted[start:end]) for start, end in stretches)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_file(path)
    # Character ranges with the white space that a token begins with.
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    marks = [AddedToken(mark, special=True, normalized=False) for mark in (TURN, TEXT, END)]
    tokenizer.add_special_tokens(marks)
    return tokenizer


def _format_rows(batches, path: str, schema: pa.Schema):
    """Input columns: conv_id, turns."""
    tokenizer = load_tokenizer(path)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rendered = [
            render([(turn["role"] or "", turn["text"] or "") for turn in turns])
            for turns in batch.column(1).to_pylist()
        ]
        for begin in range(0, len(ids), 256):
            rows = []
            some = rendered[begin : begin + 256]
            encoded = tokenizer.encode_batch([one[0] for one in some], add_special_tokens=False)
            for conv_id, (text, lo, hi), tokens in zip(ids[begin:], some, encoded):
                offsets = np.array(tokens.offsets, np.int64).reshape(-1, 2)
                mask = overlapping(offsets[:, 0], offsets[:, 1], lo, hi)
                rows.append(
                    {"conv_id": conv_id, "formatted": text, "token_ids": tokens.ids,
                     "token_starts": offsets[:, 0], "token_ends": offsets[:, 1], "loss_mask": mask}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def format_chats(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per conversation the rendered text, its tokens with character ranges, and the mask.

    Rows (``conv_id``, ``turn``, ``role``, ``text``) are ordered by turn, then role and text;
    rows without turn come first. Null roles and texts are empty, repeated rows are repeated
    turns, rows without ``conv_id`` form one conversation. Further columns are ignored.
    ``tokenizer`` is a file that every executor can read.
    """
    small_batches(conversations.sparkSession)
    turns = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = conversations.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turns)).alias("turns")
    )
    schema = _schema(FORMATTED)
    return whole.mapInArrow(lambda batches: _format_rows(batches, tokenizer, schema), FORMATTED)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def _digest_rows(batches, schema: pa.Schema):
    for batch in batches:
        rows = []
        columns = [batch.column(name) for name in batch.schema.names]
        for conv_id, text, _, starts, ends, mask in zip(*(c.to_pylist() for c in columns)):
            turns = read_turns(text)
            said = "".join(f"{role}\n{one}\n" for role, one in turns)
            loss = masked_text(text, starts, ends, mask)
            rows.append(
                {"conv_id": conv_id, "n_turns": len(turns),
                 "turns_sha256": hashlib.sha256(said.encode()).hexdigest(), "loss_chars": len(loss),
                 "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(text)}
            )
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the mask, from the formatted output alone."""
    schema = _schema(DIGESTS)
    return formatted.mapInArrow(lambda batches: _digest_rows(batches, schema), DIGESTS)
