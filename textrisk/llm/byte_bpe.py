r"""Byte-level BPE by ranks from a local file: encoding of whole texts and raw-byte decoding.

The library splits a text by a pattern and merges the bytes of each match by rank. Long texts
are handed to it in pieces, cut where no match can reach across. The pattern's matches hold white
space only at their start, so one of them always ends between a character that is no white space
and white space behind it, and the matches on both sides are those of the whole text. A very
long run of white space is more than the library's pattern matching can hold. All but its last
character, or all at the end of the text, is one match of the pattern and is merged as such.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textrisk.llm.words import slices, small_batches

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Characters from which on a text is cut, and the least length of a piece.
PIECE_CHARS = 1 << 18
#: White space from which on a run is a piece of its own.
LONG_RUN = 1 << 16
#: Tokens that are decoded at once; one longer list is decoded by itself.
TOKENS = 1 << 18

# The characters with the Unicode property White_Space.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BOUNDARY = re.compile(f"(?<=[^{_SPACE}])[{_SPACE}]")


@lru_cache(maxsize=8)
def load_ranks(path: str, pattern: str):
    """The encoding of a rank file, and one that merges a whole string as one match."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tuple(
        tiktoken.Encoding(path, pat_str=one, mergeable_ranks=ranks, special_tokens={})
        for one in (pattern, r"[\s\S]+")
    )


def pieces(text: str, size: int = PIECE_CHARS, long_run: int = LONG_RUN) -> Iterator[tuple[str, bool]]:
    """The text in pieces that can be encoded one by one, and whether a piece is one match."""
    if len(text) <= min(size, long_run):
        yield text, False
        return
    begin = 0
    for run in re.finditer(f"[{_SPACE}]{{{max(long_run, 2)},}}", text):
        yield from _cut(text, begin, run.start(), size)
        begin = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : begin], True
    yield from _cut(text, begin, len(text), size)


def _cut(text: str, begin: int, end: int, size: int) -> Iterator[tuple[str, bool]]:
    while end - begin > size:
        found = _BOUNDARY.search(text, begin + size, end)
        if not found:
            break
        yield text[begin : found.start()], False
        begin = found.start()
    if end > begin:
        yield text[begin:end], False


def encode(text: str, encodings, size: int = PIECE_CHARS, long_run: int = LONG_RUN) -> list[int]:
    ids: list[int] = []
    for piece, single in pieces(text, size, long_run):
        ids += encodings[single].encode_ordinary(piece)
    return ids


def encode_texts(
    documents: DataFrame,
    columns: Sequence[str] = ("doc_id",),
    ranks: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Per row the ``columns`` and ``token_ids`` of the whole ``text``, without special tokens.

    Null and empty texts have no tokens; repeated rows give repeated results; further columns
    are ignored. ``ranks`` is a file that every executor can read. A map, no shuffle.
    """
    small_batches(documents.sparkSession)
    narrow = documents.select(*columns, F.col("text").cast("string").alias("_text"))
    kept = len(columns)

    def work(batches):
        encodings = load_ranks(ranks, pattern)
        for batch in batches:
            texts = batch.column(kept)
            for begin, end in slices(texts):
                found = [
                    np.array(encode(text.as_py() or "", encodings), np.int32) for text in texts[begin:end]
                ]
                bounds = np.cumsum([0, *map(len, found)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(found)))
                parts = [batch.column(i)[begin:end] for i in range(kept)]
                yield pa.RecordBatch.from_arrays([*parts, lists], [*columns, "token_ids"])

    tokens = T.StructField("token_ids", T.ArrayType(T.IntegerType()))
    schema = T.StructType([*narrow.schema.fields[:kept], tokens])
    return narrow.mapInArrow(work, schema)


def decode_tokens(
    encoded: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of ``token_ids``; null ids have none. The bytes of
    ids that were cut from a text need not be whole characters, so they stay bytes."""
    small_batches(encoded.sparkSession)
    place = encoded.columns.index("token_ids")

    def work(batches):
        merges, _ = load_ranks(ranks, pattern)
        for batch in batches:
            lists = batch.column(place)
            bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            begin = 0
            while begin < len(lists):
                # Rows of about so many tokens at once, one at least.
                end = int(np.searchsorted(bounds, bounds[begin] + TOKENS, "right")) - 1
                end = min(max(end, begin + 1), len(lists))
                decoded = [
                    merges.decode_bytes(flat[a:b].tolist()) for a, b in zip(bounds[begin:end], bounds[begin + 1 :])
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(begin, end - begin).columns, pa.array(decoded, pa.binary())],
                    [*batch.schema.names, "decoded"],
                )
                begin = end

    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(work, schema)
