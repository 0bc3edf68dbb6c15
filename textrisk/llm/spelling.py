"""Spelling variants: words one edit from a much more frequent one.

With one edit, either the first or the last half of a word is unchanged. So words are dealt by
their halves: a word looks for its variants among the words that share its first half, and among
those that share its last one. As lengths differ by one at most, a word is found under two
lengths of either half. The words of some halves make up a bucket, one FM-index each
(``fm_index``), which matches the shared half exactly and the rest with one edit. A half of very
many words is cut into several buckets, and its searching words go to all of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.llm.fm_index import VocabularyIndex
from textrisk.llm.words import small_batches
from textrisk.operators.lookups import BROADCAST_ROWS
from textrisk.session import staged

#: Words of a bucket: on average, and at most under one half.
BUCKET_WORDS = 16_384
MOST_WORDS = 65_536
#: Least number of buckets, so that small inputs use several executors too.
LEAST_BUCKETS = 24
# Different words that a task collects before it hands them on.
_BUFFER = 1 << 19

_ASCII_LOWER = {upper: upper + 32 for upper in range(65, 91)}


def misspelt(word: str, seed: int, one_in: int) -> str:
    """``word`` without one character, for one of ``one_in`` seeds (32-bit numbers)."""
    if seed % one_in:
        return word
    place = seed % len(word)
    return word[:place] + word[place + 1 :]


def _count_words(batches, least_length: int, one_in: int | None):
    """Input columns: id as string, text."""
    # Shorter runs give no word: a word is never longer than its run.
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{max(least_length, 1)},}}")
    found: Counter = Counter()

    def rows():
        words, counts = list(found), list(found.values())
        found.clear()
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    for batch in batches:
        for name, text in zip(batch.column(0), batch.column(1)):
            own: Counter = Counter()
            for run, count in Counter(runs.findall(text.as_py() or "")).items():
                own[run.lower() if run.isascii() else run.translate(_ASCII_LOWER)] += count
            begun = zlib.crc32(f"{name.as_py() or ''}:".encode())
            for run, count in own.items():
                word = misspelt(run, zlib.crc32(run.encode(), begun), one_in) if one_in else run
                if len(word) >= least_length:
                    found[word] += count
            if len(found) >= _BUFFER:
                yield from rows()
    if found:
        yield from rows()


def word_counts(
    documents: DataFrame, least_length: int = 7, least_count: int = 2, one_in: int | None = 31
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts: runs of ASCII and Latin-1 letters, A-Z
    read as a-z, of at least ``least_length`` characters.

    With ``one_in``, a run loses one character if the crc32 of ``<doc_id>:<run>`` is divisible
    by it; the remainder by the run's length is the character's place. A null ``doc_id`` reads
    as empty, null texts have no words, repeated rows count as often as they are there, further
    columns are ignored.
    """
    small_batches(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(
        lambda batches: _count_words(batches, least_length, one_in), "word string, n bigint"
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _halves(words: DataFrame) -> DataFrame:
    """Each word under two lengths of its first part and of its last one. ``asks`` marks the
    halves with which it looks for others."""
    length = F.length("word")
    first = F.floor(length / 2).cast("int")
    last = length - first
    even = length % 2 == 0
    other_first = F.when(even, first - 1).otherwise(first + 1)
    other_last = F.when(even, last + 1).otherwise(last - 1)
    ends = [
        (side, size, asks)
        for side, own, other in (("first", first, other_first), ("last", last, other_last))
        for size, asks in ((own, True), (other, False))
    ]

    def part(side: str, size):
        return F.left("word", size) if side == "first" else F.right("word", size)

    rows = F.array(*[
        F.struct(
            F.lit(side).alias("side"), F.concat(F.lit(f"{side}:"), part(side, size)).alias("half"),
            F.lit(asks).alias("asks"),
        )
        for side, size, asks in ends
    ])
    return words.select("word", "n", F.inline(rows))


def _buckets(rows: DataFrame, words: int, bucket_words: int, most_words: int) -> DataFrame:
    """With the ``bucket`` of each row, and whether it ``holds`` the word or only asks there."""
    buckets = max(-(-4 * words // bucket_words), LEAST_BUCKETS)
    dealt = F.concat_ws(":", "side", F.pmod(F.xxhash64("half"), F.lit(buckets)).cast("string"))
    large = staged(
        rows.groupBy("half").agg(F.count(F.lit(1)).alias("words"))
        .where(F.col("words") > most_words)
        .select("half", F.ceil(F.col("words") / F.lit(most_words)).cast("int").alias("cuts"))
    )
    if large.isEmpty():
        return rows.select(dealt.alias("bucket"), "side", "word", "n", "asks", F.lit(True).alias("holds"))
    known = large.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    marked = rows.join(F.broadcast(large), "half", "left") if known else rows.hint("merge").join(large, "half", "left")
    own = F.pmod(F.xxhash64("word", F.lit(7)), F.coalesce("cuts", F.lit(1))).cast("int")
    visits = F.when(F.col("asks") & F.col("cuts").isNotNull(), F.sequence(F.lit(0), F.col("cuts") - 1)).otherwise(
        F.array(own)
    )
    spread = marked.withColumn("own", own).withColumn("cut", F.explode(visits))
    return spread.select(
        F.when(F.col("cuts").isNull(), dealt).otherwise(F.concat_ws("#", "half", "cut")).alias("bucket"),
        "side", "word", "n", "asks", (F.col("own") == F.col("cut")).alias("holds"),
    )


_BEST = pa.schema(
    [("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]
)


#: Words whose variants are looked up side by side.
_ASKED = 1 << 13


def _search(table: pa.Table) -> pa.Table:
    """The words near each word that asks in a bucket: how many, and the most frequent one."""
    first = table.column("side")[0].as_py() == "first"
    held: dict[str, int] = {}
    asking: set[str] = set()
    for word, n, asks, holds in zip(*(table.column(c).to_pylist() for c in ("word", "n", "asks", "holds"))):
        if holds:
            held[word] = n
        if asks:
            asking.add(word)
    names = sorted(word[::-1] if first else word for word in held)
    plain = [name[::-1] for name in names] if first else names
    order = np.empty(len(plain), np.int64)
    order[sorted(range(len(plain)), key=plain.__getitem__)] = np.arange(len(plain))
    counts = np.array([held[word] for word in plain], np.int64)
    index = VocabularyIndex(names)
    asked = sorted(asking)
    parts = [
        _best_near(index, plain, counts, order, asked[begin : begin + _ASKED], first)
        for begin in range(0, len(asked), _ASKED)
    ]
    return pa.concat_tables([_BEST.empty_table(), *parts])


def _best_near(index, plain, counts, order, words: list[str], first: bool) -> pa.Table:
    lengths = np.array([len(word) for word in words], np.int64)
    half = lengths // 2
    read = [word[::-1] for word in words] if first else words
    who, near = index.near(read, half if first else lengths - half)
    if not first:
        # Those that share the first half too are found there. They differ in length.
        kept = np.ones(len(who), bool)
        for pair in np.flatnonzero(lengths[who] != index.lengths[near]).tolist():
            word = words[who[pair]]
            kept[pair] = not plain[near[pair]].startswith(word[: len(word) // 2])
        who, near = who[kept], near[kept]
    ranked = np.lexsort((order[near], -counts[near], who))
    who, near = who[ranked], near[ranked]
    word, begin, found = np.unique(who, return_index=True, return_counts=True)
    best = near[begin]
    columns = [[words[i] for i in word], found, counts[best], [plain[i] for i in best]]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _BEST.types)], schema=_BEST)


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form reached from each word with a ``form``. Each round
    doubles the steps; a form is more frequent than its word, so the chains end."""
    links = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(links.join(onward, "root", "left").select("word", "root", "next"))
        links = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next is not null").isEmpty():
            return links


def group_variants(
    words: DataFrame,
    ratio: int = 10,
    bucket_words: int = BUCKET_WORDS,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """Per word of ``words`` (``word``, ``n``; one row each) its ``n``, ``n_near`` (words made by
    one inserted, deleted or replaced character), ``form`` (the most frequent of these, ties to
    the first in the order of characters, if it is at least ``ratio`` times as frequent), that
    one's ``form_n``, and ``root`` (the last form in a row of forms, or the word itself).

    Null words are left out. ``ratio`` must be above 1. An index holds ``bucket_words`` words
    on average, and ``most_words`` of one half.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its word")
    known = staged(words.select("word", F.col("n").cast("bigint").alias("n")).where("word is not null"))
    rows = _buckets(_halves(known), known.count(), bucket_words, most_words)
    found = rows.groupBy("bucket").applyInArrow(
        lambda table: _search(table), "word string, n_near bigint, best_n bigint, best string"
    )
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("order"), "best")).alias("first")
    )
    enough = -F.col("first.order") >= F.col("n") * ratio
    formed = staged(
        known.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(enough, F.col("first.best")).alias("form"),
            F.when(enough, -F.col("first.order")).alias("form_n"),
        )
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
