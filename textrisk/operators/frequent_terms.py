"""TF-IDF of the most frequent terms of one or two words, without a shuffle of all terms.

All pairs of words are more than the texts. A task counts the terms of its texts and tells the most
frequent of them, and the largest count it does not tell. Sums of the told counts, and those with the
largest counts of the tasks that did not tell, bound the count of every term: terms that may be among the
most frequent are candidates. Their exact counts are then kept per text, from which the vocabulary and
the weights follow. If the bounds cannot exclude a term that no task told, all terms are counted
(``textvec.vocabulary``); the result is the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from textrisk.functions import text
from textrisk.operators.lookups import BROADCAST_ROWS
from textrisk.operators.textvec import _KNOWN, _lists_of, _weigh, count_terms, one_per_term, term_weights, vocabulary
from textrisk.session import staged

#: Terms a task tells, as a multiple of those wanted.
TOLD = 4
#: Words of texts that are counted together, about; counts that wait to be summed up, and distinct terms
#: after which a task tells and begins anew, about.
_WORDS_AT_ONCE, _WAITING, _TERMS_AT_ONCE = 500_000, 1_000_000, 4_000_000


def weigh_frequent(
    texts: DataFrame, keys: Sequence[str], max_features: int, min_df: int = 2, max_df: float = 1.0,
    sublinear: bool = False, told: int = TOLD,
) -> DataFrame:
    """``term_weights`` of the vocabulary of the texts (``text``) with terms of one or two words."""
    words = staged(texts.select(*keys, _joined(text.tokens("text")).alias("words")))
    documents = words.count()
    candidates = _candidates(words, documents, max_features, min_df, max_df, told)
    if candidates is None:
        counted = count_terms(_with_terms(words), keys)
        counts = one_per_term(counted, keys)
        terms = staged(vocabulary(counts, documents, min_df, max_df, max_features))
        return term_weights(counted, terms, keys, sublinear)
    known = staged(_known(words, candidates, keys))
    sums = known.select(F.inline("counts")).groupBy("place").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf")
    )
    numbered = words.sparkSession.createDataFrame(
        pa.table({"place": pa.array(range(len(candidates)), pa.int32()), "term": candidates})
    )
    counts = sums.join(F.broadcast(numbered), "place")  # at most BROADCAST_ROWS rows
    kept = counts.where((F.col("df") >= min_df) & (F.col("df") <= float(max_df) * documents))
    idf = F.log((1.0 + documents) / (F.col("df") + 1.0)) + 1.0
    # max_features rows
    found = kept.orderBy(F.desc("cf"), "term").limit(max_features).select("place", "term", idf.alias("idf")).toArrow()
    return _weigh(
        known, found.column("place").to_numpy(), found.column("term"), found.column("idf").to_numpy(), keys, sublinear
    )


def _joined(words: Column) -> Column:
    return F.concat_ws(" ", words)


def _with_terms(words: DataFrame) -> DataFrame:
    split = F.filter(F.split("words", " "), lambda word: word != "")
    return words.withColumn("_words", split).withColumn("terms", F.concat("_words", text.ngrams("_words", 2)))


def _candidates(
    words: DataFrame, documents: int, max_features: int, min_df: int, max_df: float, told: int
) -> pa.Array | None:
    """Terms that may be among the ``max_features`` most frequent; None if any term may."""

    def work(batches):
        yield from _told(batches, told * max_features)

    partial = staged(
        words.select("words").mapInArrow(work, "term string, df bigint, cf bigint, untold bigint")
    )
    # One row per part of a task.
    whole = partial.where("term is null").agg(F.sum("df").alias("df"), F.sum("untold").alias("untold")).first()
    if not whole["df"]:
        return pa.array([], pa.string())
    untold = whole["untold"]
    sums = staged(
        partial.where("term is not null").groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.sum("untold").alias("untold"))
        .select("term", "df", "cf", (F.col("cf") + (F.lit(untold) - F.col("untold"))).alias("most"))
    )
    # So many terms at most are in more than the share max_df of the texts.
    wanted = max_features + (math.ceil(whole["df"] / (max_df * documents)) if max_df < 1.0 else 0)
    top = sums.where(F.col("df") >= min_df).orderBy(F.desc("cf")).limit(wanted)
    floor = top.agg(F.count(F.lit(1)).alias("n"), F.min("cf").alias("cf")).first()
    least = floor["cf"] if floor["n"] == wanted else 1
    if untold >= least:
        return None
    chosen = sums.where(F.col("most") >= least).select("term")
    if chosen.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return None
    return chosen.toArrow().column("term").combine_chunks().cast(pa.string())


def _told(batches, most: int):
    """The ``most`` most frequent terms of a task's texts with ``df``, ``cf`` and the largest count ``untold``;
    and a row without term, with the sum of all ``df``. Very many terms are told in parts."""
    known, sums, waiting = pa.array([], pa.string()), _NO_SUMS, []
    for batch in batches:
        for part in _runs(batch):
            names, first, second, _, begins, tf = _counted(part.column(0))
            if not len(begins):
                continue
            known = pa.concat_arrays([known, names.filter(pc.invert(pc.is_in(names, value_set=known)))])
            number = pc.index_in(names, value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)
            # A code is the number of the second word, and of the first one behind it.
            code = number[second[begins]] + (np.where(first[begins] < 0, -1, number[first[begins]]) + 1 << 31)
            waiting.append(np.stack([code, np.diff(begins, append=len(tf)), np.add.reduceat(tf, begins)]))
            if sum(one.shape[1] for one in waiting) > max(_WAITING, sums.shape[1]):
                sums, waiting = _summed([sums, *waiting]), []
            if sums.shape[1] > _TERMS_AT_ONCE:
                yield _most_told(known, sums, most)
                known, sums = pa.array([], pa.string()), _NO_SUMS
    yield _most_told(known, _summed([sums, *waiting]), most)


#: Code, ``df`` and ``cf`` of no term.
_NO_SUMS = np.zeros((3, 0), np.int64)


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    code, df, cf = np.concatenate(parts, axis=1)
    order = np.argsort(code, kind="stable")
    code, df, cf = code[order], df[order], cf[order]
    begins = np.flatnonzero(np.diff(code, prepend=-1))
    return np.stack([code[begins], np.add.reduceat(df, begins), np.add.reduceat(cf, begins)]) if len(begins) else _NO_SUMS


def _most_told(words: pa.Array, sums: np.ndarray, most: int) -> pa.RecordBatch:
    code, df, cf = sums
    some, untold = np.arange(len(cf)), 0
    if len(cf) > most:
        order = np.argpartition(-cf, most)
        some, untold = order[:most], int(cf[order[most:]].max())
    terms = _names(words, (code[some] >> 31) - 1, code[some] & ((1 << 31) - 1))
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([terms, pa.nulls(1, pa.string())]), pa.array(np.append(df[some], df.sum())),
            pa.array(np.append(cf[some], 0)), pa.array(np.full(len(some) + 1, untold)),
        ],
        ["term", "df", "cf", "untold"],
    )


def _known(words: DataFrame, candidates: pa.Array, keys: Sequence[str]) -> DataFrame:
    """Per text the counts of the candidates, by their place."""
    rows = words.select(*keys, "words")
    kept = rows.drop("words").schema.fields

    def work(batches):
        for batch in batches:
            for part in _runs(batch):
                names, first, second, row, begins, tf = _counted(part.column(part.num_columns - 1))
                found = pc.index_in(_names(names, first[begins], second[begins]), value_set=candidates)
                place = found.fill_null(-1).to_numpy(zero_copy_only=False)
                place = np.repeat(place, np.diff(np.append(begins, len(tf)))) if len(begins) else place
                some = np.flatnonzero(place >= 0)
                some = some[np.argsort(row[some], kind="stable")]
                counts = _lists_of(row[some], place[some], tf[some], part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], counts], [*(one.name for one in kept), "counts"])

    return rows.mapInArrow(work, StructType([*kept, StructField("counts", ArrayType(_KNOWN))]))


def _runs(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """Runs of rows with about ``_WORDS_AT_ONCE`` words, or one row."""
    size = pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False)
    run = np.cumsum(size, dtype=np.int64) // (6 * _WORDS_AT_ONCE)
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    return [batch.slice(begin, end - begin) for begin, end in zip(cuts[:-1], cuts[1:])]


def _names(words: pa.Array, first: np.ndarray, second: np.ndarray) -> pa.Array:
    """Terms by the places of their words; without a first word (-1) a term is one word."""
    one = pa.array(second).take(pa.array(np.flatnonzero(first < 0)))
    two = np.flatnonzero(first >= 0)
    pairs = pc.binary_join_element_wise(words.take(pa.array(first[two])), words.take(pa.array(second[two])), " ")
    order = np.argsort(np.concatenate([np.flatnonzero(first < 0), two]), kind="stable")
    return pa.concat_arrays([words.take(one), pairs]).take(pa.array(order))


def _counted(joined: pa.Array) -> tuple:
    """Different words; the places of the words of each entry (term and text), ordered by term and
    text; its row and count; and where a term begins."""
    lists = pc.split_pattern(joined, " ")
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    full = pc.not_equal(flat, "")
    flat, row = flat.filter(full), row[full.to_numpy(zero_copy_only=False)]
    coded = flat.dictionary_encode()
    names, word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    size, rows = len(names) + 1, max(len(joined), 1)
    pair = np.flatnonzero(row[1:] == row[:-1])
    # The first word (0 without one), the second and the row in one number: a slice has few of all.
    keys = np.concatenate([word * rows + row, ((word[pair] + 1) * size + word[pair + 1]) * rows + row[pair]])
    keys.sort()
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    tf = np.diff(starts, append=len(keys))
    term, row = np.divmod(keys[starts], rows)
    begins = np.flatnonzero(np.diff(term, prepend=-1))
    first, second = np.divmod(term, size)
    return names, first - 1, second, row, begins, tf
