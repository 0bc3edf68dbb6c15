"""From chat exports to a labelling sample and a run summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.functions.risk import Lexicon, add_features
from textrisk.operators.labels import weak_labels
from textrisk.operators.lookups import BROADCAST_ROWS, join_lookup
from textrisk.operators.messages import clean_messages, file_counters, pseudonyms
from textrisk.operators.sampling import labeling_sample
from textrisk.session import spread_small, staged
from textrisk.sources.exports import read_chat_exports
from textrisk.sources.samples import read_sample, write_sample, write_summary


def message_table(raw: DataFrame, lexicon: Lexicon = Lexicon(), count_shouted: bool = False) -> DataFrame:
    """Clean messages with features, staged: texts are masked and counted once."""
    return staged(add_features(clean_messages(raw), "text", lexicon, count_shouted))


def draw_messages(
    raw: DataFrame,
    size: int,
    seed: int = fixed.DEFAULT_SEED,
    lexicon: Lexicon = Lexicon(),
    candidate: Column | None = None,
    count_shouted: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The labelling sample of raw messages with its users named, and the names of all users.

    Hashes and numbers of all messages are staged, their texts are not: those of the drawn
    messages are read again and masked.
    """
    clean = clean_messages(raw, keep=("file", "id"))
    numbers = staged(add_features(clean, "text", lexicon, count_shouted).drop("text"))
    names = staged(pseudonyms(numbers.select("raw_user_id")))
    drawn = staged(labeling_sample(numbers, size, seed, candidate))
    ids = drawn.select(F.col("file").alias("_file"), F.col("id").alias("_id")).distinct()
    if size <= BROADCAST_ROWS:  # the sample has at most ``size`` rows
        ids = F.broadcast(ids)
    same = F.col("file").eqNullSafe(F.col("_file")) & F.col("id").eqNullSafe(F.col("_id"))
    again = clean_messages(raw.join(ids, same, "left_semi")).select("message_hash", "text")
    # copies of a message have one hash and one text
    texts = again.dropDuplicates(["message_hash"])
    named = join_lookup(drawn.drop("file", "id"), names, "raw_user_id", "user_rows")
    return named.join(texts, "message_hash"), names


def prepare_sample(
    spark: SparkSession,
    paths: str | Sequence[str],
    sample_path: str,
    summary_path: str,
    size: int = fixed.DEFAULT_SAMPLE_SIZE,
    seed: int = fixed.DEFAULT_SEED,
    lexicon: Lexicon = Lexicon(),
    candidate: Column | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Read the exports, draw and write the sample, write the summary; the sample as written.

    Rows are drawn before the users are named, so only the sample is joined with the
    pseudonyms.
    """
    raw = read_chat_exports(spark, paths, spread)
    if spread is None:
        raw = spread_small(raw, "file", "id", "date")
    sample, names = draw_messages(raw, size, seed, lexicon, candidate, count_shouted=True)
    write_sample(sample.select(*fixed.SAMPLE_COLUMNS), sample_path, rounded=True)
    written = read_sample(spark, sample_path)
    write_summary(file_counters(raw), names.count(), written.count(), sample_path, summary_path)
    return written


def label_sample(spark: SparkSession, sample_path: str, labelled_path: str) -> DataFrame:
    """Write weak labels for a sample; fails when they would give one class only."""
    labelled = weak_labels(read_sample(spark, sample_path).drop("toxic"))
    labelled = staged(labelled)
    if labelled.select("toxic").distinct().limit(2).count() < 2:
        raise ValueError("weak labels give one class only")
    write_sample(labelled, labelled_path)
    return labelled
