"""Feature vectors: TF-IDF over word n-grams next to imputed, scaled numbers.

Fitting looks at the training rows once for the vocabulary (one aggregation) and once for
the numbers. Applying the fitted block is a map: no shuffle, the vocabulary (bounded by
``max_features``) travels with the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from textrisk.functions import fixed, text
from textrisk.operators.lookups import BROADCAST_ROWS, join_lookup
from textrisk.operators.quantiles import exact_quantiles, value_cell
from textrisk.session import staged, staged_folder


def add_terms(
    df: DataFrame, column: str = "text", ngram_range: tuple[int, int] = (1, 2), name: str = "terms"
) -> DataFrame:
    """Append the array of n-grams of each text."""
    low, high = ngram_range
    worded = df.withColumn("_words", text.tokens(column))
    parts = [text.ngrams("_words", n) for n in range(low, high + 1)]
    return worded.withColumn(name, F.concat(*parts) if len(parts) > 1 else parts[0]).drop("_words")


def term_counts(df: DataFrame, keys: Sequence[str], terms: str = "terms") -> DataFrame:
    """One row per text and distinct term, with its count ``tf``."""
    return one_per_term(count_terms(df, keys, terms), keys)


def one_per_term(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Texts without terms give no row. The outer form is used since Spark derives a filter on
    the array from the inner one, which would count the terms a second time."""
    return counted.select(*keys, F.inline_outer("counts")).where(F.col("term").isNotNull())


def count_terms(df: DataFrame, keys: Sequence[str], terms: str = "terms") -> DataFrame:
    """``keys`` and the array ``counts`` of each text's distinct terms with their count ``tf``.

    A map: each task numbers the terms of a batch of texts and counts the numbers, so the text's
    words never cross a shuffle to be counted. Terms are in order; null terms count for nothing,
    and null stays null.
    """
    rows = df.select(*[F.col(key) for key in keys], F.col(terms).alias("_terms"))
    kept = rows.drop("_terms").schema.fields
    counted = StructType([StructField("term", StringType()), StructField("tf", IntegerType())])

    def work(batches):
        for batch in batches:
            for part in _of_few_terms(batch):
                counts = _counted_lists(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], counts], [*(one.name for one in kept), "counts"]
                )

    return rows.mapInArrow(work, StructType([*kept, StructField("counts", ArrayType(counted))]))


#: Terms counted together, about.
_TERMS_AT_ONCE = 2_000_000


def _of_few_terms(batch: pa.RecordBatch):
    """Runs of rows with up to ``_TERMS_AT_ONCE`` terms, or one row."""
    lengths = batch.column(batch.num_columns - 1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(lengths, dtype=np.int64) // _TERMS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    return [batch.slice(begin, end - begin) for begin, end in zip(cuts[:-1], cuts[1:])]


def _counted_lists(lists: pa.ListArray) -> pa.ListArray:
    """The distinct terms of each list in order, with their count."""
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    known = lists.flatten().dictionary_encode()
    order = pc.sort_indices(known.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = known.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    some = number >= 0
    size = max(len(order), 1)
    keys = np.sort(row[some] * size + rank[number[some]]) if len(order) else np.zeros(0, np.int64)
    begins = np.flatnonzero(np.diff(keys, prepend=-1))
    owner, place = np.divmod(keys[begins], size)
    terms = known.dictionary.take(pa.array(order[place]))
    found = np.diff(begins, append=len(keys)).astype(np.int32)
    offsets = np.searchsorted(owner, np.arange(len(lists) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.StructArray.from_arrays([terms, pa.array(found)], ["term", "tf"]),
        mask=lists.is_null(),
    )


def vocabulary(
    counts: DataFrame,
    documents: int,
    min_df: int = 2,
    max_df: float = 1.0,
    max_features: int | None = None,
) -> DataFrame:
    """Terms with their document frequency ``df``, total count ``cf`` and smoothed ``idf``.

    ``documents`` is the number of texts. Keeps the ``max_features`` terms with the highest
    total count, equal counts in the order of the terms.
    """
    terms = counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf")
    )
    kept = terms.where((F.col("df") >= min_df) & (F.col("df") <= float(max_df) * documents))
    if max_features is not None:
        kept = _most_frequent(kept, max_features)
    idf = F.log((1.0 + documents) / (F.col("df") + 1.0)) + 1.0
    return kept.select("term", "df", "cf", idf.alias("idf"))


def _most_frequent(terms: DataFrame, count: int) -> DataFrame:
    """The ``count`` terms with the highest total count.

    Terms far too rare are dropped first by a histogram over the counts, so that only
    about ``count`` candidates are left to sort.
    """
    cell = value_cell(F.col("cf").cast("double"))
    per_cell = terms.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("terms"))
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    reached = per_cell.withColumn("above", F.coalesce(F.sum("terms").over(above), F.lit(0)))
    floor = reached.where(F.col("above") < count).agg(F.min("cell").alias("cell")).scalar()
    return terms.where(cell >= floor).orderBy(F.desc("cf"), "term").limit(count)


def term_weights(
    counted: DataFrame, terms: DataFrame, keys: Sequence[str], sublinear: bool = False
) -> DataFrame:
    """TF-IDF as rows ``keys, term, weight``; the weights of each ``keys`` have length 1.

    ``counted`` has a row per text (``count_terms``), ``terms`` is a staged vocabulary. One of a
    checked size goes to all tasks: only counts of its terms are staged, and the squares of texts are
    summed by key, so that no term is shuffled. With a larger one the counts are partitioned by
    their keys and the vocabulary is shuffled, with its frequent terms in slices.
    """
    if terms.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return _weights_of_few(counted, terms, keys, sublinear)
    rows = one_per_term(counted.repartition(*keys), keys)
    known = join_lookup(rows, terms.select("term", "idf", "df"), "term", "df")
    raw = _damped(F.col("tf"), sublinear) * F.col("idf")
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*keys)))
    return known.select(*keys, "term", raw.alias("raw")).select(
        *keys, "term", (F.col("raw") / length).alias("weight")
    )


def _damped(tf: Column, sublinear: bool) -> Column:
    return F.log(tf.cast("double")) + 1.0 if sublinear else tf.cast("double")


def _weights_of_few(
    counted: DataFrame, terms: DataFrame, keys: Sequence[str], sublinear: bool
) -> DataFrame:
    # At most BROADCAST_ROWS rows, here and in every task.
    found = terms.select("term", "idf").toArrow().combine_chunks()
    known = staged(_known_counts(counted, found.column("term"), keys))
    places = np.arange(found.num_rows)
    return _weigh(known, places, found.column("term"), found.column("idf").to_numpy(), keys, sublinear)


_KNOWN = StructType([StructField("place", IntegerType()), StructField("tf", IntegerType())])


def _known_counts(counted: DataFrame, terms: pa.ChunkedArray, keys: Sequence[str]) -> DataFrame:
    """Per text the counts of the vocabulary's terms, by their place in it."""
    rows = counted.select(*keys, "counts")
    kept, vocabulary = rows.drop("counts").schema.fields, terms.combine_chunks()

    def work(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            term, tf = lists.flatten().flatten()
            place = pc.index_in(term, value_set=vocabulary.cast(term.type))
            some = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
            counts = _lists_of(row[some], place.take(pa.array(some)), tf.take(pa.array(some)), len(lists))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], [*(one.name for one in kept), "counts"])

    return rows.mapInArrow(work, StructType([*kept, StructField("counts", ArrayType(_KNOWN))]))


def _lists_of(row: np.ndarray, place, tf, rows: int) -> pa.ListArray:
    """A list per row; entries are ordered by row."""
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(tf, pa.int32())], ["place", "tf"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def _weigh(
    known: DataFrame, places: np.ndarray, terms: pa.ChunkedArray, idf: np.ndarray, keys: Sequence[str], sublinear: bool
) -> DataFrame:
    """TF-IDF rows of the staged counts of ``known``, of the terms at ``places`` only."""
    kept = known.drop("counts").schema.fields
    weight_at = np.full(int(places.max(initial=-1)) + 1, np.nan)
    weight_at[places] = idf

    def work(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            place, tf = (part.to_numpy(zero_copy_only=False) for part in lists.flatten().flatten())
            some = np.flatnonzero(place < len(weight_at))
            some = some[~np.isnan(weight_at[place[some]])]
            row, place, tf = row[some], place[some], tf[some]
            raw = (np.log(tf) + 1.0 if sublinear else tf.astype(float)) * weight_at[place]
            square = np.bincount(row, raw * raw, len(lists)).astype(float)  # whole numbers without rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], _lists_of(row, place, tf, len(lists)), pa.array(square)],
                [*(one.name for one in kept), "counts", "square"],
            )

    texts = known.mapInArrow(
        work, StructType([*kept, StructField("counts", ArrayType(_KNOWN)), StructField("square", DoubleType())])
    )
    # Texts that share their keys share one length; most have keys of their own.
    shared = staged(
        texts.groupBy(*[F.col(key).alias(f"_{key}") for key in keys])
        .agg(F.count(F.lit(1)).alias("_texts"), F.sum("square").alias("_square"))
        .where("_texts > 1").drop("_texts")
    )
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    if shared.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(shared), same, "left")
    else:
        texts = texts.hint("merge").join(shared, same, "left")
    # As many rows as the vocabulary has terms.
    numbered = known.sparkSession.createDataFrame(
        pa.table({"place": pa.array(places, pa.int32()), "term": terms, "idf": pa.array(idf, pa.float64())})
    )
    length = F.sqrt(F.coalesce("_square", "square"))
    rows = texts.select(*keys, length.alias("_length"), F.inline_outer("counts")).where(F.col("place").isNotNull())
    weight = _damped(F.col("tf"), sublinear) * F.col("idf") / F.col("_length")
    return rows.join(F.broadcast(numbered), "place").select(*keys, "term", weight.alias("weight"))


@F.udf(returnType=VectorUDT(), useArrow=True)
def _log_counts(counts):
    """1 + ln(count) for the counts present; MLlib has no such transformer."""
    return SparseVector(counts.size, counts.indices, 1.0 + np.log(counts.values))


@dataclass(frozen=True)
class FeatureSpec:
    """What the feature vector consists of."""

    numeric: Sequence[str] = fixed.FEATURES
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int = 2
    max_df: float = 1.0
    max_features: int = 15_000
    sublinear: bool = False
    scale: bool = True
    text: str = "text"

    def fit(self, train: DataFrame) -> "FeatureModel":
        """Learn vocabulary, idf, medians and scaling from the training rows only."""
        counts = term_counts(
            add_terms(train.select(self.text), self.text, self.ngram_range).withColumn(
                "_row", F.lit(0)
            ),
            ["_row"],
        )
        terms = vocabulary(counts, train.count(), self.min_df, self.max_df, self.max_features)
        found = terms.orderBy("term").collect()  # at most max_features rows
        return FeatureModel(
            self,
            [row["term"] for row in found],
            [row["idf"] for row in found],
            numeric_fit(train, self.numeric, self.scale),
        )


@dataclass(frozen=True)
class NumericFit:
    median: float
    mean: float = 0.0
    deviation: float = 1.0

    def apply(self, column: str) -> Column:
        filled = F.coalesce(F.col(column).cast("double"), F.lit(self.median))
        return (filled - F.lit(self.mean)) / F.lit(self.deviation)


def numeric_fit(train: DataFrame, columns: Sequence[str], scale: bool = True) -> dict[str, NumericFit]:
    """Median of each column; with ``scale`` also mean and population deviation after filling."""
    columns = list(columns)
    if not columns:
        return {}
    tall = train.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "feature", "value"
    )
    medians = {
        row["feature"]: row["quantile"]
        for row in exact_quantiles(tall, "value", [0.5], ["feature"], True).collect()
    }
    fits = {c: NumericFit(medians.get(c) or 0.0) for c in columns}
    if not scale:
        return fits
    moments = train.agg(
        *[F.avg(fits[c].apply(c)).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(fits[c].apply(c)).alias(f"{c}_dev") for c in columns],
    ).first()
    return {
        c: NumericFit(fits[c].median, moments[f"{c}_mean"] or 0.0, moments[f"{c}_dev"] or 1.0)
        for c in columns
    }


@dataclass(frozen=True)
class FeatureModel:
    """A fitted feature block. ``transform`` appends the vector column ``features``."""

    spec: FeatureSpec
    terms: list[str] = field(repr=False)
    idf: list[float] = field(repr=False)
    numbers: dict[str, NumericFit]

    @property
    def names(self) -> list[str]:
        """Names of the vector's slots, in order."""
        return [*self.terms, *self.numbers]

    def text_vector(self, df: DataFrame, name: str = "_text_vector") -> DataFrame:
        """Append the TF-IDF vector alone."""
        spec = self.spec
        counted = CountVectorizerModel.from_vocabulary(
            self.terms, inputCol="_terms", outputCol="_counts"
        ).transform(add_terms(df, spec.text, spec.ngram_range, "_terms"))
        if spec.sublinear:
            counted = counted.withColumn("_counts", _log_counts("_counts"))
        weighted = ElementwiseProduct(
            scalingVec=DenseVector(self.idf), inputCol="_counts", outputCol="_weighted"
        ).transform(counted)
        scaled = Normalizer(p=2.0, inputCol="_weighted", outputCol=name).transform(weighted)
        return scaled.drop("_terms", "_counts", "_weighted")

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        numbers = {f"_number_{c}": fit.apply(c) for c, fit in self.numbers.items()}
        numbered = df.withColumns(numbers) if numbers else df
        inputs = list(numbers)
        if self.terms:
            numbered = self.text_vector(numbered)
            inputs = ["_text_vector", *inputs]
        assembled = VectorAssembler(inputCols=inputs, outputCol=name).transform(numbered)
        return assembled.drop("_text_vector", *numbers)

    def entries(self, df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
        """The non-zero slots of a transformed frame by name: rows ``keys, name, value``.

        Staged, to read the vectors as their stored parts: sparse ones are never spread out.
        """
        spark = df.sparkSession
        names = spark.createDataFrame(list(enumerate(self.names)), "slot int, name string")
        path = staged_folder(spark)
        kept = df.select(*keys, F.col(vector).alias("_vector"))
        kept.write.parquet(path)
        stored = StructType(
            [*kept.drop("_vector").schema.fields, StructField("_vector", VectorUDT.sqlType())]
        )
        parts = spark.read.schema(stored).parquet(path).select(*keys, "_vector.*")
        dense = F.sequence(F.lit(0), F.size("values") - 1)
        slot = F.when(F.size("values") == 0, F.array().cast("array<int>")).otherwise(
            F.coalesce("indices", dense)
        )
        pairs = F.arrays_zip(slot.alias("slot"), F.col("values").alias("value"))
        slots = parts.select(*keys, F.inline(pairs).alias("slot", "value"))
        # one name per slot of the vector
        return (
            slots.where(F.col("value") != 0)
            .join(F.broadcast(names), "slot")
            .select(*keys, "name", "value")
        )
