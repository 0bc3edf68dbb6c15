"""Named queries over the given tables, one per operator of the library."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrisk.functions import dates, fixed, risk, text
from textrisk.operators import (
    checks,
    evaluation,
    labels,
    lookups,
    messages as message_ops,
    models,
    sampling,
    summary,
    textvec,
    trends,
)
from textrisk.operators.boosted_fits import PenalisedSpec
from textrisk.operators.frequent_terms import weigh_frequent
from textrisk.operators.meancut import MeanCutSpec, draw_cuts
from textrisk.operators.quantiles import exact_quantiles
from textrisk.plans import inputs, training
from textrisk.plans.labeling import draw_messages
from textrisk.session import shared_folder, staged
from textrisk.sources import exports, samples

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = fixed.DEFAULT_SEED
FRACTIONS = (0.2, 0.4, 0.6, 0.8, 1.0)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, columns: Sequence[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


# --- text ---------------------------------------------------------------------------


@query
def anonymize_text(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.clean_documents(spark, folder).select("doc_id", "text")


@query
def anonymize_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = inputs.texts(spark, folder, "pages")
    return pages.select("page_id", text.anonymize("html").alias("text"))


@query
def anonymize_conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = inputs.texts(spark, folder, "conversations")
    return turns.select("conv_id", "turn", text.anonymize("text").alias("text"))


@query
def mask_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Length of each page after each single mask."""
    steps = {
        "url": text.mask_urls, "email": text.mask_emails, "phone": text.mask_phones,
        "mention": text.mask_mentions, "space": text.collapse_space,
    }
    pages = inputs.texts(spark, folder, "pages")
    return pages.select(
        "page_id", *[F.length(mask("html")).alias(f"{name}_len") for name, mask in steps.items()]
    )


@query
def message_view(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.messages(spark, folder).select(
        "message_hash", "date", "hour", "month", "chat", "raw_user_id", "text"
    )


@query
def file_counters(spark: SparkSession, folder: str) -> DataFrame:
    return message_ops.file_counters(inputs.message_flags(spark, folder))


@query
def summary_totals(spark: SparkSession, folder: str) -> DataFrame:
    return message_ops.counter_totals(file_counters(spark, folder))


@query
def pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return message_ops.pseudonyms(inputs.messages(spark, folder).select("raw_user_id"))


@query
def pseudonymized_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.messages(spark, folder).select("message_hash", "chat", "raw_user_id")
    return message_ops.pseudonymize(staged(rows))


@query
def conversation_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Second text source: roles as files, system turns as service entries."""
    turns = inputs.texts(spark, folder, "conversations").select(
        F.col("role").alias("file"),
        F.when(F.col("role") == "system", "service").otherwise("message").alias("type"),
        "text",
    )
    return message_ops.file_counters(turns)


@query
def all_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and conversation turns as one set of clean texts, counted by source."""
    documents = inputs.texts(spark, folder, "documents").select(
        F.lit("documents").alias("source"), "text"
    )
    turns = inputs.texts(spark, folder, "conversations").select(
        F.lit("conversations").alias("source"), "text"
    )
    both = message_ops.drop_blank(documents.unionByName(turns))
    return both.groupBy("source").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.length(text.anonymize("text"))).alias("chars"),
    )


@query
def rich_text(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns written as rich text (a string, an object, other items) and flattened."""
    turns = inputs.texts(spark, folder, "conversations")
    piece = F.to_json(F.struct("text"))
    quoted = F.expr("substring(piece, length('{\"text\":') + 1, length(piece) - length('{\"text\":}'))")
    rich = F.concat(F.lit("["), quoted, F.lit(","), F.col("piece"), F.lit(',5,{"type":"x"},["y"]]'))
    document = F.when(F.col("role") == "system", quoted).otherwise(rich)
    return turns.withColumn("piece", piece).select(
        "conv_id", "turn", text.flatten_rich_text(F.parse_json(document)).alias("text")
    )


@query
def message_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The messages written as one JSON object per line, read back and cleaned."""
    path = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    raw = inputs.raw_messages(spark, folder)
    raw.select("id", "type", "date", "from_id", "text").write.json(path)
    return message_ops.clean_messages(exports.read_message_lines(spark, path)).select(
        "date", "hour", "month", "raw_user_id", "text"
    )


@query
def chat_list(spark: SparkSession, folder: str) -> DataFrame:
    return summary.chat_list(inputs.messages(spark, folder))


# --- dates ----------------------------------------------------------------------------


@query
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parse ISO texts of the event times and take them apart."""
    stamps = inputs.table(spark, folder, "events").select(
        "event_id",
        dates.parse_iso(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))).alias("date"),
    )
    return stamps.select(
        "event_id", "date", F.hour("date").alias("hour"), dates.month_of("date").alias("month"),
        dates.month_end("date").alias("month_end"),
        dates.day_part(F.hour("date")).alias("day_part"),
    )


# --- features ---------------------------------------------------------------------------


@query
def message_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        inputs.featured_documents(spark, folder).select("doc_id", *fixed.FEATURES), ["caps_ratio"]
    )


@query
def conversation_features(spark: SparkSession, folder: str) -> DataFrame:
    turns = inputs.texts(spark, folder, "conversations").select("conv_id", "turn", "text")
    featured = risk.add_features(turns, "text", inputs.TABLE_LEXICON)
    return rounded(
        featured.select("conv_id", "turn", *fixed.FEATURES, "risk_score"),
        ["caps_ratio", "risk_score"],
    )


@query
def risk_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        inputs.featured_documents(spark, folder).select("doc_id", "risk_score"), ["risk_score"]
    )


@query
def risk_score_caps(spark: SparkSession, folder: str) -> DataFrame:
    featured = inputs.featured_documents(spark, folder, count_shouted=True)
    return rounded(featured.select("doc_id", "all_caps_words", "risk_score"), ["risk_score"])


@query
def sink_rounding(spark: SparkSession, folder: str) -> DataFrame:
    featured = inputs.featured_documents(spark, folder)
    return featured.select(
        "doc_id",
        risk.round_for_sink("caps_ratio").alias("caps_ratio"),
        risk.round_for_sink("risk_score").alias("risk_score"),
    )


@query
def risk_candidates(spark: SparkSession, folder: str) -> DataFrame:
    numbers = inputs.document_numbers(spark, folder).where(F.col("risk_score") > 0)
    return rounded(numbers.select("doc_id", "risk_score"), ["risk_score"])


@query
def numeric_coercion(spark: SparkSession, folder: str) -> DataFrame:
    """The events' property text read as a number: most of it is none."""
    events = inputs.table(spark, folder, "events")
    digits = F.regexp_extract("props", r"(\d+)", 1)
    given = F.when(F.col("event_type") == "view", digits).otherwise(F.col("event_type"))
    return events.select("event_id", risk.to_number(given).alias("number"))


# --- summaries ----------------------------------------------------------------------------


@query
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    used = staged(
        inputs.messages(spark, folder).select("chat", "date", F.col("raw_user_id").alias("user"))
    )
    return summary.dataset_summary(used)


@query
def feature_describe(spark: SparkSession, folder: str) -> DataFrame:
    described = summary.describe_features(inputs.document_numbers(spark, folder))
    return rounded(described, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(summary.class_balance(inputs.table(spark, folder, "labels")), ["share"])


@query
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = summary.class_weights(inputs.table(spark, folder, "labels"))
    return rounded(weights, ["balanced_weight", "pos_weight"])


@query
def value_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles of the event values per event type."""
    events = inputs.table(spark, folder, "events")
    found = exact_quantiles(events, "value", [0.05, 0.25, 0.5, 0.8, 0.99], ["event_type"])
    return rounded(found, ["quantile"])


# --- labels ----------------------------------------------------------------------------------


@query
def weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    labelled = labels.weak_labels(inputs.document_numbers(spark, folder))
    return labelled.select("doc_id", "toxic", "label_source")


@query
def weak_label_notes(spark: SparkSession, folder: str) -> DataFrame:
    noted = (
        inputs.document_numbers(spark, folder)
        .withColumn("notes", F.when(F.col("question_count") == 0, F.concat(F.lit("seen in "), "source")))
    )
    return labels.weak_labels(noted).select("doc_id", "notes")


def _marked_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a ``toxic`` text column as a person would fill it: 0, 1, other, blank."""
    marks = inputs.table(spark, folder, "labels")
    mark = F.when(F.col("quality") == 1, F.col("toxic").cast("string")).otherwise(
        F.when(F.col("toxic") == 1, "2").otherwise("x")
    )
    documents = inputs.table(spark, folder, "documents").select("doc_id", "source")
    return documents.join(marks.select("doc_id", mark.alias("toxic")), "doc_id", "left")


@query
def manual_labels(spark: SparkSession, folder: str) -> DataFrame:
    return labels.manual_labels(_marked_documents(spark, folder)).select(
        "doc_id", "toxic", "label_source"
    )


@query
def resolved_labels(spark: SparkSession, folder: str) -> DataFrame:
    resolved = labels.resolve_labels(_marked_documents(spark, folder))
    return resolved.groupBy("label_source", "toxic").agg(F.count(F.lit(1)).alias("rows"))


@query
def resolved_by_score(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of documents whose ``toxic`` is blank, but which have a column of scores."""
    scored = inputs.labelled_documents(spark, folder).select(
        "doc_id", F.lit("").alias("toxic"), F.least(F.col("caps_ratio") * 2, F.lit(1.0)).alias("Toxic-Score")
    )
    return labels.resolve_labels(staged(scored)).select("doc_id", "toxic", "label_source")


@query
def resolved_by_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of documents that have neither labels nor scores."""
    numbers = inputs.document_numbers(spark, folder).withColumn("toxic", F.lit(None).cast("string"))
    return labels.resolve_labels(numbers).select("doc_id", "toxic", "label_source")


@query
def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled rows ready for training; some texts are blank or missing, some numbers are no numbers."""
    labelled = inputs.labelled_documents(spark, folder, with_text=True)
    text_ = F.when(F.col("doc_id") % 10 == 0, None).when(F.col("doc_id") % 5 == 0, " \n\t").otherwise(F.col("text"))
    length = F.when(F.col("doc_id") % 7 == 0, "long").otherwise(F.col("char_len").cast("string"))
    rows = labelled.withColumns({"text": text_, "char_len": length})
    return labels.training_rows(rows).select("doc_id", "toxic", "label_source", "char_len")


def _score_labels(spark: SparkSession, folder: str, scale: float) -> DataFrame:
    scored = inputs.labelled_documents(spark, folder)
    scored = staged(scored.select("doc_id", "quality", "caps_ratio")).select(
        "doc_id",
        F.when(F.col("quality") == 1, F.least(F.col("caps_ratio") * 2, F.lit(1.0)) * scale).alias(
            "Toxic-Score"
        ),
    )
    column = labels.find_score_column(scored.columns)
    found = labels.score_labels(scored, column)
    return rounded(
        found.select("doc_id", "toxicity_score_label", "toxic", "label_source"),
        ["toxicity_score_label"],
    )


@query
def score_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _score_labels(spark, folder, 100.0)


@query
def score_labels_unit(spark: SparkSession, folder: str) -> DataFrame:
    return _score_labels(spark, folder, 1.0)


@query
def score_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Largest value per event type and the threshold that goes with such a scale."""
    events = inputs.table(spark, folder, "events")
    largest = events.groupBy("event_type").agg(F.max("value").alias("largest"))
    return largest.select("event_type", "largest", labels.score_cut("largest").alias("cut"))


# --- draws -------------------------------------------------------------------------------------


@query
def row_cap(spark: SparkSession, folder: str) -> DataFrame:
    documents = inputs.table(spark, folder, "documents").select("doc_id", "source")
    return sampling.cap_rows(documents, 500, ["doc_id"], SEED)


def _sampled(spark: SparkSession, folder: str, size: int, candidate: Column) -> DataFrame:
    rows = inputs.document_numbers(spark, folder).select("message_hash", "risk_score")
    sample = sampling.labeling_sample(rows, size, SEED, candidate)
    return rounded(sample, ["risk_score"])


@query
def labeling_sample(spark: SparkSession, folder: str) -> DataFrame:
    sample = _sampled(spark, folder, 300, F.col("risk_score") > 1)
    return sample.select("label_id", "message_hash", "selection_reason", "risk_score", "toxic", "notes")


@query
def labeling_sample_default(spark: SparkSession, folder: str) -> DataFrame:
    sample = _sampled(spark, folder, 250, F.col("risk_score") > 0)
    return sample.select("label_id", "message_hash", "selection_reason")


@query
def sample_file(spark: SparkSession, folder: str) -> DataFrame:
    """A labelling sample of named messages, written as CSV and read back with all columns."""
    path = f"{shared_folder(spark)}/sample-{uuid.uuid4().hex}"
    raw = inputs.raw_messages(spark, folder)
    sample, _ = draw_messages(raw, 200, SEED, inputs.TABLE_LEXICON, F.col("risk_score") > 1)
    samples.write_sample(sample.select(*fixed.SAMPLE_COLUMNS), path)
    return rounded(samples.read_sample(spark, path), ["risk_score", "caps_ratio"])


@query
def unlabelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents outside the labelled set, counted by source."""
    documents = inputs.table(spark, folder, "documents").select("doc_id", "source")
    rest = lookups.exclude_keys(documents, inputs.table(spark, folder, "labels"), "doc_id")
    return rest.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))


@query
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    marks = inputs.table(spark, folder, "labels").select("doc_id", "toxic")
    return sampling.holdout_split(marks, "toxic", ["doc_id"], 0.2, SEED)


@query
def stratified_subsample(spark: SparkSession, folder: str) -> DataFrame:
    marks = inputs.table(spark, folder, "labels").select("doc_id", "toxic")
    return sampling.stratified_subsample(marks, "toxic", ["doc_id"], 150, seed=SEED)


@query
def kfold_assignment(spark: SparkSession, folder: str) -> DataFrame:
    marks = inputs.table(spark, folder, "labels").select("doc_id", "toxic")
    return sampling.assign_folds(marks, "toxic", ["doc_id"], 5, SEED)


@query
def learning_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    marks = inputs.table(spark, folder, "labels").select("doc_id", "toxic")
    return sampling.learning_prefixes(marks, "toxic", ["doc_id"], FRACTIONS, SEED)


# --- text vectors --------------------------------------------------------------------------------


def _counted(spark: SparkSession, folder: str, ngram_range: tuple[int, int]) -> DataFrame:
    documents = inputs.clean_documents(spark, folder)
    return textvec.count_terms(textvec.add_terms(documents, "text", ngram_range), ["doc_id"])


def _term_counts(spark: SparkSession, folder: str, ngram_range: tuple[int, int]) -> DataFrame:
    return textvec.one_per_term(_counted(spark, folder, ngram_range), ["doc_id"])


def _vocabulary(counts: DataFrame, spark: SparkSession, folder: str, **limits) -> DataFrame:
    documents = message_ops.drop_blank(inputs.table(spark, folder, "documents"))
    return textvec.vocabulary(counts, documents.count(), **limits)


@query
def tokens_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: terms and distinct terms for one to three words."""
    counts = _term_counts(spark, folder, (1, 3))
    words = F.size(F.split("term", " "))
    return counts.groupBy("doc_id", words.alias("words")).agg(
        F.sum("tf").alias("terms"), F.count(F.lit(1)).alias("distinct_terms")
    )


@query
def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    counts = _term_counts(spark, folder, (1, 2))
    return rounded(_vocabulary(counts, spark, folder, max_features=15_000), ["idf"])


@query
def vocabulary_max_df(spark: SparkSession, folder: str) -> DataFrame:
    counts = _term_counts(spark, folder, (1, 1))
    terms = _vocabulary(counts, spark, folder, max_df=0.2, max_features=5_000)
    return rounded(terms, ["idf"])


def _weights(spark: SparkSession, folder: str, sublinear: bool, **limits) -> DataFrame:
    documents = inputs.clean_documents(spark, folder).select("doc_id", "text")
    return rounded(weigh_frequent(documents, ["doc_id"], sublinear=sublinear, **limits), ["weight"])


@query
def tfidf(spark: SparkSession, folder: str) -> DataFrame:
    return _weights(spark, folder, False, max_features=5_000)


@query
def tfidf_sublinear(spark: SparkSession, folder: str) -> DataFrame:
    return _weights(spark, folder, True, max_df=0.95, max_features=5_000)


@query
def impute_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of the labelled documents, some missing, filled and scaled as fitted on the
    documents of good quality."""
    numbers = inputs.labelled_documents(spark, folder)
    rows = staged(numbers.select("doc_id", "quality", *fixed.FEATURES)).select(
        "doc_id",
        "quality",
        F.when(F.col("word_count") > 30, F.col("char_len")).alias("char_len"),
        F.when(F.col("exclamation_count") == 0, F.col("caps_ratio")).alias("caps_ratio"),
    )
    columns = ["char_len", "caps_ratio"]
    fitted = textvec.numeric_fit(rows.where(F.col("quality") == 1), columns)
    scaled = rows.select("doc_id", *[fitted[c].apply(c).alias(c) for c in columns])
    return rounded(scaled, columns)


# --- evaluation ----------------------------------------------------------------------------------


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion_matrix(inputs.rated_documents(spark, folder))


@query
def binary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluation.binary_metrics(inputs.rated_documents(spark, folder))
    return rounded(metrics, metrics.columns)


@query
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    report = evaluation.class_report(inputs.rated_documents(spark, folder))
    return rounded(report, ["precision", "recall", "f1"])


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.score_points(inputs.rated_documents(spark, folder))


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.roc_auc(_points(spark, folder)), ["roc_auc"])


@query
def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.roc_points(_points(spark, folder)), ["threshold", "fpr", "tpr"])


@query
def pr_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        evaluation.pr_points(_points(spark, folder)), ["threshold", "precision", "recall"]
    )


@query
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.average_precision(_points(spark, folder)), ["average_precision"])


@query
def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    best = evaluation.best_threshold(_points(spark, folder))
    return rounded(best, best.columns)


@query
def calibration_bins(spark: SparkSession, folder: str) -> DataFrame:
    rated = inputs.rated_documents(spark, folder).withColumn(
        "score", F.col("score") / (1 + F.col("score"))
    )
    return rounded(evaluation.calibration_bins(rated), ["mean_score", "positive_share"])


@query
def error_slices(spark: SparkSession, folder: str) -> DataFrame:
    wrong = evaluation.error_slices(inputs.rated_documents(spark, folder))
    return rounded(wrong, ["score"])


# --- trends ------------------------------------------------------------------------------------------


def _weakly_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Messages scored by their weak label."""
    weak = labels.weak_labels(staged(inputs.risk_by_message(spark, folder)))
    return weak.withColumn("toxicity_score", F.col("toxic").cast("double"))


def _risk_scored(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.risk_by_message(spark, folder).withColumnRenamed("risk_score", "toxicity_score")


@query
def hourly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trends.hourly_trend(_weakly_scored(spark, folder)), ["mean_toxicity"])


@query
def hourly_risk(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trends.hourly_trend(_risk_scored(spark, folder)), ["mean_toxicity"])


@query
def day_part_trend(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trends.day_part_trend(_risk_scored(spark, folder)), ["mean_toxicity"])


@query
def monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trends.monthly_trend(_risk_scored(spark, folder)), ["mean_toxicity"])


@query
def top_users(spark: SparkSession, folder: str) -> DataFrame:
    named = message_ops.pseudonymize(staged(_risk_scored(spark, folder)))
    return rounded(trends.top_users(named, min_messages=5), ["mean_toxicity"])


@query
def top_raw_users(spark: SparkSession, folder: str) -> DataFrame:
    best = trends.top_raw_users(_risk_scored(spark, folder), min_messages=5)
    return rounded(best, ["mean_toxicity"])


# --- checks ----------------------------------------------------------------------------------------------


@query
def quality_checks(spark: SparkSession, folder: str) -> DataFrame:
    named = message_ops.pseudonymize(
        inputs.messages(spark, folder).select("text", "raw_user_id")
    )
    return checks.message_checks(named)


@query
def planted_violations(spark: SparkSession, folder: str) -> DataFrame:
    """The checks over messages and labels that break their rules."""
    doc = F.col("doc_id")
    rows = inputs.table(spark, folder, "documents").select(
        F.when(doc % 4 == 0, "\u00a0 ").otherwise("said").alias("text"),
        F.when(doc % 6 == 0, "user_7").when(doc % 9 == 0, None).otherwise("user_012").alias("user"),
        doc.alias("raw_user_id"),
    )
    marks = inputs.table(spark, folder, "labels").select(
        F.when(doc % 3 == 0, 2).when(doc % 5 == 0, None).otherwise(F.col("toxic")).alias("toxic")
    )
    return checks.message_checks(rows).crossJoin(checks.label_checks(marks).withColumnRenamed("rows", "labels"))


@query
def label_checks(spark: SparkSession, folder: str) -> DataFrame:
    return checks.label_checks(inputs.table(spark, folder, "labels"))


@query
def class_guard(spark: SparkSession, folder: str) -> DataFrame:
    return checks.class_guard(inputs.table(spark, folder, "labels"))


# --- models -------------------------------------------------------------------------------------------------
# All labelled documents take part, with the sizes, folds, fractions and draws of ``plans/training``. Results
# that other engines must reproduce to the digit come from classifiers in closed form; of the others, rows tell
# what does not depend on their random draws.

TABLE_MODELS = {
    **models.DEFAULT_MODELS,
    "Linear SVM": replace(models.DEFAULT_MODELS["Linear SVM"], id_columns=("doc_id",)),
}
PENALISED = PenalisedSpec()
CLOSED_MODELS = {
    "Risk score": MeanCutSpec(),
    "Length": MeanCutSpec("char_len", 0.4),
    "Hostile words": MeanCutSpec("hostile_count"),
    "Capitals": MeanCutSpec("caps_ratio", 0.6),
}
CLOSED = MeanCutSpec()


def _training_set(spark: SparkSession, folder: str, with_text: bool = True) -> DataFrame:
    labelled = inputs.labelled_documents(spark, folder, with_text)
    texts = ["text"] if with_text else []
    split = sampling.holdout_split(
        staged(labelled.select("doc_id", *texts, "toxic", *fixed.BOOSTED_FEATURES)),
        "toxic", ["doc_id"], 0.2, SEED,
    )
    return split


def _train_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    split = _training_set(spark, folder)
    return split.where(~F.col("is_test")), split.where("is_test")


def _train_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The training rows without their texts, staged: no text is shuffled."""
    split = _training_set(spark, folder, with_text=False)
    return staged(split.where(~F.col("is_test")).drop("is_test"))


@query
def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Slots of the assembled vectors of all labelled documents, fitted on the training part."""
    split = _training_set(spark, folder)
    block = TABLE_MODELS["Logistic Regression"].features.fit(split.where(~F.col("is_test")))
    return rounded(block.entries(block.transform(split), ["doc_id"]), ["value"])


@query
def model_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    _, board = models.fit_all(*_train_test(spark, folder), CLOSED_MODELS)
    return rounded(board, ["f1", "roc_auc"])


@query
def scored_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All messages scored by a model trained on the labelled documents."""
    fitted = CLOSED.fit(_train_numbers(spark, folder))
    named = message_ops.pseudonymize(inputs.messages(spark, folder))
    featured = risk.add_features(named, "text", inputs.TABLE_LEXICON)
    return rounded(models.score_messages(fitted, featured), ["toxicity_score"])


SWEEP_COLUMNS = ("train_f1_mean", "train_f1_std", "cv_f1_mean", "cv_f1_std", "positive_share")


@query
def size_sweep(spark: SparkSession, folder: str) -> DataFrame:
    sweep = models.size_sweep(_train_numbers(spark, folder), CLOSED, training.SIZES, ["doc_id"])
    return rounded(sweep, SWEEP_COLUMNS)


@query
def near_best_size(spark: SparkSession, folder: str) -> DataFrame:
    sweep = models.size_sweep(_train_numbers(spark, folder), CLOSED, training.SIZES, ["doc_id"])
    return models.near_best_size(sweep)


@query
def random_search(spark: SparkSession, folder: str) -> DataFrame:
    settings = draw_cuts(training.TRIALS, SEED)
    table, _ = models.random_search(_train_numbers(spark, folder), CLOSED, settings, ["doc_id"])
    return rounded(table, ["mean_test_f1", "std_test_f1", "mean_test_roc_auc", "mean_train_f1"])


@query
def learning_curve(spark: SparkSession, folder: str) -> DataFrame:
    curve = models.learning_curve(_train_numbers(spark, folder), CLOSED, training.FRACTIONS, ["doc_id"])
    return rounded(curve, [name for name in curve.columns if name != "train_size"])


def _ratings(scored: DataFrame, *names: str) -> DataFrame:
    """Per name: rows, positives, and whether all scores lie in 0 to 1 and agree with the predictions."""
    inside = F.col("score").between(0.0, 1.0) & ((F.col("score") > 0.5) == (F.col("prediction") == 1))
    return scored.groupBy(*names).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("toxic") == 1).alias("positives"),
        F.bool_and(F.coalesce(inside, F.lit(False))).alias("scores_agree"),
    )


@query
def classifier_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The linear classifiers and the forest with their default settings, on the test rows."""
    train, test = _train_test(spark, folder)
    fitted, _ = models.fit_all(train, test, TABLE_MODELS)
    scored = [
        model.predict(test).select(F.lit(name).alias("model"), "toxic", "score", "prediction")
        for name, model in fitted.items()
    ]
    return _ratings(staged(reduce(DataFrame.unionByName, scored)), "model")


@query
def boosted_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The boosted trees on the test rows."""
    train, test = _train_test(spark, folder)
    rated = staged(PENALISED.fit_spread(train).predict(test).select("toxic", "score", "prediction"))
    metrics = evaluation.binary_metrics(rated, "toxic")
    area = evaluation.roc_auc(evaluation.score_points(rated, "toxic"))
    whole = metrics.withColumn("roc_auc", area.scalar())
    shares = [F.col(name).between(0.0, 1.0) for name in whole.columns]
    valid = whole.select(reduce(lambda a, b: a & b, shares).alias("metrics_valid"))
    return _ratings(rated.withColumn("model", F.lit("Boosted trees")), "model").crossJoin(valid)


@query
def boosted_search(spark: SparkSession, folder: str) -> DataFrame:
    """The search over the settings of the trees with leaf penalties: what was drawn, and whether
    all trials were rated over all folds."""
    settings = models.draw_settings(training.TRIALS, SEED)
    train = staged(_train_test(spark, folder)[0])
    table, _ = models.random_search(train, PENALISED, settings, ["doc_id"])
    rates = [F.col(name).between(0.0, 1.0) for name in ("mean_test_f1", "mean_test_roc_auc", "mean_train_f1")]
    return table.select("trial", "params", reduce(lambda a, b: a & b, rates).alias("rated"))


@query
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Of the most important features of the boosted trees: how many, and what holds of all."""
    train, _ = _train_test(spark, folder)
    fitted = PENALISED.fit_spread(train)
    top = models.feature_importance(fitted, spark)
    known = spark.createDataFrame([(name,) for name in fitted.names], "feature string")
    return top.join(known, "feature", "left_semi").agg(
        F.count(F.lit(1)).alias("features"),
        F.count_distinct("feature").alias("names"),
        F.bool_and(F.col("importance").between(0.0, 1.0)).alias("shares"),
        (F.sum("importance") <= 1.0 + 1e-6).alias("within_whole"),
    )
