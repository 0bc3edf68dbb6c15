"""The given tables in the roles the operators expect.

``documents`` carries the texts and chats (``source``), ``events`` the time, user and type
of the message with the same id, ``labels`` the manual marks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrisk.functions import text
from textrisk.functions.risk import Lexicon, add_features
from textrisk.operators.messages import clean_messages, drop_blank, raw_user
from textrisk.session import spread_small, staged
from textrisk.sources.tables import from_table

# The texts of the tables are not Russian: these words stand in for the default lists.
TABLE_LEXICON = Lexicon(
    profanity_stems=("trash", "scum", "clown", "pathetic", "disgusting"),
    hostile_stems=("idiot", "moron", "stupid", "loser", "worthless"),
    hostile_words=(),
)


# Tables with texts, and the key that spreads them.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread_small(table(spark, folder, name), TEXT_KEYS[name])


def message_events(spark: SparkSession, folder: str) -> DataFrame:
    """Per message id: type, user and date. The dates of the table span a few days, so they
    are spread over two years with a gap of some months; some are left out."""
    shift = F.pmod(F.col("event_id") * 37, F.lit(700))
    shift = F.when(shift.between(100, 200), shift + 600).otherwise(shift).cast("int")
    date = F.when(
        F.col("event_id") % 29 != 0, F.col("ts") + F.make_dt_interval(days=shift)
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("doc_id"),
        F.when(F.col("event_type") == "signup", "service").otherwise("message").alias("type"),
        F.when(
            F.col("event_id") % 31 != 0, F.concat(F.lit("user"), F.col("user_id").cast("string"))
        ).alias("from_id"),
        date.alias("date"),
    )


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    joined = texts(spark, folder, "documents").join(message_events(spark, folder), "doc_id")
    return from_table(
        joined,
        {
            "file": F.concat("source", F.lit(".json")),
            "id": "doc_id",
            "type": "type",
            "date": "date",
            "from_id": "from_id",
            "text": "text",
        },
    )


def message_flags(spark: SparkSession, folder: str) -> DataFrame:
    """File and type of each message and whether its text is visible, told before the join: no
    text is shuffled."""
    documents = texts(spark, folder, "documents").select(
        "doc_id", F.concat("source", F.lit(".json")).alias("file"), text.has_text("text").alias("visible")
    )
    events = message_events(spark, folder).select("doc_id", "type")
    return documents.join(events, "doc_id").select("file", "type", "visible")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return clean_messages(raw_messages(spark, folder))


def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = drop_blank(texts(spark, folder, "documents"))
    return documents.select("doc_id", "source", text.anonymize("text").alias("text"))


def featured_documents(
    spark: SparkSession, folder: str, count_shouted: bool = False
) -> DataFrame:
    return add_features(clean_documents(spark, folder), "text", TABLE_LEXICON, count_shouted)


def risk_by_message(spark: SparkSession, folder: str) -> DataFrame:
    """Ordinary messages with their risk score: texts are scored before the join, so only
    numbers are shuffled."""
    scored = featured_documents(spark, folder).select(
        "doc_id", F.col("source").alias("chat"), "risk_score", "profanity_count", "hostile_count"
    )
    events = message_events(spark, folder).where(F.col("type") == "message")
    return scored.join(events, "doc_id").select(
        "doc_id", "chat", "risk_score", "profanity_count", "hostile_count", "date",
        F.hour("date").alias("hour"), raw_user().alias("raw_user_id"),
    )


def labelled_documents(spark: SparkSession, folder: str, with_text: bool = False) -> DataFrame:
    """Features of the labelled documents with ``toxic`` and ``quality``."""
    featured = featured_documents(spark, folder)
    if not with_text:
        featured = featured.drop("text")
    return featured.join(table(spark, folder, "labels"), "doc_id")


def document_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Features and hash of each document, staged for operators that pass over them again."""
    featured = featured_documents(spark, folder)
    return staged(
        featured.withColumn("message_hash", text.short_hash("source", "doc_id", "text")).drop("text")
    )


def rated_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Label, score and prediction without a model: the risk score stands in for one.

    Staged: an evaluation reads these few columns several times."""
    numbers = staged(labelled_documents(spark, folder).select("doc_id", "toxic", "risk_score"))
    return numbers.select(
        "doc_id",
        F.col("toxic").alias("label"),
        F.col("risk_score").alias("score"),
        (F.col("risk_score") >= 2.0).cast("int").alias("prediction"),
    )
