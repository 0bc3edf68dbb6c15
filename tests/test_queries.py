"""Named queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, normal

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


#: Minutes of fits each; their classifiers are tested on small sets, the queries by ``tools/check_queries.py``.
SLOW = {"classifier_ratings", "boosted_search"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_sql(spark, db, name):
    frame = entry.queries()[name](spark, FOLDER)
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert normal([tuple(r) for r in frame.collect()], frame.columns) == normal(result.fetchall(), names)


@pytest.fixture()
def cluster_like(spark):
    """No broadcast by size, many shuffle partitions, and tiny skew limits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize(
    "name",
    "message_view pseudonymized_messages labeling_sample tfidf roc_points monthly_trend top_users "
    "value_quantiles unlabelled_documents".split(),
)
def test_query_with_shuffled_joins(cluster_like, db, name):
    test_query_equals_sql(cluster_like, db, name)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["hour", "mean_toxicity", "messages"] and frame.count() > 0
