"""Every registered query against its DuckDB text, at the smallest scale."""

import pytest

import __spark_entry__ as entry_points
from check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SLOW = {"mail_communities"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(entry_points.oracle_sql())))
def test_same_rows(spark, con, name):
    rows, problem = compare(spark, con, SF_DIR, name)
    assert problem == ""
    assert rows > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_topics(spark):
    from pyspark.sql import functions as F

    topics = entry_points.queries()["topic_terms"](spark, SF_DIR)
    assert {r["count"] for r in topics.groupBy("topic").count().collect()} == {10}
    scores = entry_points.queries()["document_topics"](spark, SF_DIR)
    per_doc = scores.groupBy("id").agg(F.count("*").alias("k"), F.sum("score").alias("total"), F.min("score").alias("low"))
    bad = per_doc.where("k <> 10 OR abs(total - 1) > 0.001 OR low < 0")
    assert bad.count() == 0
