"""Small helpers of the training-data operators: row keys, connected groups, range unions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.runtime import checkpointed

#: rows of a lookup that may be broadcast; at 100 bytes a row this is 20 MB
BROADCAST_ROWS = 200_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else, in any locale."""
    return F.translate(text, UPPER, UPPER.lower())


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that tell rows apart by id and text; repeated rows share a key, nulls have one."""
    return F.unhex(
        F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("\n"), F.coalesce(text, F.lit(""))))
    )


def stored(df: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder and read again."""
    return checkpointed(df)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint only where at most `limit` rows were counted; beyond it a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of an edge can reach.

    Each round takes the smallest label over the neighbours and then the label's own label, so
    chains halve. The rounds are tables in the shared folder; the driver sees one count a round.
    The loop ends when no label changes; every round lowers a label, so it does end.
    """
    one = edges.select(F.col(a).alias("node"), F.col(b).alias("near"))
    both = stored(one.unionByName(one.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct())
    labels = stored(both.groupBy("node").agg(F.least(F.min("near"), F.min("node")).alias("label")))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "near"), "near").select("node", "label")
        lower = seen.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        lower = stored(lower)
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = stored(
            lower.join(jump, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        )
        old = labels.withColumnRenamed("label", "old")
        changed = after.join(old, "node").where(F.col("old") != F.col("label")).limit(1).count()
        labels = after
        if not changed:
            return labels.withColumnRenamed("label", "component")
