"""Naive Bayes spam model, its evaluation, and the spam filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.cleaning import spam_text
from mailloom.runtime import checkpointed

SPAM, NONSPAM = "spam", "nonspam"

# log odds are whole millionths, so a score does not depend on the order of rows
SCALE = 1_000_000
# tokens of a model that may be broadcast; at 100 bytes a token this is 20 MB
BROADCAST_TOKENS = 200_000


def spam_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(spam_text(text)), F.lit("[a-z0-9_]+"), F.lit(0))


def count_tokens(labelled: DataFrame) -> DataFrame:
    """(token, spam, nonspam): occurrences per class in (label, body) rows."""
    return (
        labelled.select("label", F.explode(spam_tokens(F.col("body"))).alias("token"))
        .groupBy("token")
        .agg(
            F.count_if(F.col("label") == SPAM).alias("spam"),
            F.count_if(F.col("label") == NONSPAM).alias("nonspam"),
        )
    )


def add_counts(*counts: DataFrame) -> DataFrame:
    """Training is additive: the sum of several count tables."""
    together = counts[0]
    for more in counts[1:]:
        together = together.unionByName(more)
    return together.groupBy("token").agg(
        F.sum("spam").alias("spam"), F.sum("nonspam").alias("nonspam")
    )


def spam_model(counts: DataFrame) -> DataFrame:
    """(token, log_odds) with add-one smoothing; positive speaks for spam."""
    counts = checkpointed(counts)
    total = counts.agg(
        F.sum("spam").alias("spam"), F.sum("nonspam").alias("nonspam"), F.count(F.lit(1)).alias("size")
    ).first()
    size = total["size"]

    def log_share(column: str) -> Column:
        return F.ln((F.col(column) + 1) / F.lit(float((total[column] or 0) + size)))

    odds = F.round((log_share("spam") - log_share("nonspam")) * SCALE).cast("bigint")
    return counts.select("token", odds.alias("log_odds"))


def classify(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(id, score, predicted) of (id, body); each distinct token counts once, no evidence is nonspam.

    Next to a small model the tokens of a mail are summed where they are read. A large one is joined by token, where a task would
    keep a sum for nearly every mail there is; so the rows are dealt out by id first and summed after that.
    """
    tokens = docs.select("id", F.explode_outer(F.array_distinct(spam_tokens(F.col("body")))).alias("token"))
    if model.limit(BROADCAST_TOKENS + 1).count() <= BROADCAST_TOKENS:
        odds = tokens.join(F.broadcast(model), "token", "left")
    else:
        odds = tokens.join(model, "token", "left").select("id", "log_odds").repartition("id")
    scored = odds.groupBy("id").agg(F.coalesce(F.sum("log_odds"), F.lit(0)).alias("score"))
    return scored.withColumn(
        "predicted", F.when(F.col("score") > 0, F.lit(SPAM)).otherwise(F.lit(NONSPAM))
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """(tested, misclassified, misclassification_rate, accuracy) of (label, predicted) rows."""
    wrong = F.count_if(F.col("label") != F.col("predicted"))
    rate = wrong / F.count(F.lit(1))
    return predictions.agg(
        F.count(F.lit(1)).alias("tested"),
        wrong.alias("misclassified"),
        rate.alias("misclassification_rate"),
        (1 - rate).alias("accuracy"),
    )


def filter_spam(emails: DataFrame, model: DataFrame) -> DataFrame:
    """The mails whose top class is nonspam."""
    spam = classify(emails.select("id", "body"), model).where(F.col("predicted") == SPAM)
    return emails.join(spam.select("id"), "id", "left_anti")
