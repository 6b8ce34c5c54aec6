"""Attachment contents by their digest: what is found out about a content is found out once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.operators import entities, language
from mailloom.runtime import checkpointed

UNKNOWN = "UNKNOWN"


def content_store(mails: DataFrame) -> DataFrame:
    """(content_hash, contents64): each distinct attachment body once.

    `mails` went through `read_attachments` and still has its binaries. Equal bodies combine before they
    travel; nothing else in the chain moves a body.
    """
    rows = mails.select(F.explode("attachments").alias("a")).where(F.col("a.content_hash").isNotNull())
    return rows.groupBy("a.content_hash").agg(F.min("a.contents64").alias("contents64"))


def distinct_texts(mails: DataFrame) -> DataFrame:
    """(content_hash, content) of the attachments that could be read, each text once.

    Bodies of one digest that were read as different texts, by their declared charsets, give the first.
    """
    rows = mails.select(F.explode("attachments").alias("a")).where(F.col("a.content").isNotNull())
    return rows.groupBy("a.content_hash").agg(F.min("a.content").alias("content"))


def describe_contents(
    texts: DataFrame,
    profile: language.LanguageProfile | None = None,
    lexicon: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    force_language: str | None = None,
    margin: float = 0.02,
) -> DataFrame:
    """(content_hash, content_tika_langid, content_lang, content_translated, entities) of distinct texts.

    The language id is UNKNOWN without a certain answer. `force_language` stands in for the language in
    translation alone; without a profile or a forced language nothing is translated. Missing tables leave
    their columns null.
    """
    out = texts
    keyed = texts.select(F.col("content_hash").alias("id"), F.col("content").alias("body"))
    if profile is not None:
        found = checkpointed(language.detect_language(keyed, profile, unsure=UNKNOWN, margin=margin))
        ids = found.select(F.col("id").alias("content_hash"), F.col("lang").alias("content_tika_langid"))
        out = out.join(ids, "content_hash", "left")
    else:
        out = out.withColumn("content_tika_langid", F.lit(None).cast("string"))
    known = F.when(F.col("content_tika_langid") != UNKNOWN, F.col("content_tika_langid"))
    spoken = F.lit(force_language) if force_language else known
    out = out.withColumn("content_lang", F.when(spoken != "en", spoken))
    if lexicon is not None:
        out = language.translate_fields(out, ["content"], lexicon, "content_lang", "content_hash")
        out = out.withColumn("content_translated", F.when(F.col("content_lang").isNotNull(), F.col("content_translated")))
    else:
        out = out.withColumn("content_translated", F.lit(None).cast("string"))
    if gazetteer is not None:
        named = out.withColumnRenamed("content_hash", "id")
        out = entities.add_entities(checkpointed(named), gazetteer, "content").withColumnRenamed("id", "content_hash")
    return out.drop("content")


def add_descriptions(files: DataFrame, described: DataFrame) -> DataFrame:
    """Attachment rows with what is known of their contents; a content that many share is one row of
    `described`, and adaptive execution splits the many."""
    return files.drop("content_tika_langid").join(described, "content_hash", "left")
