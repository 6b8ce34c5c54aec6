"""The whole chain: raw messages to enriched index tables in one session."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom.functions.cleaning import domain
from mailloom.operators import addresses as A
from mailloom.operators import amounts, attachments, communities, contents, entities, geo, language, numbers, topics
from mailloom.operators import terms
from mailloom.operators.index import all_addresses
from mailloom.runtime import checkpointed, written


@dataclass
class Lookups:
    """Reference tables; a step whose table is missing is left out."""

    networks: DataFrame | None = None
    gazetteer: DataFrame | None = None
    lexicon: DataFrame | None = None
    phone_plan: numbers.Plan | None = None
    image_sidecars: Sequence[DataFrame] = field(default_factory=tuple)
    #: tags of images by guid, as `attachments.gps_from_tags` reads them
    image_tags: DataFrame | None = None
    force_language: str | None = "en"
    profile: language.LanguageProfile | None = None
    topic_count: int = topics.TOPICS
    topic_iterations: int = topics.ITERATIONS
    vocabulary: int = terms.VOCABULARY_SIZE


@dataclass
class Tables:
    emails: DataFrame
    attachments: DataFrame
    addresses: DataFrame
    topics: DataFrame
    #: lists of mails and attachments by address and month
    address_history: DataFrame
    #: each distinct attachment body once, by digest
    contents: DataFrame


def land(emails: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mails with binaries, the same without): parsed and read once, written, and read back twice.

    The second reads the stored columns without the binaries' column, so that no later join or shuffle
    carries a body.
    """
    read = attachments.read_attachments(emails)
    path = written(read)
    files = read.schema["attachments"].dataType.elementType
    light = T.ArrayType(T.StructType([f for f in files.fields if f.name != "contents64"]))
    fields = [T.StructField(f.name, light if f.name == "attachments" else f.dataType) for f in read.schema.fields]
    reader = emails.sparkSession.read
    return reader.schema(read.schema).parquet(path), emails.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def enrich(emails: DataFrame, lookups: Lookups | None = None, documents: bool = False) -> Tables:
    """Every stage over normalised mails.

    Row-local steps are chained in one plan. What several later steps read is written once to the
    checkpoint folder: the mails, parsed and with the text of their attachments, and the address
    communities. Mails with one id, and communities of mails that are missing, are an error.
    """
    lookups = lookups or Lookups()
    landed, light = land(emails)
    base = light
    if documents:
        base = attachments.bodies_from_contents(base)
    if lookups.image_sidecars:
        base = checkpointed(attachments.merge_sidecars(base, *lookups.image_sidecars, documents=documents))
    described = contents.describe_contents(
        checkpointed(contents.distinct_texts(light)), lookups.profile, lookups.lexicon, lookups.gazetteer, lookups.force_language
    )
    files = contents.add_descriptions(attachments.to_attachments(base), described)
    if lookups.image_tags is not None:
        found = attachments.gps_from_tags(lookups.image_tags).where(F.col("gps").isNotNull())
        files = files.join(found.select("guid", F.struct("gps").alias("exif")), "guid", "left")

    people = A.participants(base)
    edges = A.weighted_edges(base)
    nodes = checkpointed(A.node_index(edges))
    membership = communities.louvain(A.undirected(edges), nodes=nodes)
    named = checkpointed(A.name_communities(nodes, membership))
    stamps = [c for c in ("ingest_id", "case_id", "alt_ref_id", "label") if c in base.columns]
    address_rows = A.address_table(A.address_stats(people), named).withColumn("domain", domain(F.col("addr")))
    if stamps:
        address_rows = address_rows.join(_stamps(A.participants(base), base, stamps), "addr")

    out = numbers.add_numbers(base, lookups.phone_plan)
    out = amounts.add_currency(out)
    assigned = checkpointed(A.email_communities(people, named))
    A.assert_unique_ids(base, assigned)
    out = A.assign_communities(out, assigned)
    vectors, vocab = _vectors(base, lookups.vocabulary)
    model = topics.fit_lda(vectors, lookups.topic_count, lookups.topic_iterations)
    scores = topics.doc_topics(model)
    out = out.join(scores.withColumnRenamed("scores", "topic_scores"), "id", "left")
    if lookups.lexicon is not None:
        texts = base.select("id", "body")
        spoken = language.detect_language(texts, lookups.profile, lookups.force_language)
        out = language.route_translation(out, lookups.lexicon, spoken)
    if lookups.gazetteer is not None:
        out = entities.add_entities(out, lookups.gazetteer)
    if lookups.networks is not None:
        out = geo.add_locations(out, lookups.networks)
    out = out.withColumn("addrs", all_addresses())
    return Tables(
        out,
        files,
        address_rows,
        topics.topic_map(topics.describe_topics(model, vocab)),
        A.address_history(base.withColumn("attachments", F.transform("attachments", _listed))),
        contents.content_store(landed),
    )


def _listed(attachment: Column) -> Column:
    """What an address record lists of an attachment."""
    return F.struct(*(attachment[c].alias(c) for c in ("guid", "extension", "filename", "content_type", "content_hash", "size")))


def _stamps(people: DataFrame, base: DataFrame, stamps: list[str]) -> DataFrame:
    """Provenance per address: that of its lowest mail id."""
    rows = people.select("addr", F.col("email_id").alias("id")).join(base.select("id", *stamps), "id")
    return rows.groupBy("addr").agg(*[F.min_by(c, "id").alias(c) for c in stamps])


def _vectors(base: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    texts = base.select("id", "body").where(F.col("body").isNotNull())
    vocab = checkpointed(terms.vocabulary(texts, size))
    vectors = topics.with_terms(terms.term_vectors(texts, vocab, size)).select("id", "features")
    return checkpointed(vectors), vocab
