"""LDA topics of a corpus and topic scores of its documents.

The model is the one of expectation-maximisation: counts of (term, topic) and of (document, topic), and in each
iteration every cell (document, term) is shared out to the topics by both. Documents stay where they are, as
blocks of cells with the topic counts beside them; only the table of terms by topics, which the vocabulary
bounds, is summed up and sent out again. So an iteration moves no documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.runtime import ensure_checkpoint_dir

# fixed values: number of topics, EM iterations, terms shown per topic, decimals of a score
TOPICS = 10
ITERATIONS = 100
TERMS_PER_TOPIC = 10
SCORE_DECIMALS = 5

# documents of a block, cells that are shared out at once, iterations between two checkpoints
BLOCK_DOCS = 2048
SLICE_CELLS = 65_536
CHECKPOINT_INTERVAL = 20


@dataclass(frozen=True)
class TopicModel:
    """topics: one row of term counts per topic; scores: (id, distribution) of the documents fitted."""

    topics: np.ndarray
    scores: DataFrame


def with_terms(vectors: DataFrame) -> DataFrame:
    """Documents that hold at least one vocabulary term."""
    values = F.unwrap_udt("features")["values"]
    return vectors.where(F.aggregate(values, F.lit(0.0), lambda t, v: t + v) > 0)


def _cells(vectors: DataFrame, seed: int) -> DataFrame:
    """(id, draw, terms, counts, size): the non-zero cells of each vector, sparse or dense."""
    raw = F.unwrap_udt("features")
    dense = vector_to_array("features")
    every = F.sequence(F.lit(0), F.size(dense) - 1)
    terms = F.when(raw["type"] == 0, raw["indices"]).otherwise(F.filter(every, lambda i: F.get(dense, i) != 0))
    counts = F.when(raw["type"] == 0, raw["values"]).otherwise(F.filter(dense, lambda v: v != 0))
    size = F.when(raw["type"] == 0, raw["size"]).otherwise(F.size(dense))
    draw = F.xxhash64("id", F.lit(seed))
    return vectors.select(
        F.col("id").cast("string").alias("id"), draw.alias("draw"), terms.alias("terms"), counts.alias("counts"), size.alias("size")
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of `BLOCK_DOCS` rows, a row each: ids, and the other columns as bytes."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        lengths = rows["terms"].combine_chunks().value_lengths().to_numpy().astype(np.int32)
        terms = rows["terms"].combine_chunks().flatten().to_numpy().astype(np.int32)
        counts = rows["counts"].combine_chunks().flatten().to_numpy().astype(np.float64)
        draws = rows["draw"].to_numpy().astype(np.int64)
        data = [pa.array([x.tobytes()], pa.binary()) for x in (draws, lengths, terms, counts)]
        ids = pa.array([rows["id"].to_pylist()], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([ids, *data], names=["ids", "draws", "lengths", "terms", "counts"])

    waiting: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_DOCS):
            piece = batch.slice(at, BLOCK_DOCS)
            if n + piece.num_rows > BLOCK_DOCS:
                yield block(pa.Table.from_batches(waiting))
                waiting, n = [], 0
            waiting.append(piece)
            n += piece.num_rows
    if n:
        yield block(pa.Table.from_batches(waiting))


def _block(row) -> tuple:
    """(ids, draws, starts of the documents' cells, terms, counts)"""
    lengths = np.frombuffer(row.lengths, np.int32)
    starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return row.ids, np.frombuffer(row.draws, np.int64), starts, np.frombuffer(row.terms, np.int32), np.frombuffer(row.counts)


def _singly(rdd: RDD) -> RDD:
    """The same elements, pickled one at a time: zip() would else pickle a hundred together, and a task hold so many blocks at once."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def first_shares(draws: np.ndarray, k: int) -> np.ndarray:
    """One row per topic: what each document starts from, drawn from its own number alone."""
    with np.errstate(over="ignore"):
        x = draws.astype(np.uint64)[None, :] + np.arange(1, k + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    share = (x >> np.uint64(11)).astype(np.float64) / 2.0**53 + 1e-9
    return share / share.sum(axis=0)


def shared_out(block: tuple, held: np.ndarray, weights: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Topic counts of the documents, and of the terms, after each cell went to the topics by both weights."""
    _, _, starts, terms, counts = block
    new, total = np.empty_like(held), np.zeros_like(weights)
    first = 0
    while first < len(starts) - 1:
        # whole documents, one at least
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + SLICE_CELLS, "right")) - 1)
        a, b = starts[first], starts[last]
        term, lengths = terms[a:b], np.diff(starts[first : last + 1])
        parts = weights[:, term] * np.repeat(held[:, first:last] + alpha, lengths, axis=1)
        parts *= counts[a:b] / parts.sum(axis=0)
        new[:, first:last] = np.add.reduceat(parts, starts[first:last] - a, axis=1)
        for j, part in enumerate(parts):
            total[j] += np.bincount(term, part, len(total[j]))
        first = last
    return new, total


def fit_lda(vectors: DataFrame, k: int = TOPICS, iterations: int = ITERATIONS, seed: int = 17) -> TopicModel:
    """EM model over (id, features); vectors without a term are left out.

    The priors are those that Spark's EM takes by default, 50 / k of a document for each topic and 0.1 of a topic
    for each term. What documents start from depends on their ids alone.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    ensure_checkpoint_dir(spark)
    cells = _cells(vectors, seed)
    size = cells.select("size").first()
    width = size[0] if size else 0
    packed = cells.where(F.size("counts") > 0).select("id", "draw", "terms", "counts").mapInArrow(
        _packed, "ids array<string>, draws binary, lengths binary, terms binary, counts binary"
    )
    blocks = _singly(packed.repartition(context.defaultParallelism).rdd.map(_block)).persist(StorageLevel.MEMORY_AND_DISK)
    alpha, eta = 50.0 / k, 0.1
    totals = np.random.default_rng(seed).random((k, width))
    totals /= totals.sum(axis=0)
    state: RDD = _singly(blocks.map(lambda b: (first_shares(b[1], k), None)))
    for turn in range(iterations):
        weights = context.broadcast((totals + eta) / (totals.sum(axis=1, keepdims=True) + eta * width))
        after = _singly(blocks.zip(state).map(lambda x, w=weights: shared_out(x[0], x[1][0], w.value, alpha)))
        after.persist(StorageLevel.MEMORY_AND_DISK)
        if turn % CHECKPOINT_INTERVAL == CHECKPOINT_INTERVAL - 1:
            after.checkpoint()
        totals = after.map(lambda s: s[1]).treeAggregate(np.zeros((k, width)), np.add, np.add)
        state.unpersist()
        state = after
    rows = blocks.zip(state).flatMap(lambda x: zip(x[0][0], (x[1][0] / x[1][0].sum(axis=0)).T.tolist()))
    scores = spark.createDataFrame(rows, "id string, distribution array<double>")
    return TopicModel(totals, scores.withColumn("id", F.col("id").cast(vectors.schema["id"].dataType)))


def describe_topics(model: TopicModel, vocab: DataFrame, terms: int = TERMS_PER_TOPIC) -> DataFrame:
    """(topic, position, idx, term, score): the top terms of every topic."""
    shares = model.topics / np.maximum(model.topics.sum(axis=1, keepdims=True), 1e-300)
    rows = [
        (topic, position, int(idx), float(share[idx]))
        for topic, share in enumerate(shares)
        for position, idx in enumerate(np.argsort(-share, kind="stable")[:terms])
    ]
    top = vocab.sparkSession.createDataFrame(rows, "topic bigint, position int, idx bigint, score double")
    return top.join(vocab.select("idx", "term"), "idx").select("idx", "topic", "position", "score", "term")


def topic_map(described: DataFrame) -> DataFrame:
    """(idx, topic[{idx, term, score}]) as stored in the index."""
    entry = F.struct("position", "idx", "term", "score")
    return described.groupBy(F.col("topic").alias("idx")).agg(
        F.transform(
            F.sort_array(F.collect_list(entry)),
            lambda e: F.struct(e.idx.alias("idx"), e.term.alias("term"), e.score.alias("score")),
        ).alias("topic")
    )


def doc_topics(model: TopicModel) -> DataFrame:
    """(id, scores): one rounded score per topic, of every document the model was fitted to."""
    return model.scores.select("id", F.transform("distribution", lambda s: F.round(s, SCORE_DECIMALS)).alias("scores"))


def merge_topics(emails: DataFrame, scores: DataFrame) -> DataFrame:
    """Add topic_scores map(idx_i -> score); null for mails without scores."""
    keyed = scores.select(
        "id",
        F.map_from_arrays(
            F.transform(
                F.sequence(F.lit(0), F.size("scores") - 1), lambda i: F.concat(F.lit("idx_"), i.cast("string"))
            ),
            "scores",
        ).alias("topic_scores"),
    )
    return emails.join(keyed, "id", "left")
