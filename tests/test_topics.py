"""The topic model against expectation-maximisation spelled out on dense tables."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from mailloom.operators import topics as P

K, TERMS, SEED = 3, 40, 5


def corpus(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for d in range(300):
        counts = np.bincount((rnd.integers(0, 14, 20) + 13 * (d % 3)) % TERMS, minlength=TERMS).astype(float)
        if d % 50 == 7:
            counts[:] = 0
        held = {i: c for i, c in enumerate(counts) if c}
        rows.append((f"d{d}", Vectors.dense(counts) if d % 10 == 3 else Vectors.sparse(TERMS, held)))
    return spark.createDataFrame(rows, ["id", "features"])


def by_hand(vectors, iterations):
    rows = vectors.withColumn("draw", F.xxhash64("id", F.lit(SEED))).collect()
    cells = np.array([r.features.toArray() for r in rows])
    docs = P.first_shares(np.array([r.draw for r in rows]), K).T
    terms = np.random.default_rng(SEED).random((K, TERMS))
    terms = (terms / terms.sum(axis=0)).T
    for _ in range(iterations):
        share = (docs[:, None, :] + 50 / K) * (terms[None, :, :] + 0.1) / (terms.sum(axis=0) + 0.1 * TERMS)
        share *= (cells / share.sum(axis=2))[:, :, None]
        docs, terms = share.sum(axis=1), share.sum(axis=0)
    return {r.id: d / d.sum() for r, d in zip(rows, docs, strict=True)}, terms.T


@pytest.mark.parametrize("iterations", [1, 45])
def test_blocks_give_the_model_of_the_whole_table(spark, monkeypatch, iterations):
    monkeypatch.setattr(P, "BLOCK_DOCS", 64)
    vectors = corpus(spark).repartition(5).cache()
    filled = P.with_terms(vectors)
    assert filled.count() == 294
    model = P.fit_lda(filled, K, iterations, SEED)
    scores, terms = by_hand(filled, iterations)
    assert np.allclose(model.topics, terms)
    found = {r.id: list(r.scores) for r in P.doc_topics(model).collect()}
    assert set(found) == set(scores)
    assert all(np.allclose(found[i], scores[i], atol=1e-5) for i in found)


def test_top_terms_come_by_weight(spark):
    model = P.TopicModel(np.array([[1.0, 3.0, 0.0, 4.0], [5.0, 0.0, 5.0, 0.0]]), None)
    vocab = spark.createDataFrame([(i, f"w{i}") for i in range(4)], "idx bigint, term string")
    rows = P.describe_topics(model, vocab, 2).orderBy("topic", "position").collect()
    assert [(r.topic, r.position, r.term, r.score) for r in rows] == [(0, 0, "w3", 0.5), (0, 1, "w1", 0.375), (1, 0, "w0", 0.5), (1, 1, "w2", 0.5)]


def test_blocks_are_pickled_one_at_a_time(spark):
    """A block may have megabytes; zip() packs a hundred elements together unless they come one by one."""
    numbers = spark.sparkContext.parallelize(range(300), 3)
    blocks = P._singly(numbers.map(lambda i: (i, "block")))
    state = P._singly(blocks.map(lambda b: -b[0]))
    both = blocks.zip(state)
    assert both._jrdd.count() == blocks._jrdd.count() == 300
    assert both.collect() == [((i, "block"), -i) for i in range(300)]
