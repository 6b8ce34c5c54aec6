"""Severity of toxic language by cumulative-link (ordinal) regression on the words of a text.

Grades are ordered: 0 clean, 1 toxic, 2 severe. P(grade <= k) = sigmoid(threshold_k - weights . x),
with one weight per word for all thresholds; the expected grade is the sum of P(grade > k).

Words and their beginnings are counted over all labelled rows. All of them whose share of toxic rows surely differs
from their share of clean ones become features, present or absent in a text. Labels say
only toxic or not; among toxic rows those with at least as many of the telling words per row as their median
are severe. The regression is fitted on at most about `TRAINING_ROWS` labelled rows, chosen by a hash of
the id; below that bound all are used.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.llm.shared import broadcast_if_small
from mailloom.runtime import bounded_rows

WORD = re.compile(r"[^\W\d_]+")
#: features that a driver can hold; more are an error, never a cut
MOST_FEATURES = 1_000_000
TRAINING_ROWS = 20_000
#: rows a word must be in, and its least log-likelihood ratio (16: four standard errors)
LEAST_ROWS, SURE = 3, 16.0
RIDGE = 0.01
STEPS = 600
FLUSH_WORDS = 200_000
GRADED = "severity double, p_toxic double, p_severe double, toxic boolean"


#: lengths of the word beginnings that are features of their own, so that forms of a word count together
BEGINNINGS = (4, 5, 6, 7)
CACHE_WORDS = 300_000


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words marked by a hyphen."""
    return words.union(*({w[:n] + "-" for w in words if len(w) > n} for n in BEGINNINGS))


class Lookup(dict):
    """Ids of the known features of a word; forgets all when full."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = tuple(self.known[f] for f in features_of({word}) if f in self.known)
        return found

    def of(self, text: str | None) -> list[int]:
        return sorted({i for found in map(self.__getitem__, words_of(text)) if found for i in found})


@dataclass(frozen=True)
class Grader:
    words: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    cutoff: float = 0.5

    def probabilities(self, at: list[int] | np.ndarray) -> tuple[float, float]:
        """P(grade > 0) and P(grade > 1) of a text with these features."""
        score = self.weights[at].sum() if len(at) else 0.0
        above = 1 / (1 + np.exp(self.thresholds - score))
        return float(above[0]), float(above[1])


def word_rows(rows: DataFrame) -> DataFrame:
    """(word, toxic, clean): labelled rows with the word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[bool(toxic)].update(features_of(words_of(text)))
            if len(seen[0]) + len(seen[1]) > FLUSH_WORDS:
                yield out(seen)
                seen = (Counter(), Counter())
        yield out(seen)

    def out(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        clean, toxic = seen
        words = list(clean.keys() | toxic.keys())
        counts = [[c[w] for w in words] for c in (toxic, clean)]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array(c, pa.int64()) for c in counts)], ["word", "toxic", "clean"]
        )

    parts = rows.select("toxic", "text").mapInArrow(count, "word string, toxic bigint, clean bigint")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def telling_words(rows: DataFrame) -> list[tuple[str, float]]:
    """Every word and beginning that is sure enough, and its log-likelihood ratio, positive for toxic, the largest first."""
    totals = {bool(r[0]): r[1] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    if not n_toxic or not n_clean:
        return []
    n = n_toxic + n_clean
    has = F.col("toxic") + F.col("clean")

    def term(seen, total: int, with_word):
        """Part of the log-likelihood ratio of one cell of the table of word and label."""
        return F.when(seen > 0, seen * F.log(seen * n / (with_word * total))).otherwise(0.0)

    ratio = 2 * sum(
        term(seen, total, has) + term(total - seen, total, n - has)
        for seen, total in ((F.col("toxic"), n_toxic), (F.col("clean"), n_clean))
    )
    sign = F.when(F.col("toxic") * n_clean > F.col("clean") * n_toxic, 1.0).otherwise(-1.0)
    found = word_rows(rows).where(has >= LEAST_ROWS).select("word", (sign * ratio).alias("sure"))
    best = bounded_rows(found.where(F.abs("sure") >= SURE), MOST_FEATURES, "the words that tell toxic texts")
    return sorted(((r.word, r.sure) for r in best), key=lambda x: (-abs(x[1]), x[0]))


def cumulative_link(at: list[np.ndarray], grade: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and two thresholds of highest penalised likelihood, by accelerated gradient steps."""
    row = np.repeat(np.arange(len(at)), [len(x) for x in at])
    column = np.concatenate(at) if at else np.zeros(0, np.int64)
    weights, thresholds = np.zeros(features), np.array([0.0, 1.0])
    above = np.stack([grade > 0, grade > 1]).astype(float)
    share = np.clip(above.mean(axis=1), 1e-3, 1 - 1e-3)
    thresholds = np.maximum.accumulate(np.log(1 / share - 1) + np.array([0, 1e-3]))
    moment, spread = np.zeros(features + 2), np.zeros(features + 2)
    for step in range(1, STEPS + 1):
        score = np.bincount(row, weights[column], minlength=len(at))
        p = 1 / (1 + np.exp(np.clip(thresholds[:, None] - score, -30, 30)))  # P(grade > k)
        # P(grade) is a difference of neighbouring cumulative probabilities
        bounds = np.vstack([np.ones(len(at)), p, np.zeros(len(at))])
        slopes = bounds * (1 - bounds)
        index = np.arange(len(at))
        mass = np.maximum(bounds[grade, index] - bounds[grade + 1, index], 1e-12)
        by_score = (slopes[grade, index] - slopes[grade + 1, index]) / mass
        by_threshold = [
            ((grade == k + 1) * -slopes[k + 1] / mass + (grade == k) * slopes[k + 1] / mass).sum() for k in (0, 1)
        ]
        slope = np.concatenate([np.bincount(column, by_score[row], minlength=features) - RIDGE * weights, by_threshold])
        moment = 0.9 * moment + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        move = 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        weights = weights + move[:features]
        thresholds = np.maximum.accumulate(thresholds + move[features:] + np.array([0, 1e-9]))
    return weights, thresholds


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Grader:
    """A grader learned from labelled rows.

    Rows with a null label, id or text teach nothing; an id with several labels has the largest one.
    Without toxic or without clean rows every text gets grade 0.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label).alias("toxic")).dropna().groupBy("id").agg((F.max("toxic") > 0).alias("toxic"))
    own = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).dropna()
    rows = own.join(broadcast_if_small(marks), "id")
    found = telling_words(rows)
    words = {word: i for i, (word, _) in enumerate(found)}
    if not words:
        return Grader({}, np.zeros(0), np.array([30.0, 31.0]))
    sure = np.array([s for _, s in found])
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        for batch in batches:
            at = [lookup.of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32()))], ["toxic", "at"])

    total = marks.count()
    share = min(1.0, TRAINING_ROWS / max(total, 1))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)).select("toxic", "text")
    data = sample.mapInArrow(features, "toxic boolean, at array<int>").toArrow()
    at = [np.array(x, dtype=np.int64) for x in data["at"].to_pylist()]
    toxic = np.array(data["toxic"].to_pylist(), dtype=bool)
    strength = np.array([(sure[x] > 0).sum() for x in at], dtype=float)
    median = max(1.0, np.median(strength[toxic])) if toxic.any() else 1.0
    grade = toxic.astype(int) + (toxic & (strength >= median))
    weights, thresholds = cumulative_link(at, grade, len(words))
    found = Grader(words, weights, thresholds)
    return replace(found, cutoff=best_cutoff(np.array([found.probabilities(x)[0] for x in at]), toxic))


def best_cutoff(p: np.ndarray, toxic: np.ndarray) -> float:
    """The P(toxic) from which a text counts as toxic: most right answers on the shares of both classes.

    Between the last value taken and the next lower one the middle is used.
    """
    values, at = np.unique(-p, return_inverse=True)
    values = -values
    hits = np.cumsum(np.bincount(at[toxic], minlength=len(values))) / max(toxic.sum(), 1)
    caught = hits - np.cumsum(np.bincount(at[~toxic], minlength=len(values))) / max((~toxic).sum(), 1)
    best = int(np.argmax(caught)) if len(values) else 0
    return float(values[best : best + 2].mean()) if len(values) > 1 else 0.5


_GRADERS: dict[str, tuple[Grader, Lookup]] = {}


def grader(spark: SparkSession, model: Grader):
    """A column function: text to struct<severity, p_toxic, p_severe, toxic>."""
    shared = spark.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(texts: pd.Series) -> pd.DataFrame:
        if name not in _GRADERS:
            _GRADERS.clear()
            _GRADERS[name] = shared.value, Lookup(shared.value.words)
        own, lookup = _GRADERS[name]
        both = [own.probabilities(lookup.of(t if isinstance(t, str) else None)) for t in texts]
        out = pd.DataFrame(both, columns=["p_toxic", "p_severe"], dtype=float)
        out.insert(0, "severity", out.p_toxic + out.p_severe)
        out["toxic"] = out.p_toxic >= own.cutoff
        return out

    return F.pandas_udf(run, GRADED)


def grade(docs: DataFrame, model: Grader, text: str = "text", into: str = "toxicity") -> DataFrame:
    """All columns of `docs` and a struct `into`; a null or empty text has the grade of no words at all."""
    return docs.withColumn(into, grader(docs.sparkSession, model)(F.col(text)))
