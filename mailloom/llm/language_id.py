"""Language identification by unigram pieces, summed over all segmentations.

A word is "▁" and its letters. Under a language it has the probability of all its segmentations
into pieces of a fixed public vocabulary, summed by a forward pass. Piece probabilities are learned
for each language by expectation-maximisation over the counts of (language, word) of all training
rows; a step of it is one pass over that table, spread over the cluster, and only a row per language
and piece, bounded by the vocabulary, comes back to the driver.

Letter runs of more than `RUN` letters are taken in parts of that length, so that no product of
probabilities underflows; all letters of a text count.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom.llm.shared import stored
from mailloom.runtime import bounded_rows

RUN = 32
LETTERS = re.compile(r"[^\W\d_]+")
#: probability of a letter that the vocabulary lacks
UNKNOWN = 1e-8
#: added to every piece's expected count
SMOOTHING = 0.1
STEPS = 3
#: languages are a closed list; more of them is a mistake in the label column
MAX_LANGUAGES = 300
CACHE_WORDS = 500_000
#: numbers in one table of places, or in the memory of words, over all languages
CELLS = 4_000_000
#: texts whose new words are looked at together
TOGETHER = 1000
FLUSH_WORDS = 100_000
UNDETERMINED = "und"

PREDICTION = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def words_of(text: str) -> list[str]:
    found = LETTERS.findall(text.lower())
    if max(map(len, found), default=0) <= RUN:
        return found
    return [run[i : i + RUN] for run in found for i in range(0, len(run), RUN)]


class Lattice:
    """The pieces of a vocabulary at every place of words."""

    def __init__(self, pieces: list[str], languages: int = 1):
        import ahocorasick

        self.most_cells = CELLS // max(1, languages)
        self.unknown = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        # a match is one number: its length less one, then its piece
        self.base = self.unknown + 2
        self.matcher = ahocorasick.Automaton()
        for i, piece in enumerate(pieces):
            self.matcher.add_word(piece, (len(piece) - 1) * self.base + i)
        self.matcher.make_automaton()

    def parts(self, by_length: dict[int, list[int]]) -> Iterator[tuple[int, list[int]]]:
        """Words of one length in parts whose tables stay within `CELLS` numbers."""
        for n, members in by_length.items():
            together = max(1, self.most_cells // (n * min(n, self.longest)))
            for start in range(0, len(members), together):
                yield n, members[start : start + together]

    def places(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length at a time: their positions in the list, and piece ids [word, end, length - 1].

        `unknown` stands for a letter without a piece of its own, `unknown + 1` for no piece.
        """
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word) + 1, []).append(i)
        matches, step = self.matcher.iter, self.longest * self.base
        for n, members in self.parts(by_length):
            codes: list[int] = []
            for row, i in enumerate(members):
                first = row * n * step
                codes += [first + end * step + match for end, match in matches("▁" + words[i])]
            cell, piece = np.divmod(np.array(codes, dtype=np.int64), self.base)
            cell, k = np.divmod(cell, self.longest)
            at = np.full((len(members) * n, int(k.max(initial=0)) + 1), self.unknown + 1, dtype=np.int32)
            at[:, 0] = self.unknown
            at[cell, k] = piece
            yield np.array(members), at.reshape(len(members), n, -1)


def forward(p: np.ndarray) -> np.ndarray:
    """alpha[word, end, ...]: probability of all segmentations of the first `end` characters.

    `p` is the probability of the piece [word, end, length - 1, ...].
    """
    n, width = p.shape[1:3]
    alpha = np.ones((p.shape[0], n + 1, *p.shape[3:]))
    for end in range(1, n + 1):
        total = alpha[:, end - 1] * p[:, end - 1, 0]
        for k in range(2, min(width, end) + 1):
            total += alpha[:, end - k] * p[:, end - 1, k - 1]
        alpha[:, end] = total
    return alpha


@dataclass(frozen=True)
class Model:
    """Languages in order, pieces, and log-free probabilities [piece + 2, language]; the last two rows
    are an unknown letter and no piece."""

    languages: tuple[str, ...]
    pieces: tuple[str, ...]
    table: np.ndarray


def word_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, word, n) over all rows with a language and a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(name, Counter()).update(words_of(body))
            if sum(map(len, seen.values())) > FLUSH_WORDS:
                yield out(seen)
                seen = {}
        yield out(seen)

    def out(seen: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(name, word, n) for name, words in seen.items() for word, n in words.items()]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["lang", "word", "n"]
        )

    usable = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    parts = usable.mapInArrow(count, "lang string, word string, n bigint")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, pieces: list[str], lang: str = "lang", text: str = "text", steps: int = STEPS) -> Model:
    """Piece probabilities of each language of the column `lang`.

    Rows with a null language or text teach nothing. Without any usable row the model knows no
    language and predicts none. Languages are ordered by name, so equal scores go to the first.
    """
    counts = stored(word_counts(docs, lang, text))
    languages = tuple(sorted(r[0] for r in bounded_rows(counts.select("lang").distinct(), MAX_LANGUAGES, lang)))
    table = np.full((len(pieces) + 2, len(languages)), 1.0 / max(len(pieces), 1))
    table[-2], table[-1] = UNKNOWN, 0.0
    for _ in range(steps if languages else 0):
        expected = np.full((len(pieces), len(languages)), SMOOTHING)
        # at most a row per piece and language
        sums = expectation(counts, languages, list(pieces), table).toArrow()
        at = sums["piece"].to_numpy(), sums["language"].to_numpy()
        expected[at] += sums["n"].to_numpy()
        table = table.copy()
        table[:-2] = (1 - UNKNOWN) * expected / expected.sum(axis=0)
    return Model(languages, tuple(pieces), table)


def expectation(counts: DataFrame, languages: tuple[str, ...], pieces: list[str], table: np.ndarray) -> DataFrame:
    """(language, piece, n): expected uses of each piece, by forward and backward sums over each word."""
    index = {name: i for i, name in enumerate(languages)}
    shared = counts.sparkSession.sparkContext.broadcast((pieces, table))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = shared.value
        lattice = Lattice(names)
        cells: list[np.ndarray] = []
        values: list[np.ndarray] = []

        def gathered() -> np.ndarray:
            if not cells:
                return np.zeros(p.size)
            out = np.bincount(np.concatenate(cells), np.concatenate(values), minlength=p.size)
            cells.clear()
            values.clear()
            return out

        total = np.zeros(p.size)
        for batch in batches:
            lang = np.array([index[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            weight = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            for members, at in lattice.places(batch.column(1).to_pylist()):
                own, n_of = lang[members], weight[members]
                chance = p[at, own[:, None, None]]
                alpha = forward(chance)
                n, width = at.shape[1:]
                beta = np.zeros_like(alpha)
                beta[:, n] = n_of / alpha[:, n]
                used = np.zeros_like(chance)
                for end in range(n, 0, -1):
                    for k in range(1, min(width, end) + 1):
                        onward = beta[:, end] * chance[:, end - 1, k - 1]
                        beta[:, end - k] += onward
                        used[:, end - 1, k - 1] = alpha[:, end - k] * onward
                word, end, k = np.nonzero(used)
                cells.append(at[word, end, k].astype(np.int64) * p.shape[1] + own[word])
                values.append(used[word, end, k])
                if sum(map(len, cells)) > FLUSH_WORDS * 10:
                    total += gathered()
        total += gathered()
        total = total.reshape(p.shape)
        piece, language = np.nonzero(total[:-2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(language), pa.array(piece), pa.array(total[piece, language])], ["language", "piece", "n"]
        )

    parts = counts.select("lang", "word", "n").mapInArrow(step, "language bigint, piece bigint, n double")
    return parts.groupBy("language", "piece").agg(F.sum("n").alias("n"))


class Scorer:
    """Predictions of one model; keeps the log probabilities of a bounded number of words."""

    def __init__(self, model: Model):
        self.model = model
        self.lattice = Lattice(list(model.pieces), len(model.languages))
        self.known: dict[str, int] = {}
        self.most = max(1000, min(CACHE_WORDS, CELLS // max(1, len(model.languages))))
        self.rows = np.zeros((self.most, len(model.languages)))

    def learn(self, words: list[str]) -> None:
        """Rows for words that have none; all words fit in the memory together."""
        values = np.zeros((len(words), len(self.model.languages)))
        for members, at in self.lattice.places(words):
            values[members] = np.log(forward(self.model.table[at])[:, -1])
        first = len(self.known)
        self.rows[first : first + len(words)] = values
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def forget(self, wanted: set[str]) -> None:
        """Makes room: the words of the texts at hand stay."""
        stay = [w for w in wanted if w in self.known]
        rows = self.rows[[self.known[w] for w in stay]]
        self.rows[: len(stay)] = rows
        self.known = dict(zip(stay, range(len(stay)), strict=True))

    def totals(self, words: Counter) -> np.ndarray:
        """Log probability of a text under each language; texts of any number of words."""
        names = list(words)
        total = np.zeros(len(self.model.languages))
        for start in range(0, len(names), self.most // 2):
            part = names[start : start + self.most // 2]
            missing = [w for w in part if w not in self.known]
            if len(self.known) + len(missing) > self.most:
                self.forget(set(part))
                missing = [w for w in part if w not in self.known]
            self.learn(missing)
            at = np.fromiter(map(self.known.__getitem__, part), dtype=np.int64, count=len(part))
            n = np.fromiter(map(words.__getitem__, part), dtype=float, count=len(part))
            total += n @ self.rows[at]
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for start in range(0, len(texts), TOGETHER):
            part = [Counter(words_of(t)) if t else Counter() for t in texts[start : start + TOGETHER]]
            # new words of many texts are looked at together
            wanted = set().union(*part)
            if len(wanted) <= self.most:
                missing = [w for w in wanted if w not in self.known]
                if len(self.known) + len(missing) > self.most:
                    self.forget(wanted)
                    missing = [w for w in wanted if w not in self.known]
                self.learn(missing)
            for words in part:
                if not words or not self.model.languages:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                total = self.totals(words)
                odds = np.exp(total - total.max())
                best = int(odds.argmax())
                names.append(self.model.languages[best])
                scores.append(float(odds[best] / odds.sum()))
        return names, scores


_SCORERS: dict[str, Scorer] = {}


def predictor(spark, model: Model):
    """A column function: text to struct<lang_pred, score>.

    `score` is the posterior of the predicted language among the learned ones. A null text, or one
    without a letter, is `und` with score 0.
    """
    shared = spark.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(texts: pd.Series) -> pd.DataFrame:
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(shared.value)
        langs, scores = _SCORERS[name].predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return F.pandas_udf(run, PREDICTION)


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by `parts`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == 0


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """All columns of `docs` and a struct `into` with lang_pred and score."""
    return docs.withColumn(into, predictor(docs.sparkSession, model)(F.col(text)))
