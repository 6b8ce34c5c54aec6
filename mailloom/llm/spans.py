"""Removal of passages that occur elsewhere, by matching statistics on suffix automata.

A window is `length` consecutive words. Every word that a window with another occurrence in the
corpus covers is removed.

Broadcasting the automaton of every part of the corpus to every document would cost the square of
the corpus, so automata and documents first meet by fingerprint: the smallest hash of `GRAM` words
in a window. Equal windows have equal fingerprints, and the windows of a document with the same
fingerprint make one short context, so each window lies in exactly one context. Contexts whose
fingerprint is found once are done. Equal contexts count once, with their number. The rest are the
reference, cut into shards of about `SHARD` contexts that keep the contexts of a fingerprint
together; a suffix automaton of each shard counts in how many places each of its strings ends, and
the contexts are streamed through it: a place where the longest match reaches `length` words and
whose state has two occurrences ends a repeated window.

A fingerprint with more than `HOT` different contexts is dealt over several shards. There a window
found once is also counted, by a 128-bit digest, over the other shards of its fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.llm.shared import fresh, row_key, stored
from mailloom.llm.words import gram_hashes, run_hashes, word_hashes

LENGTH = 35
GRAM = 8
SHARD = 1000
HOT = 1000


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def contexts_of(words: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Fingerprint, first window, number of windows and two digests of every context of a document."""
    n = len(words)
    hashes = word_hashes(words)
    grams = gram_hashes(hashes, gram)
    windows = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1)
    chosen = windows.argmin(axis=1) + np.arange(n - length + 1)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    count = np.diff(np.concatenate([first, [len(chosen)]]))
    ends = first + count - 1 + length
    return (
        grams[chosen[first]],
        first,
        count,
        run_hashes(hashes, first, ends, 0),
        run_hashes(hashes, first, ends, 1),
    )


def fingerprints(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text.encode().split() if text else []
                if len(words) >= length:
                    parts.append(contexts_of(words, length, gram))
                    keys += [key] * len(parts[-1][0])
            if parts:
                fp, first, count, one, two = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.binary()),
                        pa.array(first.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        signed(fp),
                        signed(one),
                        signed(two),
                    ],
                    ["key", "first", "windows", "fp", "d1", "d2"],
                )

    return run


def cut_contexts(length: int):
    """Texts of the asked contexts of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"fp": [], "d1": [], "d2": [], "many": [], "part": [], "words": []}
            for text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text.encode().split()
                for x in asked:
                    for name in ("fp", "d1", "d2", "many", "part"):
                        out[name].append(x[name])
                    out["words"].append(b" ".join(words[x["first"] : x["first"] + x["windows"] - 1 + length]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True)], list(out)
            )

    return run


class SuffixAutomaton:
    """Of several strings of words: for each state its longest string, suffix link and places."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.longest, self.places = [-1], [0], [0]

    def add_state(self, longest: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.longest.append(longest)
        self.places.append(0)
        return len(self.next) - 1

    def branch(self, state: int, word, below: int) -> int:
        """The state of exactly the string of `state` and `word`, split off from `below` if need be."""
        if self.longest[below] == self.longest[state] + 1:
            return below
        copy = self.add_state(self.longest[state] + 1, self.link[below], dict(self.next[below]))
        self.link[below] = copy
        while state >= 0 and self.next[state].get(word) == below:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def extend(self, last: int, word) -> int:
        below = self.next[last].get(word)
        if below is not None:
            return self.branch(last, word, below)
        new = self.add_state(self.longest[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self.branch(state, word, self.next[state][word])
        return new

    def add(self, words: list, weight: int) -> None:
        last = 0
        for word in words:
            last = self.extend(last, word)
            self.places[last] += weight

    def count_places(self) -> None:
        """Places of a string are also places of its suffixes."""
        for state in sorted(range(1, len(self.next)), key=self.longest.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]] += self.places[state]

    def repeated_ends(self, words: list, length: int) -> list[int]:
        """Ends of the windows of `length` words that have two places or more, by matching statistics."""
        out, state, match = [], 0, 0
        for end, word in enumerate(words, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                match = self.longest[state]
            below = self.next[state].get(word)
            state, match = (below, match + 1) if below is not None else (0, 0)
            while self.longest[self.link[state]] >= length:
                state = self.link[state]
                match = self.longest[state]
            if match >= length and self.places[state] > 1:
                out.append(end)
        return out


def match_shard(length: int):
    """Repeated windows of the contexts of one shard; of split fingerprints also all other windows."""

    def run(shard: pa.Table) -> pa.Table:
        rows = shard.select(["fp", "d1", "d2", "many", "part", "words"]).to_pylist()
        automaton = SuffixAutomaton()
        names: dict[bytes, int] = {}
        texts = []
        for row in rows:
            texts.append([names.setdefault(w, len(names)) for w in row["words"].split()])
            automaton.add(texts[-1], 2 if row["many"] else 1)
        automaton.count_places()
        out: dict[str, list] = {"fp": [], "d1": [], "d2": [], "starts": [], "open": [], "w1": [], "w2": []}
        for row, text in zip(rows, texts, strict=True):
            n = len(text) - length + 1
            starts = [end - length for end in automaton.repeated_ends(text, length)]
            for name in ("fp", "d1", "d2"):
                out[name].append(row[name])
            out["starts"].append(starts)
            split = row["part"] is not None
            hashes = word_hashes(row["words"].split()) if split else None
            places = np.arange(n)
            for column, which in (("w1", 0), ("w2", 1)):
                out[column].append(
                    run_hashes(hashes, places, places + length, which).view(np.int64).tolist() if split else []
                )
            out["open"].append(sorted(set(range(n)) - set(starts)) if split else [])
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        kinds = (pa.int64(), pa.int64(), pa.int64(), ints, ints, longs, longs)
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return run


MATCHED = "fp long, d1 long, d2 long, starts array<int>, open array<int>, w1 array<long>, w2 array<long>"


def repeated_windows(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, starts): starts of the repeated windows of each document that has any."""
    places = stored(
        keyed.select("key", "text").mapInArrow(
            fingerprints(length, gram), "key binary, first int, windows int, fp long, d1 long, d2 long"
        )
    )
    context = ["fp", "d1", "d2"]
    twice = places.groupBy("fp").agg(F.count("*").alias("total")).where("total > 1").select("fp")
    places = stored(places.join(twice, "fp"))
    found = places.groupBy(context).agg(F.count("*").alias("n"), F.min(F.struct("key", "first", "windows")).alias("at"))
    found = stored(found.select(*context, "at.*", (F.col("n") > 1).alias("many")))
    reference = stored(found.join(found.groupBy("fp").agg(F.count("*").alias("kinds")), "fp"))
    mixed = reference.where("kinds > 1").withColumn(
        "part",
        F.when(
            F.col("kinds") > HOT,
            F.concat_ws("/", "fp", F.pmod(F.xxhash64("d1"), F.ceil(F.col("kinds") / SHARD))),
        ),
    )
    shards = mixed.where("part IS NULL").count() // SHARD + 1
    asked = mixed.groupBy("key").agg(F.collect_list(F.struct(*context, "many", "part", "first", "windows")).alias("asked"))
    one_text = keyed.select("key", "text")
    cut = one_text.join(asked, "key").select("text", "asked").mapInArrow(
        cut_contexts(length), "fp long, d1 long, d2 long, many boolean, part string, words binary"
    )
    shard = F.coalesce("part", F.pmod(F.xxhash64("fp"), F.lit(shards)).cast("string"))
    matched = stored(cut.groupBy(shard.alias("shard")).applyInArrow(match_shard(length), MATCHED))

    # windows of split fingerprints: how many of their shards' places there are in all
    open_windows = matched.where(F.size("open") > 0).select(*context, F.explode("open").alias("start"), "w1", "w2").select(
        *context, "start", F.get("w1", "start").alias("w1"), F.get("w2", "start").alias("w2")
    )
    split = matched.where(F.size("w1") > 0).select("fp", F.explode(F.arrays_zip("w1", "w2")).alias("w")).select("fp", "w.*")
    common = split.groupBy("fp", "w1", "w2").agg(F.count("*").alias("n")).where("n > 1")
    later = open_windows.join(common, ["fp", "w1", "w2"]).groupBy(context).agg(F.collect_set("start").alias("later"))
    some = matched.join(later, context, "left").select(
        *context, F.concat("starts", F.coalesce("later", F.array().cast("array<int>"))).alias("starts")
    )
    # equal contexts lead to one result, whichever text stood for them
    some = some.groupBy(context).agg(F.flatten(F.collect_set("starts")).alias("starts"))
    marks = reference.join(some, context, "left").select(
        *context,
        F.when(F.col("many"), F.sequence(F.lit(0), F.col("windows") - 1)).otherwise(F.col("starts")).alias("starts"),
    ).where(F.size("starts") > 0)
    hit = places.join(marks, context).select(
        "key", F.transform("starts", lambda s: s + F.col("first")).alias("starts")
    )
    return hit.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))


def removed_words(length: int):
    kind = "n_words long, n_removed long, kept string"

    def run(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for text, at in zip(texts, starts, strict=True):
            words = text.encode().split() if isinstance(text, str) else []
            n = len(words)
            if at is not None and len(at):
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, np.asarray(at, dtype=np.int64), 1)
                np.add.at(change, np.asarray(at, dtype=np.int64) + length, -1)
                keep = np.cumsum(change)[:-1] == 0
                words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            out.append((n, n - len(words), b" ".join(words).decode()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    return F.pandas_udf(run, kind)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", into: str = "cleaned", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """All columns of `docs` and a struct `into` <n_words, n_removed, kept>.

    Words are what white space of ASCII separates; `kept` joins the words left by single spaces. A
    null or empty text has no words. Repeated rows are documents of their own, so the windows of a row
    given twice do occur elsewhere.
    """
    key, starts = fresh("key"), fresh("starts")
    keyed = docs.select(row_key(F.col(id_col), F.col(text)).alias("key"), F.col(text).alias("text")).where(
        F.col("text").isNotNull()
    )
    repeats = repeated_windows(keyed, length, gram)
    joined = docs.withColumn(key, row_key(F.col(id_col), F.col(text))).join(
        repeats.select(F.col("key").alias(key), F.col("starts").alias(starts)), key, "left"
    )
    others = [F.col(c) for c in docs.columns if c != into]
    return joined.select(*others, removed_words(length)(F.col(text), F.col(starts)).alias(into))
