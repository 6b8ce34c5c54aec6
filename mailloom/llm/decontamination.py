"""Benchmark passages in documents, found by winnowing and confirmed word by word.

A window is `WINDOW` consecutive words of an item; an item of fewer words is one window. Of all runs
of `GRAM` words in a window the one of smallest hash is its fingerprint, so a window that a document
shares has its fingerprint among the document's. Fingerprints of documents and items are joined; the
few hits are extended in the document to all windows around them, and these are joined to the items'
windows as text. Items shorter than a window get runs as long as they are.

Only column expressions are used. `let` binds a value inside a row, because Spark would otherwise
compute it again for each element of an array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.llm.shared import ascii_lower, broadcast_if_small, fresh, row_key, stored

WINDOW = 13
GRAM = 8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """Lower-cased words; none for null."""
    return F.regexp_extract_all(F.coalesce(ascii_lower(text), F.lit("")), F.lit(WORD), F.lit(0))


def places(count: Column) -> Column:
    """1 to count; nothing for 0 or less."""
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def gram_hashes(hashes: Column, gram: int) -> Column:
    return F.transform(places(F.size(hashes) - gram + 1), lambda i: F.xxhash64(F.slice(hashes, i, gram)))


def fingerprints(hashes: Column, length: int) -> Column:
    """array<struct<length, fp>> of the windows of `length` words of a row of word hashes."""
    gram = min(GRAM, length)
    span = length - gram + 1

    def least(h: Column) -> Column:
        return F.transform(places(F.size(h) - span + 1), lambda i: F.array_min(F.slice(h, i, span)))

    found = gram_hashes(hashes, gram) if span == 1 else let(gram_hashes(hashes, gram), least)
    return F.transform(F.array_distinct(found), lambda fp: F.struct(F.lit(length).alias("length"), fp.alias("fp")))


def row_fingerprints(words: Column, lengths: list[int]) -> Column:
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.concat(*(fingerprints(h, n) for n in lengths)),
    )


def windows_at(words: Column, lengths: list[int], hits: Column) -> Column:
    """array<struct<length, start, words>>: windows of a document around its hit fingerprints."""

    def of_length(h: Column, n: int) -> Column:
        gram = min(GRAM, n)
        own = F.transform(F.filter(hits, lambda x: x.length == n), lambda x: x.fp)

        def around(asked: Column) -> Column:
            at = F.filter(
                F.transform(gram_hashes(h, gram), lambda g, i: F.when(F.array_contains(asked, g), i + 1)),
                lambda i: i.isNotNull(),
            )
            starts = F.flatten(
                F.transform(
                    at,
                    lambda i: F.sequence(F.greatest(F.lit(1), i - (n - gram)), F.least(i, F.size(words) - n + 1)),
                )
            )
            return F.transform(
                F.array_distinct(starts),
                lambda s: F.struct(
                    F.lit(n).alias("length"), s.alias("start"), F.array_join(F.slice(words, s, n), " ").alias("window")
                ),
            )

        return F.when(F.size(own) > 0, let(own, around)).otherwise(
            F.array().cast("array<struct<length:int,start:int,window:string>>")
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.concat(*(of_length(h, n) for n in lengths)))


def item_windows(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """(item, length, window): the distinct windows of all items with words."""
    n = F.least(F.size("words"), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.size("words") - n + 1)
    return (
        items.select(F.col(id_col).alias("item"), words_of(F.col(text)).alias("words"))
        .where(F.size("words") > 0)
        .select("item", n.alias("length"), F.explode(F.transform(starts, lambda s: F.array_join(F.slice("words", s, n), " "))).alias("window"))
        .distinct()
    )


def find(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    into: str = "overlap",
) -> DataFrame:
    """All columns of `docs` and a struct `into` <n_words, n_hit, items, contaminated>.

    `n_hit` counts the words inside any occurrence of a window of any item, `items` has the ids of the
    items with such windows, sorted as strings; a document is contaminated if a twentieth of its words
    or more are hit. Null and empty texts have no words; a null item id never shows in `items`.
    """
    windows = stored(item_windows(items, item_id, item_text))
    # at most WINDOW different lengths
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect()) or [WINDOW]
    known = windows.select("length", F.split("window", " ").alias("words"))
    by_length = F.coalesce(
        *(F.when(F.col("length") == n, row_fingerprints(F.col("words"), [n])) for n in lengths)
    )
    wanted = known.select(F.explode(by_length).alias("x")).select("x.*").distinct()

    keyed = docs.select(row_key(F.col(id_col), F.col(text)).alias("key"), F.col(text).alias("text"))
    seen = keyed.select("key", F.explode(let(words_of(F.col("text")), lambda w: row_fingerprints(w, lengths))).alias("x"))
    hits = seen.select("key", "x.*").join(broadcast_if_small(wanted), ["length", "fp"])
    asked = stored(hits.groupBy("key").agg(F.collect_set(F.struct("length", "fp")).alias("hits")))

    near = let(words_of(F.col("text")), lambda w: windows_at(w, lengths, F.col("hits")))
    around = keyed.join(asked, "key").select("key", F.explode(near).alias("x")).select("key", "x.*").distinct()
    met = around.join(broadcast_if_small(windows), ["length", "window"])
    covered = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s.start, s.start + s.length - 1)))
    )
    found = (
        met.groupBy("key")
        .agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("item").alias("items"))
        .select("key", F.size(covered).cast("long").alias("n_hit"), F.sort_array(F.col("items").cast("array<string>")).alias("items"))
    )
    key, n, hit, ids = (fresh(x) for x in ("key", "n", "hit", "items"))
    joined = docs.withColumn(key, row_key(F.col(id_col), F.col(text))).withColumn(n, F.size(words_of(F.col(text))).cast("long"))
    joined = joined.join(found.select(F.col("key").alias(key), F.col("n_hit").alias(hit), F.col("items").alias(ids)), key, "left")
    n_hit = F.coalesce(hit, F.lit(0).cast("long"))
    return joined.select(
        *(F.col(c) for c in docs.columns if c != into),
        F.struct(
            F.col(n).alias("n_words"),
            n_hit.alias("n_hit"),
            F.coalesce(ids, F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col(n))).alias("contaminated"),
        ).alias(into),
    )
