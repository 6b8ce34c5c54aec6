"""Near-duplicate documents by MinHash with tensored banding, confirmed on the full shingle sets.

A document has `collections` small collections of `ROWS` minhashes. A table key is a pair of
collections, so 16 collections give 120 tables of six minhashes each from 48 instead of 720 hash
functions. Two documents meet if any two of their collections agree; the number of collections is
chosen so that a pair at the similarity asked for is missed with a chance of at most `MISS`, and
closer pairs far less often.

Equal sets count once. Only collections that another set shares make keys. The sets of a bucket are
joined in a star, which gives candidate groups without a row per pair; inside a group all pairs are
decided exactly by products of 0/1 matrices over the shared shingles, in blocks of bounded size, and
only links that join two parts are returned. A group of n sets costs n * n / 2 cells of a matrix
product, about 1e-8 seconds each, spread over blocks of `BLOCK` sets; groups of equal sets cost one.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.shared import components, fresh, row_key, stored
from mailloom.llm.words import gram_hashes, mixed, word_hashes

ROWS = 3
MISS = 1e-5
BLOCK = 400
#: candidate sets in one task of small groups
SLOT = 1500
COLUMNS = 4096


def collections_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Fewest collections of which two agree with a chance of 1 - `miss` at this similarity."""
    p = similarity**rows
    m = 2
    while (1 - p) ** m + comb(m, 1) * p * (1 - p) ** (m - 1) > miss:
        m += 1
    return m


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` words, A-Z in lower case.

    Fewer words make one run of all of them; none make an empty set.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(width, len(words))))


def signatures(width: int, many: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mixed(np.arange(2 * many * rows, dtype=np.uint64), 7)
        flip, factor = seeds[: many * rows, None], seeds[many * rows :, None] | np.uint64(1)
        for batch in batches:
            sets, sizes, found = [], [], []
            for text in batch.column(2).to_pylist():
                h = shingle_hashes(text, width)
                sizes.append(len(h))
                if not len(h):
                    sets.append(None)
                    found.append(None)
                    continue
                digest = (mixed(h, 1).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(h, 2)))
                sets.append(b"".join(int(x).to_bytes(8, "big") for x in digest))
                least = np.full((many * rows, 1), np.uint64(2**64 - 1))
                for start in range(0, len(h), COLUMNS):
                    part = ((h[None, start : start + COLUMNS] ^ flip) * factor).min(axis=1, keepdims=True)
                    least = np.minimum(least, part)
                least = least.reshape(many, rows)
                value = least[:, 0]
                for i in range(1, rows):
                    value = mixed(value, i) + least[:, i]
                found.append(mixed(value).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sets, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["key", "id", "set", "size", "found"],
            )

    return run


def shingles_of(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [shingle_hashes(text, width).tobytes() for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["grp", "set", "shingles"]
            )

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products over the shingles that two sets or more have."""
    n = len(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    use = df[column] > 1
    order = np.cumsum(df > 1) - 1
    rows, column = rows[use], order[column[use]]
    by_column = np.argsort(column, kind="stable")
    rows, column = rows[by_column], column[by_column]
    total = np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        block = np.zeros((n, min(COLUMNS, width - start)), np.float32)
        block[rows[low:high], column[low:high] - start] = 1
        total += block @ block.T
    return total


def joining_links(sets: list[np.ndarray], part: int, whole: int) -> list[tuple[int, int]]:
    """A spanning forest of the links part * union <= whole * intersection."""
    both = shared_counts(sets)
    size = np.array([len(s) for s in sets])
    union = size[:, None] + size[None, :] - both
    a, b = np.nonzero(np.triu(whole * both >= part * union, 1))
    parent = list(range(len(sets)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        i, j = top(x), top(y)
        if i != j:
            parent[max(i, j)] = min(i, j)
            out.append((x, y))
    return out


def confirm(part: int, whole: int):
    def run(slot: pa.Table) -> pa.Table:
        groups: dict[bytes, dict[bytes, bytes]] = {}
        for grp, name, data in zip(*(slot[c].to_pylist() for c in ("grp", "set", "shingles")), strict=True):
            groups.setdefault(grp, {})[name] = data
        left, right = [], []
        for members in groups.values():
            names = sorted(members)
            for i, j in joining_links([np.frombuffer(members[x], np.uint64) for x in names], part, whole):
                left.append(names[i])
                right.append(names[j])
        return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary())})

    return run


def candidate_groups(sets: DataFrame) -> DataFrame:
    """(set, grp): sets that meet in a table, directly or through others."""
    each = sets.select("set", F.posexplode("found").alias("place", "value"))
    common = each.groupBy("place", "value").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    shared = each.join(common, ["place", "value"]).groupBy("set").agg(
        F.sort_array(F.collect_list(F.struct("place", "value"))).alias("have")
    )
    pairs = F.flatten(
        F.transform(
            "have",
            lambda x, i: F.transform(F.slice("have", i + 2, F.size("have")), lambda y: F.xxhash64(x, y)),
        )
    )
    keys = stored(shared.where(F.size("have") > 1).select("set", F.explode(pairs).alias("table_key")))
    buckets = keys.groupBy("table_key").agg(F.min("set").alias("leader"), F.count("*").alias("n")).where("n > 1")
    edges = keys.join(buckets, "table_key").where(F.col("set") != F.col("leader"))
    # a set has at most as many leaders as there are tables; all of them join its smallest leader, and
    # sets with the same leaders then share those edges
    led = edges.groupBy("set").agg(F.collect_set("leader").alias("leaders"))
    least = F.array_min("leaders")
    starred = led.select(least.alias("leader"), F.explode(F.concat(F.array("set"), "leaders")).alias("set"))
    edges = starred.where(F.col("set") != F.col("leader")).distinct()
    return components(edges, "set", "leader").select(F.col("node").alias("set"), F.col("component").alias("grp"))


def confirmed_links(keyed: DataFrame, sets: DataFrame, width: int, part: int, whole: int) -> DataFrame:
    """(a, b): links between different sets that connect whatever is linked."""
    groups = stored(candidate_groups(sets))
    sizes = groups.groupBy("grp").agg(F.count("*").alias("members"))
    wanted = groups.join(sizes, "grp").join(sets.select("set", "key"), "set")
    texts = keyed.join(wanted.select("key", "grp", "set"), "key").select("grp", "set", "text")
    data = texts.mapInArrow(shingles_of(width), "grp binary, set binary, shingles binary")
    slots = groups.count() // SLOT + 1
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    small = F.array(F.concat(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(slots)).cast("string")))
    blocks = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda x: F.concat_ws("/", F.hex("grp"), F.least(x, "own"), F.greatest(x, "own")),
    )
    placed = (
        data.join(sizes, "grp")
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("slot", F.explode(F.when(F.col("parts") > 1, blocks).otherwise(small)))
    )
    return placed.select("slot", "grp", "set", "shingles").groupBy("slot").applyInArrow(
        confirm(part, whole), "a binary, b binary"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = 3,
    part: int = 85,
    whole: int = 100,
) -> DataFrame:
    """(key, size, component_id, first): a row for each distinct id and text.

    `key` is `row_key` of the row, `size` the number of distinct shingles, `component_id` the smallest
    id that the document reaches over links of similarity part / whole or more. A null or empty text is
    linked with nothing. A null id counts as larger than all others; `component_id` is null only where no member
    has an id. `first` marks the one key that stands for its component: of smallest id, then key.
    """
    keyed = docs.select(
        row_key(F.col(id_col), F.col(text)).alias("key"), F.col(id_col).alias("id"), F.col(text).alias("text")
    )
    many = collections_for(part / whole)
    signed = stored(
        keyed.mapInArrow(
            signatures(width, many, ROWS),
            f"key binary, id {docs.schema[id_col].dataType.simpleString()}, set binary, size long, found array<long>",
        )
    )
    rows = signed.drop("found").distinct()
    sets = stored(
        signed.where("set IS NOT NULL").groupBy("set").agg(F.min("key").alias("key"), F.first("found").alias("found"))
    )
    labels = components(stored(confirmed_links(keyed, sets, width, part, whole)))
    # of each set the smallest member, then of each component
    member = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    by_set = rows.where("set IS NOT NULL").groupBy("set").agg(F.min(member).alias("best"))
    labelled = by_set.join(labels.withColumnRenamed("node", "set"), "set", "left").select(
        "set", "best", F.coalesce("component", "set").alias("component")
    )
    heads = labelled.groupBy("component").agg(F.min("best").alias("head"))
    of_set = labelled.join(heads, "component").select("set", "head")
    alone = F.col("set").isNull()
    return rows.join(of_set, "set", "left").select(
        "key",
        "id",
        "size",
        F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        (alone | (F.col("head.key") == F.col("key"))).alias("first"),
    )


def mark_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = 3,
    part: int = 85,
    whole: int = 100,
) -> DataFrame:
    """(id column, n_shingles, component_id, kept) with as many rows as `docs` has; see `near_duplicates`."""
    found = near_duplicates(docs, id_col, text, width, part, whole)
    key = row_key(F.col(id_col), F.col(text)).alias("key")
    return (
        docs.select(key)
        .join(found, "key")
        .select(
            F.col("id").alias(id_col),
            F.col("size").alias("n_shingles"),
            "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
        )
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = 5,
    part: int = 80,
    whole: int = 100,
) -> DataFrame:
    """The rows of `docs` without near-duplicates: one row of each component, of repeated rows one."""
    key, place = fresh("key"), fresh("place")
    first = near_duplicates(docs, id_col, text, width, part, whole).where("first").select(F.col("key").alias(key))
    kept = docs.withColumn(key, row_key(F.col(id_col), F.col(text))).join(first, key)
    order = Window.partitionBy(key).orderBy(F.lit(1))
    return kept.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*docs.columns)
