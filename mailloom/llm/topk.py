"""Exact top-k by integer inner product over buckets of vectors of like length.

Vectors are grouped by length (a step is a tenth) and, within a length, spread over buckets of at
most about `BUCKET` vectors. A first pass over the longest bucket gives every query a score that its
k-th result reaches at least. With it a query skips all buckets whose longest vector is too short,
and in a bucket the cosine it needs decides: a high one narrows the candidates by the range that the
query's strongest coordinate leaves them, a low one only by their length. What is left is multiplied
out. Bounds are widened by rounding errors, so nothing that could belong to the result is skipped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.shared import stored
from mailloom.runtime import bounded_rows

BUCKET, LEAST_BUCKET, SPREAD = 8192, 512, 64
QUERY_BLOCK = 4096
LENGTH_STEP = 0.9
#: from this cosine on, coordinates prune better than a product over the whole bucket
COORDINATE_COSINE = 0.7
MAX_LENGTHS = 20_000
FOUND = "query_id long, vec_id long, score long"


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double; null for vectors with a null or non-finite one."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    return F.when(finite & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """Rows of an Arrow list column as float64 where products stay exact in it, else as int64."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    whole = flat.reshape(rows, -1)
    most = int(np.abs(flat).max(initial=0))
    return whole.astype(np.float64) if whole.shape[1] * most * most < 2**52 else whole


def best_in(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; ids ascend."""
    if len(scores) <= k:
        return np.argsort(-scores, kind="stable")
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    level = np.flatnonzero(scores == least)[: k - len(above)]
    at = np.concatenate([above, level])
    return at[np.lexsort((ids[at], -scores[at]))]


def search_bucket(k: int):
    def run(key, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if candidates.num_rows and queries.num_rows:
            order = np.argsort(candidates["id"].to_numpy(), kind="stable")
            ids = candidates["id"].to_numpy()[order]
            rows = matrix(candidates["v"], len(ids))[order]
            asked = matrix(queries["q_v"], queries.num_rows)
            if rows.dtype != asked.dtype:
                rows, asked = rows.astype(np.int64), asked.astype(np.int64)
            q_ids, floor = queries["q_id"].to_numpy(), queries["least"].to_numpy()
            lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
            q_lengths = np.sqrt((asked.astype(np.float64) ** 2).sum(axis=1))
            unit = rows / np.maximum(lengths, 1e-300)[:, None]
            for start in range(0, len(q_ids), 256):
                part = slice(start, start + 256)
                needed = floor[part] / np.maximum(q_lengths[part] * lengths.max(initial=0.0), 1e-300)
                together = np.flatnonzero(needed < COORDINATE_COSINE)
                if len(together):
                    # the shortest length that any of these queries can use
                    least = (floor[part][together] / np.maximum(q_lengths[part][together], 1e-300)).min()
                    use = np.flatnonzero(lengths >= least * (1 - 1e-9) - 1e-9)
                    products = asked[part][together] @ rows[use].T
                    for i, scores in zip(together, products, strict=True):
                        keep(out, q_ids[start + i], floor[start + i], ids[use], scores, k)
                for i in np.flatnonzero(needed >= COORDINATE_COSINE):
                    if needed[i] > 1 + 1e-9:
                        continue
                    q = asked[start + i]
                    focus = int(np.argmax(np.abs(q)))
                    own, cosine = q[focus] / q_lengths[start + i], min(needed[i], 1.0)
                    reach = math.sqrt(max(0.0, (1 - cosine**2) * (1 - own**2)))
                    near = unit[:, focus] * math.copysign(1, own)
                    low = abs(own) * cosine - reach
                    high = 1.0 if abs(own) >= cosine else abs(own) * cosine + reach
                    use = np.flatnonzero((near >= low - 1e-9) & (near <= high + 1e-9))
                    keep(out, q_ids[start + i], floor[start + i], ids[use], rows[use] @ q, k)
        columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    return run


def keep(out: list, query: int, floor: float, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    allowed = np.flatnonzero((scores >= floor) & (ids != query))
    if len(allowed):
        at = allowed[best_in(scores[allowed], ids[allowed], k)]
        out.append((np.full(len(at), query, np.int64), ids[at], scores[at].astype(np.int64)))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of highest score for each query, ties to the smaller id.

    Candidates are all rows with another id than the query's. Vectors that are null, empty or hold a
    null or non-finite component, and rows without an id, take no part. A row repeated with id and vector is as many
    candidates but one query; of its copies the k that can be ranked are kept. Only vectors of the same number of
    components meet.
    """
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = stored(
        vectors.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector), scale).alias("v"), is_query.alias("asks"))
        .dropna(subset=["id", "v"])
        .groupBy("id", "v", "asks")
        .agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .drop("copies")
        .withColumn("length", length)
        .withColumn("dim", F.size("v"))
        .withColumn("class", F.when(F.col("length") >= 1, F.floor(F.log("length") / -math.log(LENGTH_STEP))).otherwise(-1))
    )
    classes = bounded_rows(
        rows.groupBy("dim", "class").agg(F.count("*").alias("n"), F.max("length").alias("most"), F.sum(F.col("asks").cast("long")).alias("asked")),
        MAX_LENGTHS,
        "lengths of vectors",
    )
    if not classes:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    buckets, blocks = [], {}
    for r in classes:
        parts = max(math.ceil(r.n / BUCKET), min(SPREAD, math.ceil(r.n / LEAST_BUCKET)))
        buckets.append((r.dim, r["class"], parts, r.most))
        blocks[r.dim] = blocks.get(r.dim, 0) + (r.asked or 0)
    spark = rows.sparkSession
    sizes = spark.createDataFrame(
        [(*b, max(1, math.ceil(blocks[b[0]] / QUERY_BLOCK))) for b in buckets],
        "dim int, class long, parts int, most double, blocks int",
    )
    placed = rows.join(F.broadcast(sizes), ["dim", "class"]).withColumn(
        "bucket", F.concat_ws("/", "dim", "class", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")))
    )
    longest = {}
    for dim, cls, _, most in buckets:
        longest[dim] = max(longest.get(dim, (-1.0, None)), (most, cls))
    listed = spark.createDataFrame(
        [(dim, f"{dim}/{cls}/{part}", most, part == 0 and cls == longest[dim][1]) for dim, cls, parts, most in buckets for part in range(parts)],
        "dim int, bucket string, most double, first boolean",
    )
    queries = placed.where("asks AND copy = 1").select("dim", "id", "v", "length", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).alias("block"))
    candidates = placed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))

    def found(asked: DataFrame) -> DataFrame:
        left = candidates.select("bucket", "block", "id", "v").groupBy("bucket", "block")
        renamed = [F.col(c).alias(f"q_{c}") for c in ("bucket", "block", "id", "v")]
        right = asked.select(*renamed, F.col("least").cast("double").alias("least")).groupBy("q_bucket", "q_block")
        return left.cogroup(right).applyInArrow(search_bucket(k), FOUND)

    first = stored(
        found(queries.join(F.broadcast(listed.where("first")), "dim").withColumn("least", F.lit(-math.inf)))
    )
    floors = first.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count("*") >= k, F.min("score")).alias("least")
    )
    bound = queries.join(floors, "id", "left").withColumn("least", F.coalesce(F.col("least").cast("double"), F.lit(-math.inf)))
    rest = bound.join(F.broadcast(listed.where("NOT first")), "dim").where(
        F.col("length") * F.col("most") * (1 + 1e-9) + 1e-6 >= F.col("least")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(found(rest))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
