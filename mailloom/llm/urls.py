"""URL rules: host suffixes and path prefixes of a URL looked up among rules by short digests.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path starts with its own.
Each URL is expanded into the suffixes of its host at label borders and the prefixes of its path at
slashes, no longer than the longest rule has. Expressions meet rules in an equality join on the first
`PREFIX` hex digits of their SHA-256; the whole digest and the rest of the path are then confirmed.
Among fitting rules the longest text wins, then the longer host, then block before allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.llm.shared import ascii_lower, broadcast_if_small, fresh, row_key

PREFIX = 8
RULES = "host string, path string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null and for a text without `://`."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """All columns of `pages` and a struct `judged` <host, path, rule, verdict>.

    `rule` is host and path of the winning rule, null where none fits; the verdict is then `default`.
    Rules with a null part are ignored, repeated ones count once. Repeated pages are each judged.
    """
    usable = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), "verdict").dropna()
    usable = usable.distinct()
    base = F.regexp_extract("r_path", r"(?s)^.*/", 0)  # the part that is also a prefix at a slash
    keyed = usable.withColumn("digest", F.sha2(F.concat("r_host", base), 256)).withColumn(
        "short", F.left("digest", F.lit(PREFIX))
    )
    longest = usable.agg(
        F.coalesce(F.max(F.size(F.split("r_host", r"\."))), F.lit(0)).alias("labels"),
        F.coalesce(F.max(F.size(F.split("r_path", "/"))), F.lit(0)).alias("slashes"),
    ).first()
    out, key = fresh("judged"), fresh("key")
    host, path = host_and_path(F.col(url))
    seen = pages.withColumn(out, F.struct(host.alias("host"), path.alias("path"))).withColumn(
        key, row_key(F.col(id_col), F.col(url))
    )
    labels, steps = F.split("host", r"\."), F.split("path", "/")
    n_labels = F.least(F.size(labels), F.lit(longest.labels))
    n_steps = F.least(F.size(steps), F.lit(longest.slashes)) - 1
    suffixes = F.when(
        n_labels > 0, F.transform(F.sequence(F.lit(1), n_labels), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    )
    prefixes = F.concat(
        F.array(F.lit("")),
        F.when(
            n_steps > 0,
            F.transform(
                F.sequence(F.lit(1), n_steps), lambda n: F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/"))
            ),
        ).otherwise(F.array().cast("array<string>")),
    )
    expressions = (
        seen.select(F.col(key).alias("key"), f"{out}.host", f"{out}.path")
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("digest", F.explode(F.transform(prefixes, lambda p: F.sha2(F.concat("suffix", p), 256))))
        .select("key", "path", "digest", F.left("digest", F.lit(PREFIX)).alias("short"))
    )
    hits = expressions.join(broadcast_if_small(keyed.withColumnRenamed("digest", "whole")), "short").where(
        (F.col("digest") == F.col("whole")) & F.col("path").startswith(F.col("r_path"))
    )
    rule = F.concat("r_host", "r_path")
    rank = F.struct(F.length(rule), F.length("r_host"), F.col("verdict") == "block", rule.alias("rule"), "verdict")
    best = hits.groupBy("key").agg(F.max(rank).alias("best"))
    found = fresh("best")
    joined = seen.join(best.select(F.col("key").alias(key), F.col("best").alias(found)), key, "left")
    return joined.select(
        *(F.col(c) for c in pages.columns if c != "judged"),
        F.struct(
            F.col(out).host.alias("host"),
            F.col(out).path.alias("path"),
            F.col(found).rule.alias("rule"),
            F.coalesce(F.col(found).verdict, F.lit(default)).alias("verdict"),
        ).alias("judged"),
    )
