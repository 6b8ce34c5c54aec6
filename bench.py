"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

The given tables are one file with one row group each, which one task reads. They are first written out
as one file a core, as a cluster's tables are many files; that is not part of the times.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from mailloom.runtime import build_session
from workloads import catalog

HEADLINE = (
    "participants",
    "address_stats",
    "address_history",
    "weighted_edges",
    "node_index",
    "undirected_edges",
    "address_table",
    "email_communities",
    "weekly_activity",
    "message_rows",
    "attachment_text",
    "sidecar_merge_chain",
    "attachment_rows",
    "term_counts",
    "vocabulary",
    "term_matrix",
    "trigram_vectors",
    "body_language",
    "lexicon_translation",
    "punctuation_tokens",
    "gazetteer_matches",
    "spam_filter",
    "phone_numbers",
    "card_numbers",
    "numbers_on_email",
    "currency_entities",
    "email_locations",
    "latest_by_id",
    "nested_attachments",
    "attachment_export",
    "topic_terms",
    "translation_routing",
    "entity_routing",
    "place_mentions",
    "attachment_language",
)


def dealt_out(spark: SparkSession, sf_dir: str, files: int) -> str:
    """A copy of the tables in `files` files each."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        spark.read.parquet(path).repartition(files).write.parquet(f"{folder}/{os.path.basename(path)}")
    return folder


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = dealt_out(spark, sf_dir, int(cpus))
    # one small run so that start-up does not count against the first query
    catalog.QUERIES["address_stats"](spark, tables).limit(1).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        # every row and column is computed, nothing is stored
        catalog.QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or list(HEADLINE))
