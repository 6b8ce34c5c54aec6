"""Where results go: sized files, index tables, exports and attachment files."""

from __future__ import annotations

import os
import threading
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom import schemas
from mailloom.operators.index import attachments_by_email, emails_by_id, to_schema
from mailloom.runtime import checkpointed

# fixed value: output files roll over at this size unless asked otherwise
TARGET_MB = 10

# fixed values: the id of each index table; addresses and datasets have none
INDEX_KEYS = {"emails": "id", "attachments": "guid", "topics": "idx", "contents": "content_hash"}

#: a dataset's rows lie in this many buckets by the hash of their id; it must stay the same for a table's life
BUCKETS = 64
# columns that index files have beside those of the schema
_BUCKET, _VERSION = "_bucket", "_version"


def write_sized(df: DataFrame, path: str, target_mb: int = TARGET_MB, fmt: str = "json") -> None:
    """Write files of about `target_mb`: Spark rebalances partitions to that size first."""
    conf = df.sparkSession.conf
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = conf.get(name)
    conf.set(name, f"{target_mb}m")
    try:
        df.hint("rebalance").write.format(fmt).save(path)
    finally:
        conf.set(name, before)


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def create_index(df: DataFrame, root: str, table: str, version: Column | None = None) -> None:
    """First load of an index table; stops when the table is already there."""
    _write(_incoming(df, table, version), f"{root}/{table}", "errorifexists")


def write_index(df: DataFrame, root: str, table: str, version: Column | None = None) -> None:
    """Load rows into an index table; a row with an id already in its dataset replaces it, unless its
    `version` is lower.

    `version` is a number or a timestamp over the columns of `df`; without one the time of the load counts, so
    the last load wins. Only the buckets that hold an incoming id are read and written again; all other
    files of the table stay as they are. Tables without an id are added to.
    """
    spark = df.sparkSession
    path = f"{root}/{table}"
    rows = _incoming(df, table, version)
    key = INDEX_KEYS.get(table)
    if not exists(spark, path):
        _write(rows, path, "errorifexists")
    elif key is None:
        _write(rows, path, "append")
    else:
        rows = checkpointed(rows)
        stored = _stored(spark, path, rows)
        places = [c for c in ("ingest_id", _BUCKET) if c in rows.columns]
        touched = rows.select(*places).distinct()
        same = [stored[c].eqNullSafe(touched[c]) if c == "ingest_id" else stored[c] == touched[c] for c in places]
        condition = same[0]
        for more in same[1:]:
            condition = condition & more
        kept = stored.join(touched, condition, "left_semi")
        merged = checkpointed(merge_rows(kept.select(*rows.columns), rows, _keys(rows, key), _VERSION))
        _write(merged, path, "overwrite")


def merge_rows(stored: DataFrame, incoming: DataFrame, keys: list[str], version: str) -> DataFrame:
    """One row a key of two tables with the same columns: the one of the highest version.

    Nulls are the lowest version. Of equal versions incoming rows win over stored ones, and among rows of one
    side the largest as JSON text, so the result is the same however rows come. Copies combine map-side.
    """
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    columns = stored.columns
    row = F.struct(*columns)
    rank = F.struct(F.col(version).isNotNull(), version, "_new", F.to_json(row))
    grouped = both.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys))
    return grouped.agg(F.max_by(row, rank).alias("row")).select("row.*")


def _keys(rows: DataFrame, key: str) -> list[str]:
    return ["ingest_id", key] if "ingest_id" in rows.columns else [key]


def _incoming(df: DataFrame, table: str, version: Column | None = None) -> DataFrame:
    """Rows as they are stored: one a key, with their version and bucket."""
    key = INDEX_KEYS.get(table)
    if key is None:
        return to_schema(df, table)
    if version is None:
        version = F.current_timestamp()
    kind = df.select(version.alias("v")).schema["v"].dataType.typeName()
    number = F.unix_micros(version) if kind == "timestamp" else version.cast("bigint")
    schema = schemas.INDEX_SCHEMAS[table]
    typed = df.withColumn(_VERSION, number)
    own = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    rows = typed.select(*own, _VERSION)
    rows = rows.withColumn(_BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    return merge_rows(rows.limit(0), rows, _keys(rows, key), _VERSION)


def _write(rows: DataFrame, path: str, mode: str) -> None:
    places = [c for c in ("ingest_id", _BUCKET) if c in rows.columns]
    if _BUCKET in rows.columns:
        # a bucket is one task's work, a dataset `BUCKETS` of them
        rows = rows.repartition(*places)
    writer = rows.write.mode(mode)
    if places:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*places)
    writer.parquet(path)


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def read_index(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of an index table, without what the sink keeps beside them."""
    schema = schemas.INDEX_SCHEMAS[table]
    return spark.read.schema(schema).parquet(f"{root}/{table}").select(*schema.fieldNames())


def register_dataset(
    spark: SparkSession, root: str, ingest_id: str, case_id: str, alt_ref_id: str, label: str
) -> None:
    row = spark.createDataFrame([(ingest_id, case_id, alt_ref_id, label)], schemas.DATASET)
    row.write.mode("append").partitionBy("ingest_id").parquet(f"{root}/datasets")


def purge(spark: SparkSession, root: str, ingest_id: str) -> None:
    """Remove one dataset from every index table."""
    for table in schemas.INDEX_SCHEMAS:
        fs, folder = _folder(spark, f"{root}/{table}/ingest_id={ingest_id}")
        if fs.exists(folder):
            fs.delete(folder, True)


def export_json(spark: SparkSession, root: str, table: str, path: str, ingest_id: str | None = None) -> None:
    rows = read_index(spark, root, table)
    if ingest_id is not None:
        rows = rows.where(F.col("ingest_id") == ingest_id)
    rows.write.json(path)


def import_json(spark: SparkSession, path: str, root: str, table: str) -> None:
    write_index(spark.read.schema(schemas.INDEX_SCHEMAS[table]).json(path), root, table)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path)


def export_edges(edges: DataFrame, folder: str) -> None:
    """Edge rows (from, to) as JSON lines, and from those as CSV."""
    edges.write.json(f"{folder}/json")
    spark = edges.sparkSession
    export_csv(spark.read.schema(edges.schema).json(f"{folder}/json"), f"{folder}/csv")


def export_attachments(found: DataFrame, folder: str) -> None:
    """Attachment hits (addr, guid, filename, datetime, extension, contents64): a CSV and the files."""
    export_csv(found.select("addr", "guid", "filename", "datetime"), f"{folder}/attachments")
    dump_attachments(found.dropDuplicates(["guid"]), f"{folder}/files")


def export_emails(emails: DataFrame, attachments: DataFrame, ids: DataFrame, folder: str) -> None:
    """The chosen mails as JSON lines, and the files attached to them."""
    emails_by_id(emails, ids).write.json(f"{folder}/emails")
    dump_attachments(attachments_by_email(attachments, ids), f"{folder}/files")


def dump_attachments(attachments: DataFrame, folder: str) -> None:
    """Write every decoded attachment to <folder>/<guid><extension>, on any shared file system."""
    rows = attachments.select("guid", "extension", F.unbase64("contents64").alias("data"))

    def save(partition: Iterator) -> None:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(base, recursive=True)
        for row in partition:
            name = f"{base}/{row.guid}{row.extension or ''}"
            # a retried or speculative task must never leave half a file under the final name
            part = f"{name}.{os.getpid()}.{threading.get_ident()}.part"
            with system.open_output_stream(part) as out:
                out.write(bytes(row.data or b""))
            system.move(part, name)

    rows.foreachPartition(save)
