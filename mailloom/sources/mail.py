"""Mail archives and loose files as raw message tables."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.functions.cleaning import path_categories
from mailloom.sources.records import base_name

# fixed values: extensions a file corpus leaves out
SKIPPED_EXTENSIONS = ("mdb", "msg", "exe", "zip", "gz", "dat")
UNKNOWN_TYPE = "application/octet-stream"


def _plain(path: Column) -> Column:
    """A file URI as a plain path."""
    return F.regexp_replace(F.url_decode(path), r"^file:/+", "/")


def _below(path: Column, root: str) -> Column:
    """A path relative to the folder that was read."""
    prefix = "/" + root.rstrip("/").removeprefix("file:").lstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)


def _folder(relative: Column) -> Column:
    return path_categories(F.regexp_replace(relative, r"[^/]*$", ""))


def read_mbox(spark: SparkSession, root: str) -> DataFrame:
    """(id, path, data, categories) per message of every file whose name ends in mbox.

    The text reader splits large archives at message separators, so one archive is read by many
    tasks. Each row starts with the rest of its separator line, which is cut off here. An id comes from
    the path and the bytes of the message, however the archive is split; a message that an archive
    holds twice has one id.
    """
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*mbox")
        .option("lineSep", "\nFrom ")
        .text(root)
    )
    path = _plain(F.col("_metadata.file_path"))
    # bytes after the first line; the text column holds the file's bytes as they are
    data = F.expr("substring(cast(value AS binary), octet_length(substring_index(value, '\\n', 1)) + 2)")
    return rows.select(
        F.md5(F.concat_ws("|", path, F.sha2(data, 256))).alias("id"),
        path.alias("path"),
        data.alias("data"),
        _folder(_below(path, root)).alias("categories"),
    ).where(F.octet_length("data") > 0)


def read_eml(spark: SparkSession, root: str, suffix: str = "_mime.txt") -> DataFrame:
    """(id, path, data, categories) per file that ends in .eml or the suffix; none is an error."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*{.eml," + suffix + "}")
        .load(root)
    )
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no .eml or {suffix} files under {root}")
    path = _plain(F.col("path"))
    return files.select(
        F.md5(path).alias("id"),
        path.alias("path"),
        F.col("content").alias("data"),
        _folder(_below(path, root)).alias("categories"),
    )


def guess_type(extension: Column) -> Column:
    """Content type by extension without a dot."""
    known = sorted((ext.lstrip("."), kind) for ext, kind in mimetypes.types_map.items())
    table = F.map_from_arrays(
        F.array(*[F.lit(ext) for ext, _ in known]), F.array(*[F.lit(kind) for _, kind in known])
    )
    return F.coalesce(F.try_element_at(table, extension), F.lit(UNKNOWN_TYPE))


def _corpus(spark: SparkSession, root: str, max_bytes: int | None) -> tuple[DataFrame, Column, Column]:
    """Files, their extension, and why a file is left out (null if it is not)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    extension = F.lower(F.regexp_extract(base_name(_plain(F.col("path"))), r"[^.]\.([^.]*)$", 1))
    reason = F.when(extension.isin(*SKIPPED_EXTENSIONS), F.lit("extension"))
    if max_bytes is not None:
        reason = reason.when(F.col("length") > max_bytes, F.lit("size"))
    return files, extension, reason


def skipped_files(spark: SparkSession, root: str, max_bytes: int | None = None) -> DataFrame:
    """(path, length, reason) of the files that `read_files` leaves out with the same limit."""
    files, _, reason = _corpus(spark, root, max_bytes)
    return files.select(_plain(F.col("path")).alias("path"), "length", reason.alias("reason")).where("reason IS NOT NULL")


def read_files(spark: SparkSession, root: str, owner: str = "unknown", max_bytes: int | None = None) -> DataFrame:
    """Every file as a mail with one attachment: subject is its path, body is empty.

    Files of certain extensions and, where a limit is given, larger ones are left out; see `skipped_files`.
    """
    files, extension, reason = _corpus(spark, root, max_bytes)
    path = _plain(F.col("path"))
    name = base_name(path)
    none = F.array().cast("array<string>")
    attachment = F.struct(
        F.md5(F.concat(path, F.lit("/0"))).alias("guid"),
        extension.alias("extension"),
        name.alias("filename"),
        F.col("length").alias("filesize"),
        guess_type(extension).alias("content_type"),
        F.base64("content").alias("contents64"),
        F.col("modificationTime").alias("modified"),
    )
    return files.where(reason.isNull()).select(
        F.md5(path).alias("id"),
        F.col("modificationTime").alias("datetime"),
        F.array(F.lit(owner)).alias("senders"),
        F.array(F.lit(owner)).alias("senders_line"),
        F.array(F.lit("none")).alias("tos"),
        F.array(F.lit("none")).alias("tos_line"),
        *[none.alias(c) for c in ("ccs", "ccs_line", "bccs", "bccs_line")],
        F.array(attachment).alias("attachments"),
        _below(path, root).alias("subject"),
        F.lit("").alias("body"),
    )
