"""Index-style projections and queries over the mail, address and attachment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from mailloom.schemas import INDEX_SCHEMAS

# fixed value: matching attachments shown per address unless asked otherwise
INNER_HITS = 3

# beyond this Spark no longer limits a window before its shuffle
_WINDOW_LIMIT = 1000
_SALTS = 256


def latest_by_id(df: DataFrame, key: str, version: Column) -> DataFrame:
    """One row per key, the one with the highest version; copies of a key combine map-side."""
    newest = F.max_by(F.struct(*df.columns), version).alias("row")
    return df.groupBy(F.col(key).alias("_key")).agg(newest).select("row.*")


def to_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Project to an index table: known columns cast to their types, missing ones null."""
    target = INDEX_SCHEMAS[schema] if isinstance(schema, str) else schema
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def all_addresses() -> Column:
    """Every address of a mail, once: senders, tos, delivered_to, ccs, bccs."""
    none = F.array().cast("array<string>")
    lists = ("senders", "tos", "delivered_to", "ccs", "bccs")
    return F.array_distinct(F.concat(*[F.coalesce(F.col(c), none) for c in lists]))


def addresses_with_extension(files: DataFrame, extension: str) -> DataFrame:
    """(addr) of senders with at least one attachment of the extension.

    `files` is the row form of sender_attachments.
    """
    return files.where(F.col("extension") == extension).select("addr").distinct()


def files_of_history(history: DataFrame) -> DataFrame:
    """Row form of the stored `address_history`: (addr, email_id, datetime, attachment fields), what the queries
    by extension, by address and the export read."""
    rows = history.select("addr", F.explode("sender_attachments").alias("a"))
    return rows.select("addr", "a.*")


def attachments_of(
    files: DataFrame,
    addr: str | None = None,
    extension: str | None = None,
    dates: tuple[str, str] | None = None,
    limit: int | None = INNER_HITS,
) -> DataFrame:
    """Matching attachments, at most `limit` per address, oldest first.

    Dates are inclusive. Only the first `limit` rows of each task's share of an address travel.
    """
    rows = files
    if addr is not None:
        rows = rows.where(F.col("addr") == addr)
    if extension is not None:
        rows = rows.where(F.col("extension") == extension)
    if dates is not None:
        rows = rows.where(F.col("datetime").between(*[F.lit(d).cast("timestamp") for d in dates]))
    if limit is None:
        return rows
    if limit >= _WINDOW_LIMIT:
        rows = below_bound(rows, limit)
    return _first(rows, limit, "addr").drop("_place")


def _first(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    order = (F.col("datetime").asc_nulls_last(), "guid")
    place = F.row_number().over(W.Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= limit)


def below_bound(rows: DataFrame, limit: int) -> DataFrame:
    """Rows that may be among the first `limit` of their address: about twice as many, however many it has.

    Each address is cut into slices, and each slice keeps its first `limit` rows. Every `step`-th row of a
    slice says that `step` rows are not above it, so enough of these, in order, bound the last row asked
    for. Rows above the bound are dropped in their slices, before the slices meet.
    """
    step = max(1, limit // _SALTS)
    key = F.struct(F.col("datetime").isNull(), "datetime", "guid")
    sliced = _first(rows.withColumn("_salt", F.pmod(F.xxhash64("guid"), F.lit(_SALTS)).cast("int")), limit, "addr", "_salt")
    marks = sliced.where(F.col("_place") % step == 0).select("addr", key.alias("_bound"))
    counted = marks.withColumn("_rows", F.row_number().over(W.Window.partitionBy("addr").orderBy("_bound")) * step)
    bounds = counted.where(F.col("_rows") >= limit).groupBy("addr").agg(F.min("_bound").alias("_bound"))
    # a bound for each slice: rows are already dealt out by address and slice
    spread = bounds.select("addr", "_bound", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
    kept = sliced.join(spread, ["addr", "_salt"], "left").where(F.col("_bound").isNull() | (key <= F.col("_bound")))
    return kept.drop("_salt", "_place", "_bound")


def with_bodies(files: DataFrame, contents: DataFrame) -> DataFrame:
    """Chosen attachment rows with their `contents64`, fetched from the store by digest."""
    return files.join(contents.select("content_hash", "contents64"), "content_hash")


def export_rows(found: DataFrame, attachments: DataFrame) -> DataFrame:
    """(addr, guid, filename, datetime, data): the hits with their binaries fetched by guid."""
    data = attachments.select("guid", F.unbase64("contents64").alias("data"))
    return found.select("addr", "guid", "filename", "datetime").join(data, "guid")


def emails_by_id(emails: DataFrame, ids: DataFrame) -> DataFrame:
    return emails.join(ids.select("id"), "id", "left_semi")


def attachments_by_email(attachments: DataFrame, ids: DataFrame) -> DataFrame:
    """Attachment rows of the chosen mails."""
    return attachments.join(ids.select("id"), "id", "left_semi")


def attachments_by_guid(attachments: DataFrame, guids: DataFrame) -> DataFrame:
    """(guid, filename, data) of the attachments found; unknown guids are skipped."""
    found = attachments.join(guids.select("guid"), "guid", "left_semi")
    return found.select("guid", "filename", F.unbase64("contents64").alias("data"))


def require_rows(df: DataFrame, what: str = "stage output") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
