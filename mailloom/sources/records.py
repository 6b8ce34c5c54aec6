"""Line-based records: mail as JSON lines, keyed sidecars, manifests, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom import schemas


def read_emails(spark: SparkSession, path: str, schema: T.StructType = schemas.EMAIL) -> DataFrame:
    """Mail table from JSON lines."""
    return spark.read.schema(schema).json(path)


def split_valid(lines: DataFrame, enabled: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of (value) rows; bad rows carry an `error`. Disabled, everything is good."""
    valid = F.expr("try_parse_json(value) IS NOT NULL") if enabled else F.lit(True)
    bad = lines.where(~valid).withColumn("error", F.lit("not a JSON record"))
    return lines.where(valid), bad


def read_valid_emails(
    spark: SparkSession, path: str, schema: T.StructType = schemas.EMAIL
) -> tuple[DataFrame, DataFrame]:
    """(emails, rejected lines) of a JSON-lines path."""
    good, bad = split_valid(spark.read.text(path))
    return parse_json(good, schema), bad


def parse_json(lines: DataFrame, schema: T.StructType) -> DataFrame:
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def _halves() -> tuple[Column, Column]:
    """Key and rest of a line, cut at its first tab."""
    key = F.substring_index("value", "\t", 1)
    return key, F.substr(F.col("value"), F.length(key) + 2)


def split_sidecar(lines: DataFrame, kind: T.DataType = schemas.TEXT_SIDECAR) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of `id <tab> json-array` lines: (id, attachments), and (value, error) of broken ones."""
    key, rest = _halves()
    rows = lines.select("value", key.alias("id"), rest.alias("json"))
    valid = F.expr("try_parse_json(json) IS NOT NULL")
    bad = rows.where(~valid).select("value", F.lit("not a JSON record").alias("error"))
    # a generator, since a filter would be moved under the line's own expressions and these computed again for it
    read = F.when(valid, F.array(F.struct("id", F.from_json("json", kind).alias("attachments"))))
    return rows.select(F.inline_outer(read)).where("id IS NOT NULL"), bad


def parse_sidecar(lines: DataFrame, kind: T.DataType = schemas.TEXT_SIDECAR) -> DataFrame:
    """(id, attachments) of the good lines; `split_sidecar` also gives the broken ones."""
    return split_sidecar(lines, kind)[0]


def parse_scores(lines: DataFrame) -> DataFrame:
    """(id, scores) of `id <tab> space-separated doubles` lines."""
    key, rest = _halves()
    numbers = F.filter(F.split(rest, " "), lambda s: s != "")
    return lines.select(
        key.alias("id"), F.transform(numbers, lambda s: s.cast("double")).alias("scores")
    )


def parse_vocabulary(lines: DataFrame) -> DataFrame:
    """(idx, term) of `idx <tab> term` lines."""
    key, rest = _halves()
    return lines.select(key.cast("bigint").alias("idx"), rest.alias("term"))


def read_sidecar(spark: SparkSession, path: str, kind: str = "text") -> DataFrame:
    """A keyed sidecar file: kind is text, image, scores or vocabulary."""
    lines = spark.read.text(path)
    if kind == "scores":
        return parse_scores(lines)
    if kind == "vocabulary":
        return parse_vocabulary(lines)
    return parse_sidecar(lines, schemas.IMAGE_SIDECAR if kind == "image" else schemas.TEXT_SIDECAR)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stamp(
    df: DataFrame,
    ingest_id: str | Column,
    case_id: str | Column,
    alt_ref_id: str | Column,
    label: str | Column,
    filename: Column | None = None,
    kind: str | Column | None = None,
) -> DataFrame:
    """Add provenance; `filename` and `kind` (mbox, eml, msg or files) make the original artifact."""

    def value(v: str | Column | None) -> Column:
        return v if isinstance(v, Column) else F.lit(v).cast("string")

    out = df.withColumns(
        {
            "ingest_id": value(ingest_id),
            "case_id": value(case_id),
            "alt_ref_id": value(alt_ref_id),
            "label": value(label),
        }
    )
    if filename is None and kind is None:
        return out
    artifact = F.struct(value(filename).alias("filename"), value(kind).alias("type"))
    return out.withColumn("original_artifact", artifact)


MANIFEST = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("filename", "ingest_id", "case_id", "alt_ref_id", "label", "language", "type")
    ]
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).csv(path)


def stamp_from_manifest(raw: DataFrame, manifest: DataFrame) -> DataFrame:
    """Stamp rows that carry `filename` from the manifest row of that file; others drop out."""
    listed = manifest.withColumn("filename", base_name(F.col("filename")))
    rows = raw.join(listed.withColumnRenamed("type", "_type"), "filename")
    stamped = rows.withColumn(
        "original_artifact", F.struct("filename", F.col("_type").alias("type"))
    )
    return stamped.drop("_type")
