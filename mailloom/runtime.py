"""Session defaults and the few run-time decisions operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # messages may be tens of megabytes; keep the batches sent to Python workers small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(app: str = "mailloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a scratch one only for local runs."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    scratch = tempfile.mkdtemp(prefix="mailloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def written(df: DataFrame) -> str:
    """The path of the rows, written to the checkpoint folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/mailloom/{uuid.uuid4().hex}"
    # these tables are read a few times at most, and disks hold many of them
    df.write.option("compression", "zstd").parquet(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing the rows to the checkpoint folder and reading them back.

    A written table survives lost executors like `checkpoint()`, and unlike it the next plan sees
    the real size: a checkpointed frame keeps the estimate of the plan it came from, which after
    some rounds of joins is too large to be of use.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df))


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a lookup whose size is limited by its meaning; refuses anything larger."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows")
    return rows
