"""Weekly mail activity of one address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .addresses import all_recipients


def weekly_activity(
    emails: DataFrame, addr: str, start: str = "1970-01-01", end: str | None = None
) -> DataFrame:
    """(addr, week, sent, received) for every Monday week from start to end, zero when empty.

    `end` defaults to today; pass it to make a run repeatable.
    """
    last = F.to_date(F.lit(end)) if end else F.current_date()
    sent = F.array_contains("senders", addr)
    received = F.array_contains(all_recipients(), addr)
    seen = (
        emails.where(F.col("datetime").isNotNull())
        .select(
            F.to_date(F.date_trunc("week", "datetime")).alias("week"),
            F.coalesce(sent, F.lit(False)).alias("sent"),
            F.coalesce(received, F.lit(False)).alias("received"),
        )
        .where(F.col("sent") | F.col("received"))
        .groupBy("week")
        .agg(F.count_if("sent").alias("sent"), F.count_if("received").alias("received"))
    )
    weeks = emails.sparkSession.range(1).select(
        F.explode(
            F.sequence(
                F.to_date(F.date_trunc("week", F.to_date(F.lit(start)))),
                F.to_date(F.date_trunc("week", last)),
                F.expr("interval 7 days"),
            )
        ).alias("week")
    )
    # one row per calendar week, at most a few thousand on either side
    return weeks.join(seen, "week", "left").select(
        F.lit(addr).alias("addr"),
        F.date_format("week", "yyyy-MM-dd").alias("week"),
        F.coalesce("sent", F.lit(0)).alias("sent"),
        F.coalesce("received", F.lit(0)).alias("received"),
    )
