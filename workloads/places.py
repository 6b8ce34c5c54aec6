"""Originating addresses of events located in a network table."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom.operators import geo as G

from .fixtures import table
from .registry import query

# ranges, networks inside them, and inside these some without a place; the smallest counts
IPS = """ips AS (
  SELECT event_id, (user_id * 2654435761 + event_id * 40503) % 4294967296 AS ip,
    (user_id * 40503 + event_id * 2654435761) % 4294967296 AS second, event_id % 80 AS site, user_id * 7919 % 65536 AS subnet FROM events),
  nets AS (
  SELECT i * 67108864 AS lo, i * 67108864 + 59999999 AS hi, 'CITY_' || i AS city, i - 32 AS lat, 2 * i - 64 AS lon FROM range(0, 64) t(i)
  UNION ALL SELECT (4 * i + 1) * 16777216 + 8388608, (4 * i + 2) * 16777216 - 1, 'INNER_' || i, i + 1, i + 2 FROM range(0, 64) t(i)
  UNION ALL SELECT (4 * i + 1) * 16777216 + 8388608, (4 * i + 1) * 16777216 + 8388608 + 1048575, 'NOWHERE_' || i, 0, i FROM range(0, 64, 8) t(i)),
  matched AS (
  SELECT event_id, 0 AS pos, city, lat, lon, hi - lo AS size FROM ips JOIN nets ON ip BETWEEN lo AND hi
  UNION ALL SELECT event_id, 1, city, lat, lon, hi - lo FROM ips JOIN nets ON second BETWEEN lo AND hi WHERE event_id % 4 = 0
  UNION ALL SELECT event_id, 2, 'SITE_' || site || CASE WHEN subnet >= 32768 THEN '_HIGH' ELSE '' END, site + 1, CASE WHEN subnet >= 32768 THEN 7 ELSE 5 END, 0
    FROM ips WHERE event_id % 3 = 0 AND site < 64),
  found AS (
  SELECT event_id, pos, city, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY event_id, pos ORDER BY size) AS place FROM matched)
  WHERE place = 1 AND lat <> 0 AND lon <> 0)"""


def _dotted(n):
    parts = [(F.floor(n / (256**i)) % 256).cast("bigint").cast("string") for i in (3, 2, 1, 0)]
    return F.concat(F.lit("["), F.concat_ws(".", *parts), F.lit("]"))


def ip_mail(spark, sf_dir):
    """One mail per event with one to three bracketed addresses, IPv4 and IPv6, some of them broken or empty."""
    e, u = F.col("event_id"), F.col("user_id")
    second = F.when(e % 4 == 0, _dotted((u * 40503 + e * 2654435761) % 4294967296)).when(
        e % 4 == 1, F.lit("[300.1.2.3]")
    )

    def digits(n):
        return F.lower(F.hex(n))

    third = F.concat(F.lit("[2001:DB8:"), digits(e % 80), F.lit(":"), digits(u * 7919 % 65536), F.lit("::"), digits(e % 65536), F.lit("]"))
    ips = F.array(_dotted((u * 2654435761 + e * 40503) % 4294967296), F.coalesce(second, F.lit("")), F.when(e % 3 == 0, third))
    return table(spark, sf_dir, "events").select(
        e.cast("string").alias("id"), F.filter(ips, lambda ip: ip.isNotNull()).alias("originating_ips")
    )


def networks(spark):
    i = F.col("id")

    def text(*parts):
        return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))

    def rows(count, step, network, city, lat, lon, lo=None, hi=None):
        none = F.lit(None)
        return spark.range(0, count, step).select(
            (none if lo is None else lo).cast("bigint").alias("lo"),
            (none if hi is None else hi).cast("bigint").alias("hi"),
            (none if network is None else network).cast("string").alias("network"),
            text(*city).alias("city"),
            lat.cast("double").alias("lat"),
            lon.cast("double").alias("lon"),
        )

    site = F.lower(F.hex(i))
    parts = [
        rows(64, 1, None, ("CITY_", i), i - 32, 2 * i - 64, i * 67108864, i * 67108864 + 59999999),
        rows(64, 1, text(4 * i + 1, ".128.0.0/9"), ("INNER_", i), i + 1, i + 2),
        rows(64, 8, text(4 * i + 1, ".128.0.0/12"), ("NOWHERE_", i), F.lit(0), i),
        rows(64, 1, text("2001:db8:", site, "::/48"), ("SITE_", i), i + 1, F.lit(5)),
        rows(64, 1, text("2001:0DB8:", site, ":8000::/49"), ("SITE_", i, "_HIGH"), i + 1, F.lit(7)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    f"""WITH {IPS} SELECT CAST(event_id AS VARCHAR) AS id, count(city) AS n,
      coalesce(string_agg(city || '@' || lat || '/' || lon, ',' ORDER BY pos), '') AS locations
    FROM events LEFT JOIN found USING (event_id) GROUP BY event_id"""
)
def email_locations(spark, sf_dir):
    rows = G.add_locations(ip_mail(spark, sf_dir), networks(spark))
    text = F.transform(
        "originating_locations",
        lambda o: F.concat(
            o.city, F.lit("@"), o.geo_coord.lat.cast("bigint").cast("string"), F.lit("/"), o.geo_coord.lon.cast("bigint").cast("string")
        ),
    )
    return rows.select(
        "id", F.size("originating_locations").cast("bigint").alias("n"), F.array_join(text, ",").alias("locations")
    )


@query(f"WITH {IPS} SELECT count(*) AS located FROM found")
def located_count(spark, sf_dir):
    return G.located_count(G.add_locations(ip_mail(spark, sf_dir), networks(spark)))


@query(
    """SELECT event_id, (user_id * 2654435761 + event_id * 40503) % 4294967296 AS ip,
      CASE event_id % 4 WHEN 0 THEN (user_id * 40503 + event_id * 2654435761) % 4294967296 END AS second FROM events"""
)
def ip_numbers(spark, sf_dir):
    def number(i):
        return G.ip_number(G.clean_ip(F.get("originating_ips", F.lit(i))))

    return ip_mail(spark, sf_dir).select(
        F.col("id").cast("bigint").alias("event_id"), number(0).alias("ip"), number(1).alias("second")
    )
