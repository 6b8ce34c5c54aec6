"""Where mail was sent from: originating addresses located in a network table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.runtime import checkpointed


def clean_ip(ip: Column) -> Column:
    return F.translate(ip, "[]", "")


def ip_number(ip: Column) -> Column:
    """IPv4 text to a number, null when it is not an address."""
    parts = F.transform(F.split(ip, r"\."), lambda p: p.try_cast("bigint"))
    shaped = ip.rlike(r"\A[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z")
    inside = F.forall(parts, lambda p: F.coalesce(p <= 255, F.lit(False)))
    value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, p: n * 256 + p)
    return F.when(shaped & inside, value)


def ip_key(text: Column) -> Column:
    """IPv4 or IPv6 text as 32 hexadecimal digits, null when it is not an address.

    IPv4 addresses are the ones of ::ffff:0:0/96, however they are written.
    """
    four = ip_number(text)
    # a dotted tail is two groups more
    dotted = F.regexp_extract(text, r"\A([0-9A-Fa-f:]*:)([0-9]+[.][0-9.]+)\z", 2)
    tail = F.lpad(F.lower(F.hex(ip_number(dotted))), 8, "0")
    spelled = F.when(dotted == "", F.lower(text)).otherwise(
        F.concat(F.lower(F.regexp_extract(text, r"\A([0-9A-Fa-f:]*:)", 1)), F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4))
    )

    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda g: g != "")

    def key(sides: Column) -> Column:
        left, right = groups(F.get(sides, 0)), groups(F.coalesce(F.get(sides, 1), F.lit("")))
        gap = F.lit(8) - F.size(left) - F.size(right)
        fits = F.when(F.size(sides) == 2, gap >= 1).otherwise((F.size(sides) == 1) & (gap == 0))
        padded = [F.array_join(F.transform(side, lambda g: F.lpad(g, 4, "0")), "") for side in (left, right)]
        return F.when(fits, F.concat(padded[0], F.repeat(F.lit("0000"), F.greatest(gap, F.lit(0))), padded[1]))

    # single colons stand between groups, and only the double one may stand at an end
    shaped = spelled.rlike(r"\A(?:[0-9a-f]{1,4}(?![0-9a-f])|:(?=:)|(?<=:):|(?<=[0-9a-f]):(?=[0-9a-f]))+\z") & ~spelled.contains(":::")
    six = F.when(shaped, F.get(F.transform(F.array(F.split(spelled, "::")), key), 0))
    mapped = F.concat(F.lit("0" * 20 + "ffff"), F.lpad(F.lower(F.hex(four)), 8, "0"))
    return F.when(text.contains(":"), six).when(four.isNotNull(), mapped)


DIGITS = "0123456789abcdef"


def prefix_of(key: Column, bits: Column | int) -> Column:
    """The first bits of a key: whole digits, and the last one with its other bits cleared."""
    if isinstance(bits, int):
        step = 16 >> bits % 4
        cleared = "".join(DIGITS[n - n % step] for n in range(16))
        last = F.translate(F.substring(key, bits // 4 + 1, 1), DIGITS, cleared)
        return F.substring(key, 1, bits // 4) if bits % 4 == 0 else F.concat(F.substring(key, 1, bits // 4), last)
    whole = F.floor(bits / 4).cast("int")
    rest = bits % 4
    digit = F.conv(F.substring(key, whole + 1, F.lit(1)), 16, 10).cast("int")
    step = F.element_at(F.array(*(F.lit(n) for n in (16, 8, 4, 2))), rest + 1)
    cleared = F.lower(F.hex(digit - digit % step))
    return F.concat(F.substring(key, F.lit(1), whole), F.when(rest > 0, cleared).otherwise(F.lit("")))


def range_prefixes(lo: Column, hi: Column) -> Column:
    """array<struct<key, bits>>: the aligned blocks that make up a range of IPv4 numbers, at most 62."""
    block = "array<struct<at:bigint,size:int>>"

    def narrow(range_: Column, size: Column) -> Column:
        low, high = range_.low, range_.high
        odd_low, odd_high = (low < high) & (low % 2 == 1), (low < high) & (high % 2 == 1)
        taken = F.array_compact(
            F.array(
                F.when(odd_low, F.struct(F.call_function("shiftleft", low, size).alias("at"), size.alias("size"))),
                # a block that both ends name is taken once
                F.when(odd_high & ~(odd_low & (low == high - 1)), F.struct(F.call_function("shiftleft", high - 1, size).alias("at"), size.alias("size"))),
            )
        ).cast(block)
        return F.struct(
            F.floor((low + F.when(odd_low, 1).otherwise(0)) / 2).cast("bigint").alias("low"),
            F.floor((high - F.when(odd_high, 1).otherwise(0)) / 2).cast("bigint").alias("high"),
            F.concat(range_.blocks, taken).alias("blocks"),
        )

    start = F.struct(lo.cast("bigint").alias("low"), (hi.cast("bigint") + 1).alias("high"), F.array().cast(block).alias("blocks"))
    blocks = F.aggregate(F.sequence(F.lit(0), F.lit(32)), start, narrow, lambda r: r.blocks)
    mapped = F.lit("0" * 20 + "ffff")
    return F.transform(blocks, lambda b: F.struct(F.concat(mapped, F.lpad(F.lower(F.hex(b["at"])), 8, "0")).alias("key"), (128 - b["size"]).alias("bits")))


def network_prefixes(nets: DataFrame) -> DataFrame:
    """(bits, prefix, city, lat, lon), one row a prefix; of several networks with one prefix the largest entry.

    `nets` has a `network` column of address/bits texts, IPv4 or IPv6, or numbers `lo` and `hi` of IPv4
    ranges, or both; texts that are no networks are left out.
    """
    blocks = []
    if {"lo", "hi"} <= set(nets.columns):
        ranged = F.when(F.col("lo").isNotNull() & (F.col("hi") >= F.col("lo")), range_prefixes(F.col("lo"), F.col("hi")))
        blocks.append(F.coalesce(ranged, F.array().cast("array<struct<key:string,bits:int>>")))
    if "network" in nets.columns:
        parts = F.split("network", "/")
        address, bits = F.get(parts, 0), F.get(parts, 1).try_cast("int")
        whole = bits + F.when(address.contains(":"), 0).otherwise(96)
        valid = ip_key(address).isNotNull() & (F.size(parts) == 2) & (bits >= 0) & (whole <= 128)
        one = F.array(F.struct(ip_key(address).alias("key"), whole.alias("bits")))
        blocks.append(F.when(valid, one).otherwise(F.array().cast("array<struct<key:string,bits:int>>")))
    rows = nets.select("city", "lat", "lon", F.explode(F.concat(*blocks)).alias("b"))
    keyed = rows.select(F.col("b.bits").alias("bits"), prefix_of(F.col("b.key"), F.col("b.bits")).alias("prefix"), F.struct("city", "lat", "lon").alias("entry"))
    return keyed.groupBy("bits", "prefix").agg(F.max("entry").alias("entry"))


def locate(addresses: DataFrame, nets: DataFrame) -> DataFrame:
    """Add city, lat and lon of the innermost network to rows with a `key` as `ip_key` gives it.

    Each different address is looked up under its prefixes of the lengths that occur, at most 129, by an
    equality join, so neither a wide network nor a busy one makes a range of rows meet. Rows without a
    network, or whose network has a coordinate that is missing or 0, drop out.
    """
    known = checkpointed(network_prefixes(nets))
    lengths = sorted(r.bits for r in known.select("bits").distinct().collect())
    if not lengths:
        lengths = [0]
    spelled = F.array(*(F.struct(F.lit(n).alias("bits"), prefix_of(F.col("key"), n).alias("prefix")) for n in lengths))
    asked = addresses.select("key").where(F.col("key").isNotNull()).distinct().select("key", F.explode(spelled).alias("p")).select("key", "p.*")
    innermost = asked.join(known, ["bits", "prefix"]).groupBy("key").agg(F.max_by("entry", "bits").alias("entry"))
    located = innermost.select("key", "entry.*").where((F.col("lat") != 0) & (F.col("lon") != 0))
    return addresses.join(located, "key")


def email_locations(emails: DataFrame, nets: DataFrame) -> DataFrame:
    """(id, originating_locations[{city, geo_coord}]) in header order, for mails with any."""
    ips = emails.select(
        "id", F.posexplode(F.transform("originating_ips", clean_ip)).alias("pos", "text")
    ).select("id", "pos", ip_key(F.col("text")).alias("key"))
    found = F.struct("pos", "city", F.struct("lat", "lon").alias("geo_coord"))
    return (
        locate(ips.where(F.col("key").isNotNull()), nets)
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(found)).alias("found"))
        .select(
            "id",
            F.transform(
                "found", lambda f: F.struct(f.city.alias("city"), f.geo_coord.alias("geo_coord"))
            ).alias("originating_locations"),
        )
    )


def add_locations(emails: DataFrame, nets: DataFrame) -> DataFrame:
    """Add originating_locations to every mail; [] when nothing was located."""
    found = email_locations(emails, nets)
    none = F.array().cast(found.schema["originating_locations"].dataType)
    return emails.join(found, "id", "left").withColumn(
        "originating_locations", F.coalesce("originating_locations", none)
    )


def located_count(emails: DataFrame) -> DataFrame:
    """(located): how many originating addresses were located."""
    return emails.agg(F.coalesce(F.sum(F.size("originating_locations")), F.lit(0)).alias("located"))
