"""Addresses, networks and the innermost match."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from mailloom.operators import geo

TEXTS = """1.2.3.4 ::1 :: 1:: 2001:db8::1 2001:DB8:0:0:0:0:0:1 1:2:3:4:5:6:7:8 1:2:3:4:5:6:7 1:2:3:4:5:6:7:8:9 ::ffff:1.2.3.4
64:ff9b::1.2.3.4 1::2::3 ::: :1::2 1:2:3:4:5:6:7:: ::2:3:4:5:6:7:8 1:2:3:4::5:6:7:8 g::1 12345:: 1.2.3 256.1.1.1 ::1.2.3.4.5 :1 1:
::ffff:300.1.1.1 1:2:3:4:5:6:1.2.3.4 : a.b.c.d""".split()


def number(text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    return int(address) + (0 if address.version == 6 else 0xFFFF << 32)


def test_addresses_become_keys(spark):
    rows = spark.createDataFrame([(t,) for t in [*TEXTS, "", None]], "t string").select("t", geo.ip_key(F.col("t")).alias("k")).collect()
    for r in rows:
        n = number(r.t) if r.t else None
        assert r.k == (None if n is None else f"{n:032x}"), r.t


def test_ranges_become_blocks(spark):
    dice = random.Random(1)
    ranges = [(a := dice.randrange(2**32), min(2**32 - 1, a + dice.randrange(2 ** dice.randrange(1, 32)))) for _ in range(40)]
    ranges += [(0, 2**32 - 1), (5, 5), (0, 0), (2**32 - 1, 2**32 - 1), (2**31, 2**32 - 1)]
    rows = spark.createDataFrame(ranges, "lo long, hi long").select("lo", "hi", geo.range_prefixes(F.col("lo"), F.col("hi")).alias("b"))
    for r in rows.collect():
        blocks = sorted((int(b.key, 16) & 0xFFFFFFFF, b.bits - 96) for b in r.b)
        want = ipaddress.summarize_address_range(ipaddress.ip_address(r.lo), ipaddress.ip_address(r.hi))
        assert blocks == sorted((int(n.network_address), n.prefixlen) for n in want)


@pytest.mark.parametrize("bits", range(0, 129, 3))
def test_prefixes(spark, bits):
    n = 0x20010DB8_1234_5678_9ABC_DEF0_1357_9BDF
    key = F.lit(f"{n:032x}")
    a, b = spark.range(1).select(geo.prefix_of(key, F.lit(bits)), geo.prefix_of(key, bits)).first()
    assert a == b == f"{n >> (128 - bits) << (128 - bits):032x}"[: -(-bits // 4)]


def test_the_innermost_network_counts(spark):
    nets = [
        ("10.0.0.0/8", None, None, "wide", 1.0, 1.0), ("10.1.0.0/16", None, None, "inner", 2.0, 2.0), ("10.1.2.0/24", None, None, "no place", 0.0, 2.0),
        ("10.1.2.7/32", None, None, "host", 3.0, 3.0), (None, 0xC0000200, 0xC0000209, "range", 4.0, 4.0), ("2001:db8::/32", None, None, "six", 5.0, 5.0),
        ("2001:db8:1::/48", None, None, "six inner", 6.0, 6.0), ("not a network", None, None, "x", 1.0, 1.0), ("10.0.0.0/99", None, None, "x", 1.0, 1.0),
        ("10.1.0.0/16", None, None, "aaa", 9.0, 9.0),
    ]
    table = spark.createDataFrame(nets, "network string, lo long, hi long, city string, lat double, lon double")
    # a third of all mails comes from one address
    ips = ["10.1.9.9"] * 400 + ["10.9.9.9", "10.1.2.3", "10.1.2.7", "192.0.2.9", "192.0.2.10", "[2001:db8::7]", "2001:db8:1::7", "::ffff:10.9.9.9", "junk", "9.9.9.9"]
    mails = spark.createDataFrame([(str(i), [ip]) for i, ip in enumerate(ips)] + [("none", []), ("null", None)], "id string, originating_ips array<string>")
    found = {r.id: [o.city for o in r.originating_locations] for r in geo.add_locations(mails, table).collect()}
    assert [found[str(i)] for i in range(400, 410)] == [["wide"], [], ["host"], ["range"], [], ["six"], ["six inner"], ["wide"], [], []]
    assert all(found[str(i)] == ["inner"] for i in range(400)) and found["none"] == found["null"] == []
    assert geo.add_locations(mails, table.limit(0)).where("size(originating_locations) > 0").count() == 0
