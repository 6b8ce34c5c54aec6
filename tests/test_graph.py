"""Communities on planted graphs, integrity checks and hot addresses."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from mailloom.operators import addresses as A
from mailloom.operators import communities as C


def clique(prefix, n):
    return [(f"{prefix}{i}", f"{prefix}{j}") for i, j in itertools.combinations(range(n), 2)]


def graph(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def groups(membership):
    found = {}
    for row in membership.collect():
        found.setdefault(row.community_key, set()).add(row.addr)
    return {frozenset(g) for g in found.values()}


def test_two_cliques_with_a_bridge_split_in_two(spark):
    edges = graph(spark, clique("a", 6) + clique("b", 6) + [("a0", "b0"), ("x", "y"), ("z", "z")])
    found = groups(C.louvain(edges))
    assert found == {
        frozenset(f"a{i}" for i in range(6)),
        frozenset(f"b{i}" for i in range(6)),
        frozenset("xy"),
        frozenset("z"),
    }


def test_planted_communities_are_found(spark):
    rnd = random.Random(3)
    pairs = [
        (f"p{i}", f"p{j}")
        for i, j in itertools.combinations(range(160), 2)
        if rnd.random() < (0.5 if i // 40 == j // 40 else 0.02)
    ]
    edges = graph(spark, pairs)
    membership = C.louvain(edges).cache()
    assert groups(membership) == {frozenset(f"p{i}" for i in range(b, b + 40)) for b in range(0, 160, 40)}
    ends = edges.select(F.explode(F.array("src", "dst")).alias("addr")).distinct()
    assert membership.count() == ends.count() == membership.select("addr").distinct().count()
    assert C.modularity(edges, membership).first().modularity > 0.6
    again = C.louvain(edges.repartition(3).orderBy(F.desc("dst")))
    assert groups(again) == groups(membership)


def gain_of_merging(pairs, of):
    """The most that uniting two communities would add to modularity, times the square of twice the edges."""
    total, size, between = 2 * len(pairs), {}, {}
    for a, b in pairs:
        for x in (a, b):
            size[of[x]] = size.get(of[x], 0) + 1
        key = tuple(sorted((of[a], of[b])))
        between[key] = between.get(key, 0) + 1
    return max(2 * (n * total - size[a] * size[b]) for (a, b), n in between.items() if a != b)


def test_no_two_communities_gain_by_uniting(spark):
    pairs = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(300)]
    of = {r.addr: r.community_key for r in C.louvain(graph(spark, pairs)).collect()}
    assert len(of) == 301
    assert gain_of_merging(pairs, of) <= 0


def first_level(spark, pairs):
    """What a level starts with: (links, state, total); nodes are numbered in the order of their names."""
    names = sorted({x for pair in pairs for x in pair})
    nodes = spark.createDataFrame([(name, i) for i, name in enumerate(names)], "addr string, idx bigint")
    adjacency = C._adjacency(graph(spark, pairs), nodes)
    degrees = adjacency.groupBy("u").agg(F.sum("w").alias("k"))
    links = adjacency.join(degrees, "u").where("u <> v").select("u", "v", "w", "k").cache()
    state = degrees.select(F.col("u").alias("node"), F.col("u").alias("c"), "k", F.col("k").alias("tot"))
    return links, state, 2 * len(pairs)


def test_all_leaves_enter_a_hub_in_one_round(spark):
    links, state, total = first_level(spark, [("hub", f"leaf{i:02d}") for i in range(30)])
    moved = C._moved(C._propose(links, state, total), 0, True, total).collect()
    assert {(r.c, r.tot) for r in moved} == {(0, 60)} and len(moved) == 31


@pytest.mark.parametrize("large", [False, True])
def test_rounds_of_few_movers_always_raise_modularity(spark, large):
    """Also where gains are decimals, with weights that add up to over 2^31."""
    rnd = random.Random(5)
    pairs = list({tuple(sorted(rnd.sample([f"p{i:03d}" for i in range(120)], 2))) for _ in range(500)} | {("hub", f"p{i:03d}") for i in range(90)})
    links, state, total = first_level(spark, pairs)
    factor = 2**31 // total + 1 if large else 1
    links = links.withColumn("w", F.col("w") * factor).withColumn("k", F.col("k") * factor)
    state = state.withColumn("k", F.col("k") * factor).withColumn("tot", F.col("tot") * factor)
    total *= factor
    last = None
    for turn in range(4):
        proposal = C.checkpointed(C._propose(links, state, total))
        quality, moving, nodes = C._quality(proposal, 0, total)
        assert nodes == 121 and moving > 0 and (last is None or quality > last)
        last, state = quality, C.checkpointed(C._moved(proposal, turn, True, total))


def test_modularity_of_two_cliques(spark):
    edges = graph(spark, clique("a", 6) + clique("b", 6) + [("a0", "b0")])
    nodes = A.node_index(edges)
    split = nodes.select("addr", F.substring("addr", 1, 1).alias("community_key"))
    assert C.modularity(edges, split).first().modularity == pytest.approx(30 / 31 - 0.5)


def mails(spark, rows):
    return spark.createDataFrame(
        rows,
        "id string, datetime string, senders array<string>, tos array<string>, ccs array<string>, bccs array<string>,"
        "attachments array<struct<guid:string,extension:string,content:string>>",
    )


def test_participants_and_statistics(spark):
    emails = mails(
        spark,
        [
            ("1", "2001-01-01", ["a", "z"], ["b", "b", ""], ["c"], ["b"], [("g", ".txt", "text")]),
            ("2", "", ["a"], [], [], [], []),
            ("3", "2000-01-01", [], ["a"], [], [], []),
            ("4", "2000-05-01", [""], ["b"], [], [], []),
        ],
    )
    people = {(r.addr, r.email_id, r.type): r.datetime for r in A.participants(emails).collect()}
    assert people == {
        ("a", "1", "sender"): "2001-01-01",
        ("b", "1", "recepient"): "2001-01-01",
        ("c", "1", "recepient"): "2001-01-01",
        ("a", "2", "sender"): None,
        ("a", "3", "recepient"): "2000-01-01",
        ("b", "4", "recepient"): "2000-05-01",
    }
    stats = {r.addr: r for r in A.address_stats(A.participants(emails)).collect()}
    a = stats["a"]
    assert (a.sent_count, a.received_count, a.attachments_count) == (2, 1, 1)
    assert (a.first_sent, a.last_sent, a.first_received) == ("2001-01-01", "2001-01-01", "2000-01-01")
    assert stats["b"].first_sent is None
    files = A.sender_attachments(emails)
    assert "content" not in files.columns and files.count() == 1
    assert {(r.src, r.dst, r.n) for r in A.weighted_edges(emails).collect()} == {("a", "b", 1), ("a", "c", 1)}


def test_mail_without_recipients_gives_no_address_row(spark):
    emails = mails(spark, [("1", "", ["a"], ["b"], [], [], []), ("2", "", ["solo"], [], [], [], [])])
    nodes = A.node_index(A.weighted_edges(emails))
    named = A.name_communities(nodes, nodes.select("addr", F.lit(1).alias("community_key")))
    table = A.address_table(A.address_stats(A.participants(emails)), named)
    assert {r.addr for r in table.collect()} == {"a", "b"}
    ids = {r.addr: r.idx for r in nodes.collect()}
    assert sorted(ids.values()) == [0, 1]
    for row in named.collect():
        assert row.community_id == 0 and ids[row.community] == 0
    found = A.assign_communities(emails, A.email_communities(A.participants(emails), named))
    assert {r.id: r.communities_count for r in found.collect()} == {"1": 1, "2": 0}


def test_integrity(spark):
    emails = spark.createDataFrame([("1",), ("2",)], "id string")
    A.assert_unique_ids(emails, emails)
    with pytest.raises(ValueError, match="duplicate"):
        A.assert_unique_ids(emails.union(emails), emails)
    with pytest.raises(ValueError, match="without email"):
        A.assert_unique_ids(emails.where("id = '1'"), emails)


def test_history_of_a_hot_address_stays_whole_in_months(spark):
    n = 4000
    emails = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 10 > 0, F.date_add(F.lit("2001-01-01"), F.col("id").cast("int"))).cast("string").alias("datetime"),
        F.array(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))).alias("senders"),
        F.array(F.lit("hot2")).alias("tos"),
        F.array().cast("array<string>").alias("ccs"),
        F.array().cast("array<string>").alias("bccs"),
        F.array(F.struct(F.col("id").cast("string").alias("guid"), F.lit(".x").alias("extension"))).alias("attachments"),
    )
    history = A.address_history(emails).cache()
    assert history.where("addr = 'hot2' AND month IS NOT NULL").agg(F.max(F.size("recepient"))).first()[0] <= 31
    assert history.where("addr = 'hot2' AND month IS NULL").count() == 1
    assert history.where("addr = 'hot2'").select(F.explode("recepient.email_id")).distinct().count() == n
    hot = history.where("addr = 'hot'").agg(F.sum(F.size("sender")), F.sum(F.size("sender_attachments"))).first()
    assert tuple(hot) == ((n + 2) // 3, (n + 2) // 3)
