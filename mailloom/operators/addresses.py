"""Who wrote to whom: participants, address statistics, edges, communities on mail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W



def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def all_recipients() -> Column:
    return F.concat(_list("tos"), _list("ccs"), _list("bccs"))


def distinct_recipients() -> Column:
    return F.filter(F.array_distinct(all_recipients()), lambda a: a.isNotNull() & (a != ""))


def first_sender() -> Column:
    """The first sender, or null when there is none or it is blank."""
    return F.nullif(F.get(F.col("senders"), F.lit(0)), F.lit(""))


def _sent_at(emails: DataFrame) -> Column:
    at = F.col("datetime")
    if isinstance(emails.schema["datetime"].dataType, T.StringType):
        return F.nullif(at, F.lit(""))
    return at


def participants(emails: DataFrame) -> DataFrame:
    """(addr, email_id, datetime, type, n_attachments): one pass over the mail table.

    Attachments count for the sender only.
    """
    n_attachments = (
        F.coalesce(F.size("attachments"), F.lit(0)).cast("int")
        if "attachments" in emails.columns
        else F.lit(0)
    )

    def entry(addr: Column, kind: str, n: Column) -> Column:
        return F.struct(addr.alias("addr"), F.lit(kind).alias("type"), n.alias("n_attachments"))

    no_one = F.array().cast("array<struct<addr:string,type:string,n_attachments:int>>")
    people = F.concat(
        F.when(
            first_sender().isNotNull(),
            F.array(entry(first_sender(), "sender", F.greatest(n_attachments, F.lit(0)))),
        ).otherwise(no_one),
        F.transform(distinct_recipients(), lambda a: entry(a, "recepient", F.lit(0))),
    )
    return (
        emails.select(
            F.col("id").alias("email_id"),
            _sent_at(emails).alias("datetime"),
            F.explode(people).alias("p"),
        )
        .select("p.addr", "email_id", "datetime", "p.type", "p.n_attachments")
    )


def sender_attachments(emails: DataFrame) -> DataFrame:
    """(addr, email_id, datetime, attachment fields without content) per attachment sent."""
    fields = [
        f.name
        for f in emails.schema["attachments"].dataType.elementType.fields
        if f.name not in ("content", "contents64")
    ]
    return (
        emails.where(first_sender().isNotNull())
        .select(
            first_sender().alias("addr"),
            F.col("id").alias("email_id"),
            _sent_at(emails).alias("datetime"),
            F.explode("attachments").alias("a"),
        )
        .select("addr", "email_id", "datetime", *[F.col(f"a.{name}").alias(name) for name in fields])
    )


def address_stats(people: DataFrame) -> DataFrame:
    """Counts and first/last dates per address; plain aggregates, so a hot address combines map-side."""
    sent = F.col("type") == "sender"
    received = F.col("type") == "recepient"
    return people.groupBy("addr").agg(
        F.count_if(sent).alias("sent_count"),
        F.count_if(received).alias("received_count"),
        F.sum("n_attachments").cast("bigint").alias("attachments_count"),
        F.min(F.when(sent, F.col("datetime"))).alias("first_sent"),
        F.max(F.when(sent, F.col("datetime"))).alias("last_sent"),
        F.min(F.when(received, F.col("datetime"))).alias("first_received"),
        F.max(F.when(received, F.col("datetime"))).alias("last_received"),
    )


def address_history(emails: DataFrame) -> DataFrame:
    """Nested history per address and month: sender[], recepient[], sender_attachments[].

    The key is (addr, month), the same for every address, so a busy mailbox is many records of
    months; undated mail has a null month. A mail is read once and gives one entry for each of its people; the
    sender's has the files, which get the mail's id and date when they have met. Maps, which have no
    order, are left out of the attachments' fields.
    """
    files = emails.schema["attachments"].dataType.elementType.fields
    kept = [f.name for f in files if f.name not in ("content", "contents64") and not isinstance(f.dataType, T.MapType)]
    listed = F.transform("attachments", lambda a: F.struct(*[a[name].alias(name) for name in kept]))

    def entry(addr: Column, sent: bool) -> Column:
        return F.struct(addr.alias("addr"), F.lit(sent).alias("sent"))

    people = F.concat(
        F.when(first_sender().isNotNull(), F.array(entry(first_sender(), True))).otherwise(
            F.array().cast("array<struct<addr:string,sent:boolean>>")
        ),
        F.transform(distinct_recipients(), lambda a: entry(a, False)),
    )
    rows = emails.select(
        F.col("id").alias("email_id"), _sent_at(emails).alias("datetime"), listed.alias("files"), F.explode(people).alias("p")
    ).select(
        "p.addr", F.date_trunc("month", "datetime").alias("month"), "p.sent",
        F.struct("email_id", "datetime").alias("mail"), F.when(F.col("p.sent"), F.col("files")).alias("files"),
    )
    # dealt out first: lists do not get shorter by being begun before the shuffle
    met = rows.repartition("addr", "month").groupBy("addr", "month").agg(
        F.sort_array(F.collect_list(F.when(F.col("sent"), F.struct("mail.email_id", "mail.datetime", "files")))).alias("sent"),
        F.sort_array(F.collect_list(F.when(~F.col("sent"), F.col("mail")))).alias("recepient"),
    )

    def of_mail(m: Column) -> Column:
        return F.transform(
            F.coalesce(m.files, F.array()),
            lambda a: F.struct(m.email_id.alias("email_id"), m.datetime.alias("datetime"), *[a[name].alias(name) for name in kept]),
        )

    return met.select(
        "addr",
        "month",
        F.transform("sent", lambda m: F.struct(m.email_id.alias("email_id"), m.datetime.alias("datetime"))).alias("sender"),
        "recepient",
        F.sort_array(F.flatten(F.transform("sent", of_mail))).alias("sender_attachments"),
    )


def weighted_edges(emails: DataFrame) -> DataFrame:
    """(src, dst, n): mails from the first sender to each distinct recipient."""
    return (
        emails.where(first_sender().isNotNull())
        .select(first_sender().alias("src"), F.explode(distinct_recipients()).alias("dst"))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dense_index(values: DataFrame, column: str, start: int = 0) -> DataFrame:
    """Number the distinct values of a column 0..n-1 in the order of their MD5 digest.

    Digests are uniform, so 4096 prefix buckets are sorted independently and only the 4096
    bucket sizes meet in one task; there is no global sort.
    """
    digest = F.md5(F.col(column).cast("string"))
    rows = values.select(column).distinct().withColumn("_digest", digest)
    # the filter stands on both uses of the rows, so that they share one shuffle
    rows = rows.withColumn("_bucket", F.substring("_digest", 1, 3)).where(F.col("_bucket").isNotNull())
    sizes = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.Window.orderBy("_bucket").rowsBetween(W.Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_bucket"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = W.Window.partitionBy("_bucket").orderBy("_digest", column)
    # at most 16^3 offset rows, so the hint is safe at any scale
    return rows.join(F.broadcast(offsets), "_bucket").select(
        column,
        (F.row_number().over(within) + F.col("_offset") - 1 + start).cast("bigint").alias("idx"),
    )


def node_index(edges: DataFrame) -> DataFrame:
    """(addr, idx) over the distinct end points of the edges."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("addr"))
    return dense_index(ends, "addr")


def mail_nodes(emails: DataFrame) -> DataFrame:
    """(addr, idx) as `node_index` of the weighted edges gives it, from the mails themselves.

    Only different addresses are shuffled; the pairs, of which there are about as many as recipients, are not.
    """
    linked = emails.where(first_sender().isNotNull() & (F.size(distinct_recipients()) > 0))
    ends = F.concat(F.array(first_sender()), distinct_recipients())
    return dense_index(linked.select(F.explode(ends).alias("addr")), "addr")


def undirected(edges: DataFrame) -> DataFrame:
    """One unweighted edge per unordered pair."""
    return edges.select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    ).distinct()


def name_communities(nodes: DataFrame, membership: DataFrame) -> DataFrame:
    """(addr, idx, community, community_id): a community is named after its lowest-index member.

    `membership` is (addr, community_key) from any clustering.
    """
    members = nodes.join(membership, "addr")
    names = members.groupBy("community_key").agg(
        F.min_by("addr", "idx").alias("community"), F.min("idx").alias("community_id")
    )
    return members.join(names, "community_key").select("addr", "idx", "community", "community_id")


def address_table(stats: DataFrame, communities: DataFrame) -> DataFrame:
    """Addresses on at least one edge, with statistics and community."""
    return stats.join(communities, "addr")


def email_communities(people: DataFrame, communities: DataFrame) -> DataFrame:
    """(id, communities[], communities_count) for mails that touch at least one community."""
    return (
        people.select("addr", "email_id")
        .join(communities.select("addr", "community_id", "community"), "addr")
        .groupBy(F.col("email_id").alias("id"))
        .agg(
            F.sort_array(F.collect_set(F.struct("community_id", "community"))).alias("communities")
        )
        .withColumn("communities_count", F.size("communities").cast("bigint"))
    )


def assign_communities(emails: DataFrame, assignments: DataFrame) -> DataFrame:
    """Add communities and communities_count to every mail; none means [] and 0."""
    none = F.array().cast("array<struct<community_id:bigint,community:string>>")
    return (
        emails.join(assignments, "id", "left")
        .withColumn("communities", F.coalesce("communities", none))
        .withColumn("communities_count", F.coalesce("communities_count", F.lit(0).cast("bigint")))
    )


def integrity_violations(emails: DataFrame, assignments: DataFrame) -> DataFrame:
    """(id, problem): duplicate mail ids, and assignments whose mail is missing."""
    duplicates = (
        emails.groupBy("id")
        .count()
        .where(F.col("count") > 1)
        .select("id", F.lit("duplicate email id").alias("problem"))
    )
    orphans = (
        assignments.select("id")
        .distinct()
        .join(emails.select("id"), "id", "left_anti")
        .select("id", F.lit("community without email").alias("problem"))
    )
    return duplicates.unionByName(orphans)


def assert_unique_ids(emails: DataFrame, assignments: DataFrame) -> None:
    bad = integrity_violations(emails, assignments).limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{row.id}: {row.problem}" for row in bad))


def edge_list(emails: DataFrame, predicate: Column | None = None) -> DataFrame:
    """(from, to) per recipient, repeats kept, for mails with a sender and any recipient list."""
    chosen = emails if predicate is None else emails.where(predicate)
    return chosen.where(F.size("senders") > 0).select(
        F.get("senders", F.lit(0)).alias("from"), F.explode(all_recipients()).alias("to")
    )


def infer_bcc(emails: DataFrame, owner: str | Column) -> DataFrame:
    """Append the mailbox owner to bccs when no list names them, ignoring case."""
    owner = F.lit(owner) if isinstance(owner, str) else owner
    named = F.transform(
        F.concat(_list("senders"), all_recipients()), lambda a: F.lower(F.coalesce(a, F.lit("")))
    )
    return emails.withColumn(
        "bccs",
        F.when(F.array_contains(named, F.lower(owner)), _list("bccs")).otherwise(
            F.concat(_list("bccs"), F.array(owner))
        ),
    )
