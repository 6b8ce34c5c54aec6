"""Index-style projections and queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom import schemas
from mailloom.functions import cleaning as C
from mailloom.operators import addresses as A
from mailloom.operators import index as X
from mailloom.sources.sinks import merge_rows

from .fixtures import EDGES, MAIL, at, mail, table
from .registry import query

FILES = f"""{MAIL}, files AS (
  SELECT addr, id AS email_id, datetime, a.guid AS guid, a.extension AS extension, a.filename AS filename
  FROM (SELECT senders[1] AS addr, id, datetime, unnest(attachments) AS a FROM mail WHERE len(senders) > 0))"""


def _files(spark, sf_dir):
    return A.sender_attachments(mail(spark, sf_dir))


@query(
    """SELECT l_orderkey AS id, arg_max(l_partkey, v) AS l_partkey, arg_max(l_suppkey, v) AS l_suppkey
    FROM (SELECT *, strftime(l_shipdate, '%Y%m%d') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') ||
        lpad(CAST(l_partkey AS VARCHAR), 12, '0') || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS v FROM lineitem)
    GROUP BY l_orderkey"""
)
def latest_by_id(spark, sf_dir):
    version = F.concat(
        F.date_format("l_shipdate", "yyyyMMdd"),
        *[F.lpad(F.col(c).cast("string"), n, "0") for c, n in (("l_linenumber", 3), ("l_partkey", 12), ("l_suppkey", 12))],
    )
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_partkey", "l_suppkey", version.alias("v")
    )
    return X.latest_by_id(rows, "id", F.col("v")).drop("v")


@query(
    """WITH stored AS (SELECT doc_id AS id, CASE WHEN doc_id % 7 <> 0 THEN doc_id % 10 END AS version, 'old ' || md5(text) AS value, 0 AS new FROM documents),
    incoming AS (
      SELECT doc_id + k AS id, CASE WHEN doc_id % 5 <> 0 THEN (doc_id + 3 * k) % 11 END AS version, 'new ' || k || md5(text) AS value, 1 AS new
      FROM documents, range(0, 3) copies(k) WHERE doc_id % 3 <> 1)
    SELECT id, version, value FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY version IS NOT NULL DESC, version DESC, new DESC, value DESC) AS place
      FROM (SELECT * FROM stored UNION ALL SELECT * FROM incoming)) WHERE place = 1"""
)
def index_merge(spark, sf_dir):
    """Several rows of an id on both sides, with higher, lower, equal and missing versions."""
    docs = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    stored = docs.select(i.alias("id"), F.when(i % 7 != 0, i % 10).alias("version"), F.concat(F.lit("old "), F.md5("text")).alias("value"))
    copies = docs.where(i % 3 != 1).select(i, "text", F.explode(F.array(*(F.lit(k) for k in range(3)))).alias("k"))
    incoming = copies.select(
        (i + F.col("k")).alias("id"),
        F.when(i % 5 != 0, (i + 3 * F.col("k")) % 11).alias("version"),
        F.concat(F.lit("new "), F.col("k").cast("string"), F.md5("text")).alias("value"),
    )
    return merge_rows(stored, incoming, ["id"], "version")


@query(
    f"""WITH {MAIL} SELECT id, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS sent_at, array_to_string(senders, ',') AS senders,
      CAST(NULL AS VARCHAR) AS subject, {len(schemas.EMAIL_INDEX.fields)} AS n_columns FROM mail"""
)
def index_projection(spark, sf_dir):
    rows = X.to_schema(mail(spark, sf_dir).drop("attachments"), "emails")
    return rows.select(
        "id", at("datetime").alias("sent_at"), F.array_join("senders", ",").alias("senders"), "subject",
        F.lit(len(rows.columns)).alias("n_columns"),
    )


@query(
    f"""WITH {MAIL} SELECT id, CASE WHEN quantity > 25 THEN quantity % 2 = 0 ELSE FALSE END AS starred,
      (SELECT string_agg(a, ',' ORDER BY a) FROM (SELECT DISTINCT unnest(senders || tos || ccs || bccs) AS a)) AS addrs
    FROM mail"""
)
def all_addresses(spark, sf_dir):
    none = F.array().cast("array<string>")
    emails = mail(spark, sf_dir).withColumns(
        {"delivered_to": none, "starred": F.when(F.col("quantity") > 25, F.col("quantity") % 2 == 0)}
    )
    joined = F.array_join(F.sort_array(X.all_addresses()), ",")
    return emails.select(
        "id", C.null_default(F.col("starred")).alias("starred"),
        F.when(F.size(X.all_addresses()) > 0, joined).alias("addrs"),
    )


@query(
    f"""WITH {EDGES} SELECT addr, regexp_replace(addr, '.*@', '') AS domain,
      array_to_string(list_filter(string_split_regex(lower(regexp_replace(addr, '.*@', '')), '[^\\p{{L}}\\p{{N}}_.]+'), lambda w: w <> ''), ' ') AS words
    FROM (SELECT DISTINCT regexp_replace(addr, '[.]example$', '-Unit b.Example') AS addr FROM people)"""
)
def address_domains(spark, sf_dir):
    """Addresses with a domain of several words."""
    several = F.regexp_replace("addr", "[.]example$", "-Unit b.Example").alias("addr")
    people = A.participants(mail(spark, sf_dir)).select(several).distinct()
    return people.select(
        "addr", C.domain(F.col("addr")).alias("domain"), F.array_join(C.domain_words(F.col("addr")), " ").alias("words")
    )


@query(f"WITH {FILES} SELECT DISTINCT addr FROM files WHERE extension = '.pdf'")
def addresses_with_extension(spark, sf_dir):
    return X.addresses_with_extension(_files(spark, sf_dir), ".pdf")


HITS = f"""{FILES}, matching AS (
  SELECT *, row_number() OVER (PARTITION BY addr ORDER BY datetime ASC NULLS LAST, guid) AS place FROM files
  WHERE extension = '.pdf' AND datetime BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31')"""


def _hits(spark, sf_dir, limit):
    return X.attachments_of(
        _files(spark, sf_dir), extension=".pdf", dates=("1996-01-01", "2000-12-31"), limit=limit
    )


@query(f"WITH {HITS} SELECT addr, email_id, guid, filename FROM matching WHERE place <= 3")
def nested_attachments(spark, sf_dir):
    return _hits(spark, sf_dir, 3).select("addr", "email_id", "guid", "filename")


@query(
    f"""WITH {HITS} SELECT addr, guid, filename, strftime(datetime, '%Y-%m-%d') AS sent_on, md5(guid) AS data
    FROM matching"""
)
def attachment_export(spark, sf_dir):
    """Every matching attachment with its binary, looked up by guid."""
    binaries = mail(spark, sf_dir).select(F.explode("attachments").alias("a")).select(
        "a.guid", F.base64(F.col("a.guid").cast("binary")).alias("contents64")
    )
    rows = X.export_rows(_hits(spark, sf_dir, None), binaries)
    return rows.select(
        "addr", "guid", "filename", F.date_format("datetime", "yyyy-MM-dd").alias("sent_on"), F.md5("data").alias("data")
    )


def _wanted(spark, sf_dir):
    """Ids of mails to the busiest list, and some ids no mail has."""
    return mail(spark, sf_dir).where(F.array_contains("bccs", "list.7@lists.example")).select("id").union(
        table(spark, sf_dir, "orders").select(F.concat(F.lit("none-"), F.col("o_orderkey").cast("string")))
    )


@query(
    f"""WITH {MAIL} SELECT id, CAST(len(attachments) AS INTEGER) AS n, quantity FROM mail
    WHERE list_contains(bccs, 'list.7@lists.example')"""
)
def emails_by_id(spark, sf_dir):
    rows = X.emails_by_id(mail(spark, sf_dir), _wanted(spark, sf_dir))
    return rows.select("id", F.size("attachments").alias("n"), "quantity")


@query(
    f"""WITH {MAIL} SELECT id, a.guid AS guid, a.filename AS filename FROM (
      SELECT id, unnest(attachments) AS a FROM mail WHERE list_contains(bccs, 'list.7@lists.example'))"""
)
def attachments_by_email(spark, sf_dir):
    from mailloom.operators.attachments import to_attachments

    rows = X.attachments_by_email(to_attachments(mail(spark, sf_dir)), _wanted(spark, sf_dir))
    return rows.select("id", "guid", "filename")


@query(
    f"""WITH {MAIL} SELECT a.guid AS guid, a.filename AS filename, md5(a.filename) AS data FROM (
      SELECT unnest(attachments) AS a FROM mail) WHERE a.extension = '.txt'"""
)
def attachments_by_guid(spark, sf_dir):
    files = mail(spark, sf_dir).select(F.explode("attachments").alias("a")).select(
        "a.guid", "a.filename", "a.extension", F.base64(F.col("a.filename").cast("binary")).alias("contents64")
    )
    wanted = files.where(F.col("extension") == ".txt").select("guid").union(
        table(spark, sf_dir, "nation").select(F.col("n_name"))
    )
    return X.attachments_by_guid(files, wanted).select("guid", "filename", F.md5("data").alias("data"))
