"""Header, address, date and record parsing over rows written in mail form."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom import schemas
from mailloom.functions import cleaning as C
from mailloom.operators.normalize import ascii_variant, normalize
from mailloom.sources import records as R

from .fixtures import DOCS, MAIL, at, docs, mail, table
from .registry import query


@query(
    """SELECT c_custkey AS id,
      lower(c_name || '@' || c_mktsegment || '.example,' || c_name || '@plain.example,oneil@x.example,' || c_name || '@name.example') AS addrs
    FROM customer"""
)
def header_addresses(spark, sf_dir):
    name = F.col("c_name")
    lines = F.array(
        F.concat(F.lit('"'), name, F.lit(', Buyer" <'), name, F.lit("@"), "c_mktsegment", F.lit(".Example>")),
        F.concat(name, F.lit("@plain.example, undisclosed recipients, O'Neil@x.example (a comment)")),
        F.lit("no address here"),
        F.concat(F.lit('"'), name, F.lit('@name.example" <local>')),
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.array_join(C.addresses_of(lines), ",").alias("addrs")
    )


@query(
    """SELECT s_suppkey AS id, lower(s_name || '@a.example,' || s_name || '@b.example,c@c.example') AS addrs FROM supplier"""
)
def delimited_addresses(spark, sf_dir):
    text = F.concat("s_name", F.lit("@A.example; Someone <"), "s_name", F.lit("@b.example>, c@c.example;"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.array_join(C.split_addresses(text), ",").alias("addrs")
    )


@query(
    """SELECT o_orderkey AS id, strftime(CASE o_orderkey % 7
        WHEN 0 THEN o_orderdate - INTERVAL 2 HOUR WHEN 1 THEN o_orderdate + INTERVAL 5 HOUR + INTERVAL 30 MINUTE
        WHEN 5 THEN TIMESTAMP '2010-01-01 00:00:00' ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS sent_at
    FROM orders"""
)
def utc_dates(spark, sf_dir):
    d = F.col("o_orderdate").cast("timestamp")

    def as_text(fmt, zone=""):
        return F.concat(F.date_format(d, fmt), F.lit(zone))

    kind = F.col("o_orderkey") % 7
    text = (
        F.when(kind == 0, as_text("EEE, d MMM yyyy HH:mm:ss", " +0200 (CEST)"))
        .when(kind == 1, as_text("d MMM yyyy HH:mm:ss", " -0530"))
        .when(kind == 2, as_text("EEE, d  MMM yyyy HH:mm:ss"))
        .when(kind == 3, as_text("yyyy-MM-dd'T'HH:mm:ss", "Z"))
        .when(kind == 4, as_text("EEE MMM d HH:mm:ss yyyy"))
        .when(kind == 5, F.lit("some day"))
        .otherwise(as_text("yyyy-MM-dd"))
    )
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), text.alias("text"))
    return rows.select("id", at(C.to_utc(F.col("text"), "2010-01-01 00:00:00")).alias("sent_at"))


@query(
    r"""SELECT doc_id AS id,
      md5(regexp_replace(regexp_replace(replace(text, chr(10), ''), '[^\x00-\x7F]', ' ', 'g'), '\t', ' ', 'g')) AS message_id,
      md5(regexp_replace(regexp_replace(replace(text, chr(10), ' '), '[^\x00-\x7F]', ' ', 'g'), '\t', ' ', 'g')) AS refs
    FROM documents"""
)
def cleaned_ids(spark, sf_dir):
    return docs(spark, sf_dir).select(
        F.col("doc_id").alias("id"),
        F.md5(C.clean(F.col("body"), C.ID_RULES)).alias("message_id"),
        F.md5(C.clean(F.col("body"), C.REFERENCE_RULES)).alias("refs"),
    )


@query(
    r"""SELECT doc_id AS id,
      md5(regexp_replace(regexp_replace(text, '[^\x00-\x7F]', ' ', 'g'), '[\t\r]', ' ', 'g')) AS body,
      regexp_replace(regexp_replace(substr(text, 1, 40), '[^\x00-\x7F]', ' ', 'g'), '[\t\r]', ' ', 'g') AS subject,
      lower(replace(replace(replace('A & b/' || lang || ' c.TXT', '/', '_'), ' ', '_'), '&', '_')) AS filename
    FROM documents"""
)
def ascii_mail(spark, sf_dir):
    emails = docs(spark, sf_dir).withColumn(
        "attachments",
        F.array(F.struct(F.concat(F.lit("A & b/"), "lang", F.lit(" c.TXT")).alias("filename"), F.lit(".TXT").alias("extension"))),
    )
    rows = ascii_variant(emails)
    return rows.select(
        F.col("doc_id").alias("id"), F.md5("body").alias("body"), "subject", F.get("attachments", F.lit(0))["filename"].alias("filename")
    )


@query(
    r"""SELECT page_id AS id, array_to_string(list_filter(string_split(regexp_replace(url, '^http://|\?.*$', '', 'g'), '/'),
      lambda x: x <> ''), '|') AS categories FROM pages"""
)
def path_categories(spark, sf_dir):
    path = F.regexp_replace(F.regexp_replace("url", r"^http://", "/"), r"\?.*$", "/")
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.array_join(C.path_categories(path), "|").alias("categories")
    )


@query(f"""WITH {MAIL} SELECT id, array_to_string(CASE WHEN len(tos) = 0 THEN senders ELSE tos END, ',') AS tos FROM mail""")
def recipient_fallback(spark, sf_dir):
    """The senders stand in for the Delivered-To list."""
    return mail(spark, sf_dir).select(
        "id", F.array_join(C.fallback_recipients(F.col("tos"), F.col("senders")), ",").alias("tos")
    )


# ---- records ----------------------------------------------------------------------------------


@query(
    f"""WITH {MAIL} SELECT id, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS sent_at, array_to_string(tos, ',') AS tos,
      CAST(len(attachments) AS INTEGER) AS n_attachments FROM mail"""
)
def json_mail(spark, sf_dir):
    """Mail written as JSON lines and read back with the mail schema."""
    out = F.to_json(F.struct("id", "datetime", "senders", "tos", "ccs", "bccs", "attachments"))
    lines = mail(spark, sf_dir).select(out.alias("value"))
    rows = R.parse_json(lines, schemas.EMAIL)
    return rows.select(
        "id", at("datetime").alias("sent_at"), F.array_join("tos", ",").alias("tos"), F.size("attachments").alias("n_attachments")
    )


def _event_lines(spark, sf_dir):
    props = F.when(F.col("event_id") % 10 == 0, F.substr(F.col("props"), F.lit(1), F.length("props") - 1)).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", props.alias("value"))


@query(
    """SELECT event_id, event_id % 10 <> 0 AS good, CASE WHEN event_id % 10 = 0 THEN 'not a JSON record' END AS error FROM events"""
)
def valid_records(spark, sf_dir):
    good, bad = R.split_valid(_event_lines(spark, sf_dir))
    rows = good.withColumn("good", F.lit(True)).unionByName(
        bad.withColumn("good", F.lit(False)), allowMissingColumns=True
    )
    return rows.select("event_id", "good", "error")


@query(
    f"""WITH {MAIL} SELECT id, a.guid AS guid, a.content AS content, CAST(a.filesize AS BIGINT) AS size
    FROM (SELECT id, unnest(attachments) AS a FROM mail)"""
)
def sidecar_lines(spark, sf_dir):
    entries = F.transform(
        "attachments", lambda a: F.struct(a.guid.alias("guid"), a.content.alias("content"), a.filesize.alias("size"))
    )
    lines = mail(spark, sf_dir).select(F.concat("id", F.lit("\t"), F.to_json(entries)).alias("value"))
    rows = R.parse_sidecar(lines).select("id", F.explode("attachments").alias("a"))
    return rows.select("id", "a.guid", "a.content", "a.size")


@query(
    """SELECT CAST(vec_id AS VARCHAR) AS id, CAST(i - 1 AS INTEGER) AS topic, round(CAST(embedding[i] AS DOUBLE), 4) AS score
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""
)
def score_lines(spark, sf_dir):
    scores = F.transform("embedding", lambda v: F.round(v.cast("double"), 4).cast("string"))
    lines = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.concat(F.col("vec_id").cast("string"), F.lit("\t"), F.array_join(scores, " ")).alias("value")
    )
    rows = R.parse_scores(lines)
    return rows.select("id", F.posexplode("scores").alias("topic", "score"))


@query("SELECT p_partkey AS idx, p_name AS term FROM part")
def vocabulary_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select(F.concat_ws("\t", "p_partkey", "p_name").alias("value"))
    return R.parse_vocabulary(lines)


@query(
    f"""WITH {MAIL} SELECT id, 'ingest' AS ingest_id, 'case-' || line AS case_id, 'ref' AS alt_ref_id, 'label' AS label,
      ext || '.mbox' AS artifact_name, 'mbox' AS artifact_type FROM mail"""
)
def provenance(spark, sf_dir):
    rows = R.stamp(
        mail(spark, sf_dir),
        "ingest",
        F.concat(F.lit("case-"), F.col("line").cast("string")),
        "ref",
        "label",
        F.concat("ext", F.lit(".mbox")),
        "mbox",
    )
    return rows.select(
        "id", "ingest_id", "case_id", "alt_ref_id", "label",
        F.col("original_artifact.filename").alias("artifact_name"), F.col("original_artifact.type").alias("artifact_type"),
    )


@query(
    """SELECT c_custkey AS id, n_name || '.mbox' AS filename, 'ingest-' || n_nationkey AS ingest_id, 'case-' || n_regionkey AS case_id,
      CASE WHEN n_nationkey % 2 = 0 THEN 'en' ELSE 'es' END AS language, CASE WHEN n_nationkey % 3 = 0 THEN 'pst' ELSE 'mbox' END AS type
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey <> 7"""
)
def manifest_stamp(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    manifest = nations.where(key != 7).select(
        F.concat(F.lit("/in/"), "n_name", F.lit(".mbox")).alias("filename"),
        F.concat(F.lit("ingest-"), key.cast("string")).alias("ingest_id"),
        F.concat(F.lit("case-"), F.col("n_regionkey").cast("string")).alias("case_id"),
        F.lit("ref").alias("alt_ref_id"),
        F.lit("label").alias("label"),
        F.when(key % 2 == 0, F.lit("en")).otherwise(F.lit("es")).alias("language"),
        F.when(key % 3 == 0, F.lit("pst")).otherwise(F.lit("mbox")).alias("type"),
    )
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"), F.lit(".mbox")).alias("filename"),
    )
    rows = R.stamp_from_manifest(raw, manifest)
    return rows.select("id", "filename", "ingest_id", "case_id", "language", F.col("original_artifact.type").alias("type"))


# ---- MIME messages ----------------------------------------------------------------------------


def raw_messages(spark, sf_dir):
    """A multipart message per document: encoded text, an HTML part, and on some a named file."""
    d = docs(spark, sf_dir)
    n = F.col("doc_id").cast("string")

    def encoded(text):
        return F.base64(F.encode(text, "UTF-8"))

    parts = [
        F.concat(F.lit('From: "Buyer, '), n, F.lit('" <Buyer.'), n, F.lit("@X.Example>")),
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit('To: a@x.example, "O\'B" <o\'b@Y.example>'))),
        F.when(F.col("doc_id") % 3 == 0, F.lit("To: Undisclosed-Recipient:;")),
        F.concat(F.lit("Delivered-To: box"), n, F.lit("@d.example")),
        F.concat(F.lit("Date: Thu, 17 Jun 2010 12:00:00 +0"), (F.col("doc_id") % 10).cast("string"), F.lit("00")),
        # an encoded word is one line, however long Spark's lines of base64 are
        F.concat(F.lit("Subject: =?utf-8?B?"), F.replace(encoded(F.col("subject")), F.lit("\r\n"), F.lit("")), F.lit("?=")),
        F.concat(F.lit("Message-ID: <"), n, F.lit("\t@x>")),
        F.lit('MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="cut"\n\n--cut'),
        F.lit("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n"),
        F.concat(encoded(F.col("body")), F.lit("\n--cut")),
        F.lit("Content-Type: text/html; charset=iso-8859-1\n\n<p>hi</p>\n--cut"),
        F.when(
            F.col("doc_id") % 2 == 0,
            F.concat(
                F.lit('Content-Type: text/csv\nContent-Disposition: attachment; filename="List '),
                n,
                F.lit('.CSV"\nContent-Transfer-Encoding: base64\n\n'),
                encoded(F.col("subject")),
                F.lit("\n--cut"),
            ),
        ),
        F.lit("Content-Type: application/pdf\nContent-Disposition: inline\n\nxyz\n--cut--\n"),
    ]
    return d.select("id", F.encode(F.concat_ws("\n", *parts), "UTF-8").alias("data"))


@query(
    f"""WITH {DOCS} SELECT id, strftime(TIMESTAMP '2010-06-17 12:00:00' - INTERVAL (doc_id % 10) HOUR, '%Y-%m-%d %H:%M:%S') AS sent_at,
      'buyer.' || doc_id || '@x.example' AS senders,
      CASE WHEN doc_id % 3 = 0 THEN 'box' || doc_id || '@d.example' ELSE 'a@x.example,ob@y.example' END AS tos,
      '<' || doc_id || ' @x>' AS message_id, subject,
      md5(body || chr(10) || '=============================Next Part==============================' || chr(10) || '<p>hi</p>') AS body,
      FALSE AS body_as_html, CAST(2 - doc_id % 2 AS INTEGER) AS n_attachments
    FROM docs"""
)
def message_rows(spark, sf_dir):
    emails, _ = normalize(raw_messages(spark, sf_dir), keep_unnamed=True)
    return emails.select(
        "id",
        at("datetime").alias("sent_at"),
        F.array_join("senders", ",").alias("senders"),
        F.array_join("tos", ",").alias("tos"),
        F.array_join("messageid", ",").alias("message_id"),
        "subject",
        F.md5("body").alias("body"),
        "body_as_html",
        F.size("attachments").alias("n_attachments"),
    )


@query(
    f"""WITH {DOCS} SELECT id, 'List ' || doc_id || '.CSV' AS filename, '.csv' AS extension, 'text/csv' AS content_type,
      CAST(octet_length(encode(subject)) AS BIGINT) AS filesize, md5(subject) AS data FROM docs WHERE doc_id % 2 = 0"""
)
def message_attachments(spark, sf_dir):
    emails, _ = normalize(raw_messages(spark, sf_dir), keep_unnamed=False)
    rows = emails.select("id", F.explode("attachments").alias("a"))
    return rows.select(
        "id", "a.filename", "a.extension", "a.content_type", "a.filesize", F.md5(F.unbase64("a.contents64")).alias("data")
    )
