"""Attachment extraction, merges, splits and image positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom import schemas
from mailloom.operators import attachments as A
from mailloom.operators import language as L

from .fixtures import MAIL, docs, mail, table
from .registry import query
from .text import lang_sql


def page_mail(spark, sf_dir):
    """One mail per page: the page, its address as text, and on some an unreadable or sealed file."""

    def file(n, extension, content_type, data):
        return F.struct(
            F.md5(F.concat_ws("/", F.lit(n), "page_id")).alias("guid"),
            F.lit(extension).alias("extension"),
            F.concat(F.lit("page"), F.lit(extension)).alias("filename"),
            F.lit(content_type).alias("content_type"),
            F.base64(F.encode(data, "UTF-8")).alias("contents64"),
        )

    files = F.array(
        file("a", ".html", "text/html", F.col("html")),
        file("b", ".TXT", "text/plain", F.col("url")),
        F.when(F.col("page_id") % 5 == 0, file("c", ".bin", "application/octet-stream", F.col("url"))),
        F.when(F.col("page_id") % 7 == 0, file("d", ".p7m", "application/pkcs7-mime", F.col("url"))),
        file("e", ".txt", "text/plain", F.lit("")),
    )
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.filter(files, lambda f: f.isNotNull()).alias("attachments"),
    )


HTML_SQL = r"""trim(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '<!--.*?-->', ' ', 'gs'), '<script\b.*?</script\s*>', ' ', 'gis'), '<style\b.*?</style\s*>', ' ', 'gis'),
      '<(?:br|p|div|li|tr|h[1-6]|title|table|ul|ol)\b[^>]*>', chr(10), 'gi'), '<[^>]*>', ' ', 'gs'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
  '[ \t\r]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))"""

EXTRACTED = f"""extracted AS (
  SELECT 'p' || page_id AS id, md5('a/' || page_id) AS guid, {HTML_SQL} AS content, html AS raw, FALSE AS sealed, '.html' AS ext FROM pages
  UNION ALL SELECT 'p' || page_id, md5('b/' || page_id), url, url, FALSE, '.txt' FROM pages
  UNION ALL SELECT 'p' || page_id, md5('d/' || page_id), NULL, url, TRUE, '.p7m' FROM pages WHERE page_id % 7 = 0)"""
EXTRACTED_COLUMNS = """id, guid, md5(content) AS content, CAST(coalesce(length(content), 0) AS BIGINT) AS content_length,
  sealed AS content_encrypted, NOT sealed AS content_extracted, sha256(encode(raw)) AS content_hash,
  CAST(octet_length(encode(raw)) AS BIGINT) AS size"""


def _entries(sidecar):
    rows = sidecar.select("id", F.explode("attachments").alias("a"))
    return rows.select(
        "id", "a.guid", F.md5("a.content").alias("content"), "a.content_length", "a.content_encrypted",
        "a.content_extracted", "a.content_hash", "a.size",
    )


@query(f"WITH {EXTRACTED} SELECT {EXTRACTED_COLUMNS} FROM extracted")
def attachment_text(spark, sf_dir):
    return _entries(A.extract_text(page_mail(spark, sf_dir)))


@query(f"WITH {EXTRACTED} SELECT {EXTRACTED_COLUMNS} FROM extracted WHERE ext IN ('.html', '.txt')")
def attachment_text_by_extension(spark, sf_dir):
    return _entries(A.extract_text(page_mail(spark, sf_dir), A.TEXT_EXTENSIONS))


@query(
    f"""WITH {EXTRACTED}, texts AS (SELECT guid AS id, content AS body, 0 AS half FROM extracted WHERE content IS NOT NULL), {lang_sql(least=1)}
    SELECT extracted.id, extracted.guid, CASE WHEN lang IS NULL OR gap < n * 20000 THEN 'UNKNOWN' ELSE lang END AS lang
    FROM extracted LEFT JOIN (SELECT id AS guid, lang, gap, n FROM ordered WHERE place = 1) USING (guid)"""
)
def attachment_language(spark, sf_dir):
    sidecar = A.extract_text(page_mail(spark, sf_dir))
    texts = sidecar.select(F.explode("attachments").alias("a")).select(
        F.col("a.guid").alias("id"), F.col("a.content").alias("body")
    )
    # every trigram of the corpus counts
    profile = L.train_profile(docs(spark, sf_dir).select("lang", "body"))
    languages = L.detect_language(
        texts.where(F.col("body").isNotNull()), profile, unsure="UNKNOWN", margin=0.02
    )
    filled = A.set_content_language(sidecar, languages.withColumnRenamed("id", "guid"))
    rows = filled.select("id", F.explode("attachments").alias("a"))
    return rows.select("id", "a.guid", F.col("a.content_tika_langid").alias("lang"))


# ---- merges -----------------------------------------------------------------------------------


def _text_sidecar(spark, sf_dir):
    """For most mails: a text for the first attachment twice (the later wins) and one unknown guid."""

    def entry(guid, content, extracted):
        return F.struct(
            guid.alias("guid"), content.alias("content"), F.lit(extracted).alias("content_extracted"),
            F.lit(False).alias("content_encrypted"), F.col("quantity").alias("content_length"),
        )

    first = F.md5(F.concat("id", F.lit("/0")))
    return mail(spark, sf_dir).where(F.col("quantity") > 10).select(
        "id",
        F.array(
            entry(first, F.concat(F.lit("old "), "id"), False),
            entry(F.lit("unknown"), F.lit("nobody's"), True),
            entry(first, F.when(F.col("quantity") % 2 == 0, F.concat(F.lit("new "), "id")), True),
        ).alias("attachments"),
    )


def _image_sidecar(spark, sf_dir):
    seen = F.struct(
        F.lit(True).alias("human_detected"), F.lit(False).alias("receipt_detected"),
        F.when(F.col("quantity") % 3 == 0, F.concat(F.lit("ocr "), "id")).alias("ocr_output"),
    )
    return mail(spark, sf_dir).where(F.col("quantity") > 30).select(
        "id", F.array(F.struct(F.md5(F.concat("id", F.lit("/0"))).alias("guid"), seen.alias("image_analytics"))).alias("attachments")
    )


MERGED = f"""{MAIL}, files AS (
  SELECT id, quantity, line, unnest(attachments) AS a, unnest(range(0, len(attachments))) AS place FROM mail),
  merged AS (
  SELECT id, quantity, a.guid AS guid, a.filename AS filename, place,
    CASE WHEN place > 0 OR quantity <= 10 THEN a.content WHEN quantity % 2 = 0 THEN 'new ' || id ELSE 'old ' || id END AS content,
    CASE WHEN place = 0 AND quantity > 10 THEN TRUE END AS content_extracted,
    CASE WHEN place = 0 AND quantity > 10 THEN FALSE END AS content_encrypted,
    CASE WHEN place = 0 AND quantity > 10 THEN quantity END AS content_length,
    CASE WHEN place = 0 AND quantity > 30 THEN TRUE END AS human_detected,
    CASE WHEN place = 0 AND quantity > 30 AND quantity % 3 = 0 THEN 'ocr ' || id END AS ocr_output
  FROM files)"""


@query(
    f"""WITH {MERGED} SELECT id, guid, filename, content, content_extracted, content_encrypted, content_length FROM merged"""
)
def sidecar_merge(spark, sf_dir):
    rows = A.merge_sidecar(mail(spark, sf_dir), _text_sidecar(spark, sf_dir)).select("id", F.explode("attachments").alias("a"))
    return rows.select("id", *[f"a.{c}" for c in ("guid", "filename", "content", "content_extracted", "content_encrypted", "content_length")])


@query(f"""WITH {MERGED} SELECT id, guid, content, content_extracted, content_encrypted FROM merged""")
def sidecar_merge_fields(spark, sf_dir):
    merged = A.merge_sidecar(mail(spark, sf_dir), _text_sidecar(spark, sf_dir), fields=A.LEGACY_FIELDS)
    rows = merged.select("id", F.explode("attachments").alias("a"))
    return rows.select("id", *[f"a.{c}" for c in ("guid", "content", "content_extracted", "content_encrypted")])


@query(f"""WITH {MERGED} SELECT id, guid, content, content_length, human_detected, ocr_output FROM merged""")
def sidecar_merge_chain(spark, sf_dir):
    merged = A.merge_sidecars(mail(spark, sf_dir), _text_sidecar(spark, sf_dir), _image_sidecar(spark, sf_dir))
    rows = merged.select("id", F.explode("attachments").alias("a"))
    return rows.select(
        "id", "a.guid", "a.content", "a.content_length",
        F.col("a.image_analytics.human_detected").alias("human_detected"),
        F.col("a.image_analytics.ocr_output").alias("ocr_output"),
    )


@query(
    f"""WITH {MERGED} SELECT mail.id, CASE
        WHEN mail.line % 2 = 0 OR mail.quantity <= 10 THEN 'body ' || mail.id
        ELSE coalesce(ocr_output, content) END AS body
    FROM mail LEFT JOIN (SELECT * FROM merged WHERE place = 0) USING (id)"""
)
def document_bodies(spark, sf_dir):
    emails = mail(spark, sf_dir).withColumn("body", F.concat(F.lit("body "), "id"))
    merged = A.merge_sidecars(
        emails, _text_sidecar(spark, sf_dir), _image_sidecar(spark, sf_dir), documents=True
    )
    return merged.select("id", "body")


@query(
    """SELECT 'p' || page_id AS id, CAST(3 + CAST(page_id % 5 = 0 AS INTEGER) + CAST(page_id % 7 = 0 AS INTEGER) AS INTEGER) AS n,
      'guid,extension,filename,content_type' AS fields FROM pages"""
)
def stripped_binaries(spark, sf_dir):
    rows = A.strip_binaries(page_mail(spark, sf_dir))
    fields = ",".join(f.name for f in rows.schema["attachments"].dataType.elementType.fields)
    return rows.select("id", F.size("attachments").alias("n"), F.lit(fields).alias("fields"))


@query(
    f"""WITH {MAIL} SELECT id, strftime(datetime, '%Y-%m-%d') AS sent_on, a.guid AS guid, a.extension AS extension, a.filename AS filename,
      a.content AS content, 'case' AS case_id FROM (SELECT id, datetime, unnest(attachments) AS a FROM mail)"""
)
def attachment_rows(spark, sf_dir):
    rows = A.to_attachments(mail(spark, sf_dir).withColumn("case_id", F.lit("case")))
    return rows.select(
        "id", F.date_format("datetime", "yyyy-MM-dd").alias("sent_on"), "guid", "extension", "filename", "content", "case_id"
    )


@query(
    """WITH tags AS (
      SELECT s_suppkey AS id, s_suppkey % 4 AS kind, s_suppkey % 100 + (s_suppkey % 60) / 60.0 + (s_suppkey * 7 % 6000) / 100.0 / 3600 AS lat,
        s_suppkey * 3 % 200 + (s_suppkey * 11 % 120) / 2.0 / 60 + (s_suppkey % 60) / 3600.0 AS lon FROM supplier)
    SELECT id, round(CASE WHEN lat > 90 THEN 0 WHEN id % 2 = 0 THEN lat ELSE -lat END, 6) AS lat,
      round(CASE WHEN lon > 180 THEN 0 WHEN id % 3 = 0 THEN lon ELSE -lon END, 6) AS lon
    FROM tags WHERE kind < 3 AND id % 13 <> 0"""
)
def image_positions(spark, sf_dir):
    k = F.col("s_suppkey")
    tags = table(spark, sf_dir, "supplier").select(
        k.alias("id"),
        F.element_at(F.array(F.lit(".jpg"), F.lit(".JPEG"), F.lit("jpg"), F.lit(".png")), (k % 4 + 1).cast("int")).alias("extension"),
        F.when(k % 2 == 0, F.lit("N")).otherwise(F.lit("S")).alias("latref"),
        F.when(k % 3 == 0, F.lit("E")).otherwise(F.lit("W")).alias("lonref"),
        F.lit("0").alias("altref"),
        F.when(k % 13 != 0, F.concat_ws(",", k % 100, k % 60, F.concat((k * 7 % 6000).cast("string"), F.lit("/100")))).alias("lat_dms"),
        F.concat_ws(",", k * 3 % 200, F.concat((k * 11 % 120).cast("string"), F.lit("/2")), k % 60).alias("lon_dms"),
        F.lit("12").alias("alt"),
    )
    rows = A.gps_from_tags(tags).where(F.col("gps").isNotNull())
    return rows.select("id", F.round("gps.coord.lat", 6).alias("lat"), F.round("gps.coord.lon", 6).alias("lon"))
