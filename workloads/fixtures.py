"""Mail-shaped views of the driver tables, once for Spark and once as DuckDB text.

Every view is row-local: one table row becomes one mail, so no group is ever gathered to build it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


# ---- mail: one message per line item ----------------------------------------------------------


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyyMMdd')) AS id",
        "CASE WHEN l_quantity <> 13 THEN cast(l_shipdate AS timestamp) END AS datetime",
        """CASE WHEN l_orderkey % 97 = 0 THEN array(concat('solo.', l_orderkey, '@lost.example'))
                WHEN l_orderkey % 89 = 0 THEN cast(array() AS array<string>)
                ELSE array(concat('buyer.', l_partkey, '@', lower(l_returnflag), '.example'), 'copy@desk.example')
           END AS senders""",
        """CASE WHEN l_orderkey % 97 = 0 THEN cast(array() AS array<string>)
                WHEN l_linenumber % 2 = 0 THEN array(concat('supplier.', l_suppkey, '@supplier.example'),
                                                     concat('supplier.', l_suppkey, '@supplier.example'))
                ELSE array(concat('supplier.', l_suppkey, '@supplier.example')) END AS tos""",
        """CASE WHEN l_orderkey % 97 <> 0 AND l_linenumber >= 3
                THEN array(concat('buyer.', l_partkey, '@', lower(l_linestatus), '.example'), '')
                ELSE cast(array() AS array<string>) END AS ccs""",
        """CASE WHEN l_orderkey % 97 <> 0 AND l_linenumber >= 5
                THEN array(concat('list.', l_linenumber, '@lists.example'),
                           concat('Supplier.', l_suppkey, '@supplier.example'))
                ELSE cast(array() AS array<string>) END AS bccs""",
        "l_orderkey AS order_key",
        "l_linenumber AS line",
        "cast(l_quantity AS bigint) AS quantity",
        "CASE l_returnflag WHEN 'A' THEN '.jpg' WHEN 'N' THEN '.pdf' ELSE '.xls' END AS ext",
        # columns of their own, so that reading several fields of a file computes them once
    ).selectExpr(
        "*",
        "md5(concat(id, '/0')) AS guid0",
        "md5(concat(id, '/1')) AS guid1",
        "concat('file', line, ext) AS name0",
    ).selectExpr(
        "id", "datetime", "senders", "tos", "ccs", "bccs", "order_key", "line", "quantity", "ext",
        """CASE WHEN line % 2 = 1 AND quantity > 40 THEN array(
             named_struct('guid', guid0, 'extension', ext, 'filename', name0, 'filesize', quantity * 1000,
                          'content', concat('text of ', id)),
             named_struct('guid', guid1, 'extension', '.txt', 'filename', 'notes.txt', 'filesize', quantity,
                          'content', concat('notes of ', id)))
           WHEN line % 2 = 1 THEN array(
             named_struct('guid', guid0, 'extension', ext, 'filename', name0, 'filesize', quantity * 1000,
                          'content', concat('text of ', id)))
           ELSE cast(array() AS array<struct<guid:string,extension:string,filename:string,filesize:bigint,content:string>>)
           END AS attachments""",
    )


MAIL = """mail AS (
  SELECT *, CASE WHEN line % 2 = 1 THEN
      CASE WHEN quantity > 40
        THEN [{'guid': md5(id || '/0'), 'extension': ext, 'filename': 'file' || line || ext,
               'filesize': quantity * 1000, 'content': 'text of ' || id},
              {'guid': md5(id || '/1'), 'extension': '.txt', 'filename': 'notes.txt',
               'filesize': quantity, 'content': 'notes of ' || id}]
        ELSE [{'guid': md5(id || '/0'), 'extension': ext, 'filename': 'file' || line || ext,
               'filesize': quantity * 1000, 'content': 'text of ' || id}] END
      ELSE [] END AS attachments
  FROM (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS id,
      CASE WHEN l_quantity <> 13 THEN l_shipdate END AS datetime,
      CASE WHEN l_orderkey % 97 = 0 THEN ['solo.' || l_orderkey || '@lost.example']
           WHEN l_orderkey % 89 = 0 THEN []::VARCHAR[]
           ELSE ['buyer.' || l_partkey || '@' || lower(l_returnflag) || '.example', 'copy@desk.example'] END AS senders,
      CASE WHEN l_orderkey % 97 = 0 THEN []::VARCHAR[]
           WHEN l_linenumber % 2 = 0 THEN ['supplier.' || l_suppkey || '@supplier.example',
                                           'supplier.' || l_suppkey || '@supplier.example']
           ELSE ['supplier.' || l_suppkey || '@supplier.example'] END AS tos,
      CASE WHEN l_orderkey % 97 <> 0 AND l_linenumber >= 3
           THEN ['buyer.' || l_partkey || '@' || lower(l_linestatus) || '.example', '']
           ELSE []::VARCHAR[] END AS ccs,
      CASE WHEN l_orderkey % 97 <> 0 AND l_linenumber >= 5
           THEN ['list.' || l_linenumber || '@lists.example', 'Supplier.' || l_suppkey || '@supplier.example']
           ELSE []::VARCHAR[] END AS bccs,
      l_orderkey AS order_key, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS quantity,
      CASE l_returnflag WHEN 'A' THEN '.jpg' WHEN 'N' THEN '.pdf' ELSE '.xls' END AS ext
    FROM lineitem))"""

PEOPLE = (
    MAIL
    + """, people AS (
  SELECT senders[1] AS addr, id AS email_id, datetime, 'sender' AS type, len(attachments) AS n_attachments
  FROM mail WHERE len(senders) > 0 AND senders[1] <> ''
  UNION ALL
  SELECT addr, id, datetime, 'recepient', 0
  FROM (SELECT DISTINCT id, datetime, unnest(tos || ccs || bccs) AS addr FROM mail) WHERE addr <> '')"""
)

EDGES = (
    PEOPLE
    + """, edges AS (
  SELECT s.addr AS src, r.addr AS dst, count(*) AS n
  FROM people s JOIN people r ON s.email_id = r.email_id AND s.type = 'sender' AND r.type = 'recepient'
  GROUP BY 1, 2)"""
)

NODES = (
    EDGES
    + """, nodes AS (
  SELECT addr, row_number() OVER (ORDER BY md5(addr), addr) - 1 AS idx
  FROM (SELECT src AS addr FROM edges UNION SELECT dst FROM edges))"""
)

# a partition to name: everyone at the same domain
COMMUNITIES = (
    NODES
    + """, communities AS (
  SELECT addr, idx,
    first_value(addr) OVER (PARTITION BY regexp_replace(addr, '^.*@', '') ORDER BY idx) AS community,
    first_value(idx) OVER (PARTITION BY regexp_replace(addr, '^.*@', '') ORDER BY idx) AS community_id
  FROM nodes)"""
)


# ---- texts: one message per document ----------------------------------------------------------


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        F.col("text").alias("body"),
        F.substring("text", 1, 40).alias("subject"),
        "lang",
        "doc_id",
    )


DOCS = """docs AS (
  SELECT 'd' || doc_id AS id, text AS body, substr(text, 1, 40) AS subject, lang, doc_id FROM documents)"""
