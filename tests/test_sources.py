"""Archives, loose files, sinks and index tables on small generated folders."""

import base64
import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mailloom import schemas
from mailloom.operators import attachments as A
from mailloom.operators.index import require_rows
from mailloom.operators.normalize import normalize
from mailloom.sources import mail, records, sinks

PLAIN = "From: A <A@X.example>\nTo: b@y.example\nDate: Tue, 17 Jun 2010 08:33:51 -0400\nSubject: one\n\nFrom here on\n"
NAIVE = "From: c@x.example\nTo: Undisclosed-Recipient:;\nDelivered-To: d@y.example\nDate: 17 Jun 2010 08:33:51\n\ntwo\n"
UNDATED = "From: e@x.example\nBcc: f@y.example\nContent-Type: text/html\n\n<p>three</p>\n"


@pytest.fixture()
def folder():
    return Path(tempfile.mkdtemp(prefix="mailloom-test-"))


def test_mbox(spark, folder):
    (folder / "in" / "sub dir").mkdir(parents=True)
    separator = "From someone@x.example Thu Jun 17 08:33:51 2010\n"
    text = "".join(separator + m.replace("\nFrom here", "\n>From here") + "\n" for m in (PLAIN, NAIVE, UNDATED))
    (folder / "in" / "sub dir" / "all.mbox").write_text(text)
    (folder / "in" / "other.txt").write_text(text)
    raw = mail.read_mbox(spark, str(folder))
    emails, failures = normalize(raw)
    rows = {r.senders[0]: r for r in emails.collect()}
    assert set(rows) == {"a@x.example", "c@x.example", "e@x.example"}
    assert failures.count() == 0
    first = rows["a@x.example"]
    assert first.categories == ["in", "sub dir"]
    assert str(first.datetime) == "2010-06-17 12:33:51"
    assert first.body.startswith(">From here on")
    assert rows["c@x.example"].tos == ["d@y.example"]
    assert str(rows["c@x.example"].datetime) == "2010-06-17 08:33:51"
    assert rows["e@x.example"].datetime is None and rows["e@x.example"].body_as_html
    assert emails.select("id").distinct().count() == 3


def test_mbox_is_the_same_however_it_is_split(spark, folder):
    separator = "From x@x.example Thu Jun 17 08:33:51 2010\n"
    (folder / "big.mbox").write_text(
        "".join(f"{separator}From: u{i}@x.example\nSubject: s{i}\n\nbody {i} {'é' * (i % 50)}\n\n" for i in range(2000))
    )
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    try:
        found = []
        for size in ("128m", "10k"):
            spark.conf.set(conf, size)
            emails, _ = normalize(mail.read_mbox(spark, str(folder)))
            found.append(sorted((r.subject, r.body, r.id) for r in emails.select("subject", "body", "id").collect()))
    finally:
        spark.conf.set(conf, before)
    assert len(found[0]) == 2000
    assert found[0] == found[1]


def test_eml(spark, folder):
    with pytest.raises(FileNotFoundError):
        mail.read_eml(spark, str(folder))
    (folder / "a").mkdir()
    (folder / "a" / "1.eml").write_text(PLAIN)
    (folder / "2_mime.txt").write_text(NAIVE)
    (folder / "3.txt").write_text(NAIVE)
    raw = mail.read_eml(spark, str(folder))
    stamped = records.stamp(raw, "ingest", "case", "ref", "label", records.base_name(F.col("path")), "eml")
    emails, _ = normalize(stamped)
    rows = {r.original_artifact.filename: r for r in emails.collect()}
    assert set(rows) == {"1.eml", "2_mime.txt"}
    assert rows["1.eml"].categories == ["a"] and rows["1.eml"].case_id == "case"


def test_file_corpus(spark, folder):
    (folder / "docs").mkdir()
    (folder / "docs" / "Page.HTML").write_text("<p>hello</p>")
    (folder / "docs" / "tool.exe").write_text("no")
    (folder / "README").write_text("plain")
    rows = {r.subject: r for r in mail.read_files(spark, str(folder)).collect()}
    assert set(rows) == {"docs/Page.HTML", "README"}
    page = rows["docs/Page.HTML"]
    assert page.tos == ["none"] and page.body == ""
    file = page.attachments[0]
    assert (file.extension, file.content_type, file.filename) == ("html", "text/html", "Page.HTML")
    assert base64.b64decode(file.contents64) == b"<p>hello</p>"
    assert rows["README"].attachments[0].content_type == mail.UNKNOWN_TYPE


def test_files_left_out_are_listed(spark, folder):
    (folder / "tool.exe").write_text("no")
    (folder / "long.txt").write_text("x" * 100)
    (folder / "short.txt").write_text("x")
    assert mail.read_files(spark, str(folder)).count() == 2
    assert [r.subject for r in mail.read_files(spark, str(folder), max_bytes=10).collect()] == ["short.txt"]
    left = mail.skipped_files(spark, str(folder), max_bytes=10).collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.reason) for r in left) == [("long.txt", "size"), ("tool.exe", "extension")]


def test_broken_sidecar_lines_are_set_aside(spark):
    lines = spark.createDataFrame([('1\t[{"guid": "g"}]',), ('2\t[{"guid"',), ("3",)], "value string")
    good, bad = records.split_sidecar(lines)
    assert [r.id for r in good.collect()] == ["1"]
    assert sorted(r.value for r in bad.collect()) == ['2\t[{"guid"', "3"]


def test_file_corpus_text_becomes_the_body(spark, folder):
    (folder / "Page.html").write_text("<p>hello</p>")
    files = mail.read_files(spark, str(folder))
    merged = A.merge_sidecar(files, A.extract_text(files, A.TEXT_EXTENSIONS), documents=True)
    assert merged.first().body == "hello"


def test_invalid_lines_are_set_aside(spark, folder):
    (folder / "part-0").write_text('{"id": "1", "tos": ["a@x.example"]}\n{"id": "2", "tos"\n')
    emails, bad = records.read_valid_emails(spark, str(folder))
    assert [r.id for r in emails.collect()] == ["1"]
    assert bad.count() == 1 and bad.first().error
    good, none = records.split_valid(spark.read.text(str(folder)), enabled=False)
    assert (good.count(), none.count()) == (2, 0)


def test_sidecar_files(spark, folder):
    (folder / "text").write_text('1\t[{"guid": "g", "content": "a\\tb", "size": 3}]\n2\t[{"guid"\n')
    (folder / "image").write_text('1\t[{"guid": "g", "image_analytics": {"human_detected": true}}]\n')
    (folder / "scores").write_text("1\t0.5 0.25\n")
    (folder / "vocabulary").write_text("0\tword\n")
    text = records.read_sidecar(spark, str(folder / "text")).collect()
    assert [(r.id, r.attachments[0].content, r.attachments[0].size) for r in text] == [("1", "a\tb", 3)]
    image = records.read_sidecar(spark, str(folder / "image"), "image").first()
    assert image.attachments[0].image_analytics.human_detected is True
    assert records.read_sidecar(spark, str(folder / "scores"), "scores").first().scores == [0.5, 0.25]
    assert records.read_sidecar(spark, str(folder / "vocabulary"), "vocabulary").first().term == "word"


def test_manifest_file(spark, folder):
    (folder / "m.csv").write_text("/a/b/x.mbox,i1,c1,r1,l1,es,mbox\n")
    raw = spark.createDataFrame([("1", "x.mbox"), ("2", "y.mbox")], "id string, filename string")
    rows = records.stamp_from_manifest(raw, records.read_manifest(spark, str(folder / "m.csv"))).collect()
    assert [(r.id, r.ingest_id, r.language, r.original_artifact.type) for r in rows] == [("1", "i1", "es", "mbox")]


def _emails(spark, rows):
    return spark.createDataFrame(rows, "id string, subject string, ingest_id string")


def test_index_tables(spark, folder):
    root = str(folder / "index")
    sinks.create_index(_emails(spark, [("1", "old", "a"), ("2", "keep", "a"), ("9", "other", "b")]), root, "emails")
    with pytest.raises(Exception, match="already exists"):
        sinks.create_index(_emails(spark, [("1", "x", "a")]), root, "emails")
    sinks.write_index(_emails(spark, [("1", "new", "a"), ("3", "add", "a")]), root, "emails")

    def subjects():
        return {r.id: r.subject for r in sinks.read_index(spark, root, "emails").collect()}

    assert subjects() == {"1": "new", "2": "keep", "3": "add", "9": "other"}
    sinks.export_json(spark, root, "emails", str(folder / "out"), "a")
    sinks.register_dataset(spark, root, "a", "case", "ref", "label")
    sinks.register_dataset(spark, root, "b", "case", "ref", "label")
    sinks.purge(spark, root, "a")
    assert subjects() == {"9": "other"}
    assert [r.ingest_id for r in sinks.read_index(spark, root, "datasets").collect()] == ["b"]
    sinks.import_json(spark, str(folder / "out"), root, "emails")
    assert subjects() == {"1": "new", "2": "keep", "3": "add", "9": "other"}


def test_only_touched_buckets_are_written_again(spark, folder):
    root = str(folder / "index")
    sinks.write_index(_emails(spark, [(str(i), "old", "ab"[i % 2]) for i in range(400)]), root, "emails")

    def files():
        return {p: p.stat().st_mtime_ns for p in (folder / "index" / "emails").rglob("*.parquet")}

    before = files()
    sinks.write_index(_emails(spark, [("2", "new", "a"), ("4", "new", "a"), ("new", "new", "a")]), root, "emails")
    after = files()
    buckets = {p.parent for p in before} - {p.parent for p in before if after.get(p) == before[p]}
    assert 1 <= len(buckets) <= 3 and all("ingest_id=a" in str(b) for b in buckets)
    rows = {(r.ingest_id, r.id): r.subject for r in sinks.read_index(spark, root, "emails").collect()}
    assert len(rows) == 401 and {k for k, v in rows.items() if v == "new"} == {("a", "2"), ("a", "4"), ("a", "new")}


def test_versions_decide_between_rows_of_an_id(spark, folder):
    root = str(folder / "index")

    def load(*rows):
        df = spark.createDataFrame(rows, "id string, subject string, ingest_id string, revision int").repartition(3)
        sinks.write_index(df, root, "emails", F.col("revision"))
        found = sinks.read_index(spark, root, "emails")
        assert "revision" not in found.columns and "_version" not in found.columns
        return {(r.ingest_id, r.id): r.subject for r in found.collect()}

    assert load(("1", "one", "a", 1), ("1", "two", "a", 2), ("1", "other", "b", 0), ("2", "x", None, None)) == {
        ("a", "1"): "two", ("b", "1"): "other", (None, "2"): "x"}
    assert load(("1", "late", "a", 1), ("1", "equal", "b", 0), ("2", "y", None, None)) == {
        ("a", "1"): "two", ("b", "1"): "equal", (None, "2"): "y"}
    assert load(("1", "b", "a", 3), ("1", "a", "a", 3))[("a", "1")] == "b"


def test_index_reads_one_dataset_by_its_folder(spark, folder):
    root = str(folder / "index")
    sinks.write_index(_emails(spark, [("1", "x", "a"), ("2", "y", "b")]), root, "emails")
    plan = sinks.read_index(spark, root, "emails").where("ingest_id = 'a'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingest_id" in plan


def test_topic_map_rows_replace_by_position(spark, folder):
    root = str(folder / "index")
    rows = spark.createDataFrame([(0, [(4, "w", 0.5)])], "idx bigint, topic array<struct<idx:bigint,term:string,score:double>>")
    sinks.write_index(rows, root, "topics")
    assert sinks.read_index(spark, root, "topics").first().topic[0].term == "w"


def test_attachment_files(spark, folder):
    rows = [("g1", ".txt", base64.b64encode(b"one").decode()), ("g2", "", base64.b64encode(b"two").decode())]
    files = spark.createDataFrame(rows, "guid string, extension string, contents64 string")
    sinks.dump_attachments(files, str(folder / "dump"))
    assert {p.name: p.read_bytes() for p in (folder / "dump").iterdir()} == {"g1.txt": b"one", "g2": b"two"}


def test_sized_output_and_csv(spark, folder):
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition(16)
    sinks.write_sized(df, str(folder / "sized"), target_mb=1)
    parts = list((folder / "sized").glob("part-*"))
    assert spark.read.json(str(folder / "sized")).count() == 200_000
    assert len(parts) > 1
    sinks.export_csv(spark.createDataFrame([("a", "b")], "x string, y string"), str(folder / "csv"))
    assert spark.read.csv(str(folder / "csv")).first()[:] == ("a", "b")


def test_empty_output_is_reported(spark):
    with pytest.raises(ValueError, match="empty"):
        require_rows(spark.range(0))
    assert require_rows(spark.range(1)).count() == 1


def test_json_mail_round_trip(spark, folder):
    record = {"id": "1", "datetime": "2010-06-17T12:33:51", "tos": ["a@x.example"], "attachments": [{"guid": "g", "filesize": 3}]}
    (folder / "mail.json").write_text(json.dumps(record) + "\n")
    row = records.read_emails(spark, str(folder / "mail.json")).first()
    assert str(row.datetime) == "2010-06-17 12:33:51" and row.attachments[0].filesize == 3
    assert row.asDict().keys() == {f.name for f in schemas.EMAIL.fields}


def test_exports(spark, folder):
    data = base64.b64encode(b"one").decode()
    hits = spark.createDataFrame(
        [("a", "g1", "n.txt", "2001-01-01", ".txt", data), ("b", "g1", "n.txt", "2001-01-01", ".txt", data)],
        "addr string, guid string, filename string, datetime string, extension string, contents64 string",
    )
    sinks.export_attachments(hits, str(folder / "hits"))
    assert spark.read.csv(str(folder / "hits" / "attachments")).count() == 2
    assert (folder / "hits" / "files" / "g1.txt").read_bytes() == b"one"

    emails = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, subject string")
    files = hits.limit(1).withColumn("id", F.lit("1"))
    sinks.export_emails(emails, files, spark.createDataFrame([("1",), ("7",)], "id string"), str(folder / "mail"))
    assert [r.subject for r in spark.read.json(str(folder / "mail" / "emails")).collect()] == ["x"]
    assert (folder / "mail" / "files" / "g1.txt").exists()

    edges = spark.createDataFrame([("a", "b"), ("a", "b")], "from string, to string")
    sinks.export_edges(edges, str(folder / "edges"))
    assert [tuple(r) for r in spark.read.csv(str(folder / "edges" / "csv")).collect()] == [("a", "b")] * 2
