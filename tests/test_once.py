"""Work that a row needs once is done once."""

from pyspark.sql import functions as F

from mailloom.operators import addresses, attachments, language, terms
from mailloom.sources import records
from workloads import fixtures


def analyzed(df):
    """The whole text of the plan as written, nothing shortened."""
    for name in ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields", "spark.sql.maxPlanStringLength"):
        df.sparkSession.conf.set(name, "1000000")
    return df._jdf.queryExecution().analyzed().toString()


MAILS = "id string, body string, attachments array<struct<guid:string,content:string,name:string>>"
SIDE = "id string, attachments array<struct<guid:string,content:string,pages:int,kind:string>>"


def test_sidecar_entries_are_looked_up_once_for_all_fields(spark):
    mails = spark.createDataFrame(
        [
            ("1", "b1", [("g", "old", "n1"), ("h", "keep", "n2"), ("g", "twin", "n3"), (None, "none", "n4")]),
            ("2", "b2", [("g", "alone", "n")]),
            ("3", "b3", None),
            ("4", "b4", []),
        ],
        MAILS,
    )
    side = spark.createDataFrame(
        [
            ("1", [("g", "first", 1, "x"), ("z", "nobody's", 9, "z"), ("g", None, 2, None), (None, "void", 5, "v"), ("h", None, None, "y")]),
            ("3", [("g", "c", 1, "k")]),
            ("4", None),
        ],
        SIDE,
    )
    merged = attachments.merge_sidecar(mails, side, documents=True)
    rows = {r.id: (r.body, r.attachments and [tuple(a) for a in r.attachments]) for r in merged.collect()}
    assert rows == {
        # a later value wins, a later null does not; a second attachment of a guid and one without stay as they are
        "1": ("keep", [("g", "first", "n1", 2, "x"), ("h", "keep", "n2", None, "y"), ("g", "twin", "n3", None, None), (None, "none", "n4", None, None)]),
        "2": ("b2", [("g", "alone", "n", None, None)]),
        "3": ("b3", None),
        "4": ("b4", []),
    }
    # before, the place of the attachment was sought and the entries were filtered twice for each field
    assert analyzed(attachments.merge_sidecar(mails, side)).count("array_position") == 1


def test_terms_and_trigrams_stay_where_their_text_is(spark):
    docs = spark.createDataFrame(
        [("1", "alpha beta"), ("1", "beta gamma"), ("2", None), (None, "alpha"), (None, "alpha"), ("3", "")], "id string, body string"
    )
    counts = {(r.id, r.term): r.n for r in terms.term_counts(docs).collect()}
    assert counts == {("1", "alpha"): 1, ("1", "beta"): 2, ("1", "gamma"): 1, (None, "alpha"): 2}
    grams = {(r.id, r.gram): r.n for r in terms.trigram_vectors(docs).collect()}
    assert grams[("1", "bet")] == 2 and grams[(None, "pha")] == 2 and sum(grams.values()) == 16
    for df in (terms.term_counts(docs), terms.trigram_vectors(docs)):
        # before, a row for each term or trigram of a text was shuffled
        physical = df._jdf.queryExecution().executedPlan().toString()
        assert physical.count("Exchange hashpartitioning(id#") == 1 == physical.count("Exchange ")


def test_address_history_reads_a_mail_once(spark):
    file = [("g2", "b", "secret"), ("g1", "a", "secret")]
    mails = spark.createDataFrame(
        [("m2", "2024-01-05", ["a", "x"], ["b", "b", ""], file), ("m1", "2024-01-09", ["a"], ["a"], None), ("m3", "", ["", "a"], ["b"], file)],
        "id string, datetime string, senders array<string>, tos array<string>, attachments array<struct<guid:string,filename:string,content:string>>",
    ).withColumns({"ccs": F.lit(None).cast("array<string>"), "bccs": F.lit(None).cast("array<string>")})
    history = addresses.address_history(mails)
    rows = {(r.addr, str(r.month)[:7]): tuple([tuple(e) for e in r[c]] for c in ("sender", "recepient", "sender_attachments")) for r in history.collect()}
    m1, m2 = ("m1", "2024-01-09"), ("m2", "2024-01-05")
    assert rows == {
        ("a", "2024-01"): ([m1, m2], [m1], [(*m2, "g1", "a"), (*m2, "g2", "b")]),
        ("b", "2024-01"): ([], [m2], []),
        ("b", "None"): ([], [("m3", None)], []),
    }
    # before, the mails were read a second time for their files
    physical = addresses.address_history(fixtures.mail(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert physical.count("FileScan") == 1


def test_sidecar_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([('1\t[{"guid":"g","content":"c"}]',), ("2\t[{",), (None,), ("3\t[]",), ("4\tnull",), ("\t[]",), ("5",)], "value string")
    good, bad = records.split_sidecar(lines)
    assert [(r.id, r.attachments and [a.guid for a in r.attachments]) for r in good.collect()] == [("1", ["g"]), ("3", []), ("4", None), ("", [])]
    assert good.columns == ["id", "attachments"] and bad.where("value IS NOT NULL").count() == 2
    made = spark.range(3).select(F.concat("id", F.lit("\t"), F.to_json(F.array(F.struct("id")))).alias("value"))
    rows = records.parse_sidecar(made).select("id", F.explode("attachments"))
    # before, a line was made and parsed once for the filter and again for the columns
    assert "from_json(" in analyzed(rows)
    optimized = rows._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("StructsToJsonEvaluator") == 1 == optimized.count("from_json(")


def test_punctuation_is_peeled_with_each_pattern_once(spark):
    words = ["(e.g.,", "...", "U.S.!", "'em", "\"(x)\"", "a", "-", "mr.).", "¿qué?"]
    rows = spark.createDataFrame([(" ".join(words),)], "t string").select(language.text_pieces(F.col("t")).alias("p"))
    assert "".join(rows.first().p) == " ".join(words)
    # before, eight searches a word
    assert analyzed(rows).count("regexp_extract(") == 3


def test_a_long_text_is_translated_from_one_dictionary(spark):
    lexicon = spark.createDataFrame([("xx", f"w{i}", f"t{i}") for i in range(0, 6000, 2)], "lang string, word string, translation string")
    text = " ".join(f"W{i}," for i in range(6000))
    done = language.translate_fields(spark.createDataFrame([("1", "xx", text, None)], "id string, lang string, a string, b string"), ["a", "b"], lexicon).first()
    assert done.a_translated == " ".join(f"t{i}," if i % 2 == 0 else f"W{i}," for i in range(6000)) and done.b_translated is None
