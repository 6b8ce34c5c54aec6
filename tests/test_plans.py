"""Whole-chain run, and the plans that decide whether a job scales."""

import base64

import pytest
from pyspark.sql import functions as F

from mailloom.operators import addresses as A
from mailloom.operators import amounts, attachments, contents, entities, geo, index, language, numbers, terms
from mailloom.operators.normalize import normalize
from mailloom.plans.ingest import Lookups, enrich, land
from mailloom.runtime import checkpointed
from mailloom.operators.index import to_schema
from mailloom.sources.records import stamp
from workloads import catalog, fixtures, places
from workloads.files import page_mail
from workloads.messages import raw_messages

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    """The whole text of the plan, nothing shortened."""
    for name in ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields", "spark.sql.maxPlanStringLength"):
        df.sparkSession.conf.set(name, "1000000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_local_steps_do_not_shuffle(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("doc_id AS id", "text AS body", "text AS subject")
    assert "Exchange" not in plan(amounts.add_currency(numbers.add_numbers(docs)))
    files = spark.createDataFrame([], "id string, attachments array<struct<guid:string,extension:string,content_type:string,contents64:string>>")
    assert "Exchange" not in plan(attachments.extract_text(files))


def test_scans_read_only_needed_columns(spark):
    people = A.participants(fixtures.mail(spark, SF_DIR))
    text = plan(people.groupBy("addr").count())
    assert "l_tax" not in text and "l_discount" not in text


def test_no_cartesian_or_nested_loop_joins(spark):
    located = geo.email_locations(places.ip_mail(spark, SF_DIR), places.networks(spark))
    assert "NestedLoop" not in plan(located) and "Cartesian" not in plan(located)


def test_first_rows_per_address_are_limited_before_the_shuffle(spark):
    files = A.sender_attachments(fixtures.mail(spark, SF_DIR))
    text = plan(index.attachments_of(files, limit=3))
    assert text.count("WindowGroupLimit") == 2


def test_few_rows_of_a_busy_address_meet(spark):
    """Of 200,000 attachments of one address about twice as many as asked for reach its last window."""
    hot = spark.range(200_000).select(
        F.lit("hot@x").alias("addr"),
        F.when(F.col("id") % 50 != 0, F.timestamp_seconds(F.col("id") * 7919 % 100_003)).alias("datetime"),
        F.md5(F.col("id").cast("string")).alias("guid"),
    )
    small = spark.range(30).select(F.lit("calm@x").alias("addr"), F.lit(None).cast("timestamp").alias("datetime"), F.col("id").cast("string").alias("guid"))
    files = hot.unionByName(small)
    meet = index.below_bound(files, 2000)
    assert meet.columns == files.columns
    counts = {r.addr: r["count"] for r in meet.groupBy("addr").count().collect()}
    assert counts["calm@x"] == 30 and 2000 <= counts["hot@x"] <= 2 * 2000 + 512
    found = index.attachments_of(files.withColumn("extension", F.lit(".x")), addr="hot@x", limit=2000)
    want = hot.orderBy(F.col("datetime").asc_nulls_last(), "guid").limit(2000)
    assert {r.guid for r in found.collect()} == {r.guid for r in want.collect()}
    assert index.attachments_of(files.withColumn("extension", F.lit(".x")), limit=300_000).count() == 200_030


def test_vocabulary_is_a_top_k(spark):
    docs = fixtures.docs(spark, SF_DIR).select("id", "body")
    assert "TakeOrderedAndProject" in plan(terms.vocabulary(docs))


@pytest.mark.parametrize("partitions", [1, 7])
def test_results_do_not_depend_on_partitions(spark, partitions):
    mail = fixtures.mail(spark, SF_DIR)
    shuffled = mail.repartition(partitions).orderBy(F.rand(3))

    def rows(df):
        return sorted(tuple(map(str, r)) for r in df.collect())

    for job in (
        lambda m: A.address_stats(A.participants(m)),
        lambda m: A.node_index(A.weighted_edges(m)),
        lambda m: index.attachments_of(A.sender_attachments(m), limit=2),
        lambda m: index.attachments_of(A.sender_attachments(m), limit=2000),
    ):
        assert rows(job(mail)) == rows(job(shuffled))


def test_forced_language_needs_no_profile(spark):
    docs = spark.createDataFrame([("1", "hola")], "id string, body string")
    assert language.detect_language(docs, force="es").first().lang == "es"
    with pytest.raises(ValueError):
        language.detect_language(docs)


def test_undetectable_language_is_english(spark):
    train = spark.createDataFrame([("en", "the house"), ("es", "la casa")], "lang string, body string")
    profile = language.train_profile(train)
    docs = spark.createDataFrame([("1", "a"), ("2", None), ("3", "casa"), ("4", "house")], "id string, body string")
    found = {r.id: r.lang for r in language.detect_language(docs, profile).collect()}
    assert found == {"1": "en", "2": "en", "3": "es", "4": "en"}


def test_lexicon_translation_cases(spark):
    lexicon = spark.createDataFrame([("es", "casa", "house")], "lang string, word string, translation string")
    rows = [("1", "es", "la  Casa\nblanca"), ("2", "es", "  "), ("3", "fr", "la  casa"), ("4", None, "x")]
    texts = spark.createDataFrame(rows, "id string, lang string, text string")
    found = {r.id: r.translated for r in language.lexicon_translate(texts, lexicon).collect()}
    assert found == {"1": "la  house\nblanca", "2": "", "3": "la  casa", "4": "x"}


def test_words_beside_punctuation_are_translated(spark):
    lexicon = spark.createDataFrame(
        [("es", "casa", "house"), ("es", "casa", "home"), ("es", "u.s.", "ee"), ("es", "null", None)],
        "lang string, word string, translation string",
    )
    long = "la casa, (casa)\n\n" * 900
    rows = [("1", "es", "la casa, (casa)\r\n\u00bfCASA?", "casa"), ("2", "es", None, ""), ("3", "es", long, " \n"),
            ("4", "es", "casas casa-casa u.s., null", None), ("5", None, "casa", "casa")]
    texts = spark.createDataFrame(rows, "id string, lang string, body string, subject string")
    done = language.translate_fields(texts, ["body", "subject"], lexicon)
    found = {r.id: (r.body_translated, r.subject_translated) for r in done.collect()}
    assert found == {
        "1": ("la home, (home)\r\n\u00bfhome?", "home"),
        "2": (None, ""),
        "3": (long.replace("casa", "home"), ""),
        "4": ("casas casa-casa ee, null", None),
        "5": ("casa", "casa"),
    }


def without_broadcast(spark, make):
    """The plan that large tables get."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(make())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_translation_joins_the_lexicon_once(spark):
    docs = fixtures.docs(spark, SF_DIR)
    lexicon = spark.createDataFrame([("es", "casa", "house")], "lang string, word string, translation string")
    text = without_broadcast(spark, lambda: language.route_translation(docs.select("id", "body", "subject"), lexicon, docs.select("id", "lang")))
    lookups = [line for line in text.splitlines() if "SortMergeJoin" in line and "word" in line]
    assert len(lookups) == 1
    assert text.count("SortMergeJoin") <= 4


def test_language_join_sees_distinct_trigrams(spark):
    texts = spark.createDataFrame([("1", "abcabcabc"), ("2", None), ("3", "ab"), ("4", "ABC")], "id string, body string")
    found = {r.id: {g.gram: g.n for g in r.g} for r in texts.select("id", language.gram_counts(F.col("body")).alias("g")).collect()}
    assert found == {"1": {"abc": 3, "bca": 2, "cab": 2}, "2": {}, "3": {}, "4": {"abc": 1}}
    profile = language.train_profile(spark.createDataFrame([("en", "the the the"), ("es", "la la la la")], "lang string, body string"), least=3)
    assert profile.weights.where("gram = 'eth'").count() == 0


def test_entities_are_disjoint(spark):
    phrases = ["New York", "York City", "new york city hall", "City", "one two three four five six seven", "two three", "caf\u00e9 noir", "a"]
    gazetteer = spark.createDataFrame([(p, "MISC", float(i)) for i, p in enumerate(phrases)], "phrase string, tag string, score double")
    texts = [
        ("1", "New York City and York"), ("2", "new York city hall"), ("3", "one two three four"), ("4", "One two three four five six seven."),
        ("5", "Caf\u00e9 noir"), ("6", None), ("7", ""), ("8", "a " * 3000 + "New York"), ("9", "York City, York City"),
    ]
    docs = spark.createDataFrame(texts, "id string, body string")
    found = {}
    for r in entities.match_gazetteer(docs, gazetteer).collect():
        found.setdefault(r.id, []).append((r.start, r.words, r.phrase))
    found = {k: sorted(v) for k, v in found.items()}
    long = found.pop("8")
    assert len(long) == 3001 and long[-1] == (3000, 2, "New York")
    assert found == {
        "1": [(0, 2, "New York"), (2, 1, "City")],
        "2": [(0, 4, "new York city hall")],
        "3": [(1, 2, "two three")],
        "4": [(0, 7, "One two three four five six seven")],
        "5": [(0, 2, "Caf noir")],
        "9": [(0, 2, "York City"), (2, 2, "York City")],
    }
    assert entities.match_gazetteer(docs, gazetteer.limit(0)).count() == 0


def test_only_started_phrases_are_spelled(spark):
    """A phrase of 20 words does not multiply the words of the texts."""
    long = " ".join(f"w{i}" for i in range(20))
    gazetteer = spark.createDataFrame([(long, "MISC", 1.0), ("w0 x", "MISC", 1.0)], "phrase string, tag string, score double")
    body = "other words " * 50 + "w0 other " * 5 + long
    docs = spark.createDataFrame([(str(i), body) for i in range(10)], "id string, body string")
    found = entities.match_gazetteer(docs, gazetteer)
    assert found.count() == 10
    words, started = 10 * (100 + 10 + 20), 10 * 6
    rows = []

    def walk(node):
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node
        node = node.plan() if node.nodeName().endswith("QueryStage") else node
        if node.nodeName() == "Generate":
            rows.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    found.collect()
    walk(found._jdf.queryExecution().executedPlan())
    assert rows and sum(rows) <= words + 3 * started


def test_attachments_translate_on_their_own_language(spark):
    lexicon = spark.createDataFrame([("es", "casa", "house")], "lang string, word string, translation string")
    files = spark.createDataFrame([("g1", "casa"), ("g2", "house")], "guid string, content string")
    spoken = spark.createDataFrame([("g1", "es"), ("g2", "en")], "id string, lang string")
    found = {r.guid: (r.content_lang, r.content_translated) for r in language.translate_attachments(files, lexicon, spoken).collect()}
    assert found == {"g1": ("es", "house"), "g2": (None, None)}


def chain_mails(spark):
    raw = stamp(raw_messages(spark, SF_DIR), "ingest", "case", "ref", "label", F.lit("x.mbox"), "mbox")
    return normalize(raw, keep_unnamed=True)[0]


def test_messages_are_parsed_once_and_bodies_do_not_travel(spark):
    read = attachments.read_attachments(chain_mails(spark))
    assert plan(read).count("MapInPandas") == 1 and "Exchange" not in plan(read)
    landed, light = land(chain_mails(spark))
    assert "MapInPandas" not in plan(landed) + plan(light)
    assert "contents64" in plan(landed.select("attachments")) and "contents64" not in plan(light.select("attachments"))


def test_attachments_are_read_in_the_row_as_by_a_merge(spark):
    mails = page_mail(spark, SF_DIR)
    merged = attachments.merge_sidecar(mails, attachments.extract_text(mails))
    fields = ("guid", "content", "content_length", "content_extracted", "content_encrypted")

    def rows(df):
        return sorted(map(str, df.select("id", F.explode("attachments").alias("a")).select("id", *(f"a.{c}" for c in fields)).collect()))

    assert rows(attachments.read_attachments(mails)) == rows(merged)


@pytest.mark.parametrize("charset, text", [("iso-8859-1", "caf\u00e9 \u00c3\u00a9"), ("windows-1252", "\u20ac \u201cx\u201d"), ("utf-16le", "a\u00e9"), ("x-unknown", "caf\u00e9"), (None, "\u00e9")])
def test_declared_charsets_are_used(spark, charset, text):
    data = text.encode(charset if charset and charset != "x-unknown" else "utf-8")
    row = spark.createDataFrame([(bytearray(data), charset)], "d binary, c string")
    assert row.select(attachments.decoded(F.col("d"), F.col("c")).alias("t")).first().t == text


def test_equal_contents_are_described_once(spark):
    def mail(i, *texts):
        return (i, [(f"g{i}{n}", ".txt", "text/plain", base64.b64encode(t.encode()).decode() if t else t) for n, t in enumerate(texts)])

    mails = spark.createDataFrame(
        [mail("1", "la casa, roja", "the house"), mail("2", "la casa, roja", None), mail("3", "", "la casa, roja")],
        "id string, attachments array<struct<guid:string,extension:string,content_type:string,contents64:string>>",
    )
    read = attachments.read_attachments(mails)
    texts = contents.distinct_texts(read)
    assert texts.count() == 2 == contents.content_store(read).count()
    profile = language.train_profile(spark.createDataFrame([("en", "the house the red house"), ("es", "la casa roja la casa")], "lang string, body string"))
    lexicon = spark.createDataFrame([("es", "casa", "house")], "lang string, word string, translation string")
    gazetteer = spark.createDataFrame([("house", "LOCATION", 1.0, "en"), ("roja", "MISC", 1.0, "es")], "phrase string, tag string, score double, lang string")
    described = contents.describe_contents(texts, profile, lexicon, gazetteer)
    rows = contents.add_descriptions(attachments.to_attachments(read), described).collect()
    found = {r.guid: (r.content_tika_langid, r.content_lang, r.content_translated, r.entities and r.entities.content_entities.entity_all,
                      r.entities and r.entities.content_entities_translated and r.entities.content_entities_translated.entity_all) for r in rows}
    spanish = ("es", "es", "la house, roja", ["roja"], ["house"])
    nothing = (None,) * 5
    assert found == {"g10": spanish, "g11": ("en", None, None, ["house"], None), "g20": spanish, "g21": nothing, "g30": nothing, "g31": spanish}
    bare = contents.describe_contents(texts)
    assert bare.where("content_tika_langid IS NULL AND content_lang IS NULL").count() == 2


def test_whole_chain(spark):
    emails = chain_mails(spark)
    gazetteer = spark.createDataFrame([("the", "MISC", 1.0, "en")], "phrase string, tag string, score double, lang string")
    lexicon = spark.createDataFrame([("es", "casa", "house"), ("es", "de", "of"), ("de", "ein", "a")], "lang string, word string, translation string")
    labelled = fixtures.docs(spark, SF_DIR).select("lang", F.col("body"))
    guids = emails.select(F.explode("attachments").alias("a")).select("a.guid").limit(7)
    tags = guids.selectExpr("guid", "'.jpg' AS extension", "'N' AS latref", "'E' AS lonref", "'0' AS altref", "'1,30,0' AS lat_dms", "'2,0,0' AS lon_dms", "'3' AS alt")
    lookups = Lookups(
        networks=places.networks(spark), gazetteer=gazetteer, lexicon=lexicon, topic_iterations=2, topic_count=3, vocabulary=100,
        force_language=None, profile=language.train_profile(labelled), image_tags=checkpointed(tags),
    )
    tables = enrich(emails, lookups)
    for df in (tables.emails, tables.attachments, tables.addresses, tables.address_history):
        text = plan(df)
        assert "MapInPandas" not in text and "contents64" not in text
    out = to_schema(tables.emails, "emails").cache()
    assert out.count() == 200
    assert out.where("communities_count > 0").count() == 200
    assert out.where("size(entities.body_entities.entity_all) > 0").count() > 0
    assert out.where("size(topic_scores) = 3").count() > 0
    assert out.where("body_lang = 'es' AND body_translated <> body").count() > 0
    files = to_schema(tables.attachments, "attachments").cache()
    assert files.where("content_extracted").count() == 100
    assert files.where("content_extracted AND content_tika_langid IS NOT NULL").count() == 100
    assert files.where("content_lang <> 'en' AND content_translated IS NOT NULL").count() > 0
    assert files.where("size(entities.content_entities.entity_all) > 0").count() > 0
    assert files.where("exif.gps.coord.lat = 1.5").count() == 7
    store = to_schema(tables.contents, "contents")
    assert store.count() == files.select("content_hash").dropna().distinct().count()
    assert index.with_bodies(files.limit(3), store).where("contents64 IS NOT NULL").count() == 3
    history = to_schema(tables.address_history, "address_history").cache()
    stored_files = index.files_of_history(history)
    assert stored_files.count() == files.count()
    assert index.addresses_with_extension(stored_files, ".csv").count() == 100
    assert history.where("size(recepient) > 0").count() > 0
    assert tables.topics.count() == 3
    addresses = to_schema(tables.addresses, "addresses")
    assert addresses.where("community IS NOT NULL AND ingest_id = 'ingest' AND domain <> ''").count() == addresses.count() > 200


def test_mails_with_one_id_stop_the_chain(spark):
    with pytest.raises(ValueError, match="duplicate email id"):
        emails = chain_mails(spark).limit(20)
        enrich(emails.unionByName(emails), Lookups(topic_iterations=1, topic_count=2, vocabulary=10))


def test_history_takes_one_shuffle(spark):
    text = plan(A.address_history(fixtures.mail(spark, SF_DIR)))
    assert text.count("Exchange hashpartitioning(addr") == text.count("Exchange ") == 1


def test_both_uses_of_the_node_table_share_their_shuffle(spark):
    nodes = A.node_index(A.weighted_edges(fixtures.mail(spark, SF_DIR)))
    nodes.collect()
    assert "ReusedExchange" in nodes._jdf.queryExecution().executedPlan().toString()


def test_phrases_are_looked_up_by_small_tables(spark):
    """Levels of the trie are written tables of hashes, so that the planner can tell that they are small."""
    words = [(["a", "b", "c"],), (["a", "b", "d"],), (["a"],)]
    listed = spark.createDataFrame(words, "_words array<string>")
    levels = entities.phrase_trie(listed, [], 3)
    assert [dict(level.dtypes)["_prefix"] for level in levels] == ["bigint", "bigint"]
    assert all("Exchange" not in plan(level) for level in levels)
    assert [sorted((list(r._ends), r._depth) for r in level.collect()) for level in levels] == [[([1], 3)], [([3], 3)]]


def test_no_words_travel_with_a_place_in_a_text(spark):
    words = [f"w{i}" for i in range(32)]
    gazetteer = spark.createDataFrame([(" ".join(words[i:] + words[:i]), "MISC", 1.0) for i in range(32)], "phrase string, tag string, score double")
    docs = spark.range(50).select("id", F.lit(" ".join(words * 30)).alias("body"))
    found = entities.match_gazetteer(docs, gazetteer)
    text = without_broadcast(spark, lambda: found)
    assert "_run" not in text
    assert found.count() == 50 * 30


def test_addresses_are_numbered_without_shuffling_pairs(spark):
    emails = fixtures.mail(spark, "/root/testdata/sf0.001")
    nodes = A.mail_nodes(emails)
    assert "hashpartitioning(src" not in plan(nodes)
    assert {tuple(r) for r in nodes.collect()} == {tuple(r) for r in A.node_index(A.weighted_edges(emails)).collect()}
    assert "hashpartitioning(src" not in plan(catalog.QUERIES["node_index"](spark, "/root/testdata/sf0.001"))


def test_longer_runs_are_dealt_out_as_short_hashes(spark):
    """Prefixes of two words and more have 32 bits, two levels share a column, and phrases of any length are still found."""
    phrases = [" ".join(f"w{i}" for i in range(n)) for n in (1, 2, 3, 5, 9, 17, 20)]
    gazetteer = spark.createDataFrame([(p, len(p)) for p in phrases], "phrase string, n int")
    listed = gazetteer.select(F.split("phrase", " ").alias("_words"))
    levels = entities.phrase_trie(listed, [], 20)
    assert [0 < r._prefix <= entities.SHORT for states in levels[1:] for r in states.collect()] == [True] * 4
    texts = [(n, " ".join(f"w{i}" for i in range(n)) + " end") for n in range(1, 23)]
    found = entities.match_gazetteer(spark.createDataFrame(texts, "id int, body string"), gazetteer).where("start = 0").collect()
    assert {r.id: r.words for r in found} == {n: max(w for w in (1, 2, 3, 5, 9, 17, 20) if w <= n) for n in range(1, 23)}
    hashed = spark.range(1).select(*(F.lit(h).cast("long").alias(f"_h{w}") for w, h in ((1, 5), (2, 2**40 + 7), (4, 2**32), (8, None))))
    assert hashed.select(*entities._packed([1, 2, 4, 8])).first().asDict() == {"_p0": (7 << 32) + 1, "_p1": 0}
