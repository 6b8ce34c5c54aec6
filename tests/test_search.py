"""Nested attachment search, entities by threshold, additive spam training."""

from pyspark.sql import functions as F

from mailloom.operators import entities as N
from mailloom.operators import index as X
from mailloom.operators import spam as S


def test_search_options(spark):
    rows = [(f"a{i % 2}", f"g{i:02d}", ".x" if i % 3 else ".y", f"2001-01-{i + 1:02d}") for i in range(20)]
    files = spark.createDataFrame(rows, "addr string, guid string, extension string, datetime string").withColumn(
        "datetime", F.col("datetime").cast("timestamp")
    )

    def guids(**options):
        return sorted(r.guid for r in X.attachments_of(files, **options).collect())

    assert guids(addr="a1") == ["g01", "g03", "g05"]
    assert guids(addr="a1", extension=".y", limit=None) == ["g03", "g09", "g15"]
    assert guids(dates=("2001-01-02", "2001-01-03"), limit=100_000) == ["g01", "g02"]
    assert len(guids(limit=None)) == 20 == len(guids(limit=5000))
    assert [r.addr for r in X.addresses_with_extension(files.where("addr = 'a0'"), ".y").collect()] == ["a0"]


def test_one_hot_address_keeps_exactly_its_first_rows(spark):
    files = spark.range(20_000).select(
        F.lit("hot").alias("addr"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("guid"),
        F.timestamp_seconds(F.col("id")).alias("datetime"),
    )
    found = X.attachments_of(files, limit=5000)
    assert found.count() == 5000
    assert found.agg(F.max("guid")).first()[0] == "004999"


def test_longest_phrase_and_thresholds(spark):
    gazetteer = spark.createDataFrame(
        [("new york", "LOCATION", 0.4), ("new", "MISC", 0.9), ("york, City hall", "ORGANIZATION", 0.4), ("x" * 31, "MISC", 1.0)],
        "phrase string, tag string, score double",
    )
    docs = spark.createDataFrame([("1", "New York, York  City hall new" + " " + "x" * 31), ("2", "none"), ("3", None)], "id string, body string")
    found = N.match_gazetteer(docs, gazetteer)
    assert [(r.start, r.words, r.phrase) for r in found.orderBy("start").collect()] == [
        (0, 2, "New York"),
        (2, 3, "York City hall"),
        (5, 1, "new"),
        (6, 1, "x" * 31),
    ]
    plain = N.bucket_entities(found).first()
    assert plain.entity_all == ["New York", "York City hall", "new"]
    assert (plain.entity_location, plain.entity_organization, plain.entity_misc) == (["New York"], ["York City hall"], ["new"])
    strict = N.bucket_entities(found, N.THRESHOLDS).first()
    assert (strict.entity_location, strict.entity_organization) == (["New York"], [])


def test_spanish_is_matched_in_both_languages(spark):
    gazetteer = spark.createDataFrame(
        [("casa", "LOCATION", 1.0, "es"), ("house", "LOCATION", 1.0, "en")], "phrase string, tag string, score double, lang string"
    )
    docs = spark.createDataFrame(
        [("1", "la casa", "es", "the house"), ("2", "house casa", "fr", None)], "id string, body string, body_lang string, body_translated string"
    )
    rows = {r.id: r.entities for r in N.add_entities(docs, gazetteer).collect()}
    assert rows["1"].body_entities.entity_all == ["casa"]
    assert rows["1"].body_entities_translated.entity_all == ["house"]
    assert rows["2"].original_lang == "en" and rows["2"].body_entities.entity_all == ["house"]
    assert rows["2"].body_entities_translated is None


def test_spam_training_adds_up(spark):
    rows = [("spam", "buy now buy"), ("nonspam", "see you now"), ("spam", "buy pills"), ("nonspam", "lunch")]
    whole = spark.createDataFrame(rows, "label string, body string")
    halves = [spark.createDataFrame(part, whole.schema) for part in (rows[:2], rows[2:])]

    def table(counts):
        return {(r.token, r.spam, r.nonspam) for r in counts.collect()}

    assert table(S.add_counts(*[S.count_tokens(h) for h in halves])) == table(S.count_tokens(whole))
    model = S.spam_model(S.count_tokens(whole))
    mails = spark.createDataFrame([("1", "buy pills"), ("2", "lunch?"), ("3", ""), ("4", None)], "id string, body string")
    assert {r.id for r in S.filter_spam(mails, model).collect()} == {"2", "3", "4"}


def test_mails_are_dealt_out_before_they_are_summed_next_to_a_large_model(spark, monkeypatch):
    mails = spark.createDataFrame([(str(i), "buy now " * (i % 3) + "see you") for i in range(40)] + [("none", None)], "id string, body string")
    model = spark.createDataFrame([("buy", 5), ("now", -1), ("see", -2), ("you", -1)], "token string, log_odds bigint")

    def judged():
        found = S.classify(mails, model)
        # below the only exchange by id no sums are kept
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        return {(r.id, r.score, r.predicted) for r in found.collect()}, "RepartitionByExpression [id" in plan

    small, dealt = judged()
    assert not dealt and ("1", 1, "spam") in small and ("0", -3, "nonspam") in small and ("none", 0, "nonspam") in small
    monkeypatch.setattr(S, "BROADCAST_TOKENS", 3)
    assert judged() == (small, True)
