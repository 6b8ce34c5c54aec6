"""Operators that look at one row at a time: language, pieces, toxicity, URLs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailloom.llm import language_id, pieces, toxicity, urls, vocabulary
from mailloom.llm.queries import QUERIES, model_bytes

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def model():
    return model_bytes()


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


# ---- language -----------------------------------------------------------------------------------


def segmentations(word, chance):
    """Probability of a word as a sum over all its segmentations, spelled out."""
    if not word:
        return 1.0
    return sum(chance(word[:n]) * segmentations(word[n:], chance) for n in range(1, len(word) + 1))


def test_forward_sums_all_segmentations():
    names = ["▁", "▁a", "a", "b", "ab", "▁ab", "aba"]
    lattice = language_id.Lattice(names)
    table = np.append(np.linspace(0.05, 0.3, len(names)), [1e-8, 0.0])[:, None]
    for word in ("a", "abab", "baabaab", "axb"):

        def chance(piece):
            if piece in names:
                return table[names.index(piece), 0]
            return 1e-8 if len(piece) == 1 else 0.0

        (members, at), = lattice.places([word])
        assert list(members) == [0]
        assert math.isclose(language_id.forward(table[at])[0, -1, 0], segmentations("▁" + word, chance), rel_tol=1e-9)


def test_an_expectation_step_raises_the_likelihood(spark):
    names = ["▁", "▁a", "a", "b", "ab", "▁ab"]
    counts = spark.createDataFrame([("x", "ab", 5), ("x", "ba", 2), ("y", "aab", 3)], "lang string, word string, n long")
    tables = [np.vstack([np.full((6, 2), 1 / 6), [[1e-8] * 2], [[0.0] * 2]])]
    for _ in range(3):
        sums = language_id.expectation(counts, ("x", "y"), names, tables[-1]).collect()
        fresh = np.zeros((6, 2))
        for r in sums:
            fresh[r.piece, r.language] += r.n
        tables.append(np.vstack([fresh / fresh.sum(axis=0), [[1e-8] * 2], [[0.0] * 2]]))

    def likelihood(table):
        lattice = language_id.Lattice(names)
        total = 0.0
        for lang, word, n in (("x", "ab", 5), ("x", "ba", 2), ("y", "aab", 3)):
            (_, at), = lattice.places([word])
            total += n * math.log(language_id.forward(table[at])[0, -1, "xy".index(lang)])
        return total

    assert likelihood(tables[0]) < likelihood(tables[1]) <= likelihood(tables[2]) <= likelihood(tables[3])


def test_languages_of_odd_rows(spark, model):
    rows = [(i, "the thing and other things", "en") for i in range(5)] + [(i, "das ding und andere dinge", "de") for i in range(5, 10)]
    train = spark.createDataFrame([*rows, (None, None, "en"), (11, "no label here", None)], DOCS)
    learned = language_id.fit(train, vocabulary.normal_pieces(model))
    assert learned.languages == ("de", "en")
    asked = [(1, "the other and " * 3000, None), (1, "the other and " * 3000, None), (2, None, None), (3, "", None), (4, "12 -- !", None), (5, "und" * 5000, "x"), (None, "das ding", None)]
    docs = spark.createDataFrame(asked, DOCS).withColumn("score", F.lit("own")).withColumn("lang_pred", F.lit("own"))
    found = [(r.doc_id, r.language.lang_pred, r.language.score, r.score) for r in language_id.identify(docs, learned).collect()]
    assert [f[1] for f in found] == ["en", "en", "und", "und", "und", "de", "de"]
    assert [f[2] for f in found][2:5] == [0.0] * 3 and all(0 <= f[2] <= 1 and f[3] == "own" for f in found)


def test_no_language_can_be_learned_from_nothing(spark, model):
    empty = spark.createDataFrame([], DOCS)
    learned = language_id.fit(empty, vocabulary.normal_pieces(model))
    assert learned.languages == ()
    found = language_id.identify(spark.createDataFrame([(1, "abc", None)], DOCS), learned).first().language
    assert (found.lang_pred, found.score) == ("und", 0.0)
    assert language_id.identify(empty, learned).count() == 0


def test_held_out_languages_are_right(spark):
    found = QUERIES["op1_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    held = found.join(truth, "doc_id").where("held_out AND lang IS NOT NULL")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held.count() > 20 and right > 0.95


# ---- pieces -------------------------------------------------------------------------------------


def test_encoding_and_decoding_are_the_library_s(model, library):
    own = pieces.Encoder(model)
    dice = random.Random(7)
    letters = "abcdetniors ▁ \n\té日ü.,:;(){}=0123456789THE🙂\x00"
    known = list(own.id_of)
    texts = ["", " ", "   a  b", "\n\n x", "▁▁a", "日本語🙂", "<s> <0x0A>", "a" * 300, " " * 40 + "x" + " " * 17, "ab\r\n"]
    texts += ["".join(dice.choice(letters) for _ in range(dice.randint(1, 40))) for _ in range(2000)]
    texts += ["".join(dice.choice(known).replace("▁", " ") for _ in range(dice.randint(1, 10))) for _ in range(2000)]
    for text in texts:
        ids = library.encode(text)
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids)
    for _ in range(500):
        ids = [dice.randrange(32000 if dice.random() < 0.5 else 259) for _ in range(dice.randint(0, 9))]
        assert own.decode(ids) == library.decode(ids)


def test_encoded_columns(spark, model, library):
    long = "wört und words  " * 20_000
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("own"))
    found = pieces.encode(docs, model).collect()
    assert [r.encoded.ids for r in found] == [library.encode(t or "") for _, t in rows]
    assert [r.encoded.decoded for r in found] == [library.decode(library.encode(t or "")) for _, t in rows]
    assert {r.ids for r in found} == {"own"}
    assert pieces.encode(docs.limit(0), model).count() == 0


def test_every_document_encodes_as_in_the_library(spark, library):
    from hashlib import sha256

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op3_sentencepiece"](spark, SF_DIR).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(library.decode(ids).encode()).hexdigest()


# ---- toxicity -----------------------------------------------------------------------------------


def test_grades_are_learned_and_ordered(spark):
    def text(i):
        mild, severe = "grumble ", "grumble snarl snarlish "
        return f"plain words number{i} " + ("" if i % 4 else severe if i % 8 else mild)

    rows = [(i, text(i)) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, "x"), (401, None)], "doc_id long, text string").withColumn("toxic", F.lit("own"))
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(300)] + [(1, 0), (None, 1), (5, None), (999, 1)], "doc_id long, toxic int"
    )
    model = toxicity.fit(docs.drop("toxic"), labels)
    assert np.all(np.diff(model.thresholds) >= 0)
    found = {r.doc_id: r for r in toxicity.grade(docs, model).collect()}
    assert all(found[i].toxicity.toxic == (i % 4 == 0) for i in range(400))
    assert found[4].toxicity.severity > found[8].toxicity.severity > found[1].toxicity.severity >= 0
    assert all(0 <= r.toxicity.p_severe <= r.toxicity.p_toxic <= 1 for r in found.values())
    assert not found[401].toxicity.toxic and found[1].toxic == "own"


def test_grades_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b " * 50_000), (3, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.toxicity.toxic for r in toxicity.grade(docs, model).collect()] == [False] * 4
    assert toxicity.grade(docs.limit(0), model).count() == 0


def test_known_toxic_documents_are_found(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op7_toxicity"](spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label")), "doc_id"
    )
    counts = {(r.label, r.toxic): r["count"] for r in found.groupBy("label", "toxic").count().collect()}
    assert counts.get((1, True), 0) >= 0.6 * (counts.get((1, True), 0) + counts.get((1, False), 0))
    assert counts.get((0, True), 0) <= 0.05 * counts[(0, False)]


def labelled_texts(seed=5, rows=160):
    dice = random.Random(seed)
    bad = [f"vile{chr(97 + i)}" for i in range(6)]
    texts = []
    for i in range(rows):
        toxic = i % 3 == 0
        own = dice.sample(bad, dice.randint(1, 4)) if toxic else dice.sample(bad, 1) * (dice.random() < 0.05)
        texts.append((i, " ".join([*own, *(f"word{chr(97 + dice.randrange(20))}" for _ in range(8))]), int(toxic)))
    return texts + [texts[0], (None, "vilea", 1), (998, None, 1), (999, "vilea", None)]


def test_features_are_all_sure_words(spark):
    """Against ratios of whole contingency tables, spelled out; no feature is cut for their number."""
    texts = [t for t in labelled_texts() if None not in t]
    many = [(1000 + i, " ".join(f"x{chr(97 + j // 26 % 26)}{chr(97 + j % 26)}{chr(97 + j // 676)}" for j in range(2500)), i % 2) for i in range(0, 40, 2)]
    many += [(2000 + i, "clean words only", 0) for i in range(40)]
    many = [(i, t, int(t.startswith("x"))) for i, t, _ in many]
    for rows, least in ((texts, 6), (many, 2501)):
        frame = spark.createDataFrame([(bool(x), t) for _, t, x in rows], "toxic boolean, text string").repartition(3)
        found = dict(toxicity.telling_words(frame))
        counts = {}
        for _, t, x in rows:
            for f in toxicity.features_of(toxicity.words_of(t)):
                counts.setdefault(f, [0, 0])[x] += 1
        totals = [sum(1 for r in rows if r[2] == x) for x in (0, 1)]
        want = {}
        for f, seen in counts.items():
            cells = [(seen[x], totals[x], sum(seen)) for x in (0, 1)] + [(totals[x] - seen[x], totals[x], sum(totals) - sum(seen)) for x in (0, 1)]
            ratio = 2 * sum(o * math.log(o * sum(totals) / (a * b)) for o, a, b in cells if o)
            if sum(seen) >= toxicity.LEAST_ROWS and ratio >= toxicity.SURE:
                want[f] = ratio if seen[1] * totals[0] > seen[0] * totals[1] else -ratio
        assert len(want) >= least and found.keys() == want.keys()
        assert all(math.isclose(found[f], want[f], rel_tol=1e-9) for f in want)


def test_the_fit_is_the_most_likely_one(spark):
    """No small change of weights or thresholds makes the training grades more likely, but for a hundredth of what the
    fit gains over no weights at all: it takes a fixed number of gradient steps."""
    rows = labelled_texts()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumn("toxic", F.lit("own"))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    sure = dict(toxicity.telling_words(spark.createDataFrame([(bool(r[2]), r[1]) for r in rows if None not in r], "toxic boolean, text string")))
    assert set(model.words) == set(sure)
    known = [(toxicity.features_of(toxicity.words_of(t)) & set(model.words), x) for i, t, x in rows if None not in (i, t, x)]
    strength = [sum(sure[f] > 0 for f in fs) for fs, _ in known]
    middle = max(1.0, float(np.median([n for n, (_, x) in zip(strength, known) if x])))
    grades = [x + (x and n >= middle) for n, (_, x) in zip(strength, known)]

    def likelihood(weights, thresholds):
        total = -toxicity.RIDGE / 2 * float((weights**2).sum())
        for (fs, _), grade in zip(known, grades):
            score = sum(weights[model.words[f]] for f in fs)
            above = [1.0, *(1 / (1 + math.exp(min(30, max(-30, t - score)))) for t in thresholds), 0.0]
            total += math.log(max(above[grade] - above[grade + 1], 1e-12))
        return total

    dice = np.random.default_rng(3)
    best = likelihood(model.weights, model.thresholds)
    shares = [sum(g > k for g in grades) / len(grades) for k in (0, 1)]
    gained = best - likelihood(np.zeros(len(model.weights)), [math.log(1 / s - 1) for s in shares])
    assert gained > 50
    for size in (0.3, 0.1, 0.03):
        for _ in range(60):
            weights = model.weights + size * dice.standard_normal(len(model.weights))
            thresholds = np.sort(model.thresholds + size * dice.standard_normal(2))
            assert likelihood(weights, thresholds) <= best + 0.01 * gained
    found = {r.doc_id: r.toxicity for r in toxicity.grade(docs, model).collect() if r.doc_id is not None}
    for (i, text, _), _ in zip(rows, range(160)):
        score = sum(model.weights[model.words[f]] for f in toxicity.features_of(toxicity.words_of(text)) & set(model.words))
        want = sum(1 / (1 + math.exp(t - score)) for t in model.thresholds)
        assert math.isclose(found[i].severity, want, rel_tol=1e-9)
    assert toxicity.grade(docs, model).columns == ["doc_id", "text", "toxic", "toxicity"]


# ---- URLs ---------------------------------------------------------------------------------------

RULES = [("com", "/", "allow"), ("Example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/f", "block"), (None, "/", "block"), ("com", "/", "allow")]


def plainly(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (len(h + p), len(h), v == "block", h.lower() + p, v)
        for h, p, v in RULES
        if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, False, None, "allow"))
    return host, path, best[3], best[4]


def test_url_rules(spark):
    seen = [
        None, "", "no scheme", "http://", "https://EXAMPLE.com", "https://example.com/en/x?q#f", "http://www.Example.com/en/",
        "http://a.www.example.com/en/y", "ftp://x.net/foo/bar", "ftp://x.net/faa?x", "http://notexample.com/en/", "http://a?b/c",
        "http://a..com/", "http://com/", "http://h.com#/x", "http://" + "a." * 2000 + "com/" + "p/" * 2000, "http://www.example.com/en/" * 2,
    ]
    rows = [(i, u) for i, u in enumerate(seen)] + [(5, seen[5]), (None, seen[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("own") for c in ("host", "path", "key", "verdict", "best")})
    rules = spark.createDataFrame(RULES, urls.RULES)
    found = urls.judge(pages, rules).collect()
    assert sorted((str(r.page_id), *map(str, r.judged)) for r in found) == sorted((str(i), *map(str, plainly(u))) for i, u in rows)
    assert {r.verdict for r in found} == {"own"}
    assert urls.judge(pages.limit(0), rules).count() == 0
    none = urls.judge(pages, rules.limit(0), default="block").select("judged.rule", "judged.verdict").distinct().collect()
    assert [tuple(r) for r in none] == [(None, "block")]
