"""Terms, topics, language, translation, entities and spam over the documents."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from mailloom.operators import entities as N
from mailloom.operators import language as L
from mailloom.operators import spam as S
from mailloom.operators import terms as T
from mailloom.operators import topics as P
from mailloom.functions.cleaning import entity_text, spam_text
from mailloom.runtime import checkpointed

from .fixtures import DOCS, docs, table
from .registry import query

_STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS if len(w) >= T.MIN_TERM_CHARS)

TERMS = f"""words AS (
  SELECT id, lang, unnest(string_split_regex(array_to_string(list_filter(string_split(lower(body), chr(10)),
    lambda l: NOT regexp_matches(l, '^(from:|to:|subject|sent:|cc)')), chr(10)), '\\s+')) AS term FROM docs),
  terms AS (SELECT id, lang, term FROM words WHERE length(term) >= 4 AND term NOT IN ({_STOP}))"""

VOCAB = f"""{TERMS}, counted AS (SELECT term, count(*) AS n FROM terms GROUP BY term),
  ranked AS (SELECT row_number() OVER (ORDER BY n DESC, term) - 1 AS idx, term, n FROM counted),
  vocab AS (SELECT * FROM ranked WHERE idx < 2000)"""

BASE = f"WITH {DOCS}, {VOCAB}"


def _bodies(spark, sf_dir):
    return docs(spark, sf_dir).select("id", "body")


def _vocab(spark, sf_dir):
    """The vocabulary as the table it is between jobs."""
    return checkpointed(T.vocabulary(_bodies(spark, sf_dir)))


@query(f"WITH {DOCS}, {TERMS} SELECT id, term, count(*) AS n FROM terms GROUP BY id, term")
def term_counts(spark, sf_dir):
    return T.term_counts(_bodies(spark, sf_dir))


@query(
    f"""WITH {DOCS}, {TERMS} SELECT id, count(*) FILTER (term <> '') AS n_words,
      count(DISTINCT term) FILTER (term <> '') AS n_distinct FROM words GROUP BY id"""
)
def word_tokens(spark, sf_dir):
    words = T.words(F.col("body"))
    return _bodies(spark, sf_dir).select(
        "id",
        F.size(words).cast("bigint").alias("n_words"),
        F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
    )


@query(f"{BASE} SELECT idx, term, n FROM vocab")
def vocabulary(spark, sf_dir):
    return T.vocabulary(_bodies(spark, sf_dir))


@query(f"{BASE} SELECT id, idx, count(*) AS n FROM terms JOIN vocab USING (term) GROUP BY id, idx")
def term_matrix(spark, sf_dir):
    return T.term_matrix(_bodies(spark, sf_dir), _vocab(spark, sf_dir))


@query(
    f"""{BASE}, cells AS (SELECT id, idx, count(*) AS n FROM terms JOIN vocab USING (term) GROUP BY id, idx)
    SELECT docs.id, CAST(coalesce(sum(n), 0) AS BIGINT) AS total, CAST(coalesce(sum(n * idx), 0) AS BIGINT) AS weighted
    FROM docs LEFT JOIN cells USING (id) GROUP BY docs.id"""
)
def term_vectors(spark, sf_dir):
    rows = T.term_vectors(_bodies(spark, sf_dir), _vocab(spark, sf_dir))
    cells = F.transform(vector_to_array("features"), lambda v: v.cast("bigint"))

    def add(total, v):
        return total + v

    return rows.select(
        "id",
        F.aggregate(cells, F.lit(0).cast("bigint"), add).alias("total"),
        F.aggregate(F.transform(cells, lambda v, i: v * i), F.lit(0).cast("bigint"), add).alias("weighted"),
    )


@query(
    r"""WITH chars AS (SELECT doc_id, string_split(lower(text), '') AS c FROM documents),
    grams AS (SELECT doc_id, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
      FROM chars)
    SELECT 'd' || doc_id AS id, gram, count(*) AS n FROM grams
    WHERE regexp_full_match(gram, '[\p{L}\p{N}]{3}') GROUP BY doc_id, gram"""
)
def trigram_vectors(spark, sf_dir):
    return T.trigram_vectors(_bodies(spark, sf_dir))


# ---- topics -----------------------------------------------------------------------------------


def _lda(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    # written, so that the words of a text are counted once for the filter and the cells
    vectors = checkpointed(T.term_vectors(_bodies(spark, sf_dir), vocab).select("id", "features"))
    return P.fit_lda(P.with_terms(vectors)), vocab


@query()
def topic_terms(spark, sf_dir):
    model, vocab = _lda(spark, sf_dir)
    return P.describe_topics(model, vocab)


@query()
def document_topics(spark, sf_dir):
    model, _ = _lda(spark, sf_dir)
    scores = P.doc_topics(model)
    return scores.select("id", F.posexplode("scores").alias("topic", "score"))


@query(
    f"""{BASE}, scored AS (SELECT count(DISTINCT id) AS n FROM terms JOIN vocab USING (term))
    SELECT 'topics' AS what, {P.TOPICS} AS n FROM scored UNION ALL SELECT 'terms of topics', {P.TOPICS * P.TERMS_PER_TOPIC} FROM scored
    UNION ALL SELECT 'terms of topics in the vocabulary', {P.TOPICS * P.TERMS_PER_TOPIC} FROM scored
    UNION ALL SELECT 'terms out of order', 0 FROM scored
    UNION ALL SELECT 'documents with scores', n FROM scored UNION ALL SELECT 'documents whose scores sum to 1', n FROM scored
    UNION ALL SELECT 'scores outside 0 to 1', 0 FROM scored UNION ALL SELECT 'documents without a score for each topic', 0 FROM scored"""
)
def topic_invariants(spark, sf_dir):
    """What holds for any topics of these documents, counted over all topics and all document scores."""
    model, vocab = _lda(spark, sf_dir)
    described = P.describe_topics(model, vocab)
    above = F.lag("score").over(Window.partitionBy("topic").orderBy("position"))
    terms = described.withColumn("above", above).agg(
        F.count_distinct("topic").alias("topics"),
        F.count(F.lit(1)).alias("terms of topics"),
        F.count_if(F.col("term").isNotNull()).alias("terms of topics in the vocabulary"),
        F.count_if(F.col("score") > F.col("above")).alias("terms out of order"),
    )
    scores = P.doc_topics(model)
    total = F.aggregate("scores", F.lit(0.0), lambda t, s: t + s)
    docs_ = scores.agg(
        F.count(F.lit(1)).alias("documents with scores"),
        F.count_if(F.abs(total - 1) <= 10 * 10.0**-P.SCORE_DECIMALS).alias("documents whose scores sum to 1"),
        F.coalesce(F.sum(F.size(F.filter("scores", lambda s: ~s.between(0.0, 1.0)))), F.lit(0)).alias("scores outside 0 to 1"),
        F.count_if(F.size("scores") != P.TOPICS).alias("documents without a score for each topic"),
    )

    def rows(one):
        return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("what"), F.col(c).cast("bigint").alias("n")) for c in one.columns))))

    return rows(terms).unionByName(rows(docs_))


@query(
    """SELECT 'd' || doc_id AS id, CASE WHEN i IS NOT NULL THEN 'idx_' || (i - 1) END AS topic,
      round(CAST(embedding[i] AS DOUBLE), 5) AS score
    FROM documents LEFT JOIN (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
      ON vec_id = doc_id"""
)
def topic_merge(spark, sf_dir):
    """The merge alone, with embedding components standing in for topic scores."""
    scores = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.concat(F.lit("d"), F.col("vec_id").cast("string")).alias("id"),
        F.transform("embedding", lambda v: F.round(v.cast("double"), 5)).alias("scores"),
    )
    rows = P.merge_topics(_bodies(spark, sf_dir).select("id"), scores)
    return rows.select("id", F.explode_outer("topic_scores").alias("topic", "score"))


# ---- language ---------------------------------------------------------------------------------

def lang_sql(half: str = "0", least: int = L.LEAST_GRAMS) -> str:
    """Scores of texts (id, body, half) by a profile for each half of the documents, of trigrams found `least` times or more."""
    grams = "list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])"
    return f"""train AS (
    SELECT half, lang, gram, count(*) AS n FROM (
      SELECT half, lang, unnest({grams}) AS gram
      FROM (SELECT {half} AS half, lang, string_split(lower(text), '') AS c FROM documents)) GROUP BY half, lang, gram),
  floors AS (
    SELECT half, lang, CAST(round(-ln(sum(n) + any_value(size)) * 1000000) AS BIGINT) AS floor
    FROM train JOIN (SELECT half, count(DISTINCT gram) AS size FROM train GROUP BY half) USING (half) GROUP BY half, lang),
  weights AS (
    SELECT half, lang, gram, CAST(round(ln(n + 1) * 1000000) AS BIGINT) AS weight FROM train WHERE n >= {least}),
  text_grams AS (
    SELECT id, half, unnest({grams}) AS gram FROM (SELECT id, half, string_split(lower(body), '') AS c FROM texts)),
  lengths AS (SELECT id, half, count(*) AS n FROM text_grams GROUP BY id, half),
  sums AS (SELECT id, lang, sum(weight) AS s FROM text_grams JOIN weights USING (half, gram) GROUP BY id, lang),
  scores AS (
    SELECT lengths.id, floors.lang, coalesce(s, 0) + lengths.n * floor AS score, lengths.n AS n
    FROM lengths JOIN floors USING (half) LEFT JOIN sums ON sums.id = lengths.id AND sums.lang = floors.lang),
  ordered AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS place,
      score - lead(score) OVER (PARTITION BY id ORDER BY score DESC, lang) AS gap FROM scores)"""


def _profile(spark, sf_dir, rows="TRUE"):
    return L.train_profile(docs(spark, sf_dir).where(rows).select("lang", "body"), L.LEAST_GRAMS)


@query(
    f"""WITH texts AS (SELECT 'd' || doc_id AS id, text AS body, 1 - doc_id % 2 AS half FROM documents), {lang_sql("doc_id % 2")}
    SELECT texts.id, coalesce(lang, 'en') AS lang FROM texts LEFT JOIN (SELECT * FROM ordered WHERE place = 1) USING (id)"""
)
def body_language(spark, sf_dir):
    """Every document is judged by what the other half of the documents teaches."""
    texts = docs(spark, sf_dir)
    halves = [
        L.detect_language(texts.where(f"doc_id % 2 = {1 - half}").select("id", "body"), _profile(spark, sf_dir, f"doc_id % 2 = {half}"))
        for half in (0, 1)
    ]
    return halves[0].unionByName(halves[1])


@query(
    f"""WITH texts AS (SELECT conv_id || '/' || turn AS id, text AS body, 0 AS half FROM conversations), {lang_sql()}
    SELECT texts.id, CASE WHEN lang IS NULL OR gap < n * 50000 THEN 'UNKNOWN' ELSE lang END AS lang
    FROM texts LEFT JOIN (SELECT * FROM ordered WHERE place = 1) USING (id)"""
)
def content_language(spark, sf_dir):
    """With a certainty margin: texts whose two best languages are close stay UNKNOWN."""
    texts = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.concat_ws("/", "conv_id", "turn").alias("id"), F.col("text").alias("body")
    )
    return L.detect_language(texts, _profile(spark, sf_dir), unsure="UNKNOWN", margin=0.05)


LEXICON = f"""{TERMS}, lexicon AS (
  SELECT lang, term AS word, reverse(term) AS translation FROM terms WHERE lang <> 'en'
  GROUP BY lang, term HAVING count(*) >= 3)"""


def _lexicon(spark, sf_dir):
    texts = docs(spark, sf_dir)
    languages = texts.select("id", "lang")
    rows = T.term_rows(texts.where(F.col("lang") != "en").select("id", "body")).join(languages, "id")
    common = rows.groupBy("lang", F.col("term").alias("word")).count().where(F.col("count") >= 3)
    return checkpointed(common.select("lang", "word", F.reverse("word").alias("translation")))


_ABBREVS = ", ".join("('" + a.replace("'", "''") + "')" for a in L.ABBREVIATIONS)


def _peel_sql(words: str) -> str:
    """Words and their parts, punctuation taken off one character at a time, split at chr(1)."""
    open_ = r"""length(core) > 1 AND core NOT IN (SELECT a FROM abbrevs)
        AND (regexp_full_match(right(core, 1), '\p{P}') OR regexp_full_match(left(core, 1), '\p{P}'))"""
    last = r"regexp_full_match(right(core, 1), '\p{P}')"
    return f"""abbrevs(a) AS (VALUES {_ABBREVS}),
    peel AS (
      SELECT w, w AS core, ''::VARCHAR AS head, ''::VARCHAR AS tail FROM {words}
      UNION ALL
      SELECT w,
        CASE WHEN {last} THEN left(core, -1) ELSE substr(core, 2) END,
        CASE WHEN {last} THEN head ELSE head || left(core, 1) || chr(1) END,
        CASE WHEN {last} THEN chr(1) || right(core, 1) || tail ELSE tail END
      FROM peel WHERE {open_}),
    finished AS (SELECT w, head || core || tail AS parts FROM peel WHERE NOT ({open_}))"""


# a lexicon word is written with punctuation and line breaks around it in most texts
_PIECES = rf"""pieces AS (
    SELECT id, lang, field, unnest(p) AS w, unnest(range(1, len(p) + 1)) AS pos
    FROM (SELECT id, lang, field, regexp_extract_all(text, '\s+|\S+') AS p FROM (
      SELECT id, lang, 'body' AS field, body AS text FROM docs UNION ALL SELECT id, lang, 'subject', subject FROM docs)
      WHERE lang <> 'en')),
  {_peel_sql("(SELECT DISTINCT w FROM pieces)")},
  parts AS (
    SELECT id, lang, field, pos, unnest(x) AS part, unnest(range(1, len(x) + 1)) AS place
    FROM (SELECT *, string_split(parts, chr(1)) AS x FROM pieces JOIN finished USING (w))),
  done AS (
    SELECT id, field, string_agg(coalesce(translation, part), '' ORDER BY pos, place) AS text
    FROM parts LEFT JOIN lexicon ON lexicon.lang = parts.lang AND lexicon.word = lower(part) GROUP BY id, field)"""


@query(
    f"""WITH RECURSIVE {DOCS}, {LEXICON}, {_PIECES}
    SELECT docs.id, md5(CASE WHEN lang = 'en' THEN body WHEN trim(body) = '' THEN '' ELSE coalesce(text, body) END) AS translated
    FROM docs LEFT JOIN (SELECT * FROM done WHERE field = 'body') USING (id)"""
)
def lexicon_translation(spark, sf_dir):
    texts = docs(spark, sf_dir).select("id", "lang", F.col("body").alias("text"))
    return L.lexicon_translate(texts, _lexicon(spark, sf_dir)).select("id", F.md5("translated").alias("translated"))


@query(
    f"""WITH RECURSIVE {DOCS}, {LEXICON}, {_PIECES}
    SELECT docs.id, CASE WHEN lang <> 'en' THEN lang END AS body_lang,
      CASE WHEN lang <> 'en' THEN md5(CASE WHEN trim(body) = '' THEN '' ELSE coalesce(b.text, body) END) END AS body_translated,
      CASE WHEN lang <> 'en' THEN lang END AS subject_lang,
      CASE WHEN lang <> 'en' THEN md5(CASE WHEN trim(subject) = '' THEN '' ELSE coalesce(s.text, subject) END) END AS subject_translated
    FROM docs LEFT JOIN done b ON b.id = docs.id AND b.field = 'body' LEFT JOIN done s ON s.id = docs.id AND s.field = 'subject'"""
)
def translation_routing(spark, sf_dir):
    texts = docs(spark, sf_dir)
    rows = L.route_translation(
        texts.select("id", "body", "subject"), _lexicon(spark, sf_dir), texts.select("id", "lang")
    )
    return rows.select(
        "id",
        "body_lang",
        F.md5("body_translated").alias("body_translated"),
        "subject_lang",
        F.md5("subject_translated").alias("subject_translated"),
    )


@query(
    rf"""WITH RECURSIVE tokens AS (SELECT doc_id, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS pos
      FROM (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS t FROM documents)),
    {_peel_sql("(SELECT DISTINCT w FROM tokens)")}
    SELECT 'd' || documents.doc_id AS id, md5(coalesce(joined, '')) AS tokens FROM documents LEFT JOIN (
      SELECT doc_id, string_agg(parts, chr(1) ORDER BY pos) AS joined FROM tokens JOIN finished USING (w) GROUP BY doc_id)
      USING (doc_id)"""
)
def punctuation_tokens(spark, sf_dir):
    tokens = L.tokenize_punctuation(F.col("body"))
    return _bodies(spark, sf_dir).select("id", F.md5(F.array_join(tokens, "\x01")).alias("tokens"))


# ---- entities ---------------------------------------------------------------------------------

def _cover(matches: str) -> str:
    """Disjoint matches of each text, as a reader from left to right takes them."""
    return f"""SELECT id, lang, unnest(kept, recursive := true) FROM (
      SELECT id, lang, list_reduce(
        list({{'start': start, 'words': words, 'phrase': phrase, 'e': e}} ORDER BY start),
        lambda taken, m: CASE WHEN m.start >= taken.stop
          THEN {{'stop': m.start + m.words, 'kept': list_append(taken.kept, m)}} ELSE taken END,
        {{'stop': 0::BIGINT, 'kept': list({{'start': start, 'words': words, 'phrase': phrase, 'e': e}})[1:0]}}).kept AS kept
      FROM {matches} GROUP BY id, lang)"""


def _matched(entries: str) -> str:
    """The longest of the listed phrases at each word."""
    return f"""SELECT id, lang, start, words, phrase, e FROM (
      SELECT id, lang, i - 1 AS start, n AS words, array_to_string(run[1 : n], ' ') AS phrase, e,
        row_number() OVER (PARTITION BY id, i ORDER BY n DESC) AS place
      FROM (SELECT id, lang, i, t[i : i + longest - 1] AS run
            FROM (SELECT id, lang, t, longest, unnest(range(1, len(t) + 1)) AS i FROM clean, (SELECT max(n) AS longest FROM {entries})))
      JOIN {entries} ON lower(run[1]) = first_word AND lower(run[n]) = last_word
      WHERE lower(array_to_string(run[1 : n], ' ')) = words_of) WHERE place = 1"""


GAZ = f"""{VOCAB}, gaz AS (
    SELECT term AS listed, CASE idx % 4 WHEN 0 THEN 'LOCATION' WHEN 1 THEN 'ORGANIZATION' WHEN 2 THEN 'PERSON'
      ELSE 'MISC' END AS tag, 1.0 / (idx + 1) AS score, idx FROM ranked WHERE idx < 2000
    UNION ALL
    SELECT a.term || ' ' || b.term, 'PERSON', 0.9, 2000 + a.idx FROM ranked a JOIN ranked b ON b.idx = a.idx + 1
    WHERE a.idx < 200
    UNION ALL
    SELECT array_to_string(regexp_extract_all(body, '\\S+')[1 : 1 + doc_id % 20], ' '),
      CASE doc_id % 2 WHEN 0 THEN 'LOCATION' ELSE 'MISC' END, 0.75, doc_id FROM docs WHERE body IS NOT NULL),
  clean AS (SELECT id, lang, regexp_extract_all(
      replace(regexp_replace(body, '[^\\x00-\\x7F]', ' ', 'g'), '[:newline:]', repeat(' ', 11)), '[A-Za-z0-9]+') AS t FROM docs),
  spelled AS (
    SELECT *, array_to_string(w, ' ') AS words_of, w[1] AS first_word, w[-1] AS last_word, len(w) AS n FROM (
      SELECT *, regexp_extract_all(regexp_replace(lower(listed), '[^\\x00-\\x7F]', ' ', 'g'), '[A-Za-z0-9]+') AS w FROM gaz)
    WHERE len(w) > 0),
  known AS (SELECT words_of, first_word, last_word, n, max({{'tag': tag, 'score': score}}) AS e FROM spelled GROUP BY ALL),
  matched AS ({_matched('known')}),
  mentions AS ({_cover('matched')})"""


def _gazetteer(spark, sf_dir):
    """The vocabulary with tags by rank, pairs of neighbouring ranks, and openings of 1 to 20 words."""
    vocab = _vocab(spark, sf_dir)
    tag = F.element_at(
        F.array(*[F.lit(t) for t in ("LOCATION", "ORGANIZATION", "PERSON", "MISC")]), (F.col("idx") % 4 + 1).cast("int")
    )
    single = vocab.select(F.col("term").alias("phrase"), tag.alias("tag"), (1.0 / (F.col("idx") + 1)).alias("score"), "idx")
    after = vocab.select((F.col("idx") - 1).alias("idx"), F.col("term").alias("next_term"))
    pairs = (
        vocab.where(F.col("idx") < 200)
        .join(after, "idx")
        .select(
            F.concat_ws(" ", "term", "next_term").alias("phrase"),
            F.lit("PERSON").alias("tag"),
            F.lit(0.9).alias("score"),
            (F.col("idx") + 2000).alias("idx"),
        )
    )
    words = F.regexp_extract_all("body", F.lit(r"(?U)\S+"), F.lit(0))
    openings = docs(spark, sf_dir).where(F.col("body").isNotNull()).select(
        F.array_join(F.slice(words, F.lit(1), (F.col("doc_id") % 20 + 1).cast("int")), " ").alias("phrase"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("LOCATION")).otherwise(F.lit("MISC")).alias("tag"),
        F.lit(0.75).alias("score"),
        F.col("doc_id").alias("idx"),
    )
    return single.unionByName(pairs).unionByName(openings)


@query(f"WITH {DOCS}, {GAZ} SELECT id, CAST(start AS INTEGER) AS start, CAST(words AS INTEGER) AS words, phrase, tag, round(score, 6) AS score FROM mentions")
def gazetteer_matches(spark, sf_dir):
    rows = N.match_gazetteer(_bodies(spark, sf_dir), _gazetteer(spark, sf_dir).drop("idx"))
    return rows.select("id", "start", "words", "phrase", "tag", F.round("score", 6).alias("score"))


def _bucket_sql(condition: str, name: str) -> str:
    return f"coalesce(string_agg(phrase, ',' ORDER BY start) FILTER ({condition}), '') AS {name}"


@query(
    f"""WITH {DOCS}, {GAZ} SELECT id, {_bucket_sql('TRUE', 'entity_all')},
      {_bucket_sql("tag = 'LOCATION' AND score > 0.3", 'entity_location')},
      {_bucket_sql("tag = 'ORGANIZATION' AND score > 0.5", 'entity_organization')},
      {_bucket_sql("tag = 'PERSON' AND score > 0.3", 'entity_person')},
      {_bucket_sql("tag = 'MISC' AND score > 0.5", 'entity_misc')}
    FROM mentions WHERE length(phrase) <= 30 GROUP BY id"""
)
def entity_buckets(spark, sf_dir):
    found = N.match_gazetteer(_bodies(spark, sf_dir), _gazetteer(spark, sf_dir).drop("idx"))
    rows = N.bucket_entities(found, N.THRESHOLDS)
    return rows.select("id", *[F.array_join(name, ",").alias(name) for name in N.LISTS])


@query(
    f"""WITH {DOCS}, {GAZ}, en AS (
      SELECT id, string_agg(phrase, ',' ORDER BY start) AS found FROM mentions WHERE length(phrase) <= 30 GROUP BY id)
    SELECT docs.id, CASE WHEN lang = 'es' THEN 'es' ELSE 'en' END AS original_lang,
      CASE WHEN lang = 'es' THEN '' ELSE coalesce(found, '') END AS body_entities,
      CASE WHEN lang = 'es' THEN coalesce(found, '') END AS translated_entities
    FROM docs LEFT JOIN en USING (id)"""
)
def entity_routing(spark, sf_dir):
    """Only an English gazetteer is given, so Spanish texts find nothing until translated."""
    texts = docs(spark, sf_dir).select(
        "id", "body", F.col("lang").alias("body_lang"), F.col("body").alias("body_translated")
    )
    gazetteer = _gazetteer(spark, sf_dir).drop("idx").withColumn("lang", F.lit("en"))
    rows = N.add_entities(texts, gazetteer)
    return rows.select(
        "id",
        F.col("entities.original_lang").alias("original_lang"),
        F.array_join("entities.body_entities.entity_all", ",").alias("body_entities"),
        F.array_join("entities.body_entities_translated.entity_all", ",").alias("translated_entities"),
    )


@query(
    f"""WITH {DOCS}, {GAZ}, spots AS (
      SELECT words_of, first_word, last_word, n, max({{'preferred': 'p:' || listed, 'lat': idx % 90, 'lon': idx % 180}}) AS e
      FROM spelled WHERE tag = 'LOCATION' GROUP BY ALL),
    hits AS ({_matched('spots')}),
    places AS ({_cover('hits')})
    SELECT docs.id, count(start) AS n,
      coalesce(string_agg(phrase || '@' || lat || '/' || lon || '=' || preferred, ',' ORDER BY start), '') AS locations
    FROM docs LEFT JOIN places USING (id) GROUP BY docs.id"""
)
def place_mentions(spark, sf_dir):
    places = _gazetteer(spark, sf_dir).where(F.col("tag") == "LOCATION").select(
        "phrase",
        F.concat(F.lit("p:"), "phrase").alias("preferred"),
        (F.col("idx") % 90).cast("double").alias("lat"),
        (F.col("idx") % 180).cast("double").alias("lon"),
    )
    rows = N.place_mentions(_bodies(spark, sf_dir), places)
    text = F.transform(
        "locations",
        lambda m: F.concat(
            m["name"], F.lit("@"), m.location.lat.cast("bigint").cast("string"), F.lit("/"),
            m.location.lon.cast("bigint").cast("string"), F.lit("="), m.preferredName,
        ),
    )
    return rows.select("id", F.size("locations").cast("bigint").alias("n"), F.array_join(text, ",").alias("locations"))


# ---- spam -------------------------------------------------------------------------------------

CLEAN_SQL = r"""translate(replace(regexp_replace({text}, '[^\x00-\x7F]', ' ', 'g'), '[:newline:]', repeat(' ', 11)),
    chr(10) || chr(9) || '"><', '')"""

def _spam_sql(rows: str = "TRUE") -> str:
    return f"""labelled AS (
    SELECT CASE WHEN toxic = 1 THEN 'spam' ELSE 'nonspam' END AS label, text FROM labels JOIN documents USING (doc_id)
    WHERE {rows}),
  counts AS (
    SELECT token, count(*) FILTER (label = 'spam') AS spam, count(*) FILTER (label = 'nonspam') AS nonspam
    FROM (SELECT label, unnest(regexp_extract_all(lower({CLEAN_SQL.format(text='text')}), '[a-z0-9_]+')) AS token FROM labelled)
    GROUP BY token),
  totals AS (SELECT sum(spam) AS spam, sum(nonspam) AS nonspam, count(*) AS size FROM counts),
  model AS (
    SELECT token, CAST(round((ln((c.spam + 1) / (t.spam + t.size)) - ln((c.nonspam + 1) / (t.nonspam + t.size))) * 1000000)
      AS BIGINT) AS log_odds FROM counts c, totals t),
  scored AS (
    SELECT docs.id, doc_id, CAST(coalesce(sum(log_odds), 0) AS BIGINT) AS score
    FROM docs LEFT JOIN (SELECT DISTINCT id, unnest(regexp_extract_all(lower({CLEAN_SQL.format(text='body')}), '[a-z0-9_]+')) AS token
      FROM docs) USING (id) LEFT JOIN model USING (token) GROUP BY docs.id, doc_id)"""


SPAM = _spam_sql()


def _labelled(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    label = F.when(F.col("toxic") == 1, F.lit(S.SPAM)).otherwise(F.lit(S.NONSPAM))
    return docs(spark, sf_dir).join(labels.select("doc_id", label.alias("label")), "doc_id")


def _model(spark, sf_dir, rows="TRUE"):
    return S.spam_model(S.count_tokens(_labelled(spark, sf_dir).where(rows).select("label", "body")))


@query(f"WITH {DOCS}, {SPAM} SELECT token, log_odds FROM model")
def spam_model(spark, sf_dir):
    return _model(spark, sf_dir)


@query(
    f"""WITH {DOCS}, {_spam_sql("doc_id % 2 = 1")}, judged AS (
      SELECT (score > 0) <> (toxic = 1) AS wrong FROM scored JOIN labels USING (doc_id) WHERE doc_id % 2 = 0)
    SELECT count(*) AS tested, count(*) FILTER (wrong) AS misclassified,
      round(avg(CAST(wrong AS INTEGER)), 6) AS misclassification_rate,
      round(1 - avg(CAST(wrong AS INTEGER)), 6) AS accuracy FROM judged"""
)
def spam_evaluation(spark, sf_dir):
    """Trained on the rows of odd ids, tested on those of even ids."""
    labelled = _labelled(spark, sf_dir).where("doc_id % 2 = 0")
    predicted = S.classify(labelled.select("id", "body"), _model(spark, sf_dir, "doc_id % 2 = 1"))
    result = S.evaluate(predicted.join(labelled.select("id", "label"), "id"))
    return result.withColumns(
        {c: F.round(c, 6) for c in ("misclassification_rate", "accuracy")}
    )


@query(f"WITH {DOCS}, {SPAM} SELECT id, lang FROM docs JOIN scored USING (id) WHERE score <= 0")
def spam_filter(spark, sf_dir):
    return S.filter_spam(docs(spark, sf_dir), _model(spark, sf_dir)).select("id", "lang")


@query(f"""SELECT page_id, md5({CLEAN_SQL.format(text='html')}) AS spam_text,
      md5(replace(regexp_replace(html, '[^\\x00-\\x7F]', ' ', 'g'), '[:newline:]', repeat(' ', 11))) AS entity_text FROM pages""")
def cleaned_text(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(spam_text(html)).alias("spam_text"), F.md5(entity_text(html)).alias("entity_text")
    )
