"""Language identification from character trigrams, and lexicon translation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.runtime import bounded_rows, checkpointed

MAX_LANGUAGES = 500

# what a trigram must occur in a language's texts to be in a profile learned from a large corpus
LEAST_GRAMS = 3

# log weights are kept as whole millionths, so sums do not depend on the order of rows
SCALE = 1_000_000

# words of a text that share a shelf of its dictionary, and shelves at most; they set the time of a lookup, not its result
SHELF, MOST_SHELVES = 4, 1024

# fixed values: words a tokenizer must not take apart
ABBREVIATIONS = tuple(
    """mr. mrs. ms. mme. dr. a.m. p.m. u.s. e.u. i.d. d.c. t.b. p.s. m.s. m.a. u.n
    a. b. c. d. e. f. g. h. i. j. k. l. m. n. o. p. q. r. s. t. u. v. w. x. y. z.
    etc. e.t. a.d. b.c. e.g. i.e. 'em ... .... -- 'bout 's""".split()
)


# a word that punctuation begins or ends
EDGED = r"\A\p{P}|\p{P}\z"


def char_trigrams(text: Column) -> Column:
    """All overlapping 3-grams of the lowercase text; none means [null]-free empty array."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?s)(?=(.{3}))."), F.lit(1))


def gram_counts(text: Column) -> Column:
    """array<struct<gram, n>>: the distinct trigrams of a text and how often each occurs; none for null.

    Sorted trigrams are counted by where each run of equal ones begins, so a text costs n log n.
    """

    def counted(grams: Column) -> Column:
        starts = F.filter(
            F.transform(grams, lambda g, i: F.when((i == 0) | (g != F.get(grams, i - 1)), i)), lambda i: i.isNotNull()
        )
        return _with(
            starts,
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    F.get(grams, i).alias("gram"), (F.coalesce(F.get(at, k + 1), F.size(grams)) - i).cast("bigint").alias("n")
                ),
            ),
        )

    return _with(F.sort_array(char_trigrams(F.coalesce(text, F.lit("")))), counted)


def _with(value: Column, use) -> Column:
    """`use(value)` with the value computed once however often it is mentioned."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


@dataclass(frozen=True)
class LanguageProfile:
    """weights: (gram, one bigint column per language); floors: score of an unseen gram."""

    weights: DataFrame
    floors: dict[str, int]


def train_profile(labelled: DataFrame, least: int = 1) -> LanguageProfile:
    """Add-one naive Bayes over the trigrams of (lang, body) rows.

    A trigram that a language's texts have fewer than `least` times gets no weight in it and scores as
    unseen, so that the table need not grow with every misspelling (`LEAST_GRAMS` suits large corpora);
    totals count all trigrams.
    """
    # counted before the shuffle by (lang, gram), so there is no need to sort and count them in the row
    counts = checkpointed(
        labelled.select("lang", F.explode(char_trigrams(F.col("body"))).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    size = F.lit(counts.select("gram").distinct().count())
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    floor = F.round(-F.ln(F.col("total") + size) * SCALE).cast("bigint")
    rows = bounded_rows(totals.select("lang", floor.alias("floor")), MAX_LANGUAGES, "the label set")
    floors = {r.lang: r.floor for r in sorted(rows, key=lambda r: r.lang)}
    weight = F.round(F.ln(F.col("n") + 1) * SCALE).cast("bigint")
    weights = counts.where(F.col("n") >= least).groupBy("gram").agg(
        *[F.sum(F.when(F.col("lang") == name, weight)).alias(f"w_{name}") for name in floors]
    )
    return LanguageProfile(checkpointed(weights), floors)


def score_languages(docs: DataFrame, profile: LanguageProfile) -> DataFrame:
    """(id, n_grams, scores): scores is one struct(score, lang) per language, best first.

    `docs` is (id, body). Trigrams are counted in the row, so the join sees each of a text's distinct
    trigrams once; its sums combine before the shuffle, and one row per text travels.
    """
    counted = docs.select("id", F.explode_outer(gram_counts(F.col("body"))).alias("g")).select("id", "g.gram", "g.n")
    sums = (
        counted.join(profile.weights, "gram", "left")
        .groupBy("id")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_grams"),
            *[F.coalesce(F.sum(F.col("n") * F.col(f"w_{name}")), F.lit(0)).alias(f"w_{name}") for name in profile.floors],
        )
    )
    scored = [
        F.struct(
            (-(F.col(f"w_{name}") + F.col("n_grams") * floor)).alias("cost"), F.lit(name).alias("lang")
        )
        for name, floor in profile.floors.items()
    ]
    ranked = F.transform(
        F.sort_array(F.array(*scored)), lambda s: F.struct((-s.cost).alias("score"), s.lang.alias("lang"))
    )
    return sums.select("id", "n_grams", ranked.alias("scores"))


def detect_language(
    docs: DataFrame,
    profile: LanguageProfile | None = None,
    force: str | None = None,
    undetected: str = "en",
    unsure: str | None = None,
    margin: float = 0.0,
) -> DataFrame:
    """(id, lang). `force` short-circuits; texts too short to score get `undetected`.

    With `unsure`, a lead of less than `margin` nats per trigram gives that label instead.
    """
    if force:
        return docs.select("id", F.lit(force).alias("lang"))
    if profile is None:
        raise ValueError("a language profile is needed unless a language is forced")
    best = F.get("scores", F.lit(0))
    second = F.get("scores", F.lit(1))
    lang = F.when(F.col("n_grams") == 0, F.lit(unsure or undetected))
    if unsure is not None:
        lead = best["score"] - second["score"]
        lang = lang.when(lead < F.col("n_grams") * int(margin * SCALE), F.lit(unsure))
    return score_languages(docs, profile).select("id", lang.otherwise(best["lang"]).alias("lang"))


def lexicon_languages(lexicon: DataFrame) -> list[str]:
    return [r.lang for r in bounded_rows(lexicon.select("lang").distinct(), MAX_LANGUAGES, "the lexicon")]


def text_pieces(text: Column) -> Column:
    """A text as tokens: white-space runs as they are, words with their punctuation split off. Joined, they
    are the text again."""
    runs = F.regexp_extract_all(text, F.lit(r"(?U)\s+|\S+"), F.lit(0))
    peel = _peeling(ABBREVIATIONS)
    return F.flatten(F.transform(runs, lambda r: F.when(r.rlike(EDGED), peel(r)).otherwise(F.array(r))))


def _shelf(word: Column, shelves: Column) -> Column:
    return F.pmod(F.xxhash64(word), shelves).cast("int")


def translate_fields(rows: DataFrame, fields: Sequence[str], lexicon: DataFrame, lang: str = "lang", key: str = "id") -> DataFrame:
    """Add <field>_translated to rows (`key`, `lang`, fields), word by word, all else as it stands.

    Words are looked up in lower case without the punctuation around them; unknown words, punctuation,
    spaces and line breaks stay, and entries that begin with punctuation match nothing. A blank text gives
    '', a null one null, and a language the lexicon lacks gives the text itself. `key` is unique.

    All fields of a row share one join: their distinct words meet the lexicon, what it knows comes back as
    the row's dictionary, in shelves by hash so that looking words up costs a text its length, and the text is
    rewritten inside the row.
    """
    known = F.coalesce(F.col(lang).isin(lexicon_languages(lexicon)), F.lit(False))

    def blank(field: str) -> Column:
        return F.col(field).rlike(r"(?U)\A\s*\z")

    def spoken(field: str) -> Column:
        pieces = text_pieces(F.coalesce(F.col(field), F.lit("")))
        return F.transform(F.filter(pieces, lambda t: ~t.rlike(r"(?U)\A[\s\p{P}]")), lambda t: F.lower(t))

    def numbered(distinct: Column) -> Column:
        shelves = F.least(F.floor(F.size(distinct) / SHELF).cast("int") + 1, F.lit(MOST_SHELVES))
        return F.transform(distinct, lambda w: F.struct(shelves.alias("shelves"), w.alias("word")))

    distinct = F.array_distinct(F.concat(*map(spoken, fields)))
    cut = rows.where(known).select(key, F.col(lang).alias("lang"), F.explode(_with(distinct, numbered)).alias("x"))
    words = cut.select(key, "lang", "x.shelves", "x.word")
    # of several translations the first in order
    listed = lexicon.groupBy("lang", "word").agg(F.min("translation").alias("translation")).where(F.col("translation").isNotNull())
    entry = F.struct("word", "translation")
    found = words.join(listed, ["lang", "word"]).select(key, "shelves", "word", "translation").repartition(key)
    dictionaries = (
        found.groupBy(key, "shelves", _shelf(F.col("word"), F.col("shelves")).alias("shelf"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("words"))
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("shelf", "words"))).alias("_known"), F.first("shelves").alias("_shelves"))
    )
    # every shelf has a place, so that its number finds it
    shelved = F.transform(F.sequence(F.lit(0), F.col("_shelves") - 1), lambda i: F.try_element_at("_known", i))
    dictionaries = dictionaries.select(key, shelved.alias("_words"))

    def rewritten(field: str) -> Column:
        def translated(piece: Column) -> Column:
            word = F.lower(piece)
            return F.coalesce(F.try_element_at(F.get("_words", _shelf(word, F.size("_words"))), word), piece)

        done = F.array_join(F.transform(text_pieces(F.col(field)), translated), "")
        return F.when(F.col(field).isNotNull(), F.when(blank(field), "").when(~known | F.col("_words").isNull(), F.col(field)).otherwise(done))

    joined = rows.join(dictionaries, key, "left")
    return joined.withColumns({f"{f}_translated": rewritten(f) for f in fields}).drop("_words")


def lexicon_translate(texts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(id, translated) of (id, lang, text) rows, as `translate_fields` says."""
    return translate_fields(texts, ["text"], lexicon).select("id", F.col("text_translated").alias("translated"))


def route_translation(
    emails: DataFrame, lexicon: DataFrame, languages: DataFrame, target: str = "en"
) -> DataFrame:
    """Add {body,subject}_{lang,translated} to mails whose body is not in the target language.

    `languages` is (id, lang) of the bodies; it decides the subject too.
    """
    fields = ("body", "subject")
    spoken = languages.select("id", F.when(F.col("lang") != target, F.col("lang")).alias("_lang"))
    done = translate_fields(emails.join(spoken, "id", "left"), fields, lexicon, "_lang")
    foreign = F.col("_lang").isNotNull()
    return done.withColumns(
        {f"{f}_lang": F.when(foreign & F.col(f).isNotNull(), F.col("_lang")) for f in fields}
        | {f"{f}_translated": F.when(foreign, F.col(f"{f}_translated")) for f in fields}
    ).drop("_lang")


def translate_attachments(
    attachments: DataFrame, lexicon: DataFrame, languages: DataFrame, target: str = "en"
) -> DataFrame:
    """Add content_lang and content_translated to attachment rows (guid, content), each on its own."""
    foreign = languages.where(F.col("lang") != target).select(
        F.col("id").alias("guid"), F.col("lang").alias("content_lang")
    )
    done = translate_fields(attachments.join(foreign, "guid", "left"), ["content"], lexicon, "content_lang", "guid")
    return done.withColumn("content_translated", F.when(F.col("content_lang").isNotNull(), F.col("content_translated")))


def tokenize_punctuation(text: Column, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """White-space words with leading and trailing punctuation split off one character at a time.

    Trailing characters go first; a word that has shrunk to an abbreviation is left alone.
    """
    peel = _peeling(abbreviations)
    tokens = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    return F.flatten(F.transform(tokens, lambda w: F.when(w.rlike(EDGED), peel(w)).otherwise(F.array(w))))


def _peeling(abbreviations: Sequence[str]) -> Callable[[Column], Column]:
    """What takes the punctuation off a word; each pattern is tried once a word, the costly ones only where they may match."""
    by_length = sorted(abbreviations, key=len, reverse=True)
    listed = "|".join("\\Q" + a + "\\E" for a in by_length)
    # an abbreviation that only punctuation follows ends the peeling; else all punctuation goes,
    # except that the rest never gets shorter than one character
    stops = rf"\A({listed})\p{{P}}*\z"
    starts = rf"\A(\p{{P}}*?)((?:{listed})|[^\p{{P}}].*|.)\z"

    def after(text: Column, head: Column) -> Column:
        return F.substr(text, F.length(head) + 1)

    def peel(word: Column) -> Column:
        def opened(core: Column) -> Column:
            led = _with(F.regexp_extract(core, starts, 1), lambda lead: F.concat(_chars(lead), F.array(after(core, lead))))
            return F.concat(F.when(core.rlike(r"\A\p{P}"), led).otherwise(F.array(core)), _chars(after(word, core)))

        def parts(stopped: Column) -> Column:
            core = F.regexp_extract(word, r"\A(.+?)\p{P}*\z", 1)
            whole = F.concat(F.array(stopped), _chars(after(word, stopped)))
            return F.when(stopped != "", whole).otherwise(_with(core, opened))

        return _with(F.regexp_extract(word, stops, 1), parts)

    return peel


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")
