"""Phone, card and model numbers in mail text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.functions.matching import excerpt, find_all, line_hits, regex_hits
from mailloom.runtime import checkpointed

# fixed values: candidate patterns
PHONE_PATTERN = r"[+]?[0-9]?[0-9]?[0-9\- .()]{6,15}"
PHONE_CHARS = r"+0-9\- .()"
CARD_PATTERN = r"(?U)(?:[0-9]{4}\W*){4}"
CARD_CHARS = r"\W0-9"
MODEL_CHARS = r"[a-zA-Z0-9\\/:#-]+"

# fixed values: words that announce a phone number, how far before it, and its fewest digits
PHONE_WORDS = ("call", "tel", "cel", "mob", "line", "desk", "office", "home", "work", "phone", "fax")
PHONE_WORD_CHARS = 15
PHONE_MIN_DIGITS = 7

# no number has more digits, so no prefix does
PLAN_MAX_DIGITS = 15

_NUMBERS = (
    "array<struct<type:string,value:string,normalized:string,excerpt:string,"
    "offset_start:bigint,offset_end:bigint,excerpt_value_start:bigint,excerpt_value_stop:bigint,"
    "possible_area:string,possible_carrier:string>>"
)

#: a table (prefix, min_len, max_len, area, carrier) of any size, or a few rows of it
Plan = DataFrame | Sequence[Mapping]

_ENTRY = "struct<min_len:int,max_len:int,area:string,carrier:string>"


def plan_table(spark: SparkSession, plan: Plan) -> DataFrame:
    if isinstance(plan, DataFrame):
        return plan
    rows = [(p["prefix"], p["min_len"], p["max_len"], p.get("area"), p.get("carrier")) for p in plan]
    return spark.createDataFrame(rows, "prefix string, min_len int, max_len int, area string, carrier string")


def plan_entries(texts: DataFrame, plan: DataFrame) -> DataFrame:
    """(id, entries): for the candidate numbers of (id, text) rows a map from their digits to their plan entry.

    Each different number is looked up once, under its prefixes of the lengths that occur; the longest one
    counts, and of several entries for a prefix the largest.
    """
    fields = F.struct("min_len", "max_len", "area", "carrier").cast(_ENTRY)
    known = plan.where(F.length("prefix").between(1, PLAN_MAX_DIGITS)).groupBy("prefix").agg(F.max(fields).alias("entry"))
    known = checkpointed(known)
    lengths = sorted(r.n for r in known.select(F.length("prefix").alias("n")).distinct().collect()) or [1]
    digits = F.transform(find_all(F.col("text"), regex_hits(PHONE_PATTERN), PHONE_CHARS), lambda hit: digits_of(hit.value))
    dialled = F.array_distinct(F.filter(digits, lambda d: F.length(d) >= PHONE_MIN_DIGITS))
    candidates = texts.select("id", F.explode(dialled).alias("digits")).distinct()
    spelled = F.array(*(F.substring("digits", 1, n) for n in lengths))
    prefixes = candidates.select("digits").distinct().select("digits", F.explode(F.array_distinct(spelled)).alias("prefix"))
    longest = prefixes.join(known, "prefix").groupBy("digits").agg(F.max_by("entry", F.length("prefix")).alias("entry"))
    met = candidates.join(longest, "digits")
    return met.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("digits", "entry"))).alias("entries"))


def with_plan(emails: DataFrame, texts: Column, plan: Plan | None) -> tuple[DataFrame, Column | None]:
    """The mails with the plan entries of the numbers in an array of their texts, and the column of these."""
    if plan is None:
        return emails, None
    rows = emails.select("id", F.explode(texts).alias("text")).where(F.col("text").isNotNull())
    entries = plan_entries(rows, plan_table(emails.sparkSession, plan)).withColumnRenamed("entries", "_plan")
    return emails.join(entries, "id", "left"), F.col("_plan")


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _record(kind: str, hit: Column, normalized: Column, area=None, carrier=None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(kind).alias("type"),
        hit.value.alias("value"),
        normalized.alias("normalized"),
        excerpt(hit).alias("excerpt"),
        hit.s.cast("bigint").alias("offset_start"),
        hit.e.cast("bigint").alias("offset_end"),
        F.length(hit.before).cast("bigint").alias("excerpt_value_start"),
        F.length(hit.after).cast("bigint").alias("excerpt_value_stop"),
        (none if area is None else area).alias("possible_area"),
        (none if carrier is None else carrier).alias("possible_carrier"),
    )


def _entry_of(digits: Column, plan: Column | Sequence[Mapping] | None) -> Column:
    """The plan entry of a number, or null."""
    if isinstance(plan, Column):
        return F.try_element_at(plan, digits)
    if not plan:
        return F.lit(None).cast(_ENTRY)
    prefixes = F.array(*(F.lit(p["prefix"]) for p in plan))
    entries = F.array(*(F.struct(*(F.lit(p.get(c)).alias(c) for c in ("min_len", "max_len", "area", "carrier"))).cast(_ENTRY) for p in plan))
    listed = F.map_from_arrays(prefixes, entries)
    lengths = sorted({len(p["prefix"]) for p in plan}, reverse=True)
    return F.coalesce(*(F.try_element_at(listed, F.substring(digits, 1, n)) for n in lengths))


def find_phones(text: Column, plan: Column | Sequence[Mapping] | None = None) -> Column:
    """Accepted when the plan says the number is valid or a phone word comes shortly before.

    `plan` is a map from digits to plan entries, as `plan_entries` gives it, or a few rows of a plan, which
    become part of the expression.
    """
    hits = find_all(text, regex_hits(PHONE_PATTERN), PHONE_CHARS)
    judged = F.transform(
        hits,
        lambda hit: F.struct(
            hit.alias("hit"),
            digits_of(hit.value).alias("digits"),
            _entry_of(digits_of(hit.value), plan).alias("entry"),
        ),
    )

    def accept(c: Column) -> Column:
        announced = F.lower(F.right(c.hit.before, F.lit(PHONE_WORD_CHARS))).rlike("|".join(PHONE_WORDS))
        valid = F.coalesce(F.length(c.digits).between(c.entry.min_len, c.entry.max_len), F.lit(False))
        return (F.length(c.digits) >= PHONE_MIN_DIGITS) & (valid | announced)

    def record(c: Column) -> Column:
        area = F.concat(F.lit("Possible area: "), c.entry.area, F.lit(". "))
        carrier = F.concat(F.lit("Possible carrier: "), c.entry.carrier, F.lit("."))
        return _record("phone_number", c.hit, c.digits, area, carrier)

    return F.transform(F.filter(judged, accept), record).cast(_NUMBERS)


def find_cards(text: Column) -> Column:
    hits = find_all(text, regex_hits(CARD_PATTERN), CARD_CHARS)
    return F.transform(
        hits, lambda hit: _record("credit_card_number", hit, digits_of(hit.value))
    ).cast(_NUMBERS)


def is_model_number(line: Column) -> Column:
    """One word of letters, digits and \\ / : # - with at least one digit and one letter."""
    return line.rlike(f"\\A{MODEL_CHARS}\\z") & line.rlike("[0-9]") & line.rlike("[a-zA-Z]")


def find_models(text: Column) -> Column:
    hits = find_all(text, line_hits(is_model_number), r"^\n")
    return F.transform(hits, lambda hit: _record("model_number", hit, hit.value)).cast(_NUMBERS)


def find_numbers(text: Column, plan: Column | Sequence[Mapping] | None = None) -> Column:
    """Phones, then cards, then model numbers, each in text order."""
    return F.concat(find_phones(text, plan), find_cards(text), find_models(text))


def add_numbers(
    emails: DataFrame, plan: Plan | None = None, include_attachments: bool = False
) -> DataFrame:
    """Add numbers[] and phone_numbers[]; the latter holds every number found, of any type."""
    none = F.array().cast(_NUMBERS)
    texts = F.array("body")
    if include_attachments:
        texts = F.concat(texts, F.coalesce(F.transform("attachments", lambda a: a.content), F.array().cast("array<string>")))
    rows, entries = with_plan(emails, texts, plan)
    found = F.coalesce(find_numbers(F.col("body"), entries), none)
    if include_attachments:
        in_files = F.transform(
            "attachments", lambda a: F.coalesce(find_numbers(a.content, entries), none)
        )
        found = F.concat(found, F.coalesce(F.flatten(in_files), none))
    kept = ("normalized", "type", "excerpt", "offset_start", "offset_end")
    return rows.withColumn("_found", found).select(
        *emails.columns,
        F.transform("_found", lambda n: F.struct(*[n[c].alias(c) for c in kept])).alias("numbers"),
        F.transform("_found", lambda n: n.normalized).alias("phone_numbers"),
    )


def add_phones(
    emails: DataFrame, keys: Sequence[str] = ("body",), plan: Plan | None = None
) -> DataFrame:
    """Phones only, over chosen text columns, as phone_numbers[]."""
    none = F.array().cast("array<string>")
    rows, entries = with_plan(emails, F.array(*keys), plan)
    found = [
        F.coalesce(F.transform(find_phones(F.col(key), entries), lambda n: n.normalized), none)
        for key in keys
    ]
    return rows.select(*emails.columns, F.concat(*found).alias("phone_numbers"))
