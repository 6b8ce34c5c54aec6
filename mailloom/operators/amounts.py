"""Money amounts in mail text, kept when currency or transaction words are near."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.matching import find_all, regex_hits

# fixed values: the amount pattern, the words looked for and how far around the amount. The
# possessive repeat matches the same and keeps the JVM from recursing on long runs of digits.
AMOUNT_PATTERN = r"(?:0|[1-9]\d{0,3}(?:,?\d{3})*+)(?:\.\d+)?"
AMOUNT_CHARS = "0-9,."
CURRENCY_WORDS = ("$", "usd", "us$")
CURRENCY_CHARS = 6
TRANSACTION_WORDS = ("balance", "paid", "deposit", "withdraw")
TRANSACTION_CHARS = 25

_AMOUNTS = "array<struct<symbol_ex:string,trans_ex:string,value:string,offset_start:bigint>>"


def _window(hit: Column, chars: int, text_length: Column) -> Column:
    """The amount with `chars` characters either side; a window that reaches the end of the
    text stops one character before it."""
    raw = F.concat(
        F.right(hit.before, F.lit(chars)), hit.value, F.left(hit.after, F.lit(chars))
    )
    return F.when(hit.e + chars >= text_length, F.substr(raw, F.lit(1), F.length(raw) - 1)).otherwise(raw)


def _with_word(window: Column, words: tuple[str, ...]) -> Column:
    low = F.lower(window)
    found = F.lit(False)
    for word in words:
        found = found | F.contains(low, F.lit(word))
    return F.when(found, window)


def find_amounts(text: Column) -> Column:
    """Every amount with its currency window and transaction window, null where no word is near."""
    hits = find_all(text, regex_hits(AMOUNT_PATTERN), AMOUNT_CHARS, TRANSACTION_CHARS)
    size = F.length(text)
    return F.transform(
        hits,
        lambda hit: F.struct(
            _with_word(_window(hit, CURRENCY_CHARS, size), CURRENCY_WORDS).alias("symbol_ex"),
            _with_word(_window(hit, TRANSACTION_CHARS, size), TRANSACTION_WORDS).alias("trans_ex"),
            hit.value.alias("value"),
            hit.s.cast("bigint").alias("offset_start"),
        ),
    ).cast(_AMOUNTS)


def money_text(include_attachments: bool = False) -> Column:
    parts = [F.coalesce("body", F.lit("")), F.lit(" "), F.coalesce("subject", F.lit("")), F.lit(" ")]
    if include_attachments:
        parts.append(
            F.array_join(F.transform("attachments", lambda a: F.coalesce(a.content, F.lit(""))), " ")
        )
    return F.concat(*parts)


def add_currency(emails: DataFrame, include_attachments: bool = False) -> DataFrame:
    """Add currency_entities[{symbol_ex, trans_ex, value}]."""
    near = F.filter(
        find_amounts(F.col("_money")), lambda a: a.symbol_ex.isNotNull() | a.trans_ex.isNotNull()
    )
    found = F.transform(near, lambda a: F.struct(a.symbol_ex.alias("symbol_ex"), a.trans_ex.alias("trans_ex"), a.value.alias("value")))
    return (
        emails.withColumn("_money", money_text(include_attachments))
        .withColumn("currency_entities", found)
        .drop("_money")
    )


def currency_rows(emails: DataFrame) -> DataFrame:
    """(sender, tos, symbol_ex, trans_ex, value): one row per currency entity."""
    return emails.select(
        F.get("senders", F.lit(0)).alias("sender"),
        F.array_join("tos", ",").alias("tos"),
        F.inline("currency_entities"),
    )


def amount_total(text: Column) -> Column:
    """Sum of all amounts in a text."""
    values = F.transform(
        find_amounts(text),
        lambda a: F.coalesce(F.replace(a.value, F.lit(","), F.lit("")).try_cast("double"), F.lit(0.0)),
    )
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)
