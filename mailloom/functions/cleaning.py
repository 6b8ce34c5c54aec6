"""Column expressions that tidy header fields, addresses, dates and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (pattern, replacement) rules a header or body can be cleaned with
RULES = {
    "non_ascii": (r"[^\x00-\x7F]", " "),
    "tab": (r"\t", " "),
    "newline": (r"\n", "[:newline:]"),
    "carriage_return": (r"\r", " "),
    "slash": (r"/", "_"),
    "drop_newline": (r"\n", ""),
    "fold_newline": (r"\n", " "),
    "separate": (r"[\t\n]", ";"),
    "space": (r" ", "_"),
    "ampersand": (r"&", "_"),
}

# fixed values: rule chains per field
ID_RULES = ("drop_newline", "non_ascii", "tab")
REFERENCE_RULES = ("fold_newline", "non_ascii", "tab")
ASCII_TEXT_RULES = ("non_ascii", "tab", "carriage_return")
ASCII_LINE_RULES = ("non_ascii", "separate")
ASCII_FILENAME_RULES = ("non_ascii", "slash", "space", "ampersand")

# fixed values: date layouts tried in order, those with a zone offset first
ZONED_FORMATS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXXX")
NAIVE_FORMATS = (
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy HH:mm",
    "MMM d HH:mm:ss yyyy",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)
DATE_NOISE = r"(?i)\([^)]*\)|^\s*(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+"
ZONE_NAME = r"(?<=[0-9]) [A-Za-z]{2,5}$"


def clean(text: Column, rules: tuple[str, ...]) -> Column:
    for name in rules:
        pattern, replacement = RULES[name]
        text = F.regexp_replace(text, pattern, replacement)
    return text


def domain(addr: Column) -> Column:
    return F.regexp_replace(addr, r"^.*@", "")


def domain_words(addr: Column) -> Column:
    """Lowercase word tokens of the part after the last @."""
    return F.filter(F.split(F.lower(domain(addr)), r"[^\p{L}\p{N}_.]+"), lambda w: w != "")


def path_categories(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda part: (part != "") & (part != "."))


def addresses_of(lines: Column) -> Column:
    """Addresses of decoded header lines: an @-word of the address part, else of the name."""
    # commas inside quotes do not separate
    entry = F.lit(r'(?:[^",]|"[^"]*+"?)++')
    pieces = F.flatten(F.transform(lines, lambda s: F.regexp_extract_all(s, entry, F.lit(0))))

    def pick(piece: Column) -> Column:
        bracketed = F.regexp_extract(piece, r"<([^<>]*)>", 1)
        bare = F.trim(F.regexp_replace(piece, r"\([^()]*\)|<[^<>]*>|\"", ""))
        return F.when(F.contains(bracketed, F.lit("@")), F.trim(bracketed)).when(
            F.contains(bare, F.lit("@")), bare
        )

    found = F.filter(F.transform(pieces, pick), lambda a: a.isNotNull())
    return F.transform(found, lambda a: F.replace(F.lower(a), F.lit("'"), F.lit("")))


def split_addresses(text: Column) -> Column:
    """Address list written with commas or semicolons."""
    return addresses_of(F.filter(F.split(text, "[,;]"), lambda s: F.trim(s) != ""))


def to_utc(text: Column, default: str | None = None) -> Column:
    """Date header to a UTC timestamp; no match means `default` or null.

    Dates without an offset count as UTC, as do those that only name their zone. Needs a session
    whose time zone is UTC.
    """
    tidy = F.trim(F.regexp_replace(F.regexp_replace(text, DATE_NOISE, ""), r"\s+", " "))
    tidy = F.regexp_replace(tidy, ZONE_NAME, "")
    tries = [F.try_to_timestamp(tidy, F.lit(fmt)) for fmt in ZONED_FORMATS + NAIVE_FORMATS]
    if default is not None:
        tries.append(F.to_timestamp(F.lit(default)))
    return F.coalesce(*tries)


def fallback_recipients(tos: Column, delivered_to: Column) -> Column:
    """Delivered-To stands in when no recipient was readable."""
    return F.when((F.size(tos) <= 0) & (F.size(delivered_to) > 0), delivered_to).otherwise(tos)


def spam_text(text: Column) -> Column:
    spaced = F.replace(
        F.regexp_replace(text, r"[^\x00-\x7F]", " "), F.lit("[:newline:]"), F.lit(" " * 11)
    )
    return F.translate(spaced, '\n\t"><', "")


def entity_text(text: Column) -> Column:
    return F.replace(
        F.regexp_replace(text, r"[^\x00-\x7F]", " "), F.lit("[:newline:]"), F.lit(" " * 11)
    )


def null_default(flag: Column, default: bool = False) -> Column:
    return F.coalesce(flag, F.lit(default))
