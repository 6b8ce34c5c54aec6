"""Readable text of HTML."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what is dropped whole and what breaks a line
HIDDEN = (r"(?is)<!--.*?-->", r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>")
BREAKS = r"(?i)<(?:br|p|div|li|tr|h[1-6]|title|table|ul|ol)\b[^>]*>"
TAGS = r"(?s)<[^>]*>"
#: characters of the named references, from the standard library's table; a hard space is a plain one
NAMED = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,8});"


def resolve_references(text: Column) -> Column:
    """Named, decimal and hexadecimal character references as characters; unknown ones stay."""
    named = F.map_from_arrays(F.array(*map(F.lit, NAMED)), F.array(*map(F.lit, NAMED.values())))

    def character(code: Column) -> Column:
        usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        space = F.when(code == 160, F.lit(" "))
        return F.when(usable, F.coalesce(space, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))

    def piece(part: Column, i: Column) -> Column:
        name = F.regexp_extract(part, REFERENCE, 1)
        number = F.when(
            F.lower(F.left(name, F.lit(2))) == "#x", F.conv(F.substr(name, F.lit(3)), 16, 10)
        ).otherwise(F.substr(name, F.lit(2)))
        found = F.when(F.startswith(name, F.lit("#")), character(number.cast("long"))).otherwise(
            F.try_element_at(named, name)
        )
        whole = F.concat(F.lit("&"), part)
        resolved = F.when((name != "") & found.isNotNull(), F.concat(found, F.substr(part, F.length(name) + 2)))
        return F.when(i == 0, part).otherwise(F.coalesce(resolved, whole))

    return F.array_join(F.transform(F.split(text, "&"), piece), "")


def html_text(html: Column) -> Column:
    text = html
    for pattern in HIDDEN:
        text = F.regexp_replace(text, pattern, " ")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, " ")
    text = resolve_references(text)
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    return F.trim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))
