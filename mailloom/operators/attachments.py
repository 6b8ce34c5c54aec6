"""Attachment text, sidecar merges, splitting and image positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom import schemas
from mailloom.functions.markup import html_text

# fixed values: extensions the whitelisted extraction reads
TEXT_EXTENSIONS = (
    "doc",
    "docx",
    "txt",
    "pdf",
    "xls",
    "xlsx",
    "rtf",
    "xml",
    "html",
    "htm",
    "ppt",
    "pptx",
)
ENCRYPTED_TYPES = ("application/pkcs7-mime", "application/x-pkcs7-mime", "application/pgp-encrypted")
ENCRYPTED_ARMOUR = "-----BEGIN PGP MESSAGE-----"

# fixed values: keys an attachment row keeps, and the parent's keys that override them
ATTACHMENT_KEYS = (
    "guid",
    "extension",
    "filename",
    "content",
    "contents64",
    "content_extracted",
    "content_encrypted",
    "content_length",
    "content_type",
    "content_hash",
    "content_tika_langid",
    "exif",
    "image_analytics",
    "metadata",
    "size",
)
PARENT_KEYS = ("id", "datetime", "ingest_id", "case_id", "alt_ref_id", "label", "original_artifact")

LEGACY_FIELDS = ("content", "content_encrypted", "content_extracted")


def bare_extension(extension: Column) -> Column:
    return F.lower(F.regexp_replace(extension, r"^\.", ""))


def content_hash(data: Column) -> Column:
    return F.sha2(data, 256)


def extraction_status(content_type: Column, data: Column) -> Column:
    """ok, encrypted, or failed for types that hold no readable text."""
    armoured = F.coalesce(F.startswith(data.cast("string"), F.lit(ENCRYPTED_ARMOUR)), F.lit(False))
    return (
        F.when(data.isNull(), F.lit("failed"))
        .when(content_type.isin(*ENCRYPTED_TYPES) | armoured, F.lit("encrypted"))
        .when(content_type.startswith("text/"), F.lit("ok"))
        .otherwise(F.lit("failed"))
    )


# what the 128 upper bytes of the Windows charset stand for where Latin-1 has control characters
_WINDOWS = {n: bytes([n]).decode("cp1252") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def decoded(data: Column, charset: Column | None = None) -> Column:
    """Text of bytes: by the declared charset if it is a known one and fits, else by what the bytes show: byte
    order marks, then UTF-8, then one byte a character."""
    mark = F.hex(F.substring(data, 1, 2))
    utf8 = data.cast("string")
    latin = F.decode(data, "ISO-8859-1")
    shown = (
        F.when(mark.isin("FFFE", "FEFF"), F.decode(data, "UTF-16"))
        .when(F.is_valid_utf8(utf8), F.regexp_replace(utf8, "^\uFEFF", ""))
        .otherwise(latin)
    )
    if charset is None:
        return shown
    name = F.lower(charset)
    even = (F.octet_length(data) % 2 == 0) & ~mark.isin("FFFE", "FEFF")
    windows = F.translate(latin, "".join(map(chr, _WINDOWS)), "".join(_WINDOWS.values()))
    return (
        F.when(name.isin("iso-8859-1", "latin-1", "latin1"), latin)
        .when(name.isin("windows-1252", "cp1252"), windows)
        .when((name == "utf-16le") & even, F.decode(data, "UTF-16LE"))
        .when((name == "utf-16be") & even, F.decode(data, "UTF-16BE"))
        .otherwise(shown)
    )


def _opened(a: Column, charset: bool) -> Column:
    data = F.try_to_binary(F.when(a.contents64 != "", a.contents64), F.lit("base64"))
    return F.struct(
        a.guid.alias("guid"),
        a.content_type.alias("type"),
        (a.charset if charset else F.lit(None).cast("string")).alias("charset"),
        data.alias("data"),
        extraction_status(a.content_type, data).alias("status"),
    )


def _entry(o: Column) -> Column:
    ok = o.status == "ok"
    raw = decoded(o.data, o.charset)
    text = F.when(ok, F.when(o.type == "text/html", html_text(raw)).otherwise(raw))
    return F.struct(
        o.guid.alias("guid"),
        text.alias("content"),
        F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("content_length"),
        F.lit(None).cast("string").alias("content_tika_langid"),
        (~ok).alias("content_encrypted"),
        ok.alias("content_extracted"),
        content_hash(o.data).alias("content_hash"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        F.octet_length(o.data).cast("bigint").alias("size"),
    )


def _has_charset(emails: DataFrame) -> bool:
    return "charset" in emails.schema["attachments"].dataType.elementType.fieldNames()


def extract_text(emails: DataFrame, extensions: Sequence[str] | None = None) -> DataFrame:
    """(id, attachments): one sidecar entry per attachment that could be read.

    Encrypted ones get an entry without content; other failures get none. With `extensions`,
    only those are read and mails left without entries give no row. Each mail stays one row
    throughout, so there is nothing to shuffle. A declared `charset` of an attachment is used.
    """
    declared = _has_charset(emails)
    chosen = F.filter("attachments", lambda a: F.coalesce(a.contents64, F.lit("")) != "")
    if extensions is not None:
        chosen = F.filter(chosen, lambda a: bare_extension(a.extension).isin(*extensions))
    readable = F.filter(F.transform(chosen, lambda a: _opened(a, declared)), lambda o: o.status != "failed")
    entries = F.transform(readable, _entry).cast(schemas.TEXT_SIDECAR)
    rows = emails.where(F.size("attachments") > 0).select("id", entries.alias("attachments"))
    return rows if extensions is None else rows.where(F.size("attachments") > 0)


def read_attachments(emails: DataFrame) -> DataFrame:
    """The mails with the text of their attachments beside the binaries, as a merge with `extract_text` would
    give them, but inside the row: no join, and no body moves.

    Every attachment with a body also has its digest and size; those that can't be read have no content.
    A guid is one attachment.
    """
    declared = _has_charset(emails)
    own = [f.name for f in emails.schema["attachments"].dataType.elementType.fields]
    extracted = {f.name: f.dataType for f in schemas.TEXT_SIDECAR.elementType.fields if f.name != "guid"}

    def with_text(a: Column) -> Column:
        def overlay(o: Column) -> Column:
            read = o.status != "failed"
            entry = _entry(o)
            always = ("content_hash", "size")
            new = {c: (entry[c] if c in always else F.when(read, entry[c])).cast(t) for c, t in extracted.items()}
            new["size"] = F.when(o.data.isNotNull(), new["size"])
            kept = [(F.coalesce(new[c], a[c]) if c in new else a[c]).alias(c) for c in own]
            return F.struct(*kept, *(v.alias(c) for c, v in new.items() if c not in own))

        return _with(_opened(a, declared), overlay)

    return emails.withColumn("attachments", F.transform("attachments", with_text))


def set_content_language(sidecar: DataFrame, languages: DataFrame) -> DataFrame:
    """Fill content_tika_langid from (guid, lang) rows."""
    rows = sidecar.select("id", F.posexplode("attachments").alias("pos", "a"))
    found = rows.join(languages, rows["a.guid"] == languages["guid"], "left").select(
        "id",
        "pos",
        F.col("a").withField("content_tika_langid", F.coalesce(F.col("lang"), F.lit("UNKNOWN"))).alias("a"),
    )
    by_place = F.map_from_entries(F.collect_list(F.struct("pos", "a")))
    return (
        found.groupBy("id")
        .agg(by_place.alias("m"))
        .select(
            "id",
            F.transform(F.sort_array(F.map_keys("m")), lambda i: F.try_element_at("m", i)).alias("attachments"),
        )
    )


def merge_sidecar(
    emails: DataFrame,
    sidecar: DataFrame,
    fields: Sequence[str] | None = None,
    documents: bool = False,
) -> DataFrame:
    """Overlay sidecar entries on the first attachment with the same guid.

    A value the sidecar has wins, and a later entry for the same guid wins over an earlier one.
    Entries without an attachment are ignored; mails without a sidecar stay as they are. With
    `documents`, each matched attachment's OCR text, else its content, becomes the body.
    """
    own = [f.name for f in emails.schema["attachments"].dataType.elementType.fields]
    side_fields = sidecar.schema["attachments"].dataType.elementType.fields
    side = [f.name for f in side_fields if f.name != "guid" and (fields is None or f.name in fields)]
    types = {f.name: f.dataType for f in side_fields}
    joined = emails.join(sidecar.select("id", F.col("attachments").alias("_side")), "id", "left")
    nothing = F.struct(*[F.lit(None).cast(types[name]).alias(name) for name in side])

    def later(found: Column, e: Column) -> Column:
        return F.struct(*[F.coalesce(e[name], found[name]).alias(name) for name in side])

    # all fields in one walk over the entries, which each attachment looks up once
    def overlay(a: Column, first: Column) -> Column:
        entries = F.filter("_side", lambda e: e.guid == a.guid)
        latest = F.when(first, F.aggregate(entries, nothing, later)) if side else None

        def merged(new: Column | None) -> Column:
            return F.struct(
                *[(F.coalesce(new[name], a[name]) if name in side else a[name]).alias(name) for name in own],
                *[new[name].alias(name) for name in side if name not in own],
            )

        return merged(None) if latest is None else _with(latest, merged)

    guids = F.transform("attachments", lambda a: a.guid)
    overlaid = _with(
        guids, lambda g: F.transform("attachments", lambda a, i: overlay(a, F.array_position(g, a.guid) == i + 1))
    )
    merged = joined.withColumn("attachments", overlaid)
    if documents:
        names = set(own) | set(side)

        def text_of(a: Column) -> Column:
            found = [a.content] if "content" in names else []
            if "image_analytics" in names:
                found.insert(0, a.image_analytics.ocr_output)
            return F.coalesce(*found, F.lit(None).cast("string"))

        def step(body: Column, entry: Column) -> Column:
            owner = F.get(F.filter("attachments", lambda a: a.guid == entry.guid), F.lit(0))
            return F.coalesce(_with(owner, text_of), body)

        merged = merged.withColumn(
            "body",
            F.when(F.col("_side").isNull(), F.col("body")).otherwise(
                F.aggregate("_side", F.col("body"), step)
            ),
        )
    return merged.drop("_side")


def merge_sidecars(emails: DataFrame, *sidecars: DataFrame, documents: bool = False) -> DataFrame:
    """Text, image analytics and OCR sidecars, one after the other."""
    for sidecar in sidecars:
        emails = merge_sidecar(emails, sidecar, documents=documents)
    return emails


def bodies_from_contents(emails: DataFrame) -> DataFrame:
    """For loose files read as mails: the last content of an attachment becomes the body."""
    texts = F.filter(F.transform("attachments", lambda a: a.content), lambda t: t.isNotNull())
    return emails.withColumn("body", F.coalesce(F.get(texts, F.size(texts) - 1), F.col("body")))


def strip_binaries(emails: DataFrame) -> DataFrame:
    return emails.withColumn("attachments", F.transform("attachments", lambda a: a.dropFields("contents64")))


def to_attachments(emails: DataFrame) -> DataFrame:
    """One row per attachment with its known keys; the mail's keys override."""
    own = {f.name for f in emails.schema["attachments"].dataType.elementType.fields}
    parent = [c for c in PARENT_KEYS if c in emails.columns]
    kept = [k for k in ATTACHMENT_KEYS if k in own and k not in parent]
    rows = emails.select(*parent, F.explode("attachments").alias("a"))
    return rows.select(*[F.col(f"a.{k}").alias(k) for k in kept], *parent)


# ---- image positions --------------------------------------------------------------------------


def _with(value: Column, use) -> Column:
    """`use(value)` with the value computed once however often it is mentioned."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _ratio(text: Column) -> Column:
    def divide(parts: Column) -> Column:
        return F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).otherwise(
            F.try_divide(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
        )

    return _with(F.transform(F.split(F.trim(text), "/"), lambda n: n.try_cast("double")), divide)


def degrees(dms: Column) -> Column:
    """'d,m,s' with optional fractions a/b to degrees."""
    return _with(
        F.transform(F.split(dms, ","), _ratio),
        lambda v: F.get(v, F.lit(0)) + F.get(v, F.lit(1)) / 60 + F.get(v, F.lit(2)) / 3600,
    )


def validate_coord(value: Column, limit: float) -> Column:
    """Out-of-range coordinates become 0."""
    return _with(value, lambda v: F.when(F.abs(v) > limit, F.lit(0.0)).otherwise(v))


def gps_from_tags(images: DataFrame) -> DataFrame:
    """Add gps{latref, lonref, altref, alt, coord} to rows of image tags.

    Input columns: extension, latref, lonref, altref, lat_dms, lon_dms, alt. Only .jpg and .jpeg
    have a position, and only when both coordinates are there.
    """

    def signed(dms: str, ref: str, positive: str) -> Column:
        return degrees(F.col(dms)) * F.when(F.col(ref) == positive, F.lit(1.0)).otherwise(F.lit(-1.0))

    jpeg = bare_extension(F.col("extension")).isin("jpg", "jpeg")
    coord = F.struct(F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))
    gps = F.struct("latref", "lonref", "altref", "alt", coord.alias("coord"))
    return (
        images.withColumns(
            {
                "_lat": validate_coord(signed("lat_dms", "latref", "N"), 90.0),
                "_lon": validate_coord(signed("lon_dms", "lonref", "E"), 180.0),
            }
        )
        .withColumn("gps", F.when(jpeg & F.col("_lat").isNotNull() & F.col("_lon").isNotNull(), gps))
        .drop("_lat", "_lon")
    )
