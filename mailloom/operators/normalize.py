"""Raw messages to the mail table.

Only MIME parsing runs in Python workers; addresses' fallback, id cleaning, categories and dates
are column expressions around it.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from email import message_from_bytes
from email.header import decode_header
from email.message import Message
from email.utils import getaddresses, parsedate_tz
from calendar import timegm

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom import schemas
from mailloom.functions import cleaning as C

# fixed values: the line between body parts, and an attachment name that is skipped
PART_BREAK = "\n=============================Next Part==============================\n"
SKIPPED_NAME = "rtf-body.rtf"

# charsets tried when the declared one is missing or unknown
FALLBACK_CHARSETS = ("utf-8", "cp1252")

_ADDRESS_HEADERS = {
    "senders": "from",
    "tos": "to",
    "delivered_to": "delivered-to",
    "ccs": "cc",
    "bccs": "bcc",
}
_LIST_HEADERS = {
    "originating_ips": "x-originating-ip",
    "forensic_bcc": "x-libpst-forensic-bcc",
    "messageid": "message-id",
    "inreplyto": "in-reply-to",
    "references": "references",
}

_PARSED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("sent_epoch", T.LongType()),
        T.StructField("date_text", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("body_as_html", T.BooleanType()),
        T.StructField("attachments", T.ArrayType(schemas.RAW_ATTACHMENT)),
    ]
    + [T.StructField(name, schemas.STRINGS) for name in _LIST_HEADERS]
    + [T.StructField(name, schemas.STRINGS) for name in _ADDRESS_HEADERS]
    + [T.StructField(f"{name}_line", schemas.STRINGS) for name in _ADDRESS_HEADERS]
)


def to_text(data: bytes | None, charset: str | None) -> str:
    """Decode with the declared charset, else a fitting one, else show the bytes as ASCII."""
    if not data:
        return ""
    try:
        return data.decode(charset or "utf-8", "replace" if charset else "strict")
    except (LookupError, ValueError):
        pass
    for guess in FALLBACK_CHARSETS:
        try:
            return data.decode(guess)
        except ValueError:
            continue
    return ascii(data)


def decode_words(text: str) -> str:
    """Header text with encoded words resolved; unreadable ones stay as they are."""
    try:
        return "".join(
            part if isinstance(part, str) else to_text(part, charset or "utf-8")
            for part, charset in decode_header(str(text))
        )
    except Exception:
        return str(text)


def parse_addresses(lines: list[str]) -> list[str]:
    found = []
    for name, addr in getaddresses(lines, strict=False):
        chosen = addr if "@" in addr else name if "@" in name else None
        if chosen:
            found.append(chosen.lower().replace("'", ""))
    return found


def sent_epoch(text: str) -> int | None:
    """Seconds since 1970 of a date header; without a numeric offset the time counts as UTC."""
    parsed = parsedate_tz(text)
    if parsed is None:
        return None
    offset = (parsed[9] or 0) if re.search(r"[+-]\d{4}", text) else 0
    try:
        return timegm(parsed[:6] + (0, 1, 0)) - offset
    except (ValueError, OverflowError):
        return None


def _assemble_body(message: Message) -> tuple[str, bool]:
    body, as_html = "", False
    for part in message.walk():
        kind = part.get_content_type()
        if kind not in ("text/plain", "text/html") or part.get_filename() is not None:
            continue
        as_html = kind == "text/html" and not body
        if body:
            body += PART_BREAK
        body += to_text(part.get_payload(decode=True), part.get_content_charset())
    return body, as_html


def _attachments(message: Message, email_id: str, keep_unnamed: bool) -> list[dict]:
    found, unnamed = [], 0
    for part in message.walk():
        if part.get_content_maintype() == "multipart" or part.get_content_type() == "message/delivery-status":
            continue
        if part.get("Content-Disposition") is None:
            continue
        name = part.get_filename()
        if not name:
            if not keep_unnamed:
                continue
            name = f"attach_{unnamed}"
            unnamed += 1
        name = decode_words(name)
        if name == SKIPPED_NAME:
            continue
        # an attached message is kept as the bytes of the message itself
        data = part.get_payload(0).as_bytes() if part.is_multipart() else part.get_payload(decode=True) or b""
        found.append(
            {
                "guid": hashlib.md5(f"{email_id}/{len(found)}".encode()).hexdigest(),
                "extension": os.path.splitext(name.lower())[1],
                "filename": name,
                "filesize": len(data),
                "content_type": part.get_content_type(),
                "charset": part.get_content_charset(),
                "contents64": base64.b64encode(data).decode("ascii"),
            }
        )
    return found


def parse_message(email_id: str, data: bytes, keep_unnamed: bool) -> dict:
    message = message_from_bytes(data)

    def header(name: str) -> list[str]:
        return [str(v) for v in message.get_all(name, [])]

    dates = header("date")
    subjects = header("subject")
    body, as_html = _assemble_body(message)
    row = {
        "id": email_id,
        "error": None,
        "sent_epoch": sent_epoch(dates[0]) if dates else None,
        "date_text": dates[0] if dates else None,
        "subject": decode_words(subjects[0]) if subjects else "",
        "body": body,
        "body_as_html": as_html,
        "attachments": _attachments(message, email_id, keep_unnamed),
    }
    for field, name in _LIST_HEADERS.items():
        row[field] = header(name)
    for field, name in _ADDRESS_HEADERS.items():
        lines = [decode_words(line) for line in header(name)]
        row[field], row[f"{field}_line"] = parse_addresses(lines), lines
    return row


def parse_messages(raw: DataFrame, keep_unnamed: bool = False) -> DataFrame:
    """One row per message of (id, data, ...): its parts, or an `error` when it could not be read.

    Other columns of the input, such as categories and provenance, are carried along.
    """
    extra = [f for f in raw.schema.fields if f.name not in ("id", "data")]
    carried = [f.name for f in extra]
    blank = {f.name: None for f in _PARSED.fields}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for email_id, data in zip(batch["id"], batch["data"]):
                try:
                    rows.append(parse_message(email_id, bytes(data), keep_unnamed))
                except Exception as error:
                    rows.append({**blank, "id": email_id, "error": f"{type(error).__name__}: {error}"})
            out = pd.DataFrame(rows, columns=list(blank)).astype({"sent_epoch": "Int64"})
            for name in carried:
                out[name] = batch[name].values
            yield out

    return raw.select("id", "data", *carried).mapInPandas(parse, T.StructType(_PARSED.fields + extra))


def normalize(raw: DataFrame, keep_unnamed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(emails, failures) of raw messages (id, data, categories, provenance columns)."""
    parsed = parse_messages(raw, keep_unnamed)
    failures = parsed.where(F.col("error").isNotNull()).select("id", "error")
    def cleaned(name: str, rules: tuple[str, ...]) -> Column:
        return F.transform(name, lambda s: C.clean(s, rules))

    ids = {
        "messageid": cleaned("messageid", C.ID_RULES),
        "inreplyto": cleaned("inreplyto", C.ID_RULES),
        "references": cleaned("references", C.REFERENCE_RULES),
    }
    emails = (
        parsed.where(F.col("error").isNull())
        .withColumns(
            {
                **ids,
                "tos": C.fallback_recipients(F.col("tos"), F.col("delivered_to")),
                "datetime": F.coalesce(F.timestamp_seconds("sent_epoch"), C.to_utc(F.col("date_text"))),
            }
        )
        .drop("error", "sent_epoch", "date_text")
    )
    return emails, failures


def ascii_variant(emails: DataFrame) -> DataFrame:
    """Header lines, addresses, subject, body and file names forced to ASCII.

    Addresses are read anew from the lower-case lines, in which tabs and line feeds separate. Columns that
    a table lacks are left out.
    """
    changes = {
        "subject": C.clean(F.col("subject"), C.ASCII_TEXT_RULES),
        "body": C.clean(F.col("body"), C.ASCII_TEXT_RULES),
        "attachments": F.transform(
            "attachments",
            lambda a: a.withField("filename", C.clean(F.lower(a.filename), C.ASCII_FILENAME_RULES)),
        ),
    }
    for field in _ADDRESS_HEADERS:
        if f"{field}_line" in emails.columns:
            lines = F.transform(f"{field}_line", lambda s: C.clean(F.lower(s), C.ASCII_LINE_RULES))
            pieces = F.flatten(F.transform(lines, lambda s: F.split(s, ";")))
            changes |= {f"{field}_line": lines, field: C.addresses_of(pieces)}
    return emails.withColumns(changes)
