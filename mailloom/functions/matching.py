"""Every match of a pattern with its offsets, as one column expression.

Spark has `regexp_extract_all` but no offsets. A text is cut into pieces of bounded length at
characters no match can contain, each piece is matched, and the position of a match inside its
piece is found from the end of the match before it. Bounded pieces keep the work proportional to
the length of the text, and nothing leaves the row: no explode, no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE_CHARS = 4096
CONTEXT_CHARS = 50

_HITS = "array<struct<s:int,e:int,value:string>>"
_PIECES = "array<struct<base:int,text:string>>"


def _hit(start: Column, end: Column, value: Column) -> Column:
    return F.array(F.struct(start.alias("s"), end.alias("e"), value.alias("value"))).cast(_HITS)


def regex_hits(pattern: str) -> Callable[[Column], Column]:
    """Matches of a pattern without anchors or look-around that never matches nothing."""

    def hits(piece: Column) -> Column:
        def step(state: Column, value: Column) -> Column:
            start = F.position(value, piece, state.done + 1) - 1
            end = start + F.length(value)
            return F.struct(end.alias("done"), F.concat(state.out, _hit(start, end, value)).alias("out"))

        return F.aggregate(
            F.regexp_extract_all(piece, F.lit(pattern), F.lit(0)),
            F.struct(F.lit(0).alias("done"), F.array().cast(_HITS).alias("out")),
            step,
            lambda state: state.out,
        )

    return hits


def line_hits(accept: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Whole lines that satisfy a predicate."""

    def hits(piece: Column) -> Column:
        def step(state: Column, line: Column) -> Column:
            end = state.done + F.length(line)
            return F.struct(
                (end + 1).alias("done"),
                F.when(accept(line), F.concat(state.out, _hit(state.done, end, line)))
                .otherwise(state.out)
                .alias("out"),
            )

        return F.aggregate(
            F.split(piece, "\n"),
            F.struct(F.lit(0).alias("done"), F.array().cast(_HITS).alias("out")),
            step,
            lambda state: state.out,
        )

    return hits


def find_all(
    text: Column,
    hits_in: Callable[[Column], Column],
    inside: str,
    context: int = CONTEXT_CHARS,
) -> Column:
    """array<struct<s, e, value, before, after>>: non-overlapping matches in order.

    `s` and `e` are 0-based character offsets; `before` and `after` hold up to `context`
    characters around the match. `inside` is the content of a character class that covers every
    character a match may contain; texts are only ever cut after a character outside it.
    """
    cut_at = f"(?sU).{{0,{PIECE_CHARS - 1}}}[^{inside}]|[{inside}]+[^{inside}]?"

    def add(done: Column, piece: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        base = F.coalesce(last.base + F.length(last.text), F.lit(0))
        return F.concat(done, F.array(F.struct(base.alias("base"), piece.alias("text"))).cast(_PIECES))

    cut = F.aggregate(
        F.regexp_extract_all(text, F.lit(cut_at), F.lit(0)), F.array().cast(_PIECES), add
    )
    whole = F.array(F.struct(F.lit(0).alias("base"), text.alias("text"))).cast(_PIECES)
    cut_pieces = F.when(F.length(text) <= PIECE_CHARS, whole).otherwise(cut)

    def margin(near: Column, side, start: Column, size: Column) -> Column:
        # the neighbouring piece nearly always holds the whole margin
        enough = (F.length(near.text) >= context) | (near.base == 0)
        return F.when(enough, side(near.text, F.lit(context))).otherwise(F.substr(text, start, size))

    def widen_in(pieces: Column) -> Callable[[Column, Column], Column]:
        return lambda piece, i: widen(pieces, piece, i)

    def widen(pieces: Column, piece: Column, i: Column) -> Column:
        left = F.least(F.lit(context), piece.base)
        end = piece.base + F.length(piece.text)
        before = margin(F.get(pieces, i - 1), F.right, piece.base - left + 1, left)
        after = margin(F.get(pieces, i + 1), F.left, end + 1, F.lit(context))
        return F.struct(
            piece.base.alias("base"),
            left.alias("left"),
            F.when(F.size(piece.hits) > 0, F.concat(
                F.when(piece.base > 0, before).otherwise(F.lit("")),
                piece.text,
                F.when(end < F.length(text), after).otherwise(F.lit("")),
            )).alias("wide"),
            piece.hits.alias("hits"),
        )

    def place(piece: Column) -> Column:
        def one(hit: Column) -> Column:
            start = piece.left + hit.s
            before = F.least(F.lit(context), start)
            return F.struct(
                (piece.base + hit.s).alias("s"),
                (piece.base + hit.e).alias("e"),
                hit.value.alias("value"),
                F.substr(piece.wide, start - before + 1, before).alias("before"),
                F.substr(piece.wide, piece.left + hit.e + 1, F.lit(context)).alias("after"),
            )

        return F.transform(piece.hits, one)

    def matched(piece: Column) -> Column:
        return F.struct(
            piece.base.alias("base"), piece.text.alias("text"), hits_in(piece.text).alias("hits")
        )

    def placed(pieces: Column) -> Column:
        found = F.filter(F.transform(pieces, widen_in(pieces)), lambda piece: F.size(piece.hits) > 0)
        return F.flatten(F.transform(found, place))

    return F.get(F.transform(F.array(F.transform(cut_pieces, matched)), placed), F.lit(0))


def excerpt(hit: Column) -> Column:
    """The match in its context on one line: carriage returns dropped, white space runs to one space."""
    raw = F.concat(hit.before, hit.value, hit.after)
    return F.regexp_replace(F.regexp_replace(raw, r"\r+", ""), r"[ \t\n\f\x0B]+", " ")
