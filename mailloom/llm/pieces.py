"""Exact sentencepiece BPE encoding by backtracking, and decoding.

A BPE encoding is the only sequence of pieces in which every piece encodes to itself and every two
neighbours are compatible: merging their characters again ends in the same two pieces. The encoder
takes the longest piece at each place (Aho-Corasick), checks it against its left neighbour by undoing
merges, falls back to shorter prefixes, and keeps a bit field of places from which no encoding leads
on. No piece holds a space mark after another character, so a text falls into runs that start at a
space mark and are encoded on their own; frequent runs are remembered.

Only the marks of several spaces in a row have equal scores, where the leftmost merge goes first;
such runs are merged directly.
"""

from __future__ import annotations

import heapq
import re
import uuid
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.llm.vocabulary import BYTE, CONTROL, NORMAL, read_vocabulary
from mailloom.llm.vocabulary import UNKNOWN as UNKNOWN_KIND

SPACE = "▁"
#: runs in each of the two generations of the memory; a run used again moves to the younger one
CACHE_RUNS = 250_000
CACHE_CHARS = 48
ENCODED = "struct<ids: array<int>, decoded: string>"


class Encoder:
    """Encodes and decodes like the library, without begin or end ids and without sampling."""

    def __init__(self, model: bytes):
        import ahocorasick

        vocabulary = read_vocabulary(model)
        self.pieces, self.kinds = vocabulary.pieces, vocabulary.kinds
        self.unknown_surface = vocabulary.unknown_surface
        normal = [i for i, kind in enumerate(self.kinds) if kind == NORMAL]
        self.id_of = {self.pieces[i]: i for i in normal}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i, kind in enumerate(self.kinds) if kind == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.special = frozenset(i for i, kind in enumerate(self.kinds) if kind != NORMAL)
        # merges of better score come first; equal scores share a rank
        ranked = {score: r for r, score in enumerate(sorted({vocabulary.scores[i] for i in normal}, reverse=True))}
        self.rank = {i: ranked[vocabulary.scores[i]] for i in normal}
        chars = {c for p in self.id_of for c in p if len(p) > 0}
        self.known = {c for c in chars if c in self.id_of}
        by_rank: dict[int, list[int]] = {}
        for i in normal:
            if len(self.pieces[i]) > 1:
                by_rank.setdefault(self.rank[i], []).append(i)
        tied = {i for ids in by_rank.values() if len(ids) > 1 for i in ids}
        for i in normal:
            mark = self.pieces[i].rfind(SPACE)
            if mark > 0 and self.pieces[i].strip(SPACE) and self.pieces[i][mark - 1] != SPACE:
                raise ValueError("a piece holds a space mark after another character")
        if any(self.pieces[i].strip(SPACE) for i in tied):
            raise ValueError("pieces other than runs of space marks share a score")
        self.splits_lines = not any("\n" in p for p in self.id_of)
        self.split: dict[int, tuple[int, int] | None] = {}
        automaton = ahocorasick.Automaton()
        for i in normal:
            piece = self.pieces[i]
            if SPACE * 2 in piece:
                continue  # such runs are merged directly
            parts, last = self.merge(piece)
            if len(parts) == 1:
                self.split[i] = last
                automaton.add_word(piece, i)
        automaton.make_automaton()
        self.automaton = automaton
        self.prefix: dict[int, int | None] = {}
        for i in self.split:
            piece = self.pieces[i]
            shorter = (self.id_of.get(piece[:n]) for n in range(len(piece) - 1, 0, -1))
            self.prefix[i] = next((j for j in shorter if j in self.split), None)
        self.lengths = [len(p) for p in self.pieces]
        self.pairs: dict[int, bool] = {}
        stop = SPACE + ("\n" if self.splits_lines else "")
        self.runs = re.compile(f"{SPACE}*[^{stop}]+|{SPACE}+" + (r"|\n" if self.splits_lines else ""))
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def merge(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Merging adjacent symbols, best score and then leftmost first: the ids, and the last merge.

        Every character has to be in the vocabulary.
        """
        ids: list[int | None] = [self.id_of[c] for c in text]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(ids):
                joined = self.id_of.get(self.pieces[ids[left]] + self.pieces[ids[right]])
                if joined is not None:
                    heapq.heappush(heap, (self.rank[joined], left, ids[left], ids[right]))

        for i in range(len(ids)):
            offer(i)
        last = None
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left] if ids[left] is not None else len(ids)
            if right >= len(ids) or ids[left] != a or ids[right] != b:
                continue
            ids[left], ids[right] = self.id_of[self.pieces[a] + self.pieces[b]], None
            last = (a, b)
            after[left] = after[right]
            if after[left] < len(ids):
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [i for i in ids if i is not None], last

    def compatible(self, left: int, right: int) -> bool:
        """Whether the characters of two neighbours merge to these two pieces again.

        Merges are undone from the latest on. Two symbols that met at the border would have been
        joined if that merge comes before the ones undone so far.
        """
        a, b = left, right
        # a merge across the border with rank under `limit`, or equal to it and further left, came first
        limit: tuple[int, int] | None = None
        answer = True
        while True:
            joined = self.id_of.get(self.pieces[a] + self.pieces[b])
            if joined is not None and (limit is None or (self.rank[joined], 1) < limit):
                answer = False
                break
            step_a = (self.rank[a], 0) if self.split[a] else None
            step_b = (self.rank[b], 2) if self.split[b] else None
            if step_a is None and step_b is None:
                break
            # undo the later of the two last merges
            if step_b is None or (step_a is not None and step_a > step_b):
                limit, a = step_a, self.split[a][1]
            else:
                limit, b = step_b, self.split[b][0]
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        self.pairs[left * len(self.pieces) + right] = answer
        return answer

    def backtrack(self, text: str) -> list[int]:
        """The encoding of a text whose characters all have pieces and no two space marks meet."""
        n, lengths, pairs, many = len(text), self.lengths, self.pairs, len(self.pieces)
        longest: list[int | None] = [None] * n
        for end, i in self.automaton.iter(text):
            longest[end + 1 - lengths[i]] = i  # later matches from one start are longer
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        place, piece, last = 0, longest[0] if n else None, None
        while piece is not None:
            while True:
                end = place + lengths[piece]
                if alive[end]:
                    fits = True if last is None else pairs.get(last * many + piece)
                    if fits is None:
                        fits = self.compatible(last, piece)
                    if fits:
                        out.append(piece)
                        place, last = end, piece
                        piece = longest[end] if end < n else None
                        break
                piece_before, piece = piece, self.prefix[piece]
                if piece is None:
                    if last is None:
                        raise ValueError(f"no encoding from piece {piece_before}")
                    alive[place] = 0
                    out.pop()
                    place -= lengths[last]
                    piece = last  # its end is dead now, so a shorter one is tried
                    last = out[-1] if out else None
                    break
        return out

    def encode_known(self, text: str) -> list[int]:
        return self.merge(text)[0] if SPACE * 2 in text else self.backtrack(text)

    def encode_run(self, run: str) -> list[int]:
        if self.known.issuperset(run):
            return self.encode_known(run)
        out: list[int] = []
        part: list[str] = []
        for c in chain(run, (None,)):
            if c is not None and c in self.known:
                part.append(c)
                continue
            if part:
                out += self.encode_known("".join(part))
                part = []
            if c is not None:
                out += [self.byte_ids[b] for b in c.encode("utf-8")]
        return out

    def look(self, run: str) -> tuple[bytes, str]:
        """Ids as 32-bit integers, and the decoded text, of one run."""
        found = self.young.get(run)
        if found is not None:
            return found
        found = self.old.get(run)
        if found is None:
            ids = self.encode_run(run)
            found = (array("i", ids).tobytes(), self.decode(ids, inner=True))
        if len(run) <= CACHE_CHARS:
            if len(self.young) >= CACHE_RUNS:
                self.young, self.old = {}, self.young
            self.young[run] = found
        return found

    def spans(self, text: str) -> list[str]:
        return self.runs.findall((SPACE + text).replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.encode_run, self.spans(text))))

    def decode(self, ids, inner: bool = False) -> str:
        """Text of ids; one leading space is dropped unless `inner`. Bytes that are no UTF-8 become U+FFFD."""
        if inner and not self.special.intersection(ids):
            return "".join([self.pieces[i] for i in ids]).replace(SPACE, " ")
        out: list[str] = []
        held = bytearray()
        start = not inner
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(utf8(held))
                held = bytearray()
                start = False
            if kind == CONTROL:
                continue
            piece = self.unknown_surface if kind == UNKNOWN_KIND else self.pieces[i]
            if start and piece.startswith(SPACE):
                piece = piece[1:]
            start = False
            out.append(piece.replace(SPACE, " "))
        if held:
            out.append(utf8(held))
        return "".join(out)


def utf8(data: bytearray) -> str:
    """Each byte outside a valid sequence becomes one U+FFFD, as in the library."""
    try:
        return bytes(data).decode("utf-8")
    except UnicodeDecodeError as error:
        good = bytes(data[: error.start]).decode("utf-8")
        return good + "�" + utf8(data[error.start + 1 :])


_ENCODERS: dict[str, Encoder] = {}


def encoder(spark: SparkSession, model: bytes):
    """A column function: text to struct<ids, decoded>. A null text counts as empty: no ids, text ''."""
    shared = spark.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(texts: pa.Array) -> pa.Array:
        if name not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[name] = Encoder(shared.value)
        own = _ENCODERS[name]
        values, offsets, decoded, total = [], [0], [], 0
        for text in texts.to_pylist():
            found = list(map(own.look, own.spans(text or "")))
            ids = b"".join([x[0] for x in found])
            values.append(ids)
            total += len(ids) // 4
            offsets.append(total)
            whole = "".join([x[1] for x in found])
            decoded.append(whole[1:] if whole.startswith(" ") else whole)
        flat = np.frombuffer(b"".join(values), dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], ["ids", "decoded"])

    # the column function finds its kind of arguments from the annotations of real classes
    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ENCODED)


def encode(docs: DataFrame, model: bytes, text: str = "text", into: str = "encoded") -> DataFrame:
    """All columns of `docs` and a struct `into` with the ids and the decoded text."""
    return docs.withColumn(into, encoder(docs.sparkSession, model)(F.col(text)))
