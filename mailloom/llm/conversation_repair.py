"""Cheapest repair of conversations whose turns are missing, empty, repeated, cut off or out of turn.

A conversation is its rows by turn. Each row has at most one fault: it is blank, repeats an earlier row,
or is cut off before its end. A repair keeps, re-roles, deletes and inserts rows until the roles read
`(s?(ua)+)?`, an optional system turn and then user and assistant in turn, at the least cost.

A row matters to the repair by its role's initial and its fault alone, so a conversation is a short
string of nine symbols. The repair is a path through four states (start, after system, after user, after
assistant); a symbol is a 4 x 4 matrix of the cheapest ways from state to state, each with the edits that
make it, and strings multiply as matrices do, with minimum and plus. Re-Pair names frequent pairs of
symbols by new symbols until a grammar stands; each rule's matrix is the product of its two symbols',
computed once, bottom-up, and shared by all conversations. Edits are ropes, which share their parts.

Of equally cheap edits the ASCII-least string of initials wins. That choice survives products: two ways
through the same rows with equal costs are never prefixes of each other, as a prefix costs less.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mailloom.llm.shared import stored

DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
BLANK = r"\A[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
#: rows whose roles start so; all other roles are one class that has to change
INITIALS = "sua"
OTHER, GONE = "o", "x"
SYMBOLS = "sua" + OTHER + "SUAO" + GONE
#: a grammar of any size gives the same repairs; a larger one shares more products
MOST_RULES = 96
RULES_A_ROUND = 12
#: sequences whose result a task remembers
REMEMBERED = 50_000

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ENDS = (START, ASSISTANT)
#: state after a row of that role, by state before it
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")


# ---- ropes and matrices -------------------------------------------------------------------------


class Rope:
    """A string kept as the two strings it is made of; parts are shared, never copied."""

    __slots__ = ("left", "right", "text", "size")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if left is None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        return other if not self.size else self if not other.size else Rope("", self, other)

    def __str__(self) -> str:
        out, open_ = [], [self]
        while open_:
            rope = open_.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                open_ += rope.right, rope.left
        return "".join(out)


def before(a: Rope, b: Rope) -> bool:
    """Whether the string of `a` sorts before that of `b`; shared parts are not read."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if x.left is None and y.left is None:
            n = min(x.size, y.size)
            if x.text[:n] != y.text[:n]:
                return x.text[:n] < y.text[:n]
            if x.size > n:
                left.append(Rope(x.text[n:]))
            if y.size > n:
                right.append(Rope(y.text[n:]))
        elif y.left is None or (x.left is not None and x.size >= y.size):
            left += x.right, x.left
            right.append(y)
        else:
            right += y.right, y.left
            left.append(x)
    return bool(right) and not left


#: (cost, edits) of the cheapest way from the first state to the second; absent if there is none
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def offer(found: Matrix, at: tuple[int, int], cost: int, edits: Rope) -> None:
    held = found.get(at)
    if held is None or cost < held[0] or (cost == held[0] and before(edits, held[1])):
        found[at] = cost, edits


def times(a: Matrix, b: Matrix) -> Matrix:
    """Minimum over the state between of the sums; edits follow one another."""
    found: Matrix = {}
    costs: dict[tuple[int, int], int] = {}
    for (p, k), (left, _) in a.items():
        for q in STATES:
            if (k, q) in b:
                cost = left + b[k, q][0]
                if cost < costs.get((p, q), cost + 1):
                    costs[p, q] = cost
    for (p, k), (left, edits) in a.items():
        for q in STATES:
            if (k, q) in b and left + b[k, q][0] == costs[p, q]:
                offer(found, (p, q), costs[p, q], edits + b[k, q][1])
    return found


def inserts() -> Matrix:
    """Any number of inserted rows."""
    one: Matrix = {(s, s): (0, Rope()) for s in STATES}
    for role in ROLES:
        for p, q in AFTER[role].items():
            offer(one, (p, q), INSERT, Rope("I"))
    return times(times(one, one), times(one, one))


def row_matrix(symbol: str) -> Matrix:
    """One row, with whatever is inserted before it."""
    found: Matrix = {(s, s): (DELETE, Rope("D")) for s in STATES}
    if symbol != GONE:
        extra = CUT_OFF if symbol.isupper() else 0
        for p, q in AFTER.get(symbol.lower(), {}).items():
            offer(found, (p, q), extra, Rope("K"))
        for role in ROLES:
            for p, q in AFTER[role].items():
                offer(found, (p, q), REROLE + extra, Rope("R"))
    return times(inserts(), found)


class Grammar:
    """Re-Pair rules in the order they were made, and the matrix of every symbol."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.rules = rules
        self.matrices = {s: row_matrix(s) for s in SYMBOLS}
        self.end = inserts()
        for symbol, (first, second) in rules:
            self.matrices[symbol] = times(self.matrices[first], self.matrices[second])
        self.remembered: dict[tuple[str, bool], Matrix] = {}

    def product(self, symbols: str, whole: bool) -> Matrix:
        """The matrix of a string of rows; only its row of the start state if it is `whole`."""
        key = symbols, whole
        if key not in self.remembered:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            short = symbols
            for symbol, pair in self.rules:
                short = short.replace(pair, symbol)
            begin: Matrix = {(s, s): (0, Rope()) for s in ((START,) if whole else STATES)}
            self.remembered[key] = reduce(times, map(self.matrices.__getitem__, short), begin)
        return self.remembered[key]

    def finish(self, product: Matrix) -> tuple[int, str]:
        """Cost and edits of the cheapest way from the start to an allowed end."""
        best: Matrix = {}
        for (p, q), (cost, edits) in times(product, self.end).items():
            if p == START and q in ENDS:
                offer(best, (0, 0), cost, edits)
        cost, edits = best[0, 0]
        return cost, str(edits)


_GRAMMARS: dict[tuple, Grammar] = {}


def grammar_of(rules: tuple[tuple[str, str], ...]) -> Grammar:
    """The grammar of these rules, built once a worker; ropes stay shared, which pickling would undo."""
    if rules not in _GRAMMARS:
        _GRAMMARS.clear()
        _GRAMMARS[rules] = Grammar(rules)
    return _GRAMMARS[rules]


def learn_rules(sequences: DataFrame, most: int = MOST_RULES) -> tuple[tuple[str, str], ...]:
    """Re-Pair over all sequences of a `symbols` column, a batch of frequent pairs a round.

    Sequences are counted first, so equal conversations weigh in without being read again. The pairs of a
    batch share no symbol, so that their order does not matter; there are at most `most` symbols more
    than `SYMBOLS`, hence few pairs to count. It ends when no pair occurs twice.
    """
    distinct = stored(sequences.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")))
    rules: list[tuple[str, str]] = []
    while len(rules) < most:
        short = F.col("symbols")
        for symbol, pair in rules:
            short = F.replace(short, F.lit(pair), F.lit(symbol))
        left = distinct.select(short.alias("s"), "n").where(F.length("s") > 1)
        spelled = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring("s", i, F.lit(2)))
        counts = left.select(F.explode(spelled).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
        common = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * RULES_A_ROUND).collect()
        used: set[str] = set()
        batch = []
        for row in common:
            if not used & set(row.pair) and len(batch) < min(RULES_A_ROUND, most - len(rules)):
                used |= set(row.pair)
                batch.append(row.pair)
        if not batch:
            break
        rules += [(chr(0x100 + len(rules) + i), pair) for i, pair in enumerate(batch)]
    return tuple(rules)


# ---- rows to sequences --------------------------------------------------------------------------


def named(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )


def row_digest() -> Column:
    return F.md5(F.concat_ws(":", F.length("role"), "role", "text"))


ORDER = ("conv", "turn", "role", "digest")
COUNTED = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")


def segments(rows: DataFrame) -> DataFrame:
    """The rows of each conversation that lie in one task, as symbols and counts.

    Rows are dealt by ranges of (conversation, turn), so a conversation longer than a task's share is
    several segments, in the order of `part`; `edge` marks segments that may have neighbours. Whether a row
    is the first of its kind is a count over (conversation, digest) and a join on the turn as well, so no
    key of it is hot.
    """
    narrow = rows.select(
        "conv",
        "turn",
        "role",
        row_digest().alias("digest"),
        F.col("text").rlike(BLANK).alias("blank"),
        (~F.col("text").rlike(ENDED)).alias("cut_off"),
    )
    firsts = (
        narrow.where(~F.col("blank"))
        .groupBy(F.col("conv").alias("f_conv"), F.col("digest").alias("f_digest"))
        .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"].alias("f_turn"), F.lit(True).alias("is_first"))
    )
    met = F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("digest") == F.col("f_digest")) & F.col("turn").eqNullSafe(F.col("f_turn"))
    judged = narrow.join(firsts, met, "left").select(
        *ORDER, "blank", "cut_off", F.coalesce("is_first", F.lit(False)).alias("is_first")
    )
    dealt = stored(judged).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    schema = StructType(
        [rows.schema["conv"], StructField("part", LongType()), StructField("symbols", StringType())]
        + [StructField(c, LongType()) for c in COUNTED]
        + [StructField(c, StringType()) for c in ("first_initial", "last_initial")]
        + [StructField(c, LongType()) for c in ("least", "most", "first_turn", "last_turn", "edge")]
    )
    arrow = to_arrow_schema(schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        current: dict | None = None
        spelled: list[str] = []
        last_digest = None
        first = True

        def closed(edge: bool) -> dict:
            return {**current, "symbols": "".join(spelled), "edge": int(edge)}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                initial = row["role"][:1]
                initial = initial if initial and initial in INITIALS else OTHER
                if current is None or row["conv"] != current["conv"]:
                    if current is not None:
                        out.append(closed(first))
                        first = False
                    current = dict.fromkeys(COUNTED, 0) | {
                        "conv": row["conv"], "part": part, "first_initial": initial, "last_initial": None,
                        "least": None, "most": None, "first_turn": row["turn"], "last_turn": None,
                    }
                    spelled, last_digest = [], None
                repeated = not row["is_first"] or (row["digest"] == last_digest and row["turn"] == current["last_turn"])
                if current["last_initial"] is not None and current["last_initial"] + initial not in LEGAL:
                    current["illegal"] += 1
                turn = row["turn"]
                if turn is not None:
                    current["turns"] += current["last_turn"] != turn
                    current["least"] = turn if current["least"] is None else current["least"]
                    current["most"] = turn
                symbol = initial
                if row["blank"]:
                    current["blank"] += 1
                    symbol = GONE
                elif repeated:
                    current["duplicate"] += 1
                    symbol = GONE
                elif row["cut_off"]:
                    current["truncated"] += 1
                    symbol = initial.upper()
                spelled.append(symbol)
                current["rows"] += 1
                current["last_initial"], current["last_turn"], last_digest = initial, turn, row["digest"]
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
        if current is not None:
            yield pa.RecordBatch.from_pylist([closed(True)], arrow)

    return dealt.mapInArrow(gather, schema)


def joined_counts(parts: list[dict]) -> dict:
    """Counts of a conversation from those of its segments, in order."""
    total = {c: sum(p[c] for p in parts) for c in COUNTED}
    for one, other in zip(parts, parts[1:]):
        total["illegal"] += one["last_initial"] + other["first_initial"] not in LEGAL
        total["turns"] -= one["last_turn"] is not None and one["last_turn"] == other["first_turn"]
    known = [p for p in parts if p["least"] is not None]
    total["gaps"] = known[-1]["most"] - known[0]["least"] + 1 - total["turns"] if known else 0
    return total


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def solve(found: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """(conv, *RESULT, audit) of every conversation with rows.

    A conversation inside one segment is solved there. Segments at the edges of tasks become matrices in
    their tasks; only these meet, at most one a task for a conversation.
    """
    session = found.sparkSession
    conv = found.schema["conv"]
    schema = StructType([conv] + [StructField(c, LongType()) for c in RESULT] + [StructField("audit", StringType())])
    arrow = to_arrow_schema(schema)

    def solved(parts: list[dict], product: Matrix) -> dict:
        cost, audit = grammar_of(rules).finish(product)
        return {"conv": parts[0]["conv"], **joined_counts(parts), "cost": cost, "audit": audit}

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [solved([r], grammar_of(rules).product(r["symbols"], True)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([{c: r[c] for c in arrow.names} for r in rows], arrow)

    matrix = "array<struct<p:int,q:int,cost:bigint,edits:string>>"
    carried = [c for c in found.columns if c not in ("symbols", "edge")]
    edge_schema = StructType([*(found.schema[c] for c in carried), *_schema(f"matrix {matrix}", session)])
    edge_arrow = to_arrow_schema(edge_schema)

    def as_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                product = grammar_of(rules).product(r["symbols"], False)
                cells = [{"p": p, "q": q, "cost": c, "edits": str(e)} for (p, q), (c, e) in product.items()]
                rows.append({**{c: r[c] for c in carried}, "matrix": cells})
            yield pa.RecordBatch.from_pylist(rows, edge_arrow)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for parts in batch.column(0).to_pylist():
                matrices = [{(m["p"], m["q"]): (m["cost"], Rope(m["edits"])) for m in p["matrix"]} for p in parts]
                row = solved(parts, reduce(times, matrices))
                rows.append({c: row[c] for c in arrow.names})
            yield pa.RecordBatch.from_pylist(rows, arrow)

    alone = found.where("edge = 0").mapInArrow(inside, schema)
    edges = found.where("edge = 1").mapInArrow(as_matrices, edge_schema)
    ordered = F.struct("part", *(c for c in edges.columns if c != "part"))
    together = edges.groupBy("conv").agg(F.sort_array(F.collect_list(ordered)).alias("parts")).select("parts")
    return alone.unionByName(together.mapInArrow(meet, schema))


def _schema(text: str, session) -> StructType:
    return session.createDataFrame([], text).schema


# ---- repair -------------------------------------------------------------------------------------


def find_repairs(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with rows.

    Rows are taken by turn, null turns first; rows of one turn by role, then by the digest of role and
    text. A null role or text is one space; a null conversation id is an id of its own. `gaps` are the
    whole turns missing between the least and the largest, 0 if all are null. `duplicate` rows repeat role
    and text of an earlier row, repeated rows included. `illegal` counts neighbours whose initials are not
    su, ua or au. `audit` has the initials of the edits in order: Keep, Rerole, Delete, Insert.
    Other columns are not looked at; an empty table gives no rows.
    """
    found = stored(segments(named(rows, conv, turn, role, text)))
    return solve(found, learn_rules(found.select("symbols"))).withColumnRenamed("conv", "conv_id")


class Editor:
    """Carries out the edits of one conversation, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _turned(self, role: str | None) -> str:
        """The role of the next row: the given one, or the one whose turn it is."""
        initial = role[:1] if role is not None else "a" if self.state == USER else "u"
        self.state = AFTER[initial][self.state]
        return role if role is not None else ROLES[initial]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", self._turned(None), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield edit, self._turned(role if edit == "K" else None), text


def _edited(rows: DataFrame, repairs: DataFrame, conv: str, turn: str, role: str, text: str, use, schema: StructType) -> DataFrame:
    """Streams each conversation through `use(results)`, a generator of rows of `schema`.

    Every conversation is in one task, in order, its audit first: a digest of the whole can't be made in
    parts. Rows are read one batch at a time and are never gathered; sorting spills.
    """
    own = named(rows, conv, turn, role, text).withColumn("digest", row_digest()).withColumn("audit", F.lit(None).cast("string"))
    first = repairs.select(F.col("conv_id").alias("conv"), "audit")
    both = first.unionByName(own, allowMissingColumns=True)
    sorted_ = both.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), "turn", "role", "digest")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handler = None
        for batch in batches:
            out: list[dict] = []
            for r in batch.to_pylist():
                if r["audit"] is not None:
                    if handler:
                        out += handler.end()
                    handler = use(r["conv"], r["audit"])
                else:
                    out += handler.row(r["role"], r["text"])
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
        if handler:
            yield pa.RecordBatch.from_pylist(handler.end(), arrow)

    return sorted_.mapInArrow(run, schema)


class _Digest:
    def __init__(self, conv, audit: str):
        self.conv, self.editor, self.hash, self.first = conv, Editor(audit), hashlib.sha256(), True

    def _add(self, rows) -> None:
        for _, role, text in rows:
            self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
            self.first = False

    def row(self, role: str, text: str) -> list[dict]:
        self._add(self.editor.row(role, text))
        return []

    def end(self) -> list[dict]:
        self._add(self.editor.inserted())
        return [{"conv_id": self.conv, "repaired_sha256": self.hash.hexdigest()}]


class _Rows:
    def __init__(self, conv, audit: str):
        self.conv, self.editor, self.place = conv, Editor(audit), 0

    def _given(self, rows) -> list[dict]:
        out = []
        for edit, role, text in rows:
            out.append({"conv_id": self.conv, "place": self.place, "edit": edit, "role": role, "text": text})
            self.place += 1
        return out

    def row(self, role: str, text: str) -> list[dict]:
        return self._given(self.editor.row(role, text))

    def end(self) -> list[dict]:
        return self._given(self.editor.inserted())


def repaired_rows(
    rows: DataFrame, repairs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations; `repairs` as `find_repairs` gives them."""
    schema = StructType([StructField("conv_id", rows.schema[conv].dataType), *_schema("place bigint, edit string, role string, text string", rows.sparkSession)])
    return _edited(rows, repairs, conv, turn, role, text, _Rows, schema)


def repaired_digests(
    rows: DataFrame, repairs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired `role:text` lines, joined by line feeds."""
    schema = StructType([StructField("conv_id", rows.schema[conv].dataType), StructField("repaired_sha256", StringType())])
    return _edited(rows, repairs, conv, turn, role, text, _Digest, schema)


def damage(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with planted faults, chosen by the CRC-32 of `conv_id:turn`.

    Modulo 20: 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it
    the user's. Nulls count as one space; the copies of a repeated row are neighbours by their turn.
    """
    spelled = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.pmod(F.crc32(spelled.cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    changed = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return (
        rows.where(kind != 0)
        .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), changed.alias("text"), copies.alias("copy"))
        .drop("copy")
    )
