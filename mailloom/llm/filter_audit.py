"""What each filter of a chain removes, in every order of the filters, from decision diagrams.

A document's failures are a mask, a bit a filter. Masks are counted by part, so a part is at most
2^filters rows, however many documents it has; everything after that is small. The masks of a part
make a decision diagram whose paths spell masks and whose ends are the counts of documents that have
them. Equal sub-diagrams are one node, and a node whose failing side is empty is left out, so a node's
weight is the sum of its two sides: the documents that reach it.

Swapping two neighbouring variables of the diagram changes only nodes of the upper one, so a walk
through all orders by neighbour swaps costs little each. In an order the path on which all filters
pass yields the steps: its nodes' weights are the documents kept, the weights beside it those removed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: all orders of this many filters are 5,040 rows of seven steps a part
MOST_FILTERS = 7
#: counts carried by a mask: documents, those of good quality, toxic ones
COUNTS = ("docs", "good", "toxic")

WORD = r"[^\x20\x09-\x0D]+"
#: the fifth filter looks at other documents, the first four at the text alone
FILTERS = ("A", "B", "C", "D", "E")

AUDIT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


class Diagram:
    """A zero-suppressed decision diagram over failure masks, its ends weighted with counts."""

    def __init__(self, filters: int, counts: dict[int, tuple[int, ...]]):
        self.order = list(range(filters))
        self.width = len(next(iter(counts.values()), COUNTS))
        self.nodes: list[tuple[int, int, int] | None] = [None]  # 0 is the empty end
        self.weights: list[tuple[int, ...]] = [(0,) * self.width]
        self.known: dict[tuple, int] = {}
        self.root = self._build(0, counts)

    def _build(self, level: int, counts: dict[int, tuple[int, ...]]) -> int:
        if not counts:
            return 0
        if level == len(self.order):
            return self._end(counts[next(iter(counts))])
        bit = 1 << level
        passing = {m: c for m, c in counts.items() if not m & bit}
        failing = {m: c for m, c in counts.items() if m & bit}
        return self._node(level, self._build(level + 1, passing), self._build(level + 1, failing))

    def _end(self, weight: tuple[int, ...]) -> int:
        return self._known(("end", weight), None, weight)

    def _node(self, variable: int, passing: int, failing: int) -> int:
        if failing == 0:
            return passing
        weight = tuple(map(sum, zip(self.weights[passing], self.weights[failing])))
        return self._known((variable, passing, failing), (variable, passing, failing), weight)

    def _known(self, key: tuple, node: tuple[int, int, int] | None, weight: tuple[int, ...]) -> int:
        if key not in self.known:
            self.known[key] = len(self.nodes)
            self.nodes.append(node)
            self.weights.append(weight)
        return self.known[key]

    def _sides(self, node: int, variable: int) -> tuple[int, int]:
        spelled = self.nodes[node]
        return spelled[1:] if spelled and spelled[0] == variable else (node, 0)

    def swap(self, level: int) -> None:
        """Exchange the variables at `level` and below it; nodes keep their numbers and weights."""
        upper, lower = self.order[level : level + 2]
        for node in self._reached():
            spelled = self.nodes[node]
            if not spelled or spelled[0] != upper:
                continue
            (pp, pf), (fp, ff) = (self._sides(side, lower) for side in spelled[1:])
            if pf == ff == 0:
                continue
            del self.known[spelled]
            turned = (lower, self._node(upper, pp, fp), self._node(upper, pf, ff))
            self.nodes[node] = turned
            self.known[turned] = node
        self.order[level : level + 2] = lower, upper

    def _reached(self) -> list[int]:
        """Nodes under the root; those that swaps left behind are forgotten."""
        seen, open_ = set(), [self.root]
        while open_:
            node = open_.pop()
            if node in seen:
                continue
            seen.add(node)
            if self.nodes[node]:
                open_.extend(self.nodes[node][1:])
        self.known = {key: node for key, node in self.known.items() if node in seen}
        return sorted(seen)

    def steps(self) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        """(kept, removed) at each filter of the order, along the path on which all pass."""
        node, out = self.root, []
        for variable in self.order:
            node, failing = self._sides(node, variable)
            out.append((self.weights[node], self.weights[failing]))
        return out


def neighbour_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next one, so that every order of n things comes up exactly once."""
    if n < 2:
        return
    inner, rightwards = list(neighbour_swaps(n - 1)), False
    for turn in range(math.factorial(n - 1)):
        # the last thing walks through the others; between two walks these take their next order
        yield from range(n - 1) if rightwards else range(n - 2, -1, -1)
        if turn < len(inner):
            yield inner[turn] + (0 if rightwards else 1)
        rightwards = not rightwards


def part_steps(counts: dict[int, tuple[int, int, int]], filters: Sequence[str]) -> list[tuple]:
    """Rows of `AUDIT` without the part: every order of the filters and its steps."""
    n = len(filters)
    diagram = Diagram(n, counts)
    walked = {tuple(diagram.order): diagram.steps()}
    for level in neighbour_swaps(n):
        diagram.swap(level)
        walked[tuple(diagram.order)] = diagram.steps()
    # a filter that goes first removes all that fail it, one that goes last those that fail nothing else
    failing = {order[0]: steps[0][1][0] for order, steps in walked.items()}
    alone = {order[-1]: steps[-1][1][0] for order, steps in walked.items()}
    summed = dict.fromkeys(range(n), 0)
    for order, steps in walked.items():
        for variable, (_, removed) in zip(order, steps):
            summed[variable] += removed[0]
    rows = []
    for order in sorted(walked):
        spelled = "".join(filters[v] for v in order)
        for step, (variable, (kept, removed)) in enumerate(zip(order, walked[order]), 1):
            rows.append(
                (spelled, step, kept[0], removed[0], failing[variable] - removed[0], alone[variable],
                 removed[1], removed[2], summed[variable])
            )
    return rows


def audit(masks: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row of `AUDIT` per part, order and step.

    `masks` is (part, mask, docs, good, toxic); bit i of a mask says that filter i fails, and equal masks
    of a part add up. Filter names are one letter each. Rows with a null mask or part take no part; a null
    count is 0. An empty table gives no rows. Other columns are not looked at.
    """
    if not 1 <= len(filters) <= MOST_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"1 to {MOST_FILTERS} filters with names of their own")
    filters = tuple(filters)
    summed = (
        masks.where(F.col("part").isNotNull() & F.col("mask").isNotNull())
        .groupBy(F.col("part").alias("part"), F.col("mask").cast("int").alias("mask"))
        .agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS))
    )
    # a part has at most 2^filters rows
    parts = summed.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("masks"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                steps = part_steps({m["mask"]: tuple(m[c] for c in COUNTS) for m in found}, filters)
                orders, *numbers = zip(*steps)
                step, *numbers = map(np.array, numbers)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(steps)), pa.array(orders), pa.array(step.astype(np.int32)), *map(pa.array, numbers)],
                    [c.split()[0] for c in AUDIT.split(", ")],
                )

    return parts.mapInArrow(rows, AUDIT)


# ---- failures of documents ----------------------------------------------------------------------


def text_failures(text: Column) -> Column:
    """Bits of the four filters that need nothing but the text; null counts as empty.

    A: under 50 words. B: under 65 % of the words are different. C: over 5 % capitals. D: markup characters.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))

    def bits(w: Column) -> Column:
        fails = (
            F.size(w) < 50,
            100 * F.size(F.array_distinct(w)) < 65 * F.size(w),
            100 * capitals > 5 * F.length(text),
            text.rlike("[#$%&*|]"),
        )
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails[1:], 1)), F.when(fails[0], 1).otherwise(0))

    return F.get(F.transform(F.array(words), bits), F.lit(0)).cast("int")


def document_masks(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    part: str = "source",
    quality: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """(part, mask, docs, good, toxic): the counted failure masks of whole texts under `FILTERS`.

    E fails where a smaller id has the same text, anywhere in the table. A null text is empty, a null part
    is the empty string; a row without an id has no smaller id and is none. Rows repeated with id and text
    count each, and are no copies of each other. Labels of one id that differ: any 1 counts. Other columns
    of either table are not looked at.

    Rows are narrow before the first shuffle. Copies of a text are counted by id, label and part before
    they meet, so a text that a third of all rows share is one row for each part and label.
    """
    own = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        text_failures(F.col(text)).alias("bits"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
    )
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max(F.when(F.col(quality) == 1, 1)), F.lit(0)).alias("good"),
        F.coalesce(F.max(F.when(F.col(toxic) == 1, 1)), F.lit(0)).alias("toxic"),
    )
    marked = own.join(marks, "id", "left").na.fill(0, ["good", "toxic"])
    kind = ("digest", "part", "bits", "good", "toxic")
    by_id = marked.groupBy("id", *kind).agg(F.count(F.lit(1)).alias("n"))
    counted = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.min("id").alias("least"),
        F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
    )
    firsts = counted.groupBy("digest").agg(F.min("least").alias("first"))
    original = F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    copied = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("bits").alias("mask"), original.alias("docs")),
        F.struct(F.col("bits").bitwiseOR(F.lit(copied)).alias("mask"), (F.col("n") - original).alias("docs")),
    )
    spread = counted.join(firsts, "digest").select("part", "good", "toxic", F.explode(both).alias("m")).where("m.docs > 0")
    return spread.groupBy("part", F.col("m.mask").alias("mask")).agg(
        F.sum("m.docs").alias("docs"),
        F.sum(F.col("m.docs") * F.col("good")).alias("good"),
        F.sum(F.col("m.docs") * F.col("toxic")).alias("toxic"),
    )
