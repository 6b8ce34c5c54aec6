"""Quality rules as a ledger: measurements and failure bits of every text, judged later by policies.

Each text is measured once and every rule is evaluated once; the row keeps the measurements and one bit
a failed rule. A policy is a version with a set of rules, so a bit mask: a text is kept if it fails none
of them. New policies and ablations (what would stay without one rule) read the stored bits, never the
texts: texts are counted by their bits, and the few counts are combined with bitwise operations.

Only column expressions are used. Repeated windows are found in the row: hashes of all windows are
sorted with their places, and equal neighbours are the repeats, so a text costs n log n.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.llm.decontamination import let, places

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[^#*$%&|<>]+"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """`fails` looks at a struct of `MEASURES` and is true for a text that breaks the rule."""

    name: str
    fails: Callable[[Column], Column]


#: the order gives the bits; new rules go to the end, so that stored ledgers stay readable
RULES = (
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > 4 * m.n_words),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 60 * m.n_lines),
    Rule("short_words", lambda m: m.word_chars < 2 * m.n_words),
    Rule("long_words", lambda m: m.word_chars > 20 * m.n_words),
)
#: rules of each policy version
POLICIES = {
    "v1": ("few_words", "repeated_words"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v3": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
}


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more in the row, the first occurrence included.

    `hashes` is the array of word hashes. Windows are compared by 64-bit hashes of these.
    """

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, i: F.coalesce(F.least(s - F.get(starts, i - 1), F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, n: total + n)

    def repeats(found: Column) -> Column:
        starts = F.transform(
            found,
            lambda x, i: F.when((x.h == F.get(found, i - 1).h) | (x.h == F.get(found, i + 1).h), x.at),
        )
        return let(F.array_sort(F.array_compact(starts)), covered)

    def of_windows(w: Column) -> Column:
        several = F.size(F.array_distinct(w)) < F.size(w)
        placed = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(several, let(placed, repeats)).otherwise(F.lit(0).cast("bigint"))

    starts = places(F.size(hashes) - window + 1)
    return let(F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, window))), of_windows)


def measure(text: Column) -> Column:
    """struct of `MEASURES`; null is measured as the empty text.

    Words are runs without white space, characters are code points. Lines are split at line feeds and
    count if they have a word; a line is repeated if it equals an earlier one, character by character.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def counted(words: Column) -> Column:
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        return let(
            lines,
            lambda x: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
                F.length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint").alias("n_symbols"),
                F.size(x).cast("bigint").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
                let(hashes, lambda h: repeated_words(h)).alias("n_repeat_words"),
            ),
        )

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), counted)


def failure_bits(measures: Column, rules: Sequence[Rule] = RULES) -> Column:
    bits = [F.when(rule.fails(measures), 1 << i).otherwise(0) for i, rule in enumerate(rules)]
    return sum(bits[1:], bits[0]).cast("bigint")


def enter(docs: DataFrame, text: str = "text", into: str = "ledger", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All columns of `docs` and a struct `into`: the measures and `failures`, a bit a broken rule.

    No shuffle. Null and empty texts have zero measures and break `few_words` only. Repeated rows are
    entered each; an input column named as `into` is replaced.
    """
    names = list(MEASURES)
    ledger = let(measure(F.col(text)), lambda m: F.struct(*(m[c].alias(c) for c in names), failure_bits(m, rules).alias("failures")))
    return docs.withColumn(into, ledger)


def policy_mask(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    names = [rule.name for rule in rules]
    return sum(1 << names.index(name) for name in set(policy))


def passes(failures: Column, policy: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Whether stored failure bits have none of the policy's rules; a null ledger entry does not pass."""
    return F.coalesce(failures.bitwiseAND(F.lit(policy_mask(policy, rules))) == 0, F.lit(False))


def ablations(
    ledger: DataFrame,
    policies: Mapping[str, Sequence[str]] = POLICIES,
    by: Sequence[str] = (),
    failures: str = "ledger.failures",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """(*by, policy, rule, docs, failing, removed, kept_without): the effect of each rule of each policy.

    `failing` break the rule, `removed` break this rule of the policy and no other, so `kept_without` is
    what the policy keeps if the rule is left out. Rows are counted by their bits first: at most 2^rules
    counts for each value of `by` are combined, however many rows and however they are spread. A null in
    `by` is a value like others; rows without bits count as documents that no policy keeps.
    """
    bits = F.col(failures)
    counted = ledger.groupBy(*by, bits.alias("_bits")).agg(F.count(F.lit(1)).alias("_n"))
    names = [rule.name for rule in rules]
    cells = []
    for version, policy in policies.items():
        mask = policy_mask(policy, rules)
        for name in sorted(set(policy), key=names.index):
            bit = 1 << names.index(name)
            seen = F.col("_bits").bitwiseAND(F.lit(mask))
            cells.append(
                F.struct(
                    F.lit(version).alias("policy"),
                    F.lit(name).alias("rule"),
                    (F.col("_bits").bitwiseAND(F.lit(bit)) != 0).alias("fails"),
                    (seen == bit).alias("only"),
                    (seen.bitwiseAND(F.lit(mask & ~bit)) == 0).alias("stays"),
                )
            )
    spread = counted.select(*by, "_n", F.explode(F.array(*cells)).alias("c"))

    def total(when: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(f"c.{when}"), F.col("_n"))), F.lit(0)).cast("bigint")

    return spread.groupBy(*by, F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule")).agg(
        F.sum("_n").alias("docs"),
        total("fails").alias("failing"),
        total("only").alias("removed"),
        total("stays").alias("kept_without"),
    )
