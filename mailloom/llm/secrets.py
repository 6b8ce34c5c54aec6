"""Secrets in texts, told from widely copied examples by how many owners have the same value.

Three base kinds are found by pattern: assignments, access keys and long hexadecimal runs. The method
adds runs of `GENERIC` characters that mix lower case, upper case and digits, if no base span
overlaps them and the value is specific: the digests of all values are counted over the corpus by
distinct owners and, within an owner, by distinct repositories, and a value of more than
`OWNERS` owners, or in more than `REPOSITORIES` repositories of one owner, is an example that was copied
around. Base spans stay whatever their count; it is reported beside them.

Only column expressions are used. Offsets come from the pieces between the matches. Counting goes
from (value, owner, repository) up, so a value that a third of all documents have is summed before it
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.llm.decontamination import let
from mailloom.llm.shared import row_key, stored

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group that holds the value, least length of that group
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
GENERIC = r"[A-Za-z0-9_+/=-]{20,}"
OWNERS = 2
#: repositories of one owner that may share a value of its own
REPOSITORIES = 10
KINDS = [kind for kind, *_ in BASE] + ["generic"]
SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def placed(text: Column, pattern: str) -> Column:
    """array<struct<start, match>> of the matches of a pattern, leftmost first, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def starts(m: Column, gaps: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            at = state.at + F.length(F.get(gaps, i))
            return F.struct(
                (at + F.length(F.get(m, i))).alias("at"),
                F.concat(state.out, F.array(F.struct(at.alias("start"), F.get(m, i).alias("match")))).alias("out"),
            )

        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,match:string>>").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), empty, add, lambda state: state.out)

    return F.when(
        text.rlike(pattern), let(matches, lambda m: let(between, lambda gaps: starts(m, gaps)))
    ).otherwise(F.array().cast("array<struct<start:int,match:string>>"))


def base_spans(text: Column) -> Column:
    """Accepted matches of all base kinds, by start and then kind."""

    def of(rank: int, pattern: str, group: int, least: int) -> Column:
        # a run of fixed characters that is too short cannot hide a longer one, so it need not match
        wide = pattern[:-1] + f"{{{least - (4 if rank == 1 else 0)},}}" if group == 0 else pattern

        def span(x: Column) -> Column:
            return F.struct(
                x.start.alias("start"),
                F.lit(rank).alias("rank"),
                (x.start + F.length(x.match)).alias("end"),
                (F.regexp_extract(x.match, pattern, group) if group else x.match).alias("value"),
            )

        return F.filter(F.transform(placed(text, wide), span), lambda x: F.length(x.value) >= least).cast(SPAN)

    return F.array_sort(F.concat(*(of(rank, *rest) for rank, (_, *rest) in enumerate(BASE))))


def generic_spans(text: Column, base: Column) -> Column:
    rank = len(BASE)

    def span(x: Column) -> Column:
        return F.struct(x.start.alias("start"), F.lit(rank).alias("rank"), (x.start + F.length(x.match)).alias("end"), x.match.alias("value"))

    def wanted(x: Column) -> Column:
        mixed = x.value.rlike("[a-z]") & x.value.rlike("[A-Z]") & x.value.rlike("[0-9]")
        return mixed & ~F.exists(base, lambda b: (b.start < x.end) & (x.start < b.end))

    return F.filter(F.transform(placed(text, GENERIC), span), wanted).cast(SPAN)


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str | None = None,
    into: str = "secrets",
) -> DataFrame:
    """(id column, `into`): for every row an array of spans <start, end, kind, digest, owners, repositories, live>.

    Spans are sorted by start and then kind. `live` is false for values of more than `OWNERS` owners or in more
    than `REPOSITORIES` repositories of one owner.
    A document is a repository of its own unless a column names one. A null owner counts as one
    owner. A null text has no spans; repeated rows are one repository.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    key = row_key(F.col(id_col), F.col(text))
    repo = F.col(repository).cast("string") if repository else F.hex(key)
    found = let(
        base_spans(body),
        lambda base: F.struct(base.alias("base"), generic_spans(body, base).alias("more")),
    )
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(owner).cast("string").alias("owner"), repo.alias("repo"), found.alias("x"))
    digested = F.transform(
        F.concat("x.base", "x.more"),
        lambda s: F.struct(s.start.alias("start"), s.rank.alias("rank"), s.end.alias("end"), F.sha2(s.value, 256).alias("digest")),
    )
    rows = stored(rows.select("id", "key", "owner", "repo", digested.alias("spans")))
    each = rows.select("key", "owner", "repo", F.explode("spans").alias("s")).select("key", "owner", "repo", "s.*")
    owners = F.coalesce("owner", F.lit(""))
    counts = (
        each.select("digest", owners.alias("owner"), F.coalesce("repo", F.lit("")).alias("repo")).distinct()
        .groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
        .groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("repositories").alias("most"))
    )
    kind = F.get(F.array(*map(F.lit, KINDS)), F.col("rank"))
    live = (F.col("owners") <= OWNERS) & (F.col("most") <= REPOSITORIES)
    spans = (
        each.select("key", "start", "rank", "end", "digest").distinct().join(counts, "digest")
        .where((F.col("rank") < len(BASE)) | live)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", kind.alias("kind"), "digest", "owners", "repositories", live.alias("live")))).alias("all"))
    )
    ordered = F.transform("all", lambda s: s.dropFields("rank"))
    empty = "array<struct<start:int,end:int,kind:string,digest:string,owners:bigint,repositories:bigint,live:boolean>>"
    joined = rows.select("id", "key").join(spans.select("key", ordered.cast(empty).alias("all")), "key", "left")
    return joined.select(F.col("id").alias(id_col), F.coalesce("all", F.array().cast(empty)).alias(into))
