"""One query for each operator over its whole table; `ORACLES` has DuckDB text where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.llm import (
    conversation_repair,
    decontamination,
    filter_audit,
    language_id,
    lines,
    minhash,
    pieces,
    quality_ledger,
    secrets,
    spans,
    topk,
    toxicity,
    urls,
    vocabulary,
)
from mailloom.llm.shared import stored, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def model_bytes(path: str | None = None) -> bytes:
    """The public model file, read on the driver; executors get its bytes."""
    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.where(~held), vocabulary.normal_pieces(model_bytes()))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, the items, and whether it is contaminated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "overlap.n_words",
        "overlap.n_hit",
        F.size("overlap.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("overlap.items", ","), 256).alias("items_sha256"),
        "overlap.contaminated",
    )


ORACLES["op2_decontamination"] = r"""
WITH low AS (
    SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    UNION ALL
    SELECT 'i', row_number() OVER (), item_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS MATERIALIZED (
    SELECT kind, r, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
item_windows AS MATERIALIZED (
    SELECT DISTINCT id AS item, n, array_to_string(w[s : s + n - 1], ' ') AS x
    FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS s
          FROM (SELECT *, least(len(w), 13) AS n FROM words WHERE kind = 'i' AND len(w) > 0))),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
    SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS x
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM words, lengths WHERE kind = 'd' AND len(w) >= n)),
met AS MATERIALIZED (SELECT r, item, s, n FROM doc_windows JOIN item_windows USING (n, x)),
hit AS (SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS i FROM met) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT r, item::VARCHAR AS item FROM met) GROUP BY r)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN items USING (r) WHERE kind = 'd'
"""


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and the digest of the decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, model_bytes())
    return found.select(
        "doc_id",
        F.size("encoded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("encoded.ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("encoded.decoded"), 256).alias("decoded_sha256"),
    )


@query
def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.mark_duplicates(docs)


ORACLES["op4_minhash_dedup"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 2], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
    SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * met.n >= 85 * (x.n + y.n - met.n)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, a = min(b) AS kept
FROM reach LEFT JOIN sizes ON doc_id = a GROUP BY a
"""


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets.find(docs)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(listed(F.filter("secrets", lambda s: s.kind != "generic")), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def _spans_sql(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    value = f"regexp_extract(m[i], '{pattern}', {group})"
    return f"""
    SELECT r, {rank} AS rank, '{kind}' AS kind, start, start + length(m[i]) AS stop, {value} AS value FROM (
        SELECT r, m, i, list_sum(list_transform(p[1 : i], lambda x: length(x)))
                        + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS start
        FROM (SELECT r, m, p, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p
                    FROM texts WHERE regexp_matches(t, '{pattern}'))))
    WHERE length({value}) >= {least}"""


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN_SQL = (
    "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)

ORACLES["op5_secrets"] = f"""
WITH texts AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED ({" UNION ALL ".join((
    _spans_sql(0, "assign", _ASSIGN_SQL, 2, 6),
    _spans_sql(1, "access", "AKIA[A-Z0-9]+", 0, 20),
    _spans_sql(2, "hex", "[0-9a-f]+", 0, 24)))}),
generic AS MATERIALIZED (
    SELECT g.* FROM ({_spans_sql(3, "generic", "[A-Za-z0-9_+/=-]{20,}", 0, 20)}) g
    WHERE regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')
      AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = g.r AND b.start < g.stop AND g.start < b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM generic),
owners AS (
    SELECT value, count(*) AS n, max(repositories) AS most FROM (
        SELECT value, coalesce(source, '') AS owner, count(DISTINCT coalesce(doc_id::VARCHAR, '-') || ' ' || md5(t)) AS repositories
        FROM every JOIN texts USING (r) GROUP BY ALL)
    GROUP BY value),
kept AS (SELECT every.* FROM every JOIN owners USING (value) WHERE rank < 3 OR (n <= 2 AND most <= 10))
SELECT doc_id,
       count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) FILTER (rank IS NOT NULL), '') AS spans
FROM texts LEFT JOIN kept USING (r) GROUP BY r, doc_id
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines kept elsewhere, with its number of lines and of removed ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.dedup_lines(docs)
    return found.select("doc_id", "deduped.n_lines", "deduped.n_removed", "deduped.text")


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many lie in passages found elsewhere, and the digest of the rest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = spans.remove_repeats(docs)
    return found.select(
        "doc_id", "cleaned.n_words", "cleaned.n_removed", F.sha2(F.col("cleaned.kept"), 256).alias("kept_sha256")
    )


ORACLES["op8_substring_dedup"] = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents),
windows AS MATERIALIZED (
    SELECT r, s, md5(array_to_string(words[s : s + 34], ' ')) AS h
    FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS s FROM docs)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT r, unnest(range(s, s + 35)) AS i FROM windows JOIN repeated USING (h)),
word_rows AS (SELECT r, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM docs),
kept AS (
    SELECT r, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS kept
    FROM word_rows ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(URL_RULES), urls.RULES)
    return urls.judge(pages, rules).select("page_id", "judged.*")


ORACLES["op9_url_filter"] = r"""
WITH rules(r_host, r_path, verdict) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (
    SELECT row_number() OVER () AS r, page_id,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
seen AS (
    SELECT r, page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts),
fits AS (
    SELECT r, r_host || r_path AS rule, verdict,
           row_number() OVER (PARTITION BY r ORDER BY length(r_host || r_path) DESC) AS place
    FROM seen JOIN rules
      ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM seen LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (r)
"""


@query
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every vector whose id is divisible by 50, over all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLES["op10_top_k"] = """
WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM (SELECT DISTINCT * FROM v) a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade(docs, model).select("doc_id", "toxicity.*")


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effect of five filters in each of their 120 orders, by source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    masks = filter_audit.document_masks(docs, table(spark, sf_dir, "labels"))
    return filter_audit.audit(masks)


ORACLES["op11_filter_audit"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
marks AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
judged AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
            'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
            'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)} AS f
    FROM texts LEFT JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
failed AS MATERIALIZED (
    SELECT part, set_, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'],
              lambda x: CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS set_
          FROM judged) GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, i AS step, o[i] AS filter FROM orders, (SELECT unnest(range(1, 6)) AS i)),
counted AS (
    SELECT part, o, step, filter,
           coalesce(sum(n) FILTER (NOT list_has_any(set_, o[1 : step])), 0) AS kept,
           coalesce(sum(n) FILTER (list_contains(set_, filter) AND NOT list_has_any(set_, o[1 : step - 1])), 0) AS removed,
           coalesce(sum(n) FILTER (list_contains(set_, filter) AND list_has_any(set_, o[1 : step - 1])), 0) AS redundant,
           coalesce(sum(n) FILTER (set_ = [filter]), 0) AS unique_fails,
           coalesce(sum(good) FILTER (list_contains(set_, filter) AND NOT list_has_any(set_, o[1 : step - 1])), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (list_contains(set_, filter) AND NOT list_has_any(set_, o[1 : step - 1])), 0) AS toxic_lost
    FROM failed, steps GROUP BY part, o, step, filter)
SELECT part, array_to_string(o, '') AS filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM counted
"""


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and verdict of every document, and the bits of the rules that it breaks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    entry = F.col("ledger")
    base = quality_ledger.passes(entry["failures"], quality_ledger.POLICIES["v1"])
    kept = base & quality_ledger.passes(entry["failures"], quality_ledger.POLICIES["v3"])
    return quality_ledger.enter(docs).select(
        "doc_id",
        *(entry[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        (~base).alias("base_failed"),
        kept.alias("kept"),
        entry["failures"].alias("failures"),
    )


_LEDGER_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT r, s, w[s : s + 7] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS s FROM texts)),
again AS (SELECT r, unnest(list(s)) AS s FROM windows GROUP BY r, x HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(s, s + 8)) AS i FROM again) GROUP BY r),
measured AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM texts LEFT JOIN covered USING (r)),
ledger AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 10 * n_symbols > 4 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
            + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
            + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)::BIGINT AS failures
    FROM measured)
"""

ORACLES["op12_quality_rules"] = (
    _LEDGER_SQL
    + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failures = 0 AS kept, failures
FROM ledger"""
)


@query
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy removes alone, and what the policy keeps without it, by source."""
    docs = table(spark, sf_dir, "documents").select("source", "text")
    return quality_ledger.ablations(quality_ledger.enter(docs), by=("source",))


ORACLES["quality_ablations"] = (
    _LEDGER_SQL
    + """, rules(rule, bit) AS (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8),
    ('short_words', 16), ('long_words', 32)),
policies(policy, mask) AS (VALUES ('v1', 3), ('v2', 15), ('v3', 63))
SELECT source, policy, rule, count(*) AS docs, count(*) FILTER (failures & bit <> 0) AS failing,
       count(*) FILTER (failures & mask = bit) AS removed, count(*) FILTER (failures & (mask - bit) = 0) AS kept_without
FROM ledger, policies JOIN rules ON mask & bit <> 0 GROUP BY source, policy, rule"""
)


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of every conversation, after planted damage."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversation_repair.damage(given)
    repairs = stored(conversation_repair.find_repairs(rows))
    digests = conversation_repair.repaired_digests(rows, repairs)
    every = given.select(F.col("conv_id").alias("own")).distinct()
    counts = conversation_repair.RESULT
    found = (
        every.join(repairs, F.col("own").eqNullSafe(F.col("conv_id")), "left")
        .drop("conv_id")
        .join(digests, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    )
    return found.select(
        F.col("own").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


ORACLES["op13_conversation_repair"] = r"""
WITH RECURSIVE crcs AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
given AS (
    SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations), crcs),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM given),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
    SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
           NOT regexp_matches(text, '[^ 	-
]') AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut FROM placed),
rows_ AS MATERIALIZED (
    SELECT *, blank OR again AS gone, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM judged),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
           count(*) FILTER (NOT gone AND cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows_ GROUP BY conv_id),
turns(p, x, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
adds(p, q, cost, edits) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''),
    (0, 2, 3, 'I'), (1, 2, 3, 'I'), (3, 2, 3, 'I'), (2, 3, 3, 'I'),
    (0, 3, 6, 'II'), (1, 3, 6, 'II'), (3, 3, 6, 'II'), (2, 2, 6, 'II')),
edits(x, gone, cut, p, q, cost, edit) AS (
    SELECT x, g, c, p, p, 4, 'D' FROM (VALUES ('s'), ('u'), ('a'), ('o')) a(x), (VALUES (true), (false)) b(g), (VALUES (true), (false)) d(c),
        (VALUES (0), (1), (2), (3)) e(p)
    UNION ALL SELECT x, false, c, p, q, CASE WHEN c THEN 3 ELSE 0 END, 'K' FROM turns, (VALUES (true), (false)) d(c)
    UNION ALL SELECT a.x, false, c, p, q, CASE WHEN c THEN 6 ELSE 3 END, 'R'
        FROM turns, (VALUES ('s'), ('u'), ('a'), ('o')) a(x), (VALUES (true), (false)) d(c) WHERE turns.x <> 's'),
ways AS (
    SELECT x, gone, cut, adds.p AS p, edits.q AS q, min({'cost': adds.cost + edits.cost, 'edits': adds.edits || edit}) AS best
    FROM adds JOIN edits ON adds.q = edits.p GROUP BY ALL),
walk AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0, 'edits': ''} AS best FROM counts
    UNION ALL
    SELECT w.conv_id, w.i + 1, ways.q, min({'cost': w.best.cost + ways.best.cost, 'edits': w.best.edits || ways.best.edits})
    FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
         JOIN ways ON ways.x = r.initial AND ways.gone = r.gone AND ways.cut = r.cut AND ways.p = w.state
    GROUP BY w.conv_id, w.i, ways.q),
ended AS (
    SELECT w.conv_id, min({'cost': w.best.cost + adds.cost, 'edits': w.best.edits || adds.edits}) AS best
    FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n JOIN adds ON adds.p = w.state
    WHERE adds.q IN (0, 3) GROUP BY w.conv_id),
letters AS (
    SELECT conv_id, pos, substr(best.edits, pos, 1) AS edit, length(replace(substr(best.edits, 1, pos), 'I', '')) AS i
    FROM (SELECT conv_id, best, unnest(range(1, length(best.edits) + 1)) AS pos FROM ended)),
stays AS (
    SELECT l.conv_id, pos, edit, role, text, edit = 'K' AND initial = 's' AS system,
           sum((edit <> 'D')::INTEGER - (edit = 'K' AND initial = 's')::INTEGER) OVER (PARTITION BY l.conv_id ORDER BY pos) AS place
    FROM letters l LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i AND l.edit <> 'I'
    WHERE edit <> 'D'),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
           || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS spelled FROM stays GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.edits, '') AS audit, sha256(coalesce(spelled, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
"""
