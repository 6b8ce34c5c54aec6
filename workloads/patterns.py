"""Numbers and money in text."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom.operators import amounts, numbers

from .fixtures import DOCS, docs, table
from .registry import query

# a small numbering plan, given to the operators as a parameter
PLAN = [
    {"prefix": "1", "min_len": 11, "max_len": 11, "area": "North America", "carrier": None},
    {"prefix": "44", "min_len": 11, "max_len": 12, "area": "United Kingdom", "carrier": "Carrier A"},
    {"prefix": "555", "min_len": 7, "max_len": 10, "area": "Test range", "carrier": "Carrier B"},
    {"prefix": "97", "min_len": 10, "max_len": 12, "area": None, "carrier": None},
]
_PLAN_ROWS = ", ".join(
    "('{prefix}', {min_len}, {max_len}, {area}, {carrier})".format(
        **{
            **p,
            "area": "NULL" if p["area"] is None else f"'{p['area']}'",
            "carrier": "NULL" if p["carrier"] is None else f"'{p['carrier']}'",
        }
    )
    for p in PLAN
)


def hits_sql(source: str, text: str, pattern: str, context: int = 50) -> str:
    """CTE `hits`: offsets by summing the lengths of the gaps and matches before each match."""
    return f"""found AS (
      SELECT id, {text} AS txt, regexp_extract_all({text}, '{pattern}') AS m,
        string_split_regex({text}, '{pattern}') AS g FROM {source}),
    placed AS (
      SELECT id, txt, unnest(m) AS value,
        unnest(list_transform(range(1, len(m) + 1), lambda i:
          list_sum(list_transform(g[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))) AS s
      FROM found WHERE len(m) > 0),
    hits AS (
      SELECT id, txt, value, CAST(s AS BIGINT) AS s, CAST(s + length(value) AS BIGINT) AS e,
        substr(txt, CAST(greatest(s - {context}, 0) + 1 AS BIGINT), CAST(least(s, {context}) AS BIGINT)) AS before,
        substr(txt, CAST(s + length(value) + 1 AS BIGINT), {context}) AS after
      FROM placed)"""


EXCERPT_SQL = r"""regexp_replace(regexp_replace(before || value || after, '\r+', '', 'g'), '[ \t\n\f\x0B]+', ' ', 'g')"""

_SMALL_PLAN = f"plan(prefix, min_len, max_len, area, carrier) AS (VALUES {_PLAN_ROWS})"

# a hundred thousand rows, some of them repeated, with prefixes of one to eight digits
_LARGE_PLAN = """plan AS (
    SELECT DISTINCT prefix, 7 + length(prefix) % 3 AS min_len, 12 AS max_len, 'Area ' || prefix AS area,
      CASE WHEN length(prefix) > 2 THEN 'Carrier ' || right(prefix, 1) END AS carrier
    FROM (SELECT substr(lpad((i * 48271 % 100000000)::VARCHAR, 8, '0'), 1, CAST(1 + i % 8 AS BIGINT)) AS prefix FROM range(100000) t(i)))"""


def large_plan(spark):
    digits = F.lpad((F.col("id") * 48271 % 100_000_000).cast("string"), 8, "0")
    prefix = F.substring(digits, F.lit(1), (F.col("id") % 8 + 1).cast("int"))
    return spark.range(100_000).select(prefix.alias("prefix")).select(
        "prefix",
        (7 + F.length("prefix") % 3).alias("min_len"),
        F.lit(12).alias("max_len"),
        F.concat(F.lit("Area "), "prefix").alias("area"),
        F.when(F.length("prefix") > 2, F.concat(F.lit("Carrier "), F.right("prefix", F.lit(1)))).alias("carrier"),
    )


def phones_sql(plan: str = _SMALL_PLAN) -> str:
    return f"""{hits_sql('docs', 'body', numbers.PHONE_PATTERN)},
  {plan},
  digits AS (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS normalized FROM hits),
  best AS (SELECT id, s, arg_max(plan, length(prefix)) AS p
    FROM digits, range(1, 9) lengths(n) JOIN plan ON length(normalized) >= n AND prefix = substr(normalized, 1, CAST(n AS BIGINT))
    GROUP BY id, s),
  phones AS (
    SELECT d.*, p.area AS area, p.carrier AS carrier
    FROM digits d LEFT JOIN best USING (id, s)
    WHERE length(normalized) >= 7 AND (coalesce(length(normalized) BETWEEN p.min_len AND p.max_len, FALSE)
      OR regexp_matches(lower(right(before, 15)), '{"|".join(numbers.PHONE_WORDS)}')))"""


PHONES_SQL = phones_sql()

# the same amounts, in a dialect without possessive repeats
AMOUNT_SQL = amounts.AMOUNT_PATTERN.replace("*+", "*")

CARD_SQL = r"(?:[0-9]{4}[^\p{L}\p{M}\p{N}\p{Pc}]*){4}"


def _flat(df, found):
    return df.select("id", F.inline(found))


@query(
    f"""WITH {DOCS}, {phones_sql(_LARGE_PLAN)}
    SELECT id, value, normalized, {EXCERPT_SQL} AS excerpt, s AS offset_start, e AS offset_end,
      length(before) AS excerpt_value_start, length(after) AS excerpt_value_stop,
      'Possible area: ' || area || '. ' AS possible_area, 'Possible carrier: ' || carrier || '.' AS possible_carrier
    FROM phones"""
)
def phone_numbers(spark, sf_dir):
    rows, entries = numbers.with_plan(docs(spark, sf_dir), F.array("body"), large_plan(spark))
    return _flat(rows, numbers.find_phones(F.col("body"), entries)).drop("type")


@query(
    f"""WITH {DOCS}, {hits_sql('docs', 'body', CARD_SQL)}
    SELECT id, value, regexp_replace(value, '[^0-9]', '', 'g') AS normalized, {EXCERPT_SQL} AS excerpt,
      s AS offset_start, e AS offset_end FROM hits"""
)
def card_numbers(spark, sf_dir):
    return _flat(docs(spark, sf_dir), numbers.find_cards(F.col("body"))).select(
        "id", "value", "normalized", "excerpt", "offset_start", "offset_end"
    )


PARTS = """parts AS (SELECT p_partkey AS id,
    p_name || chr(10) || p_brand || chr(10) || p_type || chr(10) || p_partkey || chr(10) ||
    'sku:' || p_partkey || '/' || p_size || chr(10) || '#' || p_size || chr(10) || 'x' || p_size || ' ' AS body
  FROM part)"""


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        r"""concat(p_name, '\n', p_brand, '\n', p_type, '\n', p_partkey, '\n', 'sku:', p_partkey, '/', p_size,
            '\n', '#', p_size, '\n', 'x', p_size, ' ') AS body""",
    )


@query(
    rf"""WITH {PARTS}, lines AS (
      SELECT id, body, unnest(string_split(body, chr(10))) AS value,
        unnest(list_transform(range(1, len(string_split(body, chr(10))) + 1), lambda i:
          coalesce(list_sum(list_transform(string_split(body, chr(10))[1:i - 1], lambda x: length(x) + 1)), 0))) AS s
      FROM parts),
    hits AS (SELECT id, value, CAST(s AS BIGINT) AS s, CAST(s + length(value) AS BIGINT) AS e,
        substr(body, CAST(greatest(s - 50, 0) + 1 AS BIGINT), CAST(least(s, 50) AS BIGINT)) AS before,
        substr(body, CAST(s + length(value) + 1 AS BIGINT), 50) AS after
      FROM lines WHERE regexp_full_match(value, '[a-zA-Z0-9\\/:#-]+') AND regexp_matches(value, '[0-9]')
        AND regexp_matches(value, '[a-zA-Z]'))
    SELECT id, value, {EXCERPT_SQL} AS excerpt, s AS offset_start, e AS offset_end FROM hits"""
)
def model_numbers(spark, sf_dir):
    return _flat(_parts(spark, sf_dir), numbers.find_models(F.col("body"))).select(
        "id", "value", "excerpt", "offset_start", "offset_end"
    )


@query(
    f"""WITH {DOCS}, {PHONES_SQL}, {hits_sql('docs', 'body', CARD_SQL).replace('found', 'cfound').replace('placed', 'cplaced').replace('hits', 'chits')},
    lines AS (
      SELECT id, unnest(string_split(body, chr(10))) AS value,
        unnest(list_transform(range(1, len(string_split(body, chr(10))) + 1), lambda i:
          coalesce(list_sum(list_transform(string_split(body, chr(10))[1:i - 1], lambda x: length(x) + 1)), 0))) AS s
      FROM docs),
    models AS (
      SELECT id, value, CAST(s AS BIGINT) AS s, CAST(s + length(value) AS BIGINT) AS e FROM lines
      WHERE regexp_full_match(value, '[a-zA-Z0-9\\/:#-]+') AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-zA-Z]')),
    all_numbers AS (
      SELECT id, 3 AS kind, 'model_number' AS type, s, e, value AS normalized FROM models
      UNION ALL
      SELECT id, 1 AS kind, 'phone_number' AS type, s, e, normalized FROM phones
      UNION ALL
      SELECT id, 2, 'credit_card_number', s, e, regexp_replace(value, '[^0-9]', '', 'g') FROM chits)
    SELECT docs.id, coalesce(string_agg(normalized, ',' ORDER BY kind, s), '') AS phone_numbers,
      coalesce(string_agg(type || ':' || s || '-' || e, ',' ORDER BY kind, s), '') AS numbers
    FROM docs LEFT JOIN all_numbers USING (id) GROUP BY docs.id"""
)
def numbers_on_email(spark, sf_dir):
    rows = numbers.add_numbers(docs(spark, sf_dir).select("id", "body"), PLAN)
    return rows.select(
        "id",
        F.array_join("phone_numbers", ",").alias("phone_numbers"),
        F.array_join(
            F.transform(
                "numbers",
                lambda n: F.concat(
                    n.type, F.lit(":"), n.offset_start.cast("string"), F.lit("-"), n.offset_end.cast("string")
                ),
            ),
            ",",
        ).alias("numbers"),
    )


@query(
    f"""WITH {DOCS}, {PHONES_SQL}
    SELECT docs.id, coalesce(string_agg(normalized, ',' ORDER BY s), '') AS phone_numbers
    FROM docs LEFT JOIN phones USING (id) GROUP BY docs.id"""
)
def phones_on_email(spark, sf_dir):
    rows = numbers.add_phones(docs(spark, sf_dir).select("id", "body"), ["body"], PLAN)
    return rows.select("id", F.array_join("phone_numbers", ",").alias("phone_numbers"))


AMOUNTS_SQL = f"""{hits_sql('money', 'txt', AMOUNT_SQL, 25)},
  windows AS (SELECT id, value, s,
      CASE WHEN least(e + 6, length(txt) - 1) > greatest(s - 6, 0)
        THEN substr(txt, greatest(s - 6, 0) + 1, least(e + 6, length(txt) - 1) - greatest(s - 6, 0)) ELSE '' END AS near,
      CASE WHEN least(e + 25, length(txt) - 1) > greatest(s - 25, 0)
        THEN substr(txt, greatest(s - 25, 0) + 1, least(e + 25, length(txt) - 1) - greatest(s - 25, 0)) ELSE '' END AS wide
    FROM hits),
  amounts AS (SELECT id, value, s,
      CASE WHEN contains(lower(near), '$') OR contains(lower(near), 'usd') THEN near END AS symbol_ex,
      CASE WHEN regexp_matches(lower(wide), 'balance|paid|deposit|withdraw') THEN wide END AS trans_ex
    FROM windows)"""


@query(
    f"""WITH {DOCS}, money AS (SELECT id, body AS txt FROM docs), {AMOUNTS_SQL}
    SELECT id, value, s AS offset_start, symbol_ex, trans_ex FROM amounts"""
)
def amount_candidates(spark, sf_dir):
    return docs(spark, sf_dir).select("id", F.inline(amounts.find_amounts(F.col("body"))))


@query(
    f"""WITH {DOCS}, money AS (SELECT id, body || ' ' || subject || ' ' AS txt FROM docs), {AMOUNTS_SQL}
    SELECT docs.id, count(value) AS n_entities,
      coalesce(string_agg(value, ';' ORDER BY s), '') AS amounts
    FROM docs LEFT JOIN (SELECT * FROM amounts WHERE symbol_ex IS NOT NULL OR trans_ex IS NOT NULL) USING (id)
    GROUP BY docs.id"""
)
def currency_entities(spark, sf_dir):
    rows = amounts.add_currency(docs(spark, sf_dir).select("id", "body", "subject"))
    return rows.select(
        "id",
        F.size("currency_entities").cast("bigint").alias("n_entities"),
        F.array_join(F.transform("currency_entities", lambda c: c.value), ";").alias("amounts"),
    )


@query(
    f"""WITH {DOCS}, money AS (SELECT id, body || ' ' || subject || ' ' AS txt FROM docs), {AMOUNTS_SQL}
    SELECT 'user@' || lang || '.example' AS sender, 'a@x.example,b@x.example' AS tos, symbol_ex, trans_ex, value
    FROM amounts JOIN docs USING (id) WHERE symbol_ex IS NOT NULL OR trans_ex IS NOT NULL"""
)
def currency_rows(spark, sf_dir):
    emails = docs(spark, sf_dir).select(
        "id",
        "body",
        "subject",
        F.array(F.concat(F.lit("user@"), "lang", F.lit(".example"))).alias("senders"),
        F.array(F.lit("a@x.example"), F.lit("b@x.example")).alias("tos"),
    )
    return amounts.currency_rows(amounts.add_currency(emails))


@query(
    f"""WITH {DOCS}, {hits_sql('docs', 'body', AMOUNT_SQL)}
    SELECT docs.id, round(coalesce(sum(CAST(replace(value, ',', '') AS DOUBLE)), 0), 2) AS total
    FROM docs LEFT JOIN hits USING (id) GROUP BY docs.id"""
)
def amount_totals(spark, sf_dir):
    return docs(spark, sf_dir).select("id", F.round(amounts.amount_total(F.col("body")), 2).alias("total"))
