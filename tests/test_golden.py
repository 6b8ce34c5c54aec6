"""Known strings with known results."""

import re

import pytest
from pyspark.sql import functions as F

from mailloom.functions import cleaning as C
from mailloom.functions.matching import find_all, regex_hits
from mailloom.functions.markup import html_text
from mailloom.operators import amounts, attachments, language, numbers, spam, terms
from mailloom.operators.geo import clean_ip, ip_number
from mailloom.operators.normalize import ascii_variant, decode_words, parse_addresses, parse_message, sent_epoch, to_text
from workloads import catalog

MONEY = """Invoice 88 for the roof: pay $310.75 by Monday, or 45 $ a week.
Balance due  $7400
Total   $912
86.40
Deposit of       $23,450.10

Withdrawal   6,100,200,300.00
The barn holds 4,500 bales of straw.
They owe us 3,250,000.00 USD in all.
After that some 61,000 US$ will be left over.
"""


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("r")).first().r


def test_amounts(spark):
    found = [
        (a.value, a.offset_start, a.symbol_ex is not None, a.trans_ex is not None)
        for a in one(spark, MONEY, amounts.find_amounts)
    ]
    assert found == [
        ("88", 8, False, False),
        ("310.75", 30, True, False),
        ("45", 51, True, True),
        ("7400", 78, True, True),
        ("912", 92, True, True),
        ("86.40", 96, True, True),
        ("23,450.10", 120, True, True),
        ("6,100,200,300.00", 144, False, True),
        ("4,500", 176, False, False),
        ("3,250,000.00", 210, True, False),
        ("61,000", 251, True, False),
    ]
    assert all(MONEY[start:].startswith(value) for value, start, _, _ in found)


def test_amount_window_stops_before_the_last_character(spark):
    assert one(spark, "pay $5", amounts.find_amounts)[0].symbol_ex == "pay $"
    assert one(spark, "pay $5 ", amounts.find_amounts)[0].symbol_ex == "pay $5"
    assert one(spark, "5$", amounts.find_amounts)[0].symbol_ex is None
    assert one(spark, "5$ ", amounts.find_amounts)[0].symbol_ex == "5$"


def phones(spark, text, plan=None):
    return [
        (p.value, p.offset_start, p.normalized)
        for p in one(spark, text, lambda t: numbers.find_phones(t, plan))
    ]


def test_phones(spark):
    assert phones(spark, "FAX: 2044-71903355/56/57") == [(" 2044-71903355", 4, "204471903355")]
    assert phones(spark, "2044-71903355") == []
    plan = [{"prefix": "204", "min_len": 12, "max_len": 12, "area": "There", "carrier": "Them"}]
    assert phones(spark, "2044-71903355", plan) == [("2044-71903355", 0, "204471903355")]
    text = "Please phone +1415-302-7719 once the ferry is in, after noon +612-5550144 is better. +358-9-5550101"
    assert phones(spark, text) == [("+1415-302-7719 ", 13, "14153027719")]
    plan = [{"prefix": p, "min_len": 7, "max_len": 15} for p in ("612", "358")]
    assert [p[1] for p in phones(spark, text, plan)] == [13, 61, 85]


def test_a_plan_table_decides_by_its_longest_prefix(spark):
    plan = spark.createDataFrame(
        [("4", 5, 6, "four", None), ("44123456", 9, 9, "long", "A"), ("44123456", 9, 9, "long", None), ("441", 8, 8, None, None), ("", 1, 15, "none", None)],
        "prefix string, min_len int, max_len int, area string, carrier string",
    )
    texts = [("1", "44123456"), ("2", "441234567"), ("3", "44123"), ("4", None), ("5", "441234567 x 441999999 x 44123456"), ("6", "9912345678")]
    docs = spark.createDataFrame(texts, "id string, body string")
    rows, entries = numbers.with_plan(docs, F.array("body"), plan)
    found = {r.id: r.n and [(n.normalized, n.possible_area, n.possible_carrier) for n in r.n] for r in rows.select("id", numbers.find_phones(F.col("body"), entries).alias("n")).collect()}
    long = ("441234567", "Possible area: long. ", "Possible carrier: A.")
    assert found == {"1": [], "2": [long], "3": [], "4": None, "5": [long], "6": []}
    listed = [r.asDict() for r in plan.where("prefix <> ''").dropDuplicates(["prefix"]).collect()]
    assert numbers.add_phones(docs, ("body",), plan).columns == ["id", "body", "phone_numbers"]
    assert sorted(map(str, numbers.add_phones(docs, ("body",), listed).collect())) == sorted(map(str, numbers.add_phones(docs, ("body",), plan).collect()))
    assert numbers.add_numbers(docs.withColumn("attachments", F.array(F.struct(F.col("body").alias("content")))), plan, True).where("id = '2' AND size(numbers) = 2").count() == 1


def test_longest_prefix_of_the_plan_decides(spark):
    plan = [
        {"prefix": "4", "min_len": 7, "max_len": 15, "area": "wide"},
        {"prefix": "44", "min_len": 9, "max_len": 15, "area": "near"},
    ]
    assert phones(spark, "44123456", plan) == []
    found = one(spark, "441234567", lambda t: numbers.find_phones(t, plan))
    assert found[0].possible_area == "Possible area: near. "


@pytest.mark.parametrize(
    "text",
    [
        "card: 9876 5432 9876 5432",
        "card: 9876-5432-9876-5432",
        "card: 9876 54329876 5432 end",
        "card: 9876 5432 9876 5432end of it",
        "card: 9876-5432-9876-5432-1111-2222",
        "card: 9876\t5432\t9876\t5432next",
    ],
)
def test_cards(spark, text):
    found = one(spark, text, numbers.find_cards)
    assert [(c.offset_start, c.normalized) for c in found] == [(6, "9876543298765432")]
    assert found[0].value == re.search(r"([0-9]{4}\W*){4}", text).group()


@pytest.mark.parametrize(
    "text, matches",
    [("wxyz", 0), ("9080", 0), ("wxyz 9080", 0), ("7k", 1), ("q4", 1), ("58-kit/9:t", 1), ("606-1177", 0)],
)
def test_models(spark, text, matches):
    assert len(one(spark, text, numbers.find_models)) == matches


def test_model_offsets(spark):
    found = one(spark, "first line\nab-12\r\nX9\n\n#7q", numbers.find_models)
    assert [(m.value, m.offset_start, m.offset_end) for m in found] == [("X9", 18, 20), ("#7q", 22, 25)]


def test_excerpt(spark):
    text = "x" * 60 + "\r\ncall\t\n  555 0100 22\n\nbye"
    found = one(spark, text, numbers.find_phones)[0]
    raw = text[found.offset_start - 50 : found.offset_end + 50]
    want = re.sub(r"\s+", " ", re.sub("\n+", " ", re.sub("\r+", "", raw)))
    assert found.excerpt == want
    assert found.excerpt_value_start == 50


@pytest.mark.parametrize("pattern, inside", [
    (numbers.PHONE_PATTERN, numbers.PHONE_CHARS),
    (numbers.CARD_PATTERN, numbers.CARD_CHARS),
    (amounts.AMOUNT_PATTERN, amounts.AMOUNT_CHARS),
])
def test_matches_of_long_texts_are_those_of_the_whole_text(spark, pattern, inside):
    import random

    rnd = random.Random(5)
    alphabet = "0123456789" * 3 + "+-. (),ab\né$😀"
    text = "".join(rnd.choice(alphabet) for _ in range(60_000)) + "1" * 20_000 + " 12 z " + "4 5 6 7 " * 3000 + "a😀" * 9000 + "555 0100"
    found = one(spark, text, lambda t: find_all(t, regex_hits(pattern), inside))
    plain = pattern.replace("(?U)", "").replace(r"\d", "[0-9]")
    want = [(m.start(), m.end(), m.group()) for m in re.finditer(plain, text)]
    assert [(h.s, h.e, h.value) for h in found] == want
    for h in found[:: max(1, len(found) // 50)]:
        assert h.before == text[max(h.s - 50, 0) : h.s]
        assert h.after == text[h.e : h.e + 50]


def test_quoted_headers_are_not_words(spark):
    text = "Hello There\nFrom: me\nto: you\nSubject matters\nsent: now\ncc all\n to: kept word\x1fx"
    assert one(spark, text, terms.words) == ["hello", "there", "to:", "kept", "word", "x"]


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("Hello, (world)!", ["Hello", ",", "(", "world", ")", "!"]),
        ("etc. e.g., u.s.!", ["etc.", "e.g.", ",", "u.s.", "!"]),
        ("wait..... ... --", ["wait", ".", ".", ".", ".", ".", "...", "--"]),
        ("('em 's", ["(", "'em", "'s"]),
        ("!!! -", ["!", "!", "!", "-"]),
        ("(u.s. ¿qué?", ["(", "u.s", ".", "¿", "qué", "?"]),
        ("", []),
    ],
)
def test_punctuation_tokens(spark, text, tokens):
    assert one(spark, text, language.tokenize_punctuation) == tokens


def test_clean_for_spam(spark):
    assert one(spark, 'aé[:newline:]b\n\t"c">><d', C.spam_text) == "a " + " " * 11 + "bcd"
    assert one(spark, "One two, two", spam.spam_tokens) == ["one", "two", "two"]


def test_html(spark):
    html = "<html><title>T</title><style>x{}</style><p>a &amp; b<br>c</p><!-- no --><script>1<2</script>&lt;d&gt;</html>"
    assert one(spark, html, html_text) == "T\na & b\nc <d>"


@pytest.mark.parametrize(
    "ip, number",
    [("[1.2.3.4]", 16909060), ("255.255.255.255", 4294967295), ("256.1.1.1", None), ("::1", None), ("1.2.3", None), ("", None)],
)
def test_ip_numbers(spark, ip, number):
    assert one(spark, ip, lambda t: ip_number(clean_ip(t))) == number


def test_degrees(spark):
    assert one(spark, "10,30,3600/100", attachments.degrees) == pytest.approx(10.51)
    assert one(spark, "10,30", attachments.degrees) is None
    assert one(spark, "1/0,2,3", attachments.degrees) is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("Tue, 17 Jun 2010 08:33:51 -0400 (EDT)", "2010-06-17 12:33:51"),
        ("Tue, 17 Jun 2010 08:33:51 EDT", "2010-06-17 08:33:51"),
        ("17 Jun 2010 08:33:51", "2010-06-17 08:33:51"),
        ("2010-06-17T08:33:51+02:00", "2010-06-17 06:33:51"),
        ("never", None),
    ],
)
def test_dates(spark, text, want):
    got = one(spark, text, lambda t: F.date_format(C.to_utc(t), "yyyy-MM-dd HH:mm:ss"))
    assert got == want


def test_python_side_helpers():
    assert sent_epoch("Tue, 17 Jun 2010 08:33:51 -0400") == 1276778031
    assert sent_epoch("Tue, 17 Jun 2010 08:33:51 EDT") == 1276763631
    assert sent_epoch("rubbish") is None
    assert decode_words("=?iso-8859-1?q?p=F6stal?=") == "pöstal"
    assert decode_words("=?x?broken") == "=?x?broken"
    assert to_text(b"caf\xe9", "no-such-charset") == "café"
    assert to_text(b"caf\xe9", "ascii") == "caf�"
    assert to_text(b"\x81\x8d", None) == "b'\\x81\\x8d'"
    assert parse_addresses(['"O\'Neil, A" <O\'Neil@X.example>', "just a name", "b@y.example"]) == [
        "oneil@x.example",
        "b@y.example",
    ]


def test_html_only_body_and_unnamed_attachment():
    html_only = b"Content-Type: text/html\n\n<b>x</b>"
    assert parse_message("1", html_only, True)["body_as_html"] is True
    both = (
        b'Content-Type: multipart/mixed; boundary="z"\n\n--z\nContent-Type: text/plain\n\nhi\n--z\n'
        b"Content-Type: image/png\nContent-Disposition: inline\n\nxx\n--z\n"
        b'Content-Disposition: attachment; filename="rtf-body.rtf"\n\nyy\n--z--'
    )
    named = parse_message("1", both, True)
    assert [a["filename"] for a in named["attachments"]] == ["attach_0"]
    assert parse_message("1", both, False)["attachments"] == []
    assert named["body"] == "hi" and named["body_as_html"] is False


def test_ascii_variant_reads_addresses_anew(spark):
    rows = [("1", ["\u00dcnal <A.\u00e9B@X.example>\tC@y.example\nD@z.example", "'O'Neil' <o'neil@w.example>"], ["x"], "caf\u00e9\ttea\rend", "b\u00f6dy", [("My & f/\u00edle.TXT",)])]
    schema = "id string, senders_line array<string>, senders array<string>, subject string, body string, attachments array<struct<filename:string>>"
    row = ascii_variant(spark.createDataFrame(rows, schema)).first()
    assert row.senders_line == [" nal <a. b@x.example>;c@y.example;d@z.example", "'o'neil' <o'neil@w.example>"]
    assert row.senders == ["a. b@x.example", "c@y.example", "d@z.example", "oneil@w.example"]
    assert (row.subject, row.body, row.attachments[0].filename) == ("caf  tea end", "b dy", "my___f__le.txt")


def test_attached_message_is_an_attachment():
    inner = "Subject: inner\n\ninner text\n"
    outer = (
        'Subject: outer\nContent-Type: multipart/mixed; boundary="b"\n\n--b\nContent-Type: text/plain\n\nhello\n'
        '--b\nContent-Type: message/rfc822\nContent-Disposition: attachment; filename="fwd.eml"\n\n' + inner + "\n--b--\n"
    )
    row = parse_message("1", outer.encode(), False)
    found = row["attachments"]
    assert [(a["filename"], a["extension"], a["content_type"]) for a in found] == [("fwd.eml", ".eml", "message/rfc822")]
    import base64

    assert base64.b64decode(found[0]["contents64"]).startswith(b"Subject: inner\n\ninner text")


@pytest.mark.parametrize(
    "data, text",
    [
        ("caf\u00e9".encode("latin-1"), "caf\u00e9"),
        ("caf\u00e9".encode(), "caf\u00e9"),
        ("\ufeffcaf\u00e9".encode(), "caf\u00e9"),
        ("caf\u00e9 \U0001f642".encode("utf-16"), "caf\u00e9 \U0001f642"),
        (b"", ""),
    ],
)
def test_bytes_without_a_charset(spark, data, text):
    row = spark.createDataFrame([(bytearray(data),)], "d binary").select(attachments.decoded(F.col("d")).alias("r")).first()
    assert row.r == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("&eacute;&#233;&#x2019;&#X1F642;", "\u00e9\u00e9\u2019\U0001f642"),
        ("a&nbsp;b &amp;lt; &lt;c&gt;", "a b &lt; <c>"),
        ("R&D &unknown; &#0; &#xD800; & &;", "R&D &unknown; &#0; &#xD800; & &;"),
        ("&#39;&apos;&quot;", "''\""),
    ],
)
def test_character_references(spark, html, text):
    assert one(spark, html, html_text) == text


def test_long_subjects_outside_ascii_are_one_encoded_word(spark, tmp_path):
    text = "Èê " * 30
    rows = [(4400, text, "fr", "x", len(text)), (4401, text, "fr", "x", len(text))]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.id: r for r in catalog.QUERIES["message_rows"](spark, str(tmp_path)).collect()}
    assert {i: (r.subject, r.message_id, r.n_attachments) for i, r in found.items()} == {
        "d4400": (text[:40], "<4400 @x>", 2), "d4401": (text[:40], "<4401 @x>", 1)}
    files = catalog.QUERIES["message_attachments"](spark, str(tmp_path)).collect()
    assert [(r.id, r.filename, r.filesize) for r in files] == [("d4400", "List 4400.CSV", len(text[:40].encode()))]


def test_rare_trigrams_tell_the_language_of_an_attachment(spark, tmp_path):
    texts = [(1, "the house is red", "en"), (2, "zut la maison ou", "fr")]
    spark.createDataFrame(texts, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(1, "zut la maison", "<p>the house is</p>")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = catalog.QUERIES["attachment_language"](spark, str(tmp_path)).collect()
    assert sorted(r.lang for r in found) == ["en", "fr"]


def test_profiles_are_learned_without_counting_in_the_row(spark, monkeypatch):
    """Occurrences are counted before the shuffle; no text is sorted."""
    texts = spark.createDataFrame([("en", "abcabc"), ("en", "ABC"), ("fr", None), ("fr", "ab"), ("es", "bca")], "lang string, body string")
    monkeypatch.setattr(language, "gram_counts", None)
    profile = language.train_profile(texts)
    assert {r.gram: (r.w_en, r.w_es) for r in profile.weights.collect()} == {
        "abc": (1386294, None), "bca": (693147, 693147), "cab": (693147, None)}
    assert sorted(profile.floors) == ["en", "es"]
