"""Golden cases of the text, list and record functions."""

import random
import html
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidemill.functions import semi, text, values


def values_of(spark, expression, *inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i INT, x STRING")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


class Walker(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "template")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def walked(html):
    walker = Walker()
    walker.feed(html)
    walker.close()
    return " ".join(" ".join(walker.parts).split())


def test_html_to_text(spark):
    cases = [
        "<p>One <b>two</b></p><script>x('</p>')</script>three",
        "a &lt; b &amp;lt; c &nbsp;&nbsp;d &#39;e&#x27; &eacute;&hellip; &unknown; &",
        '<a title="x > y">z</a><!-- <p>no</p> --><style>p{}</style>end',
        "Tiếng &#7879;&#128512; AT&T",
        "",
    ]
    assert values_of(spark, text.html_to_text, *cases) == [
        "One two three",
        "a < b &lt; c d 'e' é… &unknown; &",
        "z end",
        "Tiếng ệ😀 AT&T",
        "",
    ]
    assert values_of(spark, text.html_to_text, None) == [None]


def test_html_to_text_against_a_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.select("html", text.html_to_text(F.col("html")).alias("visible")).collect()
    whole = [r for r in rows if not r.html.endswith("&am")]
    assert rows and [r.visible for r in whole] == [walked(r.html) for r in whole]


def test_first_sentences(spark):
    assert values_of(spark, text.first_sentences, "A. B.", "A! B? C. D.", "no end", "v1.5 is. Out. Now") == [
        "A. B.", "A! B?", "no end", "v1.5 is. Out."]


def test_shorten(spark):
    word = "x" * 399
    cases = ["short", "a" * 500, ("word " * 100).strip(), f"{word}. tail goes on", f"{word}  . tail"]
    got = values_of(spark, lambda c: text.shorten(c, 400), *cases)
    assert got[0] == "short"
    assert got[1] == "a" * 400 + "..."
    assert got[2] == "word " * 78 + "word..."
    assert got[3] == f"{word}."
    assert got[4] == f"{word}..."


def test_promotions(spark):
    cases = [
        "Áo đẹp. MIỄN PHÍ vận chuyển hôm nay. Vải mềm.",
        "Xem http://a.b/c ngay. Tốt.",
        "Chi co hôm nay. Bền. Chỉ có thế.",
        "Giao hàng nhanh! Liên hệ shop. Màu đỏ",
        "Hotel đẹp. Hot nhất.",
        "  ",
    ]
    assert values_of(spark, text.drop_sentences, *cases) == [
        "Áo đẹp. Vải mềm.", "Tốt.", "Bền. Chỉ có thế.", "Màu đỏ", "Hotel đẹp.", ""]


def test_describe_product(spark):
    html = "<p>Áo khoác đẹp. Cam kết chính hãng. Câu ba.</p>"
    assert values_of(spark, text.describe_product, html, None) == ["Áo khoác đẹp.", ""]
    kept = values_of(spark, lambda c: text.describe_product(c, drop_promotions=False), html)
    assert kept == ["Áo khoác đẹp. Cam kết chính hãng."]


def test_parts_and_names(spark):
    assert values_of(spark, lambda c: text.part(c, "/", 1), "a/b", "a", None) == ["b", None, None]
    assert values_of(spark, text.email_domain, "a@gmail.com", "a") == ["gmail.com", None]
    assert values_of(spark, lambda c: text.full_name(F.lit("x"), c), "y", None) == ["x y", None]
    assert values_of(spark, lambda c: text.first_truthy(F.lit(""), c, F.lit("z")), "y", "") == ["y", "z"]
    assert values_of(spark, text.squeeze, " a\t\n b  c ") == ["a b c"]


@pytest.mark.parametrize("given, items", [
    ("a|b| |c", ["a", "b", "c"]),
    ("['a', 'b']", ["a", "b"]),
    ("[{'name': 'a', 'id': 1}, {'title': 'b'}, {'id': 3}]", ["a", "b"]),
    ('["it\'s", "b"]', ["it's", "b"]),
    ("a, b ,c", ["a", "b", "c"]),
    ("{a, b}", ["{a, b}"]),
    (" single ", ["single"]),
    (None, None),
])
def test_list_items(spark, given, items):
    assert values_of(spark, semi.list_items, given) == [items]


def test_unquoted_items(spark):
    assert values_of(spark, semi.unquoted_items, "a|b", "['a', 'b c']", "x", "a,,b") == [
        ["a", "b"], ["a", "b c"], ["x"], ["a", "b"]]


def test_email(spark):
    cases = ["a.b@c.vn", "a@b", "a b@c.com", None]
    assert values_of(spark, text.valid_email, *cases) == [True, False, False, False]
    assert values_of(spark, lambda c: text.email_or_default(F.lit("Bao"), c), *cases) == [
        "a.b@c.vn", "Bao@default.com", "Bao@default.com", "Bao@default.com"]


def test_lenient_values(spark):
    assert values_of(spark, values.to_number, "1.5", "x", "", None) == [1.5, None, None, None]
    assert [v is None for v in values_of(spark, values.to_moment, "2024-10-31 14:00:00", "2024-11-01", "soon")] == [
        False, False, True]
    age = lambda c: values.age_in_years(c.cast("date"), F.lit("2024-02-28").cast("date"))
    assert values_of(spark, age, "2000-02-29", "2000-02-28", "1999-03-01") == [23, 24, 24]


def products(spark, *raw):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i INT, raw STRING")
    records = rows.select("i", semi.product_struct(F.col("raw")).alias("record"))
    columns = [c.alias(n) for n, c in semi.product_columns("record").items()]
    return [r.asDict() for r in records.orderBy("i").select(*columns).collect()]


def test_product_record(spark):
    got = products(
        spark,
        '{"id": 7, "name": "", "title": "T", "url_path": "u", "price": 0, "final_price": 5, "images": []}',
        '{"data": {"product_id": 8, "name": "N", "list_price": 12.0, "images": [{"thumbnail_url": "t"}, "s", '
        '{"base_url": "b", "large_url": ""}], "thumbnail_url": "t", "image": "i", "thumb": "h"}}',
        '{"data": {"product": {"id": 0, "sku": "9", "description": "<p>A. B. C.</p>"}}}',
    )
    assert got[0] == {"id": 7, "name": "T", "url_key": "u", "price": 0, "description": "", "images": []}
    assert got[1]["id"] == 8 and got[1]["price"] == 12
    assert got[1]["images"] == ["h", "i", "t", "s", "b"]
    assert got[2]["id"] == 9 and got[2]["description"] == "A. B." and got[2]["images"] == []


@pytest.mark.parametrize("given", [
    "&#00000038;", "&#x00000026;x", "&#150;", "&notit;", "&amp;lt;", "&hellip;&copy2", "&bogus; &", "&AMP", "&#xD800;",
    "&#99999999;", "&CounterClockwiseContourIntegral;", "&nbsp;a&eacute", "&#x80;", "&#0;", "&lt&gt", "a&b", "&;", "&#;", "&#x;",
])
def test_references_as_the_standard_library_reads_them(spark, given):
    assert values_of(spark, text.decode_entities, given) == [html.unescape(given)]


def test_only_texts_and_objects_are_images(spark):
    images = '[3, "a", {"url": "u"}, null, true, "9", ["x"], {}]'
    assert values_of(spark, lambda c: semi.image_urls(c, []), images, "x", None) == [["a", "u", "9"], [], []]


def test_not_a_record(spark):
    rows = spark.createDataFrame([("[1]",), ("x",), ('{"id": 1}',)], "raw STRING")
    found = rows.select(semi.product_struct(F.col("raw")).isNull().alias("bad")).collect()
    assert [r.bad for r in found] == [True, True, False]


def test_zip_lists(spark):
    rows = spark.createDataFrame([(["a", "b"], ["x"], None)], "p ARRAY<STRING>, q ARRAY<STRING>, r ARRAY<STRING>")
    zipped = semi.zip_lists(F.col("p"), F.col("q"), F.col("r"), names=["title", "company", "place"])
    assert [tuple(x) for x in rows.select(zipped).first()[0]] == [("a", "x", "N/A"), ("b", "N/A", "N/A")]


def test_sentences_are_found_by_their_first_letters(spark):
    """The quick test for opening letters changes nothing, whatever the case of the letters."""
    r = random.Random(6)
    words = ["shop", "SHOP", "ſhop", "workshop", "Tặng Kèm", "TẶNG KÈM", "wWw.x", "HTTPS://a", "http", "lıcense", "licenſe", "LİCENSE", "ß", "other", "　"]
    patterns = [*text.PROMO_PATTERNS, r"(?i)\blicense\b", r"(?i)\bko"]
    rows = [(" ".join(r.choice([*words, ".", "!", "Kold"]) for _ in range(r.randrange(0, 12))),) for _ in range(400)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "t STRING")
    assert text.opening_letters(r"(?i)\blicense\b") == "license" and text.opening_letters(r"(?i)ab?c|d") is None
    assert [text.opening_letters(p) for p in (r"(?i)\bhot\b.*", r"(?i)http[s]?://", r"a|bcd", r"(abc)", r"abc?d", r"\d+")] == [
        "hot", "http", None, None, None, None]
    slow = text.any_of(patterns)
    plain = F.array_join(F.filter(F.transform(F.split("t", text.SENTENCE_GAP), lambda s: text.strip(s)), lambda s: (s != "") & ~s.rlike(slow)), " ")
    for used in (patterns, patterns[:-1]):
        slow = text.any_of(used)
        found = df.select("t", text.drop_sentences(F.col("t"), used).alias("a"), plain.alias("b")).collect()
        if used is patterns:
            assert all(x.a == x.b for x in found) and sum(x.a != x.t for x in found) > 100
        else:
            quick = [x.a for x in found]
            whole = df.select(text.drop_sentences(F.col("t"), [*used, r"(?:no such words)"]).alias("a")).collect()
            assert quick == [x.a for x in whole]


def test_stripping_takes_all_white_space(spark):
    import re
    signs = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000 and i]
    df = spark.createDataFrame([(f"{c}a b{c}",) for c in signs], "t STRING")
    found = df.select(text.strip(F.col("t")).alias("s"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("r")).collect()
    assert all(x.s == x.r for x in found) and sum(len(x.s) == 3 for x in found) == len(text.WHITE_SPACE) == len(re.findall(r"(?s).", text.WHITE_SPACE))
