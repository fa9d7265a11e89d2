"""Page and document text, product records and image lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import semi, text
from tidemill.plans.registry import query

LICENSE_PATTERNS = [r"(?i)\blicen[sc]e\b.*", r"(?i)http[s]?://\S+", r"(?i)www\.\S+"]


# The same steps in SQL. RE2 knows no look-behind, so a mark stands for the sentence gap.
def visible_sql(html: str) -> str:
    hidden = "|".join(
        f"<{tag}\\b[^>]*>.*?(?:</{tag}\\s*>|\\z)" for tag in ("script", "style", "template")
    )
    shown = f"regexp_replace({html}, '(?is)<!--.*?(?:-->|\\z)|{hidden}', ' ', 'g')"
    tags = """$$(?s)</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>|<[!?][^>]*>$$"""
    plain = f"regexp_replace({shown}, {tags}, ' ', 'g')"
    for entity, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        plain = f"regexp_replace({plain}, '&{entity}(;|\\b)', '{char}', 'g')"
    return f"trim(regexp_replace({plain}, '\\s+', ' ', 'g'))"


def sentences_sql(t: str) -> str:
    return f"string_split(regexp_replace({t}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"


def first_two_sql(t: str) -> str:
    return f"array_to_string(list_slice({sentences_sql(t)}, 1, 2), ' ')"


def shorten_sql(t: str, n: int) -> str:
    cut = f"regexp_replace(left({t}, {n}), '\\s+$', '')"
    return (
        f"CASE WHEN length({t}) <= {n} THEN {t} WHEN regexp_matches({cut}, '[.!?]$') THEN {cut} "
        f"ELSE regexp_replace({cut}, ' [^ ]*$', '') || '...' END"
    )


def drop_sql(t: str, patterns: list[str]) -> str:
    found = " OR ".join(f"regexp_matches(s, '{p}')" for p in patterns)
    stripped = f"list_transform({sentences_sql(t)}, lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g'))"
    return f"array_to_string(list_filter({stripped}, lambda s: s <> '' AND NOT ({found})), ' ')"


def described_sql(source: str, html: str, keep: str) -> str:
    """CTEs ending in ``described(<keep>, description)``."""
    return f"""
    visible AS (SELECT {keep}, {visible_sql(html)} AS t FROM {source}),
    opening AS (SELECT {keep}, {first_two_sql('t')} AS t FROM visible),
    short AS (SELECT {keep}, {shorten_sql('t', 400)} AS t FROM opening),
    kept AS (SELECT {keep}, {drop_sql('t', text.PROMO_PATTERNS)} AS t FROM short),
    described AS (SELECT {keep}, {shorten_sql('t', 400)} AS description FROM kept)"""


@query("str_08_html_to_text", f"""
    SELECT page_id, {visible_sql('html')} AS visible FROM pages""")
def html_to_text(t):
    return t.pages.select("page_id", text.html_to_text(F.col("html")).alias("visible"))


@query("str_09_first_sentences", f"""
    SELECT doc_id, {first_two_sql('text')} AS opening FROM documents""")
def first_sentences(t):
    return t.documents.select("doc_id", text.first_sentences(F.col("text")).alias("opening"))


@query("str_10_shorten", f"""
    SELECT doc_id, {shorten_sql('text', 400)} AS short FROM documents""")
def shorten(t):
    return t.documents.select("doc_id", text.shorten(F.col("text"), 400).alias("short"))


@query("str_11_drop_sentences", f"""
    SELECT doc_id, length(kept) AS chars, md5(kept) AS kept_md5
    FROM (SELECT doc_id, {drop_sql('text', LICENSE_PATTERNS)} AS kept FROM documents)""")
def drop_sentences(t):
    kept = t.documents.select("doc_id", text.drop_sentences(F.col("text"), LICENSE_PATTERNS).alias("kept"))
    return kept.select("doc_id", F.length("kept").cast("bigint").alias("chars"), F.md5("kept").alias("kept_md5"))


@query("udf_04_describe_pages", f"""
    WITH {described_sql('pages', 'html', 'page_id')} SELECT page_id, description FROM described""")
def describe_pages(t):
    return t.pages.select("page_id", text.describe_product(F.col("html")).alias("description"))


def raw_products(t):
    """Pages as raw product records with the variants crawled records show.

    French pages come without an envelope, German ones inside ``data``, the others inside
    ``data.product``; secure pages miss their name and price and fall back to other fields.
    """
    secure = F.col("url").startswith("https")
    image = lambda size: F.concat(F.col("url"), F.lit(f"/{size}.jpg"))
    images = F.concat(
        F.lit("["),
        F.to_json(F.struct(F.lit("").alias("large_url"), image("base").alias("base_url"))),
        F.lit(","),
        F.to_json(F.struct(image("small").alias("thumbnail_url"))),
        F.lit(',"'), image("plain"), F.lit('"]'),
    )
    fields = F.to_json(F.struct(
        (F.col("page_id") + 1).alias("product_id"),
        F.when(secure, "").otherwise(F.col("url")).alias("name"),
        F.concat(F.lit("Page "), "page_id").alias("title"),
        F.col("url").alias("url_path"),
        F.when(~secure, F.length("url")).alias("price"),
        F.length("html").alias("original_price"),
        F.col("html").alias("short_description"),
        image("base").alias("thumbnail_url"),
        image("thumb").alias("thumb"),
    ))
    record = F.concat(F.expr("left(r, length(r) - 1)"), F.lit(',"images":'), F.col("images"), F.lit("}"))
    rows = t.pages.withColumns({"r": fields, "images": images}).withColumn("record", record)
    wrapped = (
        F.when(F.contains("url", F.lit("/fr/")), F.col("record"))
        .when(F.contains("url", F.lit("/de/")), F.concat(F.lit('{"data":'), "record", F.lit("}")))
        .otherwise(F.concat(F.lit('{"data":{"product":'), "record", F.lit("}}")))
    )
    return rows.select("page_id", wrapped.alias("raw"))


@query("jsn_02_unwrap", """
    SELECT page_id, CAST(page_id + 1 AS VARCHAR) AS product_id, url AS url_path FROM pages""")
def unwrap(t):
    inner = raw_products(t).select("page_id", semi.unwrap(F.col("raw")).alias("inner"))
    return inner.select(
        "page_id",
        F.get_json_object("inner", "$.product_id").alias("product_id"),
        F.get_json_object("inner", "$.url_path").alias("url_path"),
    )


@query("jsn_04_product_record", f"""
    WITH {described_sql('pages', 'html', 'page_id, url, html')}
    SELECT page_id + 1 AS id, CASE WHEN starts_with(url, 'https') THEN 'Page ' || page_id ELSE url END AS name,
           url AS url_key, CASE WHEN starts_with(url, 'https') THEN length(html) ELSE length(url) END AS price,
           description, array_to_string([url || '/thumb.jpg', url || '/base.jpg', url || '/small.jpg',
           url || '/plain.jpg'], ' ') AS images
    FROM described""")
def product_record(t):
    records = raw_products(t).select(semi.product_struct(F.col("raw")).alias("record"))
    return records.select(
        *[c.alias(n) for n, c in semi.product_columns("record").items()]
    ).withColumn("images", F.array_join("images", " "))


@query("arr_03_image_list", """
    SELECT page_id, CAST(pos AS INTEGER) AS pos, url || names[pos + 1] AS image
    FROM (SELECT page_id, url, ['/thumb.jpg', '/base.jpg', '/small.jpg', '/plain.jpg'] AS names,
          unnest(range(4)) AS pos FROM pages)""")
def image_list(t):
    records = raw_products(t).select("page_id", semi.product_struct(F.col("raw")).alias("r"))
    urls = semi.image_urls(F.col("r.images"), [F.col(f"r.{f}") for f in semi.THUMBNAIL_FIELDS])
    return records.select("page_id", F.posexplode(urls).alias("pos", "image"))
