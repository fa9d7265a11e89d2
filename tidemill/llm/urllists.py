"""URL filters whose lists change over time.

List entries are dated: an entry adds a domain or a path to a list or takes it off. They become
intervals of days in which the key is listed, and each capture is judged by the entries that
were active on the day it was fetched, not by the lists of today. All of it is DataFrame
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Copies of the intervals, so that a key which most captures share is many tasks' work.
SALTS = 16
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[a-z][a-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), HOST, 1)


def keys(url: Column) -> Column:
    """What a list may hold of a URL: its host, every parent domain of two labels or more, and
    the host with the first part of the path."""
    labels = F.split(host(url), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    part = F.regexp_extract(F.lower(url), PATH, 1)
    paths = F.when(part != "", F.array(F.concat(host(url), F.lit("/"), part))).otherwise(F.array().cast("array<string>"))
    return F.when(host(url) != "", F.concat(suffixes, paths)).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """``list, key, valid_from, valid_until``: the days on which a key is listed.

    ``entries`` has ``list, key, listed`` (true: added) and ``at`` (a date). Of one key's entries
    on one day an addition wins. The end is the first day on which it is no longer listed, or
    null. Entries with a null in any column are ignored. A key has one row per day at most
    before the window, however often it is listed.
    """
    daily = entries.dropna(subset=["list", "key", "listed", "at"]).groupBy("list", "key", "at").agg(F.max("listed").alias("listed"))
    order = Window.partitionBy("list", "key").orderBy("at")
    changed = daily.withColumn("was", F.lag("listed", 1, False).over(order)).filter("listed <> was")
    ended = changed.withColumn("valid_until", F.lead("at").over(order))
    return ended.filter("listed").select("list", "key", F.col("at").alias("valid_from"), "valid_until")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Add ``verdict``, ``decided_by`` and ``listed_since`` to captures with ``url`` and ``fetched_on``.

    The longest key active on the day decides; between lists that hold it, ``allow`` beats
    ``block``. Verdicts: ``blocked``, ``allowed`` (by an entry), ``unlisted``, and ``unknown`` where
    url or day is null or the url has no host. Repeated captures get the same verdict each.
    """
    captures = captures.drop("verdict", "decided_by", "listed_since")
    asked = captures.select("url", "fetched_on").dropna().distinct()
    span = asked.agg(F.min("fetched_on"), F.max("fetched_on")).first()
    month = lambda day: F.trunc(day, "month")
    exploded = asked.select(
        "url", "fetched_on", F.explode(keys(F.col("url"))).alias("key"), month("fetched_on").alias("month"),
        F.pmod(F.xxhash64("url"), F.lit(SALTS)).alias("salt"),
    )
    first, last = F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date")
    begins, ends = F.greatest("valid_from", first), F.least(F.coalesce(F.date_sub("valid_until", 1), last), last)
    intervals = validity(entries).filter(begins <= ends).select(
        "*", F.explode(F.sequence(month(begins), month(ends), F.expr("interval 1 month"))).alias("month")
    ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    active = exploded.join(intervals, ["key", "month", "salt"]).filter(
        (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_until").isNull() | (F.col("fetched_on") < F.col("valid_until")))
    )
    best = F.struct(F.length("key").alias("size"), (F.col("list") == "allow").alias("allow"), "key", "valid_from")
    decided = active.groupBy("url", "fetched_on").agg(F.max(best).alias("best"))
    known = captures.url.isNotNull() & captures.fetched_on.isNotNull() & (host(captures.url) != "")
    return captures.join(decided, ["url", "fetched_on"], "left").select(
        *[captures[c] for c in captures.columns],
        F.when(~known, "unknown").when(F.col("best").isNull(), "unlisted").when(F.col("best.allow"), "allowed")
        .otherwise("blocked").alias("verdict"),
        F.col("best.key").alias("decided_by"), F.col("best.valid_from").alias("listed_since"),
    )


def digit_pair(text: Column, place: int) -> Column:
    """Two hexadecimal digits of a text's MD5 as a number from 0 to 255."""
    return F.conv(F.substring(F.md5(text), place, 2), 16, 10).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures; the table has no dates, so the day follows from ``page_id``."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(360)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A list log made from the hosts, parent domains and first path parts of all pages.

    Every key is listed, taken off and listed again on days that follow from its MD5.
    """
    found = pages.select(F.explode(keys(F.col("url"))).alias("key")).distinct()
    start = digit_pair(F.col("key"), 1)
    days = F.array(start, start + digit_pair(F.col("key"), 3) % 90 + 1, start + 150 + digit_pair(F.col("key"), 5) % 90)
    path = F.col("key").contains("/")
    return found.select(
        F.when(path, "allow").otherwise("block").alias("list"), "key", F.posexplode(days).alias("n", "days")
    ).select("list", "key", (F.col("n") != 1).alias("listed"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("days")).alias("at"))


SQL = r"""
WITH hosts AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 360 AS INTEGER) AS fetched_on,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1) AS host,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS part
  FROM pages
), split AS (
  SELECT *, string_split(host, '.') AS labels FROM hosts WHERE host <> ''
), keyed AS (
  SELECT page_id, url, fetched_on, unnest(list_concat(
    list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda i: array_to_string(labels[i:], '.')),
    CASE WHEN part <> '' THEN [host || '/' || part] ELSE [] END)) AS key
  FROM split
), found AS (
  SELECT DISTINCT key, CASE WHEN contains(key, '/') THEN 'allow' ELSE 'block' END AS list,
         CAST('0x' || substr(md5(key), 1, 2) AS INTEGER) AS a, CAST('0x' || substr(md5(key), 3, 2) AS INTEGER) AS b,
         CAST('0x' || substr(md5(key), 5, 2) AS INTEGER) AS c
  FROM keyed
), active AS (
  SELECT key, list, DATE '2024-01-01' + a AS valid_from, DATE '2024-01-01' + (a + b % 90 + 1) AS valid_until FROM found
  UNION ALL
  SELECT key, list, DATE '2024-01-01' + (a + 150 + c % 90), NULL FROM found
), ranked AS (
  SELECT k.page_id, k.key, list, valid_from,
         row_number() OVER (PARTITION BY k.page_id ORDER BY length(k.key) DESC, list, k.key DESC, valid_from DESC) AS place
  FROM keyed k JOIN active a ON k.key = a.key AND fetched_on >= valid_from AND (valid_until IS NULL OR fetched_on < valid_until)
)
SELECT h.page_id, h.fetched_on,
       CASE WHEN h.url IS NULL OR h.host = '' THEN 'unknown' WHEN r.key IS NULL THEN 'unlisted'
            WHEN r.list = 'allow' THEN 'allowed' ELSE 'blocked' END AS verdict,
       r.key AS decided_by, r.valid_from AS listed_since
FROM hosts h LEFT JOIN ranked r ON r.page_id = h.page_id AND r.place = 1
"""
