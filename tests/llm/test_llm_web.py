"""WARC archives and dated URL lists."""

import gzip
import hashlib
import io
import random
from collections import Counter
from datetime import date, timedelta

import pytest
import __spark_entry__ as entry
from compare import connect, difference
from pyspark.sql import functions as F
from tidemill.llm import urllists, warc

PAGES = "page_id long, url string, html string, digest string, keeper string"


def pages():
    r = random.Random(1)
    long = ["<p>" + "".join(r.choice("abé ") for _ in range(n)) for n in (998, 1500, 4000, 70_000)]
    out = [(i, f"http://h{i % 4}.example.com/p/{i}", long[i % 4], "x", None) for i in range(40)]
    out += [(50, "http://a.com/\r\nX: y", "short", None, None), (51, None, "short", None, None), (52, "", None, None, None)]
    out += [(53, "http://b.com", "", None, None), (54, "u", "a\r\n\r\nContent-Length: 3\r\n\r\n" * 80, None, None)]
    return out + [out[39], (None, "http://c.com", long[1], None, None), (None, None, None, None, None), (-3, "x", "z" * 1200, None, None)]


def test_archives(spark, none, tmp_path):
    frame = spark.createDataFrame(pages(), PAGES).repartition(3, "url")
    keep = {}
    for page, _, html, *_ in pages():
        payload = (html or "").encode()
        if len(payload) >= 1000 and page is not None:
            keep[payload] = max(keep.get(payload, page), page)
    expected = Counter()
    for page, _, html, *_ in pages():
        payload = (html or "").encode()
        revisit = payload in keep and page != keep[payload]
        expected[page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keep[payload] if revisit else None] += 1
    found = warc.archived(frame, str(tmp_path)).collect()
    assert Counter(tuple(r) for r in found) == expected
    assert any(r.record_type == "revisit" for r in found)
    assert warc.archived(frame.limit(0), str(tmp_path)).collect() == []


def test_every_member_of_a_normalised_archive_is_one_record(spark, tmp_path):
    frame = spark.createDataFrame(pages(), PAGES).repartition(2)
    files = warc.write_monolithic(warc.with_keepers(frame), f"{tmp_path}/one")
    index = warc.normalise(files, f"{tmp_path}/many").collect()
    whole = b"".join(gzip.decompress(open(r.file, "rb").read()) for r in files.collect())
    members = []
    for r in index:
        data = open(r.file, "rb").read()[r.at : r.at + r.size]
        members.append(gzip.decompress(data))
        assert warc.parsed(members[-1])[0]["warc-record-id"] == r.record_id
    assert sorted(members) == sorted(warc.inflated(io.BytesIO(gzip.compress(whole))))
    assert len(members) == len(pages())


def test_streams_of_several_members_and_cut_ones(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    made = [warc.record_bytes(i, "u", b"x" * i, "d", None, False) for i in range(30)]
    several = b"".join(gzip.compress(b"".join(made[i : i + 7])) for i in range(0, 30, 7))
    assert list(warc.inflated(io.BytesIO(several))) == made
    with pytest.raises(ValueError):
        list(warc.inflated(io.BytesIO(gzip.compress(b"".join(made)[:-9]))))


def test_lists_as_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op10_temporal_url_lists"
    assert difference(entry.queries()[name](spark, folder), connect(folder), entry.oracle_sql()[name]) is None


def brute_verdict(url, day, entries):
    if url is None or day is None or not url.lower().startswith("http://") or not url[7:].split("/")[0]:
        return "unknown", None
    name, _, rest = url.lower()[7:].partition("/")
    labels, part = name.split("."), rest.split("/")[0]
    keys = [".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))] + ([f"{name}/{part}"] if part else [])
    active = []
    for kind in ("allow", "block"):
        for key in keys:
            days = {}
            for k, e, listed, at in entries:
                if (k, e) == (kind, key) and listed is not None and at is not None and at <= day:
                    days[at] = days.get(at, False) or listed
            if days and days[max(days)]:
                active.append((len(key), kind == "allow", key))
    return ("allowed" if max(active)[1] else "blocked", max(active)[2]) if active else ("unlisted", None)


def test_lists_against_a_replay_of_the_log(spark):
    r = random.Random(6)
    first = date(2024, 1, 1)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "x.org", "one"]
    entries = [
        (r.choice(["allow", "block"]), r.choice([*hosts, "x.org/p", "a.b.example.com/q", "com"]), r.random() < 0.6, first + timedelta(r.randrange(200)))
        for _ in range(200)
    ] + [(None, "x.org", True, first), ("block", None, True, first), ("block", "one", None, first), ("block", "one", True, None)]
    captures = [
        (i, f"http://{r.choice(hosts)}/{r.choice(['p/1', 'q', ''])}", first + timedelta(r.randrange(-5, 260)), "v") for i in range(300)
    ] + [(300, None, first, None), (301, "http://x.org/", None, None), (302, "no url", first, "v"), (None, "HTTP://X.org/P/2", first + timedelta(90), None)]
    captures += captures[:2]
    log = spark.createDataFrame(entries, "list string, key string, listed boolean, at date")
    asked = spark.createDataFrame(captures, "page_id long, url string, fetched_on date, verdict string")
    found = urllists.judged(asked, log).select("page_id", "url", "fetched_on", "verdict", "decided_by").collect()
    expected = Counter((p, u, d, *brute_verdict(u, d, entries)) for p, u, d, _ in captures)
    assert Counter(tuple(x) for x in found) == expected
    assert urllists.judged(asked.limit(0), log).collect() == []
    assert {x.verdict for x in urllists.judged(asked, log.limit(0)).collect()} == {"unlisted", "unknown"}


def test_lists_use_no_python(spark):
    text = entry.queries()["op10_temporal_url_lists"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    for unwanted in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_keys(spark):
    made = spark.createDataFrame([("http://u:p@A.b.Co.uk:80/X/y?z",), ("http://one",), ("mailto:x",), (None,)], "u string")
    got = [r[0] for r in made.select(urllists.keys(F.col("u"))).collect()]
    assert got[1:] == [["one"], [], []]
    assert got[0][:3] == ["a.b.co.uk", "b.co.uk", "co.uk"]
