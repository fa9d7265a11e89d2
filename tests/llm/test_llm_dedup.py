"""Suffix dedup, SimHash groups and components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest_rows import SCHEMA, rows
from tidemill.llm import simhash, suffixes
from tidemill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_suffixes(table, length=50):
    """(doc_id, remaining bytes, removed, spans) of every row."""
    data = [(doc, (text or "").encode()) for doc, text, *_ in table]
    first = {}
    for doc, b in data:
        if doc is not None:
            for i in range(len(b) - length + 1):
                s = b[i : i + length]
                first[s] = min(first.get(s, doc), doc)
    out = Counter()
    for doc, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            least = first.get(b[i : i + length])
            if least is not None and (doc is None or least < doc):
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[doc, hashlib.sha256(kept).hexdigest(), sum(gone), len(re.findall(b"\x01+", bytes(gone)))] += 1
    return out


def found_suffixes(frame, length=50, large=suffixes.LARGE):
    return Counter(
        (r.doc_id, hashlib.sha256(r.kept).hexdigest(), r.n_removed, r.n_spans)
        for r in suffixes.without_repeats(frame, length, large).collect()
    )


@pytest.mark.parametrize("large", [suffixes.LARGE, 0])
def test_suffixes_of_the_fixture(documents, large):
    assert found_suffixes(documents, large=large) == brute_suffixes(rows())


@pytest.mark.parametrize("large", [5, 0])
def test_many_contexts_of_one_passage(spark, large):
    """A third of all documents share a line, each between words of its own."""
    r = random.Random(3)
    own = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    line = own(80)
    texts = [own(r.randrange(60)) + (line[r.randrange(25) :] if i % 3 == 0 else own(40)) + own(r.randrange(60)) for i in range(300)]
    table = [(i if i % 50 else None, t, None, None, None, None, None) for i, t in enumerate(texts)]
    table += [(7, texts[9], None, None, None, None, None), (9, line, None, None, None, None, None)]
    assert found_suffixes(spark.createDataFrame(table, SCHEMA).repartition(5), large=large) == brute_suffixes(table)


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes_of_repetitive_texts(spark, monkeypatch, seed):
    """Few letters, periods and copied stretches; texts longer than a segment."""
    monkeypatch.setattr(suffixes, "SEGMENT", 600)
    r = random.Random(seed)
    pool = ["".join(r.choice("ab") for _ in range(r.randrange(40, 90))) for _ in range(6)] + ["a" * 120, "ab" * 70, "é" * 60]
    texts = []
    for i in range(60):
        parts = [r.choice(pool) if r.random() < 0.6 else "".join(r.choice("abc") for _ in range(30)) for _ in range(r.randrange(0, 30))]
        texts.append((i % 50, "".join(parts), None, None, None, None, None))
    frame = spark.createDataFrame(texts, SCHEMA).repartition(4)
    assert found_suffixes(frame) == brute_suffixes(texts)
    assert found_suffixes(frame, 17) == brute_suffixes(texts, 17)
    assert found_suffixes(frame, 17, large=1) == brute_suffixes(texts, 17)


def test_no_suffixes(none):
    assert suffixes.without_repeats(none).collect() == []
    with pytest.raises(ValueError):
        suffixes.without_repeats(none, 16)


def test_equal_strings():
    r = random.Random(9)
    pieces = ["".join(r.choice("ab") for _ in range(r.randrange(0, 80))).encode() for _ in range(40)]
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    for length in (8, 9, 16, 23, 50):
        times = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        at, bucket = suffixes.equal_strings(data, offsets, length)
        strings = [data[a : a + length].tobytes() for a in at.tolist()]
        assert Counter(strings) == Counter({s: n for s, n in times.items() if n > 1})
        assert len(set(zip(strings, bucket.tolist()))) == len(set(strings)) == len(set(bucket.tolist()))


def brute_print(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_groups(documents):
    prints = [(doc, brute_print(text)) for doc, text, *_ in rows()]
    distinct = sorted({p for _, p in prints})
    found = simhash.near_duplicates(documents, radius=2).collect()
    near = [(a, b) for a in distinct for b in distinct if (a ^ b).bit_count() <= 2]
    group, least = groups(distinct, near), {}
    for doc, p in prints:
        if doc is not None:
            least[group[p]] = min(least.get(group[p], doc), doc)
    expected = Counter((doc, p, least.get(group[p])) for doc, p in prints)
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found) == expected


@pytest.mark.parametrize("radius, tile", [(2, 2048), (2, 3), (4, 16)])
def test_links_connect_all_within_the_radius(spark, radius, tile):
    r = random.Random(radius)
    prints = [r.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for _ in range(400):
        p = r.choice(prints)
        for _ in range(r.randrange(1, 6)):
            p ^= 1 << r.randrange(64)
        prints.append(p)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), radius, tile=tile).collect()
    distinct = sorted({p for (p,) in signed})
    near = [(a, b) for a in distinct for b in distinct if a < b and ((a ^ b) % (1 << 64)).bit_count() <= radius]
    assert all(((x.a ^ x.b) % (1 << 64)) for x in links)
    assert groups(distinct, [(x.a, x.b) for x in links]) == groups(distinct, near)


def test_components(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(50)] + [(5, 5)]
    links += [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(60)] + [(-7, 3000)]
    found = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == groups(nodes, links)


def test_no_documents(none):
    assert simhash.near_duplicates(none).collect() == []
