"""Token pieces, packing and binary records."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_rows import rows
from tidemill.llm import packing, records
from tidemill.llm.queries import tokenizer
from tidemill.llm.tokens import encoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def direct(file):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer(file))
    return lambda text: plain.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("file", FILES)
def test_ids_are_those_of_the_library(file):
    r = random.Random(3)
    signs = list(" \n\t\r\x0b\x0c\x1c\x85\xa0 　abzABZéÉñß'’.,;!*$%0129<|>́̊")
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(40))) for _ in range(3000)]
    spelled = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "|>", "\n", "\n\nAb", "  ", " Ab", "\u0301", "'s", "\xa0 x"]
    texts += ["".join(r.choice(spelled) for _ in range(r.randrange(9))) for _ in range(3000)]
    texts += ["<|endof", "text|>", "<|start", "<|endoftext|><|endoftext|>"]  # not across rows
    texts += [t for _, t, *_ in rows()] + ["x<|endoftext|> y", "İstanbul ΣΑΣ don't I'LL", None]
    ids, bounds = encoder(tokenizer(file)).encode(pa.array(texts, pa.string()))
    plain = direct(file)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == plain(text), repr(text)


def packed(frame, **capacities):
    found = packing.packed_documents(frame, tokenizer(FILES[0]), 1, packing.Capacities(**capacities)).collect()
    sequences = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        at = sequences.setdefault(r.sequence_id, [])
        assert r.offset == sum(p.length for p in at)
        at.append(r)
    return found, sequences


def test_pieces_and_capacities(documents):
    plain, expected = direct(FILES[0]), Counter()
    for doc, text, *_ in rows():
        ids = plain(text) + [1]
        for n, start in enumerate(range(0, len(ids), 256)):
            part = ids[start : start + 256]
            expected[doc, n, start, len(part), crc(part)] += 1
    found, sequences = packed(documents, tokens=256, documents=256, attention=256 * 256)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    assert len(sequences) <= 1.05 * sum(r.length for r in found) / 256 + 1
    for rule in ("norm", "dot"):
        _, sequences = packed(documents, tokens=256, documents=3, attention=40_000 + 256 * 256 // 2, rule=rule)[0:2]
        for pieces in sequences.values():
            assert sum(p.length for p in pieces) <= 256 and len(pieces) <= 3
            assert sum(p.length**2 for p in pieces) <= 40_000 + 256 * 256 // 2


def test_equal_rows_are_spread(spark):
    """Many copies of one row are numbered in several buckets, without gaps."""
    pieces = spark.range(5000).selectExpr("1L as doc_id", "0 as piece", "7L as length", "xxhash64(id) as _spread")
    found = packing.pack(pieces, packing.Capacities(tokens=70, documents=10, attention=4900), bucket_rows=100).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == 5000 and len({r.sequence_id for r in found}) == 500


def test_empty_table_packs_to_nothing(none):
    assert packed(none)[0] == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_places_every_piece_once(rule):
    r = np.random.default_rng(5)
    histogram = {int(k): int(n) for k, n in zip(r.integers(1, 101, 60), r.integers(1, 40, 60))}
    limits = packing.Capacities(tokens=100, documents=6, attention=7000 + 3000, rule=rule)
    slots = {}
    for length, first, n, each, sequence, offset in packing.plan(histogram, limits):
        for i in range(n):
            slots.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
    assert Counter(k for pieces in slots.values() for _, k in pieces) == histogram
    for pieces in slots.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [k for _, k in pieces])[:-1].tolist()
        assert sum(k for _, k in pieces) <= 100 and len(pieces) <= 6 and sum(k * k for _, k in pieces) <= 10_000


def test_a_piece_that_fits_nowhere_is_an_error():
    with pytest.raises(ValueError):
        packing.plan({11: 1}, packing.Capacities(tokens=100, attention=100))


@pytest.mark.parametrize("wide", [False, True])
def test_records_round_trip(spark, documents, tmp_path, wide):
    index = records.write_records(documents, tokenizer(FILES[1]), 2, str(tmp_path), wide_ids=wide)
    found = records.with_starts(records.read_records(index, str(tmp_path), wide)).collect()
    plain, expected, start = direct(FILES[1]), Counter(), 0
    for doc, text, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        expected[doc, crc(plain(text) + [2])] += 1
    assert Counter((r.doc_id, r.ids_crc32) for r in found) == expected
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start) if r.doc_id is not None]
    assert ids == sorted(ids)


def test_no_records(none, tmp_path):
    index = records.write_records(none, tokenizer(FILES[1]), 2, str(tmp_path))
    assert records.with_starts(records.read_records(index, str(tmp_path))).collect() == []


def test_checksums():
    assert records.crc32c([b"123456789"])[0] == 0xE3069283  # the published check value
    r = random.Random(1)
    messages = [r.randbytes(r.randrange(4, 3000)) for _ in range(60)]
    state = []
    for m in messages:
        c = 0xFFFFFFFF
        for b in m:
            c = int(records.TABLE[(c ^ b) & 0xFF]) ^ (c >> 8)
        state.append(c ^ 0xFFFFFFFF)
    assert records.crc32c(messages).tolist() == state
    framed = records.framed(messages)
    assert records.payloads_of(framed) == messages
    for at in (3, 9, 20, -2):
        broken = bytearray(framed[0])
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.payloads_of([bytes(broken)])
