"""Language scores against sums over every segmentation, and held-out accuracy on the given documents."""

import math
import random
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from conftest_rows import prose, rows
from pyspark.sql import functions as F
from tidemill.llm import languages
from tidemill.llm.queries import REGISTRY, tokenizer

SF = "/root/testdata/sf0.01"
PIECES = tuple(sorted([b" ", b" a", b" ab", b"a", b"ab", b"abc", b"b", b"c", b"bc", b"cab", b"\xc3\xa9", b"\xc3", b"\xa9"]))


def segmentations(word, pieces):
    if not word:
        yield []
    for p in pieces:
        if word.startswith(p):
            yield from ([p, *rest] for rest in segmentations(word[len(p) :], pieces))


def random_probabilities(n, seed=1):
    r = random.Random(seed)
    p = np.array([[r.random() for _ in range(n)] for _ in PIECES])
    return np.vstack([p / p.sum(axis=0), np.zeros((1, n))])


@cache
def some_words():
    r = random.Random(4)
    return ["".join(r.choice("abcé") for _ in range(r.randrange(1, 8))) for _ in range(60)] + ["a", "é", "abcabcabc"]


def arrow_words(words):
    return pa.array([b" " + w.encode() for w in words], pa.large_binary())


def test_forward_sums_all_segmentations():
    p = random_probabilities(3)
    found = languages.log_sums(languages.trie(PIECES), arrow_words(some_words()), p)
    for word, logs in zip(some_words(), found):
        ways = list(segmentations(b" " + word.encode(), PIECES))
        direct = sum(np.prod([p[PIECES.index(x)] for x in way], axis=0) for way in ways)
        assert np.allclose(np.exp(logs), direct, rtol=1e-12) and ways


def test_expected_pieces_weigh_every_segmentation():
    p, times = random_probabilities(1)[:, 0], np.arange(1, len(some_words()) + 1)
    found = languages.expected(languages.trie(PIECES), arrow_words(some_words()), times, p)
    direct = np.zeros(len(PIECES) + 1)
    for word, n in zip(some_words(), times):
        ways = [[PIECES.index(x) for x in way] for way in segmentations(b" " + word.encode(), PIECES)]
        chance = [math.prod(p[i] for i in way) for way in ways]
        for way, c in zip(ways, chance):
            for i in way:
                direct[i] += n * c / sum(chance)
    assert np.allclose(found, direct, rtol=1e-10)


def test_words_cover_every_letter_once():
    texts = [prose(1, 60), "", "a1b é—ü x", "z" * 130 + " y", "  ", "日本語 123 " + "q" * 32, prose(2, 40)]
    data = [t.lower().encode() for t in texts]
    words, bounds = languages.split(
        np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    )
    words = words.to_pylist()
    for text, a, b in zip(data, bounds, bounds[1:]):
        runs = re.findall(rb"[a-z\x80-\xff]+", text)
        direct = [(b" " if i == 0 else b"") + run[i : i + 32] for run in runs for i in range(0, len(run), 32)]
        assert words[a:b] == direct


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


@pytest.fixture(scope="module")
def model(documents):
    training = documents.filter(languages.trains(F.col("doc_id")))
    return languages.fitted(training, tokenizer("byte_bpe_multi_50k.tiktoken"))


def test_rows_of_every_kind(documents, model):
    found = languages.predicted(documents, model, keep=("doc_id", "kept", "part")).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(r[0]) for r in rows())
    answers = {}
    for r in found:
        answers.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for doc_id, text, *_ in rows():
        letters = any(map(str.isalpha, text or ""))
        assert any((pred == "und") == (not letters) and (score == 0) == (not letters) for pred, score in answers[doc_id])
        assert all(pred in ("en", "fr", "und") and 0 <= score <= 1 for pred, score in answers[doc_id])
    assert model.langs == ["en", "fr"]


def test_training_documents_only(documents):
    """Held-out rows, their ``lang`` included, change nothing of the model."""
    vocabulary = tokenizer("byte_bpe_multi_50k.tiktoken")
    changed = documents.withColumn("lang", F.when(languages.trains(F.col("doc_id")), F.col("lang")).otherwise(F.lit("xx")))
    one, two = (languages.fitted(d.filter(languages.trains(F.col("doc_id"))), vocabulary) for d in (documents, changed))
    assert one.langs == two.langs
    assert np.allclose(one.probabilities(one.langs), two.probabilities(two.langs))
    held = {r.doc_id for r in documents.filter(~languages.trains(F.col("doc_id"))).collect()}
    assert held == {r[0] for r in rows() if crc(r[0]) % 5 == 0}


def test_languages_in_several_passes(spark, documents):
    """More languages than a pass holds give the same answers, with a third of all rows in one of them."""
    vocabulary = tokenizer("byte_bpe_multi_50k.tiktoken")
    out = [(i, prose(i % 7 if i % 3 else 1, 30) + f" {chr(97 + i % 7) * 3}", f"l{i % 7 if i % 3 else 1}") for i in range(60)]
    docs = spark.createDataFrame(out, "doc_id long, text string, lang string").repartition(3)
    answers = []
    for at_once in (2, 32):
        model = languages.fitted(docs, vocabulary, languages.Settings(at_once=at_once))
        found = languages.predicted(docs, model).orderBy("doc_id").collect()
        answers.append([(r.doc_id, r.lang_pred, round(r.score, 9)) for r in found])
        assert len(model.langs) == 7
    assert answers[0] == answers[1]


def test_no_language_learned(spark, documents, none):
    vocabulary = tokenizer("byte_bpe_multi_50k.tiktoken")
    for training in (none, documents.withColumn("lang", F.lit(None).cast("string")), documents.withColumn("text", F.lit("12 3"))):
        model = languages.fitted(training, vocabulary)
        assert {(r.lang_pred, r.score) for r in languages.predicted(documents, model).collect()} == {("und", 0.0)}
        assert languages.predicted(none, model).collect() == []


def test_one_word_of_a_megabyte_is_scored_whole(spark, documents, model):
    texts = [("x" * (1 << 20),), ("é" * (1 << 19) + "1",)]
    found = languages.predicted(spark.createDataFrame(texts, "text string").withColumn("doc_id", F.lit(1)), model).collect()
    assert all(r.lang_pred in model.langs for r in found)
    p = model.probabilities(model.langs)
    words, _ = languages.split(np.full(1 << 20, 0x78, np.uint8), np.array([0, 1 << 20]))
    assert len(b"".join(words.to_pylist())) == (1 << 20) + 1
    assert np.isfinite(languages.log_sums(languages.trie(model.pieces), words, p)).all()


def test_held_out_documents_are_recognised(spark, documents):
    found = REGISTRY["op13_segmentation_languages"](spark, SF)
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = found.filter("held_out").join(lang, "doc_id").collect()
    assert len(held) > 100 and all(crc(r.doc_id) % 5 == 0 for r in held)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
