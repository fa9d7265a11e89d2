"""Benchmark decontamination, the stages against brute force, and the registered queries."""

import random
from collections import Counter

import numpy as np
import pytest
import __spark_entry__ as entry
import corpus_pipeline
from conftest_rows import SCHEMA, prose, rows
from test_llm_dedup import brute_print, groups
from tidemill.llm import decontamination, stages

FOLDER = "/root/testdata/sf0.001"
SIGNS = str.maketrans("", "", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def bare(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in (text or "").translate(SIGNS))
    return [w for w in lowered.replace("\r", " ").replace("\n", " ").replace("\t", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]


def likeness(a, b):
    a, b = (Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def brute_best(text, item):
    words, wanted = bare(text), bare(item)
    if len(wanted) < 5 or len(words) < 5:
        return 0
    return max(likeness(words[i : i + len(wanted)], wanted) for i in range(max(len(words) - len(wanted), 0) + 1))


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(i, prose(200 + i, 15 + 4 * i)) for i in range(10)]
    items += [(20, prose(99, 40)), (21, "four words only here"), (22, None), (23, ""), (None, prose(250, 30)), (24, items[0][1])]
    return items, spark.createDataFrame(items, "item_id long, text string")


def planted(items):
    r, out = random.Random(3), rows()
    for i, (_, text) in enumerate(items[:10]):
        words = text.split()
        edited = list(words)
        edited[len(edited) // 2] = "other"
        cut = words[: len(words) // 2]
        for j, part in enumerate((words, edited, cut, ["".join(c.upper() if c.isascii() else c for c in w) + "!" for w in words])):
            body = prose(300 + i, 40) + " ".join(part) + " " + prose(400 + i, r.randrange(0, 30))
            out.append((1000 + 10 * i + j, body, "en", "s", 0, None, None))
        out.append((1500 + i, " ".join(words[1:]), None, None, None, None, None))
    return out + [(1600, items[14][1], "en", "s", 0, None, None)]


def test_contaminated_documents(spark, benchmark):
    items, table = benchmark
    texts = planted(items)
    frame = spark.createDataFrame(texts, SCHEMA).repartition(3)
    found = decontamination.contaminated(frame, table).collect()
    best = {(doc, item, text): brute_best(text, wanted) for doc, text, *_ in texts for item, wanted in items}
    expected = Counter((doc, item) for doc, text, *_ in texts for item, _ in items if best[doc, item, text] >= 0.8)
    assert Counter((r.doc_id, r.item_id) for r in found) == expected
    assert expected[1000, 0] and expected[1003, 0] and not expected[1002, 0]
    by_id = {doc: text for doc, text, *_ in texts}
    for r in found:
        assert r.similarity >= 0.8 and r.distance <= 22
        piece = by_id[r.doc_id].encode()[r.byte_start : r.byte_end].decode()
        assert bare(piece) == bare(by_id[r.doc_id])[r.first_word : r.first_word + r.n_words]
    left = decontamination.decontaminated(frame, table)
    assert left.schema == frame.schema
    bad = {(doc, text) for doc, text, *_ in texts if any(best[doc, item, text] >= 0.8 for item, _ in items)}
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((d, t) for d, t, *_ in texts if (d, t) not in bad)


def test_multi_index_finds_all_within_the_radius():
    r = random.Random(5)
    index = decontamination.Benchmark(list(range(40)), [prose(i, 30) for i in range(40)], decontamination.Rule())
    marks = [int(m) for m in index.marks]
    windows = [r.getrandbits(64) for _ in range(50)]
    for m in marks:
        for flips in (0, 5, 15, 21, 22, 23, 26):
            windows.append(m ^ sum(1 << b for b in r.sample(range(64), flips)))
    row, item, distance = index.candidates(np.array(windows, dtype=np.uint64), np.arange(40))
    expected = {(i, j): (w ^ m).bit_count() for i, w in enumerate(windows) for j, m in enumerate(marks) if (w ^ m).bit_count() <= 22}
    assert dict(zip(zip(row.tolist(), item.tolist()), distance.tolist())) == expected


def test_fingerprints_lose_no_similar_window(spark):
    """Items with one word changed in the middle are found at 0.8, also where many bits differ."""
    import pyarrow as pa

    items, texts = [], []
    for i in range(4000):
        r = random.Random(i)
        words = [f"w{r.getrandbits(40)}" for _ in range(49 + i % 11)]
        items.append(" ".join(words))
        words[len(words) // 2] = "other"
        texts.append(" ".join(words))
    rule = decontamination.Rule()
    index = decontamination.Benchmark(list(range(len(items))), items, rule)
    wanted = {i for i, (a, b) in enumerate(zip(texts, items)) if likeness(bare(a), bare(b)) >= rule.similarity}
    found = {(r, match[0]): match for r, match in decontamination._found(pa.RecordBatch.from_pydict({"text": texts}), index)}
    assert wanted and {r for r, item in found if r == item} >= wanted
    assert 16 < max(match[2] for match in found.values()) <= rule.radius


def test_long_texts_and_items_alike(monkeypatch):
    """Long texts are taken in stretches, common shingles in parts; the matches stay those of one go."""
    import pyarrow as pa

    items = [f"which of the following is {prose(i, 20 + i % 4)}" for i in range(60)]
    text = " ".join(prose(1000 + i, 70) + " which of the following is " + (items[i] if i % 9 == 0 else "") for i in range(60))
    find = lambda: [m for m in decontamination._found(pa.RecordBatch.from_pydict({"text": [text, items[5]]}), index)]
    index = decontamination.Benchmark(list(range(60)), items, decontamination.Rule())
    whole = find()
    assert {(r, m[0]) for r, m in whole} >= {(0, i) for i in range(0, 60, 9)} | {(1, 5)}
    monkeypatch.setattr(decontamination, "STRETCH", 40)
    monkeypatch.setattr(decontamination, "PAIRS", 64)
    assert find() == whole


def test_nothing_to_decontaminate(documents, none, benchmark):
    assert decontamination.contaminated(none, benchmark[1]).collect() == []
    assert decontamination.contaminated(documents, benchmark[1].limit(0)).collect() == []
    assert decontamination.decontaminated(documents, benchmark[1].limit(0)).count() == len(rows())


def test_one_document_of_each_near_duplicate_group_stays(spark, documents):
    kept = [(r.doc_id, r.text) for r in stages.simhash_near_dedup(spark, documents, FOLDER).collect()]
    prints = [(doc, text, brute_print(text)) for doc, text, *_ in rows()]
    distinct = sorted({p for *_, p in prints})
    group = groups(distinct, [(a, b) for a in distinct for b in distinct if (a ^ b).bit_count() <= 2])
    least = {}
    for doc, _, p in prints:
        if doc is not None:
            least[group[p]] = min(least.get(group[p], doc), doc)
    assert Counter(group[brute_print(text)] for _, text in kept) == Counter(set(group.values()))
    assert all(doc == least.get(group[brute_print(text)]) for doc, text in kept)


def test_suffix_stage_cuts_whole_characters(spark, documents):
    found = stages.suffix_array_dedup(spark, documents, FOLDER)
    assert found.schema == documents.schema and found.count() == len(rows())
    for r in found.collect():
        assert r.n_chars is None if r.text is None else r.n_chars == len(r.text)


@pytest.mark.parametrize("number", range(5))
def test_stages_take_empty_tables(spark, none, number):
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, none, FOLDER)
    assert out.collect() == [] and (number == 4 or out.columns == none.columns)


def test_pipeline(spark):
    """Every stage works on what its predecessor kept; the pieces are of the texts that are left."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frames[-1], FOLDER)
        assert out.columns == docs.columns
        frames.append(spark.createDataFrame(out.collect(), docs.schema).repartition(2))
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in frames[1].collect()}
    good = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(d in kept for d in good) >= 0.9 * len(good)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = ({r.doc_id: r.text for r in f.collect()} for f in frames[3:5])
    hit = {d for d, t in before.items() if any(" ".join(i.split()) in " ".join(t.split()) for _, i in items)}
    assert hit and not hit & set(after)
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {p.doc_id for p in pieces} == set(after)
    assert max(Counter(p.sequence_id for p in pieces for _ in range(p.length)).values()) <= 4096


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op")))
def test_queries_return_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_columns_with_an_operators_names_come_through(spark, documents):
    """The fixture's own ``kept`` and ``part`` columns are data, whatever the operators add."""
    before = {(r.doc_id, r.text): (r.kept, r.part) for r in documents.collect()}
    for stage in (stages.quality_classifier, stages.simhash_near_dedup, stages.benchmark_decontamination):
        out = stage(spark, documents, FOLDER)
        assert out.schema == documents.schema
        for r in out.collect():
            assert (r.kept, r.part) in {v for (d, t), v in before.items() if (d, t) == (r.doc_id, r.text)}
    out = stages.suffix_array_dedup(spark, documents, FOLDER)
    assert out.schema == documents.schema and {r.kept for r in out.collect()} == {"x", "y", None}
