"""Quality rules, importance resampling and context-tree scores against direct calculations."""

import glob
import math
import random
import re
import tempfile
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_rows import rows
from tidemill.llm import contextparts, contexttree, divergence, lmscoring, queries, resampling
from tidemill.session import stored, swept

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall(text or "")


def base(text):
    words, text = words_of(text), text or ""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def kind(c):
    table = [("a-z", "lower"), ("A-Z", "upper"), ("0-9", "digit"), (r" \t-\r", "space"), ("#*$%&|<>", "symbol"), ("!-~", "sign")]
    for signs, name in table:
        if re.match(f"[{signs}]", c):
            return name
    return "wide" if ord(c) > 127 else "control"


def distance(p, q):
    if not p:
        return None
    p, q = ({k: n / sum(c.values()) for k, n in c.items() if n} for c in (p, q))
    m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in {*p, *q}}
    return math.sqrt(sum(sum(x * math.log2(x / m[k]) for k, x in c.items()) for c in (p, q)) / 2)


def test_base_measures_and_distances(documents):
    limits = divergence.Limits(common_words=5)
    found = divergence.judged(documents, limits).collect()
    assert Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found
    ) == Counter((doc, *base(text)) for doc, text, *_ in rows())
    chars, words = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, *_ in rows():
        chars[lang].update(map(kind, text or ""))
        words[lang].update(words_of(text))
    expected = Counter()
    for doc, text, lang, *_ in rows():
        common = sorted(words[lang], key=lambda w: (-words[lang][w], w.encode()))[:5]
        binned = lambda c: Counter({w: c[w] for w in common}) + Counter({None: sum(n for w, n in c.items() if w not in common)})
        c = distance(Counter(map(kind, text or "")), chars[lang])
        w = distance(binned(Counter(words_of(text))), binned(words[lang]))
        expected[doc, c is not None and round(c, 9), w is not None and round(w, 9)] += 1
    assert Counter(
        (r.doc_id, r.char_distance is not None and round(r.char_distance, 9), r.word_distance is not None and round(r.word_distance, 9))
        for r in found
    ) == expected
    for r in found:
        far = r.word_chars >= 100 and (r.char_distance or 0) > limits.char_distance
        most = limits.word_distance + limits.word_slack / math.sqrt(max(r.n_words, 1))
        far |= r.n_words >= limits.min_words and (r.word_distance or 0) > most
        assert r.kept == (not r.base_failed and not far)


def test_more_languages_than_tasks_hold(spark, documents):
    """Every language has references of its own, however many there are."""
    r = random.Random(6)
    many = [(i, " ".join(f"{a}{r.randrange(23)}" for k in range(60)), a, None, None, None, None)
            for a in ("xa", "yb", "zc", "wd", "ve") for i in range(8)]
    frame = documents.unionByName(spark.createDataFrame(many, documents.schema))
    order = lambda found: sorted(map(repr, found.collect()))
    whole = order(divergence.judged(frame))
    assert len(whole) == frame.count()
    for most in (1, 2, 3):
        assert order(divergence.judged(frame, divergence.Limits(languages=most))) == whole
    kept = divergence.judged(frame, divergence.Limits(languages=1)).filter("lang in ('xa', 'yb', 'zc', 'wd', 've')")
    assert all(r.kept for r in kept.collect())


def test_no_rules_without_documents(none):
    assert divergence.judged(none).collect() == []


@pytest.fixture(scope="module")
def labels(spark):
    good = [(i, 1, 0) for i in range(0, 20)] + [(3, 1, 0), (None, 1, 0), (21, None, 0), (20, 1, 1), (22, 1, None)]
    return spark.createDataFrame(good + [(i, 0, 0) for i in (31, 32, 33, 34, 35)], "doc_id long, quality int, toxic int")


def test_resampling(documents, labels):
    model = resampling.Model(buckets=1 << 12, prior=3.0)
    sample = resampling.labelled_sample(labels, model)
    assert 20 not in sample and 21 not in sample and sample[3][0] and not sample[32][0]
    ratio = resampling.fit(documents, sample, model)
    found = resampling.resampled(documents, labels, model).collect()
    assert len(found) == len(rows())
    target = {d for d, (good, fits) in sample.items() if good and fits}

    import pyarrow as pa

    every, wanted = Counter(), Counter()
    for doc, text, *_ in rows():
        b, _ = resampling.features(pa.array([text], pa.string()), model.buckets)
        every.update(b.tolist())
        wanted.update(b.tolist() if doc in target else [])
        n = len(words_of(text))
        assert len(b) == max(2 * n - 1, 0)
    share = sum(wanted.values()) / sum(every.values())
    for b, n in every.items():
        assert math.isclose(ratio[b], math.log((wanted[b] + 3 * share) / (n + 3) / share), abs_tol=1e-12)
    for r in found:
        b, _ = resampling.features(pa.array([r.text], pa.string()), model.buckets)
        assert math.isclose(r.log_weight, sum(ratio[b]), abs_tol=1e-9) and r.n_grams == len(b)
    keys = sorted((r.gumbel_key for r in found), reverse=True)
    kept = [r.gumbel_key for r in found if r.kept]
    assert kept and sorted(kept, reverse=True) == keys[: len(kept)]
    assert resampling.resampled(documents, labels, model).filter("kept").count() == len(kept)


def test_toxic_documents_are_not_drawn(spark):
    """Fluent text labelled good and toxic goes, labelled or not; nearly all good text stays."""
    r = random.Random(1)
    plain = lambda: " ".join(r.choice(["the", "of", "ten", "sol", "ri", "gat", "moon", "tide"]) for _ in range(60))
    table = [(i, plain() + (" you idiot " + plain() if i % 6 == 0 else ""), int(i % 11 > 0), int(i % 6 == 0)) for i in range(600)]
    table = [(i, text if good else "## $$ zz " * 30, good, toxic and good) for i, text, good, toxic in table]
    labels = spark.createDataFrame([(i, good, toxic) for i, _, good, toxic in table if i < 400], "doc_id long, quality int, toxic int")
    documents = spark.createDataFrame([(i, text) for i, text, *_ in table], "doc_id long, text string").repartition(3)
    kept = {row.doc_id for row in resampling.resampled(documents, labels).filter("kept").collect()}
    assert not kept & {i for i, *_, toxic in table if toxic}
    fine = {i for i, _, good, toxic in table if good and not toxic}
    assert len(kept & fine) >= 0.9 * len(fine)


def test_resampling_without_labels_or_documents(documents, none, labels):
    assert resampling.resampled(documents, labels.limit(0)).filter("not kept").count() == 0
    assert resampling.resampled(none, labels).collect() == []


def test_largest(spark):
    r = random.Random(2)
    values = [r.gauss(0, 1) for _ in range(3000)] + [0.25] * 500 + [1e9, -1e9]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    values.sort(reverse=True)
    for k in (1, 2, 7, 1000, 1400, 1700, 3501, 3502):
        assert resampling.largest(frame, "v", k) == values[k - 1]
    assert resampling.largest(frame, "v", 0) == math.inf and resampling.largest(frame.limit(0), "v", 3) == math.inf


def kt(zeros, ones):
    p = 1.0
    for i in range(zeros):
        p *= (i + 0.5) / (i + 1)
    for i in range(ones):
        p *= (i + 0.5) / (zeros + i + 1)
    return p


def brute_tree(texts, depth):
    """Counts of every node (context, known bits), its weighted probability and its prediction."""
    counts = defaultdict(lambda: [0, 0])
    for t in texts:
        padded = bytes(depth) + t
        for i in range(len(t)):
            for d in range(depth + 1):
                bits = f"{t[i]:08b}"
                for b in range(8):
                    counts[padded[depth + i - d : depth + i], bits[:b]][int(bits[b])] += 1

    def weighted(node):
        context, bits = node
        own = kt(*counts[node])
        if len(context) == depth:
            return own
        product = 1.0
        for c in range(256):
            child = (bytes([c]) + context, bits)
            if child in counts:
                product *= weighted(child)
        return (own + product) / 2

    def predicted(context, bits, bit):
        p = None
        for d in range(depth, -1, -1):
            node = (context[len(context) - d :], bits)
            if node not in counts:
                p = None
                continue
            zeros, ones = counts[node]
            own = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
            if p is None:
                p = own
            else:
                w = kt(zeros, ones) / 2 / weighted(node)
                p = w * own + (1 - w) * p
        return 0.5 if p is None else p

    def score(t):
        padded, total = bytes(depth) + t, 0.0
        for i in range(len(t)):
            bits = f"{t[i]:08b}"
            total += sum(math.log10(predicted(padded[i : i + depth], bits[:b], int(bits[b]))) for b in range(8))
        return total

    return score


def test_tree_scores_are_those_of_the_definition():
    r = random.Random(8)
    train = [bytes(r.choice(b"abc ") for _ in range(r.randrange(0, 30))) for _ in range(6)]
    score = brute_tree(train, 2)
    data, offsets = joined(train)
    strings, n = np.unique(contexttree.grams(data, offsets, 2), return_counts=True)
    levels = contexttree.tree(levels_of(strings, n, 2))
    scorer = contexttree.Scorer(levels)
    for text in [*train, b"", b"abcab", b"zz", b"a" * 20, "é".encode()]:
        for _ in range(2):  # the second time from memory
            assert math.isclose(scorer(*joined([text])).sum(), score(text), abs_tol=1e-4)


def joined(texts):
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def levels_of(strings, n, depth):
    out = []
    for d in range(depth + 1):
        keys, at = np.unique(strings & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
        out.append((keys, np.bincount(at, n).astype(np.int64)))
    return out


def test_predictions_add_up_to_one():
    data, offsets = joined([b"the theme of the thesis", b"then there"])
    strings, n = np.unique(contexttree.grams(data, offsets, 3), return_counts=True)
    levels = contexttree.tree(levels_of(strings, n, 3))
    for context in (0, int.from_bytes(b"eht", "big"), int.from_bytes(b"zzz", "big")):
        every = np.array([context << 8 | b for b in range(256)], dtype=np.uint64)
        assert math.isclose((10 ** contexttree.log10_of(every, levels)).sum(), 1, abs_tol=1e-6)


def test_scores_of_documents(documents):
    found = lmscoring.scored(documents, lmscoring.Settings(depth=2)).collect()
    table = [(doc, text or "", zlib.crc32(str(doc).encode() if doc is not None else b"") % 5 == 1) for doc, text, *_ in rows()]
    known = Counter(w for _, t, out in table if not out for w in [*words_of(t.translate(LOWER)), None])
    total, distinct = sum(known.values()), len(known)
    data, offsets = joined([t.encode() for _, t, out in table if not out])
    strings, n = np.unique(contexttree.grams(data, offsets, 2), return_counts=True)
    scorer = contexttree.Scorer(contexttree.tree(levels_of(strings, n, 2)))
    expected = Counter()
    for doc, t, out in table:
        tokens = [*words_of(t.translate(LOWER)), None]
        score = sum(math.log10((known[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        expected[doc, out, len(tokens), sum(known[w] > 0 for w in tokens), total, round(score, 6), round(scorer(*joined([t.encode()])).sum(), 6)] += 1
    assert Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found
    ) == expected


def test_no_scores(none):
    assert lmscoring.scored(none).collect() == []


def test_held_out_text_of_the_training_kind_is_likelier(spark):
    """Held-out prose costs fewer bits per byte than its letters in random order."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = lmscoring.scored(documents).filter("held_out and n_bytes > 200").collect()
    bits = [-r.score * math.log2(10) / r.n_bytes for r in found]
    assert 0 < sum(bits) / len(bits) < 4


def deep_tree(texts, depth):
    """As ``brute_tree``, with every node's children and probability remembered."""
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for t in texts:
        padded = bytes(depth) + t
        for i in range(len(t)):
            bits = f"{t[i]:08b}"
            for b in range(8):
                for d in range(depth + 1):
                    node = padded[depth + i - d : depth + i], bits[:b]
                    counts[node][int(bits[b])] += 1
                    if d:
                        children[node[0][1:], bits[:b]].add(node)
    logs = {}
    for node in sorted(counts, key=lambda n: -len(n[0])):
        zeros, ones = counts[node]
        own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
        product = sum(logs[c][1] for c in children[node])
        logs[node] = own, own if len(node[0]) == depth else np.logaddexp(own, product) - math.log(2)

    def score(t):
        padded, total = bytes(depth) + t, 0.0
        for i in range(len(t)):
            bits = f"{t[i]:08b}"
            for b in range(8):
                p = None
                for d in range(depth, -1, -1):
                    node = padded[depth + i - d : depth + i], bits[:b]
                    if node not in logs:
                        p = None
                        continue
                    own = (counts[node][1] + 0.5) / (sum(counts[node]) + 1)
                    w = math.exp(logs[node][0] - logs[node][1]) / 2
                    p = own if p is None else w * own + (1 - w) * p
                p = 0.5 if p is None else p
                total += math.log10(p if bits[b] == "1" else 1 - p)
        return total

    return score


@pytest.mark.parametrize("depth, subtree", [(12, 1 << 20), (12, 40), (15, 3), (3, 1)])
def test_deep_contexts_keep_all_counts(spark, depth, subtree):
    """Contexts longer than words, with every string of a level kept, whatever is in the top of the tree."""
    r = random.Random(4)
    words = ["the", "theme", "thesis", "über", "a", "on", "another one"]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 12))) for _ in range(40)] + ["", "the the the theme " * 3, "zz\u0000z"]
    train = [t.encode() for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    score = deep_tree(train, depth)
    found = lmscoring.scored(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), lmscoring.Settings(depth=depth, subtree=subtree)
    ).collect()
    assert len(found) == len(texts)
    for row in found:
        assert math.isclose(row.score, score(texts[row.doc_id].encode()), abs_tol=1e-4)


def test_strings_meet_in_passes():
    """Every string is sent in one pass and every root has one pass; a pass sends a part of them only."""
    r = random.Random(5)
    data, offsets = joined([bytes(r.choice(b"abcdefgh the") for _ in range(r.randrange(0, 90))) for _ in range(400)])
    hi, lo, row = contextparts.strings_of(data, offsets, 12)
    top = contextparts.top_of(hi, 12, 300)
    sent = [contextparts.strings_of(data, offsets, 12, wanted) for wanted in contextparts.pass_masks(top, 8)]
    assert Counter(zip(hi.tolist(), lo.tolist(), row.tolist())) == Counter(s for one in sent for s in zip(*(x.tolist() for x in one)))
    assert max(len(one[0]) for one in sent) < len(hi) / 2
    roots = []
    for own, _, _ in sent:
        depths = contextparts.root_depths(own, top)
        roots.append(set(zip((own >> (64 - 8 * depths).astype(np.uint64)).tolist(), depths.tolist())))
    assert sum(map(len, roots)) == len(set.union(*roots))


@pytest.mark.parametrize("passes", [1, 5])
def test_scores_do_not_depend_on_passes(spark, passes):
    """Also for repeated and missing texts, and for bytes and contexts that training never saw."""
    texts = ["the theme of the thesis", "then there", None, "", "the theme of the thesis", "zzz the thesaurus", "über", "t"] * 2
    train = [(t or "").encode() for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    assert len(train) < len(texts)
    score = deep_tree(train, 9)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = lmscoring.scored(frame, lmscoring.Settings(depth=9, subtree=20, passes=passes)).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(texts)))
    for row in found:
        assert math.isclose(row.score, score((texts[row.doc_id] or "").encode()), abs_tol=1e-6)


@pytest.mark.parametrize("depth, subtree", [(12, 300), (15, 20), (4, 1 << 20)])
def test_subtrees_in_pieces(depth, subtree):
    """Below whatever contexts the subtrees are cut, they tell the top the same and all bytes have the probabilities of the definition."""
    r = random.Random(7)
    words = ["the", "theme", "thesis", "über", "a", "on", "another one", "\u0000"]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 12))).encode() for _ in range(60)]
    data, offsets = joined(texts)
    hi, lo, row = contextparts.strings_of(data, offsets, depth)
    top = contextparts.top_of(hi, depth, subtree)
    hi, lo, place = contextparts.distinct(hi, lo)
    times = np.bincount(place, row % 4 > 0).astype(np.int64)
    roots, whole = contextparts.root_depths(hi, top), None
    score = deep_tree([t for i, t in enumerate(texts) if i % 4], depth)
    for most in (1 << 20, 100, 7):
        told, _ = contextparts.worked_out(hi, lo, times, roots, top, depth, most)
        levels, added = contextparts.top_levels(told, top), defaultdict(float)
        for *key, n, value in zip(*(x.tolist() for x in told)):
            added[tuple(key)] += n + value
        whole = whole or added
        assert added.keys() == whole.keys() and all(math.isclose(whole[k], v, abs_tol=1e-8) for k, v in added.items())
        told, logs = contextparts.worked_out(hi, lo, times, roots, top, depth, most, levels)
        by_text = np.bincount(row, logs[place], minlength=len(texts))
        assert all(math.isclose(found, score(t), abs_tol=1e-8) for found, t in zip(by_text, texts))
    assert (contextparts.split_roots(hi, roots, depth, 7) > roots).any()


def test_strings_are_sorted_and_share_bytes():
    """Also where the lowest or highest bits differ, which a rounded logarithm takes for a byte more or less."""
    r = random.Random(3)
    hi = np.array([r.choice([0, 1, (1 << 64) - 1, (1 << 56) - 1, 1 << 56, r.getrandbits(64)]) for _ in range(3000)], dtype=np.uint64)
    lo = np.array([r.choice([0, 255, (1 << 40) - 1, r.getrandbits(40)]) for _ in range(3000)], dtype=np.uint64)
    order = contextparts.sorting(hi, lo)
    table = sorted(zip(hi.tolist(), lo.tolist()))
    assert list(zip(hi[order].tolist(), lo[order].tolist())) == table
    context = [h.to_bytes(8, "big") + (x >> 8).to_bytes(4, "big") for h, x in table]
    common = [next((i for i in range(12) if a[i] != b[i]), 12) for a, b in zip(context, context[1:])]
    assert contextparts._shared(hi[order], lo[order], 12).tolist() == [-1, *common]


def test_passes_do_not_shuffle_texts(spark):
    """Texts are stored in units once; a pass only sends strings."""
    rows = spark.createDataFrame([(i, i % 5 == 1, "the theme") for i in range(50)], "doc_id long, held_out boolean, text string").repartition(3)
    units = stored(lmscoring.text_units(rows), "units")
    wanted, settings = contextparts.pass_masks([], 1)[0], lmscoring.Settings()
    for sent in (lmscoring.string_counts(units, wanted, [], 5, settings), lmscoring.asked_strings(units, wanted, [], 5, settings)):
        assert "Exchange" not in sent._jdf.queryExecution().executedPlan().toString()
        assert sent.count() > 0
    assert units.select("unit").distinct().count() == units.count()


def test_shuffles_of_a_pass_leave_no_files(spark, tmp_path):
    files = lambda: set(glob.glob(f"{spark.conf.get('spark.local.dir', tempfile.gettempdir())}/blockmgr-*/**/shuffle_*.data", recursive=True))
    rows, key = spark.range(1000).repartition(7), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(key)
    rows.write.parquet(str(tmp_path / "kept"))
    kept = files() - before
    with swept(spark):
        rows.write.parquet(str(tmp_path / "swept"))
    for _ in range(50):
        if not (left := files() - before - kept):
            break
        time.sleep(0.2)
    assert kept and not left and spark.conf.get(key) == setting
    assert spark.read.parquet(str(tmp_path / "swept")).count() == 1000


def test_query_scores_empty_and_missing_texts(spark, tmp_path):
    table = [(0, "the theme of the thesis"), (1, None), (2, ""), (None, None)]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.REGISTRY["op5_context_tree_scores"](spark, str(tmp_path)).collect()
    assert len(found) == 4
    for row in found:
        assert (row.score == 0 and row.n_tokens == 1 and row.bits_per_byte is None) if row.doc_id != 0 else row.bits_per_byte > 0
