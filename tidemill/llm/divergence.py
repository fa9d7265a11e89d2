"""Quality rules by distribution divergence.

Each language has two reference histograms, counted over all its documents: classes of
characters, and its most common words with one bin for all others. A document is compared with
the references of its language by Jensen-Shannon distance (base 2: 0 equal, 1 disjoint). Texts
below a minimum length are not judged by a histogram, since a few words say little about one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.columns import codes, per_row, rows_of, slices, text_bytes, words
from tidemill.session import stored

CLASSES = ["lower", "upper", "digit", "space", "sign", "symbol", "wide", "control"]
CLASS = np.full(256, CLASSES.index("control"), dtype=np.uint8)
CLASS[0x21:0x7F] = CLASSES.index("sign")
CLASS[0x61:0x7B] = CLASSES.index("lower")
CLASS[0x41:0x5B] = CLASSES.index("upper")
CLASS[0x30:0x3A] = CLASSES.index("digit")
CLASS[[0x20, *range(0x09, 0x0E)]] = CLASSES.index("space")
CLASS[list(b"#*$%&|<>")] = CLASSES.index("symbol")
CLASS[0xC0:] = CLASSES.index("wide")
CLASS[0x80:0xC0] = len(CLASSES)  # a later byte of a character beyond ASCII counts for nothing
WINDOW = 8
FLUSH = 300_000  # distinct words a task holds before it passes counts on

COUNTS = "lang string, kind string, item binary, n long"
MEASURES = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "char_distance double, word_distance double"
)


@dataclass(frozen=True)
class Limits:
    """Largest distances of documents that stay, and the lengths from which they are judged.

    A short text's word histogram is far from any reference by chance, about as one over the
    root of its words, so its limit is ``word_distance + word_slack / sqrt(words)``.
    """

    common_words: int = 40
    char_distance: float = 0.30
    word_distance: float = 0.27
    word_slack: float = 0.85
    min_chars: int = 100
    min_words: int = 40
    languages: int = 512  # whose references tasks hold at once; with more, further passes follow


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Characters of each class in each row."""
    kinds = CLASS[data]
    found = np.zeros((len(offsets) - 1, len(CLASSES) + 1), dtype=np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        found[i] = np.bincount(kinds[a:b], minlength=len(CLASSES) + 1)
    return found[:, : len(CLASSES)]


def repeated_words(numbers: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Words of each row that lie in a window of ``size`` words found twice or more in the row.

    Windows get numbers by doubling: that of 2n words is the pair of those of n.
    """
    n = len(numbers)
    if n < size:
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    rows = rows_of(offsets)
    names, width = numbers, 1
    while width < size:
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        if 2 * width == size:
            inside = rows[: len(pairs)] == rows[size - 1 : size - 1 + len(pairs)]
            at = np.flatnonzero(inside)
            _, number = np.unique(pairs[at], return_inverse=True)
            pairs = number * (int(rows[-1]) + 1) + rows[at]
            _, number, times = np.unique(pairs, return_inverse=True, return_counts=True)
            at = at[times[number] > 1]
            break
        _, names = np.unique(pairs, return_inverse=True)
        width *= 2
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return per_row((np.cumsum(change[:-1]) > 0).astype(np.int64), offsets)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def distances(found: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row's histogram to its reference; null for an empty one."""
    total = found.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = found / total
        q = reference / reference.sum(axis=1, keepdims=True)
        m = (p + q) / 2
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
        return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), np.nan)


def corpus_counts(documents: DataFrame) -> DataFrame:
    """``lang, kind, item, n``: characters by class and words, over all documents."""

    def count(batches):
        held: Counter = Counter()
        classes: dict[str | None, np.ndarray] = {}

        def passed():
            rows = [(lang, "word", word, n) for (lang, word), n in held.items()]
            rows += [(lang, "class", str(k).encode(), int(n)) for lang, c in classes.items() for k, n in enumerate(c)]
            held.clear()
            classes.clear()
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "kind", "item", "n"])

        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            lang, names = codes(batch.column("lang").fill_null(""))
            names = names.to_pylist()
            by_row = class_counts(data, offsets)
            for k, name in enumerate(names):
                classes[name] = classes.get(name, 0) + by_row[lang == k].sum(axis=0)
            values, bounds = words(data, offsets)
            if not len(values):
                continue
            numbers, distinct = codes(values)
            pair = np.repeat(lang, np.diff(bounds)) * len(distinct) + numbers
            pairs, times = np.unique(pair, return_counts=True)
            distinct = distinct.to_pylist()
            for p, n in zip(pairs.tolist(), times.tolist()):
                held[names[p // len(distinct)], distinct[p % len(distinct)]] += n
            if len(held) > FLUSH:
                yield passed()
        yield passed()

    return documents.select("lang", "text").mapInArrow(count, COUNTS)


def references(documents: DataFrame, limits: Limits) -> DataFrame:
    """One row per language: class counts, number of words, common words."""
    counts = corpus_counts(documents).groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    counts = stored(counts, "counts")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
    common = counts.filter("kind = 'word'").withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= limits.common_words
    ).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "item", "n"))).alias("common"))
    classes = counts.filter("kind = 'class'").groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("item", "n"))).alias("classes")
    )
    totals = counts.filter("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("words"))
    return classes.join(common, "lang", "left").join(totals, "lang", "left")


def measures(documents: DataFrame, limits: Limits) -> DataFrame:
    """Each document's base measures and its distances to the references of its language.

    Languages are dealt to passes of about ``limits.languages``; each pass reads the documents of its own.
    """
    known = stored(references(documents, limits), "references")
    passes = -(-known.count() // limits.languages) or 1
    number = F.pmod(F.xxhash64(F.coalesce("lang", F.lit(""))), F.lit(passes))
    return reduce(DataFrame.unionByName, [
        compared(documents.filter(number == i), known.filter(number == i)) for i in range(passes)
    ])


def compared(documents: DataFrame, known: DataFrame) -> DataFrame:
    """The measures of documents whose languages all have a row in ``known``, which tasks hold."""
    found = {}
    for r in known.collect():
        common = r["common"] or []
        counted = [w["n"] for w in common]
        found[r["lang"]] = (
            np.array([c["n"] for c in r["classes"]], dtype=np.float64),
            np.array([*counted, (r["words"] or 0) - sum(counted)], dtype=np.float64),
            [bytes(w["item"]) for w in common],
        )
    shared = documents.sparkSession.sparkContext.broadcast(found)

    def measure(batches):
        known = shared.value
        for batch in slices(batches, "text"):
            column = batch.column("text").fill_null("")
            data, offsets = text_bytes(column)
            of = [known[lang] for lang in batch.column("lang").fill_null("").to_pylist()]
            classes = class_counts(data, offsets)
            values, bounds = words(data, offsets)
            numbers, distinct = codes(values)
            place_of = {w: i for i, w in enumerate(distinct.to_pylist())}
            char_distance = distances(classes, np.array([o[0] for o in of]))
            word_distance = np.full(len(of), np.nan)
            rows = rows_of(bounds)
            for own in {id(o): o for o in of}.values():
                mine = np.array([o is own for o in of])
                k = len(own[2])
                bins = np.full(len(distinct) + 1, k, dtype=np.int64)
                for i, w in enumerate(own[2]):
                    if w in place_of:
                        bins[place_of[w]] = i
                picked = mine[rows] if len(rows) else np.zeros(0, dtype=bool)
                table = np.bincount(rows[picked] * (k + 1) + bins[numbers[picked]], minlength=len(of) * (k + 1))
                result = distances(table.reshape(-1, k + 1).astype(np.float64), np.tile(own[1], (len(of), 1)))
                word_distance[mine] = result[mine]
            n_words = np.diff(bounds)
            space, symbol = CLASSES.index("space"), CLASSES.index("symbol")
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("lang"), pa.array(n_words, pa.int64()),
                pa.array(classes.sum(axis=1) - classes[:, space], pa.int64()), pa.array(classes[:, symbol], pa.int64()),
                pa.array([duplicate_lines(t) for t in column.to_pylist()], pa.int64()),
                pa.array(repeated_words(numbers, bounds), pa.int64()),
                pa.array(char_distance, from_pandas=True), pa.array(word_distance, from_pandas=True),
            ], names=[f.split()[0] for f in MEASURES.split(", ")])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(measure, MEASURES)


def judged(documents: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to the measures.

    A document fails the base rules with under 20 words, or with over 30 % of its words in
    repeated windows. Of the rest, those stay whose distances are within the limits or that are
    too short to be judged. Null and empty texts have no words and fail; documents without a language
    (null or empty) count as one of their own. Repeated rows are judged alike.
    """
    limits = limits or Limits()
    found = measures(documents, limits)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    chars_far = (F.col("word_chars") >= limits.min_chars) & (F.coalesce("char_distance", F.lit(0.0)) > limits.char_distance)
    most = limits.word_distance + limits.word_slack / F.sqrt("n_words")
    words_far = (F.col("n_words") >= limits.min_words) & (F.coalesce("word_distance", F.lit(0.0)) > most)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~chars_far & ~words_far)
