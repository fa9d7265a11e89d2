"""Languages of whole texts by piece unigrams, marginalised over all segmentations.

Every language has probabilities of the pieces of one fixed public vocabulary. A word may be cut
into pieces in many ways; its probability is the sum over all of them of the product of the
pieces' probabilities, which a forward pass over its bytes adds up. Probabilities are fitted by
expectation maximisation: a forward and a backward pass give the expected number of each piece.

A word is a run of letters or bytes beyond ASCII of the lower-cased text, after one space. Words of
over ``WORD_BYTES`` bytes go on as further words without the space, so no pass is long and no
product leaves the range of a double; no byte is left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.columns import binary_array, codes, slices, text_bytes
from tidemill.llm.frames import fields
from tidemill.session import stored

SLICE_BYTES = 8 << 20  # texts whose distinct words are scored at once
WORD_BYTES = 32
WORDS = 1 << 14  # distinct words in one forward pass
INSIDE = np.zeros(256, dtype=bool)
INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SPACE, UNKNOWN = 0x20, "und"


@dataclass(frozen=True)
class Settings:
    """``fit_bytes``: training text per language that fits the probabilities, drawn by a hash of whole
    documents (their expected size); ``rounds`` of expectation maximisation; ``pooled``: pieces of the
    distribution over all languages added to each language's own counts; ``spread``: share of
    probability that all single bytes have in equal parts, so that no word is impossible; ``at_once``:
    languages a task holds the probabilities of in one pass over the texts; there are as many passes as it takes.
    """

    fit_bytes: int = 3 << 20
    rounds: int = 3
    pooled: float = 1000.0
    spread: float = 1e-3
    at_once: int = 32


def pieces_of(path: str) -> list[bytes]:
    """The pieces of a public vocabulary file of ranks that words can be cut into."""
    with open(path, "rb") as lines:
        found = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    inside = {i for i in range(256) if INSIDE[i] and not 0x41 <= i < 0x5B}
    usable = {p for p in found if p and set(p[1:]) <= inside and (p[0] == SPACE or p[0] in inside) and len(p) <= WORD_BYTES + 1}
    return sorted(usable | {bytes([i]) for i in inside | {SPACE}})


@dataclass(frozen=True)
class Trie:
    """``step[node, class of byte]`` is the next node, 0 where no piece goes on; ``piece[node]`` is the
    piece that ends there, or the number of pieces where none does.
    """

    step: np.ndarray
    piece: np.ndarray
    classes: np.ndarray


@lru_cache(maxsize=2)
def trie(pieces: tuple[bytes, ...]) -> Trie:
    used = sorted(set(b"".join(pieces)))
    classes = np.zeros(256, dtype=np.int64)
    classes[used] = np.arange(len(used))
    nodes, piece = {b"": 1}, [len(pieces), len(pieces)]
    edges = []
    for number, p in enumerate(pieces):
        for i in range(len(p)):
            if p[: i + 1] not in nodes:
                nodes[p[: i + 1]] = len(piece)
                edges.append((nodes[p[:i]], classes[p[i]], len(piece)))
                piece.append(len(pieces))
        piece[nodes[p]] = number
    step = np.zeros((len(piece), len(used)), dtype=np.int32)
    for a, c, b in edges:
        step[a, c] = b
    return Trie(step, np.array(piece), classes)


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-cased rows, each after its space, and the offsets of each row's words."""
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(offsets), dtype=np.int64)
    inside = INSIDE[data]
    before = np.ones(len(data), dtype=bool)
    before[1:] = ~inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    first = np.flatnonzero(inside & before)
    place = np.flatnonzero(inside)
    if not len(place):
        return pa.array([], pa.large_binary()), np.zeros(len(offsets), dtype=np.int64)
    starts = np.searchsorted(place, first)
    within = np.arange(len(place)) - np.repeat(starts, np.diff(np.append(starts, len(place))))
    cut = np.flatnonzero(within % WORD_BYTES == 0)
    # A space goes before every byte at which a word begins; later stretches of a long word have none.
    opens = within[cut] == 0
    ahead = np.zeros(len(place), dtype=np.int64)
    ahead[cut[opens]] = 1
    shift = np.cumsum(ahead)
    out = np.full(len(place) + int(shift[-1]), SPACE, dtype=np.uint8)
    out[np.arange(len(place)) + shift] = data[place]
    bounds = np.append(cut + shift[cut] - ahead[cut], len(out))
    return binary_array(out, bounds), np.searchsorted(place[cut], offsets)


def _matrices(words: pa.Array):
    """Words of one length as the rows of byte arrays, with their numbers."""
    data, offsets = text_bytes(words)
    sizes = np.diff(offsets)
    by_size = np.argsort(sizes, kind="stable")
    edges = np.searchsorted(sizes[by_size], np.arange(1, WORD_BYTES + 3))
    for size, (a, b) in enumerate(zip(edges, edges[1:]), 1):
        for at in range(a, b, WORDS):
            numbers = by_size[at : min(at + WORDS, b)]
            yield numbers, data[offsets[numbers][:, None] + np.arange(size)[None, :]]


def _walks(t: Trie, rows: np.ndarray):
    """For every start and end, the words (None: all) whose bytes between them begin a piece, and the pieces they are."""
    kinds, size = t.classes[rows], rows.shape[1]
    for start in range(size):
        own, node = None, np.ones(len(rows), dtype=np.int32)
        for end in range(start, size):
            node = t.step[node, kinds[:, end] if own is None else kinds[own, end]]
            alive = np.flatnonzero(node)
            if len(alive) < len(node):
                own, node = (alive if own is None else own[alive]), node[alive]
            if not len(node):
                break
            yield start, end + 1, own, t.piece[node]


def log_sums(t: Trie, words: pa.Array, probability: np.ndarray) -> np.ndarray:
    """The log of every word's probability in each language; ``probability`` has a last row of zeros."""
    out = np.zeros((len(words), probability.shape[1]))
    for numbers, rows in _matrices(words):
        out[numbers] = np.log(_forward(t, rows, probability)[rows.shape[1]])
    return out


def _forward(t: Trie, rows: np.ndarray, probability: np.ndarray, kept: list | None = None) -> np.ndarray:
    """By place: the probability of the bytes before it, summed over all ways to cut them."""
    sums = np.zeros((rows.shape[1] + 1, len(rows), probability.shape[1]))
    sums[0] = 1
    for start, end, own, piece in _walks(t, rows):
        if own is None:
            sums[end] += sums[start] * probability[piece]
        else:
            sums[end, own] += sums[start, own] * probability[piece]
        if kept is not None:
            kept.append((start, end, own, piece))
    return sums


def expected(t: Trie, words: pa.Array, times: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Expected number of each piece in words that occur so often, under one language's probabilities."""
    total = np.zeros(len(probability))
    for numbers, rows in _matrices(words):
        walks = []
        ahead = _forward(t, rows, probability[:, None], walks)[:, :, 0]
        size = rows.shape[1]
        behind = np.zeros((size + 1, len(rows)))
        behind[size] = times[numbers] / ahead[size]
        for start, end, own, piece in reversed(walks):
            at = slice(None) if own is None else own
            here = probability[piece] * behind[end, at]
            behind[start, at] += here
            total += np.bincount(piece, ahead[start, at] * here, minlength=len(total))
    return total


def _batches(batches: Iterable[pa.RecordBatch]):
    """Rows with their lower-cased text as bytes; a null text is empty."""
    for batch in slices(batches, "text", SLICE_BYTES):
        lower = pc.utf8_lower(pc.fill_null(batch.column("text"), ""))
        yield batch, *split(*text_bytes(lower))


def trains(doc_id: Column) -> Column:
    """Four fifths of the documents, by the CRC-32 of the id as text; rows without an id are held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def _drawn(training: DataFrame, settings: Settings) -> DataFrame:
    """Whole documents of each language, drawn by a hash of id and text to about ``fit_bytes``.

    The sizes, a row per language, are stored first: Spark knows how small they are and moves no text.
    """
    sizes = training.groupBy(F.col("lang").alias("_lang")).agg(F.sum(F.octet_length("text")).alias("_size"))
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    joined = training.join(stored(sizes, "language_sizes"), F.col("lang") == F.col("_lang"))
    return joined.filter(number * F.col("_size") < settings.fit_bytes).select("lang", "text")


def counted_words(drawn: DataFrame) -> DataFrame:
    """``lang, word, n`` over the drawn documents, added up per task before the shuffle."""

    def count(batches):
        for batch, words, bounds in _batches(batches):
            langs, names = codes(batch.column("lang"))
            of_word = np.repeat(langs, np.diff(bounds))
            numbers, distinct = codes(words)
            pairs, n = np.unique(of_word * max(len(distinct), 1) + numbers, return_counts=True)
            lang, word = np.divmod(pairs, max(len(distinct), 1))
            yield pa.RecordBatch.from_arrays(
                [names.cast(pa.string()).take(pa.array(lang)), distinct.cast(pa.binary()).take(pa.array(word)), pa.array(n)], names=["lang", "word", "n"]
            )

    found = drawn.mapInArrow(count, "lang string, word binary, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Fitted:
    """Piece counts of every learned language as a stored table ``lang, piece, n``."""

    def __init__(self, counts: DataFrame | None, langs: list[str], pieces: tuple[bytes, ...], settings: Settings):
        self.counts, self.langs, self.pieces, self.settings = counts, langs, pieces, settings
        pooled = np.zeros(len(pieces))
        if counts is not None:
            for r in counts.groupBy("piece").agg(F.sum("n").alias("n")).toLocalIterator():
                pooled[r.piece] = r.n
        self.pooled = (pooled + 1e-3) / (pooled + 1e-3).sum()

    def probabilities(self, langs: Sequence[str]) -> np.ndarray:
        """Pieces by language, and a last row of zeros for no piece."""
        n = np.zeros((len(self.pieces), len(langs)))
        if self.counts is not None:
            place = {lang: i for i, lang in enumerate(langs)}
            table = self.counts.filter(F.col("lang").isin(list(langs))).toArrow()
            at = np.array([place[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
            n[table.column("piece").to_numpy(), at] = table.column("n").to_numpy()
        n += self.settings.pooled * self.pooled[:, None]
        n /= n.sum(axis=0)
        single = np.array([len(p) == 1 for p in self.pieces])
        n = (1 - self.settings.spread) * n + self.settings.spread / single.sum() * single[:, None]
        return np.vstack([n, np.zeros((1, len(langs)))])


def fitted(documents: DataFrame, vocabulary: str, settings: Settings | None = None) -> Fitted:
    """Piece counts per language from ``doc_id, lang, text`` rows; rows without a language or text are left out.

    A language is learned if the documents drawn of it have a word.
    """
    settings = settings or Settings()
    pieces = tuple(pieces_of(vocabulary))
    training = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    training = training.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    words = stored(counted_words(_drawn(training, settings)), "language_words")
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())  # a name per language
    model = Fitted(None, langs, pieces, settings)
    told = words.sparkSession.sparkContext.broadcast(pieces)
    for _ in range(settings.rounds):
        model = Fitted(stored(_expectation(words, told, model), "piece_counts"), langs, pieces, settings)
    return model


def _expectation(words: DataFrame, told, model: Fitted) -> DataFrame:
    """One round of expectation maximisation over the words of all languages, some languages at a time."""
    counts, step = None, model.settings.at_once
    for a in range(0, max(len(model.langs), 1), step):
        langs = model.langs[a : a + step]
        table = words.sparkSession.sparkContext.broadcast(model.probabilities(langs))

        def expect(batches, langs=tuple(langs), table=table):
            t, probability = trie(told.value), table.value
            sums = {}
            for batch in batches:
                names, words, n = (batch.column(c) for c in ("lang", "word", "n"))
                for lang in pc.unique(names).to_pylist():
                    own = pc.equal(names, lang)
                    found = expected(t, words.filter(own), n.filter(own).to_numpy(), probability[:, langs.index(lang)])
                    sums[lang] = sums.get(lang, 0) + found
            for lang, total in sums.items():
                at = np.flatnonzero(total[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], names=["lang", "piece", "n"]
                )

        part = words.filter(F.col("lang").isin(langs)) if langs else words
        found = part.mapInArrow(expect, "lang string, piece long, n double")
        counts = found if counts is None else counts.unionByName(found)
    return counts.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def predicted(documents: DataFrame, model: Fitted, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score``, the probability of that language among the learned ones.

    Languages are equally likely beforehand; of equally likely ones the smaller name wins. A text
    that is null or has no letter, and every text where no language was learned, is ``und`` with
    score 0. Rows are answered each, repeated ones too; no column but ``text`` counts.
    """
    spark, step = documents.sparkSession, model.settings.at_once
    own = [f"_own_{i}" for i in range(len(keep))]
    rows = documents.select(
        *[F.col(c).alias(n) for c, n in zip(keep, own)], F.lit(None).cast("string").alias("best"),
        F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("mass"), "text",
    )
    pieces = spark.sparkContext.broadcast(model.pieces)
    for a in range(0, len(model.langs), step):
        langs, more = model.langs[a : a + step], a + step < len(model.langs)
        names = [*own, "best", "top", "mass", *(["text"] if more else [])]
        table = spark.sparkContext.broadcast(model.probabilities(langs))
        rows = rows.mapInArrow(_scorer(pieces, table, langs, own, names), rows.select(*names).schema)
        rows = stored(rows, "language_scores") if more else rows
    return rows.select(
        *[F.col(n).alias(c) for c, n in zip(keep, own)], F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("best").isNotNull(), 1 / F.col("mass")).otherwise(F.lit(0.0)).alias("score"),
    )


def _scorer(pieces, table, langs: list[str], own: list[str], names: list[str]):
    """Go on with the best language so far, its log probability, and the sum of all relative to it."""

    def score(batches):
        t, probability, known = trie(pieces.value), table.value, np.array(langs, dtype=object)
        for batch, words, bounds in _batches(batches):
            numbers, distinct = codes(words)
            logs = log_sums(t, distinct, probability)
            total = np.zeros((batch.num_rows, len(langs)))
            filled = np.flatnonzero(np.diff(bounds))
            if len(filled):
                total[filled] = np.add.reduceat(logs[numbers], bounds[:-1][filled], axis=0)
            best = total.argmax(axis=1)
            now = total[np.arange(len(total)), best]
            mass = np.exp(total - now[:, None]).sum(axis=1)
            before = batch.column("top").fill_null(-np.inf).to_numpy(zero_copy_only=False)
            mass_before = batch.column("mass").fill_null(0.0).to_numpy(zero_copy_only=False)
            top = np.maximum(before, now)
            mass = mass * np.exp(now - top) + mass_before * np.exp(before - top)
            name = np.where(before >= now, np.array(batch.column("best").to_pylist(), dtype=object), known[best])
            name[~lettered(batch.column("text"))] = None
            found = {"best": pa.array(name.tolist(), pa.string()), "top": pa.array(top), "mass": pa.array(mass)}
            found |= {c: batch.column(c) for c in (*own, "text")}
            yield pa.RecordBatch.from_arrays([found[c] for c in names], names=names)

    return score


def lettered(texts: pa.Array) -> np.ndarray:
    """Which texts have a letter of any script; a null one has none."""
    found = pc.fill_null(pc.match_substring_regex(texts, "[a-zA-Z]"), False).to_numpy(zero_copy_only=False).copy()
    for i in np.flatnonzero(~found).tolist():
        found[i] = any(map(str.isalpha, texts[i].as_py() or ""))
    return found
