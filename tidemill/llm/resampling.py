"""Quality classifier by importance resampling.

Two generative models, bags of hashed word n-grams, are counted: one of the target (documents
labelled good), one of all text. A document's importance weight is the ratio of its
probabilities under them; documents are drawn without replacement in proportion to it, which
adding Gumbel noise to the log weights and taking the largest does.

Documents labelled toxic are not wanted, whatever their quality: a model of the words of labelled
toxic and of other labelled documents tells which texts are left out before the draw.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.columns import codes, lower_ascii, per_row, slices, text_bytes, words
from tidemill.llm.frames import fields
from tidemill.session import stored

HELD_WORDS = 2_000_000  # words of documents a task holds before it passes counts on
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Settings of the fit and the draw."""

    buckets: int = 1 << 18
    labelled: int = 100_000  # labelled documents that are used, the ones with the smallest hashes
    prior: float = 100.0  # n-grams of the raw text's make-up that every bucket of the target is given
    good_weight: float = 5.0  # a good document lost counts as many times one bad document kept
    toxic_prior: float = 3.0  # toxic documents, and as large a share of others, that every word is given
    seed: int = 6


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each row's lower-cased words, and the rows' offsets."""
    data, offsets = text_bytes(column)
    values, bounds = words(lower_ascii(data), offsets)
    if not len(values):
        return np.zeros(0, dtype=np.uint64), bounds
    numbers, distinct = codes(values)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in distinct.to_pylist()], dtype=np.uint64)[numbers], bounds


def features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each row's lower-cased words and word pairs, and the rows' offsets."""
    return bucketed(*word_hashes(column), buckets)


def bucketed(hashed: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(hashed):
        return np.zeros(0, dtype=np.int64), bounds
    # Element k is word k, and element n + k the pair it begins; a pair that crosses rows is left out.
    n = len(hashed)
    pair = (hashed[:-1] * MIX) ^ (hashed[1:] >> np.uint64(7)) * (MIX ^ np.uint64(0xFF51AFD7ED558CCD))
    pair ^= pair >> np.uint64(29)
    found = np.empty(2 * n, dtype=np.int64)
    found[0::2] = (hashed >> np.uint64(11)) % np.uint64(buckets)
    found[1:-1:2] = (pair * MIX >> np.uint64(17)) % np.uint64(buckets)
    keep = np.ones(2 * n, dtype=bool)
    ends = bounds[1:][np.diff(bounds) > 0]
    keep[2 * ends - 1] = False
    sizes = np.diff(bounds)
    sizes = np.where(sizes > 0, 2 * sizes - 1, 0)
    starts = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(sizes, out=starts[1:])
    return found[keep], starts


def labelled_sample(labels: DataFrame, model: Model) -> dict[int, tuple[bool, bool]]:
    """Of at most ``model.labelled`` labelled documents: whether each is good, and whether it
    serves the fit (else the calibration). Good is quality 1 and not toxic."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("good"),
        F.min("quality").alias("quality"),
    )
    # A document of good quality that is toxic is no sample of either kind.
    known = known.filter("good = 1 or quality = 0").withColumn("place", F.xxhash64("doc_id", F.lit(model.seed)))
    chosen = known.orderBy("place", "doc_id").limit(model.labelled).collect()
    return {r["doc_id"]: (r["good"] == 1, r["place"] % 2 == 0) for r in chosen}


def toxic_sample(labels: DataFrame, model: Model) -> dict[int, tuple[bool, bool]]:
    """As ``labelled_sample``: whether each document is toxic, and whether it serves the fit."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.withColumn("place", F.xxhash64("doc_id", F.lit(model.seed))).orderBy("place", "doc_id").limit(model.labelled).collect()
    return {r["doc_id"]: (r["toxic"] == 1, r["place"] % 2 == 0) for r in chosen}


@dataclass(frozen=True)
class Toxic:
    """Words (hashes, sorted) that are likelier in toxic documents, with the log of how much; a text is
    toxic if its worst word is above the cut."""

    words: np.ndarray
    weights: np.ndarray
    cut: float

    def worst(self, hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bounds) - 1)
        if len(hashed) and len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashed), len(self.words) - 1)
            weights = np.where(self.words[at] == hashed, self.weights[at], 0.0)
            filled = np.diff(bounds) > 0
            out[filled] = np.maximum.reduceat(weights, bounds[:-1][filled])
        return out


def toxic_model(documents: DataFrame, labels: DataFrame, model: Model) -> Toxic:
    """Fitted to one half of the labelled documents, with the cut that parts the other half best.

    A word's weight is the log of the share of toxic documents that have it over that of others.
    """
    sample = toxic_sample(labels, model)
    kinds = {(toxic, fits) for toxic, fits in sample.values()}
    if len(kinds) < 4:
        return Toxic(np.zeros(0, dtype=np.uint64), np.zeros(0), math.inf)
    shared = documents.sparkSession.sparkContext.broadcast(sample)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def labelled(batches, half):
        for batch in batches:
            mine = [shared.value.get(d, (None, None))[1] is half for d in batch.column("doc_id").to_pylist()]
            for part in slices([batch.filter(pa.array(mine, pa.bool_()))], "text"):
                toxic = np.array([shared.value[d][0] for d in part.column("doc_id").to_pylist()], dtype=bool)
                yield toxic, *word_hashes(part.column("text"))

    def count(batches):
        held = {True: [], False: []}
        times = np.zeros(2, dtype=np.int64)

        def passed():
            kinds = {kind: np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *own]), return_counts=True) for kind, own in held.items()}
            every = np.union1d(kinds[True][0], kinds[False][0])
            found = []
            for kind in (True, False):
                n = np.zeros(len(every), dtype=np.int64)
                n[np.searchsorted(every, kinds[kind][0])] = kinds[kind][1]
                found.append(pa.array(np.append(n, times[int(not kind)])))
                held[kind] = []
            times[:] = 0
            # 0 stands for the documents themselves.
            return pa.RecordBatch.from_arrays([pa.array(np.append(every, np.uint64(0)).view(np.int64)), *found], names=["word", "bad", "other"])

        for toxic, hashed, bounds in labelled(batches, True):
            for i, kind in enumerate(toxic.tolist()):
                held[kind].append(np.unique(hashed[bounds[i] : bounds[i + 1]]))
                times[int(not kind)] += 1
            if sum(len(own) for kind in held.values() for own in kind) > HELD_WORDS:
                yield passed()
        yield passed()

    counts = texts.mapInArrow(count, "word long, bad long, other long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("other").alias("other"))
    table = counts.filter("bad > 0").toArrow()  # words of labelled toxic documents
    known, bad, other = table.column("word").to_numpy().view(np.uint64), table.column("bad").to_numpy(), table.column("other").to_numpy()
    own = np.flatnonzero(known == 0)
    if not len(own) or not other[own].sum():
        return Toxic(np.zeros(0, dtype=np.uint64), np.zeros(0), math.inf)
    times = other[own].sum() / bad[own].sum()  # other documents per toxic one
    weights = np.log((bad + model.toxic_prior) * times / (other + model.toxic_prior * times))
    kept = np.flatnonzero((known != 0) & (weights > 0))
    kept = kept[np.argsort(known[kept])]
    fitted = Toxic(known[kept], weights[kept], math.inf)
    told = documents.sparkSession.sparkContext.broadcast(fitted)

    def judge(batches):
        for toxic, hashed, bounds in labelled(batches, False):
            yield pa.RecordBatch.from_arrays([pa.array(toxic), pa.array(told.value.worst(hashed, bounds))], names=["toxic", "worst"])

    rows = texts.mapInArrow(judge, "toxic boolean, worst double").collect()
    clean, bad = ([-r["worst"] for r in rows if r["toxic"] == kind] for kind in (False, True))
    return Toxic(fitted.words, fitted.weights, -calibrated(clean, bad, model.good_weight))


def fit(documents: DataFrame, sample: dict[int, tuple[bool, bool]], model: Model) -> np.ndarray:
    """The log ratio of every bucket: its share of the target's n-grams over that of all text.

    The counts over all text cover every document; only bucket sums reach the driver.
    """
    target = documents.sparkSession.sparkContext.broadcast(frozenset(d for d, (good, fits) in sample.items() if good and fits))

    def count(batches):
        every, wanted = np.zeros(model.buckets, dtype=np.int64), np.zeros(model.buckets, dtype=np.int64)
        for batch in slices(batches, "text"):
            found, starts = features(batch.column("text"), model.buckets)
            every += np.bincount(found, minlength=model.buckets)
            is_target = np.array([d in target.value for d in batch.column("doc_id").to_pylist()], dtype=bool)
            wanted += np.bincount(found[np.repeat(is_target, np.diff(starts))], minlength=model.buckets)
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(every[at]), pa.array(wanted[at])], names=["bucket", "every", "wanted"]
        )

    counts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "bucket long, every long, wanted long"
    )
    sums = counts.groupBy("bucket").agg(F.sum("every").alias("every"), F.sum("wanted").alias("wanted")).toArrow()
    every, wanted = np.zeros(model.buckets), np.zeros(model.buckets)
    at = sums.column("bucket").to_numpy()
    every[at], wanted[at] = sums.column("every").to_numpy(), sums.column("wanted").to_numpy()
    share = wanted.sum() / max(every.sum(), 1)
    if share == 0:
        return np.zeros(model.buckets)
    return np.log((wanted + model.prior * share) / (every + model.prior) / share)


def scored(documents: DataFrame, ratio: np.ndarray, toxic: Toxic, model: Model, n_grams: str, log_weight: str, key: str) -> DataFrame:
    """Add the number of n-grams, the log importance weight (the sum of their log ratios), and a key
    that is minus infinity for toxic texts and 0 for others."""
    shared = documents.sparkSession.sparkContext.broadcast((ratio, toxic))
    schema = fields(documents, (n_grams, T.LongType()), (log_weight, T.DoubleType()), (key, T.DoubleType()))

    def score(batches):
        ratio, toxic = shared.value
        for batch in slices(batches, "text"):
            hashed, bounds = word_hashes(batch.column("text"))
            found, starts = bucketed(hashed, bounds, model.buckets)
            keys = np.where(toxic.worst(hashed, bounds) > toxic.cut, -np.inf, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.diff(starts), pa.int64()), pa.array(per_row(ratio[found], starts)), pa.array(keys)],
                names=schema.names,
            )

    return documents.mapInArrow(score, schema)


def calibrated(good: list[float], bad: list[float], good_weight: float) -> float:
    """The weight that parts good from bad best: the most good kept and bad dropped, in shares."""
    if not good or not bad:
        return -math.inf
    cuts = np.unique(np.concatenate([good, bad]))
    kept = 1 - np.searchsorted(np.sort(good), cuts, "left") / len(good)
    dropped = np.searchsorted(np.sort(bad), cuts, "left") / len(bad)
    return float(cuts[np.argmax(good_weight * kept + dropped)])


def largest(keys: DataFrame, name: str, k: int) -> float:
    """The ``k``-th largest value of a stored column, found by counting within ever smaller bounds."""
    low, high = keys.agg(F.min(name), F.max(name)).first()
    if k < 1 or low is None:
        return math.inf
    bins = 1024
    while low < high:
        inside = keys.filter((F.col(name) >= low) & (F.col(name) <= high))
        slot = F.least(F.floor((F.col(name) - low) / (high - low) * bins), F.lit(bins - 1))
        rows = inside.groupBy(slot.alias("slot")).agg(
            F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high")
        ).orderBy(F.desc("slot")).collect()
        for r in rows:
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
        else:
            return low
    return low


def resampled(documents: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with ``n_grams``, ``log_weight``, ``gumbel_key`` and ``kept``; stored.

    Toxic texts are not drawn; their key is minus infinity. As many of the others are drawn as have a weight of at least the calibrated one; the draw is by
    Gumbel top-k, with noise that follows from ``doc_id`` (from the text where that is null).
    Documents whose keys tie with the last one drawn stay too, so repeated rows share one fate.
    A text without words has weight 0. Without usable labels everything is kept. Columns of
    these four names that ``documents`` has are replaced.
    """
    model = model or Model()
    added = ("n_grams", "log_weight", "gumbel_key", "kept")
    documents = documents.drop(*added)
    sample = labelled_sample(labels, model)
    toxic = toxic_model(documents, labels, model)
    table = scored(documents, fit(documents, sample, model), toxic, model, "n_grams", "log_weight", "gumbel_key")
    noise = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")), F.lit(model.seed))
    uniform = (F.shiftrightunsigned(noise, 11) + 0.5) / F.lit(2.0**53)
    drawn = F.when(F.col("gumbel_key") == 0, F.col("log_weight") - F.log(-F.log(uniform))).otherwise(F.col("gumbel_key"))
    table = stored(table.withColumn("gumbel_key", drawn), "weights")

    held_out = {d: good for d, (good, fits) in sample.items() if not fits}
    ids = documents.sparkSession.createDataFrame([(d, g) for d, g in held_out.items()], "sample_id long, good boolean")
    known = table.select(F.col("doc_id").cast("long").alias("sample_id"), "log_weight").join(ids, "sample_id").collect()
    good, bad = ([r["log_weight"] for r in known if r["good"] == kind] for kind in (True, False))
    cut = calibrated(good, bad, model.good_weight)
    wanted = table.filter(F.col("gumbel_key") > -math.inf)
    k = wanted.filter(F.col("log_weight") >= cut).count()
    return table.withColumn("kept", F.col("gumbel_key") >= largest(wanted, "gumbel_key", k))
