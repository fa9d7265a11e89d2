"""The operators bound to whole tables, with production parameters."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import planeclusters, urllists, walshcodes
from tidemill.llm.frames import importable
from tidemill.plans.registry import Query, Tables

REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register an operator's query; ``sql`` is the same question asked in plain SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def shipped(t: Tables) -> DataFrame:
            importable(t.spark)
            return build(t)

        REGISTRY[name] = Query(name, shipped, sql)
        return build

    return register


def tokenizer(file: str) -> str:
    """The place of an installed public tokenizer file."""
    return import_module("public_tokenizers").path(file)


@query("op1_best_fit_packing")
def op1(t: Tables) -> DataFrame:
    from tidemill.llm.packing import packed_documents

    packed = packed_documents(t.documents, tokenizer("word_bpe_49k.json"), end_id=1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_benchmark_decontamination")
def op2(t: Tables) -> DataFrame:
    from tidemill.llm.decontamination import contaminated

    return contaminated(t.documents, t.benchmark)


@query("op3_distribution_divergence")
def op3(t: Tables) -> DataFrame:
    from tidemill.llm.divergence import judged

    return judged(t.documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


@query("op4_suffix_dedup")
def op4(t: Tables) -> DataFrame:
    from tidemill.llm.suffixes import without_repeats

    found = without_repeats(t.documents.select("doc_id", "text"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_context_tree_scores")
def op5(t: Tables) -> DataFrame:
    from tidemill.llm.lmscoring import scored

    found = scored(t.documents).withColumn("bits_per_byte", F.try_divide(-F.col("score") * math.log2(10), F.col("n_bytes")))
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"
    )


@query("op6_importance_resampling")
def op6(t: Tables) -> DataFrame:
    from tidemill.llm.resampling import resampled

    found = resampled(t.documents.select("doc_id", "text"), t.labels)
    return found.select("doc_id", "n_grams", "log_weight", "gumbel_key", "kept")


@query("op7_warc_normaliser")
def op7(t: Tables) -> DataFrame:
    from tidemill.llm.warc import archived

    return archived(t.pages, t.scratch("warc"))


@query("op8_simhash_near_dedup")
def op8(t: Tables) -> DataFrame:
    from tidemill.llm.simhash import near_duplicates

    found = near_duplicates(t.documents, shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_token_records")
def op9(t: Tables) -> DataFrame:
    from tidemill.llm.records import read_records, with_starts, write_records

    folder = t.scratch("records")
    index = write_records(t.documents, tokenizer("byte_bpe_50k.json"), end_id=2, folder=folder)
    return with_starts(read_records(index, folder)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op10_temporal_url_lists", urllists.SQL)
def op10(t: Tables) -> DataFrame:
    captures = urllists.captures_of(t.pages)
    return urllists.judged(captures, urllists.entries_of(t.pages)).drop("url")


@query("op11_walsh_vector_codes", walshcodes.SQL)
def op11(t: Tables) -> DataFrame:
    found = walshcodes.coded(t.embeddings)
    totals = found.rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    rows = found.rows.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left")
    code = F.array_join(F.transform("code", lambda n: F.lower(F.lpad(F.hex(n), 2, "0"))), "")
    digest = hashlib.sha256(walshcodes.decimals(found.codebooks).encode()).hexdigest()
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


@query("op12_bit_plane_clusters", planeclusters.SQL)
def op12(t: Tables) -> DataFrame:
    found = planeclusters.clustered(t.embeddings)
    digests = [hashlib.sha256(walshcodes.decimals(c).encode()).hexdigest() for c in found.centroids]
    inertia = [found.inertia.get(i, 0) for i in range(len(digests))]
    of_cluster = lambda values, kind: F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster"))
    return found.rows.select(
        "vec_id", "cluster", "distance", of_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"),
    )


@query("op13_segmentation_languages")
def op13(t: Tables) -> DataFrame:
    from tidemill.llm.languages import fitted, predicted, trains

    model = fitted(t.documents.filter(trains(F.col("doc_id"))), tokenizer("byte_bpe_multi_50k.tiktoken"))
    found = predicted(t.documents, model)
    return found.select("doc_id", (~trains(F.col("doc_id"))).alias("held_out"), "lang_pred", F.round("score", 9).alias("score"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    return {name: q.sql.strip() for name, q in REGISTRY.items() if q.sql}
