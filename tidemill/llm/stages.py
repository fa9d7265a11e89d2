"""The stages of the training-text pipeline.

Each takes the documents its predecessor kept and returns those it keeps, with the columns of
``documents``; the last one returns packed token pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.decontamination import decontaminated
from tidemill.llm.frames import importable
from tidemill.llm.packing import packed_documents
from tidemill.llm.queries import tokenizer
from tidemill.llm.resampling import resampled
from tidemill.llm.simhash import near_duplicates, text_tag
from tidemill.llm.suffixes import without_repeats
from tidemill.session import tune


def _shielded(docs: DataFrame, *added: str) -> DataFrame:
    """The documents with columns renamed that have the names an operator adds."""
    return docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if c.lower() in added})


def _own(found: DataFrame, shielded: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents under their own names again."""
    return found.select(*[F.col(a).alias(b) for a, b in zip(shielded.columns, docs.columns)])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling against the labelled good ones."""
    shielded = _shielded(docs, "n_grams", "log_weight", "gumbel_key", "kept")
    found = resampled(shielded, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _own(found.filter("kept"), shielded, docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id.

    Of rows that repeat this id the one with the smallest text hash stays, of repeated rows one.
    A row without an id stays only in a group without any id.
    """
    groups = near_duplicates(docs, shingle=3, radius=2)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "tag")
    keepers = groups.groupBy("root").agg(F.min(place).alias("kept"))
    keepers = keepers.select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.tag").alias("_kept_tag"))
    shielded = _shielded(docs, "_kept_id", "_kept_tag")
    same = F.col("_kept_id").eqNullSafe(shielded.doc_id.cast("long")) & (F.col("_kept_tag") == text_tag(shielded))
    return _own(shielded.join(keepers, same).dropDuplicates(["_kept_id", "_kept_tag"]), shielded, docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that a document with a smaller id has too.

    A character that loses one of its bytes goes as a whole. Every document stays, also one of
    which nothing is left; ``n_chars`` follows the text.
    """
    shielded = _shielded(docs, "kept", "n_bytes", "n_removed", "n_spans")
    kept, names = without_repeats(shielded, length=50), shielded.columns

    def decode(batches):
        place = names.index("text")
        for batch in batches:
            texts = [None if t is None else k.decode("utf-8", "ignore") for t, k in zip(
                batch.column("text").to_pylist(), batch.column("kept").to_pylist()
            )]
            columns = batch.columns[: len(names)]
            columns[place] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in names:
                count = names.index("n_chars")
                columns[count] = pc.utf8_length(columns[place]).cast(columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _own(kept.select(*names, "kept").mapInArrow(decode, shielded.schema), shielded, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a near copy of a benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenized and packed into sequences: one row per piece."""
    return packed_documents(docs, tokenizer("word_bpe_49k.json"), end_id=1)


def _stage(job: Callable[[SparkSession, DataFrame, str], DataFrame]):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        tune(spark)
        return job(spark, docs, sf_dir)

    return run


STAGES = [
    (job.__name__, _stage(job))
    for job in (quality_classifier, simhash_near_dedup, suffix_array_dedup, benchmark_decontamination, best_fit_packing)
]
