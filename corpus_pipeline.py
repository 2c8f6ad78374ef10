"""The corpus pipeline: language ID, n-gram Jaccard join, suffix-array dedup, benchmark decontamination, sentence pieces.

Each stage takes what its predecessor kept and, but for the last, returns the columns of documents. A stage's result is
written before the next stage is called, so a stage deletes the scratch tables of the stage before it, and no others.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.llm import decontamination, language_id, ngram_join, sentence_pieces, suffix_dedup
from coverloom.llm.util import collecting, delete, materialize, table

#: A document is rejected if it has no letter, or if its words have no label of half their probability in the mean, each word by its own best label.
MIN_SCORE = 0.5


#: Scratch tables of the stage that was called last.
_last: list[str] = []


def _stage(f):
    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete(spark, _last)
        with collecting() as made:
            out = f(spark, docs, sf_dir)
        _last[:] = made
        return out

    return run


def _masked(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with all columns but doc_id and text under names that no operator uses, and these names."""
    names = [c if c in ("doc_id", "text") else f"_x{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [n for n in names if n.startswith("_x")]


def _restored(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(c if c in ("doc_id", "text") else f"_x{i}").alias(c) for i, c in enumerate(docs.columns)])


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; lang becomes the predicted one. A document is rejected if its text is null or has no letter, or if its confidence is under MIN_SCORE: a text that several learned languages share stays."""
    if "lang" not in docs.columns:
        raise ValueError("documents need the column lang")
    model = language_id.train(docs)
    plain, rest = _masked(docs)
    found = language_id.identify(plain, model, keep=["text", *rest], spans=False).where((F.col("lang_pred") != "und") & (F.col("confidence") >= MIN_SCORE))
    return _restored(found.withColumn(f"_x{docs.columns.index('lang')}", F.col("lang_pred")), docs)


@_stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the least id. Rows that share this id all stay."""
    plain, _ = _masked(docs)
    firsts = ngram_join.join(plain).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    return _restored(plain.join(firsts, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"), docs)


@_stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the characters that a 100-byte string covers wholly that starts earlier. A document whose text goes altogether goes."""
    plain, rest = _masked(docs)
    cut = suffix_dedup.dedup(plain, whole_characters=True, keep=rest)
    cut = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))).withColumn("text", F.decode("kept", "utf-8"))
    out = _restored(cut, docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


@_stage
def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; contaminated ones go."""
    plain, rest = _masked(docs)
    judged = decontamination.decontaminate(plain, table(spark, sf_dir, "benchmark"), keep=("text", *rest))
    return _restored(judged.where(~F.col("contaminated")), docs)


@_stage
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and lossless."""
    return sentence_pieces.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", cut_benchmark),
    ("sentence pieces", encode_pieces),
]

#: Trained models and sampled segmentations are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What one stage leaves is written in the shared folder before the next one starts."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
