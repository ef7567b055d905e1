"""Training-corpus pipeline over ``documents``: toxicity, near duplicates, repeated passages, benchmark leaks, tokens.

Every stage but the last takes and returns the columns of ``documents``. Between
stages the documents are written as Parquet and read again. A null text counts as
empty and its row stays; repeated rows are told apart by nothing, so one of each
stays after the second stage. Extra columns pass through, whatever their names; only
names that begin with two underscores are kept for the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odflux.llm import decontaminate, toxicity
from odflux.llm.bpe_codec import round_trip
from odflux.llm.common import cut_lineage, read_table
from odflux.llm.ngram_join import ngram_components
from odflux.llm.sentence_spans import remove_repeated_spans

#: Near duplicates: shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
TOXIC_FROM = 0.5
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _packed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Text and id beside one struct of all other columns, so that no added column can clash with them."""
    others = [c for c in docs.columns if c != "text"]
    return docs.select(F.struct(*[docs[c] for c in others]).alias("__others"), docs["doc_id"],
                       docs["text"].cast("string").alias("text")), docs.columns


def _unpacked(docs: DataFrame, columns: list[str], **replaced) -> DataFrame:
    return docs.select(*[replaced[c].alias(c) if c in replaced else F.col("text") if c == "text" else F.col("__others")[c].alias(c)
                         for c in columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the labelled rows of the folder's own documents."""
    model = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    packed, columns = _packed(docs)
    return _unpacked(model.score(packed, column="__score").where(F.col("__score") < TOXIC_FROM), columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect: the smallest id, null first, then the smallest hash of id and text."""
    packed, columns = _packed(docs)
    packed = packed.withColumn("__row", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    groups = ngram_components(packed.select(F.struct("doc_id", "__row").alias("doc_id"), "text"),
                              width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    first = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.__row").alias("__row")).distinct()
    copies = Window.partitionBy("__row").orderBy("__row")
    kept = packed.join(first, "__row", "left_semi").withColumn("__copy", F.row_number().over(copies)).where("__copy = 1")
    return _unpacked(kept, columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without sentences that a passage elsewhere, or earlier in it, holds first; ``n_chars`` follows the text."""
    packed, columns = _packed(docs)
    cut = remove_repeated_spans(packed)
    return _unpacked(cut, columns, n_chars=F.length(F.coalesce("text", F.lit(""))).cast(dict(docs.dtypes).get("n_chars", "long")))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, nor one with up to a fifth of its words edited."""
    packed, columns = _packed(docs)
    return _unpacked(decontaminate.without_leaks(packed, read_table(spark, sf_dir, "benchmark")), columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the text that they decode to."""
    coded = round_trip(docs.select("doc_id", F.col("text").cast("string").alias("text")), TOKENIZER)
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("bpe_encoding", encode_tokens),
]

#: Link components, learned scores and token merges have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
