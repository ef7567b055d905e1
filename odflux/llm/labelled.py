"""The bounded sample of labelled rows that the classifiers learn from."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import crc_bucket, cut_lineage, ship_package, slices
from odflux.llm.word_arrays import set_id, shingle_sets

#: Labelled rows that a classifier is fitted on, about; the only bound on what is learned from.
TRAINING_ROWS = 20_000


def training_rows(docs: DataFrame, labels: DataFrame, label: str, buckets: int, held: int, bound: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of labelled rows outside the held-out bucket.

    The sample is chosen by a hash of the id, so it is the same at every run. One
    row stays of each group of texts with the same set of 5-word shingles: copies are
    no further evidence, while texts that share a line only all stay. Rows without
    id or label are left out.
    """
    ship_package(docs.sparkSession)
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
             .where(crc_bucket(F.col("doc_id"), buckets) != held).groupBy("doc_id").agg(F.max("label").alias("label")))
    total = known.count()
    share = min(1.0, bound / max(total, 1))
    draw = known.where(F.pmod(F.xxhash64("doc_id", F.lit("training sample")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))

    def signatures(column: pa.Array) -> pa.Array:
        texts, out = column.to_pylist(), []
        for a, b in slices(texts):
            out += [set_id(members) for members in shingle_sets(texts[a:b], 5)]
        return pa.array(out, type=pa.int64())

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(draw, "doc_id")
    rows = cut_lineage(rows.withColumn("signature", F.arrow_udf(signatures, "long")("text")))
    kept = rows.groupBy("signature").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(kept, ["signature", "doc_id"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "label")
