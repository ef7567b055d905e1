"""What the operators share: given tables, written tables, text slices, connected components."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.functions.session import cut_lineage, ensure_checkpoint_dir, release

SLICE_CHARS = 1_000_000

__all__ = ["SLICE_CHARS", "components", "crc_bucket", "cut_lineage", "ensure_checkpoint_dir", "read_table", "shared_path",
           "ship_package", "slices"]


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless it is installed or shipped anyway."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = [part for part in environment.get("PYTHONPATH", "").split(os.pathsep) if part]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}"


def crc_bucket(ident: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo the number of buckets; null ids count as the text 'null'."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("null")).cast("binary")) % F.lit(buckets)


def slices(texts: Sequence[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that hold about ``limit`` characters; a longer text stands alone, whole."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > begin and held + size > limit:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(texts):
        yield begin, len(texts)


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges(a, b)`` reaches.

    Large-star and small-star in turn: every node keeps one edge to the smallest
    neighbour it knows, so the edge list never grows and a star of any size settles
    in few rounds. Each round is a written table; nothing but two sums reaches the
    driver. Null ends and loops carry no link. Without edges the result is empty.
    """
    current = cut_lineage(edges.where("a is not null and b is not null and a <> b")
                          .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                               F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        before, current = current, cut_lineage(small)
        release(before)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        last = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
