"""Trip extract scan: delimited text whose header spelling varies from file to file."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odflux.functions.session import cut_lineage

# Logical trip columns and the header spellings accepted for each,
# compared after lower-casing and dropping everything but letters and digits.
HEADER_SPELLINGS = {
    "vendor_id": ["vendorid", "vendorid1", "vendorname"],
    "pickup_datetime": ["tpeppickupdatetime", "lpeppickupdatetime", "pickupdatetime", "pickupdate"],
    "dropoff_datetime": ["tpepdropoffdatetime", "lpepdropoffdatetime", "dropoffdatetime", "dropoffdate"],
    "passenger_count": ["passengercount"],
    "trip_distance": ["tripdistance"],
    "ratecode_id": ["ratecodeid", "ratecode"],
    "store_and_fwd_flag": ["storeandfwdflag"],
    "pickup_location_id": ["pulocationid", "pickuplocationid"],
    "dropoff_location_id": ["dolocationid", "dropofflocationid"],
    "payment_type": ["paymenttype"],
    "fare_amount": ["fareamount"],
    "extra": ["extra"],
    "mta_tax": ["mtatax"],
    "tip_amount": ["tipamount"],
    "tolls_amount": ["tollsamount"],
    "improvement_surcharge": ["improvementsurcharge"],
    "total_amount": ["totalamount"],
    "congestion_surcharge": ["congestionsurcharge"],
    "airport_fee": ["airportfee"],
    "trip_type": ["triptype"],
    "ehail_fee": ["ehailfee"],
}
REQUIRED = [
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "trip_distance",
    "total_amount",
]
FILE_SUFFIXES = (".csv", ".csv.gz", ".txt", ".txt.gz")


def _bare(name: str) -> str:
    return "".join(ch for ch in name.strip().lower() if ch.isalnum())


def logical_columns(header: list[str]) -> dict[str, str]:
    """Logical name -> header spelling found in this file."""
    present = {_bare(name): name for name in header}
    hits = {
        logical: next((present[s] for s in spellings if s in present), None)
        for logical, spellings in HEADER_SPELLINGS.items()
    }
    return {logical: name for logical, name in hits.items() if name is not None}


def canonicalise_header(df: DataFrame, source: str = "input") -> DataFrame:
    """Rename to the logical names; other columns go, bookkeeping columns stay."""
    found = logical_columns([c for c in df.columns if c not in ("source_file", "source_line")])
    absent = [name for name in REQUIRED if name not in found]
    if absent:
        raise ValueError(f"{source} lacks required columns: {', '.join(absent)}")
    kept = [F.col(f"`{spelling}`").alias(logical) for logical, spelling in found.items()]
    kept += [F.col(c) for c in ("source_file", "source_line") if c in df.columns]
    return df.select(*kept)


def list_trip_files(spark: SparkSession, path: str) -> list[str]:
    """Matching files at ``path``, by file name: one file, a flat folder, or a pattern (``*``, ``?``, ``{a,b}``) of such."""
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(location)
    if not found:
        raise FileNotFoundError(f"nothing at {path}")
    files = [f.getPath() for place in found for f in fs.listStatus(place.getPath()) if f.isFile()]
    wanted = [p for p in files if p.getName().lower().endswith(FILE_SUFFIXES)]
    return [p.toString() for p in sorted(wanted, key=lambda p: (p.getName(), p.toString()))]


def _numbered_lines(spark: SparkSession, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """(value, source_file, source_path, source_line) of every line, and (source_path, header) of every file with a line.

    The text is read once and written as a table: each line with its split and its
    place in the reading order there, so numbers do not depend on how a second read
    would cut the files. One narrow pass over that table gives, per split, its number of
    lines and its first one; splits of a file follow each other by their place in it.
    """
    lines = cut_lineage(spark.read.text(files).select(
        "value", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")))
    earlier = Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = cut_lineage(
        lines.groupBy("source_path", "block").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("lines"))
        .withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0))).drop("lines"))
    numbered = lines.join(splits, ["source_path", "block"]).select(
        "value", "source_file", "source_path", (F.col("before") + F.col("seq") - F.col("first") + 1).alias("source_line"))
    # The first line of the first split, found by its place; no other line is looked at.
    heads = splits.where("before = 0").select("source_path", F.col("first").alias("seq"))
    headers = cut_lineage(lines.join(heads, ["source_path", "seq"]).select("source_path", F.col("value").alias("header")))
    return numbered, headers


def scan_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    """All trip files under ``path`` as strings with logical column names and their physical line numbers.

    Files of any number of header spellings are read together, once, by Spark tasks;
    the driver lists the files and sees each distinct header. Line 1 of a file is its
    header; a later copy of it is a row like any other, and blank lines are no rows. A file
    without a single line is passed over; one whose first line is blank lacks its
    columns, which is an error. A column that no header has is left out.
    """
    files = list_trip_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no readable trip files at {path}")
    numbered, headers = _numbered_lines(spark, files)
    spellings = headers.groupBy("header").agg(F.min("source_path").alias("example")).orderBy("header").collect()
    if not spellings:
        raise FileNotFoundError(f"no readable trip files at {path}")
    columns = []
    for header, example in spellings:
        names = _unique(next(csv.reader([header.lstrip("\ufeff")]), []))
        found = logical_columns(names)
        absent = [name for name in REQUIRED if name not in found]
        if absent:
            raise ValueError(f"{example} lacks required columns: {', '.join(absent)}")
        columns.append((len(names), {logical: names.index(name) for logical, name in found.items()}))
    width = max(n for n, _ in columns)
    number = F.lit(0)
    for i, (header, _) in enumerate(spellings[1:], 1):
        number = F.when(F.col("header") == header, i).otherwise(number)
    cells = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), {"quote": '"', "escape": '"'})
    rows = numbered.where((F.col("source_line") > 1) & (F.trim("value") != "")).join(
        headers.select("source_path", number.alias("spelling")), "source_path")
    parsed = rows.select(cells.alias("r"), "spelling", "source_file", "source_line")

    def cell(logical: str) -> Column:
        """The column's cell under each spelling; a cell past a file's own header is none of its columns."""
        arms = F.lit(None).cast("string")
        for i, (_, places) in enumerate(columns):
            if logical in places:
                arms = F.when(F.col("spelling") == i, F.col(f"r.c{places[logical]}")).otherwise(arms)
        return arms.alias(logical)

    kept = [logical for logical in HEADER_SPELLINGS if any(logical in places for _, places in columns)]
    return parsed.select(*[cell(logical) for logical in kept], "source_file", "source_line")


def _unique(names: list[str]) -> list[str]:
    """Keep the last of repeated header names addressable, as a map from names would."""
    last = {_bare(n): i for i, n in enumerate(names)}
    return [n if last[_bare(n)] == i else f"{n}__{i}x" for i, n in enumerate(names)]
