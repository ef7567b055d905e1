"""Raw trip rows -> canonical trip events and rejects, as one projection each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.operators.events import EVENT_FIELDS

MAX_DURATION_SECONDS = 86_400
MAX_DISTANCE_MILES = 500.0
MAX_SPEED_MPH = 120.0
ZONE_RANGE = (1, 265)

# Output field of the event <- logical input column, by type.
INT_FIELDS = {"rate_code_id": "ratecode_id", "payment_type": "payment_type"}
AMOUNT_FIELDS = {
    "fare_amount": "fare_amount",
    "extra_amount": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee",
    "ehail_fee": "ehail_fee",
}


def _text(df: DataFrame, name: str) -> Column:
    """Trimmed cell, empty as null; null for a column this extract does not have."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    return F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))


def _finite(raw: Column) -> Column:
    number = raw.try_cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == F.lit(float("inf"))), None).otherwise(number)


def _whole(raw: Column) -> Column:
    """Truncated, saturated int; not-a-number becomes 0 (and fails the range rules)."""
    number = raw.try_cast("double")
    inside = F.greatest(F.least(number, F.lit(2147483647.0)), F.lit(-2147483648.0))
    return F.when(F.isnan(number), F.lit(0)).when(number.isNotNull(), inside.cast("int"))


def _one_layout(raw: Column) -> Column:
    """Wall-clock text in one layout where its look says which of the others it has."""
    text = F.when(F.substring(raw, 20, 1) == ".", F.substring(raw, 1, 19)).otherwise(raw)
    day_first = F.concat(F.substring(text, 7, 4), F.lit("-"), F.substring(text, 1, 2), F.lit("-"),
                         F.substring(text, 4, 2), F.substring(text, 11, 30))
    return (
        F.when(text.like("____-__-__T%"), F.concat(F.substring(text, 1, 10), F.lit(" "), F.substring(text, 12, 30)))
        .when(text.like("__/__/____ %"), day_first)
        .when(~F.substring(text, -3, 3).isin(" AM", " PM"), text)
    )


def _instant_millis(text: Column, tz: str) -> Column:
    """Epoch millis of a local wall-clock text in the one layout (24 hours, or 12 with AM/PM), or null.

    Each value meets a single pattern, so good rows never pay for failed parses.
    """
    half_day = F.substring(text, -3, 3).isin(" AM", " PM")
    local = F.when(half_day, F.try_to_timestamp(text, F.lit("yyyy-MM-dd hh:mm:ss a"))).otherwise(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))
    return F.unix_millis(F.to_utc_timestamp(local, tz))


def _iso(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def event_id(service: Column, vendor: Column, pickup_ms: Column, dropoff_ms: Column,
             pickup_zone: Column, dropoff_zone: Column, total: Column) -> Column:
    """Version-3 UUID of the trip's natural key: the same trip always gets the same id."""
    key = F.concat_ws(
        "|", service, F.coalesce(vendor, F.lit(-1)).cast("string"), pickup_ms.cast("string"),
        dropoff_ms.cast("string"), pickup_zone.cast("string"), dropoff_zone.cast("string"),
        F.format_string("%.2f", total),
    )
    digest = F.md5(key)
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), F.pmod(nibble, F.lit(4)) + 1)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-3"),
        F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def with_event_id(trips: DataFrame, service_type: str) -> DataFrame:
    c = F.col
    return trips.withColumn(
        "event_id",
        event_id(F.lit(service_type), c("vendor_id"), c("pickup_epoch_millis"), c("dropoff_epoch_millis"),
                 c("pickup_location_id"), c("dropoff_location_id"), c("total_amount")),
    )


def assess_trips(raw: DataFrame, service_type: str, tz: str = "America/New_York",
                 zone_range: tuple[int, int] = ZONE_RANGE) -> DataFrame:
    """Every raw row with its typed fields plus ``reason``/``detail`` (null when accepted)."""
    raw_names = {
        "_pickup_raw": "pickup_datetime", "_dropoff_raw": "dropoff_datetime",
        "_pu_raw": "pickup_location_id", "_do_raw": "dropoff_location_id",
        "_distance_raw": "trip_distance", "_total_raw": "total_amount",
    }
    c = F.col
    texts = raw.select(
        *[_text(raw, column).alias(alias) for alias, column in raw_names.items()],
        *[_text(raw, column).alias(f"_t_{field}") for field, column in
          {**INT_FIELDS, **AMOUNT_FIELDS, "vendor_id": "vendor_id", "passenger_count": "passenger_count",
           "flag": "store_and_fwd_flag"}.items()],
        (c("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")).alias("source_file"),
        (c("source_line") if "source_line" in raw.columns else F.lit(None).cast("long")).alias("source_line"),
    )
    passengers = _whole(c("_t_passenger_count"))
    # A one-row ``inline`` keeps the optimizer from copying the parsing expressions into
    # every later use and filter, so each cell is parsed once.
    typed = texts.select(F.inline(F.array(F.struct(
        *[c(name) for name in raw_names], c("source_file"), c("source_line"),
        _instant_millis(_one_layout(c("_pickup_raw")), tz).alias("pickup_epoch_millis"),
        _instant_millis(_one_layout(c("_dropoff_raw")), tz).alias("dropoff_epoch_millis"),
        _whole(c("_pu_raw")).alias("pickup_location_id"),
        _whole(c("_do_raw")).alias("dropoff_location_id"),
        _finite(c("_distance_raw")).alias("trip_distance_miles"),
        _finite(c("_total_raw")).alias("total_amount"),
        _whole(c("_t_vendor_id")).alias("vendor_id"),
        F.when(passengers >= 0, passengers).alias("passenger_count"),
        F.upper("_t_flag").alias("store_and_forward_flag"),
        *[_whole(c(f"_t_{field}")).alias(field) for field in INT_FIELDS],
        *[_finite(c(f"_t_{field}")).alias(field) for field in AMOUNT_FIELDS],
    ))))
    span_ms = c("dropoff_epoch_millis") - c("pickup_epoch_millis")
    typed = typed.withColumn("trip_duration_seconds", F.floor(span_ms / F.lit(1000)).cast("long"))
    typed = typed.withColumn("_speed", F.when(
        c("trip_duration_seconds") > 0,
        c("trip_distance_miles") / (c("trip_duration_seconds").cast("double") / F.lit(3600.0).cast("double"))))

    low, high = zone_range
    shown = lambda name: F.coalesce(c(name), F.lit("<empty>"))
    labelled = lambda label, value: F.concat(F.lit(label), value.cast("string"))
    outside = lambda zone: ~c(zone).between(low, high)
    rules: list[tuple[Column, str, Column]] = [
        (c("pickup_epoch_millis").isNull(), "unparseable_pickup_time", shown("_pickup_raw")),
        (c("dropoff_epoch_millis").isNull(), "unparseable_dropoff_time", shown("_dropoff_raw")),
        (c("pickup_location_id").isNull() | c("dropoff_location_id").isNull(), "missing_zone_id",
         F.concat(F.lit("pickup="), shown("_pu_raw"), F.lit(" dropoff="), shown("_do_raw"))),
        (c("trip_distance_miles").isNull(), "unparseable_trip_distance", shown("_distance_raw")),
        (c("total_amount").isNull(), "unparseable_total_amount", shown("_total_raw")),
        (outside("pickup_location_id"), "zone_id_out_of_range", labelled("pickup=", c("pickup_location_id"))),
        (outside("dropoff_location_id"), "zone_id_out_of_range", labelled("dropoff=", c("dropoff_location_id"))),
        (c("trip_duration_seconds") <= 0, "non_positive_duration",
         labelled("duration_seconds=", c("trip_duration_seconds"))),
        (c("trip_duration_seconds") > MAX_DURATION_SECONDS, "duration_exceeds_limit",
         labelled("duration_seconds=", c("trip_duration_seconds"))),
        (~c("trip_distance_miles").between(0.0, MAX_DISTANCE_MILES), "distance_out_of_range",
         labelled("trip_distance=", c("trip_distance_miles"))),
        (c("_speed") > MAX_SPEED_MPH, "implausible_speed", labelled("speed_mph=", c("_speed"))),
    ]
    reason = F.coalesce(*[F.when(broken, F.lit(why)) for broken, why, _ in rules])
    detail = F.coalesce(*[F.when(broken, told) for broken, _, told in rules])
    return typed.select(
        event_id(F.lit(service_type), c("vendor_id"), c("pickup_epoch_millis"), c("dropoff_epoch_millis"),
                 c("pickup_location_id"), c("dropoff_location_id"), c("total_amount")).alias("event_id"),
        F.lit(service_type).alias("service_type"), "vendor_id",
        _iso(c("pickup_epoch_millis")).alias("pickup_time"), _iso(c("dropoff_epoch_millis")).alias("dropoff_time"),
        "pickup_epoch_millis", "dropoff_epoch_millis", "trip_duration_seconds", "passenger_count", "trip_distance_miles",
        (F.rint(c("_speed") * 100.0) / F.lit(100.0).cast("double")).alias("average_speed_mph"),
        "pickup_location_id", "dropoff_location_id", *INT_FIELDS, "store_and_forward_flag", *AMOUNT_FIELDS,
        "total_amount", "source_file", "source_line",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ingested_at"),
        reason.alias("reason"), detail.alias("detail"),
    )


def split_assessed(assessed: DataFrame) -> tuple[DataFrame, DataFrame]:
    accepted = assessed.where(F.col("reason").isNull()).select(*EVENT_FIELDS)
    rejected = assessed.where(F.col("reason").isNotNull()).select("source_file", "source_line", "reason", "detail")
    return accepted, rejected


def parse_trips(raw: DataFrame, service_type: str, tz: str = "America/New_York",
                zone_range: tuple[int, int] = ZONE_RANGE, fail_fast: bool = False,
                limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted trip events and rejected rows.

    ``fail_fast`` makes the first rejected row fail the job that meets it.
    ``limit`` keeps that many accepted trips.
    """
    assessed = assess_trips(raw, service_type, tz, zone_range)
    trips, rejects = split_assessed(assessed)
    if fail_fast:
        message = F.concat(F.lit("rejected row "), F.coalesce("source_file", F.lit("?")), F.lit(": "),
                           F.col("reason"), F.lit(": "), F.col("detail"))
        sound = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        trips = assessed.where(sound).select(*EVENT_FIELDS)
    return (trips.limit(limit) if limit else trips), rejects


def to_event_json(trips: DataFrame) -> DataFrame:
    """One ``value`` per trip: the event as JSON with explicit nulls."""
    names = [name for name in EVENT_FIELDS if name in trips.columns]
    return trips.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"))


def event_records(trips: DataFrame, topic: str = "trips") -> DataFrame:
    """Message rows: key is the pickup zone so one zone stays in one topic partition."""
    names = [name for name in EVENT_FIELDS if name in trips.columns]
    header = lambda key, value: F.struct(F.lit(key).alias("key"), value.cast("string").cast("binary").alias("value"))
    source = F.col("source_file") if "source_file" in trips.columns else F.lit(None).cast("string")
    return trips.select(
        F.col("pickup_location_id").cast("string").alias("key"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"),
        F.array(
            header("event-id", F.col("event_id")),
            header("service-type", F.col("service_type")),
            header("source-file", F.coalesce(source, F.lit(""))),
            header("schema-version", F.lit("1")),
        ).alias("headers"),
        F.lit(topic).alias("topic"),
        F.col("pickup_epoch_millis").alias("event_millis"),
    )


def publish_events(trips: DataFrame, sink: dict[str, str]) -> None:
    """Send events to Kafka (``{"kafka": servers, "topic": name}``) or to files (``{"path": ...}``)."""
    records = event_records(trips, sink.get("topic", "trips"))
    if "kafka" in sink:
        (records.select("key", "value", "headers", "topic").write.format("kafka")
         .option("kafka.bootstrap.servers", sink["kafka"]).option("includeHeaders", "true").save())
    else:
        records.select("key", "value", "event_millis").write.mode(sink.get("mode", "append")).parquet(sink["path"])


def reject_breakdown(rejects: DataFrame) -> DataFrame:
    return (rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.desc("row_count"), "reason"))


def ingest_summary(assessed: DataFrame) -> DataFrame:
    """Rows read, accepted, rejected and payload bytes, from one scan of the assessed rows."""
    ok = F.col("reason").isNull()
    payload = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})
    return assessed.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(ok).alias("rows_accepted"),
        F.count_if(~ok).alias("rows_rejected"),
        F.coalesce(F.sum(F.when(ok, F.octet_length(payload)).cast("long")), F.lit(0)).cast("long").alias("payload_bytes"),
    )
