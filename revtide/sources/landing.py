"""Newline-delimited JSON landing files and their flattening into table rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide import schemas
from revtide.functions.billing import epoch_or_null, first_element, monthly_amount, or_default
from revtide.functions.months import utc

ARRIVAL = "_arrival"
REASON = "_reason"
MALFORMED = "malformed"
_CORRUPT = "_corrupt_record"

#: Fields without which a single object is skipped and reported.
REQUIRED = {"subscriptions": ("id", "customer", "status")}


def landing_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, _arrival``: the lines of an entity's files and their order.

    Files follow the first number in their names; where that is the same or
    missing, a hash of the path decides.  The order is the same on every run
    over the same files, so keep-first decisions survive task retries.
    """
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{1,18})", 1)
    arrival = F.struct(
        F.coalesce(F.nullif(number, F.lit("")).cast("bigint"), F.lit(0).cast("bigint")).alias("file"),
        F.xxhash64("_metadata.file_path").alias("path_hash"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    lines = spark.read.text(path).select("value", arrival.alias(ARRIVAL), F.col("_metadata.file_path").alias("file"))
    return lines.filter(F.trim("value") != "")


def parse_landing(lines: DataFrame, entity: str, text_column: str = "value") -> DataFrame:
    """Parse JSON text that sits in a column; other columns are kept.

    Lines that ``rejects`` lists are left out.  A generator makes the objects of a
    line, one or none: a filter on them would be moved below and parse again.
    """
    kept = [c for c in lines.columns if c != text_column]
    good = F.filter(F.array(_object(text_column, entity)), lambda read: _reason(read, entity).isNull())
    parsed = lines.select(F.explode(good).alias("_object"), *kept)
    fields = [F.col(f"_object.{name}") for name in schemas.LANDING[entity].fieldNames()]
    return parsed.select(*fields, *kept)


def read_landing(spark: SparkSession, entity: str, path: str | list[str]) -> DataFrame:
    """One entity's objects, with its explicit nested schema and ``_arrival``."""
    return parse_landing(landing_lines(spark, path).drop("file"), entity)


def _object(text_column: str, entity: str) -> Column:
    schema = T.StructType([*schemas.LANDING[entity].fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(text_column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _reason(read: Column, entity: str) -> Column:
    """Why a parsed line is rejected, null if it is not."""
    reason = F.when(read.isNull() | read[_CORRUPT].isNotNull(), F.lit(MALFORMED))
    for name in REQUIRED.get(entity, ()):
        reason = reason.when(read[name].isNull(), F.lit(f"no {name}"))
    if entity == "subscriptions":
        item = first_element(read["items"]["data"])
        reason = reason.when(item.isNotNull() & item["price"].isNull(), F.lit("no price"))
    return reason


def _judged(lines: DataFrame, entity: str, text_column: str) -> DataFrame:
    """Adds the parsed ``_object`` and why the line is rejected, null if it is not."""
    read = lines.withColumn("_object", _object(text_column, entity))
    return read.withColumn(REASON, _reason(F.col("_object"), entity))


def rejects(lines: DataFrame, entity: str, text_column: str = "value") -> DataFrame:
    """``entity, file, reason, line`` of the lines that cannot be loaded.

    ``malformed``: not JSON, or a value that does not fit its column.  A
    subscription is also rejected without an id, owner or status, or if its
    first item has no price.
    """
    file = F.col("file") if "file" in lines.columns else F.lit(None).cast("string")
    return _judged(lines, entity, text_column).filter(F.col(REASON).isNotNull()).select(
        F.lit(entity).alias("entity"), file.alias("file"), F.col(REASON).alias("reason"), F.col(text_column).alias("line")
    )


def staged(lines: DataFrame, entity: str, path: str) -> DataFrame:
    """Parses every line once, stores the outcome at ``path`` and reads it back.

    ``object`` has the entity's nested fields and ``_reason`` why the line is
    rejected; only rejected lines keep their text.  Objects, rejects and the
    probes of fallbacks all read this table.
    """
    judged = _judged(lines, entity, "value")
    fields = [F.col(f"_object.{f.name}").alias(f.name) for f in schemas.LANDING[entity].fields]
    judged.select(
        F.when(F.col(REASON).isNull(), F.struct(*fields)).alias("object"),
        REASON,
        ARRIVAL,
        "file",
        F.when(F.col(REASON).isNotNull(), F.col("value")).alias("line"),
    ).write.option("compression", "zstd").parquet(path)
    return lines.sparkSession.read.schema(staged_schema(lines, entity)).parquet(path)


def staged_schema(lines: DataFrame, entity: str) -> T.StructType:
    text = T.StringType()
    return T.StructType(
        [
            T.StructField("object", schemas.LANDING[entity]),
            T.StructField(REASON, text),
            T.StructField(ARRIVAL, lines.schema[ARRIVAL].dataType),
            T.StructField("file", text),
            T.StructField("line", text),
        ]
    )


def staged_objects(staged_lines: DataFrame) -> DataFrame:
    """The objects that can be loaded, and ``_arrival``."""
    return staged_lines.filter(F.col(REASON).isNull()).select("object.*", ARRIVAL)


def staged_rejects(staged_lines: DataFrame, entity: str) -> DataFrame:
    return staged_lines.filter(F.col(REASON).isNotNull()).select(
        F.lit(entity).alias("entity"), "file", F.col(REASON).alias("reason"), "line"
    )


def _stamp(extracted_at: dt.datetime | Column) -> Column:
    return extracted_at if isinstance(extracted_at, Column) else utc(extracted_at)


def _carried(raw: DataFrame) -> list[str]:
    return [ARRIVAL] if ARRIVAL in raw.columns else []


def flatten_customers(raw: DataFrame, extracted_at: dt.datetime | Column) -> DataFrame:
    clock = F.coalesce(F.get_json_object("test_clock", "$.id"), F.col("test_clock"))
    return raw.select(
        F.col("id").alias("customer_id"),
        "email",
        "name",
        "description",
        F.timestamp_seconds("created").alias("created"),
        "currency",
        "delinquent",
        clock.alias("test_clock_id"),
        F.col("invoice_settings.default_payment_method").alias("default_payment_method"),
        _stamp(extracted_at).alias("extracted_at"),
        *_carried(raw),
    )


def flatten_products(raw: DataFrame, extracted_at: dt.datetime | Column) -> DataFrame:
    return raw.select(
        F.col("id").alias("product_id"),
        "name",
        "description",
        "active",
        F.timestamp_seconds("created").alias("created"),
        F.timestamp_seconds("updated").alias("updated"),
        _stamp(extracted_at).alias("extracted_at"),
        *_carried(raw),
    )


def flatten_prices(raw: DataFrame, extracted_at: dt.datetime | Column) -> DataFrame:
    return raw.select(
        F.col("id").alias("price_id"),
        F.col("product").alias("product_id"),
        "active",
        "currency",
        "unit_amount",
        F.col("recurring.interval").alias("recurring_interval"),
        F.col("recurring.interval_count").alias("recurring_interval_count"),
        "nickname",
        F.timestamp_seconds("created").alias("created"),
        _stamp(extracted_at).alias("extracted_at"),
        *_carried(raw),
    )


def flatten_subscriptions(raw: DataFrame, extracted_at: dt.datetime | Column) -> DataFrame:
    """One row per subscription; only its first item sets price and amount.

    An item without a price makes the whole subscription unreadable, and it is
    left out.  A subscription without items stays, with amount zero.
    """
    stamp = _stamp(extracted_at)
    item = first_element(F.col("items.data"))
    rows = raw.select("*", item.alias("_item"))
    rows = rows.filter(F.col("_item").isNull() | F.col("_item.price").isNotNull())
    # Columns of their own, as each is used several times and their texts would be read as often.
    rows = rows.withColumn("_recurring_keys", F.json_object_keys("_item.price.recurring"))
    # Monthly if the object has anything but an interval; an explicit null is no interval.
    recurs = F.coalesce(F.size("_recurring_keys"), F.lit(0)) > 0
    named = F.array_contains("_recurring_keys", "interval")
    given = F.get_json_object("_item.price.recurring", "$.interval")
    rows = rows.withColumn("_interval", F.when(recurs, F.when(named, given).otherwise("month")))

    has_item = F.col("_item").isNotNull()
    price = F.col("_item.price")
    unit_amount = F.when(has_item, or_default(price["unit_amount"], F.lit(0)))
    quantity = or_default(F.col("_item.quantity"), F.lit(1))
    # Monthly if the object has anything but an interval; an explicit null is no interval.
    recurring = price["recurring"]
    recurs = F.coalesce(F.size(F.json_object_keys(recurring)), F.lit(0)) > 0
    named = F.array_contains(F.json_object_keys(recurring), "interval")
    interval = F.when(recurs, F.when(named, F.get_json_object(recurring, "$.interval")).otherwise("month"))

    period_start = F.coalesce(
        F.nullif(F.col("_item.current_period_start"), F.lit(0)),
        F.nullif("billing_cycle_anchor", F.lit(0)),
        F.nullif("start_date", F.lit(0)),
        F.nullif("created", F.lit(0)),
    )
    period_end = F.coalesce(F.nullif(F.col("_item.current_period_end"), F.lit(0)), period_start)

    return rows.select(
        F.col("id").alias("subscription_id"),
        F.col("customer").alias("customer_id"),
        "status",
        F.coalesce(F.timestamp_seconds(period_start), stamp).alias("current_period_start"),
        F.coalesce(F.timestamp_seconds(period_end), stamp).alias("current_period_end"),
        F.coalesce(epoch_or_null(F.col("start_date")), stamp).alias("start_date"),
        epoch_or_null(F.col("ended_at")).alias("ended_at"),
        epoch_or_null(F.col("canceled_at")).alias("canceled_at"),
        F.coalesce("cancel_at_period_end", F.lit(False)).alias("cancel_at_period_end"),
        "collection_method",
        F.coalesce(epoch_or_null(F.col("created")), stamp).alias("created"),
        F.coalesce("currency", F.lit("usd")).alias("currency"),
        price["id"].alias("price_id"),
        price["product"].alias("product_id"),
        unit_amount.alias("unit_amount"),
        quantity.alias("quantity"),
        monthly_amount(unit_amount, quantity, F.col("_interval")).alias("mrr_amount"),
        stamp.alias("extracted_at"),
        *_carried(raw),
    )


def flatten_invoices(raw: DataFrame, extracted_at: dt.datetime | Column) -> DataFrame:
    return raw.select(
        F.col("id").alias("invoice_id"),
        F.col("number").alias("invoice_number"),
        F.col("customer").alias("customer_id"),
        F.col("subscription").alias("subscription_id"),
        "status",
        "amount_due",
        "amount_paid",
        "amount_remaining",
        "subtotal",
        "total",
        "currency",
        F.timestamp_seconds("created").alias("created"),
        epoch_or_null(F.col("due_date")).alias("due_date"),
        epoch_or_null(F.col("period_start")).alias("period_start"),
        epoch_or_null(F.col("period_end")).alias("period_end"),
        epoch_or_null(F.col("status_transitions.paid_at")).alias("paid_at"),
        "collection_method",
        "hosted_invoice_url",
        "invoice_pdf",
        _stamp(extracted_at).alias("extracted_at"),
        *_carried(raw),
    )


FLATTEN = {
    "customers": flatten_customers,
    "products": flatten_products,
    "prices": flatten_prices,
    "subscriptions": flatten_subscriptions,
    "invoices": flatten_invoices,
}
