"""A uniform shuffle of all records into shards, in two passes.

The first pass scatters the records into buckets that fit in memory, by seeded
hashes; the second shuffles every bucket by Fisher-Yates.  Buckets follow each
other, and the sequence is cut into shards of equal numbers of records.

Everything is a DataFrame expression.  The random numbers are hashes of seed,
bucket and step, so a task that runs again gives the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.llm.common import quoted, row_hash, stored

SEED = 20240611
SHARDS = 16
#: Records of a bucket, on average.
BUCKET_ROWS = 512
#: Bytes of text of a bucket, on average; long records make more buckets.
BUCKET_BYTES = 1 << 26
#: Buckets of a group whose sizes are summed in one task.
GROUPED_BUCKETS = 4096


def fisher_yates(size: Column, *seed: Column) -> Column:
    """A permutation of 0 to ``size - 1``: from the last place down, each swaps with one at or before it."""

    def swapped(order: Column, last: Column) -> Column:
        other = F.pmod(F.xxhash64(*seed, last), (last + 1).cast("long")).cast("int")
        kept, moved = F.get(order, last), F.get(order, other)
        return F.transform(
            order, lambda value, at: F.when(at == last, moved).when(at == other, kept).otherwise(value)
        )

    zero = F.lit(0)
    steps = F.when(size > 1, F.sequence(size - 1, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.sequence(zero, size - 1), swapped)


def _bucket_orders(sizes: DataFrame, seed: int) -> DataFrame:
    """``bucket, start, order``: where a bucket starts in the sequence, and the place in it of each rank."""
    group = F.floor(F.col("bucket") / GROUPED_BUCKETS)
    grouped = sizes.withColumn("group", group)
    so_far = Window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per GROUPED_BUCKETS * BUCKET_ROWS records.
    totals = grouped.groupBy("group").agg(F.sum("size").alias("group_size"))
    before = F.sum("group_size").over(so_far.orderBy("group")) - F.col("group_size")
    starts = totals.select("group", before.alias("group_start"))
    within = F.sum("size").over(so_far.partitionBy("group").orderBy("bucket")) - F.col("size")
    placed = grouped.withColumn("within", within).join(starts, "group")
    # The permutations are made by as many tasks as there are reducers.
    return placed.repartition("bucket").select(
        "bucket",
        (F.col("group_start") + F.col("within")).alias("start"),
        fisher_yates(F.col("size").cast("int"), F.lit(seed), F.col("bucket")).alias("order"),
    )


def _text_bytes(records: DataFrame) -> Column:
    """Bytes of a record's strings."""
    fields = (f for f in records.schema.fields if f.dataType.simpleString() in ("string", "binary"))
    lengths = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in quoted(f.name for f in fields)]
    return sum(lengths, F.lit(0).cast("long"))


def shuffled(
    records: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The records with ``shard`` and ``slot``; slots of a shard count from 0 without gaps.

    Numbers of records differ by one at most between shards.  Rows alike in all
    columns are scattered one by one, so even a record that makes up a third of
    the table fills no bucket.  Nulls are values like others.  With fewer
    records than shards some shards stay empty; an empty table gives no rows.
    Columns named ``shard`` or ``slot`` are replaced.
    """
    records = records.drop("shard", "slot")
    names = quoted(records.columns)
    keys = [row_hash(records).alias("_row"), row_hash(records, 1).alias("_row2")]
    counted = stored(
        records.select(*keys, _text_bytes(records).alias("_bytes")).groupBy("_row", "_row2").agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("_bytes").alias("_bytes")
        ),
        "rows",
    )
    total, size = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_rows), -(-size // bucket_bytes))
    each = F.explode(F.sequence(F.lit(1).cast("long"), "_rows")).alias("_repeat")
    bucket = F.pmod(F.xxhash64(F.lit(seed), "_row", "_row2", "_repeat"), F.lit(buckets).cast("long")).alias("bucket")
    sizes = counted.select("_row", "_row2", each).select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    # A merge, as the orders grow with the records; both sides lie by bucket already.
    orders = _bucket_orders(stored(sizes, "buckets"), seed).withColumnRenamed("bucket", "_bucket").hint("merge")

    # Places are given to hashes; the records themselves travel once, each repeated one as a single row.
    scattered = counted.select("_row", "_row2", each).select("_row", "_row2", "_repeat", bucket.alias("_bucket"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_row", "_row2", "_repeat")) - 1
    places = scattered.withColumn("_rank", rank).join(
        orders.select("_bucket", F.col("start").alias("_start"), F.col("order").alias("_order")), "_bucket"
    ).select("_row", "_row2", (F.col("_start") + F.get("_order", F.col("_rank"))).alias("_position"))
    one_each = records.select(*names, *keys).dropDuplicates(["_row", "_row2"])
    placed = one_each.join(places.hint("merge"), ["_row", "_row2"])
    shard = F.expr(f"CAST(_position * {shards} DIV {max(total, 1)} AS INT)")
    first = F.expr(f"(CAST(shard AS BIGINT) * {total} + {shards - 1}) DIV {shards}")
    return placed.select(*names, "_position", shard.alias("shard")).select(
        *names, "shard", (F.col("_position") - first).alias("slot")
    )


def write_shards(records: DataFrame, path: str, **options) -> None:
    """Shuffled records as Parquet, a folder per shard, files in slot order."""
    placed = shuffled(records, **options)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").option(
        "compression", "zstd"
    ).parquet(path)


def read_shards(records: DataFrame, path: str) -> DataFrame:
    """The shards that ``write_shards`` made of ``records``, with ``shard`` and ``slot``."""
    kept = [f for f in records.schema.fields if f.name not in ("shard", "slot")]
    schema = T.StructType([*kept, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return records.sparkSession.read.schema(schema).parquet(path)


def digests(documents: DataFrame, *more: str) -> DataFrame:
    """``doc_id, size, text_crc32`` and the named columns; a null text has size 1 and the checksum of nothing."""
    text = F.col("text").cast("string")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *more,
    )
