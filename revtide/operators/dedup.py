"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lines of a slab, the most that ``bitmap_construct_agg`` has bits for.
SLAB_LINES = 1 << 15
#: Slabs, of 4 KB each, that are broadcast; more are joined as their size suggests.
BROADCAST_SLABS = 1 << 14


def keep_first(rows: DataFrame, key: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first under ``order_by``.

    Spark turns ``row_number() = 1`` into a rank limit that also runs before
    the shuffle, so any number of copies of one key leaves each task as a
    single row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = rows.withColumn("_position", F.row_number().over(window))
    return ranked.filter(F.col("_position") == 1).drop("_position")


def keep_first_unmoved(
    rows: DataFrame, key: str | Sequence[str], arrival: str, path: str, without: DataFrame | None = None
) -> DataFrame:
    """``keep_first`` by arrival that shuffles keys and arrivals only; keys ``without`` has are left out.

    ``arrival`` is a struct that no two rows share, its last field a line number
    from zero on.  A bit for each line says whether it is the first of its key;
    these bits are stored at ``path`` and joined with the rows, which stay in the
    partitions they are in.  ``rows`` are read twice and must be the same then.
    """
    spark = rows.sparkSession
    *file, line = rows.schema[arrival].dataType.fieldNames()
    slab = [F.col(f"{arrival}.{name}").alias(f"_{name}") for name in file]
    slab.append(F.shiftright(F.col(f"{arrival}.{line}"), 15).alias("_slab"))
    place = F.col(f"{arrival}.{line}").bitwiseAND(F.lit(SLAB_LINES - 1).cast("bigint")).alias("_place")
    names = [*(f"_{name}" for name in file), "_slab"]

    keys = [key] if isinstance(key, str) else list(key)
    firsts = keep_first(rows.select(*keys, arrival), keys, [arrival])
    if without is not None:
        firsts = firsts.join(without.select(*keys), keys, "left_anti")
    bits = firsts.select(*slab, place).groupBy(*names).agg(F.bitmap_construct_agg("_place").alias("_bits"))
    bits.write.option("compression", "zstd").parquet(path)
    bits = spark.read.schema(bits.schema).parquet(path)
    if bits.limit(BROADCAST_SLABS + 1).count() <= BROADCAST_SLABS:
        bits = F.broadcast(bits)

    placed = rows.select("*", *slab, place)
    same = [placed[name].eqNullSafe(bits[name]) for name in names]
    byte = F.expr("ascii(decode(substring(_bits, CAST(shiftright(_place, 3) AS INT) + 1, 1), 'ISO-8859-1'))")
    first = F.expr("shiftleft(1, CAST(_place & 7 AS INT))").bitwiseAND(byte) != 0
    return placed.join(bits, same).filter(first).select(*rows.columns)
