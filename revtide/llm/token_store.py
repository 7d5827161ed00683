"""Token ids in ORC files: run-length encoded lists, row indexes and Bloom filters on doc_id.

Documents are written in ascending doc_id order.  Stripes are read in parallel,
and a search for some documents skips files, stripes and rows by the doc_id
ranges and Bloom filters in the files' metadata.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revtide.llm.columnar_tokens import ColumnarEncoder
from revtide.llm.common import column_values, small_batches, stored, utf8, with_columns

END = 1
#: Bytes of texts that are looked up together.
GROUP_BYTES = 6 << 20
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
}

@cache
def _encoder(path: str) -> ColumnarEncoder:
    """A worker's encoder with what it remembers, which its later tasks find again."""
    return ColumnarEncoder(Tokenizer.from_file(path))


def _encode_batches(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP_BYTES:
                yield from _encoded(held, _encoder(path), end)
                held, size = [], 0
        yield from _encoded(held, _encoder(path), end)

    return run


def _encoded(held: list[pa.RecordBatch], encoder: ColumnarEncoder, end: int) -> Iterator[pa.RecordBatch]:
    """The batches with their texts' ids, looked up together."""
    if not held:
        return
    ids, sizes = encoder.encode([t for batch in held for t in column_values(batch, "text")])
    ids, sizes = np.insert(ids, np.cumsum(sizes), end), sizes + 1
    ends = np.cumsum(sizes)
    at = 0
    for batch in held:
        own = sizes[at : at + batch.num_rows]
        start = int(ends[at] - own[0]) if len(own) else 0
        offsets = np.concatenate(([0], np.cumsum(own))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[start : start + int(offsets[-1])]))
        yield with_columns(batch, ["doc_id", "text_hash"], {"ids": lists})
        at += batch.num_rows


def write_tokens(documents: DataFrame, path: str, tokenizer_path: str, end: int = END) -> None:
    """Ids of every row, ``end`` after each, as ORC under ``path`` in ascending doc_id order.

    Rows of one doc_id follow the hash of their text; null ids come first.  A
    null text is empty and has the end id alone.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        utf8("text").alias("text"),
    )
    order = ["doc_id", "text_hash"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = ordered.mapInArrow(_encode_batches(tokenizer_path, end), "doc_id long, text_hash long, ids array<int>")
    encoded.write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """``doc_id, text_hash, ids``; with ``doc_ids`` of these only, by metadata where it tells."""
    schema = "doc_id long, text_hash long, ids array<int>"
    rows = spark.read.schema(schema).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(list(doc_ids)))


def _checksum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        ends = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        new = {"n_tokens": pa.array(np.diff(ends)), "ids_crc32": pa.array(sums, pa.int64())}
        yield with_columns(batch, ["doc_id", "text_hash", "part"], new)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from stored files; ``start`` counts the ids of all rows before.

    A file holds a range of ids, and its name its place among the files: rows
    are summed within their file, and files among each other.
    """
    small_batches(spark)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = read_tokens(spark, path).select("doc_id", "text_hash", part.alias("part"), "ids")
    ddl = "doc_id long, text_hash long, part long, n_tokens long, ids_crc32 long"
    known = stored(rows.mapInArrow(_checksum_batches, ddl), "token-sizes")
    so_far = Window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per file.
    totals = known.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = F.sum("part_tokens").over(so_far.orderBy("part")) - F.col("part_tokens")
    starts = totals.select("part", before.alias("part_start"))
    order = so_far.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "text_hash")
    within = F.sum("n_tokens").over(order) - F.col("n_tokens")
    placed = known.withColumn("within", within).join(starts, "part")
    return placed.select("doc_id", (F.col("part_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
