"""Helpers shared by the text operators."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide import session

#: Texts travel to Python in batches of so many rows, so that a batch of very
#: long texts still fits a worker.
ROWS_PER_BATCH = 256


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


@functools.cache
def _own_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"revtide-{application_id}-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; where a session names none, as in tests, in one of ours."""
    if not session.scratch_base(spark):
        spark.conf.set(session.SCRATCH, _own_folder(spark.sparkContext.applicationId))
    return session.scratch_dir(spark, label)


def stored(rows: DataFrame, label: str, **options: str) -> DataFrame:
    """``rows`` written to the shared scratch folder and read again.

    It cuts the lineage: what follows reads files that outlive any executor.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, label)
    rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by name, whatever characters the names have."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def utf8(column: str) -> Column:
    """The bytes of a text column, null kept."""
    return F.col(column).cast("string").cast("binary")


def row_hash(rows: DataFrame, seed: int = 0) -> Column:
    """Hash of all columns of a row; rows alike in everything have the same."""
    values = []
    for field in rows.schema.fields:
        (value,) = quoted([field.name])
        hashable = not any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
        values.append(value if hashable else F.to_json(F.struct(value)))
    return F.xxhash64(F.lit(seed), *values)


def table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def with_columns(batch: pa.RecordBatch, keep: Iterable[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The kept columns of a batch and the new ones after them."""
    arrays = [batch.column(batch.schema.get_field_index(k)) for k in keep]
    return pa.RecordBatch.from_arrays([*arrays, *new.values()], names=[*keep, *new])


def pieces(values: list, size: int) -> Iterator[list]:
    for start in range(0, len(values), size):
        yield values[start : start + size]
