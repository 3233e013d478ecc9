"""Helpers the operators share: shared-folder tables, row keys and Arrow passes over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from fleetlens.session import work_dir

ARROW_ROWS = 2000
# A bitmap has 2^BITMAP_BITS bits (2 MB) however many values it stands for; more values only let more rows
# through to the exact join that follows.
BITMAP_BITS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back, which cuts its lineage
    and lets a lost executor cost a reread only."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows, and with them the bytes, that a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def map_arrow(
    df: DataFrame, run: Callable[[pa.RecordBatch], dict | None], schema: str
) -> DataFrame:
    """Apply a function of one record batch to a dict of columns; None yields no rows."""
    small_batches(df.sparkSession)
    types = {f.name: to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields}

    def column(values, kind: pa.DataType) -> pa.Array:
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = run(batch) if batch.num_rows else None
            if out:
                arrays = [column(out[name], kind) for name, kind in types.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=list(types))

    return df.mapInArrow(each, schema)


def bucket_of(column: Column, modulus: int) -> Column:
    """crc32 of a value's text, modulo; a null value counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(*columns: Column) -> Column:
    """A key for a row's values, equal for repeated rows; nulls count as values."""
    parts = [F.coalesce(c.cast("string"), F.lit("\0")) for c in columns]
    return F.md5(F.concat_ws("\1", *parts).cast("binary"))


def bitmap(hashes: DataFrame, name: str) -> np.ndarray:
    """A bit for the leading bits of each 64-bit hash, gathered by Spark's bitmap aggregation: at most
    2^BITMAP_BITS bits reach the driver."""
    place = F.shiftrightunsigned(name, 64 - BITMAP_BITS) + 1
    cells = hashes.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    cells = cells.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(1 << BITMAP_BITS, dtype=bool)
    for bucket, bits in cells.toLocalIterator():
        # Bit i of bucket k, which counts from 1, stands for the value (k - 1) * bits + i + 1.
        flags = np.unpackbits(np.frombuffer(bytes(bits), np.uint8), bitorder="little")
        out[(bucket - 1) * len(flags) : bucket * len(flags)] = flags
    return np.packbits(out)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes.astype(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return ((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(bool)
