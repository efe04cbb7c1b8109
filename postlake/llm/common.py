"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import shared_dir

#: Words of most contracts: runs of anything but ASCII white space, which is
#: how ``bytes.split`` divides UTF-8.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

#: Rows of one Arrow batch are handled in slices of about this many bytes of
#: text, so the working arrays of a task stay bounded.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns the reread table.

    This cuts the lineage durably: a lost executor costs no recomputation of
    what lies before, and later readers share one computation.
    """
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``mapInArrow`` over slices of rows; ``fn`` gets tuples, yields tuples."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = list(fn(list(zip(*(c.to_pylist() for c in part.columns), strict=True))))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, out, strict=True)], schema=out)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``SLICE_BYTES`` each (one row at least)."""
    if not batch.num_rows:
        return
    step = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def ascii_lower(col):
    """A-Z to a-z, all else unchanged."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)
