"""What the operators share: whole texts in, Arrow passes of bounded size, scratch tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyline.session import scratch_dir

#: Rows an Arrow pass holds as Python objects at once.
SLICE_ROWS = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row, a null text as an empty one; other columns are left out of the scan."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def per_slice(df: DataFrame, schema: str, fn: Callable[[dict[str, list]], dict[str, list]],
              rows: int = SLICE_ROWS) -> DataFrame:
    """Apply ``fn`` to slices of at most ``rows`` rows: columns as lists in, columns as lists out."""
    out_schema = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_schema)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield pa.RecordBatch.from_pydict(fn(batch.slice(start, rows).to_pydict()), schema=arrow)

    return df.mapInArrow(run, out_schema)


def per_partition(df: DataFrame, schema: str, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
                  rows: int = SLICE_ROWS) -> DataFrame:
    """As ``per_slice``, for functions that carry something from slice to slice."""
    out_schema = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_schema)
        slices = (b.slice(k, rows).to_pydict() for b in batches for k in range(0, b.num_rows, rows))
        for out in fn(slices):
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, out_schema)


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: short lineage, one evaluation.

    A lost executor costs nothing that was saved; the files stay until the folder is cleaned.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; rows without an id count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@cache
def tokenizer(path: str):
    """The tokenizer of a file, loaded once in each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made
