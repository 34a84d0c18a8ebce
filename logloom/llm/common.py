"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from logloom.session import shared_dir

#: Characters of text that one Python step works on; bounds memory, not results.
CHUNK_CHARS = 1_500_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: survives lost executors, evaluated once."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_file(spark: SparkSession, data: bytes, name: str) -> str:
    """Put a small file into the shared folder and have every executor fetch a copy; returns its name for ``SparkFiles.get``."""
    sc = spark.sparkContext
    unique = f"{uuid.uuid4().hex}-{name}"
    target = f"{shared_dir(spark, 'file')}/{unique}"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    sc.addFile(target)
    return unique


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``fn`` gets column lists of one Arrow batch at a time and yields column lists."""
    kind: StructType = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        for out in fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


_KEPT: dict[str, Callable[[], None]] = {}


def claim(owner: str, clear: Callable[[], None] = lambda: None) -> None:
    """Called by an operator in a worker process that is used again: frees what other operators keep there."""
    for other in [k for k in _KEPT if k != owner]:
        _KEPT.pop(other)()
    _KEPT[owner] = clear


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` characters; a longer text is a range of its own."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        if i > at and size + len(text) > limit:
            yield at, i
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield at, len(texts)
