"""Reference tables: files or a database, read in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 1,
    **options,
) -> DataFrame:
    """A table from files, or with ``fmt="jdbc"`` from the database at URL ``location`` (``dbtable`` in options).

    A database table is read by ``parts`` tasks when a numeric ``key`` and its bounds are given.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt != "jdbc":
        return reader.load(location)
    reader = reader.option("url", location)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()
