"""Quota check on a stream, with the use so far kept as a table per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.operators.quota import check_quota
from logloom.operators.refdata import usage_totals

_USAGE = "user_id string, used bigint, dropped bigint, reported bigint, reported_drop bigint"

Report = Callable[[DataFrame, int], None]


def read_usage(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """Bytes used and reported per token after ``batch_id``; empty before the first batch."""
    if batch_id < 0:
        return spark.createDataFrame([], _USAGE)
    return spark.read.schema(_USAGE).parquet(f"{root}/usage/batch_id={batch_id}")


def quota_writer(
    quotas: DataFrame | Callable[[], DataFrame],
    root: str,
    order: list[str],
    token: str = "token",
    size: str = "bytes",
    report: Report | None = None,
):
    """``foreachBatch`` writer that flags each event ``allowed`` and stores it and the new totals.

    ``report`` gets the change (token, usage, drop) since the last report and the batch id after every batch, to add it
    to the stored totals; a batch that is run again reports the same change again. What was reported is part of
    ``current_usage`` from then on and does not count twice. ``quotas`` may be a function that reads them anew.

    Batch N starts from the totals of batch N-1 and writes its own, so running it
    again gives the same result. No state is held in tasks; a hot token is
    handled like in the batch check.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        usage = read_usage(spark, root, batch_id - 1)
        open_use = F.coalesce(F.col("used") - F.col("reported"), F.lit(0))
        limits = quotas() if callable(quotas) else quotas
        current = limits.join(usage, "user_id", "left").select(
            "user_id", "limits", (F.col("current_usage") + open_use).alias("current_usage")
        )
        target = f"{root}/events/batch_id={batch_id}"
        flagged = T.StructType([*batch.schema.fields, T.StructField("allowed", T.BooleanType())])
        check_quota(batch, current, order, token, size).write.mode("overwrite").parquet(target)
        checked = spark.read.schema(flagged).parquet(target)
        new = usage_totals(checked, token, size).select(
            F.col("token").alias("user_id"), F.col("usage").alias("used"), F.col("drop").alias("dropped"),
            F.lit(0).alias("reported"), F.lit(0).alias("reported_drop"),
        )
        counts = ["used", "dropped", "reported", "reported_drop"]
        total = usage.unionByName(new).groupBy("user_id").agg(*[F.sum(c).alias(c) for c in counts])
        if report is not None:
            used, drop = F.col("used") - F.col("reported"), F.col("dropped") - F.col("reported_drop")
            change = total.select(F.col("user_id").alias("token"), used.alias("usage"), drop.alias("drop"))
            report(change.filter("token != '' AND (usage != 0 OR drop != 0)"), batch_id)
            total = total.withColumns({"reported": F.col("used"), "reported_drop": F.col("dropped")})
        total.write.mode("overwrite").parquet(f"{root}/usage/batch_id={batch_id}")

    return write
