"""Quota check on a stream with the use so far kept in Spark's state store.

One small value a token (bytes used and dropped) lives in the state store; a batch reads and writes the tokens it meets,
not a table of all tokens. The store needs the RocksDB provider (:data:`PROVIDER`). Only the events of one token and one
micro-batch meet in a task, so the reader's limits (``max_offsets``, ``max_files``) bound them; for streams whose batches
are not bounded use :mod:`logloom.streaming.quota_stream`, which splits a hot token over chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logloom.functions.cols import field
from logloom.operators.lookup import left_lookup

#: Value of ``spark.sql.streaming.stateStore.providerClass`` that this operator needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_USE = "used bigint, dropped bigint"


def greedy(sizes: np.ndarray, room: int) -> np.ndarray:
    """Which of the ordered sizes pass: each that still fits takes its part of the room.

    While the room stays at its highest power of two, smaller sizes pass and their sum is taken off at once; what takes
    it below ends a round, so there are no more rounds than binary digits in the room.
    """
    passed, at = np.zeros(len(sizes), bool), 0
    while at < len(sizes) and room > 0:
        bar, rest = 1 << (room.bit_length() - 1), sizes[at:]
        small = np.where(rest < bar, rest, 0)
        left = room - (np.cumsum(small) - small)
        ends = np.flatnonzero(np.where(rest < bar, left - rest < bar, rest <= left))
        stop = int(ends[0]) if len(ends) else len(rest)
        passed[at : at + stop] = rest[:stop] < bar
        if stop == len(rest):
            return passed
        passed[at + stop] = True
        room = int(left[stop] - rest[stop])
        at += stop + 1
    if room >= 0:
        passed[at:] = sizes[at:] == 0
    return passed


class _Quota(StatefulProcessor):
    def __init__(self, names: list[str], order: list[str], idle_ms: int):
        self.names, self.order, self.idle_ms = names, order, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.use = handle.getValueState("use", _USE, self.idle_ms or None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # names that begin with an underscore do not arrive as they are
        batch = pd.concat(list(rows), ignore_index=True).set_axis(self.names, axis=1).sort_values(self.order, kind="stable")
        used, dropped = self.use.get() if self.use.exists() else (0, 0)
        sizes = batch["_b"].to_numpy(np.int64)
        limit = batch["_limit"].iloc[0]
        allowed = np.ones(len(sizes), bool) if pd.isna(limit) else greedy(sizes, int(limit) - used)
        self.use.update((int(used + sizes[allowed].sum()), int(dropped + sizes[~allowed].sum())))
        yield batch.drop(columns=["_b", "_limit"]).assign(allowed=allowed)

    def close(self) -> None:
        pass


def check_stream(stream: DataFrame, quotas: DataFrame, order: list[str], token: str = "token", size: str = "bytes", idle_ms: int = 0) -> DataFrame:
    """Add ``allowed`` to every event of a stream, in the order of ``order`` inside a micro-batch.

    ``quotas`` is static: user_id, limits and current_usage (the use before the stream began). An unknown token is always
    allowed, its bytes are counted; a missing size counts as 0; events without a token count as one token. After
    ``idle_ms`` without events a token's use is forgotten (0: never).
    """
    room = quotas.select(F.col("user_id").alias("r__token"), (F.col("limits") - F.col("current_usage")).alias("_limit"))
    sized = stream.withColumns({"_token": field(token), "_b": F.coalesce(field(size).cast("bigint"), F.lit(0))})
    sized = left_lookup(sized, room, ["_token"])
    kind = T.StructType([*stream.schema.fields, T.StructField("allowed", T.BooleanType())])
    return (
        sized.groupBy("_token")
        .transformWithStateInPandas(_Quota(sized.columns, order, idle_ms), outputStructType=kind, outputMode="append", timeMode="ProcessingTime" if idle_ms else "none")
        .select(*[f.name for f in kind])
    )


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``token, used, dropped`` as the state store of a checkpoint holds them after its last batch."""
    found = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "use").load()
    return found.select(F.col("key").getField("_token").alias("token"), "value.used", "value.dropped")
