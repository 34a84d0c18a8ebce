"""Event counters of a running stream.

Outcomes are counted by ``observe`` while the rows of a micro-batch pass to the sink, so counting reads nothing again. The
numbers of a batch are one small file named by its id, written before the batch is committed: a batch that is run again
replaces its file, and a restart goes on counting where the stream goes on. :class:`LiveCounters` adds up the numbers of
micro-batches as they end, for watching a stream from the outside.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

Writer = Callable[[DataFrame, int], None]

#: Outcomes of the rows that reach the index sink; ``allowed`` is the verdict of a quota check.
SINK_OUTCOMES: dict[str, Callable[[set], Column | None]] = {
    "decode_fail": lambda names: F.col("reject_reason").isNotNull() if "reject_reason" in names else None,
    "decode_ok": lambda names: F.col("reject_reason").isNull() if "reject_reason" in names else None,
    "sink_reject": lambda names: F.size("reject_fields") > 0 if "reject_fields" in names else None,
    "usage_drop": lambda names: ~F.col("allowed") if "allowed" in names else None,
}


def sink_outcomes(columns: list[str]) -> dict[str, Column]:
    """The outcomes that rows with these columns can have; rows without any of the bad ones are ``sink_success``."""
    found = {k: c for k, make in SINK_OUTCOMES.items() if (c := make(set(columns))) is not None}
    bad = [F.coalesce(c, F.lit(False)) for k, c in found.items() if k != "decode_ok"]
    good = F.lit(True)
    for c in bad:
        good = good & ~c
    return {**found, "sink_success": good}


def _metrics(outcomes: Mapping[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("events"), *[F.count_if(c).alias(k) for k, c in outcomes.items()]]


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file through the cluster's file system, replacing what is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def counting(write: Writer, root: str, outcomes: Mapping[str, Column] | Callable[[list[str]], Mapping[str, Column]] = sink_outcomes) -> Writer:
    """``foreachBatch`` writer that counts the outcomes of the rows while ``write`` stores them in one action.

    ``outcomes`` names conditions, or makes them from the column names. A batch that fails leaves no numbers.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        named = outcomes(batch.columns) if callable(outcomes) else outcomes
        write(batch.observe(seen, *_metrics(named)), batch_id)
        numbers = [{"batch_id": batch_id, "outcome": k, "events": v} for k, v in seen.get.items()]
        _put(batch.sparkSession, f"{root}/counters/{batch_id:012d}.json", "\n".join(map(json.dumps, numbers)))

    return run


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """``outcome, events`` over all batches of all runs; outcomes that never occurred count 0."""
    rows = spark.read.schema("batch_id bigint, outcome string, events bigint").json(f"{root}/counters")
    return rows.groupBy("outcome").agg(F.sum("events").alias("events"))


def observed(stream: DataFrame, name: str, outcomes: Mapping[str, Column]) -> DataFrame:
    """Have a stream report its outcomes under ``name`` with every micro-batch, for :class:`LiveCounters`."""
    return stream.observe(name, *_metrics(outcomes))


class LiveCounters(StreamingQueryListener):
    """Adds up what :func:`observed` streams report. Register it with ``spark.streams.addListener``.

    ``totals[(topic, name)]`` counts the micro-batches since the listener was added; a batch that is reported twice
    counts once. ``open`` names the topics that run.
    """

    def __init__(self):
        self.totals: dict[tuple[str, str], Counter] = {}
        self.open: dict[str, str] = {}
        self._last: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.open[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        key = str(progress.id)
        if progress.batchId <= self._last.get(key, -1):
            return
        for name, row in progress.observedMetrics.items():
            self.totals.setdefault((progress.name, name), Counter()).update(row.asDict())
        if progress.numInputRows:
            self._last[key] = progress.batchId

    def onQueryTerminated(self, event) -> None:
        self.open.pop(str(event.runId), None)
