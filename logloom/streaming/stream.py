"""Structured Streaming: open a topic, run it end to end, keep the sink idempotent."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logloom.functions.cols import field
from logloom.operators.lookup import left_lookup
from logloom.session import cut_lineage, shared_dir

# fixed values: limits of one index request, and the trigger
MAX_ACTIONS = 15_000
MAX_BYTES = "5mb"
TRIGGER = "20 seconds"

#: Folders of a batch and outcome in the index sink.
INDEX_BUCKETS = 64

#: Shuffled bytes that one task of the sink sorts and writes, unless the session sets its own. Compact rows take ten times as much in memory.
WRITE_BYTES = "16mb"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

#: By topic: the last run that was started here and what it was started with.
_STARTED: dict[str, tuple] = {}

Transform = Callable[[DataFrame], DataFrame]


def kafka_stream(
    spark: SparkSession, topic: str, servers: str, max_offsets: int | None = None, partitions: int | None = None, **options
) -> DataFrame:
    """One topic as rows of topic, partition, offset and text value, from the earliest offset.

    ``max_offsets`` bounds a micro-batch; :data:`MAX_ACTIONS` and :data:`MAX_BYTES` are limits of one request
    to an index and belong to the options of :func:`connector_writer`.
    ``partitions`` splits the ranges of few or uneven topic partitions over at least so many tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if partitions:
        reader = reader.option("minPartitions", partitions)
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def file_stream(
    spark: SparkSession,
    path: str,
    schema=None,
    fmt: str = "text",
    max_files: int | None = None,
    max_bytes: int | str | None = None,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """A folder or glob of files as a stream; new files become new rows.

    ``max_files`` or ``max_bytes`` (such as :data:`MAX_BYTES`) bounds a micro-batch.
    ``partitions`` deals the rows of few small files out to so many tasks.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    rows = reader.load(path)
    return rows.repartition(partitions) if partitions else rows


def open_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Open ``{"kind": "kafka" | "files", ...}``; the other keys are the reader's arguments."""
    arguments = {k: v for k, v in source.items() if k != "kind"}
    return {"kafka": kafka_stream, "files": file_stream}[source["kind"]](spark, **arguments)


def write_batch(batch: DataFrame, batch_id: int, root: str, fmt: str = "parquet", max_records: int = 0) -> None:
    """Write one micro-batch below ``batch_id=N``, in folders by outcome and a bounded bucket of the index name.

    Writing the same batch again replaces its folder, so a replay changes
    nothing. ``index_name`` stays a column, so its text is kept as it is. Rows with ``reject_fields`` (values that do not
    fit the mapping) or a ``reject_reason`` (rows that a tagged decoder could not read) go to ``outcome=rejected`` in the
    same pass. The rebalance hint splits a dominant index over several files of :data:`WRITE_BYTES` and puts
    small ones together, so a task sorts and a later one reads a bounded share of the batch.
    """
    bad = F.lit(False)
    if "reject_fields" in batch.columns:
        bad = F.coalesce(F.size("reject_fields") > 0, bad)
    if "reject_reason" in batch.columns:
        bad = bad | F.col("reject_reason").isNotNull()
    outcome = F.when(bad, "rejected").otherwise("ok")
    bucket = F.pmod(F.xxhash64(F.col("index_name").cast("string")), F.lit(INDEX_BUCKETS))
    keys = [F.col("bucket"), F.col("outcome")]
    rows = batch.withColumns({"outcome": outcome, "index_name": F.col("index_name").cast("string"), "bucket": bucket}).hint("rebalance", *keys)
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy("outcome", "bucket").format(fmt)
    with _bounded_parts(batch.sparkSession):
        writer.save(f"{root}/batch_id={batch_id}")


@contextmanager
def _bounded_parts(spark: SparkSession):
    """Rebalanced parts of :data:`WRITE_BYTES`, in a session that does not say otherwise."""
    if spark.conf.get(_ADVISORY, None) is not None:
        yield
        return
    spark.conf.set(_ADVISORY, WRITE_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(_ADVISORY)


def connector_writer(fmt: str, **options) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer for an index connector; ``doc_id`` must be its id option for idempotence."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.format(fmt).mode("append").options(**options).save()

    return write


def _bases(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches up to which a complete compacted base was written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [f.getPath().getName() for f in files.listStatus(path)]
    done = [n for n in names if n.startswith("base_upto=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def _versions(spark: SparkSession, root: str, outcome: str | None = None, upto: int | None = None) -> DataFrame:
    """All stored versions of documents: the newest base and the batches after it, with ``_place`` (batch, hash of the file, row)."""
    bases = [b for b in _bases(spark, root) if upto is None or b <= upto]
    place = F.struct(F.col("batch_id").cast("bigint").alias("batch"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    reader = spark.read.options(basePath=root, mergeSchema=True)
    rows = reader.parquet(f"{root}/batch_id=*")
    names = [field(c) for c in rows.columns if c not in ("bucket",)]
    rows = rows.select(*names, place.alias("_place"))
    if upto is not None:
        rows = rows.filter(F.col("batch_id") <= upto)
    if bases:
        base = spark.read.parquet(f"{root}/base_upto={bases[-1]}")
        rows = rows.filter(F.col("batch_id") > bases[-1])
        rows = base.drop("bucket").select(*[field(c) for c in base.columns if c != "bucket"], place.alias("_place")).unionByName(rows, allowMissingColumns=True)
    return rows if outcome is None else rows.filter(F.col("outcome") == outcome)


def _newest(spark: SparkSession, versions: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of each document. Only ids and places are shuffled; ids that occur once are never joined on.

    Repeated ids are about as many as documents, so they are not repeated once per salt when they are joined back.
    """
    narrow = versions.select(*[field(k) for k in keys], "_place").dropna(subset=keys)
    repeated = narrow.groupBy(*[field(k).alias(f"r_{k}") for k in keys]).agg(F.max("_place").alias("_top"), F.count(F.lit(1)).alias("_n"))
    repeated = cut_lineage(repeated.filter("_n > 1").drop("_n"), spark, "repeated-ids")
    if repeated.limit(1).count() == 0:
        return versions.drop("_place")
    found = left_lookup(versions, repeated, keys, salts=1)
    return found.filter(F.col("_top").isNull() | (F.col("_top") == F.col("_place"))).drop("_top", "_place")


def read_index(spark: SparkSession, root: str, outcome: str = "ok") -> DataFrame:
    """Documents of the sink: of several versions of a document the one of the latest batch.

    Columns that came with a later batch are NULL in earlier documents. Repeated ids are found on (doc_id, place) alone;
    without any, whole documents are neither sorted nor shuffled.
    """
    return _newest(spark, _versions(spark, root, outcome), ["doc_id"]).drop("batch_id", "outcome")


def compact(spark: SparkSession, root: str, upto: int) -> str:
    """Write the newest versions up to batch ``upto`` as a base that later reads start from; returns its folder.

    Batches after it are untouched, and a base that was cut off is not read. The batches it holds can be removed when no
    reader uses them any more.
    """
    docs = _newest(spark, _versions(spark, root, upto=upto), ["doc_id", "outcome"])
    docs = docs.withColumn("bucket", F.pmod(F.xxhash64(F.col("index_name")), F.lit(INDEX_BUCKETS)))
    target = f"{root}/base_upto={upto}"
    with _bounded_parts(spark):
        docs.hint("rebalance", F.col("bucket"), F.col("outcome")).write.mode("overwrite").partitionBy("outcome", "bucket").parquet(target)
    return target


def start(
    stream: DataFrame,
    transform: Transform,
    root: str,
    topic: str,
    trigger: dict | None = None,
    writer: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Run ``stream`` through ``transform`` into the index sink below ``root``.

    The query carries the topic's name. Source positions are committed to the
    checkpoint only after the batch is written; a batch that fails is run again.
    """
    write = writer or (lambda batch, batch_id: write_batch(batch, batch_id, f"{root}/index"))
    query = (
        transform(stream)
        .writeStream.queryName(topic)
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
    _STARTED[topic] = str(query.runId), (stream, transform, root, topic), writer
    return query


def running(spark: SparkSession) -> dict[str, StreamingQuery]:
    """Active streams by topic."""
    return {q.name: q for q in spark.streams.active if q.name}


def stop(spark: SparkSession, topic: str) -> bool:
    """Stop the stream of a topic at once; False when none runs."""
    query = running(spark).get(topic)
    if query is None:
        return False
    query.stop()
    return True


def drain(spark: SparkSession, topic: str) -> bool:
    """Let the stream of a topic finish what has arrived by now, then stop it.

    The stream goes on from its checkpoint as a run over what is available at its start, in as many batches as the source's
    limits ask for; a batch that was cut off is run again. Later rows are not waited for. A stream that was not started
    by :func:`start` in this process runs on until no row is left.
    """
    query = running(spark).get(topic)
    if query is None:
        return False
    run_id, arguments, writer = _STARTED.get(topic, (None, None, None))
    if run_id != str(query.runId):
        query.processAllAvailable()
        query.stop()
        return True
    query.stop()
    start(*arguments, {"availableNow": True}, writer).awaitTermination()
    return True


def run_once(stream: DataFrame, transform: Transform, topic: str, root: str | None = None) -> tuple[str, StreamingQuery]:
    """Process everything that has arrived and return (sink folder, finished query)."""
    root = root or shared_dir(stream.sparkSession, topic)
    query = start(stream, transform, root, topic, {"availableNow": True})
    query.awaitTermination()
    return f"{root}/index", query


def counted(df: DataFrame, name: str, outcomes: dict) -> tuple[DataFrame, Observation]:
    """Count rows per outcome while they pass by; read the numbers from the observation after an action."""
    observation = Observation(name)
    counts = [F.count_if(c).alias(k) for k, c in outcomes.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("events"), *counts), observation


def outcome_report(df: DataFrame, kind: str, outcomes: dict) -> DataFrame:
    """Rows per (type, outcome); an event may count under several outcomes."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in outcomes.items()]))
    return df.select(field(kind).alias("type"), F.explode(hits).alias("outcome")).groupBy("type", "outcome").agg(
        F.count("*").alias("events")
    )
