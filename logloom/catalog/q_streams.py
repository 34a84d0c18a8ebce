"""Streaming runs over the events table, the index sink, dead letters and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.catalog import lines, q_ingest, q_sources
from logloom.catalog.lines import with_events
from logloom.catalog.q_refdata import _CHECK_SQL, limits
from logloom.catalog.q_sources import event_stream
from logloom.catalog.registry import query, table
from logloom.functions import rotation
from logloom.operators import json_fields, mapping, xml_fields
from logloom.operators.geo import ranges_from_longs
from logloom.operators.grok import extract
from logloom.session import shared_dir
from logloom.sources import decode
from logloom.streaming import counters, quota_state, quota_stream, stream

_KIND = "apache_access"


@query("stream_end_to_end", q_ingest.oracle(_KIND))
def stream_end_to_end(spark, sf_dir):
    """The ingest of web access lines as a stream into the index sink, read back."""
    ranges = ranges_from_longs(lines.geo_ranges(spark, sf_dir))
    source = event_stream(spark, sf_dir, spark.sparkContext.defaultParallelism)
    sink, _ = stream.run_once(source, lambda df: q_ingest.documents(lines.derived(df), ranges, _KIND), "end-to-end")
    return q_ingest.shown(stream.read_index(spark, sink), _KIND)


def _typed(df):
    """Documents with their declared types; every fifteenth holds a value that does not fit."""
    ev = lines.derived(df)
    docs = ev.select(
        "event_id",
        F.concat(F.lit("logs."), F.col("event_id").cast("string")).alias("doc_id"),
        rotation.index_name(F.col("token"), F.col("event_type")).alias("index_name"),
        F.when(F.col("event_id") % 15 == 0, "n/a").otherwise(F.col("status")).alias("response"),
        "clientip",
    )
    return mapping.apply_mapping(docs, mapping.ACCESS_MAPPING)


@query(
    "sink_index",
    with_events("SELECT concat(event_id % 8, '.', event_id % 4, '0') AS index_name, count(*) AS docs, CAST(sum(status::bigint) AS bigint) AS responses, "
        "count(*) FILTER (event_id % 2 = 0) AS late FROM ev WHERE event_id % 15 <> 0 GROUP BY 1"),
)
def sink_index(spark, sf_dir):
    """The same batch written twice, then half of it under a later number with one more column, still is one set of documents.

    The index names look like numbers and must come back as they are.
    """
    root = shared_dir(spark, "sink")
    at = F.col("event_id")
    name = F.concat((at % 8).cast("string"), F.lit("."), (at % 4).cast("string"), F.lit("0"))
    batch = _typed(table(spark, sf_dir, "events")).withColumn("index_name", name)
    stream.write_batch(batch, 0, root)
    stream.write_batch(batch, 0, root)
    stream.write_batch(batch.filter("event_id % 2 = 0").withColumn("late", F.lit(True)), 1, root)
    docs = stream.read_index(spark, root)
    return docs.groupBy("index_name").agg(F.count("*").alias("docs"), F.sum("response").alias("responses"), F.count_if(F.col("late")).alias("late"))


@query(
    "sink_dead_letter",
    "SELECT event_id, CASE WHEN event_id % 45 = 0 THEN 'empty' WHEN event_id % 15 = 0 THEN 'malformed JSON' END AS reason, "
    "CASE WHEN event_id % 15 <> 0 THEN 'upload_type' END AS field, CASE WHEN event_id % 15 <> 0 THEN 'streaming' END AS field_raw, "
    "event_id % 15 = 0 AND event_id % 45 <> 0 AS has_raw FROM events WHERE event_id % 15 = 0 OR event_id % 4 = 0",
)
def sink_dead_letter(spark, sf_dir):
    """A stream whose rejects are rows that could not be decoded and rows with a value that does not fit, written in one pass."""

    def docs(df):
        sent = q_sources.broken_beats(lines.derived(df))
        out = decode.doc_id(decode.beat(sent, now=lines.NOW, tagged=True))
        # every fourth document declares a field as a number that is none
        out = out.withColumns({"index_name": F.lit("logs"), "upload_type": F.when(F.col("event_id") % 4 == 0, F.col("upload_type"))})
        return mapping.apply_mapping(out, {"upload_type": "integer"})

    sink, _ = stream.run_once(event_stream(spark, sf_dir), docs, "dead-letter")
    rows = stream.read_index(spark, sink, "rejected")
    raw = F.element_at("reject_fields_raw", "upload_type")
    decoded = F.col("reject_reason").isNull()
    return rows.select(
        "event_id",
        F.col("reject_reason").alias("reason"),
        F.when(decoded, F.array_join("reject_fields", ",")).alias("field"),
        F.when(decoded, raw).alias("field_raw"),
        F.coalesce(F.length("raw") > 0, F.lit(False)).alias("has_raw"),
    )


@query("stream_control", "SELECT event_type AS type, count(*) AS events, true AS ran, false AS runs FROM events GROUP BY event_type")
def stream_control(spark, sf_dir):
    """Start a stream by topic, drain and stop it, and look at what it wrote."""
    root, topic = shared_dir(spark, "control"), "control-" + shared_dir(spark, "t")[-8:]

    def docs(df):
        return df.select("event_type", F.col("event_id").alias("doc_id"), F.lit("all").alias("index_name"))

    stream.start(event_stream(spark, sf_dir), docs, root, topic, {"processingTime": "0 seconds"})
    ran = topic in stream.running(spark)
    stream.drain(spark, topic)
    runs = topic in stream.running(spark) or stream.stop(spark, topic)
    counts = stream.read_index(spark, f"{root}/index").groupBy(F.col("event_type").alias("type")).agg(F.count("*").alias("events"))
    return counts.select("*", F.lit(ran).alias("ran"), F.lit(runs).alias("runs"))


@query("stream_limits", "SELECT event_id % 4 AS part, count(*) AS events, 1 AS batches, 4 AS all_batches FROM events GROUP BY event_id % 4")
def stream_limits(spark, sf_dir):
    """A limit of one file a micro-batch: each file of the table comes in a batch of its own."""
    root = shared_dir(spark, "limits")
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 4).alias("part"))
    for part in range(4):
        rows.filter(F.col("part") == part).coalesce(1).write.parquet(f"{root}/in/{part}")
    source = stream.file_stream(spark, f"{root}/in/*", rows.schema, "parquet", max_files=1)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    stream.start(source, lambda df: df, root, f"limits-{root[-12:]}", {"availableNow": True}, write).awaitTermination()
    found = spark.read.parquet(f"{root}/out").groupBy("part").agg(F.count("*").alias("events"), F.countDistinct("batch_id").cast("int").alias("batches"))
    return found.withColumn("all_batches", F.lit(spark.read.parquet(f"{root}/out").select("batch_id").distinct().count()))


@query("sink_connector", "SELECT event_type AS type, count(*) AS events, CAST(sum(event_id) AS bigint) AS ids FROM events GROUP BY event_type")
def sink_connector(spark, sf_dir):
    """The other sink: batches go to a pluggable format with its own options, here one of the built-in file formats."""
    root = shared_dir(spark, "connector")
    docs = event_stream(spark, sf_dir).select("event_id", "event_type")
    write = stream.connector_writer("json", path=f"{root}/out", compression="gzip")
    stream.start(docs, lambda df: df, root, f"connector-{root[-12:]}", {"availableNow": True}, write).awaitTermination()
    rows = spark.read.schema("event_id bigint, event_type string").json(f"{root}/out")
    return rows.groupBy(F.col("event_type").alias("type")).agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query("quota_stream", _CHECK_SQL)
def quota_stream_check(spark, sf_dir):
    """The quota check as a stream with its use kept per batch."""
    root = shared_dir(spark, "quota-stream")
    sized = event_stream(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("user_id") % 40).cast("string"))).alias("token"),
        F.floor("value").cast("bigint").alias("bytes"),
    )
    writer = quota_stream.quota_writer(limits(spark, sf_dir), root, ["event_id"])
    stream.start(sized, lambda df: df, root, f"quota-{root[-12:]}", {"availableNow": True}, writer).awaitTermination()
    return spark.read.parquet(f"{root}/events/batch_id=*")


@query("quota_stream_state", _CHECK_SQL)
def quota_stream_state(spark, sf_dir):
    """The quota check as a stream with the use of each token in the state store."""
    root = shared_dir(spark, "quota-state")
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    sized = event_stream(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("user_id") % 40).cast("string"))).alias("token"),
        F.floor("value").cast("bigint").alias("bytes"),
    )
    checked = quota_state.check_stream(sized, limits(spark, sf_dir), ["event_id"])

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/events/batch_id={batch_id}")

    spark.conf.set(setting, quota_state.PROVIDER)
    try:
        stream.start(checked, lambda df: df, root, shared_dir(spark, "quota-state")[-12:], {"availableNow": True}, write).awaitTermination()
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema("event_id bigint, token string, bytes bigint, allowed boolean").parquet(f"{root}/events/batch_id=*")


@query(
    "stream_counters",
    "SELECT unnest(['events', 'decode_fail', 'decode_ok', 'sink_reject', 'usage_drop', 'sink_success']) AS outcome, unnest([count(*), "
    "count(*) FILTER (event_id % 15 = 0), count(*) FILTER (event_id % 15 <> 0), count(*) FILTER (event_id % 4 = 0), "
    "count(*) FILTER (floor(value) > 50), count(*) FILTER (event_id % 15 <> 0 AND event_id % 4 <> 0 AND floor(value) <= 50)]) AS events FROM events",
)
def stream_counters(spark, sf_dir):
    """Outcomes of a stream that is stopped after half of its files and started again, with batches that are run twice."""
    root = shared_dir(spark, "counters")
    rows = table(spark, sf_dir, "events")
    # a batch is one file, which Spark may read in one task
    source = stream.file_stream(spark, f"{root}/in/*", rows.schema, "parquet", max_files=1, partitions=spark.sparkContext.defaultParallelism)

    def transform(df):
        sent = q_sources.broken_beats(lines.derived(df).withColumn("kept", F.floor("value") <= 50), keep=["kept"])
        out = decode.doc_id(decode.beat(sent, now=lines.NOW, tagged=True)).withColumnRenamed("kept", "allowed")
        out = out.withColumns({"index_name": F.lit("logs"), "upload_type": F.when(F.col("event_id") % 4 == 0, F.col("upload_type"))})
        return mapping.apply_mapping(out, {"upload_type": "integer"})

    write = counters.counting(lambda batch, batch_id: stream.write_batch(batch, batch_id, f"{root}/index"), root)

    def twice(batch, batch_id):
        write(batch, batch_id)
        if batch_id % 2:
            write(batch, batch_id)

    for part in (0, 1):
        half = rows.filter(F.col("event_id") % 2 == part)
        half.repartitionByRange(2, "event_id").write.parquet(f"{root}/in/{part}")
        topic = f"counters-{root[-8:]}-{part}"
        stream.start(source, transform, root, topic, {"availableNow": True}, twice).awaitTermination()
    return counters.read_counters(spark, root)


_COUNTS_SQL = with_events(
    "SELECT type, outcome, count(*) AS events FROM (SELECT event_type AS type, unnest(list_filter(["
    "CASE WHEN event_id % 15 = 0 THEN 'decode_fail' END, CASE WHEN event_id % 15 <> 0 THEN 'decode_ok' END, "
    "CASE WHEN NOT is_line THEN 'pattern_fail' END, CASE WHEN is_line THEN 'pattern_ok' END, "
    "CASE WHEN event_id % 12 = 0 THEN 'json_parse_error' END, CASE WHEN event_id % 12 <> 0 AND event_id % 5 = 0 THEN 'json_path_missing' END, "
    "CASE WHEN event_id % 14 = 0 THEN 'xml_parse_error' END], lambda x: x IS NOT NULL)) AS outcome FROM ev) GROUP BY type, outcome"
)


@query("quality_metrics", _COUNTS_SQL)
def quality_metrics(spark, sf_dir):
    """Events per type and outcome of decoding, pattern matching, JSON and XML parsing."""
    ev = lines.events(spark, sf_dir)
    at = F.col("event_id")
    json_text = F.when(at % 12 == 0, "{broken").when(at % 5 == 0, '{"other": 1}').otherwise(F.col("props"))
    ev = ev.select(
        F.col("event_type").alias("kind"),
        F.when(at % 15 == 0, '{"type":').otherwise(F.to_json(F.struct("token"))).alias("sent"),
        lines.access_message().alias("message"),
        json_text.alias("json"),
        F.when(at % 28 == 0, "<e/>junk").when(at % 14 == 0, "<e>").otherwise("<e/>").alias("xml"),
    )
    ev = extract(ev, "message", _KIND)
    decoded = F.from_json("sent", "map<string,string>").isNotNull()
    outcomes = {
        "decode_fail": ~decoded,
        "decode_ok": decoded,
        "pattern_fail": F.col("clientip").isNull(),
        "pattern_ok": F.col("clientip").isNotNull(),
        "json_parse_error": json_fields.parse_failed(F.col("json")),
        "json_path_missing": json_fields.path_missing(json_fields.parsed(F.col("json")), "$.k"),
        "xml_parse_error": ~xml_fields.well_formed("xml"),
    }
    return stream.outcome_report(ev, "kind", outcomes)
