"""Sources and decoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.catalog import lines
from logloom.catalog.lines import with_events
from logloom.catalog.registry import query, table
from logloom.session import shared_dir
from logloom.sources import decode
from logloom.streaming import stream


def _beats(spark, sf_dir):
    ev = lines.events(spark, sf_dir)
    return lines.transported(ev, lines.beat_json(lines.access_message(), F.lit("apache_access")))


@query(
    "decode_beat_json",
    with_events(
        "SELECT event_id, epoch_us(ts) // 1000 AS timestamp, concat('host', user_id % 7) AS hostname, '5.1.1' AS version, "
        "CASE WHEN event_id % 23 <> 0 THEN token END AS field_token, concat('z', user_id % 3) AS field_zone, 'log' AS input_type, "
        "event_id * 100 AS file_offset, concat('/var/log/', event_type, '.log') AS source, "
        "CASE WHEN event_id % 29 <> 0 THEN concat('t1,', event_type) END AS tags, "
        "CASE WHEN event_id % 37 <> 0 THEN 'apache_access' END AS type FROM ev"
    ),
)
def decode_beat_json(spark, sf_dir):
    out = decode.beat_json(_beats(spark, sf_dir))
    return out.select(
        "event_id", "timestamp", "beat.hostname", "beat.version",
        F.element_at("fields", "token").alias("field_token"), F.element_at("fields", "zone").alias("field_zone"),
        "input_type", "file_offset", "source",
        F.when(F.col("tags").isNotNull(), F.array_join("tags", ",")).alias("tags"), "type",
    )


@query(
    "decode_beat_basic",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 23 <> 0 THEN token ELSE '_unknown_' END AS token, "
        "CASE WHEN event_id % 37 <> 0 THEN 'apache_access' ELSE '_unknown_' END AS type, "
        "CASE WHEN event_id % 29 <> 0 THEN concat('t1,', event_type) ELSE '' END AS tags, "
        "event_id % 31 = 0 AS no_message, 'streaming' AS upload_type, epoch_us(ts) // 1000 AS upload_timestamp FROM ev"
    ),
)
def decode_beat_basic(spark, sf_dir):
    out = decode.beat(_beats(spark, sf_dir), now=lines.NOW)
    return out.select(
        "event_id", "token", "type", F.array_join("tags", ",").alias("tags"), (F.col("message") == "_").alias("no_message"),
        "upload_type", "upload_timestamp",
    )


def broken_beats(df, every=15, keep=()):
    """Shipper JSON of web access lines; every fifteenth is cut short, every forty-fifth is empty."""
    sent = lines.transported(df, lines.beat_json(lines.access_message(), F.lit("apache_access")), keep)
    cut = F.substr("value", F.lit(1), F.length("value") - 3)
    at = F.col("event_id")
    return sent.withColumn("value", F.when(at % (3 * every) == 0, "").when(at % every == 0, cut).otherwise(F.col("value")))


@query(
    "decode_beat_rejects",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 45 = 0 THEN 'empty' WHEN event_id % 15 = 0 THEN 'malformed JSON' END AS reason, "
        "event_id % 15 = 0 AND event_id % 45 <> 0 AS same_text, event_id % 15 <> 0 AND event_id % 37 <> 0 AS typed FROM ev"
    ),
)
def decode_beat_rejects(spark, sf_dir):
    """Rows cut short: kept as unknown events with their raw text, and tagged with a reason in the same pass."""
    out = decode.beat(broken_beats(lines.events(spark, sf_dir)), now=lines.NOW, tagged=True)
    same = F.coalesce(F.col("raw") == F.col("message"), F.lit(False))
    return out.select("event_id", F.col("reject_reason").alias("reason"), same.alias("same_text"), (F.col("type") != "_unknown_").alias("typed"))


@query("doc_id", with_events("SELECT event_id, concat('logs.', user_id % 4, '.', event_id) AS doc_id FROM ev"))
def doc_id(spark, sf_dir):
    return decode.doc_id(_beats(spark, sf_dir)).select("event_id", "doc_id")


def _turns(spark, sf_dir):
    """Delimited lines of all conversation turns; every seventh lacks a body, every eleventh a full header."""
    text = F.regexp_replace("text", r"\s+", " ")
    key = F.col("conv_id") + F.col("turn")
    head = F.concat_ws(" ", F.concat(F.lit("c"), F.col("conv_id")), F.col("role"), F.concat(F.lit("a,t"), F.col("turn")), F.lit("file"))
    line = (
        F.when(key % 7 == 0, F.concat(F.lit("no body "), F.col("conv_id")))
        .when(key % 11 == 0, F.concat(F.lit("short "), F.col("role"), F.lit(" || "), text))
        .otherwise(F.concat(head, F.lit(" || "), text))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", line.alias("value"))


@query(
    "decode_delimited_line",
    r"SELECT conv_id, turn, concat('c', conv_id) AS token, role AS type, concat('a|t', turn) AS tags, 'file' AS upload_type, "
    r"regexp_replace(text, '\s+', ' ', 'g') AS message FROM conversations WHERE (conv_id + turn) % 7 <> 0 AND (conv_id + turn) % 11 <> 0",
)
def decode_delimited_line(spark, sf_dir):
    out = decode.delimited_line(_turns(spark, sf_dir), now=lines.NOW)
    return out.select("conv_id", "turn", "token", "type", F.array_join("tags", "|").alias("tags"), "upload_type", "message")


@query(
    "decode_rejects",
    r"SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 7 = 0 THEN concat('no body ', conv_id) "
    r"ELSE concat('short ', role, ' || ', regexp_replace(text, '\s+', ' ', 'g')) END AS raw, "
    "CASE WHEN (conv_id + turn) % 7 = 0 THEN 'no body' ELSE 'short header' END AS reject_reason "
    "FROM conversations WHERE (conv_id + turn) % 7 = 0 OR (conv_id + turn) % 11 = 0",
)
def decode_rejects(spark, sf_dir):
    return decode.delimited_rejects(_turns(spark, sf_dir))


@query(
    "decode_raw_line",
    f"SELECT page_id, 'tok' AS token, 'url' AS type, 'a,b' AS tags, url AS message, 'file' AS upload_type, "
    f"cast({lines.NOW} AS bigint) AS upload_timestamp FROM pages",
)
def decode_raw_line(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("value"))
    out = decode.raw_line(pages, "tok", "url", ["a", "b"], "file", now=lines.NOW)
    return out.withColumn("tags", F.array_join("tags", ","))


def _flat(spark, sf_dir):
    """Flat JSON of all events; every fifteenth is cut short."""
    ev = lines.events(spark, sf_dir)
    stamp = F.when(F.col("event_id") % 4 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    body = F.to_json(
        F.struct(
            stamp.alias("@timestamp"), F.when(F.col("event_id") % 3 != 0, F.col("token")).alias("token"),
            F.col("event_type").alias("type"), F.col("request").alias("message"), F.col("user_id").alias("uid"),
        )
    )
    value = F.when(F.col("event_id") % 15 == 0, F.substr(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    return ev.select("event_id", value.alias("value"))


@query(
    "decode_flat_json",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN token ELSE '' END AS token, event_type AS type, request AS message, "
        f"CASE WHEN event_id % 4 <> 0 THEN epoch_us(ts) // 1000 ELSE {lines.NOW} END AS upload_timestamp, "
        "cast(user_id AS varchar) AS uid FROM ev WHERE event_id % 15 <> 0"
    ),
)
def decode_flat_json(spark, sf_dir):
    out = decode.flat_json(_flat(spark, sf_dir), now=lines.NOW)
    return out.select("event_id", "token", "type", "message", "upload_timestamp", F.element_at("fields", "uid").alias("uid"))


@query(
    "decode_flat_rejects",
    with_events(
        "SELECT event_id, event_id % 15 = 0 AS rejected, CASE WHEN event_id % 15 = 0 THEN concat('{', CASE WHEN event_id % 4 <> 0 THEN "
        "concat('\"@timestamp\":\"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), 'Z\",') ELSE '' END, CASE WHEN event_id % 3 <> 0 THEN concat('\"token\":\"', token, '\",') "
        "ELSE '' END, '\"type\":\"', event_type, '\",\"message\":\"', request, '\",\"uid\":', user_id) END AS raw FROM ev"
    ),
)
def decode_flat_rejects(spark, sf_dir):
    """Both sides of a tagged decode: what could not be read comes with its text."""
    out = decode.flat_json(_flat(spark, sf_dir), now=lines.NOW, tagged=True)
    return out.select("event_id", F.col("reject_reason").isNotNull().alias("rejected"), "raw")


def event_stream(spark, sf_dir, partitions=None):
    """The whole ``events`` table as a file stream (the glob also fits a single file)."""
    schema = table(spark, sf_dir, "events").schema
    source = {"kind": "files", "path": f"{sf_dir}/events.parque[t]", "schema": schema, "fmt": "parquet", "partitions": partitions}
    return stream.open_stream(spark, source)


@query("src_event_stream", "SELECT event_id, user_id, event_type, props FROM events")
def src_event_stream(spark, sf_dir):
    root = shared_dir(spark, "event-stream")
    (
        event_stream(spark, sf_dir)
        .select("event_id", "user_id", "event_type", "props")
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out")
