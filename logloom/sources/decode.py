"""Decoders: raw transport rows to the event envelope.

All are projections of their input, so they run unchanged on batch and
streaming frames. Envelope: token, type, tags, message, upload_type,
upload_timestamp.

With ``tagged`` a decoder keeps every row and adds ``reject_reason`` (NULL where the row is fine) and ``raw`` (the
transported text of a row that is not). So a malformed row travels through the same plan as the others and the sink
writes both sides in one pass over the input; :func:`accepted` and :func:`rejects` are filters on that one output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import field, nz
from logloom.functions.dates import now_millis, parse_first, strict_utc_millis
from logloom.operators.split_kv import split_parts

UNKNOWN = "_unknown_"
ENVELOPE = ("token", "type", "tags", "message", "upload_type", "upload_timestamp")

# fixed values: the JSON a shipper sends
BEAT_SCHEMA = (
    "`@timestamp` string, beat struct<hostname:string,name:string,version:string>, fields map<string,string>, "
    "input_type string, message string, offset bigint, source string, tags array<string>, type string"
)
_BAD = "_corrupt_record"
REASON, RAW = "reject_reason", "raw"


def _others(df: DataFrame, value: str) -> list[Column]:
    """Transport columns (topic, partition, offset, ...) that travel along."""
    return [field(c) for c in df.columns if c != value]


def beat_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Shipper JSON to typed columns; ``timestamp`` is epoch millis, malformed JSON gives NULLs."""
    return _beat_fields(df, value).drop(_BAD)


def _beat_fields(df: DataFrame, value: str) -> DataFrame:
    parsed = df.withColumn("_j", F.from_json(field(value).cast("string"), f"{BEAT_SCHEMA}, {_BAD} string"))
    j = F.col("_j")
    return parsed.select(
        *_others(df, value),
        strict_utc_millis(j["@timestamp"]).alias("timestamp"),
        j["beat"].alias("beat"),
        j["fields"].alias("fields"),
        j["input_type"].alias("input_type"),
        j["message"].alias("message"),
        j["offset"].alias("file_offset"),
        j["source"].alias("source"),
        j["tags"].alias("tags"),
        j["type"].alias("type"),
        j[_BAD].alias(_BAD),
    )


def _tagged(df: DataFrame, reason: Column, text: Column, columns: list[Column], tagged: bool) -> DataFrame:
    """The decoded ``columns`` of all rows with reason and raw text, or of the rows without a reason."""
    df = df.withColumn("_reason", reason)
    if not tagged:
        return df.filter(F.col("_reason").isNull()).select(*columns)
    return df.select(*columns, F.col("_reason").alias(REASON), F.when(F.col("_reason").isNotNull(), text).alias(RAW))


def accepted(tagged: DataFrame) -> DataFrame:
    """The rows of a tagged output that were decoded."""
    return tagged.filter(F.col(REASON).isNull()).drop(REASON, RAW)


def rejects(tagged: DataFrame) -> DataFrame:
    """The rows of a tagged output that were not: transport columns, raw text and reason."""
    lost = {*ENVELOPE, "fields"}
    return tagged.filter(F.col(REASON).isNotNull()).select(*[field(c) for c in tagged.columns if c not in lost])


def _json_reason(text: Column, malformed: Column) -> Column:
    return F.when(text.isNull() | (F.trim(text) == ""), "empty").when(malformed, "malformed JSON")


def beat_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows whose value is no shipper JSON."""
    return rejects(beat(df, value, tagged=True)).drop(REASON)


def beat(df: DataFrame, value: str = "value", now: int | None = None, tagged: bool = False) -> DataFrame:
    """Shipper JSON to the envelope, with the defaults for whatever is missing.

    A malformed row becomes an event of unknown type that carries the raw text as
    its message, so nothing is lost; with ``tagged`` it also has a reason.
    """
    j = _beat_fields(df.withColumn("_raw", field(value).cast("string")), value)
    columns = [
        *_others(df, value),
        nz(F.element_at(F.col("fields"), "token"), UNKNOWN).alias("token"),
        nz(F.col("type"), UNKNOWN).alias("type"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
        nz(F.coalesce(F.col("message"), F.col(_BAD)), "_").alias("message"),
        F.lit("streaming").alias("upload_type"),
        F.coalesce(F.col("timestamp"), now_millis(now)).alias("upload_timestamp"),
    ]
    if not tagged:
        return j.select(*columns)
    return _tagged(j, _json_reason(F.col("_raw"), F.col(_BAD).isNotNull()), F.col("_raw"), columns, True)


def delimited_line(df: DataFrame, value: str = "value", now: int | None = None, tagged: bool = False) -> DataFrame:
    """``token type tag,tag upload_type || message`` lines; malformed ones are tagged, or left out."""
    parts = df.withColumn("_halves", F.split(field(value), r" \|\| ", 2))
    parts = parts.withColumn("_head", F.split(F.get("_halves", F.lit(0)), " ", 4))
    reason = (
        F.when(F.col("_halves").isNull(), "empty").when(F.size("_halves") < 2, "no body").when(F.size("_head") < 4, "short header")
    )
    columns = [
        *_others(df, value),
        F.get("_head", F.lit(0)).alias("token"),
        F.get("_head", F.lit(1)).alias("type"),
        split_parts(F.get("_head", F.lit(2)), ",", 0).alias("tags"),
        F.get("_halves", F.lit(1)).alias("message"),
        F.get("_head", F.lit(3)).alias("upload_type"),
        now_millis(now).alias("upload_timestamp"),
    ]
    return _tagged(parts, reason, field(value).cast("string"), columns, tagged)


def delimited_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """The lines that are no delimited lines, with the reason."""
    return rejects(delimited_line(df, value, tagged=True))


def raw_line(
    df: DataFrame, token: str, type_: str, tags: Sequence[str], upload_type: str, value: str = "value", now: int | None = None
) -> DataFrame:
    """Whole line as message with constant metadata."""
    return df.select(
        *_others(df, value),
        F.lit(token).alias("token"),
        F.lit(type_).alias("type"),
        F.array(*[F.lit(t) for t in tags]).cast("array<string>").alias("tags"),
        field(value).cast("string").alias("message"),
        F.lit(upload_type).alias("upload_type"),
        now_millis(now).alias("upload_timestamp"),
    )


def flat_json(df: DataFrame, value: str = "value", now: int | None = None, tagged: bool = False) -> DataFrame:
    """Flat JSON object to a map column ``fields`` plus the lifted message, token and type.

    Malformed rows are tagged, or left out.
    """
    text = field(value).cast("string")
    parsed = df.withColumn("_m", F.from_json(text, "map<string,string>"))
    stamp = F.element_at(F.col("_m"), "@timestamp")
    millis = parse_first(stamp, [("yyyy-MM-dd'T'HH:mm:ss.SSSZ",), ("yyyy-MM-dd'T'HH:mm:ssZ",)])
    columns = [
        *_others(df, value),
        nz(F.element_at(F.col("_m"), "token")).alias("token"),
        nz(F.element_at(F.col("_m"), "type")).alias("type"),
        F.array().cast("array<string>").alias("tags"),
        nz(F.element_at(F.col("_m"), "message")).alias("message"),
        F.lit("streaming").alias("upload_type"),
        F.coalesce(millis, now_millis(now)).alias("upload_timestamp"),
        F.col("_m").alias("fields"),
    ]
    return _tagged(parsed, _json_reason(text, F.col("_m").isNull()), text, columns, tagged)


def flat_json_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    return rejects(flat_json(df, value, tagged=True)).drop(REASON)


def doc_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """Deterministic document id ``topic.partition.offset``."""
    return df.withColumn(name, F.concat_ws(".", "topic", "partition", "offset"))


# fixed values: the names decoders go by in a configuration
DECODERS = {
    "json": flat_json,
    "xyz-json": flat_json,
    "xyz-line": delimited_line,
    "line": delimited_line,
    "raw-line": raw_line,
    "filebeat": beat,
}


def decode(df: DataFrame, name: str, **arguments) -> DataFrame:
    """Decode with the decoder of this configured name; further arguments are the decoder's."""
    if name not in DECODERS:
        raise ValueError(f"unknown decoder {name}; known are {', '.join(DECODERS)}")
    return DECODERS[name](df, **arguments)
