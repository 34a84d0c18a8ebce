"""Typed documents: apply a declared field mapping and set aside values that do not fit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import field, try_whole
from logloom.functions.dates import parse_first
from logloom.operators.geo import ip_hex

# fixed values: the declared types of a web access document
ACCESS_MAPPING = {
    "token": "keyword",
    "tags": "keyword",
    "upload_type": "keyword",
    "upload_timestamp": "date",
    "clientip": "ip",
    "ident": "keyword",
    "auth": "keyword",
    "event_timestamp": "date",
    "verb": "keyword",
    "request": "text",
    "request_path": "text",
    "request_params": "text",
    "request_params_map": "object",
    "httpversion": "keyword",
    "rawrequest": "text",
    "response": "integer",
    "bytes": "integer",
    "referrer": "text",
    "agent": "text",
    "forwarder": "text",
    "filter_timestamp": "date",
    "index_timestamp": "date",
}

# fixed values: the declared types every other document starts from
DEFAULT_MAPPING = {
    "@timestamp": "date",
    "@version": "keyword",
    "token": "keyword",
    "timestamp": "date",
    "bytes": "integer",
    "clientip": "ip",
    "response": "integer",
    "message": "message",
    "geoip": {"ip": "ip", "location": "geo_point", "latitude": "float", "longitude": "float"},
}

# fixed values: date formats accepted for text, and the length limit of raw copies
DATE_FORMATS = (
    "dd/MMM/yyyy:HH:mm:ss Z",
    "E MMM dd HH:mm:ss yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "epoch_millis",
    "yyyy-MM-dd'T'HH:mm:ss.SSSZ",
)
RAW_LIMIT = 256

#: ``latitude,longitude`` in degrees.
GEO_POINT = r"^\s*[-+]?(?:90(?:\.0+)?|[1-8]?\d(?:\.\d+)?)\s*,\s*[-+]?(?:180(?:\.0+)?|(?:1[0-7]\d|[1-9]?\d)(?:\.\d+)?)\s*$"

_NUMBERS = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint", "float": "float", "double": "double"}


MAPPINGS = {"apache_access": ACCESS_MAPPING}


def mapping_for(type_: str) -> dict[str, str]:
    """Declared mapping of an event type, the default one where none is declared."""
    return MAPPINGS.get(type_, DEFAULT_MAPPING)


def merge_mapping(base: Mapping[str, str], extra: Mapping[str, str]) -> dict[str, str]:
    """``base`` with further field types; an extra type replaces a declared one, fields of an object are merged."""
    both = {k: {**base[k], **extra[k]} for k in base.keys() & extra.keys() if isinstance(base[k], Mapping) and isinstance(extra[k], Mapping)}
    return {**base, **extra, **both}


def typed(name: str, dtype: str, kind: str) -> Column:
    """Column ``name`` (of Spark type ``dtype``) as mapping type ``kind``; NULL where it does not fit."""
    return typed_value(field(name), dtype, kind, name)


def typed_value(c: Column, dtype: str, kind: str, name: str) -> Column:
    """Value ``c`` of column or nested field ``name`` as mapping type ``kind``."""
    if kind in ("keyword", "text", "message"):
        return c if dtype.startswith("array") else c.cast("string")
    if kind in _NUMBERS:
        if dtype == "string":
            return F.trim(c).try_cast(_NUMBERS[kind]) if kind in ("float", "double") else try_whole(F.trim(c), _NUMBERS[kind])
        return c.try_cast(_NUMBERS[kind])
    if kind == "date":
        if dtype.startswith("timestamp"):
            return c.cast("timestamp")
        millis = parse_first(c, [(f,) for f in DATE_FORMATS]) if dtype == "string" else c.try_cast("bigint")
        return F.timestamp_millis(millis)
    if kind == "ip":
        return F.when(ip_hex(name).isNotNull(), c)
    if kind == "geo_point" and dtype == "string":
        return F.when(c.rlike(GEO_POINT), c)
    if kind in ("object", "geo_point"):
        return c
    if kind == "boolean":
        return c.try_cast("boolean")
    raise ValueError(f"unknown mapping type {kind}")


def apply_mapping(df: DataFrame, mapping: Mapping[str, str], rejects: str = "reject_fields") -> DataFrame:
    """Cast the declared fields that are present; undeclared fields keep their type.

    ``rejects`` lists the fields whose value did not fit (their typed value is
    NULL) and ``<rejects>_raw`` maps them to the original text, so one pass
    yields both the documents and what a dead-letter table needs.
    """
    types = dict(df.dtypes)
    df, nested = _flat_objects(df, types, mapping)
    flat = {**{k: v for k, v in mapping.items() if not isinstance(v, Mapping)}, **{tmp: kind for tmp, (_, _, kind) in nested.items()}}
    types = dict(df.dtypes)
    shown = {tmp: path for tmp, (path, _, _) in nested.items()}
    declared = [n for n in df.columns if n in flat]
    new = {n: typed(n, types[n], flat[n]) for n in declared}
    narrow = {n: f"_typed_{i}" for i, n in enumerate(n for n in declared if flat[n] in {*_NUMBERS, "date", "ip", "boolean", "geo_point"})}
    df = df.withColumns({tmp: new[n] for n, tmp in narrow.items()})
    bad = [
        F.when(field(n).isNotNull() & field(tmp).isNull(), F.struct(F.lit(shown.get(n, n)).alias("k"), field(n).cast("string").alias("v")))
        for n, tmp in narrow.items()
        if not types[n].startswith(("struct", "map"))
    ]
    found = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<k:string,v:string>>")
    own = {n: field(narrow[n]) if n in narrow else new.get(n, field(n)) for n in df.columns if n not in narrow.values()}
    out = [(_object(n, mapping[n], nested, own) if n in {top for _, top, _ in nested.values()} else c).alias(n) for n, c in own.items() if n not in nested]
    return df.withColumn("_bad", found).select(
        *out,
        F.transform("_bad", lambda e: e["k"]).alias(rejects),
        F.map_from_entries("_bad").alias(f"{rejects}_raw"),
    )


def _flat_objects(df: DataFrame, types: Mapping[str, str], mapping: Mapping) -> tuple[DataFrame, dict[str, tuple[str, str, str]]]:
    """Declared fields of struct columns as columns of their own: name -> (path, struct column, kind)."""
    nested: dict[str, tuple[str, str, str]] = {}
    for top, kinds in mapping.items():
        if isinstance(kinds, Mapping) and types.get(top, "").startswith("struct"):
            for f in df.schema[top].dataType.fieldNames():
                nested[f"_object_{len(nested)}"] = (f"{top}.{f}", top, kinds.get(f, "object"))
    return df.withColumns({tmp: field(path.split(".", 1)[0]).getField(path.split(".", 1)[1]) for tmp, (path, _, _) in nested.items()}), nested


def _object(top: str, kinds: Mapping[str, str], nested: Mapping, own: Mapping[str, Column]) -> Column:
    """The struct column with its typed fields; NULL stays NULL."""
    parts = [own[tmp].alias(path.split(".", 1)[1]) for tmp, (path, t, _) in nested.items() if t == top]
    return F.when(field(top).isNotNull(), F.struct(*parts))


#: Evidence about the values of a field, as bits; a field's evidence is the OR over its values, so parts can be merged in any order.
BOOLEAN, WHOLE, FRACTION, DATE, POINT, TEXT = 1, 2, 4, 8, 16, 32
_WHOLE_RANGES = (("byte", 7), ("short", 15), ("integer", 31))


def _evidence(text: Column) -> Column:
    """Bits of one text: what it can be read as; 0 for NULL and empty text."""
    date = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]", "dd/MMM/yyyy:HH:mm:ss Z", "yyyy/MM/dd HH:mm:ss")])
    return (
        F.when(F.coalesce(text, F.lit("")) == "", 0)
        .when(text.isin("true", "false"), BOOLEAN)
        .when(text.rlike(r"^-?\d{1,18}$"), WHOLE)
        .when(text.rlike(r"^-?(?:\d+\.\d*|\.\d+|\d+)(?:[eE][-+]?\d+)?$"), FRACTION)
        .when(text.rlike(GEO_POINT), POINT)
        .when(text.rlike(r"^\d{1,4}[-/]") & date.isNotNull(), DATE)
        .otherwise(TEXT)
    )


def field_evidence(entries: DataFrame, name: str = "key", value: str = "value") -> DataFrame:
    """``field, bits, low, high`` of (field, text) rows: what all texts of a field can be read as, and the range of whole numbers.

    The aggregates are OR, minimum and maximum, so a hot field combines in the tasks, and the evidence of batches can be
    put together by :func:`merge_evidence`.
    """
    bits = _evidence(field(value)).alias("bits")
    rows = entries.select(field(name).alias("field"), bits, try_whole(F.trim(field(value))).alias("n"))
    return rows.groupBy("field").agg(F.bit_or("bits").alias("bits"), F.min("n").alias("low"), F.max("n").alias("high"))


def merge_evidence(*parts: DataFrame) -> DataFrame:
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("field").agg(F.bit_or("bits").alias("bits"), F.min("low").alias("low"), F.max("high").alias("high"))


def choose_templates(evidence: DataFrame, base: Mapping = DEFAULT_MAPPING) -> DataFrame:
    """``field, kind, raw``: the declared type, else the template that fits all values of the field.

    Whole numbers take the narrowest type of their range; whole and fractional numbers together are double; any other
    mixture is text. Text other than the message has an exact copy (``raw``).
    """
    bits = F.col("bits")
    whole = reduce(
        lambda rest, t: F.when((F.col("low") >= -(1 << t[1])) & (F.col("high") < (1 << t[1])), t[0]).otherwise(rest), reversed(_WHOLE_RANGES), F.lit("long")
    )
    kind = (
        F.when(bits == BOOLEAN, "boolean")
        .when(bits == WHOLE, whole)
        .when(bits.isin(FRACTION, WHOLE | FRACTION), "double")
        .when(bits == DATE, "date")
        .when(bits == POINT, "geo_point")
        .otherwise("text")
    )
    declared = {k: v for k, v in base.items() if isinstance(v, str)}
    known = F.create_map(*[F.lit(x) for kv in declared.items() for x in kv])
    out = evidence.select("field", F.coalesce(F.try_element_at(known, F.col("field")), kind).alias("kind"), (~F.col("field").isin(*declared)).alias("_free"))
    return out.select("field", "kind", (F.col("_free") & (F.col("kind") == "text")).alias("raw"))


def dynamic_mapping(templates: DataFrame) -> dict[str, str]:
    """The chosen types as a mapping for :func:`apply_mapping`; as many rows as there are fields."""
    return {r.field: r.kind for r in templates.collect()}


def accepted(df: DataFrame, rejects: str = "reject_fields") -> DataFrame:
    return df.filter(F.size(rejects) == 0).drop(rejects, f"{rejects}_raw")


def rejected(df: DataFrame, rejects: str = "reject_fields") -> DataFrame:
    return df.filter(F.size(rejects) > 0)


def with_raw(df: DataFrame, fields: Sequence[str], limit: int = RAW_LIMIT) -> DataFrame:
    """Exact-match copies ``<field>_raw`` of text fields no longer than ``limit``."""
    return df.withColumns({f"{n}_raw": F.when(F.length(field(n)) <= limit, field(n)) for n in fields})


def text_fields(df: DataFrame) -> list[str]:
    """String fields that get a raw copy by default: all but ``message``."""
    return [n for n, t in df.dtypes if t == "string" and n != "message"]
