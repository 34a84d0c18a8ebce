"""End-to-end ingest in batch: shipper JSON to routed documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.catalog import lines
from logloom.catalog.lines import with_events
from logloom.catalog.registry import query
from logloom.functions import rotation
from logloom.functions.cols import map_text
from logloom.operators import anomaly
from logloom.operators.geo import ranges_from_longs
from logloom.plans.config import steps_from_rows
from logloom.plans.shipped import ANOMALY_RULES, DATE_FORMATS, ingest
from logloom.plans.steps import route, with_fields
from logloom.sources import decode

MESSAGES = {
    "apache_access": lines.access_message,
    "nginx_access": lines.nginx_access_message,
    "apache_error": lines.apache_error_message,
    "nginx_error": lines.nginx_error_message,
    "mysql_error": lines.mysql_error_message,
}
# columns of the compared result besides those of every document
FIELDS = {
    "apache_access": "clientip auth verb request httpversion rawrequest response bytes referrer agent".split(),
    "nginx_access": "clientip auth verb request rawrequest response bytes agent forwarder".split(),
    "apache_error": "module loglevel pid clientip msg".split(),
    "nginx_error": "loglevel pid errormsg clientip server request upstream serverip".split(),
    "mysql_error": "id loglevel msg".split(),
}
_GEO, _AGENT, _PARAMS = ["city", "country", "continent"], ["agent_browser", "agent_os"], ["request_path", "request_params"]
OUTPUT = {
    "apache_access": _GEO + _AGENT + _PARAMS + ["params"],
    "nginx_access": _GEO + _AGENT + _PARAMS + ["params"],
    "apache_error": _GEO,
    "nginx_error": _GEO + _PARAMS + ["params"],
    "mysql_error": [],
}


def documents(ev: DataFrame, ranges: DataFrame, kind: str) -> DataFrame:
    """Derived events through transport, decoder, shipped steps and index naming."""
    sent = lines.transported(ev, lines.beat_json(MESSAGES[kind](), F.lit(kind)))
    docs = ingest(decode.doc_id(decode.beat(sent, now=lines.NOW)), ranges, [kind], lines.NOW)
    return docs.withColumn("index_name", rotation.index_name(F.col("token"), F.col("type")))


def shown(docs: DataFrame, kind: str) -> DataFrame:
    """The document fields that are compared, as text."""
    docs = with_fields(docs, [*FIELDS[kind], *OUTPUT[kind]])
    if "params" in OUTPUT[kind]:
        docs = docs.withColumn("params", map_text(F.col("request_params_map")))
    stamp = F.col("event_timestamp").cast("string").alias("event_timestamp")
    return docs.select("event_id", "doc_id", "index_name", stamp, *FIELDS[kind], *OUTPUT[kind])


_LIVE = "event_id % 31 <> 0 AND event_id % 37 <> 0"
_SECOND = "cast(epoch_us(date_trunc('second', ts)) // 1000 - 28800000 AS varchar)"
_FACT = {i: f"{lines.sql_list(f[i] for f in lines.AGENT_FACTS)}[event_id % {len(lines.AGENTS)} + 1]" for i in (3, 4)}
_PARSED = {
    "apache_access": {
        "clientip": "clientip", "auth": "concat('u', user_id)", "verb": "CASE WHEN NOT is_raw THEN verb END", "request": "CASE WHEN NOT is_raw THEN request END",
        "httpversion": "CASE WHEN NOT is_raw THEN '1.1' END", "rawrequest": "CASE WHEN is_raw THEN 'bad line data' END", "response": "status", "bytes": "nbytes",
        "referrer": "concat('\"', referrer, '\"')", "agent": "concat('\"', agent, '\"')", "forwarder": "CASE WHEN event_id % 5 = 0 THEN concat('10.0.0.', user_id % 256) END",
    },
    "apache_error": {
        "module": "'core'", "loglevel": "level", "pid": "CASE WHEN event_id % 4 <> 0 THEN cast(event_id AS varchar) END",
        "clientip": "CASE WHEN event_id % 3 <> 0 THEN clientip END", "msg": lines.ERROR_TEXT_SQL,
    },
    "nginx_error": {
        "loglevel": "level", "pid": "cast(event_id + 1 AS varchar)", "errormsg": f"concat('*7 ', {lines.ERROR_TEXT_SQL})", "clientip": "clientip",
        "server": "'www.example.com'", "request": "concat('\"', verb, ' ', request, ' HTTP/1.1\"')",
        "upstream": "CASE WHEN event_id % 4 <> 0 THEN concat('http://10.1.1.', user_id % 200, ':8080/', event_type) END", "serverip": "'\"www.example.com\"'",
    },
    "mysql_error": {"id": "cast(event_id AS varchar)", "loglevel": "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'Note' END", "msg": lines.MYSQL_TEXT_SQL},
}
_PARSED["nginx_access"] = _PARSED["apache_access"]


def _params_sql(tail: str) -> str:
    return (
        f"CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 9 = 0 THEN concat('k=', k, ';q=select+a+from+b;uid=last{tail}') "
        f"ELSE concat('k=', k, '{tail};uid=', user_id) END"
    )


def oracle(kind: str) -> str:
    """Expected documents: the source columns where the line was sent whole, NULL elsewhere."""
    access, error = kind in ("apache_access", "nginx_access"), kind == "nginx_error"
    live = _LIVE + (" AND is_line" if access else "")
    request = f"({_PARSED[kind]['request']})" if access or error else "NULL"
    derived = {
        "city": "CASE WHEN g.n_name IS NOT NULL THEN concat('City ', g.n_nationkey) END", "country": "g.n_name", "continent": "g.r_name",
        "agent_browser": _FACT[3], "agent_os": _FACT[4], "request_path": f"string_split({request}, '?')[1]",
        "request_params": f"CASE WHEN contains({request}, '?') THEN substr({request}, strpos({request}, '?') + 1) END",
        "params": f"CASE WHEN NOT is_raw THEN {_params_sql('')} END" if access else _params_sql(' HTTP/1.1"'),
    }
    if kind == "apache_error":
        derived = {n: f"CASE WHEN event_id % 3 <> 0 THEN {e} END" for n, e in derived.items()}
    picks = {"event_timestamp": _SECOND, **{f: _PARSED[kind][f] for f in FIELDS[kind]}, **{f: derived[f] for f in OUTPUT[kind]}}
    # a line without a time of its own gets the current one
    late = {"event_timestamp": f" WHEN event_id % 37 <> 0 THEN '{lines.NOW}'"}
    columns = ", ".join(f"CASE WHEN {live} THEN {e}{late.get(n, '')} END AS {n}" for n, e in picks.items())
    head = (
        "event_id, concat('logs.', user_id % 4, '.', event_id) AS doc_id, concat(CASE WHEN event_id % 23 <> 0 THEN token ELSE '_unknown_' END, '.', "
        f"CASE WHEN event_id % 37 <> 0 THEN '{kind}' ELSE '_unknown_' END) AS index_name"
    )
    return with_events(f"SELECT {head}, {columns} FROM ev {lines.GEO_JOIN_SQL}")


for _kind in MESSAGES:

    @query(f"ingest_{_kind}", oracle(_kind))
    def _run(spark, sf_dir, kind=_kind):
        ranges = ranges_from_longs(lines.geo_ranges(spark, sf_dir))
        return shown(documents(lines.events(spark, sf_dir), ranges, kind), kind)


def _by_type(expressions: dict[str, str], otherwise: str = "NULL") -> str:
    kinds = list(MESSAGES)
    return "CASE " + " ".join(f"WHEN event_id % 6 = {kinds.index(k)} THEN {e}" for k, e in expressions.items()) + f" ELSE {otherwise} END"


_ALL_SQL = with_events(
    "SELECT event_id, concat(CASE WHEN event_id % 23 <> 0 THEN token ELSE '_unknown_' END, '.', CASE WHEN event_id % 37 <> 0 THEN "
    + _by_type({k: f"'{k}'" for k in MESSAGES}, "'other'")
    + " ELSE '_unknown_' END) AS index_name, "
    + "CASE WHEN event_id % 37 <> 0 THEN "
    + _by_type({k: f"CASE WHEN {_LIVE}{' AND is_line' if k.endswith('access') else ''} THEN {_SECOND} ELSE '{lines.NOW}' END" for k in MESSAGES})
    + f" END AS event_timestamp, CASE WHEN {_LIVE} THEN "
    + _by_type({k: _PARSED[k]["loglevel"] for k in ("apache_error", "nginx_error", "mysql_error")})
    + f" END AS loglevel, CASE WHEN {_LIVE} AND is_line THEN "
    + _by_type({k: _FACT[3] for k in ("apache_access", "nginx_access")})
    + f" END AS agent_browser, CASE WHEN {_LIVE} THEN "
    + _by_type(
        {
            "apache_access": "CASE WHEN is_line THEN g.n_name END",
            "nginx_access": "CASE WHEN is_line THEN g.n_name END",
            "apache_error": "CASE WHEN event_id % 3 <> 0 THEN g.n_name END",
            "nginx_error": "g.n_name",
        }
    )
    + f" END AS country, CASE WHEN {_LIVE} THEN "
    + _by_type(
        {
            "apache_error": f"CASE WHEN ({lines.ERROR_TEXT_SQL}) LIKE 'File does not exist%' THEN 'warn' END",
            "nginx_error": f"CASE WHEN ({lines.ERROR_TEXT_SQL}) LIKE 'File does not exist%' THEN 'warn' END",
        }
    )
    + f" END AS anomaly_denied FROM ev {lines.GEO_JOIN_SQL}"
)


def _mixed(spark, sf_dir) -> DataFrame:
    """Decoded events of all shipped types and one unknown."""
    ev = lines.events(spark, sf_dir)
    at = (F.col("event_id") % 6).cast("int")
    kind = F.get(F.array(*[F.lit(k) for k in [*MESSAGES, "other"]]), at)
    # build only the message of the row's own type
    message = F.coalesce(*[F.when(at == i, m()) for i, m in enumerate(MESSAGES.values())], F.lit("plain text"))
    sent = lines.transported(ev, lines.beat_json(message, kind))
    return decode.doc_id(decode.beat(sent, now=lines.NOW))


def _mixed_shown(docs: DataFrame) -> DataFrame:
    docs = docs.withColumn("index_name", rotation.index_name(F.col("token"), F.col("type")))
    stamp = F.col("event_timestamp").cast("string").alias("event_timestamp")
    return docs.select("event_id", "index_name", stamp, "loglevel", "agent_browser", "country", "anomaly_denied")


@query("ingest_all", _ALL_SQL)
def ingest_all(spark, sf_dir):
    """All shipped types, and one unknown, in a single pass; the anomaly rules are routed by type."""
    docs = ingest(_mixed(spark, sf_dir), ranges_from_longs(lines.geo_ranges(spark, sf_dir)), now=lines.NOW)
    return _mixed_shown(route(docs, {"*": {k: [anomaly.regex_anomalies(rules)] for k, rules in ANOMALY_RULES.items()}}))


def _config_rows() -> list[tuple]:
    """The shipped steps as configuration rows: name, type, source field, arguments, conditions."""
    shipped = [f"global.type match {'|'.join(MESSAGES)}"]
    steps = [
        ("parse", "pattern", "message", {}, shipped),
        ("place", "geoip", "clientip", {}, [*shipped, "fields.clientip exist"]),
        ("time", "timestamp", "timestamp", {"formats": DATE_FORMATS, "fallback_now": True, "now": lines.NOW}, shipped),
        ("agent", "user-agent", "agent", {}, shipped),
        ("path", "split", "request", {"delimiter": r"\?", "limit": 2, "names": ["request_path", "request_params"]}, shipped),
        ("params", "kv", "request_params", {"delimiter": "&", "sub_delimiter": "="}, shipped),
    ]
    steps += [(f"rules-{k}", "regex-based-anomaly-detection", "", {"rules": rules}, [f"global.type == {k}"]) for k, rules in ANOMALY_RULES.items()]
    return [("*", "*", i, name, kind, field, json.dumps(args), needs) for i, (name, kind, field, args, needs) in enumerate(steps)]


@query("ingest_from_config", _ALL_SQL)
def ingest_from_config(spark, sf_dir):
    """The same from configuration rows."""
    schema = "token string, record_type string, orders int, name string, type string, source_field string, argument string, requires array<string>"
    rows = spark.createDataFrame(_config_rows(), schema)
    steps = steps_from_rows(rows, {"geoip": ranges_from_longs(lines.geo_ranges(spark, sf_dir))})
    return _mixed_shown(route(_mixed(spark, sf_dir), steps))
