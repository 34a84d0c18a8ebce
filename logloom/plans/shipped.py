"""The shipped step lists for web access, web error and database error logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from logloom.functions.cols import field
from logloom.operators import anomaly
from logloom.operators.dates import date
from logloom.operators.geo import geo
from logloom.operators.grok import grok
from logloom.operators.json_fields import json_fields
from logloom.operators.split_kv import kv, split
from logloom.operators.useragent import user_agent
from logloom.operators.xml_fields import xml_fields
from logloom.plans.steps import Step, run

# fixed values: zone and time formats of the shipped types
ZONE = "Asia/Shanghai"
DATE_FORMATS = {
    "apache_access": [("dd/MMM/yyyy:HH:mm:ss Z", ZONE)],
    "nginx_access": [("dd/MMM/yyyy:HH:mm:ss Z", ZONE)],
    "apache_error": [("E MMM dd HH:mm:ss yyyy", ZONE), ("E MMM dd HH:mm:ss.SSSSSS yyyy", ZONE)],
    "nginx_error": [("yyyy/MM/dd HH:mm:ss", ZONE), ("yyyy-MM-dd HH:mm:ss", ZONE)],
    "mysql_error": [("yyMMdd HH:mm:ss", ZONE), ("yyyy-MM-dd HH:mm:ss", ZONE), ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ", ZONE)],
}
TYPES = tuple(DATE_FORMATS)

# step factories by the names a configuration table uses
STEP_TYPES = {
    "pattern": grok,
    "geoip": geo,
    "timestamp": date,
    "user-agent": user_agent,
    "split": split,
    "kv": kv,
    "json": json_fields,
    "xml": xml_fields,
    "regex-based-anomaly-detection": anomaly.regex_anomalies,
    "random-anomaly-detection": anomaly.weighted_labels,
}

ANOMALY_RULES = {
    "apache_access": anomaly.WEB_RULES,
    "nginx_access": anomaly.WEB_RULES,
    "apache_error": anomaly.APACHE_ERROR_RULES,
    "nginx_error": anomaly.NGINX_ERROR_RULES,
    "mysql_error": anomaly.MYSQL_RULES,
}


def shipped_steps(ranges: DataFrame, types: Sequence[str] = TYPES, now: int | None = None) -> list[Step]:
    """Grok, geo, date, user agent, request split and parameter map for events of ``types``.

    All types share the list; only pattern and date format differ by type. So
    the geo join runs once for all of them. A time that is missing or fits no
    format becomes the current time, or ``now`` (epoch millis) if given.
    """
    return [
        grok("message", types=types),
        geo(ranges, "clientip"),
        date("timestamp", {t: DATE_FORMATS[t] for t in types}, fallback_now=True, now=now),
        user_agent("agent"),
        split("request", r"\?", 2, ["request_path", "request_params"]),
        kv("request_params", "&", "="),
    ]


def ingest(df: DataFrame, ranges: DataFrame, types: Sequence[str] = TYPES, now: int | None = None) -> DataFrame:
    """Run the shipped steps on the decoded events of ``types``; other events pass through."""
    df = df.withColumn("_shipped", field("type").isin(list(types)))
    return run(df, shipped_steps(ranges, types, now), field("_shipped")).drop("_shipped")


def anomaly_steps(type_: str) -> list[Step]:
    return [anomaly.regex_anomalies(ANOMALY_RULES[type_])]
