"""Log lines built in Spark from the given tables, and the same values in SQL.

Every builder covers its whole table. The SQL side states the source columns a
parsed line must give back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.catalog.registry import spread, table

NOW = 1_700_000_000_000

AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/43.0.2357.124 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_10_4) AppleWebKit/600.7.12 (KHTML, like Gecko) Version/8.0.7 Safari/600.7.12",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:38.0) Gecko/20100101 Firefox/38.0",
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1; Trident/4.0)",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.example.com/bot.html)",
    "Baiduspider+(+http://www.example.com/search/spider.htm)",
    "curl/7.35.0",
    "-",
    "Mozilla/5.0 (Linux; U; Android 4.4.4; zh-cn) AppleWebKit/533.1 (KHTML, like Gecko) MQQBrowser/5.4 Mobile Safari/533.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 8_3 like Mac OS X) AppleWebKit/600.1.4 (KHTML, like Gecko) MicroMessenger/6.1.5",
    "UCWEB7.0.2.37/28/999",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Safari/537.36 Edge/12.0",
)
# what the steps must say about each agent: vendor tag, crawler name, product token, browser, system
AGENT_FACTS = (
    ("Chrome", None, "Mozilla", "Chrome", "WINDOWS_7"),
    (None, None, "Mozilla", "Safari", "MAC_OS_X"),
    ("Firefox", None, "Mozilla", "Firefox", "UBUNTU"),
    (None, None, "Mozilla", "IE8", "WINDOWS_XP"),
    (None, "Googlebot", "Mozilla", "Googlebot", "UNKNOWN"),
    (None, "Baiduspider", "UNKNOWN", "Baiduspider", "UNKNOWN"),
    (None, None, "curl", "Curl", "UNKNOWN"),
    (None, None, "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    ("QQ", None, "Mozilla", "QQ", "ANDROID"),
    ("Weixin", None, "Mozilla", "Weixin", "IOS_IPHONE"),
    ("UC", None, "UNKNOWN", "UC", "UNKNOWN"),
    (None, None, "Mozilla", "Edge", "WINDOWS_10"),
)


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


# derived columns of `events` that need no engine-specific function
_SHARED = {
    "token": "concat('u', user_id % 40)",
    "clientip": "CASE WHEN event_id % 11 = 0 THEN '127.0.0.1' ELSE concat(16 + user_id % 32, '.', "
    "CASE WHEN event_id % 7 = 0 THEN 200 ELSE user_id % 32 % 5 END, '.', event_id % 256, '.', user_id % 256) END",
    "verb": "CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END",
    "status": "CASE WHEN event_type = 'error' THEN '500' WHEN event_type = 'purchase' THEN '201' ELSE '200' END",
    "level": "CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' THEN 'warn' ELSE 'notice' END",
    "nbytes": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast(cast(floor(value) as bigint) as varchar(20)) END",
    "is_line": "event_id % 19 <> 0",
    "is_raw": "event_id % 17 = 0",
}
_K = {"spark": "get_json_object(props, '$.k')", "duckdb": "json_extract_string(props, '$.k')"}


def _request(k: str) -> str:
    return (
        f"CASE WHEN event_id % 10 = 0 THEN concat('/', event_type) "
        f"WHEN event_id % 9 = 0 THEN concat('/', event_type, '?uid=', user_id, '&k=', {k}, '&flag&q=select+a+from+b&uid=last') "
        f"ELSE concat('/', event_type, '?uid=', user_id, '&k=', {k}) END"
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the parts of a log line as columns."""
    return derived(spread(table(spark, sf_dir, "events")))


def derived(df: DataFrame) -> DataFrame:
    exprs = {n: F.expr(e) for n, e in _SHARED.items()}
    exprs["k"] = F.expr(_K["spark"])
    exprs["request"] = F.expr(_request(_K["spark"]))
    exprs["agent"] = F.get(F.array(*[F.lit(a) for a in AGENTS]), (F.col("event_id") % len(AGENTS)).cast("int"))
    exprs["referrer"] = F.concat(F.lit("http://ref.example.com/"), F.col("event_type"))
    return df.withColumns(exprs)


EVENTS_SQL = (
    "ev AS (SELECT *, "
    + ", ".join(f"{e} AS {n}" for n, e in _SHARED.items())
    + f", {_K['duckdb']} AS k, {_request(_K['duckdb'])} AS request"
    + f", {sql_list(AGENTS)}[event_id % {len(AGENTS)} + 1] AS agent"
    + ", concat('http://ref.example.com/', event_type) AS referrer FROM events)"
)


def with_events(body: str) -> str:
    return f"WITH {EVENTS_SQL} {body}"


def _stamp(fmt: str) -> Column:
    return F.date_format("ts", fmt)


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _c(name: str) -> Column:
    return F.col(name).cast("string")


def access_message() -> Column:
    request = F.when(F.col("is_raw"), "bad line data").otherwise(_text(_c("verb"), " ", _c("request"), " HTTP/1.1"))
    line = _text(
        _c("clientip"), " - u", _c("user_id"), " [", _stamp("dd/MMM/yyyy:HH:mm:ss"), ' +0800] "', request, '" ',
        _c("status"), " ", F.coalesce(_c("nbytes"), F.lit("-")), ' "', _c("referrer"), '" "', _c("agent"), '"',
    )
    return F.when(F.col("is_line"), line).otherwise(_text("no access line ", _c("event_id")))


def nginx_access_message() -> Column:
    forwarder = F.when(F.col("event_id") % 5 == 0, _text(" 10.0.0.", (F.col("user_id") % 256).cast("string"))).otherwise("")
    return F.when(F.col("is_line"), _text(access_message(), forwarder)).otherwise(access_message())


def apache_error_message() -> Column:
    client = F.when(F.col("event_id") % 3 == 0, "").otherwise(_text("[client ", _c("clientip"), "] "))
    ids = F.when(F.col("event_id") % 4 == 0, "").otherwise(_text("[pid ", _c("event_id"), "] "))
    return _text("[", _stamp("E MMM dd HH:mm:ss yyyy"), "] [core:", _c("level"), "] ", ids, client, error_text())


def error_text() -> Column:
    """Error texts, some of which the anomaly rules know."""
    return (
        F.when(F.col("event_id") % 6 == 0, _text("File does not exist: /srv/", _c("event_type")))
        .when(F.col("event_id") % 6 == 1, _text("user u", _c("user_id"), " not found"))
        .otherwise(_text("event ", _c("event_id"), " of ", _c("event_type")))
    )


ERROR_TEXT_SQL = (
    "CASE WHEN event_id % 6 = 0 THEN concat('File does not exist: /srv/', event_type) "
    "WHEN event_id % 6 = 1 THEN concat('user u', user_id, ' not found') "
    "ELSE concat('event ', event_id, ' of ', event_type) END"
)


def nginx_error_message() -> Column:
    upstream = F.when(F.col("event_id") % 4 == 0, "").otherwise(
        _text(', upstream: "http://10.1.1.', (F.col("user_id") % 200).cast("string"), ':8080/', _c("event_type"), '"')
    )
    return _text(
        _stamp("yyyy/MM/dd HH:mm:ss"), " [", _c("level"), "] ", (F.col("event_id") + 1).cast("string"), "#0: *7 ", error_text(),
        ", client: ", _c("clientip"), ", server: www.example.com", ', request: "', _c("verb"), " ", _c("request"), ' HTTP/1.1"',
        upstream, ', host: "www.example.com"',
    )


def mysql_error_message() -> Column:
    stamp = F.when(F.col("event_id") % 2 == 0, _stamp("yyMMdd HH:mm:ss")).otherwise(_stamp("yyyy-MM-dd HH:mm:ss"))
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("Note")
    return _text(stamp, " ", _c("event_id"), " [", level, "] ", mysql_text())


def mysql_text() -> Column:
    return F.when(F.col("event_id") % 5 == 0, _text("Access denied for user u", _c("user_id"))).otherwise(
        _text("event ", _c("event_type"))
    )


MYSQL_TEXT_SQL = (
    "CASE WHEN event_id % 5 = 0 THEN concat('Access denied for user u', user_id) ELSE concat('event ', event_type) END"
)


def beat_json(message: Column, type_: Column) -> Column:
    """Shipper JSON; now and then token, tags, type or message is missing."""
    eid = F.col("event_id")

    def but(n: int, c: Column) -> Column:
        return F.when(eid % n != 0, c)

    return F.to_json(
        F.struct(
            _stamp("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("@timestamp"),
            F.struct(
                _text("host", (F.col("user_id") % 7).cast("string")).alias("hostname"),
                F.lit("shipper").alias("name"),
                F.lit("5.1.1").alias("version"),
            ).alias("beat"),
            F.create_map(F.lit("zone"), _text("z", (F.col("user_id") % 3).cast("string")), F.lit("token"), but(23, F.col("token"))).alias("fields"),
            F.lit("log").alias("input_type"),
            but(31, message).alias("message"),
            (eid * 100).alias("offset"),
            _text("/var/log/", _c("event_type"), ".log").alias("source"),
            but(29, F.array(F.lit("t1"), F.col("event_type"))).alias("tags"),
            but(37, type_).alias("type"),
        )
    )


def transported(df: DataFrame, value: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Rows as a topic delivers them: topic, partition, offset, value (and the event id and columns to compare by)."""
    return df.select(
        "event_id",
        *keep,
        F.lit("logs").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        value.alias("value"),
    )


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One IPv4 /16 per nation, as integers."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    lo = (F.col("n_nationkey").cast("bigint") + 16) * (1 << 24) + F.col("n_regionkey").cast("bigint") * (1 << 16)
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        lo.alias("lo"),
        (lo + 65535).alias("hi"),
        F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("continent"),
    )


# geo facts of an event: its first octet gives the nation, the second must be the nation's region
GEO_JOIN_SQL = (
    "LEFT JOIN (SELECT n_nationkey, n_regionkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g "
    "ON g.n_nationkey = user_id % 32 AND g.n_regionkey = user_id % 32 % 5 AND event_id % 7 <> 0 AND event_id % 11 <> 0"
)
