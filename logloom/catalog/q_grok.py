"""Grok families: lines built from the tables must give their columns back."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.catalog import lines
from logloom.catalog.lines import with_events
from logloom.catalog.registry import query, spread, table
from logloom.operators.grok import extract, first_spans, grok, library_with

_ACCESS = (
    "CASE WHEN is_line THEN clientip END AS clientip, CASE WHEN is_line THEN '-' END AS ident, "
    "CASE WHEN is_line THEN concat('u', user_id) END AS auth, "
    "CASE WHEN is_line THEN strftime(ts, '%d/%b/%Y:%H:%M:%S +0800') END AS timestamp, "
    "CASE WHEN is_line AND NOT is_raw THEN verb END AS verb, CASE WHEN is_line AND NOT is_raw THEN request END AS request, "
    "CASE WHEN is_line AND NOT is_raw THEN '1.1' END AS httpversion, CASE WHEN is_line AND is_raw THEN 'bad line data' END AS rawrequest, "
    "CASE WHEN is_line THEN status END AS response, CASE WHEN is_line THEN nbytes END AS bytes, "
    "CASE WHEN is_line THEN concat('\"', referrer, '\"') END AS referrer, CASE WHEN is_line THEN concat('\"', agent, '\"') END AS agent"
)
ACCESS_FIELDS = (
    "clientip ident auth timestamp verb request httpversion rawrequest response bytes referrer agent".split()
)


def _messages(spark, sf_dir, message):
    return lines.events(spark, sf_dir).select("event_id", message.alias("message"))


@query("grok_access", with_events(f"SELECT event_id, {_ACCESS} FROM ev"))
def grok_access(spark, sf_dir):
    return extract(_messages(spark, sf_dir, lines.access_message()), "message", "apache_access").drop("message")


@query(
    "grok_nginx_access",
    with_events(
        f"SELECT event_id, {_ACCESS}, CASE WHEN is_line AND event_id % 5 = 0 THEN concat('10.0.0.', user_id % 256) END AS forwarder FROM ev"
    ),
)
def grok_nginx_access(spark, sf_dir):
    return extract(_messages(spark, sf_dir, lines.nginx_access_message()), "message", "nginx_access").drop("message")


@query(
    "grok_apache_error",
    with_events(
        "SELECT event_id, strftime(ts, '%a %b %d %H:%M:%S %Y') AS timestamp, 'core' AS module, level AS loglevel, "
        "CASE WHEN event_id % 4 <> 0 THEN cast(event_id AS varchar) END AS pid, cast(NULL AS varchar) AS tid, "
        f"CASE WHEN event_id % 3 <> 0 THEN clientip END AS clientip, {lines.ERROR_TEXT_SQL} AS msg FROM ev"
    ),
)
def grok_apache_error(spark, sf_dir):
    return extract(_messages(spark, sf_dir, lines.apache_error_message()), "message", "apache_error").drop("message")


@query(
    "grok_nginx_error",
    with_events(
        "SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS timestamp, level AS loglevel, cast(event_id + 1 AS varchar) AS pid, "
        f"concat('*7 ', {lines.ERROR_TEXT_SQL}) AS errormsg, clientip, 'www.example.com' AS server, "
        "concat('\"', verb, ' ', request, ' HTTP/1.1\"') AS request, "
        "CASE WHEN event_id % 4 <> 0 THEN concat('http://10.1.1.', user_id % 200, ':8080/', event_type) END AS upstream, "
        "CASE WHEN event_id % 4 <> 0 THEN '8080' END AS upstreamxport, '\"www.example.com\"' AS serverip FROM ev"
    ),
)
def grok_nginx_error(spark, sf_dir):
    out = extract(_messages(spark, sf_dir, lines.nginx_error_message()), "message", "nginx_error")
    return out.drop("message", "referrer", "referrerxport")


@query(
    "grok_mysql_error",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%y%m%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp, "
        "cast(event_id AS varchar) AS id, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'Note' END AS loglevel, "
        f"{lines.MYSQL_TEXT_SQL} AS msg FROM ev"
    ),
)
def grok_mysql_error(spark, sf_dir):
    return extract(_messages(spark, sf_dir, lines.mysql_error_message()), "message", "mysql_error").drop("message")


# further families: pattern, line expression (Spark SQL), expected fields (SQL for both engines but for time formats)
_FAMILIES = {
    "grok_syslog": (
        "SYSLOGBASE",
        "concat(date_format(ts, 'MMM dd HH:mm:ss'), ' <', user_id % 24, '.', user_id % 8, '> host', user_id % 9, ' app/', event_type, '[', event_id + 1, ']: text')",
        "strftime(ts, '%b %d %H:%M:%S') AS timestamp, cast(user_id % 24 AS varchar) AS facility, cast(user_id % 8 AS varchar) AS priority, "
        "concat('host', user_id % 9) AS logsource, concat('app/', event_type) AS program, cast(event_id + 1 AS varchar) AS pid",
    ),
    "grok_vendor_access": (
        "eachbuyer",
        "concat('\"10.2.', user_id % 256, '.9, 10.3.0.', event_id % 256, '\" shop.example.com - u', user_id, ' [', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), "
        "' +0000] \"', verb, ' /', event_type, ' HTTP/1.1\" ', status, ' ', event_id, ' \"', referrer, '\" \"0.', user_id, '\" \"\"0.5\" \"', agent, '\"')",
        "concat('10.2.', user_id % 256, '.9') AS clientip, concat('10.3.0.', event_id % 256) AS proxyip, 'shop.example.com' AS host, "
        "concat('u', user_id) AS auth, strftime(ts, '%d/%b/%Y:%H:%M:%S +0000') AS timestamp, verb, concat('/', event_type) AS request, "
        "'1.1' AS httpversion, cast(NULL AS varchar) AS rawrequest, status, cast(event_id AS varchar) AS bytes, concat('\"', referrer, '\"') AS referrer, "
        "concat('0.', user_id) AS requesttime, '0.5' AS upstreamresponsetime, concat('\"', agent, '\"') AS agent",
    ),
    "grok_rsyslog": (
        "RSYSLOG",
        "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+08:00 host', user_id % 9, ' ', event_type, '[', user_id, ']: done ', event_id)",
        "strftime(ts, '%Y-%m-%dT%H:%M:%S+08:00') AS timestamp, concat('host', user_id % 9) AS client, "
        "concat(event_type, '[', user_id, ']:') AS module, concat('done ', event_id) AS msg",
    ),
    "grok_log4j": (
        "LOG4J",
        "concat(date_format(ts, 'MMM dd HH:mm:ss'), ' host', user_id % 9, ' java ', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',123 INFO [main-', user_id, "
        "'] org.demo.Main$.', event_type, ' - done ', event_id)",
        "strftime(ts, '%b %d %H:%M:%S') AS t1, concat('host', user_id % 9) AS hostname, 'java' AS lang, strftime(ts, '%Y-%m-%d %H:%M:%S,123') AS timestamp, "
        "'INFO' AS loglevel, concat('[main-', user_id, ']') AS thread, 'org.demo.Main' AS class, event_type AS method, concat('done ', event_id) AS msg",
    ),
    "grok_php": (
        "ROOBOPHP",
        "concat('[', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '] app.INFO: client(', clientip, '), url(', request, '), startms(', event_id, '), usedms(', user_id, "
        "'), request({}), response(ok', event_id, ') [] []')",
        "strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, 'app' AS logname, 'INFO' AS level, clientip, request AS url, cast(event_id AS varchar) AS startms, "
        "cast(user_id AS varchar) AS usedms, '{}' AS request, concat('ok', event_id) AS response",
    ),
    "grok_service": (
        "SCMCLIENT",
        "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',123456 [host', user_id % 9, '] [svc] [main.cpp:', event_id, '] [', level, '] : process id [', user_id, '] ', event_type)",
        "strftime(ts, '%Y-%m-%d %H:%M:%S,123') AS timestamp, concat('host', user_id % 9) AS HostAlias, 'svc' AS SrvName, 'main.cpp' AS FileName, "
        "cast(event_id AS varchar) AS Line, level AS loglevel, cast(user_id AS varchar) AS PID, event_type AS OtherInfo",
    ),
    "grok_service_link": (
        "STMLINK",
        "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',123456 [host', user_id % 9, ' x] [svc] [main.cpp:', event_id, '] [', level, '] : ', event_type)",
        "strftime(ts, '%Y-%m-%d %H:%M:%S,123') AS timestamp, concat('host', user_id % 9) AS HostAlias, 'x' AS sth, 'svc' AS SrvName, 'main.cpp' AS FileName, "
        "cast(event_id AS varchar) AS Line, level AS loglevel, event_type AS OtherInfo",
    ),
    "grok_service_manager": (
        "SCMMANAGER",
        "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',123456 [host', user_id % 9, ' x] [svc] [main.cpp:', event_id, '] [', level, '] : LinkId[', user_id, '] ', event_type)",
        "strftime(ts, '%Y-%m-%d %H:%M:%S,123') AS timestamp, concat('host', user_id % 9) AS HostAlias, 'x' AS sth, 'svc' AS SrvName, 'main.cpp' AS FileName, "
        "cast(event_id AS varchar) AS Line, level AS loglevel, cast(user_id AS varchar) AS LinkId, concat(' ', event_type) AS OtherInfo",
    ),
    "grok_mysql_general": (
        "mysql_general_query",
        "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z ', event_id, ' Query SELECT ', user_id, ' FROM ', event_type)",
        "strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, cast(event_id AS varchar) AS id, 'Query' AS command, "
        "concat('SELECT ', user_id, ' FROM ', event_type) AS argument",
    ),
    "grok_hadoop": (
        "hadoop",
        "concat(date_format(ts, 'yyyy/MM/dd HH:mm:ss'), ' INFO org.demo.', event_type, ': block ', event_id)",
        "strftime(ts, '%Y/%m/%d %H:%M:%S') AS timestamp, 'INFO' AS loglevel, concat('org.demo.', event_type) AS class, concat('block ', event_id) AS msg",
    ),
}
for _name, (_pattern, _line, _fields) in _FAMILIES.items():

    @query(_name, with_events(f"SELECT event_id, {_fields} FROM ev"))
    def _run(spark, sf_dir, pattern=_pattern, line=_line):
        return extract(_messages(spark, sf_dir, F.expr(line)), "message", pattern).drop("message")


@query(
    "grok_multi",
    with_events(
        "SELECT event_id, 'LAST' AS word, cast(event_id AS varchar) AS number, cast(user_id AS varchar) AS first FROM ev"
    ),
)
def grok_multi(spark, sf_dir):
    """All listed patterns are tried; fields of later matches overwrite earlier ones."""
    message = F.expr("concat(user_id, ' then ', event_id, ' LAST')")
    patterns = {
        "A": r"^%{INT:first} %{WORD:word} %{INT:number}",
        "B": r"%{WORD:word}$",
        "C": r"never %{WORD:word}",
    }
    step = grok("message", ["A", "B", "C", "NO_SUCH_PATTERN"], patterns)
    return step(_messages(spark, sf_dir, message)).drop("message")


@query(
    "grok_first",
    with_events(
        "SELECT event_id, CASE WHEN event_type = 'click' THEN 'A' ELSE 'B' END AS via, "
        "CASE WHEN event_type = 'click' THEN cast(user_id AS varchar) END AS a, "
        "CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS b FROM ev"
    ),
)
def grok_first(spark, sf_dir):
    """The first pattern that fits decides."""
    message = F.expr("concat(event_type, ' ', user_id)")
    step = grok("message", ["A", "B"], {"A": "^click %{INT:a}", "B": "^%{WORD:b}"}, mode="first")
    out = step(_messages(spark, sf_dir, message))
    return out.select("event_id", F.when(F.col("a").isNotNull(), "A").otherwise("B").alias("via"), "a", "b")


@query(
    "grok_custom",
    with_events("SELECT event_id, event_type AS kind, cast(user_id AS varchar) AS kindxuid, k AS rest FROM ev"),
)
def grok_custom(spark, sf_dir):
    """User patterns extend and replace the shipped ones; a group within a field gets a joined name."""
    library = library_with({"WORD": r"[a-z]+(?:#%{INT:uid})?", "LINE": "%{WORD:kind} %{NUMBER:rest}"})
    out = extract(_messages(spark, sf_dir, F.expr("concat('x ', event_type, '#', user_id, ' ', get_json_object(props, '$.k'))")), "message", "LINE", library)
    return out.select("event_id", F.split("kind", "#")[0].alias("kind"), "kindxuid", "rest")


@query(
    "grok_by_type",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp, "
        "CASE WHEN event_id % 2 = 0 THEN 'INFO' ELSE 'Note' END AS loglevel, concat('about ', event_type) AS msg FROM ev"
    ),
)
def grok_by_type(spark, sf_dir):
    """Without a list the pattern follows the event's type."""
    line = (
        "CASE WHEN event_id % 2 = 0 THEN concat(date_format(ts, 'yyyy/MM/dd HH:mm:ss'), ' INFO org.Demo: about ', event_type) "
        "ELSE concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' ', event_id, ' [Note] about ', event_type) END"
    )
    ev = lines.events(spark, sf_dir).select(
        "event_id", F.expr("CASE WHEN event_id % 2 = 0 THEN 'hadoop' ELSE 'mysql_error' END").alias("type"), F.expr(line).alias("message")
    )
    return grok("message")(ev).select("event_id", "timestamp", "loglevel", "msg")


@query(
    "grok_uri",
    r"SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS proto, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, "
    r"regexp_extract(url, '^[a-z]+://[^/]+(/[^?]*)', 1) AS path, nullif(regexp_extract(url, '(\?.*)', 1), '') AS params FROM pages",
)
def grok_uri(spark, sf_dir):
    library = library_with({"PAGE": r"^%{URIPROTO:proto}://%{URIHOST:host}%{URIPATH:path}%{URIPARAM:params}?"})
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return extract(pages, "url", "PAGE", library).select("page_id", "proto", "host", "path", "params")


@query(
    "grok_network",
    r"SELECT doc_id, nullif(regexp_extract(text, '(?:^|[^0-9])((?:(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.]){3}(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2}))(?:[^0-9]|$)', 1), '') AS ip "
    "FROM documents",
)
def grok_network(spark, sf_dir):
    """First IPv4 address anywhere in a whole text."""
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    return extract(docs, "text", "FOUND", library_with({"FOUND": "%{IPV4:ip}"})).select("doc_id", "ip")


@query(
    "grok_spans",
    with_events(
        "SELECT event_id, s.name, s.value, CASE WHEN s.value IS NULL THEN 0 ELSE s.pos END AS start, "
        "CASE WHEN s.value IS NULL THEN s.total ELSE s.pos + length(s.value) END AS \"end\" FROM (SELECT event_id, unnest(["
        "{'name': 'verb', 'value': verb, 'pos': 0, 'total': length(verb) + 1 + length(request) + 3}, "
        "{'name': 'path', 'value': concat('/', event_type), 'pos': length(verb) + 1, 'total': length(verb) + 1 + length(request) + 3}, "
        "{'name': 'params', 'value': nullif(substr(request, length(event_type) + 2), ''), 'pos': length(verb) + 2 + length(event_type), "
        "'total': length(verb) + 1 + length(request) + 3}]) AS s FROM ev)"
    ),
)
def grok_spans(spark, sf_dir):
    """Group positions; a group that took no part gets the span of the whole text."""
    library = library_with({"REQ": r"^%{WORD:verb} %{URIPATH:path}%{URIPARAM:params}? ..$"})
    ev = lines.events(spark, sf_dir)
    ev = ev.select("event_id", F.concat("verb", F.lit(" "), "request", F.lit(" ok")).alias("text"))
    return ev.select("event_id", F.inline(first_spans("text", ["NONE", "REQ"], library))).select(
        "event_id", "name", "value", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end")
    )


_MARKS_SQL = "CASE WHEN event_id % 3 = 0 THEN concat(chr(1), chr(2), chr(3)) WHEN event_id % 3 = 1 THEN concat(chr(3), chr(1), chr(2)) ELSE chr(1) END"


@query(
    "grok_control_characters",
    f"SELECT event_id, concat({_MARKS_SQL}, 'w') AS word, concat('', user_id) AS num, concat('tail', {_MARKS_SQL}) AS rest, "
    f"length({_MARKS_SQL}) + 2 AS num_start FROM events",
)
def grok_control_characters(spark, sf_dir):
    """Texts that hold the characters captures are kept apart by come back whole, with their positions."""
    marks = F.expr(_MARKS_SQL.replace("chr(", "char("))
    text = F.concat(marks, F.lit("w "), "user_id", F.lit(" tail"), marks)
    library = library_with({"MARKED": r"(?<word>[^ ]+) %{INT:num} (?<rest>.*)"})
    ev = extract(table(spark, sf_dir, "events").select("event_id", text.alias("text")), "text", "MARKED", library)
    found = F.filter(first_spans("text", ["MARKED"], library), lambda s: s["name"] == "num")
    return ev.select("event_id", "word", "num", "rest", found[0]["start"].cast("bigint").alias("num_start"))
