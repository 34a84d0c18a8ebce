"""Dates, geo, user agent, split, key-value, JSON, XML and anomaly queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.catalog import lines
from logloom.catalog.lines import with_events
from logloom.catalog.registry import query, spread, table
from logloom.functions import dates
from logloom.functions.cols import map_text
from logloom.operators import anomaly, json_fields, split_kv, useragent, xml_fields
from logloom.operators.dates import date
from logloom.operators.geo import geo, ranges_from_cidr, ranges_from_longs

_SECOND = "epoch_us(date_trunc('second', ts)) // 1000"
_CN = 8 * 3600 * 1000

# ---- dates


@query("parse_date", with_events(f"SELECT event_id, CASE WHEN is_line THEN cast({_SECOND} - {_CN} AS varchar) END AS event_timestamp FROM ev"))
def parse_date(spark, sf_dir):
    text = F.when(F.col("is_line"), F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0800"))).otherwise("no time")
    ev = lines.events(spark, sf_dir).withColumn("timestamp", text)
    out = date("timestamp", [("dd/MMM/yyyy:HH:mm:ss Z", "Asia/Shanghai", "en")])(ev)
    return out.select("event_id", F.col("event_timestamp").cast("string").alias("event_timestamp"))


@query("parse_date_tz", with_events(f"SELECT event_id, {_SECOND} - {_CN} AS event_timestamp FROM ev"))
def parse_date_tz(spark, sf_dir):
    """A format without zone takes the configured one; a leading day name is accepted."""
    ev = lines.events(spark, sf_dir).withColumn("timestamp", F.date_format("ts", "E MMM dd HH:mm:ss yyyy"))
    return date("timestamp", [("E MMM dd HH:mm:ss YYYY", "Asia/Shanghai")])(ev).select("event_id", "event_timestamp")


@query(
    "parse_date_multi",
    with_events(
        f"SELECT event_id, CASE event_id % 5 WHEN 0 THEN {_SECOND} WHEN 1 THEN {_SECOND} WHEN 2 THEN {_SECOND} - {_CN} "
        f"WHEN 3 THEN epoch_us(ts) // 1000 ELSE {lines.NOW} END AS event_timestamp FROM ev"
    ),
)
def parse_date_multi(spark, sf_dir):
    """Several formats, the first that fits; otherwise the given time."""
    text = F.expr(
        "CASE event_id % 5 WHEN 0 THEN date_format(ts, 'yyyy/MM/dd H:mm:ss') WHEN 1 THEN date_format(ts, 'EEE MMM d HH:mm:ss yyyy') "
        "WHEN 2 THEN concat(date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +08:00') "
        "WHEN 3 THEN cast(unix_millis(cast(ts as timestamp)) as string) ELSE 'junk' END"
    )
    formats = [("dd/MMM/yyyy:HH:mm:ss Z",), ("E MMM dd HH:mm:ss yyyy",), ("yyyy/MM/dd HH:mm:ss",), ("epoch_millis",)]
    ev = lines.events(spark, sf_dir).withColumn("timestamp", text)
    return date("timestamp", formats, fallback_now=True, now=lines.NOW)(ev).select("event_id", "event_timestamp")


@query("parse_date_locale", with_events(f"SELECT event_id, {_SECOND} AS event_timestamp FROM ev"))
def parse_date_locale(spark, sf_dir):
    """Month names of another language."""
    text = F.concat_ws(" ", F.date_format("ts", "dd"), F.lit("janvier"), F.date_format("ts", "yyyy HH:mm:ss"))
    ev = lines.events(spark, sf_dir).select("event_id", text.alias("timestamp"))
    return ev.select("event_id", dates.parse_millis(F.col("timestamp"), "dd MMMM yyyy HH:mm:ss", "UTC", "fr").alias("event_timestamp"))


# ---- geo

_GEO_SQL = with_events(
    "SELECT event_id, clientip, CASE WHEN g.n_name IS NOT NULL THEN concat('City ', g.n_nationkey) END AS city, g.n_name AS country, "
    f"g.r_name AS continent FROM ev {lines.GEO_JOIN_SQL}"
)


def _geo(spark, sf_dir, ranges, **options):
    ev = lines.events(spark, sf_dir).select("event_id", "clientip")
    return geo(ranges, "clientip", **options)(ev).select("event_id", "clientip", "city", "country", "continent")


@query("geo_enrich", _GEO_SQL)
def geo_enrich(spark, sf_dir):
    return _geo(spark, sf_dir, ranges_from_longs(lines.geo_ranges(spark, sf_dir)))


@query("geo_enrich_shuffled", _GEO_SQL)
def geo_enrich_shuffled(spark, sf_dir):
    """The way taken when the range table is too large to broadcast."""
    return _geo(spark, sf_dir, ranges_from_longs(lines.geo_ranges(spark, sf_dir)), broadcast_rows=0)


@query(
    "geo_enrich_v6",
    with_events(
        "SELECT event_id, CASE WHEN g.n_name IS NOT NULL THEN concat('City ', g.n_nationkey) END AS city, g.n_name AS country, "
        "g.r_name AS continent FROM ev LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g "
        "ON g.n_nationkey = user_id % 32"
    ),
)
def geo_enrich_v6(spark, sf_dir):
    """IPv6 addresses in several spellings against CIDR blocks."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    blocks = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.format_string("2001:%x::/33", F.col("n_nationkey").cast("int") + 0xDB0).alias("network"),
        F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("continent"),
    )
    group = (F.col("user_id") % 32).cast("int") + 0xDB0
    low = (F.col("event_id") % 65536).cast("int")
    ip = (
        F.when(F.col("event_id") % 3 == 0, F.format_string("2001:%x::%x", group, low))
        .when(F.col("event_id") % 3 == 1, F.format_string("2001:%X:0:0:0:0:0:%x", group, low))
        .otherwise(F.format_string("2001:%x:7fff::10.%d.0.1", group, low % 256))
    )
    ev = lines.events(spark, sf_dir).select("event_id", ip.alias("clientip"))
    return geo(ranges_from_cidr(blocks))(ev).select("event_id", "city", "country", "continent")


_NESTED_SQL = with_events(
    "SELECT event_id, clientip, CASE WHEN event_id % 11 <> 0 AND second = n_regionkey THEN concat('City ', n_nationkey) END AS city, "
    "CASE WHEN event_id % 11 <> 0 THEN CASE WHEN n_name IS NULL THEN 'World' WHEN second >= 8 THEN concat('East ', n_name) ELSE n_name END END AS country, "
    "CASE WHEN event_id % 11 <> 0 THEN coalesce(r_name, 'EARTH') END AS continent "
    "FROM (SELECT *, TRY_CAST(split_part(clientip, '.', 2) AS int) AS second FROM ev) LEFT JOIN (SELECT n_nationkey, n_regionkey, n_name, r_name FROM nation "
    "JOIN region ON n_regionkey = r_regionkey) ON n_nationkey = user_id % 32"
)


def nested_ranges(spark, sf_dir):
    """All addresses, inside them a /8 a nation, inside that a /16 and a half that is no CIDR block; as hex bounds."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    first = (F.col("n_nationkey").cast("bigint") + 16) * (1 << 24)
    city = F.concat(F.lit("City "), F.col("n_nationkey").cast("string"))
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    second = F.col("n_regionkey").cast("bigint") * (1 << 16)

    def part(lo, hi, city, country):
        return rows.select(lo.alias("lo"), hi.alias("hi"), city.alias("city"), country.alias("country"), F.col("r_name").alias("continent"))

    none = F.lit(None).cast("string")
    whole = part(first, first + (1 << 24) - 1, none, F.col("n_name"))
    inner = part(first + second, first + second + (1 << 16) - 1, city, F.col("n_name"))
    half = part(first + 8 * (1 << 16), first + (1 << 24) - 2, none, F.concat(F.lit("East "), "n_name"))
    earth = spark.range(1).selectExpr("0L AS lo", "4294967295L AS hi", "cast(null AS string) AS city", "'World' AS country", "'EARTH' AS continent")
    return ranges_from_longs(whole.unionByName(inner).unionByName(half).unionByName(earth))


@query("geo_enrich_nested", _NESTED_SQL)
def geo_enrich_nested(spark, sf_dir):
    """Ranges inside ranges: the most specific one gives the place."""
    return _geo(spark, sf_dir, nested_ranges(spark, sf_dir))


@query("geo_enrich_nested_shuffled", _NESTED_SQL)
def geo_enrich_nested_shuffled(spark, sf_dir):
    """The same by way of the distinct addresses, as for a table too large to broadcast."""
    return _geo(spark, sf_dir, nested_ranges(spark, sf_dir), broadcast_rows=0)


# ---- user agent


def _facts_sql(**columns: int) -> str:
    picks = ", ".join(
        f"{lines.sql_list(fact[i] for fact in lines.AGENT_FACTS)}[event_id % {len(lines.AGENTS)} + 1] AS {name}"
        for name, i in columns.items()
    )
    return f"SELECT event_id, {picks} FROM events"


def _quoted_agents(spark, sf_dir):
    ev = lines.events(spark, sf_dir)
    return ev.select("event_id", F.concat(F.lit('"'), "agent", F.lit('"')).alias("agent"))


@query("ua_enrich", _facts_sql(agent_browser=3, agent_os=4))
def ua_enrich(spark, sf_dir):
    return useragent.user_agent("agent")(_quoted_agents(spark, sf_dir)).drop("agent")


for _name, _fn, _at in (
    ("ua_browser_tag", useragent.browser_tag, 0),
    ("ua_bot", useragent.bot_name, 1),
    ("ua_fallback", useragent.product_token, 2),
    ("ua_os", useragent.os_family, 4),
):

    @query(_name, _facts_sql(found=_at))
    def _run(spark, sf_dir, fn=_fn):
        ev = _quoted_agents(spark, sf_dir)
        ev = ev.withColumn("agent", useragent.clean_agent(F.col("agent")))
        return ev.select("event_id", fn("agent").alias("found"))


# ---- split and key-value


def _urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url")


@query(
    "split_named",
    r"SELECT page_id, string_split_regex(url, '\?')[1] AS request_path, nullif(regexp_extract(url, '\?(.*)$', 1), '') AS request_params FROM pages",
)
def split_named(spark, sf_dir):
    step = split_kv.split("url", r"\?", 2, ["request_path", "request_params"])
    return step(_urls(spark, sf_dir)).select("page_id", "request_path", "request_params")


@query(
    "split_indexed",
    "SELECT page_id, array_to_string(list_sort(list_transform(range(len(parts)), lambda i: concat(i, '=', parts[i + 1]))), ';') AS parts "
    "FROM (SELECT page_id, string_split_regex(url, '[/.]') AS parts FROM pages)",
)
def split_indexed(spark, sf_dir):
    out = split_kv.split("url", "[/.]")(_urls(spark, sf_dir))
    return out.select("page_id", map_text(F.col("url_parts")).alias("parts"))


@query(
    "split_trimmed",
    r"SELECT page_id, CAST(len(string_split_regex(regexp_replace(url, '[/]+$', ''), '/')) AS bigint) AS parts FROM pages",
)
def split_trimmed(spark, sf_dir):
    """Limit 0 drops trailing empty parts."""
    parts = F.size(split_kv.split_parts(F.col("url"), "/", 0)).cast("bigint")
    return _urls(spark, sf_dir).select("page_id", parts.alias("parts"))


@query(
    "kv_map",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 9 = 0 THEN concat('k=', k, ';q=select+a+from+b;uid=last') "
        "ELSE concat('k=', k, ';uid=', user_id) END AS params FROM ev"
    ),
)
def kv_map(spark, sf_dir):
    ev = lines.events(spark, sf_dir)
    out = split_kv.split("request", r"\?", 2, ["request_path", "request_params"])(ev)
    out = split_kv.kv("request_params", "&", "=")(out)
    return out.select("event_id", map_text(F.col("request_params_map")).alias("params"))


@query(
    "kv_prefixed",
    "SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS request_param_page, "
    "nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS request_param_utm_source FROM pages",
)
def kv_prefixed(spark, sf_dir):
    out = split_kv.split("url", r"\?", 2, ["path", "params"])(_urls(spark, sf_dir))
    out = split_kv.kv("params", "[&#]", "=", prefix="request_param_", keys=["page", "utm_source"])(out)
    return out.select("page_id", "request_param_page", "request_param_utm_source")


@query(
    "split_spans",
    "SELECT page_id, cast(pos AS bigint) AS start, cast(pos + length(piece) AS bigint) AS \"end\", piece FROM ("
    "SELECT page_id, parts[i] AS piece, list_sum(list_transform(parts[1:i], lambda p: length(p))) - length(parts[i]) + i - 1 AS pos "
    "FROM (SELECT page_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT page_id, string_split_regex(url, '[/.?=&]') AS parts FROM pages)))",
)
def split_spans(spark, sf_dir):
    out = _urls(spark, sf_dir).select("page_id", F.inline(split_kv.split_spans(F.col("url"), "[/.?=&]")))
    return out.select("page_id", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "piece")


@query(
    "split_spans_words",
    r"SELECT doc_id, count(*) AS pieces, sum(pos)::bigint AS sum_start, sum(pos + length(piece))::bigint AS sum_end FROM ("
    r"SELECT doc_id, piece, sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(piece) - 1 AS pos "
    r"FROM (SELECT doc_id, unnest(parts) AS piece, unnest(range(1, len(parts) + 1)) AS i FROM "
    r"(SELECT doc_id, string_split_regex(text, ' ') AS parts FROM documents))) GROUP BY doc_id",
)
def split_spans_words(spark, sf_dir):
    """Word positions of whole documents, summed up per document."""
    spans = split_kv.split_spans(F.col("text"), " ")
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", spans.alias("s"))

    def total(name):
        return F.aggregate("s", F.lit(0).cast("bigint"), lambda a, e: a + e[name])

    return docs.select("doc_id", F.size("s").cast("bigint").alias("pieces"), total("start").alias("sum_start"), total("end").alias("sum_end"))


@query(
    "kv_spans",
    with_events(
        "SELECT event_id, s.name, s.start::bigint AS start, (s.start + length(s.value))::bigint AS \"end\", s.value FROM ("
        "SELECT event_id, unnest([{'name': 'uid', 'start': 4, 'value': concat('', user_id)}, "
        "{'name': 'flag', 'start': 5 + length(concat('', user_id)), 'value': 'flag'}, "
        "{'name': 'k', 'start': 12 + length(concat('', user_id)), 'value': k}]) AS s FROM ev)"
    ),
)
def kv_spans(spark, sf_dir):
    text = F.concat(F.lit("uid="), F.col("user_id").cast("string"), F.lit("&flag&k="), F.col("k"))
    spans = split_kv.kv_spans(text, "&", "=")
    out = lines.events(spark, sf_dir).select("event_id", F.inline(spans))
    return out.select("event_id", "name", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "value")


# ---- JSON and XML


def _nested(spark, sf_dir):
    """JSON of all events: the shipped props inside a nested document, every twelfth cut short."""
    text = F.expr(
        "concat('{\"id\":', event_id, ',\"user\":{\"name\":\"', token, '\",\"tags\":[\"', event_type, '\",null,{\"deep\":{\"x\":[1,{\"y\":2}]}}]},\"props\":', props, ',\"none\":null}')"
    )
    text = F.when(F.col("event_id") % 12 == 0, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return lines.events(spark, sf_dir).select("event_id", text.alias("doc"))


@query(
    "json_path",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 12 <> 0 THEN k END AS k, CASE WHEN event_id % 12 <> 0 THEN token END AS name, "
        "CASE WHEN event_id % 12 <> 0 THEN event_type END AS first_tag, CASE WHEN event_id % 12 <> 0 THEN '3' END AS tags, "
        "CAST(NULL AS varchar) AS nothing FROM ev"
    ),
)
def json_path(spark, sf_dir):
    paths = {"k": "$.props.k", "name": "$['user'].name", "first_tag": "$.user.tags[0]", "tags": "$.user.tags.length()", "nothing": "$.no.such"}
    return json_fields.json_values("doc", paths)(_nested(spark, sf_dir)).select("event_id", *paths)


@query(
    "json_flatten",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 12 <> 0 THEN concat('0=', event_type, ';2={\"deep\":{\"x\":[1,{\"y\":2}]}};id=', event_id, ';k=', k, ';name=', token) END AS fields FROM ev"
    ),
)
def json_flatten(spark, sf_dir):
    """Whole document down to level 3; what lies deeper stays JSON text."""
    return _nested(spark, sf_dir).select("event_id", map_text(json_fields.flatten(F.col("doc"), ["$"], 3)).alias("fields"))


@query(
    "json_flatten_paths",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 12 <> 0 THEN concat('0=', event_type, ';2={\"deep\":{\"x\":[1,{\"y\":2}]}};id=', event_id, ';k=', k, ';user-name=', token, ';y=2') END AS fields FROM ev"
    ),
)
def json_flatten_paths(spark, sf_dir):
    """Several paths: a scalar takes the joined path names, an object its keys, a wildcard its positions."""
    paths = ["$.id", "$.user.name", "$.props", "$.user.tags[2].deep.x[1]"]
    fields = json_fields.flatten(F.col("doc"), [*paths, "$.user.tags[*]"], 1)
    return _nested(spark, sf_dir).select("event_id", map_text(fields).alias("fields"))


_DEEP_SQL = with_events(
    "SELECT event_id, CASE WHEN event_id % 12 <> 0 THEN token END AS deep_name, CASE WHEN event_id % 12 <> 0 THEN '2' END AS deep_y, "
    "CASE WHEN event_id % 12 <> 0 THEN k END AS deep_k, CASE WHEN event_id % 12 <> 0 THEN event_type END AS first_of_two, "
    "CASE WHEN event_id % 12 <> 0 THEN '{\"deep\":{\"x\":[1,{\"y\":2}]}}' END AS last_tag, "
    "CASE WHEN event_id % 12 <> 0 AND event_id % 10 >= 5 THEN concat('i', event_id % 10) END AS large, "
    "CASE WHEN event_id % 12 <> 0 THEN concat('0={\"v\":1};1={\"v\":', event_id % 10, ',\"w\":\"i', event_id % 10, '\"};c=z;id=', event_id) END AS fields FROM ev"
)


@query("json_paths_deep", _DEEP_SQL)
def json_paths_deep(spark, sf_dir):
    """Recursive steps, several indexes, positions from the end, slices, several names and tests."""
    items = F.expr("concat(',\"items\":[{\"v\":1},{\"v\":', event_id % 10, ',\"w\":\"i', event_id % 10, '\"},{\"c\":\"z\"}]}')")
    docs = _nested(spark, sf_dir).withColumn("doc", F.when(F.col("event_id") % 12 == 0, F.col("doc")).otherwise(F.concat(F.expr("substr(doc, 1, length(doc) - 1)"), items)))
    paths = {
        "deep_name": "$..name", "deep_y": "$.user..y", "deep_k": "$..['k']", "first_of_two": "$.user.tags[0,1]", "last_tag": "$.user.tags[-1]",
        "large": "$.items[?(@.v >= 5 && @.w)].w",
    }
    out = json_fields.json_values("doc", paths)(docs)
    flat = json_fields.flatten(F.col("doc"), ["$['id','none']", "$.items[2]", "$.items[0:2]"], 1)
    return out.select("event_id", *paths, map_text(flat).alias("fields"))


def _xml(spark, sf_dir):
    """XML of all events; every fourteenth is malformed, in turn inside the root or after it."""
    text = F.expr("concat('<e id=\"', event_id, '\"><t lang=\"', event_type, '\"> ', token, ' </t><s><u>', user_id, '</u></s><v/></e>')")
    broken = ["<e><t>", "<e/>junk", "<e/><e/>", "<e>1</e> tail <", "text", "</e>"]
    turn = (F.floor(F.col("event_id") / 14) % len(broken)).cast("int")
    text = F.when(F.col("event_id") % 14 == 0, F.get(F.array(*map(F.lit, broken)), turn)).otherwise(text)
    return lines.events(spark, sf_dir).select("event_id", text.alias("doc"))


@query(
    "xml_path",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 14 <> 0 THEN token END AS t, CASE WHEN event_id % 14 <> 0 THEN cast(user_id AS varchar) END AS u, "
        "CAST(NULL AS varchar) AS v FROM ev"
    ),
)
def xml_path(spark, sf_dir):
    paths = {"t": "/e/t/text()", "u": "//u/text()", "v": "/e/v/text()"}
    return xml_fields.xml_values("doc", paths)(_xml(spark, sf_dir)).select("event_id", *paths)


@query(
    "xml_attr",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 14 <> 0 THEN cast(event_id AS varchar) END AS id, CASE WHEN event_id % 14 <> 0 THEN event_type END AS lang FROM ev"
    ),
)
def xml_attr(spark, sf_dir):
    paths = {"id": "/e/@id", "lang": "/e/t/@lang"}
    return xml_fields.xml_values("doc", paths)(_xml(spark, sf_dir)).select("event_id", *paths)


@query(
    "xml_flatten",
    with_events(
        "SELECT event_id, CASE WHEN event_id % 14 <> 0 THEN concat('#id=', event_id, ';e#lang=', event_type, ';e-s-u=', user_id, ';e-t=', token) END AS fields FROM ev"
    ),
)
def xml_flatten(spark, sf_dir):
    return _xml(spark, sf_dir).select("event_id", map_text(xml_fields.xml_flatten("doc", ["/e"])).alias("fields"))


# ---- anomalies and labels


def _rules_sql(rules) -> str:
    """The rules as SQL conditions; both engines read these expressions alike."""
    return ", ".join(f"CASE WHEN regexp_full_match({f}, {lines.sql_text(rx)}) THEN '{level}' END AS {tag}" for f, rx, tag, level in rules)


@query(
    "anomaly_regex",
    with_events(
        "SELECT event_id, CASE WHEN status = '500' THEN 'error' END AS server_error, CASE WHEN event_id % 10 = 0 THEN 'info' END AS bare FROM ev"
    ),
)
def anomaly_regex(spark, sf_dir):
    rules = [("status", "5..", "server_error", "error"), ("request", "/[a-z]+", "bare", "info"), ("no_field", ".*", "never", "error")]
    return anomaly.regex_anomalies(rules)(lines.events(spark, sf_dir)).select("event_id", "server_error", "bare")


@query("anomaly_web", with_events(f"SELECT event_id, {_rules_sql(anomaly.WEB_RULES)} FROM (SELECT *, status AS response FROM ev)"))
def anomaly_web(spark, sf_dir):
    ev = lines.events(spark, sf_dir).withColumn("response", F.col("status"))
    return anomaly.regex_anomalies(anomaly.WEB_RULES)(ev).select("event_id", *[r[2] for r in anomaly.WEB_RULES])


@query("anomaly_error", with_events(f"SELECT event_id, {_rules_sql(anomaly.APACHE_ERROR_RULES)} FROM (SELECT *, {lines.ERROR_TEXT_SQL} AS msg FROM ev)"))
def anomaly_error(spark, sf_dir):
    ev = lines.events(spark, sf_dir).withColumn("msg", lines.error_text())
    return anomaly.regex_anomalies(anomaly.APACHE_ERROR_RULES)(ev).select("event_id", *[r[2] for r in anomaly.APACHE_ERROR_RULES])


@query("anomaly_nginx_error", with_events(f"SELECT event_id, {_rules_sql(anomaly.NGINX_ERROR_RULES)} FROM (SELECT *, {lines.ERROR_TEXT_SQL} AS errormsg FROM ev)"))
def anomaly_nginx_error(spark, sf_dir):
    ev = lines.events(spark, sf_dir).withColumn("errormsg", lines.error_text())
    return anomaly.regex_anomalies(anomaly.NGINX_ERROR_RULES)(ev).select("event_id", *[r[2] for r in anomaly.NGINX_ERROR_RULES])


@query("anomaly_mysql", with_events(f"SELECT event_id, {_rules_sql(anomaly.MYSQL_RULES)} FROM (SELECT *, {lines.MYSQL_TEXT_SQL} AS msg FROM ev)"))
def anomaly_mysql(spark, sf_dir):
    ev = lines.events(spark, sf_dir).withColumn("msg", lines.mysql_text())
    return anomaly.regex_anomalies(anomaly.MYSQL_RULES)(ev).select("event_id", *[r[2] for r in anomaly.MYSQL_RULES])


def _label_sql(name: str) -> str:
    digest = f"md5(concat(event_id, '|{name}|0'))"
    share = f"('0x' || substr({digest}, 1, 8))::bigint / 4294967296.0"
    draw = f"('0x' || substr({digest}, 9, 8))::bigint % 100"
    return (
        f"CASE WHEN {share} < 0.05 THEN CASE WHEN {draw} < 10 THEN 'error' WHEN {draw} < 30 THEN 'unknown' WHEN {draw} < 60 THEN 'warn' ELSE 'info' END END AS {name}"
    )


@query("label_weighted", f"SELECT event_id, {_label_sql('anomaly_demo')}, {_label_sql('anomaly_other')} FROM events")
def label_weighted(spark, sf_dir):
    step = anomaly.weighted_labels(["anomaly_demo", "anomaly_other"], "event_id")
    return step(table(spark, sf_dir, "events")).select("event_id", "anomaly_demo", "anomaly_other")
