"""Field mutations, index names, rotation and mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.catalog import lines
from logloom.catalog.lines import with_events
from logloom.catalog.registry import query, table
from logloom.functions import rotation
from logloom.operators import mapping, mutate
from logloom.session import cut_lineage

# name, steps, output columns, SQL of the outputs; all over the whole of events
_STEPS = {
    "mut_remove": (lambda: [mutate.remove("verb", "status")], ["token", "request"], "token, request"),
    "mut_create": (lambda: [mutate.create("nbytes", "0"), mutate.create("env", "prod")], ["nbytes", "env"], "coalesce(nbytes, '0') AS nbytes, 'prod' AS env"),
    "mut_create_from": (
        lambda: [mutate.create_from("nbytes", "verb"), mutate.create_from("copy", "nbytes"), mutate.create_from("none", "no_field")],
        ["nbytes", "copy", "none"],
        "coalesce(nbytes, verb) AS nbytes, coalesce(nbytes, verb) AS copy, '' AS none",
    ),
    "mut_insert": (lambda: [mutate.insert("verb", "X"), mutate.insert("env", "prod")], ["verb", "env"], "'X' AS verb, 'prod' AS env"),
    "mut_insert_from": (lambda: [mutate.insert_from("verb", "nbytes"), mutate.insert_from("host", "token")], ["verb", "host"], "coalesce(nbytes, '') AS verb, token AS host"),
    "mut_rename": (
        lambda: [mutate.rename("nbytes", "size"), mutate.rename("verb", "token"), mutate.rename("no_field", "other")],
        ["size", "token"],
        "nbytes AS size, verb AS token",
    ),
    "mut_arith_int": (
        lambda: [
            mutate.arithmetic("sum", "+", ["nbytes", "status", 7]),
            mutate.arithmetic("diff", "-", ["nbytes", "status"]),
            mutate.arithmetic("product", "*", ["status", "k", 2]),
            mutate.arithmetic("quotient", "/", ["status", "k"]),
            mutate.arithmetic("rest", "%", ["diff", 7]),
            mutate.arithmetic("verb", "+", ["verb", "status"]),
        ],
        ["sum", "diff", "product", "quotient", "rest", "verb"],
        "cast(coalesce(cast(nbytes AS bigint), 0) + cast(status AS bigint) + 7 AS varchar) AS sum, "
        "cast(cast(nbytes AS bigint) - cast(status AS bigint) AS varchar) AS diff, cast(cast(status AS bigint) * cast(k AS bigint) * 2 AS varchar) AS product, "
        "CASE WHEN k <> '0' THEN cast(cast(status AS bigint) // nullif(cast(k AS bigint), 0) AS varchar) END AS quotient, "
        "cast((cast(nbytes AS bigint) - cast(status AS bigint)) % 7 AS varchar) AS rest, verb",
    ),
    "mut_replace": (lambda: [mutate.replace("request", "[?&](\\w+)=", "/$1:")], ["request"], r"regexp_replace(request, '[?&](\w+)=', '/\1:', 'g') AS request"),
    "mut_replace_from": (
        lambda: [mutate.replace_from("request", "/[a-z]+", "nbytes")],
        ["request"],
        "CASE WHEN nbytes IS NULL THEN request ELSE regexp_replace(request, '/[a-z]+', nbytes, 'g') END AS request",
    ),
}
for _name, (_steps, _columns, _sql) in _STEPS.items():

    @query(_name, with_events(f"SELECT event_id, {_sql} FROM ev"))
    def _run(spark, sf_dir, steps=_steps, columns=_columns):
        ev = lines.events(spark, sf_dir).drop("value")
        for step in steps():
            ev = step(ev)
        return ev.select("event_id", *columns)


@query(
    "mut_arith_double",
    with_events(
        "SELECT event_id, round(cast(nbytes AS double) + 0.5, 6) AS sum, round(cast(status AS double) / nullif(cast(k AS double), 0), 6) AS quotient, "
        "k = '0' AS infinite, round(cast(status AS double) * 1.5 * 2, 6) AS product FROM ev"
    ),
)
def mut_arith_double(spark, sf_dir):
    ev = lines.events(spark, sf_dir)
    ev = mutate.arithmetic("sum", ".+", ["nbytes", 0.5])(ev)
    ev = mutate.arithmetic("quotient", "./", ["status", "k"])(ev)
    ev = mutate.arithmetic("product", ".*", ["status", 1.5, 2])(ev)
    quotient = F.col("quotient").cast("double")
    return ev.select(
        "event_id",
        F.round(F.col("sum").cast("double"), 6).alias("sum"),
        F.when(F.col("quotient") != "Infinity", F.round(quotient, 6)).alias("quotient"),
        (F.col("quotient") == "Infinity").alias("infinite"),
        F.round(F.col("product").cast("double"), 6).alias("product"),
    )


@query("mut_mark_drop", with_events("SELECT event_id, verb FROM ev WHERE event_type <> 'error' OR user_id % 2 = 0"))
def mut_mark_drop(spark, sf_dir):
    """Later marks overrule earlier ones; marked rows are left out at the end."""
    ev = lines.events(spark, sf_dir)
    ev = mutate.mark("drop")(ev, F.col("event_type") == "error")
    ev = mutate.mark("pass")(ev, F.col("user_id") % 2 == 0)
    return mutate.unmarked(ev).select("event_id", "verb")


# ---- index names and rotation


@query("index_name", with_events("SELECT event_id, concat(CASE WHEN event_id % 5 = 0 THEN '_unknown_' ELSE token END, '.', CASE WHEN event_id % 7 = 0 THEN '_' ELSE event_type END) AS index_name FROM ev"))
def index_name(spark, sf_dir):
    token, kind = F.when(F.col("event_id") % 5 != 0, F.col("token")), F.when(F.col("event_id") % 7 != 0, F.col("event_type"))
    return lines.events(spark, sf_dir).select("event_id", rotation.index_name(token, kind).alias("index_name"))


@query("index_name_topic", with_events("SELECT event_id, concat('logs.', token, '.', event_type) AS index_name FROM ev"))
def index_name_topic(spark, sf_dir):
    name = rotation.topic_index_name(F.lit("logs"), F.col("token"), F.col("event_type"))
    return lines.events(spark, sf_dir).select("event_id", name.alias("index_name"))


@query(
    "index_escape",
    r"SELECT page_id, lower(regexp_replace(url, '[^\p{L}\p{Nd}_-]', '-', 'g')) AS name FROM pages",
)
def index_escape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", rotation.escape_index(F.col("url")).alias("name"))


def _spread(eid: str = "event_id") -> str:
    """Event times spread over two years, in SQL of DuckDB."""
    return f"(ts + to_days(CAST({eid} % 700 AS integer)) + INTERVAL 8 HOUR)"


def _millis():
    return F.unix_millis(F.col("ts").cast("timestamp")) + (F.col("event_id") % 700) * 86_400_000


_T = _spread()
_HOUR = "strftime(date_trunc('day', {t}) + to_hours(CAST((extract(hour FROM {t}) // {n} + 1) * {n} AS integer)), '%y%m%d%H')"
_ROTATIONS = {
    "rotate_hour": (
        ["1hr", "5hr", "12hr", "24hr", ""],
        [_HOUR.format(t=_T, n=n) for n in (1, 6, 12, 24, 24)],
    ),
    "rotate_week": (
        ["1wk", "2wk", "3wk"],
        ["strftime(date_trunc('week', {t}) + INTERVAL 7 DAY, '%y%m%d%H')".format(t=_T)]
        + [
            "strftime(CASE WHEN extract(day FROM {t}) <= 15 THEN date_trunc('month', {t}) + INTERVAL 15 DAY ELSE date_trunc('month', {t}) + INTERVAL 1 MONTH END, '%y%m%d%H')".format(t=_T)
        ]
        * 2,
    ),
    "rotate_month": (
        ["1mo", "3mo", "5mo", "12mo", "20mo"],
        [
            "strftime(date_trunc('year', {t}) + to_months(CAST(((extract(month FROM {t}) - 1) // {n} + 1) * {n} AS integer)), '%y%m%d%H')".format(t=_T, n=n)
            for n in (1, 3, 6, 12, 12)
        ],
    ),
}
for _name, (_periods, _sqls) in _ROTATIONS.items():

    @query(_name, "SELECT event_id, " + ", ".join(f"{s} AS r{i}" for i, s in enumerate(_sqls)) + " FROM events")
    def _run(spark, sf_dir, periods=_periods):
        stamps = [rotation.rotation_stamp(_millis(), p).alias(f"r{i}") for i, p in enumerate(periods)]
        return table(spark, sf_dir, "events").select("event_id", *stamps)


@query(
    "index_rotated",
    "SELECT event_id, concat('p.', CASE WHEN event_id % 6 = 0 THEN '_' ELSE strftime(date_trunc('year', {t}) + "
    "to_months(CAST(extract(month FROM {t}) AS integer)), '%y%m%d%H') END, '.', {day}) AS index_name FROM events".format(
        t=_T, day=_HOUR.format(t=_T, n=24)
    ),
)
def index_rotated(spark, sf_dir):
    record = F.when(F.col("event_id") % 6 != 0, _millis())
    name = rotation.rotated_index(F.lit("p"), record, _millis(), "1mo", "24hr")
    return table(spark, sf_dir, "events").select("event_id", name.alias("index_name"))


@query(
    "rotation_valid",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id % 30 > 0 AND user_id % 30 <= 12 AND 12 % greatest(user_id % 30, 1) = 0 "
    "WHEN 1 THEN user_id % 30 IN (1, 2) WHEN 2 THEN user_id % 30 > 0 AND user_id % 30 <= 24 AND 24 % greatest(user_id % 30, 1) = 0 ELSE false END AS valid FROM events",
)
def rotation_valid(spark, sf_dir):
    unit = F.get(F.array(F.lit("mo"), F.lit("wk"), F.lit("hr")), (F.col("event_id") % 4).cast("int"))
    period = F.when(F.col("event_id") % 4 == 3, " ").otherwise(F.concat((F.col("user_id") % 30).cast("string"), unit))
    return table(spark, sf_dir, "events").select("event_id", rotation.valid_period(period).alias("valid"))


# ---- mapping


def _documents(spark, sf_dir):
    """Parsed documents, some with values that do not fit their declared type."""
    ev = lines.events(spark, sf_dir)
    return ev.select(
        "event_id",
        "token",
        F.when(F.col("event_id") % 8 == 0, "n/a").otherwise(F.col("status")).alias("response"),
        F.when(F.col("event_id") % 12 == 0, "-").otherwise(F.col("nbytes")).alias("bytes"),
        F.when(F.col("event_id") % 15 == 0, "unknown").otherwise(F.col("clientip")).alias("clientip"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        "verb",
        "request",
        "k",
    )


_BAD = "event_id % 8 = 0 OR event_id % 12 = 0 OR event_id % 15 = 0"


def _as_text(df, *names):
    return df.select("event_id", *[F.col(n).cast("string").alias(n) for n in names])


@query(
    "apply_mapping",
    with_events(
        "SELECT event_id, status AS response, nbytes AS bytes, clientip, cast(epoch_us(ts) // 1000 AS varchar) AS event_timestamp, verb "
        f"FROM ev WHERE NOT ({_BAD})"
    ),
)
def apply_mapping(spark, sf_dir):
    out = mapping.accepted(mapping.apply_mapping(_documents(spark, sf_dir), mapping.ACCESS_MAPPING))
    types = dict(out.dtypes)
    assert (types["response"], types["bytes"], types["event_timestamp"]) == ("int", "int", "timestamp")
    return _as_text(out.withColumn("event_timestamp", F.unix_millis("event_timestamp")), "response", "bytes", "clientip", "event_timestamp", "verb")


@query(
    "mapping_rejects",
    with_events(
        "SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 12 = 0 THEN 'bytes' END, CASE WHEN event_id % 15 = 0 THEN 'clientip' END, "
        f"CASE WHEN event_id % 8 = 0 THEN 'response' END], lambda x: x IS NOT NULL), ',') AS fields FROM ev WHERE {_BAD}"
    ),
)
def mapping_rejects(spark, sf_dir):
    out = mapping.rejected(mapping.apply_mapping(_documents(spark, sf_dir), mapping.ACCESS_MAPPING))
    return out.select("event_id", F.array_join(F.array_sort("reject_fields"), ",").alias("fields"))


@query(
    "apply_mapping_merged",
    with_events(
        f"SELECT event_id, k, response, cast(epoch_us(ts) // 1000 AS varchar) AS event_timestamp FROM (SELECT *, CASE WHEN event_id % 8 = 0 THEN 'n/a' ELSE status END AS response FROM ev) "
        "WHERE NOT (event_id % 12 = 0 OR event_id % 15 = 0)"
    ),
)
def apply_mapping_merged(spark, sf_dir):
    """Field types of a step are merged into the declared mapping; an extra type replaces a declared one."""
    merged = mapping.merge_mapping(mapping.ACCESS_MAPPING, {"k": "long", "response": "keyword"})
    out = mapping.accepted(mapping.apply_mapping(_documents(spark, sf_dir), merged))
    assert dict(out.dtypes)["k"] == "bigint"
    return _as_text(out.withColumn("event_timestamp", F.unix_millis("event_timestamp")), "k", "response", "event_timestamp")


@query(
    "mapping_raw",
    "SELECT doc_id, lang AS lang_raw, CASE WHEN length(text) <= 256 THEN md5(text) END AS text_raw FROM documents",
)
def mapping_raw(spark, sf_dir):
    """Raw copies of text fields, left out where the text is long."""
    out = mapping.with_raw(table(spark, sf_dir, "documents"), ["lang", "text"])
    return out.select("doc_id", "lang_raw", F.md5("text_raw").alias("text_raw"))


_DYNAMIC_SQL = with_events(
    "SELECT * FROM (SELECT 'uid' AS field, CASE WHEN min(user_id) >= -128 AND max(user_id) < 128 THEN 'byte' WHEN max(user_id) < 32768 THEN 'short' "
    "WHEN max(user_id) < 2147483648 THEN 'integer' ELSE 'long' END AS kind, false AS raw FROM ev "
    "UNION ALL SELECT 'far', CASE WHEN max(event_id) * 1000003 < 2147483648 THEN 'integer' ELSE 'long' END, false FROM ev "
    "UNION ALL SELECT unnest(['type', 'ratio', 'seen', 'flag', 'mixed', 'where', 'response', 'message', 'gone']), "
    "unnest(['text', 'double', 'date', 'boolean', 'text', 'geo_point', 'integer', 'message', 'text']), unnest([true, false, false, false, true, false, false, false, true]))"
)


def _loose_fields(spark, sf_dir):
    """Events with a map of text fields, as flat JSON leaves them."""
    at = F.col("event_id")
    values = {
        "uid": F.col("user_id").cast("string"),
        "far": (at * 1000003).cast("string"),
        "type": F.col("event_type"),
        "ratio": F.when(at % 2 == 0, (at % 7).cast("string")).otherwise(F.concat((at % 7).cast("string"), F.lit(".25"))),
        "seen": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        "flag": F.when(at % 3 == 0, "true").when(at % 3 == 1, "false"),
        "mixed": F.when(at % 97 == 0, "none").otherwise((at % 5).cast("string")),
        "where": F.concat((at % 90).cast("string"), F.lit(".5,-"), (at % 180).cast("string")),
        "response": F.col("status"),
        "message": F.lit("1"),
        "gone": F.lit(None).cast("string"),
    }
    fields = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])
    return lines.events(spark, sf_dir).select("event_id", fields.alias("fields"))


def _templates(rows):
    evidence = [mapping.field_evidence(rows.filter(F.col("event_id") % 2 == k).select(F.explode("fields"))) for k in (0, 1)]
    return mapping.choose_templates(mapping.merge_evidence(*evidence))


@query("mapping_dynamic", _DYNAMIC_SQL)
def mapping_dynamic(spark, sf_dir):
    """Templates by the types of all values, from the evidence of two batches."""
    return _templates(_loose_fields(spark, sf_dir))


@query(
    "mapping_dynamic_applied",
    "SELECT event_id, user_id AS uid, CASE WHEN event_id % 2 = 0 THEN event_id % 7 ELSE event_id % 7 + 0.25 END::double AS ratio, "
    "epoch_us(ts) // 1000 AS seen, CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS flag, "
    "CASE WHEN event_id % 97 = 0 THEN 'none' ELSE concat('', event_id % 5) END AS mixed_raw, event_id % 4 <> 0 AS located, "
    "CASE WHEN event_id % 4 = 0 THEN 'geoip.latitude' ELSE '' END AS rejected FROM events",
)
def mapping_dynamic_applied(spark, sf_dir):
    """Documents typed by the chosen templates, and an object whose fields have types of their own."""
    rows = _loose_fields(spark, sf_dir)
    chosen = cut_lineage(_templates(rows), spark, "templates")
    kinds = mapping.dynamic_mapping(chosen)
    raw = [r.field for r in chosen.filter("raw").collect() if r.field != "gone"]
    at = F.col("event_id")
    place = F.struct(
        F.lit("10.0.0.1").alias("ip"), F.lit("1.5,2.5").alias("location"),
        F.when(at % 4 == 0, "north").otherwise("1.5").alias("latitude"), F.lit("2.5").alias("longitude"), F.lit("x").alias("name"),
    )
    docs = rows.select("event_id", *[F.col("fields")[k].alias(k) for k in kinds], place.alias("geoip"))
    out = mapping.apply_mapping(docs, mapping.merge_mapping(mapping.DEFAULT_MAPPING, kinds))
    out = mapping.with_raw(out, raw)
    types = dict(out.dtypes)
    assert (types["ratio"], types["flag"], types["geoip"]) == ("double", "boolean", "struct<ip:string,location:string,latitude:float,longitude:float,name:string>")
    return out.select(
        "event_id", F.col("uid").cast("bigint").alias("uid"), "ratio", F.unix_millis("seen").alias("seen"), F.col("flag").cast("string").alias("flag"), "mixed_raw",
        F.col("geoip.latitude").isNotNull().alias("located"), F.array_join("reject_fields", ",").alias("rejected"),
    )
