"""Reference tables and quotas; orders, customers and events stand in for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.catalog import lines
from logloom.catalog.registry import query, table
from logloom.operators import quota, refdata

_CONFIG_SQL = (
    "cfg AS (SELECT o_orderkey AS id, concat('u', o_custkey % 50) AS user_id, o_orderpriority AS message_type, "
    "o_orderkey % 5 AS version, o_orderstatus = 'F' AS is_delete FROM orders)"
)


def _configs(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("u"), (F.col("o_custkey") % 50).cast("string")).alias("user_id"),
        F.col("o_orderpriority").alias("message_type"),
        (F.col("o_orderkey") % 5).alias("version"),
        (F.col("o_orderstatus") == "F").alias("is_delete"),
    )


def _entries(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("config_id"),
        F.concat(F.lit("step"), F.col("l_linenumber").cast("string")).alias("name"),
        F.col("l_returnflag").alias("type"),
        F.col("l_linenumber").cast("bigint").alias("orders"),
    )


@query(
    "config_latest_by_type",
    f"WITH {_CONFIG_SQL} SELECT * FROM cfg WHERE (message_type, version) IN "
    "(SELECT (message_type, max(version)) FROM cfg WHERE NOT is_delete AND version > 0 GROUP BY message_type)",
)
def config_latest_by_type(spark, sf_dir):
    return refdata.latest_by_type(_configs(spark, sf_dir))


_LATEST_SQL = (
    "latest AS (SELECT id, user_id, message_type, version, is_delete FROM cfg "
    "QUALIFY row_number() OVER (PARTITION BY user_id, message_type ORDER BY version DESC, id) = 1)"
)


@query("config_latest_by_user_type", f"WITH {_CONFIG_SQL}, {_LATEST_SQL} SELECT * FROM latest")
def config_latest_by_user_type(spark, sf_dir):
    return refdata.latest_by_user_type(_configs(spark, sf_dir))


@query(
    "config_select",
    f"WITH {_CONFIG_SQL} SELECT 'user' AS via, * FROM cfg WHERE user_id = 'u7' "
    "UNION ALL SELECT 'type' AS via, * FROM cfg WHERE user_id = 'u7' AND message_type = '2-HIGH' AND version = 3 "
    "UNION ALL SELECT 'id' AS via, * FROM cfg WHERE id = 17",
)
def config_select(spark, sf_dir):
    configs = _configs(spark, sf_dir)
    picks = {
        "user": refdata.select_configs(configs, user_id="u7"),
        "type": refdata.select_configs(configs, "u7", "2-HIGH", 3),
        "id": refdata.select_configs(configs, message_type="2-HIGH", version=3, config_id="17"),
    }
    tagged = [df.select(F.lit(via).alias("via"), "*") for via, df in picks.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


_STEPS_SQL = (
    "steps AS (SELECT latest.user_id AS token, latest.message_type, latest.version, latest.id AS config_id, concat('step', l_linenumber) AS name, "
    "l_returnflag AS type, CAST(l_linenumber AS bigint) AS orders FROM latest JOIN lineitem ON l_orderkey = latest.id)"
)


def _steps(spark, sf_dir):
    return refdata.config_entries(refdata.latest_by_user_type(_configs(spark, sf_dir)), _entries(spark, sf_dir))


@query(
    "config_entries",
    f"WITH {_CONFIG_SQL}, {_LATEST_SQL}, {_STEPS_SQL} SELECT token, message_type AS types, version, config_id, name, type, orders FROM steps",
)
def config_entries(spark, sf_dir):
    return _steps(spark, sf_dir).withColumn("types", F.array_join("types", ","))


def _with_types(spark, sf_dir):
    """Every third config applies to all types (empty list), every fourth to a second type too."""
    types = (
        F.when(F.col("config_id") % 3 == 0, F.array().cast("array<string>"))
        .when(F.col("config_id") % 4 == 0, F.array(F.get("types", F.lit(0)), F.lit("extra")))
        .otherwise(F.col("types"))
    )
    return _steps(spark, sf_dir).withColumn("types", types)


_BY_TYPE_SQL = (
    "kinds AS (SELECT *, unnest(CASE WHEN config_id % 3 = 0 THEN ['*'] WHEN config_id % 4 = 0 THEN [message_type, 'extra'] "
    "ELSE [message_type] END) AS record_type FROM steps)"
)


@query(
    "config_by_type",
    f"WITH {_CONFIG_SQL}, {_LATEST_SQL}, {_STEPS_SQL}, {_BY_TYPE_SQL} SELECT token, record_type, version, config_id, name, type, orders FROM kinds",
)
def config_by_type(spark, sf_dir):
    return refdata.config_by_type(_with_types(spark, sf_dir))


@query(
    "config_groups",
    f"WITH {_CONFIG_SQL}, {_LATEST_SQL}, {_STEPS_SQL}, {_BY_TYPE_SQL} SELECT token, record_type, arg_min(version, (config_id, orders)) AS version, "
    "count(*) AS steps FROM kinds GROUP BY token, record_type",
)
def config_groups(spark, sf_dir):
    return refdata.config_groups(_with_types(spark, sf_dir))


# ---- aliases, quotas, usage

_ALIAS_SQL = (
    "SELECT event_id, token, index_alias FROM (SELECT event_id, concat('u', user_id % 40) AS token FROM events) e LEFT JOIN "
    "(SELECT concat('u', c_custkey * 3) AS user_, concat('idx-', lower(c_mktsegment)) AS index_alias FROM customer) a ON a.user_ = e.token"
)


def _alias(spark, sf_dir, **options):
    """All events against an alias table that knows a third of the tokens; the others must stay, with NULL."""
    aliases = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), (F.col("c_custkey") * 3).cast("string")).alias("user"),
        F.concat(F.lit("idx-"), F.lower("c_mktsegment")).alias("indexs"),
    )
    ev = lines.events(spark, sf_dir).select("event_id", "token")
    return refdata.token_alias(ev, aliases, **options)


@query("token_alias", _ALIAS_SQL)
def token_alias(spark, sf_dir):
    return _alias(spark, sf_dir)


@query("token_alias_shuffled", _ALIAS_SQL)
def token_alias_shuffled(spark, sf_dir):
    """The way taken when the alias table is too large to broadcast."""
    return _alias(spark, sf_dir, broadcast_rows=0)


_USER_SQL = (
    "usr AS (SELECT concat('u', c_custkey) AS uuid, concat('u', c_custkey // 3 * 3) AS owner, CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS is_deleted, "
    "CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS stop FROM customer), "
    "company AS (SELECT concat('co', c_custkey) AS uuid, concat('u', c_custkey * 2) AS owner, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(floor(abs(c_acctbal)) AS bigint) END AS limits, "
    "CAST(c_nationkey AS bigint) AS current_usage FROM customer)"
)
_QUOTA_SQL = (
    "quota AS (SELECT usr.uuid AS user_id, own.uuid IS NOT NULL AS owner_active, coalesce(company.uuid, '') AS company_id, coalesce(limits, 0) AS limits, "
    "coalesce(current_usage, 0) AS current_usage FROM (SELECT * FROM usr WHERE is_deleted = 0 AND stop = 0) usr "
    "LEFT JOIN (SELECT * FROM usr WHERE uuid = owner AND is_deleted = 0 AND stop = 0) own ON usr.owner = own.uuid LEFT JOIN company ON company.owner = usr.uuid)"
)


def _quota_info(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")

    def name(prefix, k):
        return F.concat(F.lit(prefix), k.cast("string"))

    users = c.select(
        name("u", key).alias("uuid"), name("u", F.floor(key / 3) * 3).alias("owner"),
        F.when(key % 7 == 0, 1).otherwise(0).alias("is_deleted"), F.when(key % 11 == 0, 1).otherwise(0).alias("stop"),
    )
    companies = c.select(
        name("co", key).alias("uuid"), name("u", key * 2).alias("owner"),
        F.when(key % 5 != 0, F.floor(F.abs("c_acctbal")).cast("bigint")).alias("limits"), F.col("c_nationkey").cast("bigint").alias("current_usage"),
    )
    return refdata.user_quota_info(users, companies)


@query("user_quota_info", f"WITH {_USER_SQL}, {_QUOTA_SQL} SELECT * FROM quota")
def user_quota_info(spark, sf_dir):
    return _quota_info(spark, sf_dir)


# every third event belongs to one hot token; limits stop some tokens early, some late, some never
_SIZED_SQL = (
    "sized AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE concat('u', user_id % 40) END AS token, CAST(floor(value) AS bigint) AS bytes FROM events), "
    "lim AS (SELECT token AS user_id, CAST(CASE WHEN token = 'hot' THEN sum(bytes) // 2 WHEN substr(token, 2)::int % 4 = 0 THEN sum(bytes) // 3 "
    "WHEN substr(token, 2)::int % 4 = 1 THEN sum(bytes) + 5 WHEN substr(token, 2)::int % 4 = 2 THEN 60 ELSE 0 END AS bigint) AS limits, CAST(5 AS bigint) AS current_usage "
    "FROM sized WHERE token <> 'u39' GROUP BY token)"
)
_GREEDY_SQL = (
    "ord AS (SELECT sized.*, limits, row_number() OVER (PARTITION BY token ORDER BY event_id) AS n FROM sized JOIN lim ON token = user_id), "
    "greedy AS (SELECT token, n, event_id, limits, CASE WHEN 5 + bytes > limits THEN 5 ELSE 5 + bytes END AS used, 5 + bytes <= limits AS allowed FROM ord WHERE n = 1 "
    "UNION ALL SELECT o.token, o.n, o.event_id, o.limits, CASE WHEN g.used + o.bytes > o.limits THEN g.used ELSE g.used + o.bytes END, g.used + o.bytes <= o.limits "
    "FROM greedy g JOIN ord o ON o.token = g.token AND o.n = g.n + 1), "
    "checked AS (SELECT sized.event_id, sized.token, bytes, coalesce(greedy.allowed, true) AS allowed FROM sized LEFT JOIN greedy USING (event_id))"
)
_CHECK_SQL = f"WITH RECURSIVE {_SIZED_SQL}, {_GREEDY_SQL} SELECT event_id, token, bytes, allowed FROM checked"


def sized_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("user_id") % 40).cast("string"))).alias("token"),
        F.floor("value").cast("bigint").alias("bytes"),
    )


def limits(spark, sf_dir):
    number = F.substr("token", F.lit(2)).try_cast("int") % 4
    total = F.col("total")
    limit = (
        F.when(F.col("token") == "hot", F.floor(total / 2))
        .when(number == 0, F.floor(total / 3))
        .when(number == 1, total + 5)
        .when(number == 2, 60)
        .otherwise(0)
    )
    totals = sized_events(spark, sf_dir).filter("token <> 'u39'").groupBy("token").agg(F.sum("bytes").alias("total"))
    return totals.select(F.col("token").alias("user_id"), limit.cast("bigint").alias("limits"), F.lit(5).cast("bigint").alias("current_usage"))


@query("quota_check", _CHECK_SQL)
def quota_check(spark, sf_dir):
    return quota.check_quota(sized_events(spark, sf_dir), limits(spark, sf_dir), ["event_id"])


@query("quota_check_rounds", _CHECK_SQL)
def quota_check_rounds(spark, sf_dir):
    """The way of a token with very many events: chunks and spans so small that most tokens have several."""
    return quota.check_quota(sized_events(spark, sf_dir), limits(spark, sf_dir), ["event_id"], chunk_rows=50, span_parts=1)


_LAST_SQL = "last AS (SELECT token, sum(bytes) // 10 AS usage, CAST(0 AS bigint) AS drop FROM sized WHERE event_id % 2 = 0 GROUP BY token)"
_DELTA_SQL = (
    "now_ AS (SELECT token, sum(CASE WHEN bytes % 5 <> 0 THEN bytes ELSE 0 END) AS usage, sum(CASE WHEN bytes % 5 = 0 THEN bytes ELSE 0 END) AS drop FROM sized GROUP BY token), "
    "delta AS (SELECT token, CAST(now_.usage - coalesce(last.usage, 0) AS bigint) AS usage, CAST(now_.drop - coalesce(last.drop, 0) AS bigint) AS drop FROM now_ LEFT JOIN last USING (token) "
    "WHERE token <> '' AND (now_.usage <> coalesce(last.usage, 0) OR now_.drop <> coalesce(last.drop, 0)))"
)


def _delta(spark, sf_dir):
    """Totals of all events against an older snapshot of the totals."""
    sized = sized_events(spark, sf_dir)
    last = sized.filter("event_id % 2 = 0").groupBy("token").agg(F.floor(F.sum("bytes") / 10).cast("bigint").alias("usage"), F.lit(0).alias("drop"))
    current = refdata.usage_totals(sized.withColumn("allowed", F.col("bytes") % 5 != 0))
    return refdata.usage_delta(current, last)


@query("usage_delta", f"WITH {_SIZED_SQL}, {_LAST_SQL}, {_DELTA_SQL} SELECT * FROM delta")
def usage_delta(spark, sf_dir):
    return _delta(spark, sf_dir)


_COMPANY_SQL = (
    f"WITH {_SIZED_SQL}, {_LAST_SQL}, {_DELTA_SQL}, {_USER_SQL}, {_QUOTA_SQL} "
    "SELECT company_id, CAST(sum(usage) AS bigint) AS usage, CAST(sum(drop) AS bigint) AS drop FROM delta JOIN quota ON user_id = token WHERE company_id <> '' GROUP BY company_id"
)


@query("usage_company", _COMPANY_SQL)
def usage_company(spark, sf_dir):
    return refdata.usage_by_company(_delta(spark, sf_dir), _quota_info(spark, sf_dir))


@query(
    "usage_apply",
    f"WITH {_SIZED_SQL}, {_LAST_SQL}, {_DELTA_SQL} SELECT concat('u', c_custkey) AS uuid, c_custkey + coalesce(usage, 0) AS total_usage, coalesce(usage, 0) AS current_usage, "
    "1 + coalesce(drop, 0) AS total_drop, coalesce(drop, 0) AS current_drop FROM customer LEFT JOIN delta ON token = concat('u', c_custkey)",
)
def usage_apply(spark, sf_dir):
    zero = F.lit(0).cast("bigint")
    stored = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("uuid"),
        F.col("c_custkey").alias("total_usage"), zero.alias("current_usage"), (zero + 1).alias("total_drop"), zero.alias("current_drop"),
    )
    return refdata.apply_usage(stored, _delta(spark, sf_dir))
