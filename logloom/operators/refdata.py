"""Work on reference tables: configuration versions, aliases, quotas and usage totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import nz
from logloom.operators.lookup import BROADCAST_ROWS, left_lookup


def latest_by_type(configs: DataFrame) -> DataFrame:
    """Configs whose (type, version) is the highest live version of the type."""
    live = configs.filter((~F.col("is_delete")) & (F.col("version") > 0))
    newest = live.groupBy("message_type").agg(F.max("version").alias("version"))
    return configs.join(newest, ["message_type", "version"], "left_semi").select(*configs.columns)


def latest_by_user_type(configs: DataFrame) -> DataFrame:
    """One config per (user, type): the highest version, the lowest id among equals.

    An aggregate with map-side combine, so a hot (user, type) is reduced before the shuffle.
    """
    best = F.max_by(F.struct(*configs.columns), F.struct(F.col("version"), -F.col("id")))
    return configs.groupBy("user_id", "message_type").agg(best.alias("_c")).select("_c.*")


def select_configs(
    configs: DataFrame, user_id: str = "", message_type: str = "", version: int = -1, config_id: str = ""
) -> DataFrame:
    """Optional equality filters; an id makes type and version irrelevant."""
    if user_id.strip():
        configs = configs.filter(F.col("user_id") == user_id)
    if config_id.strip():
        return configs.filter(F.col("id") == config_id)
    if message_type.strip():
        configs = configs.filter(F.col("message_type") == message_type)
    if version != -1:
        configs = configs.filter(F.col("version") == version)
    return configs


def config_entries(configs: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per step of the given configs. ``entries`` refers to them by ``config_id``.

    ``orders`` carries the position of the step within its config.
    """
    heads = configs.select(
        F.col("id").alias("config_id"), F.col("user_id").alias("token"), F.col("message_type"), F.col("version")
    )
    return entries.join(heads, "config_id").select(
        "token",
        F.array("message_type").alias("types"),
        "version",
        "config_id",
        *[c for c in entries.columns if c != "config_id"],
    )


def config_by_type(steps: DataFrame) -> DataFrame:
    """Steps keyed by (token, record_type): one row per step and type it lists, ``*`` without list.

    Rows stay apart (a group can be of any size); ``orders`` gives the order within a group.
    """
    kinds = F.when(F.size("types") > 0, F.col("types")).otherwise(F.array(F.lit("*")))
    return steps.withColumn("record_type", F.explode(kinds)).drop("types")


def config_groups(steps: DataFrame) -> DataFrame:
    """Per (token, record_type): the version of the first step and the number of steps."""
    return (
        config_by_type(steps)
        .groupBy("token", "record_type")
        .agg(F.min_by("version", F.struct("config_id", "orders")).alias("version"), F.count("*").alias("steps"))
    )


def token_alias(events: DataFrame, aliases: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``index_alias`` of the event's token, NULL when it has none."""
    side = aliases.select(F.col("user").alias("r_token"), F.col("indexs").alias("index_alias"))
    return left_lookup(events, side, ["token"], None, broadcast_rows)


def user_quota_info(users: DataFrame, companies: DataFrame) -> DataFrame:
    """Active users with their company, limit and usage; a missing number counts as 0."""
    active = users.filter((F.col("is_deleted") == 0) & (F.col("stop") == 0))
    owners = active.filter(F.col("uuid") == F.col("owner")).select(F.col("uuid").alias("_owner"))
    company = companies.select(
        F.col("uuid").alias("company_id"), F.col("owner").alias("_company_owner"), "limits", "current_usage"
    )
    return (
        active.select("uuid", "owner")
        .join(owners, F.col("owner") == F.col("_owner"), "left")
        .join(company, F.col("_company_owner") == F.col("uuid"), "left")
        .select(
            F.col("uuid").alias("user_id"),
            F.col("_owner").isNotNull().alias("owner_active"),
            nz(F.col("company_id")).alias("company_id"),
            F.coalesce("limits", F.lit(0)).alias("limits"),
            F.coalesce("current_usage", F.lit(0)).alias("current_usage"),
        )
    )


def usage_totals(checked: DataFrame, token: str = "token", size: str = "bytes") -> DataFrame:
    """Bytes used and dropped per token, from events flagged ``allowed``."""
    kept = F.sum(F.when(F.col("allowed"), F.col(size)).otherwise(0))
    dropped = F.sum(F.when(F.col("allowed"), 0).otherwise(F.col(size)))
    return checked.groupBy(F.col(token).alias("token")).agg(kept.alias("usage"), dropped.alias("drop"))


def usage_delta(current: DataFrame, last: DataFrame) -> DataFrame:
    """Change of the totals since the last report; no empty token, no zero change."""
    before = last.select(F.col("token"), F.col("usage").alias("_u"), F.col("drop").alias("_d"))
    delta = current.filter(F.col("token") != "").join(before, "token", "left")
    return delta.select(
        "token",
        (F.col("usage") - F.coalesce("_u", F.lit(0))).alias("usage"),
        (F.col("drop") - F.coalesce("_d", F.lit(0))).alias("drop"),
    ).filter((F.col("usage") != 0) | (F.col("drop") != 0))


def usage_by_company(delta: DataFrame, quota_info: DataFrame) -> DataFrame:
    """Usage of the users summed up per company; users without company do not count."""
    owner = quota_info.filter(F.col("company_id") != "").select(F.col("user_id").alias("token"), "company_id")
    return delta.join(owner, "token").groupBy("company_id").agg(F.sum("usage").alias("usage"), F.sum("drop").alias("drop"))


def apply_usage(stored: DataFrame, delta: DataFrame, key: str = "token") -> DataFrame:
    """Stored totals plus the change. ``stored`` has uuid and the four counters; unknown keys are ignored."""
    change = delta.select(F.col(key).alias("uuid"), F.col("usage").alias("_u"), F.col("drop").alias("_d"))
    u, d = F.coalesce("_u", F.lit(0)), F.coalesce("_d", F.lit(0))
    return stored.join(change, "uuid", "left").withColumns(
        {
            "total_usage": F.col("total_usage") + u,
            "current_usage": F.col("current_usage") + u,
            "total_drop": F.col("total_drop") + d,
            "current_drop": F.col("current_drop") + d,
        }
    ).select(*stored.columns)
