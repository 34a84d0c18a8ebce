"""Anomaly tags by rule, and reproducible weighted labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, optional, put
from logloom.functions.predicates import whole_match

# fixed values: rule packs of (field, regex over the whole text, tag field, level)
WEB_RULES = (
    ("request", r"(?i).*(\.\./\.\.|echo|cmd\.exe|root\.exe|_mem_bin|msadc|winnt|boot\.ini).*", "anomaly_directory_traversal", "error"),
    ("request", r"(?i).*(<script>|src=javascript).*", "anomaly_xss", "error"),
    ("request", r"(?i).*(\?-d|\?-s|\?-a|\?-b|\?-w).*", "anomaly_php_cgi", "error"),
    ("request", r"(?i).*(char\(\d+\)).*", "anomaly_mssql_injection", "error"),
    ("response", r"(500|501|503)", "anomaly_server_error", "error"),
    ("request", r"(?i).*(select.*from.*(where)?|insert|union).*", "anomaly_sql_injection", "error"),
)
_ERROR_LOG_RULES = (
    (r"(?i).*(exit signal segmentation fault).*", "anomaly_segmentation_fault", "error"),
    (r"(?i).*((denied by server configuration)|((file does not exist)|(failed to open stream: no such file or directory))).*", "anomaly_denied", "warn"),
    (r"(?i).*(client sent malformed host header).*", "anomaly_code_red", "error"),
    (r"(?i).*((authentication failed)|((user .* not found)|(user .* in realm .* not found))|(authentication failure)).*", "anomaly_authentication", "warn"),
    (r"(?i).*((invalid uri in request)|((file name too long)|(request failed: uri too long))).*", "anomaly_illegal_url", "warn"),
)
APACHE_ERROR_RULES = tuple(("msg", *rule) for rule in _ERROR_LOG_RULES)
NGINX_ERROR_RULES = tuple(("errormsg", *rule) for rule in _ERROR_LOG_RULES)
_MYSQL_RULES = (
    (r"(?i).*(MySQL log: \d+ \S+ \d+ Connect).*", "anomaly_mysql_succeed", "info"),
    (r"(?i).*(Access denied for user).*", "anomaly_mysql_fail", "warn"),
    (r"(?i).*(MySQL log: \d+ \S+ \d+ Query).*", "anomaly_mysql_query", "info"),
    (r"(?i).*((mysqld ended)|(shutdown complete)).*", "anomaly_mysql_shutdown", "error"),
    (r"(?i).*((mysqld started)|(mysqld restarted)).*", "anomaly_mysql_start", "info"),
    (r"(?i).*((MySQL log: \d+ \S+ \d+ \[ERROR\])|(Fatal error:)).*", "anomaly_mysql_error", "error"),
)
# the pack names no field; the parsed message text is the one that fits
MYSQL_RULES = tuple(("msg", *rule) for rule in _MYSQL_RULES)

# fixed values: default share and level weights of the weighted labels
DEFAULT_PERCENTAGE = 5.0
DEFAULT_DISTRIBUTION = (("error", 10), ("unknown", 20), ("warn", 30), ("info", 40))


def regex_anomalies(rules: Sequence[tuple[str, str, str, str]]):
    """Step that sets a tag field to its level where a field matches a rule as a whole."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        tags: dict[str, list] = {}
        for name, regex, tag, level in rules:
            tags.setdefault(tag, []).append((whole_match(optional(df, name), regex), level))
        for tag, hits in tags.items():
            # of several rules for one tag the last that matches decides
            level = F.coalesce(*[F.when(hit, F.lit(lv)) for hit, lv in reversed(hits)])
            df = put(df, {tag: level}, when & level.isNotNull())
        return df

    return step


def weighted_labels(
    names: Sequence[str],
    key: str,
    percentage: float = DEFAULT_PERCENTAGE,
    distribution: Sequence[tuple[str, int]] = DEFAULT_DISTRIBUTION,
    seed: str = "0",
):
    """Step that labels ``percentage`` of the rows per name, the level drawn by weight.

    The draw is a hash of row key, name and seed, so a replay gives the same labels.
    """

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        for name in names:
            digest = F.md5(F.concat_ws("|", optional(df, key).cast("string"), F.lit(name), F.lit(seed)))
            share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
            draw = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint") % 100
            bound = 0
            choices = []
            for text, weight in distribution:
                choices.append(F.when((draw >= bound) & (draw < bound + int(weight)), F.lit(text)))
                bound += int(weight)
            level = F.coalesce(*choices)
            df = put(df, {name: level}, when & (share < percentage / 100) & level.isNotNull())
        return df

    return step
