"""Browser and operating system of a user-agent text, as native CASE chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, masked, optional, put

# fixed values: the first substring found names the browser
BROWSER_TAGS = (
    ("Maxthon", "MAXTHON"),
    ("The world", "The world"),
    ("QQBrowser", "QQ"),
    ("QQDownload", "QQ"),
    ("GreenBrowser", "Green"),
    ("360SE", "360"),
    ("Opera", "Opera"),
    ("Chrome", "Chrome"),
    ("SE ", "Sougou"),
    ("MetaSr", "Sougou"),
    ("SogouMobileBrowser", "Sougou Mobile"),
    ("UCWEB", "UC"),
    ("UCBrowser", "UC"),
    ("UBrowser", "UC"),
    ("TencentTraveler", "QQ Mobile"),
    ("MQQBrowser", "QQ Mobile"),
    ("TaoBrowser", "Taobao"),
    ("LBBROWSER", "Liebao"),
    ("HUAWEI", "Huawei"),
    ("Huawei", "Huawei"),
    ("Firefox", "Firefox"),
    ("2345Explorer", "2345Explorer"),
    ("MicroMessenger", "Weixin"),
)

# fixed values: patterns of crawler names and of a leading product token
BOT_NAME = r"[\w-]*[bB]ot[\w-]*"
SPIDER_NAME = r"[\w-]*[sS]pider[\w-]*"
PRODUCT_TOKEN = r"^([\w+-]+)/[\w+-]+"
MSIE_VERSION = r"MSIE (\d+)"

# family rules of our own, in order: substring of the lower-cased text, family
_BROWSER_FAMILIES = (
    ("bot", "Bot"),
    ("spider", "Bot"),
    ("crawler", "Bot"),
    ("slurp", "Bot"),
    ("edge/", "Edge"),
    ("edg/", "Edge"),
    ("trident/7", "IE11"),
    ("thunderbird", "Thunderbird"),
    ("safari", "Safari"),
    ("konqueror", "Konqueror"),
    ("lynx", "Lynx"),
    ("seamonkey", "Seamonkey"),
)
_OS_FAMILIES = (
    ("windows phone", "WINDOWS_PHONE"),
    ("windows nt 10", "WINDOWS_10"),
    ("windows nt 6.3", "WINDOWS_81"),
    ("windows nt 6.2", "WINDOWS_8"),
    ("windows nt 6.1", "WINDOWS_7"),
    ("windows nt 6.0", "WINDOWS_VISTA"),
    ("windows nt 5", "WINDOWS_XP"),
    ("windows", "WINDOWS"),
    ("android", "ANDROID"),
    ("iphone", "IOS_IPHONE"),
    ("ipad", "IOS_IPAD"),
    ("ipod", "IOS_IPOD"),
    ("mac os x", "MAC_OS_X"),
    ("macintosh", "MAC_OS"),
    ("cros", "CHROME_OS"),
    ("ubuntu", "UBUNTU"),
    ("linux", "LINUX"),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _first_found(text: str, rules) -> str:
    """SQL CASE over ordered (substring, name) rules. One expression text, so a plan is built quickly."""
    return "CASE " + " ".join(f"WHEN contains({text}, {_quoted(t)}) THEN {_quoted(n)}" for t, n in rules) + " END"


def clean_agent(agent: Column) -> Column:
    """Agent text without the quotes a quoted field keeps; ``-`` means empty."""
    bare = F.btrim(agent, F.lit('"'))
    return F.when(bare == "-", "").otherwise(bare)


def browser_tag(agent: str) -> Column:
    """Vendor browser by the first tag found in the text column ``agent``, else NULL."""
    return F.expr(_first_found(agent, BROWSER_TAGS))


def bot_name(agent: str, lower: str | None = None) -> Column:
    """Name of a crawler: the word around ``bot``, else the word around ``spider``."""
    return F.expr(
        f"CASE WHEN contains({agent}, 'bot') THEN regexp_substr({agent}, {_quoted(BOT_NAME)}) "
        f"WHEN contains({lower or f'lower({agent})'}, 'spider') THEN regexp_substr({agent}, {_quoted(SPIDER_NAME)}) END"
    )


def product_token(agent: str) -> Column:
    """Leading ``name`` of ``name/version``, else UNKNOWN."""
    return F.expr(f"coalesce(nullif(regexp_extract({agent}, {_quoted(PRODUCT_TOKEN)}, 1), ''), 'UNKNOWN')")


def browser_family(agent: str, lower: str | None = None) -> Column:
    """Browser family, '' when unknown."""
    return F.expr(
        f"coalesce(CASE WHEN contains({agent}, 'MSIE ') THEN concat('IE', nullif(regexp_extract({agent}, {_quoted(MSIE_VERSION)}, 1), '')) END, "
        f"{_first_found(lower or f'lower({agent})', _BROWSER_FAMILIES)}, '')"
    )


def os_family(agent: str, lower: str | None = None) -> Column:
    lower = lower or f"lower({agent})"
    windows = [r for r in _OS_FAMILIES if r[0].startswith("windows")]
    others = [r for r in _OS_FAMILIES if not r[0].startswith("windows")]
    return F.expr(
        f"CASE WHEN contains({lower}, 'windows') THEN {_first_found(lower, windows)} "
        f"WHEN {agent} IS NOT NULL THEN coalesce({_first_found(lower, others)}, 'UNKNOWN') END"
    )


def upper_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def user_agent(target: str = "agent"):
    """Step that adds ``agent_browser`` and ``agent_os``; an absent agent changes nothing.

    The browser is the vendor tag, else the family; a crawler gives its own name;
    what stays unnamed gives its leading product token.
    """

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        # staged columns, so that every scan of the text happens once per row
        df = df.withColumn("_agent", masked(when, clean_agent(optional(df, target))))
        df = df.withColumns({"_lower": F.lower("_agent"), "_tag": browser_tag("_agent")})
        df = df.withColumn("_family", F.when(F.col("_tag").isNull(), browser_family("_agent", "_lower")))
        family = F.col("_family")
        named = F.when(family == "Bot", bot_name("_agent", "_lower")).when(family != "", family)
        df = df.withColumn("_name", F.coalesce(F.col("_tag"), named, product_token("_agent")))
        values = {"agent_browser": upper_first(F.col("_name")), "agent_os": os_family("_agent", "_lower")}
        return put(df, values, F.col("_agent").isNotNull()).drop("_agent", "_lower", "_tag", "_family", "_name")

    return step
