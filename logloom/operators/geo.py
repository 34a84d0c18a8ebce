"""IP address to city, country and continent by a table of address ranges.

Addresses of both families are written as 32 hex digits (IPv4 in its mapped form). Every range is split into aligned
blocks, each named by the hex digits that its addresses share: a prefix trie laid flat. An address is in a range exactly
when one of its prefixes is the name of a block, so lookups are joins on equal keys, one for each prefix length that
occurs, and no range is tested. Ranges may nest; the longest prefix, and so the most specific range, wins.

A small table is broadcast and looked up from the events as they pass. For a large one the distinct addresses are found
first, looked up once each, and joined back by address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.cols import ALWAYS, optional, put
from logloom.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, left_lookup, measured
from logloom.session import cut_lineage

GEO_FIELDS = ("city", "country", "continent")
_MAPPED = "00000000000000000000ffff"

# the address conversions are SQL texts: one call each instead of some hundred column calls
_V4_HEX = """
CASE WHEN {ip} RLIKE '^\\\\d{{1,3}}(\\\\.\\\\d{{1,3}}){{3}}$' AND forall(split({ip}, '[.]'), o -> cast(o AS int) <= 255)
THEN concat('00000000000000000000ffff', array_join(transform(split({ip}, '[.]'), o -> lpad(lower(hex(cast(o AS int))), 2, '0')), '')) END
"""
_DOTTED_TAIL = r"""
regexp_replace({ip}, ':[0-9.]+$', concat(':', array_join(transform(split(substring_index({ip}, ':', -1), '[.]'),
(o, i) -> concat(CASE WHEN i = 2 THEN ':' ELSE '' END, lpad(lower(hex(try_cast(o AS int))), 2, '0'))), '')))
"""
_V6_HEX = """
CASE WHEN {ip} RLIKE '^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*$' THEN
get(transform(array(split({ip}, '::', 3)), h -> CASE WHEN size(h) <= 2 THEN
get(transform(array(named_struct('l', filter(split(h[0], ':'), g -> g <> ''), 'r', filter(split(coalesce(get(h, 1), ''), ':'), g -> g <> ''))),
s -> CASE WHEN forall(concat(s.l, s.r), g -> length(g) <= 4)
AND (size(s.l) + size(s.r) = 8 AND size(h) = 1 OR size(s.l) + size(s.r) < 8 AND size(h) = 2)
THEN lower(array_join(transform(concat(s.l, array_repeat('0', 8 - size(s.l) - size(s.r)), s.r), g -> lpad(g, 4, '0')), '')) END), 0) END), 0) END
"""


def ip_hex(ip: str) -> Column:
    """32 hex digits of the IPv4 or IPv6 address in column ``ip``; NULL for any other text."""
    name = f"`{ip}`"
    v6, tail = _V6_HEX.format(ip=name), _DOTTED_TAIL.format(ip=name)
    mixed = _V6_HEX.format(ip="t")
    return F.expr(
        f"CASE WHEN NOT contains({name}, ':') THEN {_V4_HEX.format(ip=name)} "
        f"WHEN contains({name}, '.') THEN get(transform(array({tail}), t -> {mixed}), 0) ELSE {v6} END"
    )


def ranges_from_cidr(networks: DataFrame, network: str = "network") -> DataFrame:
    """Add ``lo`` and ``hi`` (32 hex digits) to rows that hold a CIDR block such as ``10.0.0.0/8``."""
    networks = networks.withColumn("_net", F.split(F.col(network), "/")[0]).withColumn("_base", ip_hex("_net"))
    bits = F.split(F.col(network), "/")[1].cast("int")
    size = F.when(F.col("_base").startswith(_MAPPED), bits + 96).otherwise(bits)
    nibbles = F.floor(size / F.lit(4)).cast("int")
    rest = size % 4

    def bound(fill_hex: str, part: Column) -> Column:
        head = F.substring(F.col("_base"), F.lit(1), F.col("_nibbles"))
        return F.rpad(F.concat(head, part), 32, fill_hex)

    digit = F.conv(F.substring(F.col("_base"), F.col("_nibbles") + 1, F.lit(1)), 16, 10).cast("int")
    span = F.expr("16 >> _rest")
    low = F.when(F.col("_rest") > 0, F.lower(F.hex(digit - digit % span))).otherwise("")
    high = F.when(F.col("_rest") > 0, F.lower(F.hex(digit - digit % span + span - 1))).otherwise("")
    return (
        networks.withColumns({"_nibbles": nibbles, "_rest": rest})
        .withColumns({"lo": bound("0", low), "hi": bound("f", high)})
        .drop("_net", "_base", "_nibbles", "_rest")
    )


def ranges_from_longs(ranges: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """IPv4 ranges given as integers, rewritten with hex bounds."""
    return ranges.withColumns(
        {c: F.concat(F.lit(_MAPPED), F.lpad(F.lower(F.hex(F.col(c).cast("bigint"))), 8, "0")) for c in (lo, hi)}
    )


# the digits in which a bound goes beyond the shared prefix; a bound that ends in 0s (lo) or fs (hi) needs fewer blocks
_SHARED = "array_position(transform(sequence(1, 32), i -> substr(lo, i, 1) = substr(hi, i, 1)), false) - 1"
_DIGIT = "cast(conv(substr({of}, {at} + 1, 1), 16, 10) AS int)"
_SPLIT = f"""
CASE WHEN lo = hi THEN array(named_struct('head', substr(lo, 1, 31), 'first', {_DIGIT.format(of="lo", at="31")}, 'last', {_DIGIT.format(of="lo", at="31")}))
WHEN below <= shared AND above <= shared AND shared > 0
THEN array(named_struct('head', substr(lo, 1, shared - 1), 'first', {_DIGIT.format(of="lo", at="(shared - 1)")}, 'last', {_DIGIT.format(of="lo", at="(shared - 1)")}))
ELSE concat(
array(named_struct('head', substr(lo, 1, shared), 'first', {_DIGIT.format(of="lo", at="shared")} + int(below > shared + 1), 'last', {_DIGIT.format(of="hi", at="shared")} - int(above > shared + 1))),
CASE WHEN below > shared + 1 THEN transform(sequence(shared + 1, below - 1), i ->
named_struct('head', substr(lo, 1, i), 'first', {_DIGIT.format(of="lo", at="i")} + int(i < below - 1), 'last', 15)) ELSE array() END,
CASE WHEN above > shared + 1 THEN transform(sequence(shared + 1, above - 1), i ->
named_struct('head', substr(hi, 1, i), 'first', 0, 'last', {_DIGIT.format(of="hi", at="i")} - int(i < above - 1))) ELSE array() END)
END
"""


def prefix_blocks(ranges: DataFrame) -> DataFrame:
    """``key`` and the geo fields: every range as aligned blocks, named by the hex digits their addresses share.

    Of several ranges with one block the one inside the others gives the fields. Rows without a bound, or whose bounds
    are the wrong way round, hold no address.
    """
    rows = ranges.select("lo", "hi", *GEO_FIELDS).where("lo <= hi")
    rows = rows.withColumn("shared", F.expr(f"CASE WHEN lo = hi THEN 32 ELSE {_SHARED} END"))
    rows = rows.withColumns({"below": F.expr("length(trim(TRAILING '0' FROM lo))"), "above": F.expr("length(trim(TRAILING 'f' FROM hi))")})
    rows = rows.select("lo", "hi", *GEO_FIELDS, F.inline(F.expr(_SPLIT))).where("first <= last")
    rows = rows.withColumn("digit", F.explode(F.sequence("first", "last")))
    # the whole address space is the one block that has no digits
    key = F.when((F.col("head") == "") & (F.col("first") == 0) & (F.col("last") == 15), "")
    rows = rows.withColumn("key", F.coalesce(key, F.concat("head", F.lower(F.hex("digit")))))
    inner = F.struct(F.col("lo"), F.translate("hi", "0123456789abcdef", "fedcba9876543210").alias("hi"), *GEO_FIELDS)
    return rows.groupBy("key").agg(F.max_by(F.struct(*GEO_FIELDS), inner).alias("found")).select("key", "found.*")


#: Digits of an address's prefix after those of its family up to which blocks are few: at most 16^0 + .. + 16^4 a family.
SHORT_DIGITS = 4


def _in_family(length: str, ip: str) -> str:
    """SQL: blocks of this prefix length concern the address; those of the mapped form go with IPv4 only."""
    return f"({length} >= {len(_MAPPED)} OR NOT startswith({ip}, '{_MAPPED}'))"


def _is_short(key: str) -> str:
    low = len(_MAPPED)
    return f"(length({key}) <= {SHORT_DIGITS} OR startswith({key}, '{_MAPPED}') AND length({key}) <= {low + SHORT_DIGITS})"


def _chained(events: DataFrame, blocks: DataFrame, lengths: list[int], small: bool, broadcast_rows: int) -> DataFrame:
    """``_found``: one lookup for each prefix length, the longest that hits."""
    hits = []
    for n in sorted(lengths, reverse=True):
        hit = f"_hit{n}"
        side = blocks.where(F.length("key") == n).select(F.col("key").alias("r__key"), F.struct(*GEO_FIELDS).alias(hit))
        events = events.withColumn("_key", F.expr(f"CASE WHEN {_in_family(str(n), '_ip')} THEN substr(_ip, 1, {n}) END"))
        if small or n <= SHORT_DIGITS:
            events = events.join(F.broadcast(side), F.col("_key") == F.col("r__key"), "left").drop("r__key")
        else:
            events = left_lookup(events, side, ["_key"], broadcast_rows=broadcast_rows)
        hits.append(hit)
    return events.withColumn("_found", F.coalesce(*[F.col(h) for h in hits])).drop("_key", *hits)


def _by_address(events: DataFrame, blocks: DataFrame, lengths: list[int], broadcast_rows: int) -> DataFrame:
    """``_found`` by way of the distinct addresses, which are looked up once each."""
    spark = events.sparkSession
    addresses = cut_lineage(events.select("_ip").where("_ip IS NOT NULL").distinct(), spark, "addresses")
    own = f"transform(filter(array({', '.join(map(str, lengths))}), n -> {_in_family('n', '_ip')}), n -> substr(_ip, 1, n))"
    keys = addresses.select("_ip", F.explode(F.expr(own)).alias("key"))
    facts = F.struct(*GEO_FIELDS).alias("_fact")
    few = F.broadcast(blocks.where(_is_short("key")).select("key", facts))  # at most 2 x 69,905 rows
    parts = [keys.where(_is_short("key")).join(few, "key")]
    # a longer IPv4 block has at most 65,536 addresses; an IPv6 block may have any number, so its keys are salted
    v4 = F.startswith("key", F.lit(_MAPPED))
    long = blocks.where(f"NOT {_is_short('key')}").select("key", facts)
    many = keys.where(f"NOT {_is_short('key')}")
    parts.append(many.where(v4).join(long.where(v4), "key"))
    salted = left_lookup(many.where(~v4), long.where(~v4).withColumnRenamed("key", "r_key"), ["key"], broadcast_rows=broadcast_rows)
    parts.append(salted.where("_fact IS NOT NULL").select("key", "_ip", "_fact"))
    hits = parts[0].unionByName(parts[1]).unionByName(parts[2])
    found = hits.groupBy(F.col("_ip").alias("r__ip")).agg(F.max_by("_fact", F.length("key")).alias("_found"))
    return left_lookup(events, cut_lineage(found, spark, "found"), ["_ip"], broadcast_rows=broadcast_rows)


def geo(ranges: DataFrame, target: str = "clientip", broadcast_rows: int = BROADCAST_ROWS):
    """Step that adds city, country and continent. ``ranges`` has rows of hex bounds ``lo``..``hi``; they may nest.

    127.0.0.1 is left alone; an unknown or malformed address changes nothing.
    """

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        ip = optional(df, target)
        keyed = df.withColumn("_address", F.when(when & (ip != "127.0.0.1"), ip)).withColumn("_ip", ip_hex("_address"))
        blocks = prefix_blocks(ranges)
        small, [lengths] = measured(blocks, broadcast_rows, BROADCAST_BYTES, F.collect_set(F.length("key")))
        if not small:
            blocks = cut_lineage(blocks, df.sparkSession, "geo-blocks")
            lengths = [r[0] for r in blocks.select(F.length("key")).distinct().collect()]  # at most 33
        if not lengths:
            joined = keyed.withColumn("_found", F.lit(None).cast(T.StructType([T.StructField(f, T.StringType()) for f in GEO_FIELDS])))
        elif small or df.isStreaming:
            joined = _chained(keyed, blocks, lengths, small, broadcast_rows)
        else:
            joined = _by_address(keyed, blocks, lengths, broadcast_rows)
        found = F.col("_found").isNotNull()
        return put(joined, {f: F.col(f"_found.{f}") for f in GEO_FIELDS}, found).drop("_address", "_ip", "_found")

    return step
