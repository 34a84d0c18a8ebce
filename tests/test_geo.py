"""Geo lookups by prefix keys against a scan of the ranges."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from logloom.operators.geo import geo, prefix_blocks, ranges_from_cidr, ranges_from_longs

MAPPED = 0xFFFF << 32


def value(ip):
    parsed = ipaddress.ip_address(ip)
    return int(parsed) | (MAPPED if parsed.version == 4 else 0)


def nested(rng, low, high, depth):
    """Ranges inside ranges with arbitrary bounds."""
    out = []
    cuts = sorted(rng.sample(range(low, high), min(6, high - low)))
    for a, b in zip(cuts[::2], cuts[1::2]):
        out.append((a, b))
        if depth and b - a > 20:
            out += nested(rng, a, b, depth - 1)
    return out


def ranges_of(rows, bounds):
    data = [(f"{a:032x}", f"{b:032x}", f"c{i}", f"x{i}", "e") for i, (a, b) in enumerate(bounds)]
    return rows(data, "lo string, hi string, city string, country string, continent string")


def expected(bounds, at):
    held = [(b - a, i) for i, (a, b) in enumerate(bounds) if a <= at <= b]
    return f"c{min(held)[1]}" if held else None


@pytest.mark.parametrize("limit", [10**6, 0])
def test_nested_ranges_of_any_bounds(rows, limit):
    rng = random.Random(limit)
    v4 = (MAPPED, MAPPED | 0xFFFFFFFF)
    bounds = nested(rng, *v4, 3) + [v4, (5 << 120, (7 << 120) + 12345), (6 << 120, (6 << 120) + 3), (6 << 120, 6 << 120)]
    edges = [x for a, b in bounds for x in (a - 1, a, b, b + 1)]
    points = edges + [rng.randint(*v4) for _ in range(200)] + [rng.randint(4 << 120, 8 << 120) for _ in range(100)]
    points = [p for p in points if v4[0] <= p <= v4[1] or 1 << 100 < p < 1 << 128]
    texts = [str(ipaddress.ip_address(p & 0xFFFFFFFF) if p < 1 << 49 else ipaddress.IPv6Address(p)) for p in points]
    df = rows(list(enumerate(texts)), "n int, clientip string")
    got = {r.n: r.city for r in geo(ranges_of(rows, bounds), broadcast_rows=limit)(df).collect()}
    assert len(got) == len(points)
    for n, text in enumerate(texts):
        want = None if text == "127.0.0.1" else expected(bounds, points[n])
        assert got[n] == want, (text, got[n], want)


def test_blocks_cover_a_range_exactly(rows):
    rng = random.Random(7)
    for _ in range(3):
        a, b = sorted(rng.sample(range(1 << 16), 2))
        keys = [r.key for r in prefix_blocks(ranges_of(rows, [(a, b)])).collect()]
        held = sorted(x for k in keys for x in range(int(k.ljust(32, "0"), 16), int(k.ljust(32, "f"), 16) + 1))
        assert held == list(range(a, b + 1)) and len(keys) <= 30 * 4
    assert [r.key for r in prefix_blocks(ranges_of(rows, [(0, (1 << 128) - 1)])).collect()] == [""]
    assert [r.key for r in prefix_blocks(ranges_of(rows, [(5, 5)])).collect()] == [f"{5:032x}"]
    assert prefix_blocks(ranges_of(rows, [(6, 5)])).count() == 0


def test_a_whole_family_is_one_block(rows):
    blocks = rows([("0.0.0.0/0", "A"), ("::/0", "B"), ("10.1.0.0/16", "C")], "network string, city string").withColumns({"country": F.lit("X"), "continent": F.lit("Y")})
    ranges = ranges_from_cidr(blocks)
    assert prefix_blocks(ranges).count() == 3
    df = rows([(0, "1.2.3.4"), (1, "2001::1"), (2, "10.1.255.255"), (3, "junk")], "n int, clientip string")
    for limit in (0, 1000):
        assert [r.city for r in geo(ranges, broadcast_rows=limit)(df).orderBy("n").collect()] == ["A", "B", "C", None]


def test_million_ranges_and_one_over_all(spark):
    at = F.col("id") * 256 + (1 << 28)
    facts = {"city": F.concat(F.lit("c"), "id"), "country": F.lit("x"), "continent": F.lit("y")}
    many = spark.range(1_000_000).select(at.alias("lo"), (at + F.when(F.col("id") % 1000 == 0, 99).otherwise(255)).alias("hi"), "id").withColumns(facts).drop("id")
    one = spark.range(1).select(F.lit(0).alias("lo"), F.lit((1 << 32) - 1).alias("hi")).withColumns({k: F.lit("all") for k in facts})
    step = geo(ranges_from_longs(many.unionByName(one)))
    ip = "concat_ws('.', 16 + a DIV 65536, a DIV 256 % 256, a % 256, id % 256)"
    df = spark.range(20_000).withColumn("a", (F.col("id") * 7919) % 1_100_000).withColumn("clientip", F.expr(ip))
    out = step(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    inside = F.expr("a < 1000000 AND (a % 1000 <> 0 OR id % 256 < 100)")
    want = F.when(inside, F.concat(F.lit("c"), "a")).otherwise("all")
    assert out.where(~F.col("city").eqNullSafe(want)).count() == 0 and out.count() == 20_000


def test_large_table_in_a_stream(spark, rows, tmp_path):
    rows([("10.0.0.1", 1), ("10.0.9.1", 2), ("11.0.0.1", 3)], "clientip string, n int").write.parquet(f"{tmp_path}/in")
    blocks = rows([("10.0.0.0/20", "A"), ("10.0.8.0/22", "B")], "network string, city string").withColumns({"country": F.lit("X"), "continent": F.lit("Y")})
    stream = spark.readStream.schema("clientip string, n int").parquet(f"{tmp_path}/in")
    out = geo(ranges_from_cidr(blocks), broadcast_rows=0)(stream)
    out.writeStream.foreachBatch(lambda df, i: df.write.parquet(f"{tmp_path}/out/{i}")).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert {r.n: r.city for r in spark.read.parquet(f"{tmp_path}/out/*").collect()} == {1: "A", 2: "B", 3: None}
