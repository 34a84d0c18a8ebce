import pytest
from pyspark.sql import functions as F

from logloom.operators import mapping
from logloom.operators.lookup import fits_broadcast, left_lookup
from logloom.sources import decode

SAMPLE = (
    '{"fields":{"token":"t"},"@timestamp":"2031-08-19T22:04:51.306Z","beat":{"hostname":"h","name":"n","version":"9.9.9"},'
    '"input_type":"log","message":"m","offset":77,"source":"/s","tags":["test"],"type":"test"}'
)


def test_beat(rows):
    out = decode.beat(rows([(SAMPLE,), ("{}",), ('{"type": ',), ('{"@timestamp":"2031-08-19T22:04:51.306+08:00"}',)], "value string"), now=7).collect()
    assert tuple(out[0]) == ("t", "test", ["test"], "m", "streaming", 1944943491306)
    assert tuple(out[1]) == ("_unknown_", "_unknown_", [], "_", "streaming", 7)
    assert out[2].message == '{"type": ' and out[2].type == "_unknown_"
    # only UTC is a valid shipper time
    assert out[3].upload_timestamp == 7


def test_beat_from_bytes_keeps_position(rows):
    df = rows([(bytearray(SAMPLE.encode()), "logs", 3, 9)], "value binary, topic string, partition int, offset bigint")
    out = decode.doc_id(decode.beat(df)).first()
    assert (out.doc_id, out.token) == ("logs.3.9", "t")


def test_delimited(rows):
    lines = ["t y a,b,, file || body || more", "t y  file || x", "t y a || x", "no separator", None]
    df = rows([(v,) for v in lines], "value string")
    out = decode.delimited_line(df, now=1).collect()
    assert [(r.token, r.tags, r.message) for r in out] == [("t", ["a", "b"], "body || more"), ("t", [""], "x")]
    assert [r.reject_reason for r in decode.delimited_rejects(df).collect()] == ["short header", "no body", "empty"]


def test_tagged_output_keeps_every_row_in_one_pass(rows, spark, tmp_path):
    texts = [SAMPLE, '{"type": ', "", None, "{}"]
    rows([(i, t) for i, t in enumerate(texts)], "n int, value string").write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    for decoder in (decode.beat, decode.flat_json, decode.delimited_line):
        out = decoder(df, now=1, tagged=True)
        both = decode.accepted(out).select("n").collect() + decode.rejects(out).select("n").collect()
        assert sorted(r.n for r in both) == [0, 1, 2, 3, 4]
        assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r.n: (r.reject_reason, r.raw) for r in decode.beat(df, tagged=True).collect()}
    assert got == {0: (None, None), 1: ("malformed JSON", '{"type": '), 2: ("empty", ""), 3: ("empty", None), 4: (None, None)}
    assert decode.rejects(decode.beat(df, tagged=True)).columns == ["n", "reject_reason", "raw"]


def test_mapping_rejects_keep_the_raw_value(rows):
    df = rows([("5", "1.1.1.1", "23/Nov/2029:17:45:08 +0800"), ("x", "host", "bad"), (None, None, None)], "bytes string, clientip string, timestamp string")
    out = mapping.apply_mapping(df, mapping.mapping_for("nginx_error")).collect()
    assert (out[0].bytes, out[0].clientip, out[0].reject_fields) == (5, "1.1.1.1", [])
    assert out[0].timestamp is not None
    assert out[1].reject_fields_raw == {"bytes": "x", "clientip": "host", "timestamp": "bad"}
    assert out[2].reject_fields == []


def test_broadcast_is_checked_by_rows_and_bytes(rows):
    side = rows([("a", "x" * 100), ("b", "y")], "r_k string, v string")
    assert fits_broadcast(side) and not fits_broadcast(side, rows=1) and not fits_broadcast(side, size=100)


def test_lookup_keeps_every_event_either_way(rows):
    events = rows([(i, "hot" if i % 3 else None) for i in range(60)], "n int, k string")
    side = rows([("hot", 1), ("cold", 2)], "r_k string, v int")
    for limit in (10, 0):
        out = left_lookup(events, side, ["k"], None, limit)
        assert out.count() == 60 and out.filter(F.col("v") == 1).count() == 40
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("strategy=broadcast" in plan) == (limit == 10)


def test_a_side_too_large_to_broadcast_is_never_broadcast(rows):
    """Spark takes the repeated side for a small one, as its estimate knows nothing of the salts."""
    events = rows([(i, "hot" if i % 3 else None) for i in range(60)], "n int, k string")
    side = rows([("hot", 1), ("cold", 2)], "r_k string, v int")
    for salts in (16, 1):
        out = left_lookup(events, side, ["k"], None, 0, salts)
        assert out.count() == 60 and out.filter(F.col("v") == 1).count() == 40
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_decoders_by_configured_name(rows):
    df = rows([('{"message":"m","type":"t"}',)], "value string")
    assert decode.decode(df, "xyz-json", now=1).first().message == "m"
    assert decode.decode(df, "raw-line", token="a", type_="b", tags=["c"], upload_type="d", now=1).first().type == "b"
    with pytest.raises(ValueError):
        decode.decode(df, "no-such")
