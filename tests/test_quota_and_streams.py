import random

import pytest
from pyspark.sql import functions as F

from logloom.functions import rotation
from logloom.operators.quota import check_quota
from logloom.session import shared_dir
from logloom.streaming import quota_stream, stream


def brute_force(events, limits):
    used, out = {}, {}
    for seq, token, size in sorted(events):
        if token not in limits:
            out[seq] = True
            continue
        room = limits[token] - used.get(token, 0)
        out[seq] = (size or 0) <= room
        if out[seq]:
            used[token] = used.get(token, 0) + (size or 0)
    return out


@pytest.mark.parametrize("seed, chunk_rows, span_parts", [(1, 10**6, 25), (2, 37, 25), (3, 10, 1), (4, 3, 1), (5, 60, 1), (6, 2, 2)])
def test_quota_matches_brute_force(rows, seed, chunk_rows, span_parts):
    rng = random.Random(seed)
    tokens = ["hot"] * 6 + ["a", "b", "c", "d", "free"]
    sizes = [0, 1, 2, 3, 5, 8, 64, 65, 100, 1000, 1023, 1024, None]
    events = [(i, rng.choice(tokens), rng.choice(sizes)) for i in range(400)]
    limits = {"hot": rng.randint(500, 20000), "a": 0, "b": 1500, "c": 10**9, "d": 63}
    quotas = rows([(t, v + 3, 3) for t, v in limits.items()], "user_id string, limits bigint, current_usage bigint")
    df = rows(events, "seq bigint, token string, bytes bigint").repartition(3)
    got = {r.seq: r.allowed for r in check_quota(df, quotas, ["seq"], chunk_rows=chunk_rows, span_parts=span_parts).collect()}
    assert got == brute_force(events, limits)


def test_quota_plans_run_no_python_and_join_no_token_alone(rows):
    df = rows([(i, "t", 7 * i % 13) for i in range(300)], "seq bigint, token string, bytes bigint")
    quotas = rows([("t", 700, 0)], "user_id string, limits bigint, current_usage bigint")
    out = check_quota(df, quotas, ["seq"], chunk_rows=20, span_parts=1)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
    assert {r.seq: r.allowed for r in out.collect()} == brute_force([(i, "t", 7 * i % 13) for i in range(300)], {"t": 700})


def test_a_chunk_of_many_events_is_folded_whole(rows, spark):
    """More events in one chunk than a block of the fold has."""
    df = spark.range(3000).selectExpr("id AS seq", "'t' AS token", "(id * 7919) % 1000 AS bytes")
    quotas = rows([("t", 300_000, 5)], "user_id string, limits bigint, current_usage bigint")
    events = [(i, "t", i * 7919 % 1000) for i in range(3000)]
    for chunk_rows in (3000, 1000):
        got = {r.seq: r.allowed for r in check_quota(df, quotas, ["seq"], chunk_rows=chunk_rows).collect()}
        assert got == brute_force(events, {"t": 299_995})


def test_quota_without_room_lets_empty_events_pass(rows):
    df = rows([(1, "t", 5), (2, "t", 0), (3, "t", 1)], "seq bigint, token string, bytes bigint")
    quotas = rows([("t", 2, 3)], "user_id string, limits bigint, current_usage bigint")
    for chunk_rows in (1, 10):
        got = check_quota(df, quotas, ["seq"], chunk_rows=chunk_rows).orderBy("seq").collect()
        # the use so far exceeds the limit, so not even an empty event fits
        assert [r.allowed for r in got] == [False, False, False]


def test_quota_stream_over_several_batches_equals_one_batch(spark, rows):
    root = shared_dir(spark, "quota-test")
    events = [(i, "t" if i % 3 else "u", i % 11) for i in range(120)]
    for part in range(3):
        rows(events[part * 40 : part * 40 + 40], "seq bigint, token string, bytes bigint").coalesce(1).write.parquet(f"{root}/in/p{part}")
    quotas = rows([("t", 150, 0), ("u", 10**6, 0)], "user_id string, limits bigint, current_usage bigint")
    source = stream.file_stream(spark, f"{root}/in/*", "seq bigint, token string, bytes bigint", "parquet", max_files=1)
    writer = quota_stream.quota_writer(quotas, root, ["seq"])
    batches = []

    def twice(batch, batch_id):
        writer(batch, batch_id)
        writer(batch, batch_id)  # a replay changes nothing
        batches.append([r.seq for r in batch.collect()])

    stream.start(source, lambda df: df, root, "quota-test", {"availableNow": True}, twice).awaitTermination()
    assert len(batches) == 3
    arrived = {seq: i for i, seq in enumerate(s for b in batches for s in sorted(b))}
    expected = brute_force([(arrived[s], t, b) for s, t, b in events], {"t": 150, "u": 10**6})
    got = {arrived[r.seq]: r.allowed for r in spark.read.parquet(f"{root}/events/batch_id=*").collect()}
    assert got == expected


def test_sink_replay_and_rewrite(spark, rows):
    root = shared_dir(spark, "sink-test")
    schema = "doc_id string, index_name string, v int"
    stream.write_batch(rows([("a", "i1", 1), ("b", "i2", 2)], schema), 0, root)
    stream.write_batch(rows([("a", "i1", 1), ("b", "i2", 2)], schema), 0, root)
    stream.write_batch(rows([("a", "i1", 9)], schema), 1, root)
    assert {(r.doc_id, r.v) for r in stream.read_index(spark, root).collect()} == {("a", 9), ("b", 2)}


def test_observed_counters(spark, rows):
    df, seen = stream.counted(rows([("x",), (None,)], "t string"), "seen", {"missing": F.col("t").isNull()})
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"events": 2, "missing": 1}


def test_drain_takes_all_that_had_arrived(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def put(a, b):
        for i in range(a, b):
            (folder / f"{i}.txt").write_text(f"{i}\n")

    def docs(df):
        return df.select(F.col("value").alias("doc_id"), F.lit("all").alias("index_name"))

    put(0, 2)
    source = stream.file_stream(spark, str(folder), max_files=1)
    query = stream.start(source, docs, root, "drained", {"processingTime": "1 hour"})
    while not query.lastProgress or query.status["isTriggerActive"]:
        query.awaitTermination(0.2)
    put(2, 7)  # the trigger is idle, and a batch takes one file
    assert stream.drain(spark, "drained") and "drained" not in stream.running(spark)
    got = stream.read_index(spark, f"{root}/index")
    assert sorted(r.doc_id for r in got.collect()) == [str(i) for i in range(7)]


def test_stop_of_unknown_topic(spark):
    assert stream.stop(spark, "no-such-topic") is False and stream.drain(spark, "no-such-topic") is False


UTC8 = 8 * 3600 * 1000


@pytest.mark.parametrize(
    "local, period, stamp",
    [
        ("2024-01-31 23:59:59", "1hr", "24020100"),
        ("2024-01-31 23:00:00", "12hr", "24020100"),
        ("2024-01-31 10:00:00", "5hr", "24013112"),
        ("2023-12-31 23:00:00", "24hr", "24010100"),
        ("2024-01-07 12:00:00", "1wk", "24010800"),
        ("2024-01-08 00:00:00", "1wk", "24011500"),
        ("2024-01-15 23:00:00", "2wk", "24011600"),
        ("2024-01-16 00:00:00", "2wk", "24020100"),
        ("2024-01-15 00:00:00", "9wk", "24011600"),
        ("2024-12-31 00:00:00", "1mo", "25010100"),
        ("2024-04-01 00:00:00", "3mo", "24070100"),
        ("2024-06-30 00:00:00", "5mo", "24070100"),
        ("2024-06-30 00:00:00", "12mo", "25010100"),
        ("2024-06-30 10:00:00", "", "24070100"),
        ("2024-06-30 10:00:00", "1mo 2wk 3hr", "24070100"),
    ],
)
def test_rotation(spark, local, period, stamp):
    df = spark.range(1).select((F.unix_millis(F.lit(local).cast("timestamp")) - UTC8).alias("m"))
    assert df.select(rotation.rotation_stamp(F.col("m"), period).alias("s")).first().s == stamp


def test_rotation_without_time_and_validation(spark, rows):
    assert spark.range(1).select(rotation.rotation_stamp(F.lit(None).cast("bigint"), "1hr").alias("s")).first().s == "_"
    periods = {"6mo": True, "5mo": False, "2wk": True, "3wk": False, "12hr": True, "7hr": False, "48hr": False, "": False, "x": False}
    df = rows([(k,) for k in periods], "p string")
    assert {r.p: r.v for r in df.select("p", rotation.valid_period(F.col("p")).alias("v")).collect()} == periods


def test_escape(rows):
    df = rows([("Añ_b-1.C/d",)], "t string")
    assert df.select(rotation.escape_index(F.col("t")).alias("s")).first().s == "añ_b-1-c-d"


def test_reported_bytes_do_not_count_twice(spark, rows, tmp_path):
    """Two batches with the totals written back between them: the room is what is left of the limit."""
    from logloom.streaming.quota_stream import quota_writer

    stored = {"u": 10}

    def quotas():
        return rows([("u", 100, stored["u"])], "user_id string, limits long, current_usage long")

    def report(change, batch_id):
        for r in change.collect():
            stored[r.token] += r.usage

    write = quota_writer(quotas, str(tmp_path), ["n"], report=report)
    write(rows([(1, "u", 40), (2, "u", 60)], "n int, token string, bytes long"), 0)
    assert stored == {"u": 50}
    write(rows([(3, "u", 50), (4, "u", 1)], "n int, token string, bytes long"), 1)
    allowed = {r.n: r.allowed for r in spark.read.parquet(f"{tmp_path}/events/batch_id=*").collect()}
    assert allowed == {1: True, 2: False, 3: True, 4: False} and stored == {"u": 100}


@pytest.fixture
def rocks(spark):
    from logloom.streaming import quota_state

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, quota_state.PROVIDER)
    yield quota_state
    spark.conf.set(name, before)


def test_greedy_equals_a_walk():
    import numpy as np

    from logloom.streaming.quota_state import greedy

    rng = random.Random(5)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 2, 3, 5, 8, 64, 100, 1000]) for _ in range(rng.randint(0, 40))]
        room, want = rng.randint(-2, 3000), []
        left = room
        for s in sizes:
            want.append(s <= left)
            left -= s if s <= left else 0
        assert greedy(np.array(sizes, np.int64), room).tolist() == want


def test_quota_state_survives_a_restart(spark, rows, rocks, tmp_path):
    schema = "seq bigint, token string, bytes bigint"
    events = [(i, "t" if i % 3 else "u", i % 11 if i % 7 else None) for i in range(120)]
    quotas = rows([("t", 150, 20), ("u", 10**6, 0)], "user_id string, limits bigint, current_usage bigint")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={batch_id}")

    for part in range(3):
        rows(events[part * 40 : part * 40 + 40], schema).repartition(2).write.parquet(f"{tmp_path}/in/p{part}")
        source = stream.file_stream(spark, f"{tmp_path}/in/*", schema, "parquet")
        checked = rocks.check_stream(source, quotas, ["seq"])
        stream.start(checked, lambda df: df, str(tmp_path), f"quota-state-{part}", {"availableNow": True}, write).awaitTermination()
    got = {r.seq: r.allowed for r in spark.read.parquet(f"{tmp_path}/out/batch_id=*").collect()}
    assert got == brute_force(events, {"t": 130, "u": 10**6})
    used = {r.token: (r.used, r.dropped) for r in rocks.state_of(spark, f"{tmp_path}/checkpoint").collect()}
    sizes = {t: [(b or 0, got[i]) for i, token, b in events if token == t] for t in ("t", "u")}
    assert used == {t: (sum(b for b, ok in x if ok), sum(b for b, ok in x if not ok)) for t, x in sizes.items()}


def test_compaction_keeps_what_readers_see(spark, rows):
    root = shared_dir(spark, "compact-test")
    schema = "doc_id string, index_name string, v int"
    stream.write_batch(rows([("a", "i1", 1), ("b", "i2", 2), ("c", "i1", 3)], schema), 0, root)
    stream.write_batch(rows([("a", "i1", 9), ("d", "i1", 4)], schema), 1, root)
    before = {tuple(r) for r in stream.read_index(spark, root).collect()}
    stream.compact(spark, root, 1)
    assert {tuple(r) for r in stream.read_index(spark, root).collect()} == before == {("a", "i1", 9), ("b", "i2", 2), ("c", "i1", 3), ("d", "i1", 4)}
    late = rows([("b", "i2", 7, True), ("e", "i1", 5, False)], schema + ", late boolean")
    stream.write_batch(late, 2, root)
    after = {(r.doc_id, r.v, r.late) for r in stream.read_index(spark, root).collect()}
    assert after == {("a", 9, None), ("b", 7, True), ("c", 3, None), ("d", 4, None), ("e", 5, False)}
    stream.compact(spark, root, 2)
    assert {(r.doc_id, r.v, r.late) for r in stream.read_index(spark, root).collect()} == after


def test_reading_an_index_without_repeated_ids_moves_no_documents(spark, rows):
    root = shared_dir(spark, "narrow-test")
    stream.write_batch(rows([(f"d{i}", "i", i) for i in range(50)], "doc_id string, index_name string, v int"), 0, root)
    docs = stream.read_index(spark, root)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and docs.count() == 50
    stream.write_batch(rows([("d1", "i", -1), ("d1", "i", -2)], "doc_id string, index_name string, v int"), 1, root)
    docs = stream.read_index(spark, root)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Sort" not in plan
    assert docs.count() == 50 and docs.filter("doc_id = 'd1'").first().v < 0


def test_live_counters_add_micro_batches_up(spark, rows, tmp_path):
    from logloom.streaming import counters

    live = counters.LiveCounters()
    spark.streams.addListener(live)
    try:
        for part in range(3):
            rows([(i, i % 2 == 0) for i in range(part * 10, part * 10 + 10)], "n int, allowed boolean").coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
        source = stream.file_stream(spark, f"{tmp_path}/in/*", "n int, allowed boolean", "parquet", max_files=1)
        seen = counters.observed(source, "seen", {"usage_drop": ~F.col("allowed")})
        query = stream.start(seen, lambda df: df, str(tmp_path), "live-test", {"availableNow": True}, lambda df, i: df.write.parquet(f"{tmp_path}/out/{i}"))
        query.awaitTermination()
        for _ in range(100):
            if live.totals.get(("live-test", "seen"), {}).get("events") == 30:
                break
            import time

            time.sleep(0.1)
        assert dict(live.totals[("live-test", "seen")]) == {"events": 30, "usage_drop": 15}
    finally:
        spark.streams.removeListener(live)


def test_counters_of_a_batch_that_is_run_again_count_once(spark, rows, tmp_path):
    from logloom.streaming import counters

    write = counters.counting(lambda df, i: df.write.mode("overwrite").format("noop").save(), str(tmp_path), {"bad": F.col("n") < 0})
    batch = rows([(1,), (-1,), (2,)], "n int")
    for batch_id in (0, 0, 1):
        write(batch, batch_id)
    assert {r.outcome: r.events for r in counters.read_counters(spark, str(tmp_path)).collect()} == {"events": 6, "bad": 2}


def test_one_large_index_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "WRITE_BYTES", "20kb")
    docs = spark.range(0, 20_000, 1, 8).selectExpr("cast(id AS string) AS doc_id", "'all' AS index_name", "md5(cast(id AS string)) AS t")
    stream.write_batch(docs, 0, f"{tmp_path}/sink")
    assert len(list(tmp_path.glob("sink/batch_id=0/*/bucket=*/*.parquet"))) > 4
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) is None
    assert stream.read_index(spark, f"{tmp_path}/sink").distinct().count() == 20_000


def test_every_batch_of_the_counted_stream_is_spread(spark, monkeypatch):
    from logloom.catalog import q_streams

    write, parts = stream.write_batch, []

    def watched(batch, batch_id, root):
        parts.append(batch._jdf.queryExecution().toRdd().getNumPartitions())
        write(batch, batch_id, root)

    monkeypatch.setattr(stream, "write_batch", watched)
    q_streams.stream_counters(spark, "/root/testdata/sf0.001")
    assert len(parts) == 6 and set(parts) == {spark.sparkContext.defaultParallelism}
