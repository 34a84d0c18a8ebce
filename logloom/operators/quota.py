"""Byte quota per token in arrival order.

An event is allowed when the token's use so far plus its size stays within the limit; a dropped event uses nothing, so
a smaller one may pass later. That is greedy and order dependent, and one token may own a third of all events.

A token whose events all fit, or of which not even the smallest fits, is decided from its total and minimum, without
ordering anything. The events of every other token are cut, in order, into chunks of bounded size, one row each. A chunk
is answered by one fold over its events once the room at its start is known, so a token of one chunk is done.

The chunks of a longer token are leaves of a tree of (sum, min) entries. Let 2^j be the highest power of two within the
room. As long as the room stays there, every smaller event passes, larger ones than 2^(j+1) never do, and the first event
of 2^j or more that fits takes the room below 2^j. So an entry holds, for each j, the sum of the smaller events and the
least of (event of that size + smaller events before it). From these it follows exactly, without its events, whether an
entry can take the room below 2^j; all before the first that does are skipped with a prefix sum, on the level of spans of
chunks first, then inside one span. Only that one chunk is folded, and the room has lost a binary digit: there are no
more steps than digits in the room, and a step reads entries, and one chunk of each open token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.cols import let
from logloom.operators.lookup import left_lookup
from logloom.session import cut_lineage

#: Events of a chunk: one row holds their order keys and sizes.
CHUNK_ROWS = 50_000
#: Rows of a partition that is cut into chunks, in chunks, and partitions of a span.
PART_CHUNKS, SPAN_PARTS = 40, 25
#: More than any sum of sizes, and small enough to be added to one.
NEVER = 1 << 61
_PLACE = 32  # bits of a chunk's number inside its partition


def check_quota(
    events: DataFrame,
    quotas: DataFrame,
    order: list[str],
    token: str = "token",
    size: str = "bytes",
    chunk_rows: int = CHUNK_ROWS,
    span_parts: int = SPAN_PARTS,
) -> DataFrame:
    """Add ``allowed`` to every event.

    ``order`` names columns that order the events of a token without ties.
    ``quotas`` holds user_id, limits and current_usage. An unknown token is
    always allowed, a missing size counts as 0; sizes are not negative.
    """
    spark = events.sparkSession
    rows = events.withColumns(
        {
            "token": F.col(token),
            "_ord": F.struct(*[F.col(c) for c in order]),
            "_b": F.coalesce(F.col(size).cast("bigint"), F.lit(0)),
        }
    )
    room = quotas.select(F.col("user_id").alias("token"), (F.col("limits") - F.col("current_usage")).alias("_room"))
    totals = (
        rows.groupBy("token")
        .agg(F.sum("_b").alias("_sum"), F.min("_b").alias("_min"), F.max("_b").alias("_top"), F.count("*").alias("_n"))
        .join(room, "token")
    )
    verdict = F.when(F.col("_sum") <= F.col("_room"), "keep").when(F.col("_min") > F.col("_room"), "drop").otherwise("order")
    totals = totals.select("token", "_room", "_n", F.least("_top", "_room").alias("_top"), verdict.alias("_case"))
    known = cut_lineage(totals, spark, "quota-totals")
    side = known.select(F.col("token").alias("r_token"), "_room", "_n", "_case")
    cases = left_lookup(rows, side, ["token"])
    names = events.columns
    plain = cases.filter(F.col("_case").isNull() | (F.col("_case") != "order"))
    plain = plain.select(*names, F.coalesce(F.col("_case") == "keep", F.lit(True)).alias("allowed"))

    # only what the ordered decision needs is shuffled; sizes beyond the room never pass
    contended = cases.filter((F.col("_case") == "order") & (F.col("_b") <= F.col("_room")))
    contended = contended.select("token", "_ord", "_b", "_room", "_n")
    one = contended.where(F.col("_n") <= chunk_rows).groupBy("token").agg(_in_order().alias("events"), F.first("_room").alias("_room"))
    passed = one.select("token", F.inline(_folded("events", "_room")))
    n_long, top = known.where((F.col("_case") == "order") & (F.col("_n") > chunk_rows)).agg(F.sum("_n"), F.max("_top")).first()
    if n_long:
        chunks = _chunks(contended.where(F.col("_n") > chunk_rows), n_long, chunk_rows, span_parts)
        passed = passed.unionByName(_by_steps(chunks, top))
    ordered = cases.filter(F.col("_case") == "order")
    passed = passed.select(F.col("token").alias("_t"), F.col("_ord").alias("_o"), F.lit(True).alias("_ok"))
    ordered = ordered.join(passed, (F.col("token") == F.col("_t")) & (F.col("_ord") == F.col("_o")), "left")
    return plain.unionByName(ordered.select(*names, F.col("_ok").isNotNull().alias("allowed")))


def _in_order() -> Column:
    """The events of a chunk in order: order keys, sizes and the binary digits of the sizes (-1 for size 0)."""
    digits = F.expr("CASE WHEN _b > 0 THEN length(bin(_b)) - 1 ELSE -1 END")
    return F.array_sort(F.collect_list(F.struct("_ord", F.col("_b").alias("b"), digits.alias("k"))))


def _room_after(events: str, room: str) -> Column:
    return F.expr(f"aggregate({events}, {room}, (r, e) -> CASE WHEN e.b <= r THEN r - e.b ELSE r END)")


def _folded(events: str, room: str) -> Column:
    """The events that pass when the chunk starts with ``room``.

    The fold notes one character an event, in blocks, so that no long text is copied for each event.
    """
    mark = "CASE WHEN e.b <= a.room THEN '1' ELSE '0' END"
    fold = F.expr(f"""
    aggregate({events}, named_struct('room', {room}, 'block', '', 'blocks', cast(array() AS array<string>)),
      (a, e) -> named_struct(
        'room', CASE WHEN e.b <= a.room THEN a.room - e.b ELSE a.room END,
        'block', CASE WHEN octet_length(a.block) < 255 THEN concat(a.block, {mark}) ELSE '' END,
        'blocks', CASE WHEN octet_length(a.block) < 255 THEN a.blocks ELSE concat(a.blocks, array(concat(a.block, {mark}))) END),
      a -> split(concat(array_join(a.blocks, ''), a.block), ''))
    """)
    return let(fold, lambda marks: F.filter(events, lambda e, i: F.get(marks, i) == "1"))


def _chunks(rows: DataFrame, n: int, chunk_rows: int, span_parts: int) -> DataFrame:
    """``token, chunk, span, events, _room``: the events of long tokens, cut in order; numbers of chunks rise with the order."""
    spark = rows.sparkSession
    parts = max(-(-n // (PART_CHUNKS * chunk_rows)), min(spark.sparkContext.defaultParallelism, -(-n // chunk_rows)))
    # range partitions split a hot token as well; inside one, rows are numbered as they are sorted
    rows = rows.repartitionByRange(parts, "token", "_ord").sortWithinPartitions("token", "_ord")
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    chunk = F.expr(f"shiftleft(_part, {_PLACE}) + (_at - shiftleft(_part, 33)) DIV {chunk_rows}")
    rows = rows.select("token", chunk.alias("chunk"), F.expr(f"_part DIV {span_parts}").alias("span"), "_ord", "_b", "_room")
    found = rows.groupBy("token", "chunk", "span").agg(_in_order().alias("events"), F.first("_room").alias("_room"))
    # the written table fixes the numbers, whatever task has to run again
    return cut_lineage(found, spark, "quota-chunks")


def _entries(chunks: DataFrame, classes: int) -> DataFrame:
    """``token, span, chunk, sums``: for each j the sum of the smaller events (s) and the least sum that an event of 2^j ends on (m)."""
    one = f"""
    transform(sequence(0, {classes}), j -> aggregate(events, named_struct('s', 0L, 'm', {NEVER}L),
      (a, e) -> named_struct('s', CASE WHEN e.k < j THEN a.s + e.b ELSE a.s END, 'm', CASE WHEN e.k = j THEN least(a.m, a.s + e.b) ELSE a.m END)))
    """
    return cut_lineage(chunks.select("token", "span", "chunk", "_room", F.expr(one).alias("sums")), chunks.sparkSession, "quota-entries")


def _spans(entries: DataFrame, classes: int) -> DataFrame:
    """The same for spans: the sums add up, and the sums before a chunk count for its least."""
    rows = entries.select("token", "span", "chunk", F.posexplode("sums").alias("j", "e")).select("token", "span", "chunk", "j", "e.s", "e.m")
    before = Window.partitionBy("token", "span", "j").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("m", F.least(F.col("m") + F.coalesce(F.sum("s").over(before), F.lit(0)), F.lit(NEVER)))
    spans = rows.groupBy("token", "span", "j").agg(F.sum("s").alias("s"), F.min("m").alias("m"))
    return spans.groupBy("token", "span").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "s", "m"))), lambda e: F.struct(e["s"], e["m"])).alias("sums"))


def _first_end(entries: DataFrame, at: str) -> DataFrame:
    """For each token the first entry that takes the room below 2^j, and the room before it.

    ``entries``: token, _R, _j, the entry's number ``at`` and its ``sums``, of the entries that are still to come.
    """
    before = Window.partitionBy("token").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    rows = entries.select("token", at, "_R", "_j", F.expr("sums[_j].s").alias("s"), F.expr("sums[_j].m").alias("m"))
    rows = rows.withColumn("_left", F.col("_R") - F.coalesce(F.sum("s").over(before), F.lit(0)))
    ends = (F.col("m") <= F.col("_left")) | (F.col("_left") - F.col("s") < F.expr("shiftleft(1L, _j)"))
    return rows.where(ends).groupBy("token").agg(F.min(F.struct(at, "_left")).alias("_end"))


def _by_steps(chunks: DataFrame, top: int) -> DataFrame:
    """Allowed events of tokens with several chunks."""
    spark = chunks.sparkSession
    classes = max(top, 1).bit_length()  # one beyond the largest size: there all events are smaller
    entries = _entries(chunks, classes)
    spans = cut_lineage(_spans(entries, classes), spark, "quota-spans")
    digits = F.expr(f"least({classes}, length(bin(_R)) - 1)").alias("_j")
    # a token is open while it has room: _at is the chunk that was folded last
    state = entries.groupBy("token").agg(F.first("_room").alias("_R")).select(
        "token", "_R", F.lit(-1).cast("long").alias("_at"), F.lit(-1).cast("long").alias("_span")
    )
    history = None
    while True:
        state = state.select("*", digits)
        live = state.where("_R > 0")
        near = entries.join(live.withColumnRenamed("_span", "span"), ["token", "span"]).where("chunk > _at")
        near = near.select("token", F.struct(F.lit(0).alias("kind"), F.col("chunk").alias("at")).alias("at"), "_R", "_j", "sums")
        # the top level has one entry for some 50 million events of a token
        far = spans.join(live, "token").where("span > _span")
        far = far.select("token", F.struct(F.lit(1).alias("kind"), F.col("span").alias("at")).alias("at"), "_R", "_j", "sums")
        found = _first_end(near.unionByName(far), "at").select("token", "_end.at.kind", "_end.at.at", "_end._left")
        found = cut_lineage(found.join(state.select("token", "_j"), "token"), spark, "quota-found")
        here = found.where("kind = 0").select("token", F.col("at").alias("chunk"), "_left")
        down = found.where("kind = 1").select("token", F.col("at").alias("span"), F.col("_left").alias("_R"), "_j")
        down = _first_end(entries.join(down, ["token", "span"]), "chunk").select("token", "_end.chunk", "_end._left")
        folded = chunks.join(here.unionByName(down), ["token", "chunk"]).select(
            "token", F.col("chunk").alias("_to"), F.col("span").alias("_to_span"), "_left", _room_after("events", "_left").alias("_after")
        )
        done = state.join(folded, "token", "left").select("token", "_R", "_j", F.col("_at").alias("_from"), "_to", "_to_span", "_left", "_after")
        done = cut_lineage(done, spark, "quota-step")
        history = done if history is None else history.unionByName(done)
        state = done.where("_to IS NOT NULL").select("token", F.col("_after").alias("_R"), F.col("_to").alias("_at"), F.col("_to_span").alias("_span"))
        if state.limit(1).count() == 0:
            break

    # a token has as many steps as digits, so their list is short
    step = F.struct("_from", "_to", F.when(F.col("_R") > 0, F.col("_j")).otherwise(0).alias("_j"), "_left")
    steps = history.groupBy(F.col("token").alias("r_token")).agg(F.collect_list(step).alias("_steps"))
    own = F.expr("filter(_steps, s -> chunk > s._from AND (s._to IS NULL OR chunk <= s._to))[0]")
    which = left_lookup(entries.select("token", "chunk"), steps, ["token"]).select("token", "chunk", own.alias("_own"))
    answer = chunks.join(which, ["token", "chunk"])
    skipped = answer.where("_own._to IS NULL OR chunk < _own._to").select("token", F.inline(F.expr("filter(events, e -> e.k < _own._j)")))
    folded = answer.where("chunk = _own._to").select("token", "events", F.col("_own._left").alias("_left"))
    return skipped.unionByName(folded.select("token", F.inline(_folded("events", "_left"))))
