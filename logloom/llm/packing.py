"""Packing documents into sequences: dominance reduction, then best fit on what remains.

Lengths are small integers, so the whole instance is a histogram of at most ``capacity`` counts. Sets of up to
three pieces that provably dominate every other set holding their largest piece are fixed first; the rest is
packed best-fit, longest first. The plan is a short list of patterns with repeat counts. Each piece then finds
its place from its rank among the pieces of its length, so no piece is moved to the driver or one task.

Defined cases: a null text is empty and takes one token (the end mark); rows that repeat are packed each; a
length below 1 or above the capacity gets no place (null); an empty table gives no rows; other columns of the
pieces are carried along.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.bpe import Bpe, Encoder, default_vocabulary, pack_ids
from logloom.llm.common import chunks, claim, map_rows, saved

CAPACITY = 1024
END_ID = 2
#: Rows of one length are numbered in so many groups; the driver reads at most capacity x SALTS counts.
SALTS = 128

Pattern = tuple[tuple[int, int], ...]  # (length, pieces) of one sequence


def reduce_dominant(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Fix dominating sets and take them out of ``counts``. Longest piece first.

    A piece alone dominates if nothing fits beside it. A pair with the largest fitting piece dominates if it is
    full, or if no two others fit together. If at most two others fit, that pair still dominates when its
    partner is as long as the best two others, and a full triple dominates when its two smaller
    pieces leave nothing longer to replace them.
    """
    fixed: list[tuple[Pattern, int]] = []

    def smallest(n: int, without: int) -> list[int]:
        out: list[int] = []
        for size in sorted(counts):
            out += [size] * min(n - len(out), counts[size] - (size == without))
            if len(out) == n:
                break
        return out

    def take(sizes: list[int]) -> None:
        need = {s: sizes.count(s) for s in sizes}
        times = min(counts[s] // k for s, k in need.items())
        fixed.append((tuple(sorted(need.items(), reverse=True)), times))
        for s, k in need.items():
            counts[s] -= k * times
            if not counts[s]:
                del counts[s]

    def best_two(room: int, without: int) -> tuple[int, int] | None:
        have = sorted(s for s in counts if counts[s] > (s == without))
        best, low, high = None, 0, len(have) - 1
        while low <= high:
            total = have[low] + have[high]
            alone = low == high and counts[have[low]] - (have[low] == without) < 2
            if total > room or alone:
                high -= 1
                continue
            if best is None or (total, have[low]) > (sum(best), best[1]):
                best = (have[high], have[low])
            low += 1
        return best

    for size in sorted(counts, reverse=True):
        while counts.get(size, 0):
            room = capacity - size
            partners = [s for s in counts if s <= room and counts[s] - (s == size) > 0]
            if not partners:
                take([size])
                continue
            best, low = max(partners), smallest(3, size)
            if best == room or len(low) < 2 or sum(low[:2]) > room:
                take([size, best])
                continue
            if len(low) < 3 or sum(low) > room:
                two = best_two(room, size)
                if two is None or best >= sum(two):
                    take([size, best])
                    continue
                longer = [s for s in counts if two[1] < s <= room and counts[s] - (s == size) - (s == two[0]) > 0 and s != two[0]]
                if sum(two) == room and not longer:
                    take([size, *two])
                    continue
            break
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts: equal sequences stay one pattern with a repeat count."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_ if r >= size), default=None)
            pattern, times = open_[room].pop() if room is not None else ((), left)
            if room is not None and not open_[room]:
                del open_[room]
            room = capacity if room is None else room
            each = min(room // size, left)
            full = min(times, left // each)
            open_.setdefault(room - each * size, []).append(((*pattern, (size, each)), full))
            if pattern and times > full:
                open_.setdefault(room, []).append((pattern, times - full))
            left -= each * full
    return [p for group in open_.values() for p in group]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    counts = {s: n for s, n in counts.items() if n}
    fixed = reduce_dominant(counts, capacity)
    return fixed + best_fit(counts, capacity)


def slots(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, pieces a sequence, offset of the first piece), by first rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for size, each in pattern:
            rank = used.get(size, 0)
            rows.setdefault(size, []).append((rank, sequence, each, offset))
            used[size] = rank + each * times
            offset += size * each
        sequence += times
    return {size: np.array(r, np.int64).T for size, r in rows.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0); every sequence holds at most ``capacity``."""
    spark = pieces.sparkSession
    spare = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = saved(pieces.select(*spare, F.monotonically_increasing_id().alias("__row")), "pieces")
    size = F.when(F.col(length).between(1, capacity), F.col(length).cast("int"))
    rows = rows.withColumns({"__size": size, "__salt": F.pmod("__row", F.lit(SALTS)).cast("int")})
    groups = rows.where("__size IS NOT NULL").groupBy("__size", "__salt").count().collect()  # at most capacity x SALTS rows
    counts = np.zeros((capacity + 1, SALTS), np.int64)
    for r in groups:
        counts[r["__size"], r["__salt"]] = r["count"]
    totals = counts.sum(1)
    table = slots(plan({s: int(totals[s]) for s in np.flatnonzero(totals).tolist()}, capacity))
    shared = spark.sparkContext.broadcast((counts.cumsum(1) - counts, table))

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, salt: pd.Series, number: pd.Series) -> pd.DataFrame:
        base, table = shared.value
        where = np.flatnonzero(size.notna().to_numpy())
        out = np.zeros((2, len(size)), np.int64)
        sizes = size.to_numpy()[where].astype(np.int64)
        order = np.argsort(sizes, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(order) else []:
            s, at = int(sizes[at[0]]), where[at]
            rank = base[s, salt.to_numpy()[at]] + number.to_numpy()[at] - 1
            first, sequence, each, offset = table[s]
            k = np.searchsorted(first, rank, "right") - 1
            inside = rank - first[k]
            out[:, at] = sequence[k] + inside // each[k], offset[k] + inside % each[k] * s
        valid = pd.Series(out[0], dtype="Int64"), pd.Series(out[1], dtype="Int64")
        return pd.DataFrame({n: v.where(size.notna().to_numpy()) for n, v in zip(("sequence_id", "offset"), valid, strict=True)})

    number = F.row_number().over(Window.partitionBy("__size", "__salt").orderBy("__row"))
    rows = rows.withColumn("__number", number).withColumn("__place", place("__size", "__salt", "__number"))
    return rows.select(*spare, "__place.sequence_id", "__place.offset")


def pieces(docs: DataFrame, vocabulary: str | None = None, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token ids of every text, end mark last, as pieces of at most ``capacity``: ``doc_id, piece, start, length, ids``.

    Only longer documents are cut; their first piece takes the remainder, all others are full.
    """
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        vocab = docs.sparkSession.sparkContext.broadcast(file.read())  # a fixed file of about 2 MB
    end = pack_ids([end_id])

    def run(batches):
        encoder = _encoder(vocab)
        for batch in batches:
            texts = [t or "" for t in batch[text]]
            for a, b in chunks(texts):
                out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
                for doc_id, ids in zip(batch["doc_id"][a:b], encoder.encode(texts[a:b]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        for name, value in (("doc_id", doc_id), ("piece", k), ("start", x), ("length", y - x), ("ids", ids[4 * x : 4 * y])):
                            out[name].append(value)
                yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", text), run, f"doc_id {kind}, piece int, start long, length long, ids binary")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(vocab) -> Encoder:
    """One encoder per worker process; a worker that is used again keeps its words."""
    claim("packing", _ENCODERS.clear)
    key = hash(vocab.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Bpe(vocab.value))
    return _ENCODERS[key]
