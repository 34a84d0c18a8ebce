"""Left joins from events to reference tables that stay safe when a key is hot.

The reference side is broadcast only after its rows and bytes have been counted. A
larger side is joined by shuffle on (key, salt): event rows draw a salt, the
reference rows are repeated once per salt, so one hot key is spread over
``SALTS`` tasks. That join is always by shuffle: Spark's estimate does not see that the rows are repeated, nor how
far text that repeats grows in memory, so left alone it would broadcast a side that does not fit the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import field

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 16
KEYLESS_SALTS = 1024


def measured(side: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES, *more: Column):
    """(True when the static frame ``side`` is small in rows and bytes, the aggregates ``more`` over it); one job.

    Reading stops at the row limit, so ``more`` covers all rows of a small side only.
    """
    width = F.lit(16 * len(side.columns))
    for c, t in side.dtypes:
        if t == "string":
            width = width + F.coalesce(F.octet_length(field(c)), F.lit(0))
        elif t.startswith(("array<", "map<", "struct<")):
            width = width + F.coalesce(F.octet_length(F.to_json(field(c))), F.lit(0))
    n, total, *found = side.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(width.cast("bigint")), *more).first()
    return n <= rows and (total or 0) <= size, found


def fits_broadcast(side: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True when the static frame ``side`` is small in rows and bytes; counting stops at the row limit."""
    return measured(side, rows, size)[0]


def left_lookup(
    events: DataFrame,
    side: DataFrame,
    keys: list[str],
    extra: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``events`` LEFT JOIN ``side`` on equal ``keys`` and an optional further condition.

    ``side`` names its key columns ``r_<key>``. Every event is kept. ``salts=1`` repeats nothing, for keys that are
    about as many as the events.
    """
    equal = [field(k) == field(f"r_{k}") for k in keys]
    residual = [extra] if extra is not None else []
    drop = [f"r_{k}" for k in keys]
    if fits_broadcast(side, broadcast_rows):
        return events.join(F.broadcast(side), equal + residual, "left").drop(*drop)
    row = F.xxhash64(*[field(c) for c, t in events.dtypes if "map<" not in t and "variant" not in t])
    # rows without key match nothing; their salt spreads them too
    keyless = reduce(lambda a, b: a | b, [field(k).isNull() for k in keys])
    salt = F.when(keyless, F.pmod(row, F.lit(KEYLESS_SALTS))).otherwise(F.pmod(row, F.lit(salts)))
    salted = events.withColumn("_salt", salt.cast("int"))
    repeated = side.withColumn("r__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    condition = equal + [field("_salt") == field("r__salt")] + residual
    return salted.join(repeated.hint("merge"), condition, "left").drop("_salt", "r__salt", *drop)
