"""Order MinHash fingerprints.

The k-mers of a text are numbered by occurrence, so repeats differ. Each of ``SLOTS`` orders picks the smallest
``PICK`` of them; they are put back into text order and hashed as a tuple. Two fingerprints agree in a slot only if
the same k-mers were picked in the same order, so the likeness falls with moved text as well as with changed text.

Defined cases: a null text is empty; an empty text has a fingerprint of its own that only empty texts share; a text
shorter than a k-mer is one k-mer; ``next`` follows descending doc_id, a null id last, equal ids by text; the row after
the last is the first, of a single row itself; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bpe import code_points
from logloom.llm.common import map_rows

K, PICK, SLOTS = 6, 2, 32
BLOCK = 4096
U = np.uint64
GOLD, MIX1, MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX1
    x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


#: One odd factor an order.
FACTORS = _mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * GOLD) | U(1)
MOST = U(0xFFFFFFFFFFFFFFFF)


def kmers(codes: np.ndarray) -> np.ndarray:
    """Hashes of the occurrence-numbered k-mers, in text order."""
    n = len(codes) - K + 1
    if n < 1:
        n = min(len(codes), 1)
        h = np.full(n, U(len(codes)))
        for c in codes.astype(np.uint64):
            h = _mix(h * GOLD + c)
        return h
    h = np.zeros(n, np.uint64)
    for k in range(K):
        h *= GOLD
        h += codes[k : k + n]
    h = _mix(h)
    bits = U(max(n - 1, 1).bit_length())
    place = (U(1) << bits) - U(1)
    order = (h & ~place) | np.arange(n, dtype=np.uint64)
    order.sort()
    kind = order >> bits
    first = np.zeros(n, np.int64)
    new = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    first[new] = new
    number = np.arange(n) - np.maximum.accumulate(first)
    again = np.flatnonzero(number)
    if len(again):
        at = (order[again] & place).astype(np.int64)
        h[at] = _mix(h[at] + number[again].astype(np.uint64) * GOLD)
    return h


def smallest(h: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every order the ranks, positions and hashes of its smallest ``PICK`` k-mers."""
    best = [np.full((SLOTS, PICK), MOST), np.full((SLOTS, PICK), np.iinfo(np.int64).max), np.zeros((SLOTS, PICK), np.uint64)]
    rows = np.arange(SLOTS)
    for a in range(0, len(h), BLOCK):
        part = h[a : a + BLOCK]
        rank = FACTORS[:, None] * part
        for _ in range(min(PICK, len(part))):
            at = rank.argmin(1)
            best = merge(best, [rank[rows, at][:, None], (at + a + start)[:, None], part[at][:, None]])
            rank[rows, at] = MOST
    return tuple(best)


def merge(x, y):
    rank, place, h = (np.concatenate([p, q], 1) for p, q in zip(x, y, strict=True))
    pick = np.lexsort((place, rank), axis=1)[:, :PICK]
    return [np.take_along_axis(v, pick, 1) for v in (rank, place, h)]


def signature(best) -> np.ndarray:
    """One 32-bit hash an order: its picked k-mers in text order."""
    _, place, h = best
    h = np.take_along_axis(h, np.argsort(place, 1, kind="stable"), 1)
    out = np.full(SLOTS, GOLD)
    for k in range(PICK):
        out = _mix(out * GOLD + h[:, k])
    return (out >> U(32)).astype(np.uint32)


def text_of(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def fingerprint(text: str) -> str:
    return text_of(signature(smallest(kmers(code_points(text)))))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def both(text: str, edited: str, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a text and of its edited form, which starts with the same ``keep`` characters."""
    own, other = kmers(code_points(text)), kmers(code_points(edited))
    same = min(keep - K + 1, len(own), len(other)) if min(len(text), len(edited)) >= K else 0
    same = max(same, 0)
    start = smallest(own[:same])
    return signature(merge(start, smallest(own[same:], same))), signature(merge(start, smallest(other[same:], same)))


def with_next(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (bucket, donor, doc_id, text), dealt and sorted so that the row after each row is its next document.

    Ids are dealt into ranges. The largest id of each range is copied to the range before it as its donor, so no
    range needs another one. Only the bounds (four a partition) reach the driver.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(1 << 63)
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    marks = [k / (4 * parts) for k in range(1, 4 * parts)]
    bounds = np.unique(np.array(rows.agg(F.percentile_approx("key", marks, 10 * len(marks) + 1000)).first()[0] or [], np.int64))

    @F.pandas_udf("long")
    def bucket(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(np.int64)))

    heads = rows.select("key").withColumn("bucket", bucket("key")).groupBy("bucket").agg(F.max("key").alias("head")).collect()
    heads = sorted((r.bucket, r["head"]) for r in heads)
    to = {head: heads[(i + 1) % len(heads)][0] for i, (_, head) in enumerate(heads)}
    keys, goals = np.array(sorted(to), np.int64), np.array([to[k] for k in sorted(to)], np.int64)

    @F.pandas_udf("array<struct<bucket: bigint, donor: boolean>>")
    def places(key: pd.Series) -> pd.Series:
        k = key.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
        own = np.searchsorted(bounds, k).tolist()
        goal = np.where(keys[at] == k, goals[at], -1).tolist()
        return pd.Series([[{"bucket": b, "donor": False}] + ([{"bucket": g, "donor": True}] if g >= 0 else []) for b, g in zip(own, goal, strict=True)])

    dealt = rows.select("doc_id", "key", "text", F.explode(places("key")).alias("at")).select("at.bucket", "at.donor", "doc_id", "key", "text")
    # ranges hold like numbers of rows; neighbours go to one partition
    dealt = dealt.repartitionById(parts, (F.col("bucket") * parts / (len(bounds) + 1)).cast("int")).sortWithinPartitions("bucket", "donor", F.desc("key"), "text")
    return dealt.select("bucket", "donor", "doc_id", "text")


def edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``.

    ``edited``: the last third of the text replaced by as many first characters of the next document.
    """

    def run(batches):
        held = None  # the row that waits for its next one
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
            for row in zip(batch["bucket"], batch["donor"], batch["doc_id"], batch["text"], strict=True):
                bucket, donor, _, following = row
                if held and held[0] == bucket:
                    _, _, doc_id, t = held
                    third = len(t) // 3
                    edited = t[: len(t) - third] + following[:third]
                    own, other = both(t, edited, len(t) - third)
                    out["doc_id"].append(doc_id)
                    out["n_chars"].append(len(t))
                    out["edited"].append(edited)
                    out["fingerprint"].append(own)
                    out["edited_fingerprint"].append(text_of(other))
                    out["near_edited"].append(likeness(own, other))
                    out["near_next"].append(following if donor else None)
                held = None if donor else row
            # the fingerprint of the next row is that of the following result, but for the last of a range or batch
            sigs = out["fingerprint"]
            for i, donor_text in enumerate(out["near_next"]):
                if donor_text is not None:
                    nxt = signature(smallest(kmers(code_points(donor_text))))
                elif i + 1 < len(sigs):
                    nxt = sigs[i + 1]
                else:
                    nxt = signature(smallest(kmers(code_points(held[3]))))
                out["near_next"][i] = likeness(sigs[i], nxt)
            out["fingerprint"] = [text_of(s) for s in sigs]
            if sigs:
                yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_rows(with_next(docs, text), run, schema)
