"""Ranked lexical search of many queries at once, with their common term sets evaluated once.

Mining: pairs of terms (or of sets found before) that several items share become a node of a DAG, the most shared
first, until no pair is shared. A node's accumulator is the sum of its two inputs, an item's score the sum of what
it has left. Documents are read twice: for their postings of query terms, written once to the shared folder, and, when
the collection's statistics are known, in blocks of documents in which every node's accumulators are made once and all
items combine them. A block yields only what can still be among the best, so no document-item pairs are shuffled.

Items are worked on in groups of bounded text; what is sent to the tasks is bounded by that, not by the documents.

Defined cases: a null or empty text has no terms; an item without terms, or whose terms no document holds, has no
rows; rows of one item_id (null is one too) are one item; repeated documents are ranked each; among equal scores a null
doc_id comes last; an empty table gives no rows; other columns are ignored. ``doc_id`` is an integer.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import chunks, map_rows, saved

BEST = 10
#: Bytes of item terms that are mined and sent to the tasks at a time. More items take more rounds over the documents.
GROUP_BYTES = 4 << 20
#: Terms of an item that are mined together; a longer item is the sum of its parts.
PART_TERMS = 64
#: Accumulators of one block of documents.
BLOCK_CELLS = 4_000_000
#: The best of an item are found in so many groups of documents first.
SPREAD = 64
#: Letters and digits stay, A-Z become small, other ASCII characters separate terms.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of any character beyond ASCII."""
    return text.translate(_FOLD).split()


class SharingDag:
    """Items as sums over a DAG. Symbols below ``n_terms`` are terms, the others nodes with two inputs.

    ``levels``: for each depth the first node and the inputs of its nodes. ``items``: the symbols of each item.
    """

    def __init__(self, n_terms: int, items: list[set[int]]):
        self.n_terms = n_terms
        used = Counter(chain.from_iterable(items))
        parts: list[set[int]] = []
        owner: list[int] = []
        for i, item in enumerate(items):
            ordered = sorted(item, key=lambda t: (-used[t], t))  # shared terms together
            for at in range(0, len(ordered), PART_TERMS):
                parts.append(set(ordered[at : at + PART_TERMS]))
                owner.append(i)
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        n = n_terms
        while pairs := self._shared_pairs(parts):
            partner = {a: (b, n + k) for k, (a, b) in enumerate(pairs)}
            for part in parts:
                for a in [a for a in part if a in partner and partner[a][0] in part]:
                    b, node = partner[a]
                    part -= {a, b}
                    part.add(node)
            self.levels.append((n, *np.array(pairs, np.int64).T))
            n += len(pairs)
        self.n_symbols = n
        self.items: list[np.ndarray] = [np.empty(0, np.int64)] * len(items)
        for i, part in zip(owner, parts, strict=True):
            self.items[i] = np.append(self.items[i], np.array(sorted(part), np.int64))

    @staticmethod
    def _shared_pairs(parts: list[set[int]]) -> list[tuple[int, int]]:
        """Pairs of symbols that at least two parts share, the most shared first; no symbol is in two of them."""
        used = Counter(chain.from_iterable(parts))
        keys = []
        for part in parts:
            some = np.array(sorted(s for s in part if used[s] > 1), np.int64)
            a, b = np.triu_indices(len(some), 1)
            keys.append(some[a] << 32 | some[b])
        pairs, shared = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
        pairs, shared = pairs[shared > 1], shared[shared > 1]
        taken: set[int] = set()
        found = []
        for key in pairs[np.argsort(-shared, kind="stable")].tolist():
            a, b = key >> 32, key & 0xFFFFFFFF
            if a not in taken and b not in taken:
                taken |= {a, b}
                found.append((a, b))
        return found

    def scores(self, acc: np.ndarray) -> np.ndarray:
        """(items, documents) from (symbols, documents), where the terms are filled in. Each node is summed once."""
        for first, a, b in self.levels:
            np.add(acc[a], acc[b], out=acc[first : first + len(a)])
        return np.array([acc[symbols].sum(0) for symbols in self.items])


class _Best:
    """The best rows of each item so far: score descending, then doc_id ascending, null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.ones(n_items, np.int64)
        self.rows = tuple(np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.floor[:, None])
        if not len(item):
            return
        new = (item, scores[item, doc], missing[doc], ids[doc])
        rows = tuple(np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        item = rows[0][order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.k
        self.rows = tuple(x[order[kept]] for x in rows)
        last = rank[kept] == self.k - 1
        self.floor[self.rows[0][last]] = self.rows[1][last]


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [(i, t) for i, raw in zip(batch["item_id"], batch["raw"], strict=True) for t in set(terms(raw or b""))]
            yield {"item_id": [i for i, _ in found], "term": [t for _, t in found]}

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("raw"))
    return map_rows(rows, run, f"item_id {kind}, term binary").distinct()


def postings(docs: DataFrame, vocabulary, text: str = "text") -> DataFrame:
    """``doc_id, n, ids, tfs`` of documents with a term: all terms counted, and the numbers and counts of those in ``vocabulary``."""

    def run(batches):
        number = {t: i for i, t in enumerate(vocabulary.value)}
        size = max(1, len(number))
        for batch in batches:
            texts = [t or b"" for t in batch["raw"]]
            for a, b in chunks(texts):
                found = [terms(t) for t in texts[a:b]]
                n = np.array([len(f) for f in found], np.int64)
                ids = np.fromiter(map(number.get, chain.from_iterable(found), repeat(-1)), np.int64, int(n.sum()))
                row = np.repeat(np.arange(b - a), n)[ids >= 0]
                key, tf = np.unique(row * size + ids[ids >= 0], return_counts=True)
                cuts = np.searchsorted(key, np.arange(b - a + 1) * size)
                ids, tf = (key % size).astype("<i4"), tf.astype("<i4")
                some = np.flatnonzero(n).tolist()
                yield {
                    "doc_id": [batch["doc_id"][a + i] for i in some],
                    "n": n[some].tolist(),
                    "ids": [ids[cuts[i] : cuts[i + 1]].tobytes() for i in some],
                    "tfs": [tf[cuts[i] : cuts[i + 1]].tobytes() for i in some],
                }

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw"))
    return map_rows(rows, run, "doc_id long, n long, ids binary, tfs binary")


def _frequencies(rows: DataFrame, n_terms: int) -> dict[int, int]:
    """Documents that hold each term; counted in the tasks, at most one row a term and task is shuffled."""

    def run(batches):
        seen = np.zeros(n_terms, np.int64)
        for batch in batches:
            for a, b in chunks(batch["ids"]):
                seen += np.bincount(np.frombuffer(b"".join(batch["ids"][a:b]), "<i4"), minlength=n_terms)
        some = np.flatnonzero(seen)
        yield {"term": some.tolist(), "df": seen[some].tolist()}

    return {r.term: r.df for r in map_rows(rows.select("ids"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}


def _ranked(rows: DataFrame, plan, n_docs: int, n_all: int, k: int) -> DataFrame:
    """``item, doc_id, score``: the best of each item in each task."""

    def run(batches: Iterator[pa.RecordBatch]):
        dag, weight = plan.value
        best = _Best(len(dag.items), k)
        step = max(16, BLOCK_CELLS // dag.n_symbols)
        for batch in batches:
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            null = columns["doc_id"].is_null().to_numpy(zero_copy_only=False)
            doc = columns["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            raw_ids, raw_tfs, sizes = (columns[c].to_pylist() for c in ("ids", "tfs", "n"))
            for a in range(0, len(doc), step):
                b = min(a + step, len(doc))
                ids, tf = (np.frombuffer(b"".join(x[a:b]), "<i4") for x in (raw_ids, raw_tfs))
                at = np.repeat(np.arange(b - a), [len(x) // 4 for x in raw_ids[a:b]])
                tf = tf.astype(np.int64)
                length = np.array([100 - 90 + 90 * n * n_docs // n_all for n in sizes[a:b]], np.int64)
                acc = np.zeros((dag.n_symbols, b - a), np.int64)
                acc[ids, at] = weight[ids] * (1_000_000_000 * tf // (1000 * tf + 8 * length[at]))
                best.add(dag.scores(acc), doc[a:b], null[a:b])
        item, score, null, ids = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null), pa.array(score)], names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def _best_of(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = BEST, text: str = "text", item_id: str = "item_id", item_text: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0.

    A term weighs floor(1000 ln((2N+2)/(2df+1))); all else is integer arithmetic, so scores are exact.
    """
    spark = docs.sparkSession
    wanted = saved(_item_terms(items, item_id, item_text), "item-terms")
    total = wanted.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    kind = f"item long, item_id {wanted.schema['item_id'].dataType.simpleString()}"
    out = spark.createDataFrame([], f"{kind}, rank int, doc_id long, score long").drop("item")
    for g in range(groups):
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect()  # about group_bytes
        if not rows:
            continue
        vocabulary = sorted({r.term for r in rows})
        number = {t: i for i, t in enumerate(vocabulary)}
        sets: dict = {}
        for r in rows:
            sets.setdefault(r.item_id, set()).add(number[r.term])
        names = list(sets)
        found = _search_group(docs, vocabulary, [sets[i] for i in names], k, text)
        named = spark.createDataFrame(list(enumerate(names)), kind)
        found = found.join(F.broadcast(named), "item")  # the items of this group only
        out = out.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return out


def _search_group(docs: DataFrame, vocabulary: list[bytes], items: list[set[int]], k: int, text: str) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    rows = saved(postings(docs, sc.broadcast(vocabulary), text), "postings")
    n_docs, n_all = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = _frequencies(rows, len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))]
    plan = sc.broadcast((SharingDag(len(vocabulary), items), np.array(weight, np.int64)))
    best = _ranked(rows, plan, n_docs, n_all or 1, k)
    best = _best_of(best.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD))), k, "item", "_part")
    return _best_of(best.drop("rank"), k, "item").select("item", "rank", "doc_id", "score")
