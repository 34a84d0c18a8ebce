"""N-gram Jaccard join by MinHash banding.

Texts with the same set of word n-grams are one class. A class's MinHash signature is cut into bands; classes that
agree in a band are candidates. Candidate groups are split into blocks of bounded size. Each block is checked on full
n-gram sets in one task, which labels its connected classes; then each pair of blocks, which puts out links between
labels only: one edge at most for two labels, never the pairs. So the edges that are left for the whole group grow with
its labels, not with its pairs of texts. Only texts of candidate groups leave their partition.

Words are runs of characters other than ASCII white space, in lower case. Defined cases: a text of fewer than
``n`` words has one n-gram, all its words; a null text or one without words has none and links to nothing; a null
doc_id is replaced by a hash of the text; rows that share a doc_id count as one document if their texts are alike, and
each text is looked at where they are not; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import claim, map_rows, saved
from logloom.llm.components import components
from logloom.llm.order_minhash import GOLD, MOST, U, _mix
from logloom.operators.lookup import fits_broadcast

N, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.9999, 8
#: A block holds at most about so many classes and n-grams. A text of a group of b blocks is read b times.
BLOCK_CLASSES, BLOCK_NGRAMS = 1000, 400_000
KEPT_WORDS = 200_000
COLUMNS = 4096


def bands_for(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands of ``rows`` values that find a pair at the threshold with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


_WORDS: dict[bytes, int] = {}


def ngrams(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > KEPT_WORDS:
        _WORDS.clear()
    found = list(map(_WORDS.get, words))
    if None in found:
        for w in {w for w, h in zip(words, found, strict=True) if h is None}:
            _WORDS[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        found = list(map(_WORDS.__getitem__, words))
    h = np.array(found, np.uint64)
    n = min(n, len(h))
    m = len(h) - n + 1
    out = np.full(m, U(n))
    for k in range(n):
        out = _mix(out * GOLD + h[k : k + m])
    return np.unique(out)


def signature(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    best = np.full(len(factors), MOST)
    for a in range(0, len(grams), 2048):
        np.minimum(best, (factors[:, None] * grams[a : a + 2048]).min(1), out=best)
    return best


def signatures(docs: DataFrame, text: str, n: int, rows: int, bands: int) -> DataFrame:
    """``uid, text_hash, k1, k2, size, bands``: a class key of 128 bits and the band hashes."""
    factors = _mix(np.arange(1, rows * bands + 1, dtype=np.uint64) * GOLD) | U(1)

    def run(batches):
        claim("ngrams", _WORDS.clear)
        for batch in batches:
            out = {"uid": batch["uid"], "text_hash": batch["text_hash"], "k1": [], "k2": [], "size": [], "bands": []}
            for t in batch["text"]:
                grams = ngrams(t or "", n)
                key = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                sig = signature(grams, factors).reshape(bands, rows)
                h = np.arange(1, bands + 1, dtype=np.uint64)
                for k in range(rows):
                    h = _mix(h * GOLD + sig[:, k])
                out["k1"].append(int.from_bytes(key[:8], "little", signed=True))
                out["k2"].append(int.from_bytes(key[8:], "little", signed=True))
                out["size"].append(len(grams))
                out["bands"].append(h.astype(np.int64).tolist() if len(grams) else [])
            yield out

    return map_rows(_rows(docs, text), run, "uid long, text_hash long, k1 long, k2 long, size int, bands array<long>")


def _rows(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("uid"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))


def linked(grams: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the n-gram sets are at the threshold or above, as a symmetric matrix."""
    g = len(grams)
    size = np.array([len(x) for x in grams], np.int64)
    values, owner = np.concatenate(grams), np.repeat(np.arange(g), size)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.concatenate([[False], values[1:] != values[:-1]]))
    shared = np.bincount(column)[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    both = np.zeros((g, g), np.float32)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + COLUMNS, COLUMNS))
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            part = np.zeros((g, int(column[b - 1] - column[a]) + 1), np.float32)
            part[owner[a:b], column[a:b] - column[a]] = 1
            both += part @ part.T
    common = both.astype(np.int64)
    link = common >= threshold * (size[:, None] + size - common) - 1e-9
    np.fill_diagonal(link, False)
    return link


def labels_of(ids: list[int], link: np.ndarray) -> list[int]:
    """For each member the smallest id that it is linked to inside the block."""
    found: list[int | None] = [None] * len(ids)
    for root in sorted(range(len(ids)), key=ids.__getitem__):
        queue = [root] if found[root] is None else []
        while queue:
            i = queue.pop()
            if found[i] is None:
                found[i] = ids[root]
                queue += [j for j in np.flatnonzero(link[i]).tolist() if found[j] is None]
    return found


def label_edges(labels: list[int], link: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between labels."""
    names = np.array(labels)
    a, b = np.nonzero(np.triu(link))
    pairs = np.unique(np.sort(np.column_stack([names[a], names[b]]), 1), axis=0)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    edges = []
    for x, y in pairs.tolist():
        u, v = find(x), find(y)
        if u != v:
            root[max(u, v)] = min(u, v)
            edges.append((x, y))
    return edges


def _units(rows: DataFrame, keys: list[str], check, schema: str) -> DataFrame:
    """``check`` on the rows (rep, label, block, text) of each unit of ``keys``, one after the other."""
    rows = rows.select(*keys, "rep", "label", "block", "text").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        claim("ngrams", _WORDS.clear)
        held, now = [], None
        for batch in batches:
            for row in zip(*(batch[c] for c in (*keys, "rep", "label", "block", "text")), strict=True):
                if row[: len(keys)] != now:
                    if len(held) > 1:
                        yield check(*map(list, zip(*held, strict=True)))
                    held, now = [], row[: len(keys)]
                held.append(row[len(keys) :])
        if len(held) > 1:
            yield check(*map(list, zip(*held, strict=True)))

    return map_rows(rows, run, schema)


def star_edges(near: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect what the rows (rep, center) connect.

    Each rep has one edge, to its smallest center, and that center has one to each other center of its reps. So a group has about as
    many edges as classes, not as many as classes times bands.
    """
    stars = saved(near.groupBy("rep").agg(F.min("center").alias("b"), F.collect_set("center").alias("centers")), "stars")
    hubs = stars.select(F.explode("centers").alias("a"), "b").where("a != b").distinct()
    return stars.select(F.col("rep").alias("a"), "b").unionByName(hubs)


def near_classes(
    docs: DataFrame, text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, counts: bool = True
) -> DataFrame:
    """``uid, text_hash, class_id, n_links`` for every row.

    ``class_id``: the smallest uid that the text is linked to directly or through others; ``n_links``: texts
    with other n-gram sets at the threshold or above (null without ``counts``).
    """
    bands = bands_for(threshold, ROWS, recall)
    rows = saved(signatures(docs, text, n, ROWS, bands), "signatures")
    key = ["k1", "k2"]
    classes = rows.groupBy(*key).agg(F.min(F.struct("uid", "text_hash")).alias("r"), F.max("size").alias("size"), F.first("bands").alias("bands"))
    classes = saved(classes.select(*key, F.col("r.uid").alias("rep"), F.col("r.text_hash").alias("rep_hash"), "size", "bands"), "classes")

    buckets = classes.select("rep", F.posexplode("bands").alias("band", "h"))
    centers = buckets.groupBy("band", "h").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where("center < last").drop("last")
    near = buckets.join(saved(centers, "centers"), ["band", "h"]).where("rep != center")
    groups = components(star_edges(near))

    members = saved(classes.join(groups.select(F.col("id").alias("rep"), F.col("label").alias("grp")), "rep").select("rep", "rep_hash", "size", "grp"), "members")
    totals = members.groupBy("grp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("size") / BLOCK_NGRAMS)).alias("blocks"))
    placed = members.join(saved(totals, "blocks"), "grp").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).drop("size")
    texts = _rows(docs, text).withColumnsRenamed({"uid": "rep", "text_hash": "rep_hash"})
    placed = F.broadcast(placed) if fits_broadcast(placed) else placed
    texts = saved(texts.join(placed, ["rep", "rep_hash"]).dropDuplicates(["rep", "rep_hash"]), "texts").withColumn("label", F.lit(None).cast("long"))

    def inside(rep, label, block, text):
        link = linked([ngrams(t, n) for t in text], threshold)
        return {"rep": rep, "label": labels_of(rep, link), "n": link.sum(1).tolist()}

    def between(rep, label, block, text):
        link = linked([ngrams(t, n) for t in text], threshold)
        side = np.array(block)
        link &= side[:, None] != side
        edges = label_edges(label, link)
        some = [(i, c) for i, c in zip(rep, link.sum(1).tolist(), strict=True) if c] if counts else []
        pad, tail = [None] * len(edges), [None] * len(some)
        return {"rep": [i for i, _ in some] + pad, "n": [c for _, c in some] + pad, "a": tail + [a for a, _ in edges], "b": tail + [b for _, b in edges]}

    local = saved(_units(texts.withColumn("i", F.col("block")), ["grp", "i"], inside, "rep long, label long, n long"), "labels-in-blocks")
    # several texts of one id are one node: its least label, with an edge to its other ones
    nodes = saved(local.groupBy("rep").agg(F.min("label").alias("label"), F.sum("n").alias("n")), "nodes")
    same = local.withColumnRenamed("label", "b").join(nodes.select("rep", F.col("label").alias("a")), "rep").where("a <> b").select("a", "b")
    many = texts.where("blocks > 1").drop("label").join(nodes.select("rep", "label"), "rep", "left")
    many = many.withColumn("label", F.coalesce("label", "rep"))
    other = F.expr("filter(sequence(0L, blocks - 1), k -> k <> block)")
    pairs = F.transform(other, lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    many = many.select("*", F.inline(pairs))
    found = saved(_units(many.withColumn("block", F.col("block").cast("long")), ["grp", "i", "j"], between, "rep long, n long, a long, b long"), "links")
    links = nodes.select("rep", "n").unionByName(found.where("rep IS NOT NULL").select("rep", "n")).groupBy("rep").agg(F.sum("n").alias("n_links"))
    merged = components(found.where("a IS NOT NULL").select("a", "b").unionByName(same))
    labels = nodes.select("rep", "label").join(merged.select(F.col("id").alias("label"), F.col("label").alias("top")), "label", "left")
    # a class alone in its block has no label of its own
    labels = labels.select("rep", F.coalesce("top", "label").alias("label"))
    alone = merged.select(F.col("id").alias("rep"), "label").join(nodes.select("rep"), "rep", "left_anti")
    labels = labels.unionByName(alone)
    named = classes.select(*key, "rep").join(links, "rep", "left").join(labels, "rep", "left")
    total = F.coalesce("n_links", F.lit(0)) if counts else F.lit(None).cast("long")
    named = saved(named.select(*key, F.coalesce("label", "rep").alias("class_id"), total.alias("n_links")), "named")
    # texts without words share a key but are no class
    own = F.when(F.col("size") == 0, F.col("uid")).otherwise(F.col("class_id"))
    return rows.select("uid", "text_hash", "size", *key).join(named, key).select("uid", "text_hash", own.alias("class_id"), "n_links")


def keep_one(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without near duplicates: of each class the document with the smallest doc_id stays, once."""
    extra = near_classes(docs, text, counts=False, **options).where("uid != class_id").select("uid", "text_hash").distinct()
    rows = docs.withColumns({"uid__": F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)), "hash__": F.xxhash64(text)})
    extra = extra.withColumnsRenamed({"uid": "uid__", "text_hash": "hash__"})
    return rows.join(extra, ["uid__", "hash__"], "left_anti").dropDuplicates(["uid__", "hash__"]).drop("uid__", "hash__")
