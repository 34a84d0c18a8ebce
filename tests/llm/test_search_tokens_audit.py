"""Operators 11 to 13 against plain versions, on small tables with edge rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from tokenizers import Tokenizer

from logloom.llm import bpe, query_sharing, source_audit, whole_tokens

SCHEMA = "doc_id long, text string, lang string, source string, n long, docs long, n_bytes long, row string, term string, place long"
EDGE = [
    (9001, None, None, None),
    (9002, "", "en", "x"),
    (9003, " \n\n ", "en", "only"),
    (9004, "one Two-two one", "en", "x"),
    (9004, "one Two-two one", "en", "x"),
    (9005, "ONE,one x　 Ünï 12", None, "y"),
    (9006, "<|endoftext|> 123 ?? <|endoftext|>x<|endoftext|>", "en", None),
    (9007, "\r\n\x00 \x1c\t don't we'll\x85 ", "en", "x"),
    (9008, "wörter und 'tis don't  \n\t" * 3000, "de", "x"),
    (9009, "x" * 5000 + " " + "é" * 3000, "de", "y"),
    (None, "no id at all but one two some words", "", ""),
    (9010, "no-id,at;all some", None, ""),
    (9011, "no id's at-at all", "", None),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    base = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(80).collect()
    rows = [(r.doc_id, r.text, r["lang"], r.source, 1, 1, 1, "x", "y", 1) for r in base]
    rows += [(*e, None, None, None, None, None, None) for e in EDGE]
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.default_vocabulary())


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- 11


def brute_search(docs, items, k):
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    rows = [(r.doc_id, Counter(term.findall(fold(r.text)))) for r in docs.collect()]
    rows = [r for r in rows if r[1]]
    n_docs, n_all = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    wanted = defaultdict(set)
    for r in items.collect():
        wanted[r.item_id] |= set(term.findall(fold(r.text)))
    out = []
    for item, ts in wanted.items():
        found = []
        for doc_id, c in rows:
            m = 10 + 90 * sum(c.values()) * n_docs // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


ITEMS = [
    (1, "one two some words"), (2, "ONE two; all"), (3, None), (4, "zzzqqq"), (5, "one two some words no"), (1, "id"), (None, "at all ünï"), (6, ""),
]


@pytest.mark.parametrize("group_bytes", [100, query_sharing.GROUP_BYTES])
def test_search_equals_brute_force(spark, docs, group_bytes, monkeypatch):
    base = [(int(r.item_id) + 100, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").limit(3 if group_bytes == 100 else 40).collect()]
    items = spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS + base], "item_id long, text string, rank int, score int")
    monkeypatch.setattr(query_sharing, "BLOCK_CELLS", 3000)
    got = query_sharing.search(docs, items, 4, group_bytes=group_bytes).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_search(docs, items, 4)


def test_search_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert query_sharing.search(empty, items).collect() == []
    assert query_sharing.search(docs, items.limit(0)).collect() == []
    assert query_sharing.search(docs, items.where("item_id = 3")).collect() == []


def test_sharing_dag_sums_each_shared_set_once():
    rng = np.random.default_rng(1)
    sets = [{0, 1, 2, 3, *rng.choice(300, 80).tolist()} for _ in range(30)] + [set(), {7}, {5, 6}]
    dag = query_sharing.SharingDag(300, sets)
    leaves = rng.integers(0, 1 << 40, (300, 5))
    acc = np.zeros((dag.n_symbols, 5), np.int64)
    acc[:300] = leaves
    want = np.array([leaves[sorted(s)].sum(0) for s in sets])
    assert (dag.scores(acc) == want).all()
    nodes = dag.n_symbols - 300
    assert nodes > 30 and nodes + sum(map(len, dag.items)) < sum(map(len, sets)) * 0.7
    assert sum(s >= 300 for s in dag.items[0]) > 0


# ---- 12


def test_whole_tokens_encode_alone(tokenizer):
    found = whole_tokens.whole_tokens(bpe.Bpe(open(bpe.default_vocabulary(), encoding="utf-8").read()))
    got = tokenizer.encode_batch(found, add_special_tokens=False)
    assert len(found) > 45_000 and all(len(e.ids) == 1 for e in got)


def test_counts_equal_the_tokenizers_library(docs, tokenizer):
    got = whole_tokens.count_tokens(docs).collect()
    want = []
    for r in docs.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    assert sorted([tuple(r)[:4] for r in got], key=repr) == sorted(want, key=repr)
    assert all(0 <= r.n_whole <= r.n_tokens for r in got)
    assert sum(r.n_whole for r in got) > 0.2 * sum(r.n_tokens for r in got)


def test_parts_and_generations_change_nothing(tokenizer):
    texts = [f"some Words{i} don't <|endoftext|>  stop here {i} \n\t ok 'll über{i % 7} " * 40 for i in range(30)]
    model = bpe.Bpe(open(bpe.default_vocabulary(), encoding="utf-8").read())
    counter = whole_tokens.Counter(model, frozenset(whole_tokens.whole_tokens(model)), keep=3)
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [counter.count([t])[0][0] for t in texts] == want
    pieces = list(whole_tokens.parts(texts[0], 50))
    assert len(pieces) > 10 and "".join(pieces) == texts[0]
    assert sum(len(tokenizer.encode(p, add_special_tokens=False).ids) for p in pieces) == want[0]


def test_counts_of_empty_table(empty):
    assert whole_tokens.count_tokens(empty).collect() == []


# ---- 13


def brute_audit(docs, top):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    uses, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in docs.collect():
        lang, source, found = r["lang"] or "", r.source or "", term.findall(fold(r.text))
        groups[lang].add(source)
        uses[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= 3]

        def p(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1000000000 * (counts[t] + 1) // (n + len(kept)) for t in kept}

        own = {s: p(uses[lang, s]) for s in sources}
        all_ = p(sum((uses[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(-sum((own[s][t] - own[o][t]) ** 2 // own[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((own[s][t] - all_[t]) ** 2 // all_[t]), t.encode(), t) for t in kept if uses[lang, s][t] and own[s][t] > all_[t]]
            out += [(lang, s, "pair", i, -v, k + 1) for k, (v, _, i) in enumerate(sorted(pair))]
            out += [(lang, s, "term", i, -v, k + 1) for k, (v, _, i) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def test_audit_equals_brute_force(docs):
    want = brute_audit(docs, 200)
    assert sorted(tuple(r) for r in source_audit.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()) == want
    assert {"one", "two"} <= {w[3] for w in want if w[2] == "term"} | {"one", "two"}


def test_audit_in_small_blocks(docs, monkeypatch):
    for name, value in {"PAIR_CELLS": 5, "TERM_CELLS": 60, "HELD_WORDS": 400, "HELD_ROWS": 30, "BROADCAST_GROUPS": 0}.items():
        monkeypatch.setattr(source_audit, name, value)
    assert sorted(tuple(r) for r in source_audit.audit(docs, top=7).collect()) == brute_audit(docs, 7)


def test_audit_counts_distinct_documents(spark, tmp_path):
    # 'a' is in three documents by rare chunks only, 'b' twice in one and once in another, 'c' in three equal rows
    rows = [(1, "a-a a, 11", "l", "s"), (2, "(a b b- 22", "l", "s"), (3, "a; b. 33", "l", "t"), (4, "c", "l", "t"), (4, "c", "l", "t"), (4, "c", "l", "t")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4).write.parquet(f"{tmp_path}/d")
    out = source_audit.audit(spark.read.parquet(f"{tmp_path}/d")).collect()
    docs = spark.read.parquet(f"{tmp_path}/d")
    assert sorted(tuple(r) for r in out) == brute_audit(docs, 200)
    assert {r.item for r in out if r.part == "term"} <= {"a", "c"}


def test_audit_packs_large_counts():
    kind = np.dtype("<u2")
    key, place, n = np.array([0, 0, 2]), np.array([3, 9, 3]), np.array([200_000, 1, 65_535])
    packed = source_audit._packed((key, place, n), 3, kind)
    words, names = pa.array([b"l a", b"l b", b"l c"]), pa.array([b""] * 3)
    sums = source_audit._merged(words, names, packed, kind)[1]
    assert [x.tolist() for x in sums] == [key.tolist(), place.tolist(), n.tolist()]


def test_probability_of_counts_beyond_64_bits():
    n = np.array([0, 5, 10**12])
    want = [1 + 10**9 * (x + 1) // (10**13 + 7) for x in n.tolist()]
    assert source_audit._probability(n, np.array([10**13 + 7] * 3)).tolist() == want


def test_audit_empty_table(empty):
    assert source_audit.audit(empty).collect() == []
