"""Language ID by a linear-chain conditional random field over words.

Every word scores each language by hashed affixes, byte trigrams and a lexicon; learned transitions link the labels
of neighbours, and forward-backward gives each word's posterior. The model is fitted on sequences switched between
languages, made of word runs from a bounded sample of labelled texts; the lexicon counts all labelled texts. The text's
language has the largest summed posterior, its score is the mean posterior.

Forward-backward is exact over joined texts: runs of words are reduced to transfer matrices side by side, then linked.

Defined cases: ``und`` with score 0 for a null text or one without letters, and where nothing was learned; words without
letters take part in the chain but do not count; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import CHUNK_CHARS, chunks, claim, map_rows, saved
from logloom.llm.order_minhash import GOLD, U, _mix

#: Bounds of the fit: labelled texts a language, runs a text and words a run. All languages are learned.
SAMPLE_TEXTS, RUNS, RUN_WORDS = 400, 6, 32
#: Up to so many languages the sizes below hold; with more, steps get smaller and sequences more.
LANGUAGES = 100
#: A word enters the lexicon from this share of its language on: at most 50,000 a language.
LEXICON_SHARE = 2e-5
TABLE_BITS, AFFIXES = 17, (1, 2, 3, 4)
SEQUENCES, LENGTH, BATCH, EPOCHS, RATE, SEED = 1600, 48, 40, 2, 0.15, 7
KEPT_WORDS, KEPT_COUNTS = 200_000, 400_000
EPS = 1e-6
STRIP = ".,;:!?'\"()[]{}<>*#$%&|-_=+/\\«»„“”…"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def bare(word: str) -> str:
    return word.strip(STRIP).lower()


class Features:
    """Hashed features of many words at once, and their lexicon scores."""

    def __init__(self, lexicon: dict[str, np.ndarray], labels: int):
        self.lexicon, self.none = lexicon, np.zeros(labels, np.float32)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature ids, first feature of each word, lexicon scores. A word without letters has one empty feature (id 0)."""
        forms = [bare(w) for w in words]
        raw = [b"\x02" + f.encode("utf-8", "surrogatepass") + b"\x03" if f and any(map(str.isalpha, f)) else b"" for f in forms]
        size = np.array([len(r) for r in raw], np.int64)
        end = np.cumsum(size)
        start, n = end - size, int(end[-1]) if len(end) else 0
        b = np.frombuffer(b"".join(raw) + b"\0\0\0\0", np.uint8).astype(np.uint64)
        ids, owner = [], []
        if n:
            word = np.repeat(np.arange(len(words)), size)
            at = np.arange(n)
            whole = at + 3 <= end[word]
            ids.append(self._hash(U(9), b[:n] << U(16) | b[1 : n + 1] << U(8) | b[2 : n + 2])[whole])
            owner.append(word[whole])
            for k in AFFIXES:
                for kind, first in ((k, start + 1), (k + 20, end - 1 - k)):
                    has = np.flatnonzero(size >= k + 2)
                    code = np.zeros(len(has), np.uint64)
                    for j in range(k):
                        code = code << U(8) | b[first[has] + j]
                    ids.append(self._hash(U(kind), code))
                    owner.append(has)
        empty = np.flatnonzero(size == 0)
        ids.append(np.zeros(len(empty), np.int64))
        owner.append(empty)
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        first = np.searchsorted(owner[order], np.arange(len(words)))
        known = np.array([self.lexicon.get(f, self.none) for f in forms], np.float32).reshape(len(words), -1)
        return ids[order], first, known

    @staticmethod
    def _hash(kind: np.uint64, code: np.ndarray) -> np.ndarray:
        return (_mix(code * U(64) + kind) >> U(64 - TABLE_BITS)).astype(np.int64) | 1


class Crf:
    """Weights: hashed features (id 0 stays zero), lexicon, transitions, start."""

    def __init__(self, labels: list[str]):
        n = len(labels)
        self.labels = labels
        self.table = np.zeros((1 << TABLE_BITS, n), np.float32)
        self.lexicon = np.eye(n, dtype=np.float32) * 0.1
        self.move, self.start = np.eye(n, dtype=np.float32), np.zeros(n, np.float32)

    def emit(self, ids: np.ndarray, first: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.table[ids], first, 0) + known @ self.lexicon

    def posteriors(self, emit: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Posterior of every word of joined texts that start at ``begins``."""
        n, labels = emit.shape
        e = np.exp(emit - emit.max(1, keepdims=True)).astype(np.float64) + 1e-12
        move, prior = np.exp(self.move.astype(np.float64)), np.exp(self.start.astype(np.float64))
        steps = max(1, int(np.sqrt(n)), -(-n // max(1, 8_000_000 // labels**2)))  # bounds the matrices' memory
        blocks = -(-n // steps)
        reset = np.zeros(blocks * steps, bool)
        reset[begins] = True
        reset[n:] = True
        e = np.concatenate([e, np.ones((blocks * steps - n, labels))]).reshape(blocks, steps, labels)
        reset = reset.reshape(blocks, steps)
        whole = np.broadcast_to(np.eye(labels), (blocks, labels, labels))
        for t in range(steps):
            step = np.where(reset[:, t, None, None], whole.sum(2, keepdims=True) * prior, whole @ move) * e[:, t, None]
            whole = step / step.max((1, 2), keepdims=True)
        ahead, behind = np.ones((blocks, labels)), np.ones((blocks, labels))
        for k in range(1, blocks):
            x = ahead[k - 1] @ whole[k - 1]
            ahead[k] = x / x.sum()
            y = whole[blocks - k] @ behind[blocks - k]
            behind[blocks - k - 1] = y / y.sum()
        alpha = np.empty_like(e)
        x = ahead
        for t in range(steps):
            x = np.where(reset[:, t, None], x.sum(1, keepdims=True) * prior, x @ move) * e[:, t]
            x /= x.sum(1, keepdims=True)
            alpha[:, t] = x
        y = behind
        for t in range(steps - 1, -1, -1):
            alpha[:, t] *= y
            z = e[:, t] * y
            y = np.where(reset[:, t, None], (z @ prior)[:, None], z @ move.T)
            y /= y.sum(1, keepdims=True)
        out = alpha.reshape(-1, labels)[:n]
        return out / out.sum(1, keepdims=True)

    def fit(self, features: Features, sequences: list[list[str]], truth: list[list[int]]) -> None:
        """Gradient ascent (AdaGrad) on the log-likelihood of equally long label sequences."""
        sums = [np.full_like(w, 1e-6) for w in (self.table, self.lexicon, self.move, self.start)]
        rng = np.random.default_rng(SEED)
        encoded = [features(s) for s in sequences]
        for _ in range(EPOCHS):
            for some in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // BATCH)):
                first, ids, at = [], [], 0
                for i in some:
                    first.append(encoded[i][1] + at)
                    ids.append(encoded[i][0])
                    at += len(encoded[i][0])
                ids, first = np.concatenate(ids), np.concatenate(first)
                known = np.concatenate([encoded[i][2] for i in some])
                y = np.array([truth[i] for i in some])
                e = self.emit(ids, first, known).reshape(len(some), -1, len(self.labels)).astype(np.float64)
                grad, move, start = self._gradient(e, y)
                flat = grad.reshape(-1, len(self.labels)).astype(np.float32)
                size = np.diff(np.append(first, len(ids)))
                used, inverse = np.unique(ids, return_inverse=True)
                by_word = np.repeat(flat, size, 0)
                part = np.column_stack([np.bincount(inverse, by_word[:, k], len(used)) for k in range(flat.shape[1])]).astype(np.float32)
                part[used == 0] = 0
                sums[0][used] += part**2
                self.table[used] += RATE * part / np.sqrt(sums[0][used])
                for k, (w, g) in enumerate(((self.lexicon, known.T @ flat), (self.move, move), (self.start, start)), 1):
                    sums[k] += g**2
                    w += (RATE * g / np.sqrt(sums[k])).astype(np.float32)

    def _gradient(self, e: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, steps, labels = e.shape
        x = np.exp(e - e.max(2, keepdims=True))
        move, prior = np.exp(self.move.astype(np.float64)), np.exp(self.start.astype(np.float64))
        alpha, beta = np.empty_like(x), np.ones_like(x)
        for t in range(steps):
            a = x[:, t] * (prior if t == 0 else alpha[:, t - 1] @ move)
            alpha[:, t] = a / a.sum(1, keepdims=True)
        for t in range(steps - 2, -1, -1):
            b = (x[:, t + 1] * beta[:, t + 1]) @ move.T
            beta[:, t] = b / b.sum(1, keepdims=True)
        post = alpha * beta
        post /= post.sum(2, keepdims=True)
        hot = np.eye(labels)[y]
        grad_move = np.zeros((labels, labels))
        for t in range(steps - 1):
            pair = alpha[:, t, :, None] * move * (x[:, t + 1] * beta[:, t + 1])[:, None]
            grad_move += hot[:, t].T @ hot[:, t + 1] - (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        return hot - post, grad_move, (hot[:, 0] - post[:, 0]).sum(0)


def hash_bound(texts: int) -> int:
    """Texts whose 63-bit hash is below are sampled; above 0 for any number of texts."""
    return min(2**63 - 1, SAMPLE_TEXTS * 2**63 // texts)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[Crf, dict[str, np.ndarray]] | None:
    """A model from labelled texts, or None without any."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select("doc_id", F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    labels = sorted(sizes)

    def count(batches):
        claim("languages")
        counts: dict[str, Counter] = {}

        def out():
            tidy: Counter = Counter()
            for name, own in counts.items():
                for w, n in own.items():
                    if form := bare(w):
                        tidy[name, form] += n
            return {"lang": [k[0] for k in tidy], "word": [k[1] for k in tidy], "n": list(tidy.values())}

        for batch in batches:
            for name, t in zip(batch["lang"], batch["text"], strict=True):
                counts.setdefault(name, Counter()).update(t.split())
            if sum(map(len, counts.values())) > KEPT_COUNTS:
                yield out()
                counts.clear()
        yield out()

    counts = map_rows(rows.select("lang", "text"), count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = saved(counts, "lexicon")
    totals = {r["lang"]: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    shares: dict[str, np.ndarray] = {}
    place, spark = {name: i for i, name in enumerate(labels)}, docs.sparkSession
    least = spark.createDataFrame([(k, LEXICON_SHARE * n) for k, n in totals.items()], "lang string, least double")
    for r in counts.join(F.broadcast(least), "lang").where("n >= least").collect():
        shares.setdefault(r.word, np.zeros(len(labels)))[place[r["lang"]]] = r.n / totals[r["lang"]]
    lexicon = {w: (np.log(p + EPS) - np.log(p + EPS).mean()).astype(np.float32) for w, p in shares.items()}

    def runs(batches):
        for batch in batches:
            out = {"lang": [], "key": [], "words": []}
            for doc_id, name, t in zip(batch["doc_id"], batch["lang"], batch["text"], strict=True):
                words, rng = t.split(), random.Random(doc_id)
                for _ in range(RUNS if words else 0):
                    at = rng.randrange(max(1, len(words) - RUN_WORDS + 1))
                    out["lang"].append(name)
                    out["key"].append(rng.random())
                    out["words"].append(words[at : at + RUN_WORDS])
            yield out

    bounds = spark.createDataFrame([(k, hash_bound(n)) for k, n in sizes.items()], "lang string, bound long")
    chosen = rows.join(F.broadcast(bounds), "lang").where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED)), 1) <= F.col("bound"))
    sample = map_rows(chosen.limit(2 * SAMPLE_TEXTS * len(labels)), runs, "lang string, key double, words array<string>")
    by_lang: dict[str, list[list[str]]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r.key, r.words)):
        by_lang.setdefault(r["lang"], []).append(r.words)
    by_lang = {k: v[: SAMPLE_TEXTS * RUNS] for k, v in by_lang.items()}
    if not by_lang:
        return None
    model, rng, names = Crf(labels), random.Random(SEED), sorted(by_lang)
    sequences, truth = [], []
    for _ in range(SEQUENCES * max(LANGUAGES, len(labels)) // LANGUAGES):
        words, marks = [], []
        while len(words) < LENGTH:
            name = rng.choice(names)
            run = rng.choice(by_lang[name])[: rng.randint(4, RUN_WORDS)]
            words += run
            marks += [place[name]] * len(run)
        sequences.append(words[:LENGTH])
        truth.append(marks[:LENGTH])
    model.fit(Features(lexicon, len(labels)), sequences, truth)
    return model, lexicon


def label(docs: DataFrame, learned: tuple[Crf, dict[str, np.ndarray]] | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``lang_pred, score, segments``: runs of words of one language, as first word, words, language."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)  # bounded: feature table and lexicon

    def run(batches):
        claim("languages")
        learned = shared.value
        if learned:
            model, lexicon = learned
            features = Features(lexicon, len(model.labels))
        many = max(LANGUAGES, len(learned[0].labels) if learned else 0)
        if learned:
            place: dict[str, int] = {}
            scores, solid = np.zeros((0, len(model.labels)), np.float32), np.zeros(0, bool)
        for batch in batches:
            texts = [t or "" for t in batch[text]]
            for a, b in chunks(texts, CHUNK_CHARS * LANGUAGES // many):
                split = [t.split() for t in texts[a:b]]
                size = np.array([len(s) for s in split], np.int64)
                out = {c: batch[c][a:b] for c in keep} | {"lang_pred": ["und"] * (b - a), "score": [0.0] * (b - a), "segments": [[] for _ in split]}
                if learned and size.any():
                    words = [w for s in split for w in s]
                    if len(place) > KEPT_WORDS * LANGUAGES // many:
                        place.clear()
                        scores, solid = scores[:0], solid[:0]
                    if new := [w for w in dict.fromkeys(words) if w not in place]:
                        ids, first, known = features(new)
                        scores = np.concatenate([scores, model.emit(ids, first, known)])
                        solid = np.concatenate([solid, ids[first] != 0])
                        place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
                    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    rows = np.flatnonzero(size)
                    begins = (np.cumsum(size) - size)[rows]
                    post = model.posteriors(scores[at], begins)
                    best = post.argmax(1)
                    counted = np.add.reduceat(solid[at].astype(np.int64), begins)
                    total = np.add.reduceat(post * solid[at][:, None], begins, 0)
                    change = np.ones(len(words), bool)
                    change[1:] = best[1:] != best[:-1]
                    change[begins] = True
                    starts = np.flatnonzero(change)
                    lengths = np.diff(np.append(starts, len(words)))
                    owner = rows[np.searchsorted(begins, starts, "right") - 1]
                    first_word = starts - begins[np.searchsorted(begins, starts, "right") - 1]
                    for i, s, n, k in zip(owner.tolist(), first_word.tolist(), lengths.tolist(), best[starts].tolist(), strict=True):
                        out["segments"][i].append({"start": s, "words": n, "lang": model.labels[k]})
                    for i, n, t in zip(rows.tolist(), counted.tolist(), total, strict=True):
                        if n:
                            k = int(t.argmax())
                            out["lang_pred"][i], out["score"][i] = model.labels[k], float(min(1.0, t[k] / n))
                        else:
                            out["segments"][i] = []
                yield out

    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return map_rows(docs.select(*dict.fromkeys([*keep, text])), run, f"{kept}lang_pred string, score double, segments array<struct<start:int,words:int,lang:string>>")


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Labels for all ``docs``; learned from those with a language that are not held out."""
    return label(docs, learn(docs.where(~held_out()), text, lang), text, keep)
