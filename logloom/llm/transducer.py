"""BPE encoding through a minimal acyclic transducer.

Frequent words are compiled into a minimal subsequential automaton: equal suffixes share states and the ids of
a word are the joined outputs of its arcs. The automaton is one flat file, fetched once per executor and
memory-mapped by its workers. Words it does not accept are merged exactly, so its size changes speed,
never results.

Defined cases: a null or empty text has no ids and decodes to the empty string; repeated rows are encoded each;
special tokens inside a text become their ids; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bpe import Bpe, Encoder, code_points, default_vocabulary, word_starts
from logloom.llm.common import chunks, claim, map_rows, saved, ship_file

#: A word is compiled into the automaton from this share of all repeated words on; bounds it to 1 / share words.
LEAST_SHARE = 4e-6
KEPT_WORDS = 1_000_000
NONE: tuple[int, ...] = ()


class _State:
    __slots__ = ("arcs", "final", "tail", "number")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte -> [state, output]
        self.final, self.tail, self.number = False, NONE, -1


def _shared(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> np.ndarray:
    """A minimal transducer of word -> ids as one flat array of 32-bit integers.

    Words are added in byte order; the part of the last word that no later word can share is frozen and
    replaced by an equal state seen before, if there is one.
    """
    register: dict[tuple, _State] = {}
    states: list[_State] = []
    path, last = [_State()], b""

    def freeze(state: _State) -> _State:
        key = (state.final, state.tail, tuple((b, t.number, out) for b, (t, out) in state.arcs.items()))
        if (known := register.get(key)) is None:
            state.number = len(states)
            states.append(state)
            register[key] = known = state
        return known

    def shrink(to: int) -> None:
        while len(path) > to + 1:
            state = freeze(path.pop())
            path[-1].arcs[last[len(path) - 1]][0] = state

    for word in sorted(entries):
        out = tuple(entries[word])
        keep = _shared(word, last)
        shrink(keep)
        for b in word[keep:]:
            state = _State()
            path[-1].arcs[b] = [state, NONE]
            path.append(state)
        for i in range(keep):  # outputs move towards the start as far as all words on an arc share them
            arc = path[i].arcs[word[i]]
            n = _shared(arc[1], out)
            rest, arc[1], out = arc[1][n:], arc[1][:n], out[n:]
            if rest:
                for other in path[i + 1].arcs.values():
                    other[1] = rest + other[1]
                if path[i + 1].final:
                    path[i + 1].tail = rest + path[i + 1].tail
        if keep < len(word):
            path[keep].arcs[word[keep]][1] = out
            out = NONE
        path[-1].final, path[-1].tail = True, out
        last = word
    shrink(0)
    root = freeze(path[0])

    pool: list[int] = []
    places: dict[tuple, int] = {NONE: 0}

    def place(ids: tuple) -> tuple[int, int]:
        if ids not in places:
            places[ids] = len(pool)
            pool.extend(ids)
        return places[ids], len(ids)

    arcs = sorted((s.number << 8 | b, t.number, *place(out)) for s in states for b, (t, out) in s.arcs.items())
    ends = [(s.final, *place(s.tail)) for s in states]
    columns = np.array(arcs, np.int32).reshape(-1, 4).T
    head = [root.number, len(arcs), len(states), len(pool)]
    return np.concatenate([np.array(head, np.int32), columns.ravel(), np.array(ends, np.int32).T.ravel(), np.array(pool, np.int32)])


class Transducer:
    """Looks up many words at once in a compiled lexicon."""

    def __init__(self, flat: np.ndarray):
        self.root, n, m, k = (int(x) for x in flat[:4])
        at = 4 + 4 * n
        self.keys, self.target, self.out_at, self.out_size = flat[4:at].reshape(4, n)
        self.final, self.end_at, self.end_size = flat[at : at + 3 * m].reshape(3, m)
        self.pool = flat[at + 3 * m : at + 3 * m + k].astype("<u4").tobytes()

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        return cls(np.memmap(path, np.int32, "r"))

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        """Little-endian ids of each word, None for a word that is not in the lexicon."""
        out: list[bytes | None] = [None] * len(words)
        if not len(self.keys) or not words:
            return out
        size = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(size) - size
        letters = np.frombuffer(b"".join(words), np.uint8)
        rows, state, step = np.arange(len(words)), np.full(len(words), self.root), 0
        arcs = np.zeros((len(words), 0), np.int64)  # of the words still followed
        while len(rows):
            over = size[rows] == step
            for i, s, taken in zip(rows[over].tolist(), state[over].tolist(), arcs[over].tolist(), strict=True):
                if self.final[s]:
                    spans = [(self.out_at[a], self.out_size[a]) for a in taken] + [(self.end_at[s], self.end_size[s])]
                    out[i] = b"".join(self.pool[4 * p : 4 * (p + n)] for p, n in spans if n)
            rows, state, arcs = rows[~over], state[~over], arcs[~over]
            key = state.astype(np.int64) << 8 | letters[first[rows] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            rows, arc = rows[hit], arc[hit]
            state, arcs = self.target[arc], np.column_stack([arcs[hit], arc])
            step += 1
        return out


def frequent_words(docs: DataFrame, text: str = "text", least: float = LEAST_SHARE) -> list[str]:
    """Words that make up at least ``least`` of all repeated words: at most 1 / least.

    Counts are combined in the tasks and by one shuffle.
    """

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            texts = [t for t in batch[text] if t]
            for a, b in chunks(texts):
                joined = "".join(texts[a:b])
                size = np.cumsum([len(t) for t in texts[a:b]])
                edges = [*word_starts(code_points(joined), np.append(0, size[:-1])).tolist(), len(joined)]
                seen.update([joined[x:y] for x, y in zip(edges, edges[1:], strict=False)])
            if len(seen) > KEPT_WORDS:
                yield {"word": list(seen), "n": list(seen.values())}
                seen.clear()
        yield {"word": list(seen), "n": list(seen.values())}

    counts = map_rows(docs.select(text), count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = saved(counts.where("n > 1"), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r.word for r in counts.where(F.col("n") >= total * least).select("word").collect()]


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", least_share: float = LEAST_SHARE) -> DataFrame:
    """``doc_id, ids binary`` (little-endian unsigned 32-bit) and ``decoded string`` of every text."""
    spark = docs.sparkSession
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        spec = file.read()
    bpe = Bpe(spec)
    words = [w.encode("utf-8", "surrogatepass") for w in frequent_words(docs, text, least_share)]
    entries = {w: np.frombuffer(ids, "<u4").tolist() for w, ids in zip(words, bpe.merge_many(words), strict=True)}
    name = ship_file(spark, compile_lexicon(entries).tobytes(), "lexicon.bin")
    vocab = spark.sparkContext.broadcast(spec)  # a fixed file of about 2 MB

    def run(batches):
        encoder = _encoder(name, vocab)
        for batch in batches:
            texts = [t or "" for t in batch[text]]
            for a, b in chunks(texts):
                ids = encoder.encode(texts[a:b])
                yield {"doc_id": batch["doc_id"][a:b], "ids": ids, "decoded": [encoder.bpe.decode(x) for x in ids]}

    return map_rows(docs.select("doc_id", text), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, vocab) -> Encoder:
    """One encoder per worker process and lexicon; a worker that is used again keeps its words."""
    claim("transducer", _ENCODERS.clear)
    if name not in _ENCODERS:
        _ENCODERS.clear()
        bpe = Bpe(vocab.value)
        lexicon = Transducer.mapped(SparkFiles.get(name))

        def resolve(words: list[str]) -> list[bytes]:
            raw = [w.encode("utf-8", "surrogatepass") for w in words]
            found = lexicon.lookup(raw)
            merged = iter(bpe.merge_many([w for w, ids in zip(raw, found, strict=True) if ids is None]))
            return [next(merged) if ids is None else ids for ids in found]

        _ENCODERS[name] = Encoder(bpe, resolve)
    return _ENCODERS[name]
