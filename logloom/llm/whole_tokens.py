"""Token counts by a whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once, before any text is read: a string that is one
pre-token and whose merges end in its own single id. A text's pre-tokens are then looked up in that fixed set;
each hit counts one without merging. Only the others are merged, exactly, and a bounded table keeps their counts.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows are counted each; a null doc_id is
carried along; the string of a special token inside a text counts one; a very long text is worked on in parts that
are cut where no pre-token crosses; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bpe import Bpe, code_points, default_vocabulary, word_starts
from logloom.llm.common import CHUNK_CHARS, chunks, claim, map_rows, ship_file

LIMIT = 1024
#: Merged words that a worker keeps, in each of two generations; bounds memory, not results.
KEPT_WORDS = 150_000
#: A blank between two plain letters always starts a pre-token, so a text may be cut there.
SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def whole_tokens(bpe: Bpe) -> list[str]:
    """Vocabulary strings proved to encode alone as one token."""
    special = set(bpe.special)
    ids, strings = [], []
    for i, raw in bpe.tokens.items():
        try:
            string = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue  # no pre-token consists of broken bytes
        if string and string not in special:
            ids.append(i)
            strings.append(string)
    joined = "".join(strings)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in strings])])[:-1].astype(np.int64)
    words = np.zeros(len(joined), bool)
    words[word_starts(code_points(joined), starts)] = True
    pre_tokens = np.add.reduceat(words, starts) if strings else np.zeros(0)
    alone = [k for k in range(len(strings)) if pre_tokens[k] == 1]
    merged = bpe.merge_many([strings[k].encode() for k in alone])
    return [strings[k] for k, got in zip(alone, merged, strict=True) if np.frombuffer(got, "<u4").tolist() == [ids[k]]]


def parts(text: str, limit: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``limit`` characters; no pre-token lies in two of them."""
    at = 0
    while len(text) - at > 2 * limit and (cut := SAFE_CUT.search(text, at + limit)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Counter:
    """Counts the tokens of texts. ``whole``: strings known to be one token."""

    def __init__(self, bpe: Bpe, whole: frozenset[str], keep: int = KEPT_WORDS):
        self.bpe, self.whole, self.keep = bpe, whole, keep
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}
        names = sorted(bpe.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None

    def sizes(self, words: list[str]) -> list[int]:
        """Tokens of each word, by exact merges. Words in use survive when the older generation is let go."""
        if len(self.recent) > self.keep:
            self.older, self.recent = self.recent, {}
        recent, older, new = self.recent, self.older, []
        for w in set(words):
            if w not in recent:
                if (n := older.get(w)) is None:
                    new.append(w)
                else:
                    recent[w] = n
        merged = self.bpe.merge_many([w.encode("utf-8", "surrogatepass") for w in new])
        recent.update((w, len(ids) // 4) for w, ids in zip(new, merged, strict=True))
        return [recent[w] for w in words]

    def count(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Tokens of each text, and how many of them the shortcut found."""
        total, direct = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        pieces, owner = [], []
        for i, text in enumerate(texts):
            between = [text]
            if self.special and self.special.search(text):
                between = self.special.split(text)
                total[i] += len(between) - 1
            for part in between:
                for piece in parts(part):
                    pieces.append(piece)
                    owner.append(i)
        for a, b in chunks(pieces):
            self._add(pieces[a:b], np.array(owner[a:b], np.int64), total, direct)
        return total.tolist(), direct.tolist()

    def _add(self, pieces: list[str], owner: np.ndarray, total: np.ndarray, direct: np.ndarray) -> None:
        joined = "".join(pieces)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        starts = word_starts(code_points(joined), np.unique(bounds[:-1][bounds[:-1] < bounds[1:]]))
        edges = [*starts.tolist(), len(joined)]
        whole = self.whole
        rest = [(k, w) for k, w in enumerate([joined[x:y] for x, y in zip(edges, edges[1:], strict=False)]) if w not in whole]
        each = owner[np.searchsorted(bounds, starts, "right") - 1]  # the text of each word
        n, words = len(total), np.bincount(each, minlength=len(total))
        total += words
        direct += words
        if rest:
            at = each[[k for k, _ in rest]]
            direct -= np.bincount(at, minlength=n)
            total += np.bincount(at, np.array(self.sizes([w for _, w in rest])) - 1, n).astype(np.int64)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, n_whole`` of every text; ``n_whole``: tokens that the shortcut counted."""
    spark = docs.sparkSession
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        spec = file.read()
    proved = json.dumps(whole_tokens(Bpe(spec))).encode()  # as many strings as the vocabulary at most
    name = ship_file(spark, proved, "whole-tokens")
    vocab = spark.sparkContext.broadcast(spec)  # a fixed file of about 2 MB

    def run(batches):
        counter = _counter(name, vocab)
        for batch in batches:
            texts = [t or "" for t in batch[text]]
            for a, b in chunks(texts):
                total, direct = counter.count(texts[a:b])
                yield {"doc_id": batch["doc_id"][a:b], "n_bytes": batch["n_bytes"][a:b], "n_tokens": total, "n_whole": direct}

    rows = docs.select("doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = map_rows(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long, n_whole long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_whole")


_COUNTERS: dict[str, Counter] = {}


def _counter(name: str, vocab) -> Counter:
    """One counter per worker process and vocabulary; a worker that is used again keeps its words."""
    claim("whole_tokens", _COUNTERS.clear)
    if name not in _COUNTERS:
        _COUNTERS.clear()
        with open(SparkFiles.get(name), encoding="utf-8") as file:
            whole = frozenset(json.load(file))
        _COUNTERS[name] = Counter(Bpe(vocab.value), whole)
    return _COUNTERS[name]
