"""Quality rules by distribution divergence.

A reference for each language holds its shares of character classes and of common words, counted over all its
texts. A document is held against every reference by the Jensen-Shannon distance of both histograms; it passes
if some language is near enough in both. Histograms of short texts are noise, so each distance counts only from
a minimum length on.

References are held in blocks of languages: one block is read in one pass over the documents; with more blocks each
has a pass of its own and the nearest of all passes counts, so memory does not grow with the number of languages.

Defined cases: a null or empty text has no words and fails the base rule; a language counts from ``MIN_WORDS`` words
of its own on, whatever the others have, and a word is common from 0.2 % of its language on, so there are at most 500
a language; a document whose own language has no reference passes on the base rule; without any reference (no
languages, an empty table) only the base rule decides; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bpe import code_points
from logloom.llm.common import chunks, map_rows, saved

COMMON = 0.002
#: A distance counts from so many letters and signs, or words, on.
MIN_CHARS, MIN_WORDS = 250, 25
#: Largest Jensen-Shannon distances (base 2, 0 to 1) of a kept document.
MAX_CHARS, MAX_WORDS = 0.29, 0.45
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
#: Character classes: other, lower, upper, other letter, digit, blank, sentence mark, symbol.
CLASSES = 8
KEPT_ENTRIES = 1_000_000
#: About so many languages make a block; documents judged at once.
BLOCK, ROWS = 50, 500


def class_table() -> np.ndarray:
    """Class of each code point."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            table[cp] = 1 if c.islower() else 2 if c.isupper() else 3
        elif c.isdigit():
            table[cp] = 4
        elif c.isspace():
            table[cp] = 5
    table[[ord(c) for c in ".,;:!?'\"()-"]] = 6
    table[[ord(c) for c in SYMBOLS]] = 7
    return table


_TABLE: list[np.ndarray] = []


def _classes(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(class_table())
    return np.bincount(_TABLE[0][code_points(text)], minlength=CLASSES)


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than blank, tab, line feed, vertical tab, form feed, carriage return."""
    return text.encode("utf-8", "surrogatepass").split()


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Counts by language and class or word (``lang, cls, word, n``), and the words of each language that counts (``lang, total``)."""

    def count(batches):
        seen: Counter = Counter()

        def out():
            keys = list(seen)
            return {"lang": [k[0] for k in keys], "cls": [k[1] if isinstance(k[1], int) else None for k in keys], "word": [k[1] if isinstance(k[1], bytes) else None for k in keys], "n": [seen[k] for k in keys]}

        counts: dict[str, Counter] = {}
        for batch in batches:
            for name, value in zip(batch[lang], batch[text], strict=True):
                if name is not None and value:
                    own = counts.setdefault(name, Counter())
                    own.update(words_of(value))
                    for k, n in enumerate(_classes(value).tolist()):
                        own[k] += n
            if sum(map(len, counts.values())) > KEPT_ENTRIES:
                seen = Counter({(name, k): n for name, own in counts.items() for k, n in own.items() if n})
                yield out()
                counts = {}
        seen = Counter({(name, k): n for name, own in counts.items() for k, n in own.items() if n})
        yield out()

    counts = map_rows(docs.select(text, F.col(lang).cast("string").alias(lang)), count, "lang string, cls int, word binary, n long")
    counts = saved(counts.groupBy("lang", "cls", "word").agg(F.sum("n").alias("n")), "counts")
    each = counts.where("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("total"))
    return counts, saved(each.where(F.col("total") >= MIN_WORDS), "languages")


def references(counts: DataFrame, languages: DataFrame) -> dict[str, tuple[np.ndarray, dict[bytes, float]]]:
    """For each of a block's ``languages`` its class shares and the shares of its common words."""
    rows = counts.join(F.broadcast(languages), "lang").where((F.col("n") >= COMMON * F.col("total")) | F.col("cls").isNotNull())
    found: dict[str, tuple[np.ndarray, dict[bytes, float]]] = {}
    for r in rows.collect():  # at most 1 / COMMON words and CLASSES a language
        own = found.setdefault(r.lang, (np.zeros(CLASSES), {}))
        if r.cls is not None:
            own[0][r.cls] = r.n
        else:
            own[1][bytes(r.word)] = r.n / r.total
    return {name: (c / max(c.sum(), 1), w) for name, (c, w) in found.items()}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of ``p`` to ``q``."""
    m = (p + q) / 2

    def part(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0).sum(1)

    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words in ``size``-word windows that occur twice or more, the first occurrence included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
        mixed ^= mixed >> np.uint64(29)
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(mixed, twice)).tolist()
    windows = [tuple(words[i : i + size]) for i in at]  # the windows themselves decide
    often = Counter(windows)
    covered = np.zeros(len(words), bool)
    for i, w in zip(at, windows, strict=True):
        if often[w] > 1:
            covered[i : i + size] = True
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += bool(line.strip(BLANKS))
        seen.add(line)
    return n


def judge(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, nearest, js_chars, js_words, kept``."""
    counts, languages = word_counts(docs, text, lang)
    blocks = max(1, -(-languages.count() // BLOCK))
    rows = docs.select("doc_id", F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.withColumn("uid", F.xxhash64("doc_id", F.col("text").isNull(), "text", F.col("lang").isNull(), "lang"))
    passes = []
    for k in range(blocks):
        some = languages.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k)
        done = _judged(rows, references(counts, some))
        passes.append(done if blocks == 1 else saved(done, "judged"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = passes[0]
    if blocks > 1:
        best = F.min(F.when(F.col("nearest").isNotNull(), F.struct("worst", "js_words", "nearest", "js_chars"))).alias("best")
        every = reduce(DataFrame.unionByName, passes).groupBy("uid").agg(*[F.first(c).alias(c) for c in ["doc_id", *measures]], F.max("own").alias("own"), best, F.count(F.lit(1)).alias("times"))
        every = every.withColumn("again", F.explode(F.sequence(F.lit(1), F.expr(f"int(times DIV {blocks})"))))  # rows that repeat
        out = every.select("doc_id", *measures, "own", "best.*")
    kept = ~F.col("base_failed") & (~F.col("own") | (F.col("worst") <= 1))
    return out.select("doc_id", *measures, "nearest", "js_chars", "js_words", kept.alias("kept"))


def _judged(rows: DataFrame, refs: dict[str, tuple[np.ndarray, dict[bytes, float]]]) -> DataFrame:
    """Measures of each row, its nearest language of ``refs``, and whether its own language is null or one of them."""
    names = sorted(refs)
    union = {w: i for i, w in enumerate(sorted({w for _, ws in refs.values() for w in ws}))}
    columns = [np.array([union[w] for w in refs[k][1]], np.int64) for k in names]
    shares = [np.array([*refs[k][1].values(), max(0.0, 1 - sum(refs[k][1].values()))]) for k in names]
    classes = [refs[k][0] for k in names]
    shared = rows.sparkSession.sparkContext.broadcast((names, union, columns, shares, classes))  # a block

    def run(batches):
        names, union, columns, shares, classes = shared.value
        find, known = union.get, {None, *names}
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for a, b in ((x, min(x + ROWS, b)) for a, b in chunks(texts) for x in range(a, b, ROWS)):
                out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}
                chars, common = np.zeros((b - a, CLASSES)), np.zeros((b - a, len(union)))
                for i, t in enumerate(texts[a:b]):
                    words = words_of(t)
                    n, repeat = len(words), repeated_words(words)
                    hits = np.fromiter((k for k in map(find, words) if k is not None), np.int64)
                    common[i] = np.bincount(hits, minlength=len(union))
                    chars[i] = _classes(t)
                    out["n_words"].append(n)
                    out["word_chars"].append(len(t) - sum(map(t.count, BLANKS)))
                    out["n_symbols"].append(sum(map(t.count, SYMBOLS)))
                    out["n_dup_lines"].append(duplicate_lines(t))
                    out["n_repeat_words"].append(repeat)
                    out["base_failed"].append(n < 10 or 100 * repeat > 20 * n)
                n = np.array(out["n_words"], float)
                total = np.maximum(chars.sum(1), 1)
                js = np.zeros((2, max(len(names), 1), b - a))
                for k in range(len(names)):
                    js[0, k] = js_distance(chars / total[:, None], classes[k])
                    own = common[:, columns[k]]
                    js[1, k] = js_distance(np.column_stack([own, n - own.sum(1)]) / np.maximum(n, 1)[:, None], shares[k])
                worst = np.maximum(np.where(total >= MIN_CHARS, js[0] / MAX_CHARS, 0), np.where(n >= MIN_WORDS, js[1] / MAX_WORDS, 0))
                near = np.lexsort((js[1], worst), axis=0)[0] if names else np.zeros(b - a, int)
                row = np.arange(b - a)
                out["uid"], out["doc_id"] = batch["uid"][a:b], batch["doc_id"][a:b]
                out["own"] = [x in known for x in batch["lang"][a:b]]
                out["nearest"] = [names[k] if names else None for k in near]
                out["js_chars"], out["js_words"] = js[0, near, row], js[1, near, row]
                out["worst"] = worst[near, row]
                yield out

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, nearest string, js_chars double, js_words double, worst double, own boolean"
    return map_rows(rows, run, schema)
