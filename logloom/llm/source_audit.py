"""How sources of a language differ in their words, by chunk factorization.

Words never cross white space, so white-space chunks are counted first: a task counts the chunks of its documents and
combines them by language and chunk, with the occurrences of each source. One shuffle brings the counts of a chunk
together; there it is split into terms, once, and its counts go to each of them. A second shuffle brings the terms of a
language together. Occurrences add up. Distinct documents do not, as a document may hold a term in several chunks: a
chunk of three documents or more decides its terms; a chunk of one or two names them by row number, and a term of such
chunks only counts distinct names, of which three suffice. All counts are sums of parts, so a task may pass on what it
holds at any time: memory is bounded, and a frequent chunk has one row for each part, not for each occurrence.

Each kept term has a smoothed probability in every source and language, in exact integers (p, at most 1e9 + 1); the
divergence of p from q is the sum of (p - q)^2 div q over the language's terms. Sources of one language are compared in
blocks of dense arrays inside the tasks, which put out sums, never pairs of a term.

Defined cases: null text, lang and source are ''; a row is a document, so repeated rows count each, also with one
doc_id; a group without terms is there with counts of 0; a language without kept terms has pairs of value 0 and no
terms; equal values rank by the bytes of the item; an empty table gives no rows; other columns are ignored.
Rows are numbered by their place in the input files, so ``docs`` should come from a scan or a written table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import saved
from logloom.operators.lookup import left_lookup

#: A term is kept from this number of documents on.
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Occurrences, bytes and rows that a task holds before it passes its counts on.
HELD_WORDS, HELD_BYTES, HELD_ROWS = 4_000_000, 48 << 20, 400_000
#: Sums of a block of pairs of sources, and probabilities compared at a time.
PAIR_CELLS, TERM_CELLS = 1_000_000, 500_000
#: Groups up to this number (some 100 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 200_000
#: Letters beyond ASCII stay, A-Z become small, all else separates terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

Sums = tuple[np.ndarray, np.ndarray, np.ndarray]  # key, place, n; sorted and unique by (key, place)


def _starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values of the columns begins."""
    n = len(sorted_columns[0])
    if not n:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for column in sorted_columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _summed(key: np.ndarray, place: np.ndarray, n: np.ndarray) -> Sums:
    code = key.astype(np.int64) << 32 | place
    order = np.argsort(code)
    code = code[order]
    first = _starts(code)
    return code[first] >> 32, code[first] & 0xFFFFFFFF, np.add.reduceat(n[order], first) if len(first) else n


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers start, start + 1, .. of each run."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Each run of the rows of ``values`` as one binary value."""
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32).tobytes()), data])


def _values(column: pa.Array, kind: np.dtype, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of entries of ``width`` values in each binary value of a column, and all its values."""
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset)
    n = int(cuts[-1] - cuts[0]) // kind.itemsize
    values = np.frombuffer(data, kind, n, int(cuts[0])) if n else np.empty(0, kind)
    return np.diff(cuts) // (width * kind.itemsize), values


def _packed(sums: Sums, n_keys: int, kind: np.dtype) -> pa.Array:
    """(place, n) pairs of each key; a number too large for its type is several pairs."""
    key, place, n = sums
    top = np.iinfo(kind).max
    times = -(-n // top)
    at = np.repeat(np.arange(len(n)), times)
    last = np.append(at[1:] != at[:-1], True)[: len(at)]
    part = np.where(last, n[at] - (times[at] - 1) * top, top)
    return _binary(np.column_stack([place[at], part]).astype(kind), np.searchsorted(key[at], np.arange(n_keys + 1)))


def _names(key: np.ndarray, name: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names of each key, sorted by key; ``many`` also where there are enough of them, whose names go."""
    few = ~many[key]
    key, name = key[few], name[few]
    order = np.lexsort((name, key))
    key, name = key[order], name[order]
    new = _starts(key, name)
    key, name = key[new], name[new]
    many = many | (np.bincount(key, minlength=len(many)) >= LEAST_DOCUMENTS)
    few = ~many[key]
    return key[few], name[few], many


def _batches(columns: dict[str, pa.Array], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def chunk_counts(docs: DataFrame, kind: np.dtype) -> DataFrame:
    """``word, names, uses`` of rows ``lang, place, row, raw``: partial counts of each task. A word is a language, a blank and a chunk."""

    def reduced(vocab: dict[bytes, int], ids: list[np.ndarray], langs: list[str], places: list[int], rows: list[int]):
        names = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(names)}
        lang, place, row = np.array([number[x] for x in langs]), np.array(places, np.int64), np.array(rows, np.int64)
        n_docs, rank = len(ids), np.argsort(place, kind="stable")  # documents in the order of their sources
        at = np.empty(n_docs, np.int64)
        at[rank] = np.arange(n_docs)
        doc = np.repeat(np.arange(n_docs), [len(x) for x in ids])
        code = np.concatenate(ids).astype(np.int64) * len(names) + lang[doc]
        code *= n_docs
        code += at[doc]
        code.sort()  # by word, then source, then document
        key, doc = np.divmod(code, n_docs)
        held = _starts(code)  # each chunk once a document
        key_of, doc_of = key[held], rank[doc[held]]
        place = place[rank][doc]
        used = _starts(key, place)
        uses = key[used], place[used], np.diff(np.append(used, len(key)))
        first = _starts(key_of)
        found, times = key_of[first], np.diff(np.append(first, len(key_of)))
        few = np.repeat(times < LEAST_DOCUMENTS, times)
        cuts = np.append(0, np.cumsum(np.where(times < LEAST_DOCUMENTS, times, 0)))
        own = np.searchsorted(found, uses[0])
        heads = [lang.encode() + b" " for lang in names]
        chunks = list(vocab)
        words = [heads[k % len(names)] + chunks[k // len(names)] for k in found.tolist()]
        yield from _batches(
            {"word": pa.array(words, pa.binary()), "names": _binary(row[doc_of[few]], cuts), "uses": _packed((own, *uses[1:]), len(found), kind)}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            return defaultdict(count().__next__), [], [], [], []

        held, size, n = fresh(), 0, 0
        for batch in batches:
            for raw, *values in zip(*(batch.column(i).to_pylist() for i in (3, 0, 1, 2)), strict=True):
                words = raw.split() if raw else ()  # bytes are split at ASCII white space only
                if not words:
                    continue
                vocab, ids, *facts = held
                ids.append(np.fromiter(map(vocab.__getitem__, words), np.int32, len(words)))
                for to, value in zip(facts, values, strict=True):
                    to.append(value)
                n += len(words)
                size += len(raw)
                if n > HELD_WORDS or size > HELD_BYTES or len(vocab) > HELD_ROWS:
                    yield from reduced(*held)
                    held, size, n = fresh(), 0, 0
        if held[1]:
            yield from reduced(*held)

    return docs.mapInArrow(run, "word binary, names binary, uses binary")


def _gathered(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[list[pa.Array]]:
    """Columns word, names, uses of many rows at a time; with ``whole``, sorted rows of one word stay together."""
    held, rows, size = [], 0, 0

    def columns() -> list[pa.Array]:
        return [x.chunk(0) for x in pa.Table.from_batches(held).combine_chunks().columns]

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows > HELD_ROWS or size > HELD_BYTES:
            found = columns()
            end = rows
            if whole:
                last = found[0][rows - 1]
                while end and found[0][end - 1].equals(last):
                    end -= 1
            if end:
                yield [x.slice(0, end) for x in found]
                held = [pa.RecordBatch.from_arrays([x.slice(end) for x in found], schema=batch.schema)] if end < rows else []
                rows, size = rows - end, sum(x.nbytes for x in held)
    if rows:
        yield columns()


def _merged(words: pa.Array, names: pa.Array, uses: pa.Array, kind: np.dtype):
    """The distinct words, and the rows' key, sums, names with their keys, and words of enough documents in one part."""
    coded = words.dictionary_encode()
    key, found = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    sizes, pairs = _values(uses, kind, 2)
    sums = _summed(np.repeat(key, sizes), pairs[::2].astype(np.int64), pairs[1::2].astype(np.int64))
    many = np.zeros(len(found), bool)
    sizes, name = _values(names, np.dtype(np.int64), 1)
    many[key[sizes == 0]] = True  # no names: enough documents in one part
    return found, sums, np.repeat(key, sizes), name, many


def term_counts(counts: DataFrame, kind: np.dtype) -> DataFrame:
    """``word, names, uses`` of terms from counts of chunks that are together: each chunk is split into terms once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _gathered(batches, False):
            found, (owner, place, n), named, name, many = _merged(*columns, kind)
            # parts of a chunk have different documents, so its names are distinct as they are
            order = np.argsort(named, kind="stable")
            named, name = named[order], name[order]
            many |= np.bincount(named, minlength=len(many)) >= LEAST_DOCUMENTS
            parts: list[bytes] = []
            sizes = np.empty(len(found), np.int64)
            for k, word in enumerate(found.to_pylist()):
                at = word.rindex(b" ") + 1
                own = word[at:].translate(_FOLD).split()
                sizes[k] = len(own)
                parts += [word[:at] + term for term in own]
            if not parts:
                continue
            of = np.repeat(np.arange(len(found)), sizes)  # the chunk of each term occurrence
            coded = pa.array(parts, pa.binary()).dictionary_encode()
            term, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary

            def handed(keys: np.ndarray, of=of) -> tuple[np.ndarray, np.ndarray]:
                """Of entries sorted by chunk: which entry, and the term occurrence it goes to."""
                ends = np.cumsum(np.bincount(keys, minlength=int(of.max()) + 1))
                size = np.diff(ends, prepend=0)
                return _spread((ends - size)[of], size[of]), np.repeat(np.arange(len(of)), size[of])

            entry, to = handed(owner)
            sums = _summed(term[to], place[entry], n[entry])
            entry, to = handed(named)
            enough = np.zeros(len(terms), bool)
            enough[term[many[of]]] = True
            named, name, enough = _names(term[to], name[entry], enough)
            cuts = np.append(0, np.cumsum(np.bincount(named, minlength=len(terms))))
            yield from _batches({"word": terms, "names": _binary(name, cuts), "uses": _packed(sums, len(terms), kind)})

    return counts.mapInArrow(run, "word binary, names binary, uses binary")


def kept_terms(terms: DataFrame, kind: np.dtype) -> DataFrame:
    """``lang, term, total, places, ns`` of the terms in enough documents, from rows that are together and sorted by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _gathered(batches, True):
            found, (owner, place, n), named, name, many = _merged(*columns, kind)
            _, _, many = _names(named, name, many)
            kept = np.flatnonzero(many)
            if not len(kept):
                continue
            mine = many[owner]
            owner, place, n = owner[mine], place[mine], n[mine]
            first = _starts(owner)  # every kept term has uses
            cuts = pa.array(np.append(first, len(owner)).astype(np.int32))
            words = [w.rsplit(b" ", 1) for w in found.take(pa.array(kept)).to_pylist()]
            yield from _batches(
                {
                    "lang": pa.array([w[0].decode() for w in words], pa.string()),
                    "term": pa.array([w[1].decode() for w in words], pa.string()),
                    "total": pa.array(np.add.reduceat(n, first)),
                    "places": pa.ListArray.from_arrays(cuts, pa.array(place.astype(np.int32))),
                    "ns": pa.ListArray.from_arrays(cuts, pa.array(n)),
                }
            )

    return terms.mapInArrow(run, "lang string, term string, total long, places array<int>, ns array<long>")


def _named(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def _probability(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    if n.max(initial=0) < 9_000_000_000:
        return 1 + SCALE * (n + 1) // total
    return np.array([1 + SCALE * (a + 1) // b for a, b in zip(n.tolist(), np.broadcast_to(total, n.shape).tolist(), strict=True)], np.int64)


class _Comparison:
    """Sums and best terms of the sources ``low .. low + height`` of one language."""

    def __init__(self, lang: str, low: int, height: int, group_n: list[int], n_terms: int, lang_n: int, top: int):
        self.lang, self.low, self.top = lang, low, top
        self.group_n, self.n_terms, self.lang_n = np.array(group_n, np.int64), n_terms, lang_n
        self.none = _probability(np.zeros(len(group_n), np.int64), self.group_n + n_terms)
        self.sums = np.zeros((min(height, len(group_n) - low), len(group_n)), np.int64)
        self.best: tuple = (np.empty(0, np.int64), np.empty(0, np.int64), [])

    def add(self, words: pa.Array, total: pa.Array, places: pa.ListArray, ns: pa.ListArray) -> None:
        """Terms of the language, in order, with their uses."""
        step = max(1, TERM_CELLS // len(self.none))
        for at in range(0, len(words), step):
            self._add(*(x.slice(at, step) for x in (words, total, places, ns)))

    def _add(self, words: pa.Array, total: pa.Array, places: pa.ListArray, ns: pa.ListArray) -> None:
        place, n = (x.flatten().to_numpy().astype(np.int64) for x in (places, ns))
        line = np.repeat(np.arange(len(words)), places.value_lengths().to_numpy())
        p = _probability(n, self.group_n[place] + self.n_terms)
        table = np.tile(self.none, (len(words), 1))
        table[line, place] = p
        for k in range(len(self.sums)):
            off = table[:, self.low + k, None] - table
            self.sums[k] += (off * off // table).sum(0)
        q = _probability(total.to_numpy().astype(np.int64), np.int64(self.lang_n + self.n_terms))[line]
        more = (p > q) & (place >= self.low) & (place < self.low + len(self.sums))
        place, value, line = place[more], ((p - q) ** 2 // q)[more], line[more]
        # rows come in the order of the terms, so what was there before goes first among equals
        old = len(self.best[2])
        at = np.append(np.arange(old), old + line)
        place, value = np.append(self.best[0], place), np.append(self.best[1], value)
        order = np.lexsort((np.arange(len(at)), -value, place))
        rank = np.arange(len(order)) - np.searchsorted(place[order], place[order])
        order = order[rank < self.top]
        at = at[order]
        new = dict(zip((lines := np.unique(at[at >= old] - old)).tolist(), words.take(pa.array(lines)).to_pylist(), strict=True))
        self.best = place[order], value[order], [self.best[2][k] if k < old else new[k - old] for k in at.tolist()]

    def out(self) -> pa.RecordBatch:
        a, b = (x.ravel() for x in np.indices(self.sums.shape))
        place, value, words = self.best
        columns = [
            pa.array([self.lang] * (len(a) + len(place)), pa.string()),
            pa.array(np.append(a + self.low, place)),
            pa.array(np.append(b, np.zeros(len(place), np.int64)), mask=np.append(np.zeros(len(a), bool), np.ones(len(place), bool))),
            pa.array([None] * len(a) + words, pa.string()),
            pa.array(np.append(self.sums.ravel(), value)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "term", "value"])


def _compared(kept: DataFrame, langs: DataFrame, limit: int, top: int) -> DataFrame:
    """``lang, a, b, term, value``: parts of the sums of pairs of sources (b), and the best terms of each source (term)."""
    rows = left_lookup(kept, langs.withColumnRenamed("lang", "r_lang"), ["lang"], broadcast_rows=limit)
    # a block of sources against all sources of the language has a bounded number of sums
    rows = rows.withColumn("height", F.expr(f"greatest(1, {PAIR_CELLS} DIV size(group_n))"))
    rows = rows.withColumn("block", F.explode(F.expr("sequence(0L, (size(group_n) - 1) DIV height)")))
    rows = rows.select("lang", "block", "term", "height", "total", "places", "ns", "group_n", "n_terms", "lang_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, work = None, None
        for batch in batches:
            columns = [batch.column(i) for i in range(10)]
            runs = _starts(columns[0].dictionary_encode().indices.to_numpy(), columns[1].to_numpy())
            for a, b in zip(runs.tolist(), [*runs[1:].tolist(), batch.num_rows], strict=True):
                lang, block, height, group_n, n_terms, lang_n = (columns[i][a].as_py() for i in (0, 1, 3, 7, 8, 9))
                if now != (lang, block):
                    if work is not None:
                        yield work.out()
                    now, work = (lang, block), _Comparison(lang, block * height, height, group_n, n_terms, lang_n, top)
                work.add(*(columns[i].slice(a, b - a) for i in (2, 4, 5, 6)))
        if work is not None:
            yield work.out()

    rows = rows.sortWithinPartitions("lang", "block", "term")
    return rows.mapInArrow(run, "lang string, a long, b long, term string, value long")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, text: str = "text", top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``. Part ``pair``: divergence from every other source of the language.
    Part ``term``: the ``top`` terms that a source uses more than its language does."""
    groups = docs.select(_named("lang"), _named("source")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = saved(groups.withColumn("place", place), "groups")
    n_groups = groups.count()
    limit = BROADCAST_GROUPS if n_groups <= BROADCAST_GROUPS else 0
    kind = np.dtype("<u2" if n_groups <= 1 << 16 else "<u4")

    side = groups.select(F.col("lang").alias("r_lang"), F.col("source").alias("r_source"), "place")
    rows = docs.select(_named("lang"), _named("source"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("binary").alias("raw"))
    rows = left_lookup(rows, side, ["lang", "source"], broadcast_rows=limit).select("lang", "place", "row", "raw")
    terms = term_counts(chunk_counts(rows, kind).repartition("word"), kind)
    kept = saved(kept_terms(terms.repartition("word").sortWithinPartitions("word"), kind), "terms")

    uses = kept.select("lang", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("ns").alias("n"))))
    sums = uses.groupBy("lang", "place").agg(F.sum("n").alias("group_n"))
    all_ = groups.join(sums, ["lang", "place"], "left").groupBy("lang")
    # one entry a source
    all_ = all_.agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("group_n", F.lit(0)).alias("n")))).alias("_n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("total").alias("lang_n"))
    langs = saved(langs.join(all_.select("lang", F.col("_n.n").alias("group_n")), "lang"), "langs")

    found = saved(_compared(kept, langs, limit, top), "compared")
    sources = groups.select("lang", "source", F.col("place").cast("long").alias("a"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("place").cast("long").alias("b"))
    sums = found.where("b IS NOT NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    grid = sources.join(others, "lang").where("a <> b")  # the rows asked for: every other source of the language
    pairs = grid.join(sums, ["lang", "a", "b"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    terms = found.where("term IS NOT NULL").withColumnRenamed("term", "item").join(sources, ["lang", "a"])
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term").where(F.col("rank") <= top))
